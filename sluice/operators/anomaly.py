"""Anomaly rules on running statistics per key.

Each rule looks at the earlier rows of its key only and needs five of them. The
row joins the statistics afterwards, flagged or not. Rows that an earlier rule
suppressed take no part in a later rule's statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import AnomalyRule
from ..functions.numbers import as_double, field_or_null
from ..session import cut_lineage
from .dedup import with_position
from .ordered import CHUNK, HOT_ROWS, Split, before_chunk, hot_only, split_hot_keys
from .rolling import STATS, rolling_stats
from .verdict import ANOMALY, FAILURES, LIVE, POSITION, append_failure, failure, with_verdict

DETECTOR = "AnomalyDetector"
MINIMUM_SAMPLES = 5
KEY = "_anomaly_key"
_N = STATS[0]
_VALUE, _MEAN, _SD, _FLAG, _HALO = "_value", "_mean", "_sd", "_flag", "_halo"
_QUARTILES = "_quartiles"
_AT = "_at_sample"


def anomaly_key(df: DataFrame, key: str | None, stream_key: str) -> Column:
    return F.coalesce(field_or_null(df, key or "customerId").cast("string"), F.lit(stream_key))


def _outside(rule: AnomalyRule) -> Column:
    """The verdict from the statistics columns; false while samples are few."""
    value, enough = F.col(_VALUE), F.col(_N) >= MINIMUM_SAMPLES
    limit = F.lit(float(rule.threshold))
    if rule.method == "THRESHOLD":
        hit = value < limit
    elif rule.method == "IQR_EXACT":
        low, high = F.get(F.col(_QUARTILES), 0), F.get(F.col(_QUARTILES), 1)
        hit = (value < low - limit * (high - low)) | (value > high + limit * (high - low))
    else:
        hit = (F.col(_SD) > 0) & (F.abs(value - F.col(_MEAN)) > limit * F.col(_SD))
    return F.coalesce(enough & hit & ~F.isnan(value), F.lit(False))


Moments = tuple[Column, Column, Column]


def merge_moments(a: Moments, b: Moments) -> Moments:
    """Count, mean and squared deviations of two disjoint samples together."""
    (na, ma, qa), (nb, mb, qb) = [
        (F.coalesce(n, F.lit(0)), F.coalesce(m, F.lit(0.0)), F.coalesce(q, F.lit(0.0))) for n, m, q in (a, b)
    ]
    n, gap = na + nb, mb - ma
    both = (na > 0) & (nb > 0)
    mean = F.when(na == 0, mb).when(nb == 0, ma).otherwise(ma + gap * nb / F.when(n > 0, n))
    return n, mean, F.when(both, qa + qb + gap * gap * na * nb / F.when(n > 0, n)).otherwise(qa + qb)


def _cumulative(split: Split, initial: DataFrame | None = None) -> Split:
    """Count, mean and sample deviation of all earlier values of the key, those
    of earlier runs (``initial``) included."""
    frame = split.window().rowsBetween(Window.unboundedPreceding, -1)
    value = F.col(_VALUE)
    if not split.hot and initial is None:
        stats = {
            _N: F.count(value).over(frame),
            _MEAN: F.avg(value).over(frame),
            _SD: F.stddev_samp(value).over(frame),
        }
        return split.with_rows(split.rows.withColumns(stats))
    rows = split.rows.withColumns(
        {"_nb": F.count(value).over(frame), "_mb": F.avg(value).over(frame), "_vb": F.var_pop(value).over(frame)}
    )
    moments = (F.col("_nb"), F.col("_mb"), F.col("_vb") * F.col("_nb"))
    if split.hot:
        rows = rows.join(F.broadcast(_carried_moments(split)), [split.key, CHUNK], "left")
        moments = merge_moments((F.col("_na"), F.col("_ma"), F.col("_qa")), moments)
    if initial is not None:
        rows = rows.join(initial.toDF(split.key, "_n0", "_m0", "_q0"), split.key, "left")
        moments = merge_moments((F.col("_n0"), F.col("_m0"), F.col("_q0")), moments)
    n, mean, squares = moments
    merged = rows.withColumns({_N: n, _MEAN: mean, _SD: F.when(n > 1, F.sqrt(squares / F.when(n > 1, n - 1)))})
    return split.with_rows(merged.drop("_na", "_ma", "_qa", "_nb", "_mb", "_vb", "_n0", "_m0", "_q0"))


def _carried_moments(split: Split) -> DataFrame:
    """Per chunk of a cut key: count, mean and squared deviations of everything
    before it. Sums are taken around the key's mean, so nothing cancels."""
    value = F.col(_VALUE)
    parts = (
        hot_only(split)
        .groupBy(split.key, CHUNK)
        .agg(F.count(value).alias("_c"), F.avg(value).alias("_m"), (F.var_pop(value) * F.count(value)).alias("_q"))
    )
    whole = Window.partitionBy(split.key)
    earlier = before_chunk(parts, split.key)
    centre = F.sum(F.col("_c") * F.col("_m")).over(whole) / F.sum("_c").over(whole)
    shifted = parts.withColumn("_centre", centre).withColumn("_d", F.col("_m") - F.col("_centre"))
    summed = shifted.select(
        split.key,
        CHUNK,
        "_centre",
        F.sum("_c").over(earlier).alias("_na"),
        F.sum(F.col("_c") * F.col("_d")).over(earlier).alias("_s1"),
        F.sum(F.col("_q") + F.col("_c") * F.col("_d") * F.col("_d")).over(earlier).alias("_s2"),
    ).where(F.col("_na") > 0)
    return summed.select(
        split.key,
        CHUNK,
        "_na",
        (F.col("_centre") + F.col("_s1") / F.col("_na")).alias("_ma"),
        F.greatest(F.lit(0.0), F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("_na")).alias("_qa"),
    )


def _with_halo(split: Split, rows_before: int) -> DataFrame:
    """Copy to each later chunk the last samples its first rows look back on. Only the
    last ``rows_before`` samples of a chunk can be among them, so only those are
    compared with the chunks' starts."""
    samples = hot_only(split).where(F.col(_VALUE).isNotNull())
    parts = samples.groupBy(split.key, CHUNK).agg(F.count(F.lit(1)).alias("_c"))
    start = F.coalesce(F.sum("_c").over(before_chunk(parts, split.key)), F.lit(0))
    chunk = F.struct(F.col(CHUNK).alias("chunk"), F.col("_start").alias("start"), F.col("_c").alias("size"))
    starts = parts.withColumn("_start", start).groupBy(split.key).agg(F.sort_array(F.collect_list(chunk)).alias("_starts"))
    from_end = F.row_number().over(Window.partitionBy(*split.groups).orderBy(*[F.desc(c) for c in split.order]))
    last = samples.withColumn("_from_end", from_end).where(F.col("_from_end") <= rows_before)
    last = last.join(F.broadcast(starts), split.key)
    own = F.get(F.filter("_starts", lambda s: s["chunk"] == F.col(CHUNK)), 0)
    last = last.withColumn("_at", own["start"] + own["size"] - F.col("_from_end") + 1)
    needed = F.filter(
        "_starts", lambda s: (s["chunk"] > F.col(CHUNK)) & (s["start"] <= F.col("_at") + F.lit(rows_before - 1))
    )
    copies = last.withColumn("_to", F.explode(needed)).withColumn(CHUNK, F.col("_to.chunk"))
    copies = copies.drop("_from_end", "_starts", "_at", "_to").withColumn(_HALO, F.lit(True))
    return split.rows.withColumn(_HALO, F.lit(False)).unionByName(copies)


def _after_samples(split: Split, earlier: DataFrame) -> Split:
    """The samples of earlier runs (key, at, value) as rows in front of their keys' rows, in
    the first chunk of a key that is cut; ``_AT`` is below zero for them."""
    chunk = F.max(CHUNK) if split.hot else F.lit(None).cast("int")
    present = split.rows.groupBy(split.key).agg(chunk.alias("_cut"))
    ahead = earlier.select(F.col("key").alias(split.key), F.col("at").alias(_AT), F.col("value").alias(_VALUE)).join(present, split.key)
    if split.hot:
        ahead = ahead.withColumn(CHUNK, F.when(F.col("_cut").isNotNull(), 0))
    rows = split.rows.withColumn(_AT, F.lit(0).cast("bigint")).unionByName(ahead.drop("_cut"), allowMissingColumns=True)
    return Split(rows, split.key, (_AT, *split.order), split.hot)


def _rolling(split: Split, rule: AnomalyRule, earlier: DataFrame | None = None) -> Split:
    """Statistics of the last ``rule.rows`` earlier samples, those of earlier runs included;
    rows without a value are none."""
    if earlier is not None:
        found = _rolling(_after_samples(split, earlier), rule).rows
        return split.with_rows(found.where(F.col(_AT) == 0).drop(_AT))
    rows = _with_halo(split, rule.rows) if split.hot else split.rows
    exact = rule.method == "IQR_EXACT"
    rows = rolling_stats(rows, split.groups, list(split.order), _VALUE, rule.rows, exact)
    n, a, b = (F.col(name) for name in STATS)
    stats = {_QUARTILES: F.array(a, b)} if exact else {_MEAN: a, _SD: F.when(n > 1, F.sqrt(b / (n - 1)))}
    rows = rows.withColumns(stats).drop(*STATS[1:])
    return split.with_rows(rows.where(~F.col(_HALO)).drop(_HALO) if split.hot else rows)


def detect_anomalies(
    df: DataFrame,
    rules: list[AnomalyRule],
    stream_key: str = "",
    key: str | None = None,
    time: str = "eventTime",
    position: str | None = None,
    hot_rows: int = HOT_ROWS,
    sizing: DataFrame | None = None,
    initial: DataFrame | None = None,
    keep_values: bool = False,
    samples: DataFrame | None = None,
) -> DataFrame:
    """Flag, dead-letter or drop outliers. Rows of a key count in (time,
    position) order; ``position`` must be unique per row. Key sizes are taken
    from ``sizing`` where given: the rows before dedup serve, at less cost.
    ``initial`` holds (key, rule number, count, mean, squared deviations) of
    earlier runs, ``samples`` (key, rule number, place below zero, value) the last
    samples of rules with a window; ``keep_values`` keeps what to add to them, see
    ``moments_after`` and ``samples_after``."""
    df = with_verdict(df)
    if not rules:
        return df
    own = [] if position else [POSITION]
    df, position = with_position(df, position)
    keyed = df.withColumn(KEY, anomaly_key(df, key, stream_key))
    if sizing is not None:
        sizing = sizing.select(anomaly_key(sizing, key, stream_key).alias(KEY), time, position)
    split = split_hot_keys(keyed, KEY, [time, position], hot_rows, sizing)
    if split.hot:
        # Rows and carried statistics are read separately; both must see the
        # same rows, and what lies before (dedup joins) should run once.
        split = split.with_rows(cut_lineage(split.rows))
    for number, rule in enumerate(rules):
        value = F.when(F.col(LIVE), as_double(split.rows, rule.field))
        split = split.with_rows(split.rows.withColumn(_VALUE, value))
        if keep_values:
            split = split.with_rows(split.rows.withColumn(f"{_VALUE}_{number}", F.col(_VALUE)))
        before = None if initial is None else initial.where(F.col("rule") == number).select("key", "n", "mean", "squares")
        earlier = None if samples is None else samples.where(F.col("rule") == number)
        split = _rolling(split, rule, earlier) if rule.rows else _cumulative(split, before)
        split = split.with_rows(_apply_verdict(split.rows.withColumn(_FLAG, _outside(rule)), rule))
    return split.rows.drop(*own, *([] if keep_values else [KEY, CHUNK]))


MOMENTS_DDL = "key string, rule int, n bigint, mean double, squares double"
SAMPLES_DDL = "key string, rule int, at bigint, value double"


def kept_columns(rules: list[AnomalyRule]) -> list[str]:
    """What ``detect_anomalies`` adds to its rows with ``keep_values``."""
    return [KEY, CHUNK, *[f"{_VALUE}_{i}" for i in range(len(rules))]]


def samples_after(checked: DataFrame, rules: list[AnomalyRule], initial: DataFrame, order: list[str]) -> DataFrame:
    """The last samples per key and windowed rule after a run that kept its values. A key that
    was cut gives the last ones of each chunk first, so no task sorts all of its rows."""
    found = checked.sparkSession.createDataFrame([], SAMPLES_DDL)
    groups = [KEY, *([CHUNK] if CHUNK in checked.columns else [])]
    last = [F.desc(c) for c in order]
    for number, rule in enumerate(rules):
        if not rule.rows:
            continue
        own = checked.select(*groups, *order, F.col(f"{_VALUE}_{number}").alias("value")).where(F.col("value").isNotNull())
        own = own.withColumn("_n", F.row_number().over(Window.partitionBy(*groups).orderBy(*last))).where(F.col("_n") <= rule.rows)
        own = own.select(F.col(KEY).alias("key"), F.lit(0).cast("bigint").alias("at"), *order, "value")
        before = initial.where(F.col("rule") == number).select("key", "at", "value")
        both = own.unionByName(before, allowMissingColumns=True)
        both = both.withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("at"), *last))).where(F.col("_n") <= rule.rows)
        found = found.unionByName(both.select("key", F.lit(number).alias("rule"), (-F.col("_n")).cast("bigint").alias("at"), "value"))
    return found


def moments_after(checked: DataFrame, rules: list[AnomalyRule], initial: DataFrame) -> DataFrame:
    """Moments per key and cumulative rule after a run of ``detect_anomalies`` that kept
    its values. Totals combine before the shuffle."""
    values = [F.when(F.lit(not rule.rows), F.col(f"{_VALUE}_{i}")) for i, rule in enumerate(rules)]
    long = checked.select(F.col(KEY).alias("key"), F.posexplode(F.array(*values)).alias("rule", "value")).where(F.col("value").isNotNull())
    totals = long.groupBy("key", "rule").agg(
        F.count("value").alias("n1"), F.avg("value").alias("mean1"), (F.var_pop("value") * F.count("value")).alias("squares1")
    )
    joined = initial.join(totals, ["key", "rule"], "full")
    n, mean, squares = merge_moments(
        (F.col("n"), F.col("mean"), F.col("squares")), (F.col("n1"), F.col("mean1"), F.col("squares1"))
    )
    return joined.select("key", "rule", n.alias("n"), mean.alias("mean"), squares.alias("squares"))


def _apply_verdict(rows: DataFrame, rule: AnomalyRule) -> DataFrame:
    flagged = F.col(_FLAG)
    message = F.concat(
        F.lit(f"Field '{rule.field}'="),
        F.col(_VALUE).cast("string"),
        F.lit(f" detected as anomaly by {rule.method} (threshold={float(rule.threshold)})"),
    )
    changes = {}
    if rule.on_anomaly != "DROP_RECORD":
        changes[FAILURES] = append_failure(flagged, failure(DETECTOR, "ANOMALY", message))
    if rule.on_anomaly == "FLAG_AND_FORWARD":
        changes[ANOMALY] = F.col(ANOMALY) | flagged
    else:
        changes[LIVE] = F.col(LIVE) & ~flagged
    return rows.withColumns(changes).drop(_VALUE, _N, _MEAN, _SD, _QUARTILES, _FLAG)
