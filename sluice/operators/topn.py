"""The leading products of each snapshot, from leading profiles.

Products with the same concerns and skin types (a *profile*) always score the same. Level
one scores profiles, as sums over the concerns they list; level two takes the first products
by id of the leading ones. A product behind ``top_n`` products of its own profile, or a
profile behind ``top_n`` others' first products, cannot reach the result, so the first
``top_n`` products of every profile are all that tasks need of the catalogue. Profiles go
to the tasks in parts of bounded size, and each part improves the result of the ones before.

Owned products count less and stay candidates. For a customer who owns products, two short
lists per profile replace the catalogue's: the first ``top_n`` products that are free, and
the first ``top_n`` that are owned. Free places are the gaps between owned places, which are
joined with the catalogue by profile and place; owned products behind ``top_n`` free ones
leave no trace. So what is kept for a customer follows the number of profiles, not of
purchases.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ..session import ship_with_tasks
from .ordered import HOT_ROWS, Split, previous_value, running_count, split_hot_keys

ship_with_tasks(__name__)

#: Profiles that a task holds at once, and scores that it computes at once.
PART_PROFILES, BLOCK_SCORES = 20_000, 2_000_000
#: Profiles that are sorted for all snapshots of a block, more go snapshot by snapshot; snapshots of a block.
SORTED_PROFILES, BLOCK_ROWS = 1000, 10_000
PRODUCTS = "array<struct<productId:string,rank:int,score:double,targetConcerns:array<string>>>"
LISTED = "array<struct<productId:string,concerns:array<string>>>"
SEPARATOR = "\u0001"


def placed(active: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Products with their place, from 1, in their profile's order of ids. A profile with
    most of the catalogue is numbered in chunks."""
    split = split_hot_keys(active, "profile", ["productId"], hot_rows)
    return running_count(split, F.lit(True), "place", inclusive=True).rows.select("profile", "place", "productId", "concerns", "places", "types")


def owned_lists(bought: DataFrame, products: DataFrame, top_n: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per customer: for each profile with an owned product whether the catalogue's first
    products change, the first free ones if so, and the first owned ones."""
    owned = bought.select("customerId", "productId").distinct().join(products.select("productId", "profile", "place", "concerns"), "productId")
    owned = owned.withColumn("_pair", F.concat_ws(SEPARATOR, F.col("customerId").cast("string"), F.col("profile")))
    split: Split = running_count(split_hot_keys(owned, "_pair", ["place"], hot_rows), F.lit(True), "_nth", inclusive=True)
    rows = previous_value(split, "place", "_before").rows
    first = rows.where(F.col("_nth") <= top_n).groupBy("customerId", "profile").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "productId", "concerns"))), lambda e: F.struct(e["productId"], e["concerns"])).alias("owned")
    )
    # owned places with fewer than top_n free ones before them
    hits = rows.where(F.col("place") - F.col("_nth") < top_n).withColumn("_before", F.coalesce("_before", F.lit(0)))
    gaps = hits.where(F.col("place") - F.col("_before") > 1).select("customerId", "profile", F.explode(F.sequence(F.col("_before") + 1, F.col("place") - 1)).alias("place"))
    last = hits.groupBy("customerId", "profile").agg(F.max("place").alias("_last"), F.max("_nth").alias("_nth"))
    tail = last.select("customerId", "profile", F.explode(F.sequence(F.col("_last") + 1, F.col("_nth") + top_n)).alias("place"))
    free = gaps.union(tail).join(products.select("profile", "place", "productId", "concerns"), ["profile", "place"]).groupBy("customerId", "profile").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "productId", "concerns"))), lambda e: F.struct(e["productId"], e["concerns"])).alias("free")
    )
    changed = last.select("customerId", "profile", F.lit(True).alias("changed")).join(free, ["customerId", "profile"], "left")
    lists = first.join(changed, ["customerId", "profile"], "left").select(
        "customerId", F.struct("profile", F.coalesce("changed", F.lit(False)).alias("changed"), F.coalesce("free", F.array().cast(LISTED)).alias("free"), "owned").alias("entry")
    )
    return lists.groupBy("customerId").agg(F.collect_list("entry").alias("own"))


@dataclass(frozen=True)
class Factors:
    """What skin types and ownership do to a score."""

    bonus: float
    penalty: float
    owned: float


class Profiles:
    """A part of the profiles, in the order of their first products."""

    def __init__(self, heads: list[Row], n_concerns: int, factors: Factors):
        by_profile: dict[str, list[Row]] = {}
        for row in heads:
            by_profile.setdefault(row["profile"], []).append(row)
        groups = sorted((sorted(rows, key=lambda r: r["place"]) for rows in by_profile.values()), key=lambda rows: rows[0]["productId"])
        self.factors, self.n_concerns = factors, n_concerns
        self.at = {rows[0]["profile"]: k for k, rows in enumerate(groups)}
        self.products = [[(r["productId"], r["concerns"]) for r in rows] for rows in groups]
        self.types = [set(rows[0]["types"]) for rows in groups]
        width = max((len(rows[0]["places"]) for rows in groups), default=0)
        self.places = np.full((len(groups), width), n_concerns, np.int64)
        for k, rows in enumerate(groups):
            self.places[k, :len(rows[0]["places"])] = [p - 1 for p in rows[0]["places"]]
        self.effects: dict[str | None, np.ndarray] = {}
        # all products by id, and where each profile's are among them
        listed = sorted((name, k, n) for k, own in enumerate(self.products) for n, (name, _) in enumerate(own))
        self.names = pa.array([name for name, _, _ in listed], pa.string())
        self.concerns = pa.array([self.products[k][n][1] for _, k, n in listed], pa.list_(pa.string()))
        self.cells = np.full((len(groups), max((len(own) for own in self.products), default=0)), -1, np.int64)
        for cell, (_, k, n) in enumerate(listed):
            self.cells[k, n] = cell

    def _effect(self, skin: str | None) -> np.ndarray:
        if skin not in self.effects:
            of = lambda types: 0.0 if skin is None or not types else self.factors.bonus if skin in types else self.factors.penalty
            self.effects[skin] = np.array([of(t) for t in self.types])
        return self.effects[skin]

    def points(self, weights: np.ndarray, skins: list) -> np.ndarray:
        """Per snapshot and profile the sum before ownership, added up in the listed order."""
        wide = np.hstack([weights, np.zeros((len(weights), 1))])
        total = np.zeros((len(weights), len(self.products)))
        for column in self.places.T:
            total += wide[:, column]
        for skin in set(skins):
            total[[k for k, s in enumerate(skins) if s == skin]] += self._effect(skin)
        return total

    def leading(self, points: np.ndarray, own: list, before: list, top_n: int) -> list[tuple]:
        """The ``top_n`` best (order, product, score, concerns) of one snapshot."""
        score = np.maximum(0.0, points)
        order = np.where(np.isnan(score), -1.0, score)
        found = list(before)

        def add(value: float, products: list) -> None:
            value = float(value)
            place = 1.0 if value != value else -value
            found.extend((place, name, value, concerns) for name, concerns in products)

        for entry in own:
            at = self.at.get(entry["profile"])
            if at is None:
                continue
            add(np.maximum(0.0, points[at] * self.factors.owned), [(p["productId"], p["concerns"]) for p in entry["owned"]])
            if entry["changed"]:
                add(score[at], [(p["productId"], p["concerns"]) for p in entry["free"]])
                order[at] = -2.0
        count = min(top_n, len(order))
        least = np.partition(order, len(order) - count)[len(order) - count]
        above = np.flatnonzero(order > least)
        chosen = np.concatenate([above, np.flatnonzero(order == least)[:count - len(above)]])
        for at in chosen.tolist():
            if order[at] > -2.0:
                add(score[at], self.products[at])
        return sorted(found, key=lambda f: f[:2])[:top_n]


    def leading_many(self, points: np.ndarray, own: pa.Array, top_n: int, kind: pa.DataType) -> tuple[pa.Array, np.ndarray]:
        """What ``leading`` finds for many snapshots at once, and the snapshots for which an
        owned or free product of the customer's own lists may be among the first: they are
        left to ``leading``."""
        score = np.maximum(0.0, points)
        order = np.where(np.isnan(score), -1.0, score)
        parent, entries = pc.list_parent_indices(own).to_numpy(), pc.list_flatten(own)
        profiles = entries.field("profile").dictionary_encode()
        at = np.array([self.at.get(p, -1) for p in profiles.dictionary.to_pylist()], np.int64)[profiles.indices.to_numpy()]
        known, changed = at >= 0, entries.field("changed").to_numpy(zero_copy_only=False).astype(bool)
        parent, at, changed = parent[known], at[known], changed[known]
        best = np.nan_to_num(np.maximum(0.0, points[parent, at] * self.factors.owned), nan=-1.0, posinf=np.inf)
        best = np.where(changed, np.maximum(best, order[parent, at]), best)
        order[parent[changed], at[changed]] = -2.0

        first = np.argsort(-order, axis=1, kind="stable")[:, :top_n]
        cells = self.cells[first]
        value = np.broadcast_to(np.take_along_axis(order, first, 1)[:, :, None], cells.shape)
        key = np.where((cells >= 0) & (value > -2.0), -value, np.inf).reshape(len(points), -1)
        cells = cells.reshape(len(points), -1)
        by_id = np.argsort(cells, axis=1)
        cells, key = np.take_along_axis(cells, by_id, 1), np.take_along_axis(key, by_id, 1)
        by_score = np.argsort(key, axis=1, kind="stable")[:, :top_n]
        cells, key = np.take_along_axis(cells, by_score, 1), np.take_along_axis(key, by_score, 1)
        there = key < np.inf
        counts = there.sum(axis=1)
        least = np.where(counts < top_n, -np.inf, -key[:, -1])  # with fewer products every listed one counts
        left = np.zeros(len(points), bool)
        left[parent[best >= least[parent]]] = True

        taken, own_key = pa.array(cells[there]), key[there]
        ranks = np.broadcast_to(np.arange(1, key.shape[1] + 1, dtype=np.int32), key.shape)[there]
        scores = np.where(own_key > 0.5, np.nan, -own_key) + 0.0  # only a score that is no number sorts behind 0
        columns = [self.names.take(taken), pa.array(ranks), pa.array(scores), self.concerns.take(taken)]
        fields = [kind.value_type.field(i) for i in range(kind.value_type.num_fields)]
        values = pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(columns, fields)], fields=fields)
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), values, type=kind), left


def improve(rows: DataFrame, part: Profiles, top_n: int, sorted_profiles: int = SORTED_PROFILES) -> DataFrame:
    """``rows`` (row, weights, skin, own, products) with the products of one more part. Parts of
    up to ``sorted_profiles`` profiles are sorted for many snapshots at once."""
    kind = to_arrow_type(StructType.fromDDL(f"p {PRODUCTS}")["p"].dataType)
    step = min(BLOCK_ROWS, max(1, BLOCK_SCORES // max(1, len(part.products))))

    def one_by_one(points: np.ndarray, lists: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for total, own, before in zip(points, lists.to_pylist(), found.to_pylist()):
            kept = [(1.0 if p["score"] != p["score"] else -p["score"], p["productId"], p["score"], p["targetConcerns"]) for p in before or ()]
            best = part.leading(total, own or (), kept, top_n)
            out.append([{"productId": n, "rank": k, "score": s + 0.0, "targetConcerns": c} for k, (_, n, s, c) in enumerate(best, 1)])
        return pa.array(out, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                own = batch.slice(start, step)
                weights = own.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, part.n_concerns)
                points = part.points(weights, own.column(2).to_pylist())
                lists, before = own.column(3), own.column(4)
                if len(part.products) > sorted_profiles or before.null_count < len(before):
                    found = one_by_one(points, lists, before)
                else:
                    found, left = part.leading_many(points, lists, top_n, kind)
                    if left.any():
                        at, which = np.arange(len(points)), np.flatnonzero(left)
                        at[which] = len(points) + np.arange(len(which))
                        found = pa.concat_arrays([found, one_by_one(points[which], lists.take(pa.array(which)), before.take(pa.array(which)))]).take(pa.array(at))
                yield own.set_column(4, own.schema.field(4), found)

    return rows.mapInArrow(run, rows.schema)
