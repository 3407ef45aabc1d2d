"""Licence scan by canonical digests.

A text is brought to a canonical form: lower case, without copyright lines, only letters
and digits, equivalent spellings made one. The SHA-256 of the whole form is joined with the
digests of known licence texts. Each document is looked up whole, and so is each of its
lines and of its blocks (lines between lines without a letter or digit) as a text of its own,
which finds notices inside other texts. All of it is Spark
expressions; lines and blocks are exploded and joined where they are, without a shuffle of documents.

The known texts are a table (licence, text, digest), where long licences have no text but the
digest of their canonical form; it is brought to digests once, equal ones by
the smallest name. Blocks are known from the texts' own blocks of at least ``BLOCK_WORDS``
words, where no two licences share them. Up to ``BROADCAST_TEXTS`` digests, which are counted, are broadcast, and
lines meet them where they are; more are joined by a shuffle.

Defined cases: null and empty texts, and texts of punctuation or copyright lines alone,
have no canonical form and match nothing; repeated rows give their matches again; a text
of one line or block is reported whole and as its line or block; blocks of one line are reported as lines only; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .licence_texts import DIGESTS, LICENCES

BROADCAST_TEXTS = 50_000
#: Least words of a known block, and what stands between blocks.
BLOCK_WORDS, BETWEEN_BLOCKS = 12, r"\n([^\n\p{L}\p{N}]*\n)+"
#: A line that states a copyright, with what stands before it.
COPYRIGHT_LINE = r"(^|\n)[^\n\p{L}\p{N}]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|<|\[|\{|:)|\(c\)[ \t]*[0-9<\[]|©)[^\n]*"
#: Equivalent spellings, applied in this order to words separated by single spaces.
SPELLINGS = (
    ("all rights reserved ", ""), ("all rights reserved", ""),
    ("licence", "license"), ("favour", "favor"), ("organisation", "organization"), ("recognise", "recognize"), ("authorise", "authorize"),
    ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("merchantibility", "merchantability"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https", "http"), ("acknowledgement", "acknowledgment"),
)


def canonical(text: Column) -> Column:
    words = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n")
    words = F.trim(F.regexp_replace(words, r"[^\p{L}\p{N}]+", " "))
    for spelled, instead in SPELLINGS:
        words = F.replace(words, F.lit(spelled), F.lit(instead))
    return F.trim(words)


def digest(text: Column) -> Column:
    """Digest of the canonical form; null if nothing is left."""
    form = canonical(text)
    return F.when(form != "", F.sha2(form, 256))


def known_licences(spark: SparkSession, texts: list[tuple[str, str]] = LICENCES, digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    rows = [(name, text, None) for name, text in texts] + [(name, None, own) for name, own in digests]
    return spark.createDataFrame(rows, "licence string, text string, digest string")


def known_digests(known: DataFrame) -> DataFrame:
    """unit (whole or block), digest, licence. Whole texts are looked up in lines as well."""
    whole = known.select(F.lit("whole").alias("unit"), F.coalesce("digest", digest(F.col("text"))).alias("digest"), "licence").where("digest IS NOT NULL")
    whole = whole.groupBy("unit", "digest").agg(F.min("licence").alias("licence"))
    blocks = known.select("licence", F.explode(F.split("text", BETWEEN_BLOCKS)).alias("block")).select("licence", canonical(F.col("block")).alias("form"))
    blocks = blocks.where(F.size(F.split("form", " ")) >= BLOCK_WORDS)
    blocks = blocks.groupBy(F.lit("block").alias("unit"), F.sha2("form", 256).alias("digest")).agg(F.min("licence").alias("licence"), F.max("licence").alias("other"))
    return whole.union(blocks.where("licence = other").drop("other"))


def find_licences(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per match: id, unit ("text", "line" or "block"), number of the line or block from
    1 (0 for the whole text), licence and digest."""
    digests = known_digests(known).withColumnRenamed("unit", "known")
    few = digests.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS
    text = F.col(text_col).cast("string")
    # the whole text, then its lines, then its blocks; a block of one line is left to the lines
    blocks = F.transform(F.split(text, BETWEEN_BLOCKS), lambda b: F.when(F.contains(b, F.lit("\n")), canonical(b)).otherwise(""))
    lines = F.transform(F.split(text, "\n"), canonical)
    forms = F.array(F.struct(F.lit("text").alias("unit"), F.array(canonical(text)).alias("forms")), F.struct(F.lit("line").alias("unit"), lines.alias("forms")), F.struct(F.lit("block").alias("unit"), blocks.alias("forms")))
    unit = docs.where(text.isNotNull()).select(F.col(id_col).alias("id"), F.explode(forms).alias("u")).select("id", "u.unit", F.posexplode("u.forms").alias("at", "form")).where("form != ''")
    line = F.when(F.col("unit") == "text", 0).otherwise(F.col("at") + 1)
    unit = unit.select("id", "unit", line.alias("line"), F.when(F.col("unit") == "block", "block").otherwise("whole").alias("known"), F.sha2("form", 256).alias("digest"))
    return unit.join(F.broadcast(digests) if few else digests, ["known", "digest"]).select(F.col("id").alias(id_col), "unit", "line", "licence", "digest")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical_sql(text: str) -> str:
    form = rf"regexp_replace(lower({text}), {quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
    form = rf"trim(regexp_replace({form}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for spelled, instead in SPELLINGS:
        form = f"replace({form}, {quoted(spelled)}, {quoted(instead)})"
    return f"trim({form})"


def matches_sql() -> str:
    """The same for DuckDB, from the texts themselves."""
    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in LICENCES)
    whole = ", ".join(f"({quoted(name)}, {quoted(own)})" for name, own in DIGESTS)
    split = lambda text: f"string_split_regex({text}, {quoted(BETWEEN_BLOCKS)})"
    return f"""WITH texts AS (SELECT * FROM (VALUES {values}) AS v(licence, text)),
      known AS (SELECT 'whole' AS known, digest, min(licence) AS licence FROM (SELECT licence, sha256({canonical_sql('text')}) AS digest FROM texts UNION ALL SELECT * FROM (VALUES {whole}) AS v(licence, digest)) GROUP BY digest
        UNION ALL SELECT 'block', sha256(form), min(licence) FROM (SELECT licence, {canonical_sql('block')} AS form FROM (SELECT licence, unnest({split('text')}) AS block FROM texts))
          WHERE len(string_split(form, ' ')) >= {BLOCK_WORDS} GROUP BY form HAVING min(licence) = max(licence)),
      pieces AS (SELECT doc_id, 'text' AS unit, 0 AS line, text AS piece FROM documents WHERE text IS NOT NULL
        UNION ALL SELECT doc_id, 'line', unnest(range(1, len(string_split(text, chr(10))) + 1)), unnest(string_split(text, chr(10))) FROM documents WHERE text IS NOT NULL
        UNION ALL SELECT * FROM (SELECT doc_id, 'block', unnest(range(1, len({split('text')}) + 1)), unnest({split('text')}) AS piece FROM documents WHERE text IS NOT NULL) WHERE contains(piece, chr(10))),
      forms AS (SELECT doc_id, unit, line, {canonical_sql('piece')} AS form FROM pieces),
      digests AS (SELECT doc_id, unit, line, CASE WHEN unit = 'block' THEN 'block' ELSE 'whole' END AS known, sha256(form) AS digest FROM forms WHERE form <> '')
      SELECT doc_id, unit, CAST(line AS INTEGER) AS line, licence, digest FROM digests JOIN known USING (known, digest)"""
