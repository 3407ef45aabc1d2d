"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
table; ``run`` writes it as Parquet in the shared folder and reads it back for the next one,
so a lost executor never costs more than the stage at hand. All but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm import decontaminate, jaccard, packing, pii, toxicity
from sluice.llm.base import table
from sluice.session import scratch_path

#: Trees, dictionaries and sequence packing have no form in SQL; tests hold the stages
#: against brute-force versions instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies."""
    return jaccard.keep_one_of_each(docs)


def drop_leaking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    redacted = pii.redact_documents(docs, pii.fit(docs))
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return redacted


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaking),
    ("pii", redact_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
