"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import cut_lineage, remove_path, scratch_path
from . import bitpacking, centroids, decontaminate, fertility, jaccard, langid, lexical, licences, neighbours, packing, pii, tokens, toxicity
from .base import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def held_out(of: int, remainder: int) -> Column:
    return F.coalesce(crc_mod("doc_id", of) == remainder, F.lit(False)).alias("held_out")


@query("op1_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(table(spark, sf_dir, "documents"))


@query("op3_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find_personal_data(docs, pii.fit(docs)))


@query("op4_licence_scan", licences.matches_sql())
def licence_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find_licences(table(spark, sf_dir, "documents"), licences.known_licences(spark))


@query("op5_fertility_rules")
def fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = fertility.judge(table(spark, sf_dir, "documents"), group_col="lang")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "chars_per_token", "fallback_share", "entropy", "n_tokens", "outside",
    )


@query("op6_language_id")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify_language(docs, langid.fit(docs))
    return found.select("doc_id", held_out(4, 2), "lang_pred", "score")


@query("op7_quality_votes")
def quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = neighbours.score_quality(docs, neighbours.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(4, 2), "score", "predicted")


@query("op8_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out(5, 0), "score", "predicted")


@query("op10_packing")
def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op11_bit_packing")
def packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "packed-ids")
    bitpacking.write_packed(table(spark, sf_dir, "documents"), path)
    found = cut_lineage(bitpacking.read_digests(spark, path))
    remove_path(spark, path)
    return found


@query("op12_lexical_search", lexical.ranks_sql())
def lexical_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_pca_clustering", centroids.clusters_sql())
def vector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
