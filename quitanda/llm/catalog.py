"""Queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.llm import (centroids, chat, decontam, hardneg, langid, licenses, line_dedup, mixing, neardup, quality, secrets,
                          simhash, tokenbin)
from quitanda.llm.common import table, workers_find_package

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_find_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(tokenbin.TOKENIZER)


@query("op1_line_dedup")
def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).drop("text_key")


@query("op2_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@query("op3_chat", chat.ORACLE)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    return chat.read_back(chat.format_conversations(turns.unionByName(added)))


@query("op4_secrets", secrets.oracle())
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


@query("op5_quality")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


@query("op6_near_duplicates", neardup.ORACLE)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, threshold=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op7_mixing", mixing.ORACLE)
def mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query("op8_licenses")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # documents carry no path: a folder for each source and hundred ids stands for one
    path = F.concat_ws("/", F.col("source"), F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    return licenses.scan(table(spark, sf_dir, "documents"), path)


@query("op9_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


@query("op10_token_ids")
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.tokenized(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op11_simhash")
def simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query("op12_hard_negatives", hardneg.ORACLE)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end"))
    return hardneg.mine(vectors, F.col("vec_id") % 100 == 0)


@query("op13_centroids", centroids.oracle())
def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")
