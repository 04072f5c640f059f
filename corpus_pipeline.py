"""Corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor
kept; the caller writes its result as Parquet and reads it back for the next.
All but the last return the columns of ``documents``.

Defined cases of every stage: extra columns of any name pass through unchanged up
to the last stage; very long texts are read whole; an empty table gives an empty
result.  Null, empty and letterless texts go in the language stage; a null doc_id
is an id like others; repeated rows are copies, of which the near-duplicate stage
keeps one.  What each operator makes of ties is in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quitanda.llm import decontam, langid, mixing, neardup, tokenbin
from quitanda.llm.catalog import tokenizer_path
from quitanda.llm.common import stored, table, workers_find_package, workers_return_memory


#: Pieces kept by each Python worker of the token stage; the workers of all stages stay alive side by side.
TOKEN_PIECES = 100_000


def _workers(spark: SparkSession) -> None:
    workers_find_package(spark)
    workers_return_memory(spark)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that language identification rejects."""
    _workers(spark)
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    _workers(spark)
    return neardup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    _workers(spark)
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that each source reaches its target."""
    _workers(spark)
    return mixing.mixed_documents(docs, table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the documents' ids bit-packed; one row per document, read back from the files."""
    _workers(spark)
    return tokenbin.tokenized(docs, tokenizer_path(), known=TOKEN_PIECES)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mix), ("tokens", tokens)]

#: Model training, MinHash components, spaced seeds and the tokenizer have no SQL form; tests compare the stages with
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
