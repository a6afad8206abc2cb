"""A corpus pipeline of five of the language-model operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet to
the shared folder and reads it again as the next stage's docs.  All stages but the last
return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerofield.llm import decontaminate, language, mixing, simhash, token_ids
from aerofield.llm._shared import BATCH, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document counts as a language model's training text by this fold, as in the language query.
LANGUAGE_FOLD = 3
#: Rows go to Python in batches of so many bytes: Spark's 10,000 rows are held, and doubled, on both sides.
BATCH_BYTES = 4 << 20


def small_batches(f: Stage) -> Stage:
    """``f`` with `BATCH_BYTES` as the session's setting; it stays, as a stage's result is computed after the call."""

    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")
        return f(spark, docs, sf_dir)

    return run


@small_batches
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter, or without a language that makes up half of them; equal texts stay or go together."""
    return language.drop_rejected(docs, language.learn(docs.where(~language.held_out(LANGUAGE_FOLD))))


@small_batches
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate group, that of the smallest doc_id; of rows that repeat it, the first."""
    return simhash.keep_one(docs)


@small_batches
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of whose words a twentieth or more lie in test passages; the others stay as they are."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@small_batches
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take the words of the mix: a row per document and epoch, in the schedule's order.

    Rows that share a doc_id are shuffled by their texts; equal rows are told apart by nothing but place.
    """
    return mixing.mix(docs)


def file_order(docs: DataFrame) -> list[Column] | None:
    """What sorts rows of written files as they were written; None for rows of no files."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index").schema  # noqa: B018
    except AnalysisException:
        return None
    name = F.col("_metadata.file_name")
    return [F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long"), name, F.col("_metadata.row_index")]


@small_batches
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files in the order of the mix, and read back each document's place, length and checksum.

    Where the rows come from no files they are in the order of doc_id.
    """
    return token_ids.digest(token_ids.token_files(docs, order=file_order(docs)))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_files", token_stage),
]

#: SQL expresses neither expectation-maximisation nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
