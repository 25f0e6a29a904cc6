"""The corpus pipeline: five stages over documents, each written as Parquet and read again.

Counted as part of the subpackage opskit.llm, whose operators it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opskit.llm import decontaminate, langid, line_dedup, minhash, packing
from opskit.llm.common import shared_folder


#: Texts in an Arrow batch: batches of long texts are what fills an executor beside the heap.
BATCH_ROWS = 1000


def _small_batches(spark: SparkSession) -> None:
    """The pipeline's stages are lazy, so the session's setting holds until they are written."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised stay."""
    _small_batches(spark)
    return langid.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; documents left without a word go."""
    return line_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    _small_batches(spark)
    return minhash.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    _small_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    _small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("op5_language", language),
    ("op7_lines", lines),
    ("op10_near_duplicates", near_duplicates),
    ("op9_benchmark", benchmark),
    ("op8_packing", pack),
]

#: Language prototypes, MinHash and best-fit cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    path = shared_folder(spark)
    STAGES[-1][1](spark, docs, sf_dir).write.parquet(path)
    return spark.read.parquet(path)
