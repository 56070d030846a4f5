"""The corpus pipeline: five stages from raw documents to encoded ones.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``run`` writes each stage's result as Parquet in the shared folder and
reads it again for the next. All stages but the last return the columns of
``documents``. A stage's result has files of about ``OUT_BYTES`` of its input's
text, or two a core, instead of one a task.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm import bpe, decontaminate, exact_dedup, quality, simhash  # noqa: E402
from tidemark.llm.common import in_few_files, read_table, text_bytes, written  # noqa: E402
from tidemark.llm.queries import TOKENIZER  # noqa: E402
from tidemark.session import ship_package  # noqa: E402

BATCH_BYTES = "4m"
OUT_BYTES = 16 << 20  # larger row groups make the executors' heaps grow


def _prepare(spark: SparkSession) -> None:
    """Workers find this package; a batch of texts is bounded by its bytes, as
    the JVM and a worker hold several batches each beside the executor's heap."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def _in_files(result: DataFrame, docs: DataFrame) -> DataFrame:
    return in_few_files(result, text_bytes(docs) // OUT_BYTES)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    _prepare(spark)
    trees = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return _in_files(quality.accepted(docs, trees), docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each group of equal texts."""
    _prepare(spark)
    return _in_files(exact_dedup.deduplicated(docs), docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component."""
    _prepare(spark)
    return _in_files(simhash.representatives(docs), docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark passages out; drop documents that are mostly such passages."""
    _prepare(spark)
    return _in_files(decontaminate.cleaned(docs, read_table(spark, sf_dir, "benchmark")), docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of their decoded text."""
    _prepare(spark)
    return _in_files(bpe.round_trip(docs, public_tokenizers.path(TOKENIZER)), docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("bpe encoding and decoding", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None
