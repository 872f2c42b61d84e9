"""Registry and small helpers of the corpus operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulemark.sources.storage import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: White space of the contracts: blank and tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"

#: Rows and bytes handed to a Python task at once; a batch holds at least one row.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Bound what one Python task holds, whatever the length of the texts."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def kept_by_worker(name: str, make):
    """What ``make`` returns, made once in each Python worker process, which serves many tasks.

    For things that depend on nothing but the name: vocabularies and bounded caches.
    """
    holder = sys.modules.setdefault("_corpus_worker", types.ModuleType("_corpus_worker"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder all executors share, and forget how it was made.

    Spark deletes the files with the DataFrame where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def utf8(name: str = "text") -> Column:
    """Bytes of a text; a null is empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def text_hash() -> Column:
    """With ``doc_id``, tells the rows of a table apart; equal rows are treated alike."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not among ``gone`` (``doc_id``, ``text_hash``); null equals null."""
    other = gone.select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash"))
    matched = same(docs["doc_id"], other["_gone_id"]) & (text_hash() == other["_gone_hash"])
    return docs.join(other, matched, "left_anti")
