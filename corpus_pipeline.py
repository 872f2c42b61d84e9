"""A corpus made ready for training: five stages, each one of the operators over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rulemark.llm.decontamination import keep_clean
from rulemark.llm.exact_dedup import keep_first
from rulemark.llm.language import keep_identified
from rulemark.llm.near_copies import keep_one_of_each
from rulemark.llm.packing import pack
from rulemark.sources.storage import delete_folder, new_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go, and those no more like one than chance."""
    return keep_identified(docs)


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest id stays."""
    return keep_first(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike in 0.8 or more of their 5-word shingles, the one with the smallest id stays."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", remove_exact_copies),
    ("SimHash near-dedup", remove_near_copies),
    ("benchmark decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: SQL can express neither the language model nor the fingerprints; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Every stage's result is written to the shared folder.

    A stage's folder is deleted when the next stage is written, the last one stays for the reader.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return docs
