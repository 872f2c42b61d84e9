"""Rule dictionaries kept as delimited text."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulemark.errors import RuleError, SettingsError
from rulemark.functions.names import clean_names
from rulemark.options import ReadOptions, WriteOptions
from rulemark.sources.export import csv_writer
from rulemark.sources.files import FILE, LOAD_ORDER, list_files, read_files, read_header
from rulemark.sources.storage import path_exists

SORT_COLUMN = "search_column_idx"
#: Columns that give the order of rules read from files.
ORDER = [FILE, *LOAD_ORDER]


def read_dictionary(spark: SparkSession, path: str, options: ReadOptions = ReadOptions()) -> DataFrame:
    """A dictionary file, or a folder of parts in order, with the ``ORDER`` columns."""
    part = _part_files(spark, path).agg(F.min("path")).first()[0]
    if part is None:
        raise SettingsError(f"no dictionary at {path!r}")
    # files of a dictionary are short: dividing one would cost more jobs than it saves
    return read_files(spark, path, clean_names(*read_header(spark, part, options)), replace(options, split_quoted=False))


def _part_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path")


def merge(dictionaries: list[DataFrame], sort_column: str = SORT_COLUMN) -> DataFrame:
    """All rules once, sorted as text by ``sort_column`` and then by the other columns."""
    first = dictionaries[0].columns
    if any(d.columns != first for d in dictionaries):
        raise RuleError(f"dictionaries differ in columns: {[d.columns for d in dictionaries]}")
    if sort_column not in first:
        raise RuleError(f"dictionaries have no column {sort_column!r}")
    rules = reduce(DataFrame.unionByName, dictionaries).distinct()
    return rules.orderBy(*[F.col(f"`{c}`") for c in [sort_column, *[c for c in first if c != sort_column]]])


def get_dictionary(
    spark: SparkSession,
    folder: str,
    name: str = "merged_dictionary",
    extension: str = "csv",
    options: ReadOptions = ReadOptions(),
) -> DataFrame:
    """The merged dictionary of a folder; it is built from the files there if missing."""
    for target in (f"{folder.rstrip('/')}/{name}.{extension.strip('.')}", f"{folder.rstrip('/')}/{name}"):
        if path_exists(spark, target):
            return read_dictionary(spark, target, options)
    files = [row[0] for row in list_files(spark, folder, extension).orderBy("path").collect()]
    if not files:
        raise SettingsError(f"no dictionary files with extension {extension!r} in {folder!r}")
    parts = [read_dictionary(spark, f, options).drop(*ORDER) for f in files]
    # BOM and compression are for exports; the dictionary is read back by us
    csv_writer(merge(parts), WriteOptions(separator=options.separator, compression=None)).save(target)
    return read_dictionary(spark, target, options)
