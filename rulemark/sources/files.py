"""Folders of delimited text files, read as text columns."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulemark.errors import SettingsError
from rulemark.functions.names import clean_names
from rulemark.options import ReadOptions
from rulemark.sources.quoted import LINE, quoted_records
from rulemark.sources.storage import any_path

BOM = "\ufeff"
#: Load order: the place of the file among all by path, the part of the file, and a
#: number that is greater within the part the later the row comes.
RANK, PART, ROW = LOAD_ORDER = ("_src_rank", "_src_part", "_src_row")
FILE = "_src_file"
#: Stands for a quoted empty field while reading, to tell it from a missing one.
QUOTED_EMPTY = "\u0001\u0001"
#: Extensions of packed files.
PACKED = (".gz", ".bz2", ".zst", ".xz", ".lz4", ".snappy", ".deflate")
#: Up to this many files the table of first lines is broadcast.
_MANY_FILES = 100_000


def list_files(
    spark: SparkSession, folder: str, extension: str, include_subfolders: bool = False
) -> DataFrame:
    """``path`` of the files with an extension."""
    reader = spark.read.format("binaryFile")
    if include_subfolders:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{extension.strip('.')}")
        location = folder
    else:
        location = _pattern(folder, extension)
    if not any_path(spark, location):
        return spark.createDataFrame([], "path string")
    return reader.load(location).select("path")


def first_file(spark: SparkSession, folder: str, extension: str, include_subfolders: bool = False) -> str:
    """The first file by path; an error if there is none."""
    path = list_files(spark, folder, extension, include_subfolders).agg(F.min("path")).first()[0]
    if path is None:
        raise SettingsError(f"no files with extension {extension!r} in {folder!r}")
    return path


def _pattern(folder: str, extension: str) -> str:
    return f"{folder.rstrip('/')}/*.{extension.strip('.')}"


def csv_options(options: ReadOptions) -> dict:
    return {
        "sep": options.separator,
        "encoding": options.encoding,
        "quote": '"',
        "escape": '"',
        "multiLine": options.multi_line,
        "inferSchema": False,
        "mode": "PERMISSIVE" if options.ignore_errors else "FAILFAST",
    }


def read_header(spark: SparkSession, file: str, options: ReadOptions = ReadOptions()) -> list[str]:
    """Column names of one file as they stand there; ``column_1, ...`` without a header."""
    if options.skip_rows:
        line = _lines(spark, file, options).filter(F.col("_line") == options.skip_rows).select("value").first()
        fields = next(csv.reader([line["value"]], delimiter=options.separator)) if line else []
    else:
        fields = spark.read.options(**csv_options(options)).option("header", False).csv(file).first() or []
    if options.has_header:
        return [(name or "").removeprefix(BOM) for name in fields]
    return [f"column_{i + 1}" for i in range(len(fields))]


def read_files(
    spark: SparkSession,
    location: str,
    names: list[str],
    options: ReadOptions = ReadOptions(),
    **reader_options,
) -> DataFrame:
    """All files at ``location`` as text columns ``names``, by position.

    ``_src_rank``, ``_src_part`` and ``_src_row`` give the load order, whatever the tasks
    the files are read in.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if options.skip_rows:
        raw = _read_skipping(spark, location, schema, options, reader_options)
    elif _splits(location, options, reader_options):
        raw = _read_quoted(spark, location, schema, options, reader_options)
    else:
        raw = (
            spark.read.options(**csv_options(options), **reader_options)
            .option("header", options.has_header)
            .option("emptyValue", QUOTED_EMPTY)
            .schema(schema)
            .csv(location)
            .select(
                "*",
                F.col("_metadata.file_path").alias(FILE),
                F.col("_metadata.file_block_start").alias(PART),
                F.monotonically_increasing_id().alias(ROW),
            )
        )
    ranked = _ranked(spark, raw, location, reader_options)
    return ranked.select(*[restore_empty(n) for n in names], FILE, *LOAD_ORDER)


def _ranked(spark: SparkSession, rows: DataFrame, location: str, reader_options: dict) -> DataFrame:
    """Add the place of each row's file. The listing is broadcast up to ``_MANY_FILES`` files."""
    files = spark.read.format("binaryFile").options(**reader_options).load(location)
    files = files.select(F.col("_metadata.file_path").alias("path"))
    # one task orders the listing, which the driver holds anyway
    order = Window.orderBy("path")
    ranks = files.select(F.col("path").alias(FILE), F.row_number().over(order).cast("bigint").alias(RANK))
    if files.count() <= _MANY_FILES:
        ranks = F.broadcast(ranks)
    return rows.join(ranks, FILE, "left")


def restore_empty(name: str):
    column = F.col(f"`{name}`")
    return F.when(column == QUOTED_EMPTY, "").otherwise(column).alias(name)


def _lines(spark: SparkSession, location: str, options: ReadOptions, reader_options: dict | None = None) -> DataFrame:
    """Text lines with their number in the file (``_line``, from 0), without a shuffle of the text."""
    lines = spark.read.option("encoding", options.encoding).options(**(reader_options or {})).text(location)
    lines = lines.select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias(ROW),
    )
    # numbers are only needed in the block a file begins with
    begins = lines.filter("_block = 0").groupBy(FILE).agg(F.min(ROW).alias("_first"))
    if spark.read.format("binaryFile").options(**(reader_options or {})).load(location).select("path").count() <= _MANY_FILES:
        begins = F.broadcast(begins)
    numbered = lines.join(begins, FILE, "left")
    return numbered.withColumn("_line", F.when(F.col("_block") == 0, F.col(ROW) - F.col("_first")))


def _splits(location: str, options: ReadOptions, reader_options: dict) -> bool:
    """Can files be divided though their fields may hold line breaks? Packed ones cannot."""
    plain = not str(reader_options.get("pathGlobFilter", location)).endswith(PACKED)
    readable = options.encoding.lower().replace("-", "") == "utf8" and len(options.separator) == 1 and options.separator != '"'
    return options.multi_line and options.split_quoted and plain and readable


def _parsed(rows: DataFrame, schema: T.StructType, options: ReadOptions) -> DataFrame:
    """Records parsed as ``r``."""
    parse = {k: str(v) for k, v in csv_options(options).items() if k not in ("encoding", "inferSchema")}
    fields = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    return rows.withColumn("r", F.from_csv("value", F.lit(fields), {**parse, "emptyValue": QUOTED_EMPTY}))


def _read_quoted(spark, location, schema, options, reader_options) -> DataFrame:
    """Fields with line breaks, by many tasks per file."""
    records = quoted_records(spark, location, options.separator, reader_options)
    if options.has_header:
        records = records.filter("NOT head")
    return _parsed(records, schema, options).select("r.*", FILE, PART, F.col(LINE).alias(ROW))


def _read_skipping(spark, location, schema, options, reader_options) -> DataFrame:
    """Skip the first lines of every file; a field then cannot hold a line break."""
    skipped = options.skip_rows + (1 if options.has_header else 0)
    lines = _lines(spark, location, options, reader_options)
    kept = lines.filter(F.col("_line").isNull() | (F.col("_line") >= skipped)).filter(F.length(F.trim("value")) > 0)
    parse = {k: str(v) for k, v in csv_options(options).items() if k not in ("encoding", "multiLine", "inferSchema")}
    parsed = F.from_csv("value", F.lit(schema.simpleString()[7:-1].replace(":", " ")), {**parse, "emptyValue": QUOTED_EMPTY})
    rows = kept.select(parsed.alias("r"), FILE, F.col("_block").alias(PART), ROW)
    return rows.select("r.*", FILE, PART, ROW)


def read_folder(
    spark: SparkSession, folder: str, extension: str = "csv", options: ReadOptions = ReadOptions()
) -> DataFrame:
    """All files of a folder under the cleaned header of the first one."""
    sample = first_file(spark, folder, extension, options.include_subfolders)
    names = clean_names(*read_header(spark, sample, options))
    if options.include_subfolders:
        return read_files(
            spark, folder, names, options, recursiveFileLookup=True, pathGlobFilter=f"*.{extension.strip('.')}"
        )
    return read_files(spark, _pattern(folder, extension), names, options)
