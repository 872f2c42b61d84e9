"""Export to delimited text in files of bounded length."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rulemark.errors import SettingsError
from rulemark.options import WriteOptions
from rulemark.sources.files import BOM
from rulemark.sources.storage import delete_folder

# File suffix per compression name, and Spark's name for it.
SUFFIXES = {
    None: ".csv", "infer": ".csv", "gzip": ".csv.gz", "gz": ".csv.gz", "bz2": ".csv.bz2",
    "xz": ".csv.xz", "zip": ".csv.zip", "zstd": ".csv.zst",
}
CODECS = {None: "none", "infer": "none", "gzip": "gzip", "gz": "gzip", "bz2": "bzip2"}



@dataclass(frozen=True)
class Export:
    #: folder of the part files, None if there was nothing to export
    path: str | None
    rows: int


def file_suffix(compression: str | None) -> str:
    return SUFFIXES.get(compression.lower() if compression else None, ".csv")


def codec(compression: str | None) -> str:
    name = compression.lower() if compression else None
    if name in CODECS:
        return CODECS[name]
    raise SettingsError(f"Spark cannot write {compression!r} text; use gzip, bz2 or none")


def export_name(prefix: str, at: datetime | None = None) -> str:
    return f"{prefix}_{(at or datetime.now()):%Y%m%d-%H%M%S}"


def csv_writer(df: DataFrame, options: WriteOptions = WriteOptions()):
    """A writer of text columns that keeps blanks, quotes, NULL and empty text apart."""
    if options.include_bom and not options.include_header:
        raise SettingsError("a byte order mark needs a header line")
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    if options.include_bom:
        texts = texts.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    return (
        texts.write.format("csv")
        .option("sep", options.separator)
        .option("header", options.include_header)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", codec(options.compression))
        .option("maxRecordsPerFile", options.chunk_size)
    )


def export_csv(
    df: DataFrame,
    folder: str,
    prefix: str,
    options: WriteOptions = WriteOptions(),
    at: datetime | None = None,
) -> Export:
    """Write ``df`` to ``folder/<prefix>_<time>``, at most ``chunk_size`` rows per file.

    The rows are counted while they are written; an empty table leaves nothing.
    """
    path = f"{folder.rstrip('/')}/{export_name(prefix, at)}"
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    csv_writer(counted, options).save(path)
    rows = written.get["rows"]
    if rows == 0:
        delete_folder(df.sparkSession, path)
        return Export(None, 0)
    return Export(path, rows)
