"""Empty and typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemark.errors import SettingsError
from rulemark.functions.names import clean_names

# Accepted column types and what they are in Spark.
COLUMN_TYPES = {
    "TEXT": "string",
    "NUMERIC": "double",
    "INTEGER": "bigint",
    "REAL": "double",
    "BLOB": "binary",
}


def rename_clean(df: DataFrame) -> DataFrame:
    """The same table with clean column names."""
    return df.toDF(*clean_names(*df.columns))


def add_label_columns(df: DataFrame, *names: str) -> DataFrame:
    """Clean all names jointly and add ``names`` as empty text columns."""
    cleaned = clean_names(*df.columns, *names)
    main, labels = cleaned[: len(df.columns)], cleaned[len(df.columns) :]
    return df.toDF(*main).withColumns({c: F.lit(None).cast("string") for c in labels})


def add_columns(df: DataFrame, **typed: str) -> DataFrame:
    """Add empty columns ``name=TYPE``; a taken name gets a suffix."""
    unknown = {n: t for n, t in typed.items() if t.upper() not in COLUMN_TYPES}
    if unknown:
        raise SettingsError(f"unknown column types {unknown}, allowed: {sorted(COLUMN_TYPES)}")
    names = clean_names(*df.columns, *typed)[len(df.columns) :]
    return df.withColumns(
        {n: F.lit(None).cast(COLUMN_TYPES[t.upper()]) for n, t in zip(names, typed.values())}
    )
