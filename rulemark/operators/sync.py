"""Bring a table in line with another one by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemark.functions.names import free_name, quoted
from rulemark.operators.skew import join_per_key


def update_from(
    target: DataFrame, source: DataFrame, key: str, columns: list[str], hot: DataFrame | None = None, how: str = "left"
) -> DataFrame:
    """Copy ``columns`` from the source row with the same key; others stay, or go if ``how`` is inner.

    ``source`` holds one row per key. ``hot`` splits frequent keys of the target,
    see ``skew.hot_keys``.
    """
    columns = [c for c in columns if c != key]
    found = free_name("_found", target.columns)
    copies = {c: free_name(f"_s{i}", target.columns) for i, c in enumerate(columns)}
    new = source.select(quoted(key), F.lit(True).alias(found), *[F.col(quoted(c)).alias(n) for c, n in copies.items()])
    joined = join_per_key(target, new, [key], how, hot)
    return joined.select(
        *[
            F.when(F.col(found), F.col(copies[c])).otherwise(F.col(quoted(c))).alias(c)
            if c in copies
            else F.col(quoted(c))
            for c in target.columns
        ]
    )


def missing_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target lacks, among them rows without a key."""
    return source.join(target.select(quoted(key)).distinct(), key, "left_anti")


def insert_missing(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Append ``columns`` of the source rows whose key the target lacks."""
    added = missing_rows(source, target, key).select(*map(quoted, columns))
    return target.unionByName(added, allowMissingColumns=True)


def delete_missing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keep target rows whose key the source has; rows without a key go."""
    return target.join(source.select(quoted(key)).distinct(), key, "left_semi")


def sync_tables(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Update, insert, then delete, as one table.

    Only ``columns`` are copied: a row inserted without its key has none, and is
    deleted again. So what is left is the target's rows that the source has too, as
    updated, and the source's rows with a new key.
    """
    kept = update_from(target, source, key, columns, how="inner")
    if key not in columns:
        return kept
    added = missing_rows(source, target, key).filter(F.col(quoted(key)).isNotNull())
    return kept.unionByName(added.select(*map(quoted, columns)), allowMissingColumns=True)


def unmapped_rows(
    rows: DataFrame, search_columns: list[str], label_columns: list[str], mode: str = "any"
) -> DataFrame:
    """Distinct search and label values of rows with ``any`` (or ``all``) labels NULL."""
    if not label_columns:
        return rows.select(*search_columns).limit(0)
    empty = [F.col(f"`{c}`").isNull() for c in label_columns]
    test = reduce((lambda a, b: a | b) if mode == "any" else (lambda a, b: a & b), empty)
    return rows.filter(test).select(*[f"`{c}`" for c in [*search_columns, *label_columns]]).distinct()
