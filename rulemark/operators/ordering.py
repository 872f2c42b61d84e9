"""Numbering and running sums over a whole table, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 100_000
MAX_BUCKETS = 1_000
SAMPLES_PER_BUCKET = 20


def number_rows(
    df: DataFrame,
    order_by: list[str],
    name: str = "rule_id",
    count: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add ``name`` = 1, 2, ... in the order of ``order_by``, which must be unique.

    Rows are cut into key ranges of about ``bucket_rows``; each range is numbered
    in its own task and shifted by the count of the ranges before it. Any range
    bounds give the same numbers, so they come from a small sample of keys.
    """
    if count is None:
        count = df.count()
    buckets = min(MAX_BUCKETS, -(-count // bucket_rows)) if count else 1
    if buckets <= 1:  # counted: one task holds at most bucket_rows rows
        numbered = F.row_number().over(Window.orderBy(*order_by))
        return df.withColumn(name, numbered.cast("int"))

    types = df.select(*order_by).dtypes
    sample = (
        df.select(*order_by, F.xxhash64(*order_by).alias("_hash"))
        .orderBy("_hash")
        .limit(buckets * SAMPLES_PER_BUCKET)
        .orderBy(*order_by)
        .drop("_hash")
        .collect()
    )
    bounds = F.array(
        *[
            F.struct(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, types)])
            for row in sample[::SAMPLES_PER_BUCKET]
        ]
    )
    bucket = F.size(F.filter(bounds, lambda bound: bound <= F.struct(*order_by)))
    ranged = df.withColumn("_bucket", bucket)
    sizes = ranged.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_by))
    return (
        ranged.withColumn("_local", local)
        .join(F.broadcast(offsets), "_bucket")  # at most MAX_BUCKETS + 1 rows
        .withColumn(name, (F.col("_offset") + F.col("_local")).cast("int"))
        .drop("_bucket", "_local", "_offset")
    )


def running_sum(
    df: DataFrame, position: str, value: str, name: str, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add ``name`` = sum of ``value`` over all rows up to ``position`` (numbered from 1)."""
    bucketed = df.withColumn("_bucket", F.floor((F.col(position) - 1) / F.lit(bucket_rows)))
    totals = bucketed.groupBy("_bucket").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    within = F.sum(value).over(Window.partitionBy("_bucket").orderBy(position))
    return (
        bucketed.withColumn("_within", within)
        .join(F.broadcast(offsets), "_bucket")  # one row per bucket_rows rows
        .withColumn(name, (F.col("_offset") + F.col("_within")).cast("int"))
        .drop("_bucket", "_within", "_offset")
    )
