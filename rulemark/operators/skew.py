"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.functions.names import free_name, quoted


#: Keys that may be split, a bound of what is broadcast for it.
HOT_KEYS = 100_000
#: Rows of a list that a row is joined with in one part, and the most parts of a list.
LIST_ROWS, LIST_PARTS = 64, 16


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan with fewer tasks than cores; a wide scan stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def join_small(
    rows: DataFrame, small: DataFrame, key: str, broadcastable: bool, rows_per_split: int | None
) -> DataFrame:
    """Inner join with a table that is broadcast if it was measured to be small.

    Otherwise both are shuffled, and hot keys of ``rows`` are split.
    """
    if broadcastable:
        return rows.join(F.broadcast(small), key)
    return join_many(rows, small, [key], rows_per_split)


def join_many(rows: DataFrame, other: DataFrame, key: list[str], rows_per_split: int | None) -> DataFrame:
    """Inner join of ``rows`` with a table too large to broadcast, of any number of rows per key.

    ``other`` is shuffled once. Adaptive execution splits hot partitions of ``rows``; where
    it is off, the keys of ``rows`` are counted and only rows of hot keys are repeated.
    """
    hot = None
    if rows_per_split and not adaptive_split(rows):
        hot = hot_keys(rows, key, rows_per_split)
    return join_per_key(rows, other.hint("merge"), key, "inner", hot)


def join_lists(rows: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """Inner join of ``rows`` with a smaller table that has long lists of rows for some keys.

    The size of ``rows`` does not tell what they grow to, so adaptive execution would not split them: the
    rows of a long list are spread over some parts, for which the list is repeated.
    """
    counted = other.groupBy(*map(quoted, key)).agg(F.count("*").alias("_n"))
    hot = hot_of(counted, key, LIST_ROWS).withColumn("_parts", F.least("_parts", F.lit(LIST_PARTS)))
    return join_per_key(rows, other, key, "inner", hot, "merge")


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row, the same whenever the row is computed again."""
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(quoted(c)) for c in hashable])


def hot_keys(rows: DataFrame, key: list[str], rows_per_split: int) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows, and into how many parts to split them."""
    names = [quoted(c) for c in key]
    return hot_of(rows.dropna(subset=names).groupBy(*names).agg(F.count("*").alias("_n")), key, rows_per_split)


def hot_of(counted: DataFrame, key: list[str], rows_per_split: int) -> DataFrame:
    """The same from the number of rows ``_n`` of each key.

    A key must hold more than one of ``HOT_KEYS`` parts of all rows too: so there are
    fewer than ``HOT_KEYS`` of them however many rows there are, and they can be broadcast.
    """
    share = counted.agg(F.sum("_n")).scalar() / F.lit(HOT_KEYS)
    hot = counted.filter((F.col("_n") > rows_per_split) & (F.col("_n") > share))
    parts = F.ceil(F.col("_n") / F.lit(rows_per_split)).cast("int")
    return hot.select(*map(quoted, key), parts.alias("_parts"))


def adaptive_split(df: DataFrame) -> bool:
    """Does the session split the hot partitions of a shuffled join by itself?"""
    conf = df.sparkSession.conf
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(conf.get(name, "true") == "true" for name in names)


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: list[str],
    how: str,
    hot: DataFrame | None = None,
    strategy: str | None = None,
) -> DataFrame:
    """Join many rows with a table of few rows per key (``inner`` or ``left``).

    With ``hot`` (see ``hot_keys``) the rows of a hot key are cut into its number
    of parts, and only that key's rows of ``per_key`` are repeated. Without it every
    key is one part. Either way the part is a join key, so both sides are shuffled
    for this join and not for what came before it: only then does adaptive
    execution split a partition that is much larger than the others. ``strategy`` is
    a hint for the join with ``hot``.
    """
    part_name = free_name("_part", rows.columns, per_key.columns)
    if hot is None:
        one = F.pmod(F.xxhash64(*map(quoted, key)), F.lit(1)).cast("int")
        left, right = rows.withColumn(part_name, one), per_key.withColumn(part_name, one)
        return left.join(right, [*key, part_name], how).drop(part_name)
    number = free_name("_parts", rows.columns, per_key.columns)
    hot = F.broadcast(hot.withColumnRenamed("_parts", number))
    parts = F.coalesce(number, F.lit(1))
    part = F.pmod(row_hash(rows), parts).cast("int")
    left = rows.join(hot, key, "left").withColumn(part_name, part).drop(number)
    right = (
        per_key.join(hot, key, "left")
        .withColumn(part_name, F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop(number)
    )
    return left.join(right.hint(strategy) if strategy else right, [*key, part_name], how).drop(part_name)
