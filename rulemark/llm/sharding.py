"""Shards of near equal bytes by a histogram sort.

Rows are ordered by a key of two hashes, of the text and of the id, so that equal texts
stand together and even they can be divided. The splitters between the shards are
found by counting: every round sums the exact bytes of the rows in cells of the key
space, and divides the cells that hold a splitter into ``CELLS`` finer ones,
until each splitter is within the tolerance. Only sums of cells reach the driver:
(shards - 1) x ``CELLS`` of a round at most. Then the rows, without their
texts, are exchanged once to number them within their shard.

The last bits of the key are those of a row's number in the checkpoint, so that rows equal in
id and text can be divided too, between shards and between tasks.

A null text has size 1. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import bisect
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rulemark.llm.common import cut, query, table

#: Parts into which a round divides a cell: 12 bits of the key.
BITS = 12
CELLS = 1 << BITS
#: How far a splitter may be from its place, as a share of a shard's bytes.
TOLERANCE = 0.002
#: Rows numbered in one task.
ROWS_PER_TASK = 200_000
#: Bits of a hash that make the key; 60 is a multiple of BITS.
HASH_BITS = 60
#: The last bits, which tell equal rows apart.
ROW_BITS = 24
ROUNDS = 2 * HASH_BITS // BITS


def digit(level: int) -> Column:
    """The 12 bits of the key that a round looks at: first those of ``a``, then of ``b``."""
    name, at = ("a", level) if level < ROUNDS // 2 else ("b", level - ROUNDS // 2)
    return F.shiftright(F.col(name), HASH_BITS - BITS * (at + 1)).bitwiseAND(CELLS - 1)


def within(prefix: tuple[int, ...]) -> Column:
    """Whether a row's key starts with these digits."""
    half = ROUNDS // 2
    found = F.lit(True)
    for name, part in (("a", prefix[:half]), ("b", prefix[half:])):
        if part:
            value = 0
            for d in part:
                value = value << BITS | d
            found &= F.shiftright(F.col(name), HASH_BITS - BITS * len(part)) == value
    return found


def at_least(prefix: tuple[int, ...]) -> Column:
    """Whether a row's key is not below the least key that starts with these digits."""
    a, b = 0, 0
    for level in range(ROUNDS):
        d = prefix[level] if level < len(prefix) else 0
        if level < ROUNDS // 2:
            a = a << BITS | d
        else:
            b = b << BITS | d
    return (F.col("a") > a) | ((F.col("a") == a) & (F.col("b") >= b))


def following(prefix: tuple[int, ...]) -> tuple[int, ...]:
    """The next prefix of this length; for the last one of its cell, that of the cell after it."""
    while prefix and prefix[-1] == CELLS - 1:
        prefix = prefix[:-1]
    return (*prefix[:-1], prefix[-1] + 1) if prefix else (CELLS,)


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, ...]]:
    """Key prefixes in order; a shard starts at each of them."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    slack = tolerance * total / shards
    cells: dict[tuple[int, ...], int] = {(): 0}  # cells to divide, and the bytes before them
    wanted = {(): [total * i / shards for i in range(1, shards)]}
    done: list[tuple[int, ...]] = []
    for level in range(ROUNDS):
        if not wanted:
            break
        which = F.lit(None).cast("int")
        order = sorted(wanted)
        for i, prefix in enumerate(order):
            which = F.when(within(prefix), F.lit(i)).otherwise(which)
        counted = rows.select(which.alias("cell"), digit(level).alias("digit"), "size").filter("cell IS NOT NULL")
        sums: dict[int, list[tuple[int, int, int]]] = {}
        for r in counted.groupBy("cell", "digit").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect():
            sums.setdefault(r["cell"], []).append((r["digit"], r["n"], r["rows"]))
        finer: dict[tuple[int, ...], list[float]] = {}
        before: dict[tuple[int, ...], int] = {}
        for i, prefix in enumerate(order):
            found = sorted(sums[i])
            ends = list(accumulate((n for _, n, _ in found), initial=cells[prefix]))
            for target in wanted[prefix]:
                at = min(max(bisect.bisect_right(ends, target) - 1, 0), len(found) - 1)
                cell, gap, rest = (*prefix, found[at][0]), target - ends[at], ends[at + 1] - target
                if min(gap, rest) <= slack or found[at][2] == 1 or level == ROUNDS - 1:
                    done.append(cell if gap <= rest else following(cell))
                else:
                    finer.setdefault(cell, []).append(target)
                    before[cell] = ends[at]
        wanted, cells = finer, before
    return sorted(done, key=lambda p: (*p, *[0] * (ROUNDS - len(p))))


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    mask, row_mask = (1 << HASH_BITS) - 1, (1 << ROW_BITS) - 1
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).bitwiseAND(mask).alias("a"),
            F.xxhash64(F.col("doc_id"), F.lit("row")).bitwiseAND(mask ^ row_mask).alias("b"),
        )
    )
    number = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(row_mask)
    rows = rows.withColumn("b", F.col("b").bitwiseOR(number))
    starts = splitters(rows, shards)
    shard = sum((at_least(p).cast("int") for p in starts), F.lit(0))
    tasks = max(1, rows.count() // (shards * ROWS_PER_TASK))
    placed = rows.withColumn("shard", shard).withColumn("task", F.expr(f"cast(pmod(b, {tasks}) as int)"))
    # Texts never move; each pair of shard and task gets about ROWS_PER_TASK rows.
    order = W.partitionBy("shard", "task").orderBy("a", "b", "doc_id")
    numbered = placed.withColumn("place", F.row_number().over(order))
    sizes = placed.groupBy("shard", "task").agg(F.count("*").alias("n"))
    before = sizes.select(
        F.col("shard").alias("_shard"),
        F.col("task").alias("_task"),
        (F.sum("n").over(W.partitionBy("shard").orderBy("task")) - F.col("n")).alias("before"),
    )
    joined = numbered.join(before, (F.col("shard") == F.col("_shard")) & (F.col("task") == F.col("_task")))
    return joined.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op7_sharding(spark, sf):
    return shard_by_bytes(table(spark, sf, "documents"))
