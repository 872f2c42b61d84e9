"""Delimited text with line breaks in quoted fields, read by many tasks per file.

Whether a line begins inside a quoted field depends on all lines before it. But each line has a function:
where it ends (inside a quoted field, or not) if it begins outside, and if it begins inside.
Functions are composed per block of a file in a first scan; one small table with a row per block then tells
how each block begins. A second scan passes the state on from line to line within its block. Lines that
are a record of their own are parsed where they are; only the others are shuffled to be put together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE, BLOCK, LINE = "_src_file", "_src_part", "_src_line"
#: What a line does to the state outside (bit 0) and inside a quoted field (bit 1): where it ends.
SAME, INTO, OUT, TURN = 0b10, 0b11, 0b00, 0b01
#: Up to this many blocks that begin inside a record, their table is broadcast.
MANY_BLOCKS = 100_000

# states between the quotes of a line
_BEGIN, _UNQUOTED, _QUOTED, _CLOSED = range(4)


def _ends_quoted(value: Column, separator: str, inside: bool) -> Column:
    """Does a line end in a quoted field? A quote opens one only at a field's begin; two in it are one quote."""
    parts = F.split(value, '"', -1)
    opens = F.lit(_QUOTED)

    def after(state: Column, part: Column) -> Column:
        fresh = F.when(part.endswith(separator), opens).otherwise(_UNQUOTED)
        return (
            F.when(state == _QUOTED, _CLOSED)
            .when((state == _CLOSED) & (part == ""), opens)
            .when((state == _BEGIN) & (part == ""), opens)
            .otherwise(fresh)
        )

    begin = F.lit(_QUOTED if inside else _BEGIN)
    # the last part has no quote after it
    return F.aggregate(F.slice(parts, 1, F.size(parts) - 1), begin, after) == _QUOTED


def _lines(spark: SparkSession, location: str, separator: str, reader_options: dict) -> DataFrame:
    """Lines in the order of their file and block, with what they do to the state."""
    lines = spark.read.option("lineSep", "\n").options(**reader_options).text(location)
    value = F.col("value")
    does = _ends_quoted(value, separator, False).cast("int") + _ends_quoted(value, separator, True).cast("int") * 2
    return lines.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.when(value.contains('"'), does).otherwise(SAME).cast("int").alias("does"),
        (~value.isin("", "\r")).alias("filled"),
        "value",
    )


def states(does: np.ndarray, begin: int) -> np.ndarray:
    """The state before each line, and after the last: 1 inside a quoted field."""
    fixed = (does == INTO) | (does == OUT)
    turns = np.concatenate([[0], np.cumsum(does == TURN)])
    # the last line whose end does not depend on its begin, counted from 1; 0 is the begin of all
    last = np.concatenate([[0], np.maximum.accumulate(np.where(fixed, np.arange(1, len(does) + 1), 0))]) if len(does) else np.zeros(1, int)
    value = np.concatenate([[begin], (does == INTO).astype(int)])[last]
    return (value + turns - turns[last]) % 2


class _Block:
    """Where a block stands: its next line, the state, and the line that the open record began with."""

    def __init__(self, begin: int, opened: tuple[int, int] | None):
        self.line, self.state, self.opened, self.head = 0, begin, opened, False


def _runs(batch: pa.RecordBatch):
    """Pieces of a batch that are of one file and block."""
    if not batch.num_rows:
        return
    files, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
    codes = files.indices.to_numpy()
    cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(codes)]):
        yield (files.dictionary[int(codes[start])].as_py(), int(blocks[start])), start, end


SUMMARY = f"{FILE} string, {BLOCK} bigint, from_out int, from_in int, opened_out bigint, opened_in bigint"


def _summaries(batches):
    """Per block and begin: how it ends, and the line that a record open at its end began with (-1: before the block)."""
    now, both = None, []

    def row():
        return (*now, *(b.state for b in both), *(b.opened if b.state else None for b in both))

    def table(r):
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(r, kinds)], names=[c.split()[0] for c in SUMMARY.split(", ")])

    for batch in batches:
        does = batch.column(2).to_numpy()
        for key, start, end in _runs(batch):
            if key != now:
                if now:
                    yield table(row())
                now, both = key, [_Block(0, None), _Block(1, -1)]
            for b in both:
                state = states(does[start:end], b.state)
                begins = np.flatnonzero(state[:-1] == 0)
                if len(begins):
                    b.opened = b.line + int(begins[-1])
                b.line, b.state = b.line + end - start, int(state[-1])
    if now:
        yield table(row())


RECORD = f"{FILE} string, {BLOCK} bigint, {LINE} bigint, value string, head boolean, single boolean, first_block bigint, first_line bigint"


def _placed(batches):
    """Every line with its number in the block, and the place of the line its record begins with.

    ``head`` marks the first line of a file that is not empty.
    """
    now, block = None, None
    for batch in batches:
        does, filled, columns = batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False), batch.columns
        for key, start, end in _runs(batch):
            if key != now:
                first = tuple(columns[i][start].as_py() for i in (5, 6))
                now, block = key, _Block(int(first[0] is not None), first)
            n = end - start
            state = states(does[start:end], block.state)
            lines = block.line + np.arange(n)
            begins = np.where(state[:-1] == 0, lines, -1)
            last = np.maximum.accumulate(begins)
            carried = last < 0  # records that began in an earlier batch or block
            first_block = np.where(carried, block.opened[0] if block.opened[0] is not None else 0, now[1])
            first_line = np.where(carried, block.opened[1] if block.opened[1] is not None else 0, last)
            head = np.zeros(n, bool)
            if key[1] == 0 and not block.head and filled[start:end].any():
                block.head = head[np.argmax(filled[start:end])] = True
            yield pa.RecordBatch.from_arrays(
                [
                    columns[0].slice(start, n), columns[1].slice(start, n), pa.array(lines), columns[4].slice(start, n), pa.array(head),
                    pa.array((state[:-1] == 0) & (state[1:] == 0)), pa.array(first_block), pa.array(first_line),
                ],
                names=[c.split()[0] for c in RECORD.split(", ")],
            )
            block.opened = (int(first_block[-1]), int(first_line[-1]))
            block.line, block.state = block.line + n, int(state[-1])


def _openings(summaries: DataFrame) -> DataFrame:
    """``first_block``, ``first_line`` of the record that each block begins inside; other blocks are left out."""
    order = Window.partitionBy(FILE).orderBy(BLOCK)
    # Outside and inside as functions again: composed from block to block of a file, one row each.
    does = F.col("from_out") + F.col("from_in") * 2
    fixed = does.isin(INTO, OUT)
    turns = F.sum((does == TURN).cast("int")).over(order)
    last = F.last(F.when(fixed, F.struct((does == INTO).cast("int").alias("value"), turns.alias("turns"))), ignorenulls=True).over(order)
    state = F.pmod(F.coalesce(last["value"] + turns - last["turns"], turns), F.lit(2))
    ended = summaries.withColumn("state", state)
    begun = ended.withColumn("begin", F.coalesce(F.lag("state").over(order), F.lit(0)))
    opened = F.when(F.col("begin") == 1, F.col("opened_in")).otherwise(F.col("opened_out"))
    here = F.when((F.col("state") == 1) & (opened >= 0), F.struct(F.col(BLOCK).alias("block"), opened.alias("line")))
    before = F.last(here, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return begun.withColumn("first", before).filter("begin = 1").select(
        F.col(FILE).alias("_file"), F.col(BLOCK).alias("_block"), F.col("first.block").alias("first_block"), F.col("first.line").alias("first_line")
    )


def quoted_records(spark: SparkSession, location: str, separator: str = ";", reader_options: dict | None = None) -> DataFrame:
    """``value``: the records of all files at ``location``, with their file, block and line, and whether they are the ``head``.

    A record keeps its line breaks; it may lie across any number of blocks. Lines end with a line
    feed, after a carriage return or not; where a record ends with both, so do the line breaks in its
    fields, and a line feed is kept of each. The separator is one character.
    """
    lines = _lines(spark, location, separator, reader_options or {})
    # texts are not needed to tell how the blocks end
    openings = _openings(lines.select(FILE, BLOCK, "does").mapInArrow(_summaries, SUMMARY))
    few = openings.limit(MANY_BLOCKS + 1).toArrow()
    met = (F.col(FILE) == F.col("_file")) & (F.col(BLOCK) == F.col("_block"))
    if few.num_rows <= MANY_BLOCKS:
        begun = lines.join(F.broadcast(spark.createDataFrame(few, openings.schema)), met, "left")
    else:
        numbered = lines.withColumn("_order", F.monotonically_increasing_id()).join(openings, met, "left")
        begun = numbered.repartition(FILE, BLOCK).sortWithinPartitions(FILE, BLOCK, "_order")
    placed = begun.select(FILE, BLOCK, "does", "filled", "value", "first_block", "first_line").mapInArrow(_placed, RECORD)
    single = placed.filter("single").select(FILE, BLOCK, LINE, "value", "head")
    pieces = F.transform(F.sort_array(F.collect_list(F.struct(BLOCK, LINE, "value"))), lambda p: p["value"])
    together = F.array_join(pieces, "\n").alias("value"), F.max("head").alias("head")
    several = placed.filter("NOT single").groupBy(FILE, "first_block", "first_line").agg(*together)
    records = single.union(several.select(FILE, F.col("first_block").alias(BLOCK), F.col("first_line").alias(LINE), "value", "head"))
    value = F.col("value")
    bare = F.when(value.endswith("\r"), F.replace(F.substring(value, F.lit(1), F.length(value) - 1), F.lit("\r\n"), F.lit("\n"))).otherwise(value)
    return records.withColumn("value", bare).filter("value != ''")
