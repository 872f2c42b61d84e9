"""Exact duplicates by a minimal perfect hash over the digests of a history.

The distinct digests of the history are dealt into buckets by their first bits. Each
bucket gets a minimal perfect hash: levels of bit arrays, where a digest takes a bit of
the first level in which no other digest falls on the same one, and its slot is the
number of bits set before. A slot holds the full digest and the locator of the
winner. Arriving digests are looked up by bucket and compared byte by byte: members
are repeats of a winner, the others form groups of their own.

Only digests, ids and counts are shuffled. Digests are aggregated before every shuffle,
so a text that holds a third of all rows is one row of a bucket. The last join brings
the winners to the rows; adaptive execution splits its hot digests.

A null text equals the empty one. A row without an id loses to rows with one. Of
repeated rows (same id and text) one stays. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.functions.names import free_name
from rulemark.llm.common import SPACES, cut, query, same, small_batches, table

#: Digests of a bucket, on average.
BUCKET_SIZE = 4096
#: Bits of a level for each digest that reaches it.
GAMMA = 2.0

INDEX = "bucket int, levels array<binary>, digests binary, ids array<bigint>, rows array<bigint>, counts array<bigint>"
GROUPS = "digest string, keep_id bigint, keep_row bigint, group_size bigint"


def digest(text: str = "text") -> Column:
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " "), 256)


def digests(docs: DataFrame) -> DataFrame:
    """A digest for every row, with a number for the row, kept in the shared folder."""
    return cut(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), digest().alias("digest")))


def distinct_digests(rows: DataFrame) -> DataFrame:
    """Each digest once: its first locator and its number of rows."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    return rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n")).select(
        "digest", F.col("first.doc_id").alias("id"), F.col("first.row").alias("row"), "n"
    )


def bucket(buckets: int) -> Column:
    return F.expr(f"cast(pmod(cast(conv(substr(digest, 1, 8), 16, 10) as bigint), {buckets}) as int)")


def _words(digests: list[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(digests)), "<u8").reshape(-1, 4)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    x = words[:, 2] + np.uint64(2 * level + 1) * words[:, 3]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def perfect_hash(digests: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Bit arrays by level, and the slot of each digest. The digests are distinct."""
    words = _words(digests)
    left, slots, levels, used = np.arange(len(digests)), np.empty(len(digests), np.int64), [], 0
    while len(left):
        size = max(64, int(GAMMA * len(left)) // 8 * 8 + 8)
        places = _places(words[left], len(levels), size)
        hits = np.bincount(places, minlength=size)
        alone = hits[places] == 1
        bits = hits == 1
        slots[left[alone]] = used + np.cumsum(bits)[places[alone]] - 1
        used += int(bits.sum())
        levels.append(np.packbits(bits).tobytes())
        left = left[~alone]
    return levels, slots


def look_up(levels: list[bytes], digests: list[str]) -> np.ndarray:
    """The slot each digest would have, or -1. The caller compares what the slot holds."""
    words, found = _words(digests), np.full(len(digests), -1, np.int64)
    left, used = np.arange(len(digests)), 0
    for level, packed in enumerate(levels):
        bits = np.unpackbits(np.frombuffer(packed, np.uint8))
        places = _places(words[left], level, len(bits))
        here = bits[places] == 1
        found[left[here]] = used + np.cumsum(bits)[places[here]] - 1
        used += int(bits.sum())
        left = left[~here]
    return found


def _build(rows: pa.Table) -> pa.Table:
    keys = rows["digest"].to_pylist()
    levels, slots = perfect_hash(keys)
    order = np.empty(len(keys), np.int64)
    order[slots] = np.arange(len(keys))
    ordered = rows.take(pa.array(order))
    return pa.table(
        {
            "bucket": pa.array([rows["bucket"][0].as_py()], pa.int32()),
            "levels": pa.array([levels], pa.list_(pa.binary())),
            "digests": pa.array([bytes.fromhex("".join(ordered["digest"].to_pylist()))], pa.binary()),
            "ids": pa.array([ordered["id"].to_pylist()], pa.list_(pa.int64())),
            "rows": pa.array([ordered["row"].to_pylist()], pa.list_(pa.int64())),
            "counts": pa.array([ordered["n"].to_pylist()], pa.list_(pa.int64())),
        }
    )


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of the distinct digests (``digest``, ``id``, ``row``, ``n``)."""
    return history.withColumn("bucket", bucket(buckets)).groupBy("bucket").applyInArrow(_build, INDEX)


def _better(a: tuple, b: tuple) -> tuple:
    return min(a, b, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def _resolve(index: pa.Table, arriving: pa.Table) -> pa.Table:
    out: list[tuple] = []
    keys = arriving["digest"].to_pylist() if arriving.num_rows else []
    new = list(zip(*(arriving[c].to_pylist() for c in ("id", "row", "n")))) if keys else []
    if index.num_rows:
        held = index["digests"][0].as_py()
        ids, rows, counts = (index[c][0].as_py() for c in ("ids", "rows", "counts"))
        slots = look_up(index["levels"][0].as_py(), keys) if keys else []
        for k, s in enumerate(slots):
            if s >= 0 and held[32 * s : 32 * s + 32] == bytes.fromhex(keys[k]):
                ids[s], rows[s] = _better((ids[s], rows[s]), new[k][:2])
                counts[s] += new[k][2]
                new[k] = None
        out += [(held[32 * s : 32 * s + 32].hex(), ids[s], rows[s], counts[s]) for s in range(len(ids))]
    out += [(key, *row) for key, row in zip(keys, new) if row is not None]
    names = ("digest", "keep_id", "keep_row", "group_size")
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
    columns = list(zip(*out)) or [()] * 4
    return pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, columns, kinds)})


def groups(history: DataFrame, arriving: DataFrame, buckets: int) -> DataFrame:
    """All groups of equal texts: those of the history with what repeats them, and new ones."""
    index = build_index(history, buckets)
    new = arriving.withColumn("bucket", bucket(buckets))
    return index.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInArrow(_resolve, GROUPS)


def exact_dedup(docs: DataFrame, historical: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``historical`` tells the rows whose digests make the index; by default those in the
    lower half of the range of ids. The result is the same whatever it says.
    """
    small_batches(docs)
    rows = digests(docs)
    if historical is None:
        ends = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
        historical = F.lit(False) if ends[0] is None else F.col("doc_id") <= (ends[0] + ends[1]) // 2
    old = F.coalesce(historical, F.lit(False))
    buckets = max(1, -(-rows.count() // BUCKET_SIZE))
    found = groups(distinct_digests(rows.filter(old)), distinct_digests(rows.filter(~old)), buckets)
    joined = rows.join(found.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"))
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    stay = cut(exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")))
    mark = free_name("_digest", docs.columns, stay.columns)
    marked = docs.withColumn(mark, digest())
    matched = marked.join(stay, (marked[mark] == stay["_sha"]) & same(marked["doc_id"], stay["_id"]), "left_semi")
    ids = docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_id"))
    if ids.isEmpty():
        return matched.drop(mark)
    ids = cut(ids)
    repeated = matched.join(ids, same(matched["doc_id"], ids["_id"]), "left_semi")
    single = matched.join(ids, same(matched["doc_id"], ids["_id"]), "left_anti")
    return single.unionByName(repeated.dropDuplicates(["doc_id", mark])).drop(mark)


@query(
    r"""
    WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
        row_number() OVER (PARTITION BY s ORDER BY doc_id) = 1 AS kept, s AS text_sha256
    FROM d
    """
)
def op2_exact_dedup(spark, sf):
    return exact_dedup(table(spark, sf, "documents"))
