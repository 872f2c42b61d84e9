"""Near duplicates by SimHash fingerprints and keys of a Golay code.

Two fingerprints of 64 bits are linked if they differ in 2 bits or fewer. The bits are
cut into three segments. By the pigeonhole principle one segment has no error, and every
segment has 2 at most. A segment of up to 23 bits is decoded to all words of the perfect
(23, 12) Golay code within distance 4: one or six of them. Two segments that differ in 2
bits have a word between them at distance 1 from both, which lies within 3 of a
code word; so they share a code word. A key is one segment as it is, with the code word
index of the next: 18 keys of a fingerprint at most, of about 33 bits each.

Distinct fingerprints are joined by key, and each pair is verified. Where a key holds more
than ``PAIR_LIMIT`` fingerprints, these are not paired: each is sent to the 65 words that
differ in at most one bit. Two fingerprints are linked exactly if they share one of
those, so a star around each word's least fingerprint has the same components.

Texts are read once; only ids and fingerprints are shuffled. A null or empty text has no
words and fingerprint zero, which links like any other. Rows without an id are members
too, but name a component only if all its rows lack one. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import cut, query, same, small_batches, table, text_hash, utf8, without_rows
from rulemark.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints of one key that are paired; more of them meet at the words between them.
PAIR_LIMIT = 32
#: Shingles counted at once.
BLOCK = 1 << 15

#: Fixed value: generator polynomial of the (23, 12) Golay code.
GENERATOR = 0xC75
#: Lowest bit and number of bits of the segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    words = text.lower().split()  # of bytes: A-Z, and the white space of the contract
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > size:
        starts, ends = starts[: 1 - size], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts, hashed = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        values = np.array([hashed(joined[s:e], SEED) for s, e in pairs], ">u8")
        counts += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big", signed=True)


def _fingerprints(batches):
    for batch in batches:
        fps = [fingerprint(t) for t in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array(fps, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp``, the 64 bits as a signed number."""
    rows = small_batches(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("text_hash"), utf8().alias("text")
    )
    return rows.mapInArrow(_fingerprints, "doc_id bigint, text_hash bigint, fp bigint")


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator."""
    out = words.copy()
    for bit in range(22, 10, -1):
        out ^= ((out >> bit) & 1) * (GENERATOR << (bit - 11))
    return out


def error_table() -> np.ndarray:
    """By syndrome, the error patterns of weight 4 or less that lead to code words; -1 fills a row."""
    bits = [1 << i for i in range(23)]
    patterns = [0]
    weight = [0]
    for n in range(1, 5):
        weight = [w | b for w in weight for b in bits if b > w]
        patterns += weight
    table = np.full((2048, 6), -1, np.int64)
    used = np.zeros(2048, np.int64)
    for s, e in zip(syndromes(np.array(patterns, np.int64)).tolist(), patterns):
        table[s, used[s]] = e
        used[s] += 1
    return table


ERRORS = error_table()


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the fingerprints, and their keys, one of each pair."""
    bits = fps.view(np.uint64)
    parts = [((bits >> np.uint64(low)) & np.uint64((1 << n) - 1)).astype(np.int64) for low, n in SEGMENTS]
    places, found = [], []
    for which in range(3):
        near = parts[(which + 1) % 3]
        errors = ERRORS[syndromes(near)]
        at, column = np.nonzero(errors >= 0)
        index = (near[at] ^ errors[at, column]) >> 11
        places.append(at)
        found.append(np.int64(which) << 34 | parts[which][at] << 12 | index)
    return np.concatenate(places), np.concatenate(found)


def _keys(batches):
    for batch in batches:
        fps = batch.column(0).to_numpy()
        at, key = keys(fps)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps[at])], ["key", "fp"])


def links(fps: DataFrame) -> DataFrame:
    """Edges ``u``, ``v`` between distinct fingerprints (``fp``), with the components of all links."""
    keyed = cut(fps.mapInArrow(_keys, "key bigint, fp bigint"))
    shared = keyed.groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("n")).filter("n > 1")
    meeting = cut(keyed.join(shared, keyed["key"] == shared["_key"]).select("key", "fp", "n"))
    few = meeting.filter(F.col("n") <= PAIR_LIMIT)
    left = few.select("key", F.col("fp").alias("u"))
    right = few.select(F.col("key").alias("_key"), F.col("fp").alias("v"))
    close = (F.col("u") > F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS)
    paired = left.join(right, (left["key"] == right["_key"]) & close).select("u", "v")
    many = meeting.filter(F.col("n") > PAIR_LIMIT).select("fp").distinct()
    between = many.select("fp", F.explode(F.array(F.lit(0), *(F.lit(_signed(1 << b)) for b in range(64)))).alias("flip"))
    between = between.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
    least = between.groupBy(F.col("word").alias("_word")).agg(F.min("fp").alias("v"), F.count("*").alias("n"))
    least = least.filter("n > 1").select("_word", "v")
    stars = between.join(least, between["word"] == least["_word"]).filter("fp != v").select(F.col("fp").alias("u"), "v")
    return paired.union(stars)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hex), ``component_id``."""
    rows = cut(fingerprints(docs))
    return _groups(rows).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _groups(rows: DataFrame) -> DataFrame:
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = components(links(distinct.select("fp"))).select(F.col("node").alias("_node"), "component")
    named = distinct.join(linked, distinct["fp"] == linked["_node"], "left")
    named = cut(named.select("fp", "first", F.coalesce("component", "fp").alias("component")))
    least = named.groupBy(F.col("component").alias("_component")).agg(F.min("first").alias("component_id"))
    names = named.join(least, named["component"] == least["_component"])
    names = names.select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(names, rows["fp"] == names["_fp"])


def keep_representatives(docs: DataFrame) -> DataFrame:
    """One document of each group, that with the smallest id; a group without ids stays whole."""
    rows = cut(fingerprints(docs))
    dropped = _groups(rows).filter(~same(F.col("doc_id"), F.col("component_id")))
    return without_rows(docs, cut(dropped.select("doc_id", "text_hash")))


@query()
def op3_simhash_near_dedup(spark, sf):
    return simhash_groups(table(spark, sf, "documents"))
