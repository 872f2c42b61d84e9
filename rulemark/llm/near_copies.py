"""Near copies by wide SimHash fingerprints and keys of pairs of Golay code words.

The contract of ``simhash`` links at 2 of 64 bits, which a single changed word often exceeds. Here
texts are alike if the sets of their 5-word shingles have a similarity (Jaccard) of ``SIMILAR`` or
more. Of two sets of one size with similarity s, a SimHash bit differs with probability
acos(2s / (1 + s)) / pi, so ``BITS`` bits tell the similarity with a standard error of 0.02 or less,
and a pair is linked if its differing bits are at most those expected at ``SIMILAR``.

The bits are cut into 56 segments of 23. Each is decoded to the nearest word of the perfect
(23, 12) Golay code; a key is the pair of code words of two segments, one or two places apart in the ring
of segments. Two texts share a key if few of their errors fall in one such pair. That is a matter of chance: of pairs
with a similarity of 0.9 nearly all share one of the ``KEYS`` keys, of those with 0.8 some two thirds.
A key tells 2**24 classes apart, so a text meets ``KEYS`` * n / 2**24 unrelated ones of n by chance.

Links so far make components, and two members of one component need no further comparison. The ``FIRST_KEYS`` find most links:
in each of these all fingerprints are compared with the least, then members of different components. With the components then
known, only members of keys that several components meet in are joined at all: a key whose members are all of one is left out when
keys are counted, so a group of copies costs a row for each member and first key. In a divided key the
strays (members not of its home, which is one of its components, in large keys that of most members) are compared with all
members of other components, if they are ``STRAYS`` at most. Of more, only the least stray is compared, and the rest goes on
with the components then known and a limit ``GROWTH`` times as large. These are mostly texts that share a key
without being alike, such as those with a long passage in common; among m of them the comparisons grow with the square of m,
but only links are rows. No link is lost: a pair that shares a key is compared unless it is in one component already.

Texts are read once; only ids, fingerprints and keys are shuffled. Texts that agree in the first 64 bits
are one. Words are those of ``simhash``; a text of up to five words is one shingle, null and empty texts have
none and are alike. In texts of less than 13 words one changed word may leave a similarity somewhat below
``SIMILAR`` and be linked. Rows without an id and repeated rows are treated as by ``simhash``. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import cut, same, small_batches, text_hash, utf8, without_rows
from rulemark.llm.components import components
from rulemark.llm.simhash import ERRORS, SEED, syndromes

SHINGLE, SIMILAR = 5, 0.8
#: Segments of 23 bits, and how far apart those of a key are.
SEGMENTS, APART = 56, (1, 2)
KEYS, BITS = SEGMENTS * len(APART), SEGMENTS * 23
#: 64-bit words of a fingerprint; the last one is not full.
LONGS = -(-BITS // 64)
#: Differing bits of a link; and of the first 64, by which unrelated pairs are told at once (3.6 standard deviations).
SHARE = math.acos(2 * SIMILAR / (1 + SIMILAR)) / math.pi
RADIUS, FIRST_RADIUS = int(SHARE * BITS), math.ceil(SHARE * 64 + 3.6 * math.sqrt(64 * SHARE * (1 - SHARE)))
#: Strays of one key that are all compared with its other members, and by how much more in each round.
STRAYS, GROWTH = 64, 4
#: Numbers of the keys whose links make the first components, and of the others.
FIRST_KEYS = np.arange(0, KEYS, 7)
OTHER_KEYS = np.setdiff1d(np.arange(KEYS), FIRST_KEYS)
#: Shingles counted at once; sums of up to 255 fit a byte.
BLOCK = 255

#: Of the errors that lead to code words, the least, by syndrome.
_weights = np.where(ERRORS >= 0, np.bitwise_count(np.maximum(ERRORS, 0)), 24)
NEAREST = ERRORS[np.arange(len(ERRORS)), _weights.argmin(axis=1)]
#: Steps and factors of the SplitMix64 generator (fixed values), which makes the words of a shingle from its hash.
STEP, FIRST, SECOND = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
STEPS = np.arange(LONGS, dtype=np.uint64) * STEP


def shingle_hashes(text: bytes) -> np.ndarray:
    """Hashes of the different shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - SHINGLE + 1)
    starts, ends = starts[:last].tolist(), ends[-last:].tolist()
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((hashed(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, last))


def wide_fingerprint(text: bytes) -> np.ndarray:
    """``LONGS`` 64-bit words."""
    hashes = shingle_hashes(text)
    counts = np.zeros(LONGS * 64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        x = hashes[at : at + BLOCK, None] + STEPS
        x = (x ^ (x >> np.uint64(30))) * FIRST
        x = (x ^ (x >> np.uint64(27))) * SECOND
        x ^= x >> np.uint64(31)
        counts += np.unpackbits(x.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    counts[BITS:] = 0
    return np.packbits(counts * 2 > len(hashes)).view(np.uint64)


def _fingerprints(batches):
    for batch in batches:
        words = np.array([wide_fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64).reshape(-1, LONGS)
        words = words.view(np.int64)
        bits = pa.ListArray.from_arrays(np.arange(len(words) + 1, dtype=np.int32) * LONGS, words.ravel())
        columns = [batch.column(0), batch.column(1), pa.array(words[:, 0]), bits]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp", "bits"])


def wide_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``bits`` (all words of the fingerprint) and ``fp``, the first of them."""
    rows = small_batches(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("text_hash"), utf8().alias("text")
    )
    return rows.mapInArrow(_fingerprints, "doc_id bigint, text_hash bigint, fp bigint, bits array<bigint>")


def wide_keys(words: np.ndarray) -> np.ndarray:
    """The ``KEYS`` keys of each fingerprint (rows of ``LONGS`` words)."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1)[:, :BITS]
    parts = bits.reshape(-1, SEGMENTS, 23) @ (1 << np.arange(23))
    index = (parts ^ NEAREST[syndromes(parts)]) >> 11
    number = np.arange(SEGMENTS)
    pairs = [(number * len(APART) + n) << 24 | index << 12 | np.roll(index, -d, axis=1) for n, d in enumerate(APART)]
    return np.concatenate(pairs, axis=1)


def _keyed(named: DataFrame, numbers: np.ndarray) -> DataFrame:
    """Members (``key``, ``fp``, ``component``) of these keys, made from ``fp``, ``bits`` and ``component``."""

    def keys(batches):
        for batch in batches:
            words = batch.column(1).flatten().to_numpy().reshape(-1, LONGS)
            fps, names = (np.repeat(batch.column(i).to_numpy(), len(numbers)) for i in (0, 2))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (wide_keys(words)[:, numbers].ravel(), fps, names)], ["key", "fp", "component"])

    return named.select("fp", "bits", "component").mapInArrow(keys, "key bigint, fp bigint, component bigint")


def _differing(left: str, right: str) -> Column:
    """Differing bits of two columns ``bits``."""
    words = [F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(LONGS)]
    return sum(words[1:], words[0])


def _alike(left: str, right: str) -> Column:
    return F.bit_count(F.col(left).bitwiseXOR(F.col(right))) <= FIRST_RADIUS


def _verified(pairs: DataFrame, wide: DataFrame) -> DataFrame:
    """The different pairs (``u``, ``v``) that are linked."""
    left = wide.select(F.col("fp").alias("_u"), F.col("bits").alias("_u_bits"))
    right = wide.select(F.col("fp").alias("_v"), F.col("bits").alias("_v_bits"))
    pairs = pairs.distinct()
    both = pairs.join(left, pairs["u"] == left["_u"]).select("u", "v", "_u_bits")
    both = both.join(right, both["v"] == right["_v"])
    return both.filter(_differing("_u_bits", "_v_bits") <= RADIUS).select("u", "v")


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with a column ``fp``, and the ``component`` of each by the links found."""
    nodes = components(found).select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    named = rows.join(nodes, rows["fp"] == nodes["_node"], "left")
    return named.select(*rows.columns, F.coalesce("_component", "fp").alias("component"))


def _divided(members: DataFrame) -> DataFrame:
    """Members of keys that several components meet in, with ``home``, the least of these, and their number ``n``."""
    keys = members.groupBy(F.col("key").alias("_key"))
    keys = keys.agg(F.min("component").alias("home"), F.max("component").alias("last"), F.count("*").alias("n")).filter("home < last")
    return members.join(keys, members["key"] == keys["_key"]).select("key", "fp", "component", "home", "n")


def _settled(members: DataFrame) -> DataFrame:
    """Members of divided keys, with the component most members of the key have as ``home``, and the number of ``strays``."""
    sizes = members.groupBy(F.col("key").alias("_key"), "component").agg(F.count("*").alias("n"))
    most = F.max_by("component", F.struct("n", "component"))
    keys = sizes.groupBy("_key").agg(most.alias("home"), (F.sum("n") - F.max("n")).alias("strays")).filter("strays > 0")
    return members.join(keys, members["key"] == keys["_key"]).select("key", "fp", "bits", "component", "home", "strays")


def _linked(some: DataFrame, members: DataFrame) -> DataFrame:
    """Links between some members and all of their key that are of another component."""
    left = some.select("key", F.col("fp").alias("u"), F.col("component").alias("_u"), F.col("bits").alias("_u_bits"))
    right = members.select(F.col("key").alias("_key"), F.col("fp").alias("v"), F.col("component").alias("_v"), F.col("bits").alias("_v_bits"))
    meet = (left["key"] == right["_key"]) & (F.col("_u") != F.col("_v")) & (_differing("_u_bits", "_v_bits") <= RADIUS)
    return left.join(right, meet).select("u", "v")


def _across(divided: DataFrame, found: DataFrame, wide: DataFrame) -> DataFrame:
    """The links found, and those between members of divided keys that are of different components."""
    bits, limit = wide.select(F.col("fp").alias("_fp"), "bits"), STRAYS
    members = cut(divided.join(bits, divided["fp"] == bits["_fp"]).drop("_fp"))
    small, members = members.filter(F.col("n") <= limit), members.filter(F.col("n") > limit)
    found = cut(found.union(_linked(small.filter("component != home"), small)))
    members = members.select("key", "fp", "bits", "component")
    while not members.isEmpty():
        settled = cut(_settled(members))
        few, crowded = settled.filter(F.col("strays") <= limit), settled.filter(F.col("strays") > limit)
        found = cut(found.union(_linked(few.filter("component != home"), few)))
        if crowded.isEmpty():
            break
        least = crowded.filter("component != home").groupBy(F.col("key").alias("_key")).agg(F.min("fp").alias("least"))
        crowded = cut(crowded.join(least, crowded["key"] == least["_key"]).drop("_key"))
        found = cut(found.union(_linked(crowded.filter("fp = least"), crowded)))
        members = cut(_named(crowded.filter("fp != least").select("key", "fp", "bits"), found))
        limit *= GROWTH
    return found


def links(wide: DataFrame) -> DataFrame:
    """Edges ``u``, ``v`` between fingerprints (``fp``, ``bits``, each once) with the components of all links."""
    first = cut(_divided(_keyed(wide.select("fp", "bits", F.col("fp").alias("component")), FIRST_KEYS)))
    met = first.filter("fp != home").select(F.col("fp").alias("u"), F.col("home").alias("v"))
    found = cut(_verified(met.filter(_alike("u", "v")), wide))
    found = _across(_divided(cut(_named(first.select("key", "fp"), found))), found, wide)
    return _across(_divided(_keyed(cut(_named(wide.select("fp", "bits"), found)), OTHER_KEYS)), found, wide)


def near_copy_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``component_id`` (least id of its group)."""
    rows = cut(wide_fingerprints(docs))
    wide = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min("bits").alias("bits")))
    linked = components(links(wide)).select(F.col("node").alias("_node"), "component")
    named = wide.join(linked, wide["fp"] == linked["_node"], "left")
    named = cut(named.select("fp", "first", F.coalesce("component", "fp").alias("component")))
    least = named.groupBy(F.col("component").alias("_component")).agg(F.min("first").alias("component_id"))
    names = named.join(least, named["component"] == least["_component"])
    names = names.select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(names, rows["fp"] == names["_fp"]).select("doc_id", "text_hash", "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, that with the smallest id, with all columns; a group without ids stays whole."""
    dropped = near_copy_groups(docs).filter(~same(F.col("doc_id"), F.col("component_id")))
    return without_rows(docs, cut(dropped.select("doc_id", "text_hash")))
