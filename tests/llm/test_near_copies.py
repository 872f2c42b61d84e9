"""The pipeline's near copies: recall by changed words, precision and large groups, against plain Jaccard."""

import random

import numpy as np
import pytest
from corpus_helpers import frame

from rulemark.llm import near_copies
from rulemark.llm.components import components


def text(rng, n):
    return [f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.randrange(400)}" for _ in range(n)]


def changed(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.randrange(10**6)}"
    return words


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a, b))
    return len(a & b) / len(a | b)


def groups(spark, texts):
    rows = near_copies.near_copy_groups(frame(spark, [(i, " ".join(w), "en") for i, w in enumerate(texts)]))
    return {r["doc_id"]: r["component_id"] for r in rows.collect()}


@pytest.fixture(scope="module")
def copies():
    """By number of changed words: pairs of a text of 200 to 400 words and its copy."""
    rng = random.Random(11)
    return {n: [(w, changed(rng, w, n)) for w in (text(rng, rng.randint(200, 400)) for _ in range(150))] for n in (1, 2, 3, 4)}


def test_recall_by_changed_words(spark, copies):
    pairs = [(n, p) for n, ps in copies.items() for p in ps]
    found = groups(spark, [w for _, p in pairs for w in p])
    for n in copies:
        caught = [found[2 * i + 1] == 2 * i for i, (m, _) in enumerate(pairs) if m == n]
        assert sum(caught) / len(caught) >= 0.9, n
    # nothing else is linked
    assert all(found[i] in (i, i - i % 2) for i in found)


def test_links_only_what_is_alike(spark):
    rng = random.Random(12)
    texts = []
    for _ in range(120):
        base = text(rng, 300)
        texts += [base, base[:200] + text(rng, 100), text(rng, 60) + base[:240]]
    assert max(jaccard(texts[i], texts[j]) for i in range(0, 360, 3) for j in (i + 1, i + 2)) < 0.72
    found = groups(spark, texts)
    assert all(found[i] == i for i in found)


def test_large_group_and_one_of_each(spark):
    rng = random.Random(13)
    base, other = text(rng, 300), text(rng, 300)
    texts = [changed(rng, base, 3) for _ in range(400)] + [changed(rng, other, 2) for _ in range(30)] + [text(rng, 200) for _ in range(20)]
    found = groups(spark, texts)
    assert sum(found[i] == 0 for i in range(400)) >= 398 and sum(found[i] == 400 for i in range(400, 430)) >= 29
    assert all(found[i] == i for i in range(430, 450))
    docs = frame(spark, [(i, " ".join(w), "en") for i, w in enumerate(texts)])
    kept = near_copies.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in found if found[i] == i}


@pytest.mark.parametrize("strays", [1, near_copies.STRAYS])
def test_cloud_around_the_radius(spark, monkeypatch, strays):
    """Near copies of which many are not alike each other: all links of pairs with a key count, few pairs are made."""
    rng = np.random.default_rng(15)
    base = rng.integers(0, 2, near_copies.LONGS * 64)
    rates = [0.02] * 60 + [0.07] * 180 + [0.15] * 80 + [0.16] * 80
    bits = np.array([base ^ (rng.random(len(base)) < r) for r in rates], np.uint8)
    bits[:, near_copies.BITS :] = 0
    words = np.packbits(bits, axis=1).view(np.uint64)
    words = words[np.unique(words[:, 0], return_index=True)[1]]
    keys = near_copies.wide_keys(words)
    parent = list(range(len(words)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(words)):
        for j in range(i):
            if np.bitwise_count(words[i] ^ words[j]).sum() <= near_copies.RADIUS and (keys[i] == keys[j]).any():
                parent[root(i)] = root(j)
    groups = {}
    for i, w in enumerate(words.view(np.int64)):
        groups.setdefault(root(i), []).append(int(w[0]))
    assert 50 < len(groups) < 200

    made, verified = [], near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, wide: made.append(pairs.distinct().count()) or verified(pairs, wide))
    monkeypatch.setattr(near_copies, "STRAYS", strays)
    rows = [(int(w[0]), w.tolist()) for w in words.view(np.int64)]
    found = components(near_copies.links(spark.createDataFrame(rows, "fp bigint, bits array<bigint>"))).collect()
    names = {r["node"]: r["component"] for r in found}
    assert all({names.get(fp, fp) for fp in group} == {min(group)} for group in groups.values())
    values, counts = np.unique(keys, return_counts=True)
    assert sum(made) < min(sum(counts[counts > 1]), sum(counts * (counts - 1) // 2) / 10)


def test_rows_of_a_group_that_shares_all_keys(spark, monkeypatch):
    """Near copies meet by few of the keys they share, and other texts by all: rows that keys are joined to."""
    rng = np.random.default_rng(16)
    bits = rng.integers(0, 2, (1, near_copies.LONGS * 64)) ^ (rng.random((300, near_copies.LONGS * 64)) < 0.03)
    pair = rng.integers(0, 2, (1, near_copies.LONGS * 64)) ^ (rng.random((2, near_copies.LONGS * 64)) < 0.05)
    bits = np.concatenate([bits, pair]).astype(np.uint8)
    bits[:, near_copies.BITS :] = 0
    words = np.packbits(bits, axis=1).view(np.int64)
    keys = near_copies.wide_keys(words)
    values, counts = np.unique(keys, return_counts=True)
    assert sum(counts[counts > 1]) > 0.8 * near_copies.KEYS * 300 and any(keys[300] == keys[301])

    made, cut = [], near_copies.cut

    def counted(df):
        out = cut(df)
        if "key" in out.columns:
            made.append(out.count())
        return out

    monkeypatch.setattr(near_copies, "cut", counted)
    rows = [(int(w[0]), w.tolist()) for w in words]
    found = components(near_copies.links(spark.createDataFrame(rows, "fp bigint, bits array<bigint>"))).collect()
    names = {r["node"]: r["component"] for r in found}
    least = [min(fp for fp, _ in group) for group in (rows[:300], rows[300:])]
    assert [names[fp] for fp, _ in rows] == [least[0]] * 300 + [least[1]] * 2
    assert max(made) <= near_copies.KEYS * 300 / 4 and sum(made) <= near_copies.KEYS * 300 / 2


def test_nulls_empties_ties_and_repeats(spark, docs, empty, nothing):
    assert near_copies.keep_one_of_each(empty).count() == 0
    assert {r["component_id"] for r in near_copies.near_copy_groups(nothing).collect()} == {1}
    found = near_copies.near_copy_groups(docs).collect()
    assert len(found) == docs.count()
    groups = {r["doc_id"]: r["component_id"] for r in found}
    assert groups[400] == groups[401] == groups[402] == groups[403] == 400
    assert groups[406] == groups[407] == 406 and groups[404] == 404 and groups[405] == 405
    assert groups[None] is None
    # one word of 300 is changed: all but few of the 40 copies are one group
    assert sum(groups[300 + i] == 300 for i in range(40)) == 40


def test_bits_estimate_the_similarity():
    rng = random.Random(14)
    for keep, alike in ((300, True), (280, True), (240, False), (150, False)):
        base = text(rng, 300)
        a, b = (near_copies.wide_fingerprint(" ".join(w).encode()) for w in (base, base[:keep] + text(rng, 300 - keep)))
        differing = sum(int(x ^ y).bit_count() for x, y in zip(a, b))
        assert (differing <= near_copies.RADIUS) == alike, keep


def test_columns_named_like_those_of_the_operator(spark):
    from pyspark.sql import functions as F

    names = ("fp", "bits", "_fp", "_u", "_v", "key", "component", "component_id", "first", "text_hash", "_gone_id")
    long = [(1, "one text of five words"), (1, "one text of  five words"), (2, "one text of five words"), (3, "another text"), (None, "no id")]
    docs = spark.createDataFrame(long, "doc_id bigint, text string").select("*", *[F.concat(F.lit(n), "text").alias(n) for n in names])
    kept = near_copies.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == ["1", "1", "3", "None"]
