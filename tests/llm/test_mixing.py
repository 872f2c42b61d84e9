"""Mixing: targets against water filling by hand, copies against the law of the method."""

import random
import re
from collections import Counter, defaultdict

import pytest
from corpus_helpers import SCHEMA, prose

from rulemark.llm import mixing as M

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    out, left, free = {}, share * sum(sizes.values()), set(order)
    while free:
        total = sum(weight[s] for s in free)
        given = {s: left * weight[s] / total for s in free}
        over = [s for s in free if given[s] > most * sizes[s]]
        if not over:
            return out | given
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def frame(spark, rows):
    fields = [f.name for f in SCHEMA]
    return spark.createDataFrame([tuple({"doc_id": i, "text": t, "source": s}.get(n, "7") for n in fields) for i, t, s in rows], SCHEMA)


def laws(rows, got):
    """What every mix must keep; returns the words taken by source."""
    count = lambda t: len(WORD.findall(t or ""))
    sizes, most = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += count(text)
        most[source] = max(most[source], count(text))
    targets = wanted(sizes)
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, count(t), s) for i, t, s in rows)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]], abs=1e-6)
        rate = targets[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert r["taken"] in {int(rate + 1e-9) * r["size"], int(-(-(rate - 1e-9) // 1)) * r["size"]}
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    return taken, targets, most


def test_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = M.op13_mixing(spark, SF).collect()
    taken, targets, _ = laws(rows, got)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 0.01 * target, source
    again = M.mixture(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_buckets_residuals_and_repeats(spark, monkeypatch):
    """Small buckets, so that the tree has several levels."""
    monkeypatch.setattr(M, "BUCKET", 8)
    monkeypatch.setattr(M, "FAN", 3)
    monkeypatch.setattr(M, "LARGE", 4)
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randint(1, 30)), rng.choice(["a", "a", "a", "b", "ü", None])) for i in range(700)]
    rows += [(1000, "the same row again", "a")] * 300 + [(None, "no id", None)] * 40 + [(i, None, "b") for i in range(2000, 2050)]
    rows += [(3000 + i, " \n ", "empty") for i in range(5)] + [(4000, prose(rng, 9000), "c"), (4001, prose(rng, 20), "c")]
    df = frame(spark, rows)
    got = M.mixture(df).collect()
    taken, targets, most = laws(rows, got)
    for source, target in targets.items():
        assert abs(taken[source] - target) <= most[source]
    assert sorted(map(tuple, M.mixture(df.repartition(3)).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    texts = Counter((r["doc_id"], r["source"]) for r in M.mixed(df).collect())
    copies = Counter()
    for r in got:
        copies[r["doc_id"], r["source"]] += r["copies"] if r["size"] else 0
    assert texts == +copies


def test_means_are_kept(spark, monkeypatch):
    """Over many seeds, a document's copies average its source's rate, large or small."""
    rng = random.Random(2)
    sizes = [90, 60, 45, 30] + [rng.randint(1, 9) for _ in range(100)]
    rows = [{"doc_id": i, "text_hash": i * 7919, "size": s, "low": 1, "bucket": 0, "part": 0, "high": 0} for i, s in enumerate(sizes)]
    fixed = {"source": "a", "source_size": sum(sizes), "target": 0.3 * sum(sizes), "base": 0, "rate": 0.3}
    import pyarrow as pa

    high, large, errors = Counter(), [r for r in rows if r["size"] > 20], []
    for seed in range(3000):
        monkeypatch.setattr(M, "SEED", seed * 1009)
        done = M._settle_large(pa.Table.from_pylist([r | fixed for r in large])).to_pylist()
        rate = done[-1]["rate"]
        small = [r | fixed | {"rate": rate} for r in rows if r["size"] <= 20]
        done = done[:-1] + M._settle(pa.Table.from_pylist(small)).to_pylist()
        left = [r for r in done if r["rate"] is not None and r["part"] == 0 and r["size"] <= 20]
        assert len(left) <= 1
        words = 0
        for r in done:
            if r in left:
                r["high"] = int(random.Random(seed).random() < r["rate"])
            high[r["doc_id"]] += r["high"]
            words += r["high"] * r["size"]
        errors.append(abs(words - fixed["target"]))
    assert max(errors) <= 9
    for r in rows:
        assert high[r["doc_id"]] / 3000 == pytest.approx(0.3, abs=0.05), r


def test_no_rows_and_no_words(spark):
    assert M.mixture(frame(spark, [])).collect() == []
    got = M.mixture(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
