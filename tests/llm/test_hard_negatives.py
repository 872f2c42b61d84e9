"""Hard negatives against brute force in whole numbers."""

import math
import random

import numpy as np
import pytest

from rulemark.llm import hard_negatives as H

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, label int, rid string, score string, place string, low string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    usable = []
    for n, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = math.fmod(label + 1, 10) if vec_id is not None and vec_id % 7 == 0 else label
        whole = [max(-H.LARGEST, min(H.LARGEST, math.floor(float(np.float32(x)) * 256))) for x in vector]
        usable.append((n, vec_id, label, whole))
    out = []
    for n, vec_id, label, vector in usable:
        if vec_id is None or vec_id % 50:
            continue
        found = [(-sum(x * y for x, y in zip(vector, v)), i is None, i or 0, i, other) for k, i, other, v in usable if k != n]
        found.sort(key=lambda f: f[:3])
        for score, _, _, positive, _ in [f for f in found if f[4] == label][:5]:
            fits = [f for f in found if f[4] != label and -50 * score <= -100 * f[0] <= -95 * score]
            out += [(vec_id, positive, r, f[3], -score, -f[0]) for r, f in enumerate(fits[:3], 1)]
    return sorted(out, key=repr)


def made(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_the_table(spark):
    read = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    got = made(H.op11_hard_negatives(spark, SF))
    assert got == brute([tuple(r) for r in read]) and got


def frame(spark, rows):
    return spark.createDataFrame([(*r, "7", "7", "7", "7") for r in rows], SCHEMA)


@pytest.mark.parametrize("dense", [0.0, 0.1, 2.0])
def test_small_cells_ties_and_odd_rows(spark, monkeypatch, dense):
    monkeypatch.setattr(H, "ANCHORS", 7)
    monkeypatch.setattr(H, "ROWS", 90)
    monkeypatch.setattr(H, "DENSE", dense)
    rng = random.Random(4)
    vector = lambda n=20: [rng.gauss(0.05, 0.1) for _ in range(n)]
    rows = [(i, vector(), rng.randrange(4)) for i in range(420)]
    same = vector()
    rows += [(1000 + i, same, i % 3) for i in range(150)]
    rows += [(50, same, 1)] * 3 + [(None, vector(), 2), (None, same, 0), (2000, None, 1), (2050, vector(), None)]
    rows += [(2100, [float("nan"), 1.0], 1), (2101, [float("inf")], 1), (2102, [None, 0.5], 1), (2103, [], 2), (2150, [], 1)]
    rows += [(2200, vector(5), 0), (2250, vector(33), 1), (2300, [3e38, -3e38], 2), (-50, vector(), -3), (2350, [-0.4] * 20, 1)]
    assert made(H.hard_negatives(frame(spark, rows).repartition(4))) == brute(rows)


def test_large_numbers_are_exact(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-3e5, 3e5) for _ in range(6)], rng.randrange(2)) for i in range(120)]
    assert made(H.hard_negatives(frame(spark, rows))) == brute(rows)


def test_no_rows_and_few_rows(spark):
    assert made(H.hard_negatives(frame(spark, []))) == []
    assert made(H.hard_negatives(frame(spark, [(0, [1.0], 1)]))) == []
    assert made(H.hard_negatives(frame(spark, [(50, [1.0], 1), (1, [1.0], 2), (2, [1.0], 1), (3, [0.6], 2)]))) == [(50, 2, 1, 3, 65536, 39168)]
    assert made(H.hard_negatives(frame(spark, [(50, [0.0], 1), (1, [1.0], 2), (2, [1.0], 1)]))) == [(50, 2, 1, 1, 0, 0)]


def test_bounds_hold(spark):
    """Bounds enclose all scores, and rule out most pairs of vectors whose segments differ in level."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    levels = np.repeat(rng.normal(size=(300, 4)), 16, axis=1)
    vectors = np.floor(256 * (levels + 0.05 * rng.normal(size=(300, 64)))).astype(np.int32)
    table = pa.table({"rid": range(300), "vec_id": range(300), "label": [0] * 300, "vector": list(vectors)})
    cell = H.Cell(table.slice(0, 40), table)
    scores = vectors[:40].astype(int) @ vectors.astype(int).T
    for level in (0, 1):
        low, high = cell.bounds(slice(0, 40), level)
        assert (low <= scores).all() and (scores <= high).all()
        fifth = np.sort(scores, axis=1)[:, -5:-4]
        assert (high >= fifth).mean() < 0.1
