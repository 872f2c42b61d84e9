"""State of streams: tiers of runs, failures between their steps."""

import os
import random

import pytest
from helpers import rows
from test_sources import COLUMNS, RULES

from rulemark.errors import SettingsError
from rulemark.operators.compiled import compile_rules
from rulemark.plans.label import label_table
from rulemark.streaming import label_stream as streams
from rulemark.streaming import runs as R

SCHEMA = ", ".join(f"{c} string" for c in [*COLUMNS, "batch"])


def rules_of(spark):
    raw = spark.createDataFrame(RULES, "n int, action string, match string, search string, note string, term string, cat string, tags string")
    return compile_rules(raw, [*COLUMNS, "batch"], ["n"])


def batches(n, ids=12):
    """Rows of ids that come again and again, some with older dates; a column named like the state's own."""
    rng, out = random.Random(n), []
    for b in range(n):
        out.append([])
        for _ in range(4):
            brand, article = rng.choice([("OZON", "MARKET PHONE"), ("none", "SMARTPHONE"), ("DELETE ME", "x"), ("none", "other")])
            day = f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
            values = {"AdId": str(rng.randrange(ids)), "day": day, "brand": brand, "article": article}
            out[-1].append(tuple(values.get(c, "m") for c in COLUMNS) + (str(b),))
    return out


def labelled(spark, out, rules):
    return rows(streams.labelled_so_far(spark, out, rules, "AdId").select("AdId", "day", "article", "batch", "cat", "tags"))


def at_once(spark, parts, rules):
    data = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    return rows(label_table(data, rules, "AdId", "day").labelled.select("AdId", "day", "article", "batch", "cat", "tags"))


def test_few_runs_whatever_the_batches(spark, tmp_path):
    out, parts, rules = str(tmp_path / "out"), batches(10), rules_of(spark)
    sink = streams.LabelSink(rules, "AdId", out, "day", fan=3)
    store = sink.store(spark)
    for number, part in enumerate(parts):
        sink(spark.createDataFrame(part, SCHEMA), number)
        runs = store.runs(number)
        assert runs[0].first == 0 and runs[-1].last == number
        assert all(a.last + 1 == b.first for a, b in zip(runs, runs[1:]))
        assert all(sum(r.tier == t for r in runs) < 3 for t in range(4))
        # folders of this state and of the one before it, no others
        for table in ("snapshot", "labels"):
            assert {*os.listdir(f"{out}/{table}")} >= {r.name for r in runs}
            assert len(os.listdir(f"{out}/{table}")) <= len(runs) + 5
        assert len(store.batches()) <= 2
    assert [r.tier for r in store.latest()] == [2, 0]
    # a merged run holds each id once
    state = spark.read.parquet(store.path("labels", store.latest()[0]))
    assert state.count() == state.select("id").distinct().count()
    assert labelled(spark, out, rules) == at_once(spark, parts, rules)


@pytest.mark.parametrize("step", ["merge", "second merge", "manifest", "forget"])
def test_a_batch_that_fails_runs_again(spark, tmp_path, monkeypatch, step):
    """At any point: before a merge is put in force, or after, before the stream knows of it."""
    out, parts, rules = str(tmp_path / "out"), batches(5, ids=5), rules_of(spark)
    sink = streams.LabelSink(rules, "AdId", out, "day", fan=2)
    done = 0

    def fail(*_):
        raise OSError("lost")

    merge, merges = R.newest_per_key, []

    def failing_merge(*given):
        merges.append(1)
        return fail() if len(merges) == (2 if step == "merge" else 3) else merge(*given)

    for number, part in enumerate(parts):
        batch = spark.createDataFrame(part, SCHEMA)
        if number == 3:  # with two merges of two tables
            with monkeypatch.context() as m:
                if "merge" in step:
                    m.setattr(R, "newest_per_key", failing_merge)
                elif step == "manifest":
                    m.setattr(R, "write_text", fail)
                elif step == "forget":
                    m.setattr(R.RunStore, "_forget", fail)
                with pytest.raises(OSError):
                    sink(batch, number)
                done = sink.store(spark).batches()[-1]
                assert done == (3 if step == "forget" else 2)
        sink(batch, number)
    assert labelled(spark, out, rules) == at_once(spark, parts, rules)
    state = sink.store(spark)
    left = {r.name for b in state.batches() for r in state.runs(b)}
    assert {*os.listdir(f"{out}/snapshot")} == {*os.listdir(f"{out}/labels")} == left


def test_state_of_another_stream(spark, tmp_path):
    out, rules = str(tmp_path / "out"), rules_of(spark)
    sink = streams.LabelSink(rules, "AdId", out, "day")
    with pytest.raises(SettingsError):
        streams.labelled_so_far(spark, out, rules, "AdId")
    batch = spark.createDataFrame(batches(1)[0], SCHEMA)
    with pytest.raises(SettingsError):
        sink(batch, 1)
    sink(batch, 0)
    sink(batch, 1)
    with pytest.raises(SettingsError):
        sink(batch, 0)
    with pytest.raises(SettingsError):
        R.RunStore(spark, out, ("labels",), 1)


def test_merging_aggregates_numbers_only(spark):
    """Newest rows are found by hash aggregation of key and batch."""
    plan = R.newest_per_key(spark.createDataFrame([("a", "text", 1)], f"id string, v string, {R.BATCH} bigint"), "id")
    shown = plan._jdf.queryExecution().toString()
    assert "HashAggregate" in shown and "SortAggregate" not in shown
