import random

import pytest

from helpers import rows
from pyspark.sql import functions as F
from rulemark.operators import actions, skew, snapshot, sync


def reference_latest(data, date=True):
    """Latest row per key, first of equals; of keys without any date the last row."""
    best = {}
    for key, when, at, value in data:  # in load order
        if key is None:
            continue
        if key not in best:
            best[key] = (when, at, value)
        elif date:
            held = best[key][0]
            if held is None or (when is not None and when > held):
                best[key] = (when, at, value)
    return sorted((k, v[2]) for k, v in best.items())


@pytest.mark.parametrize("order_type", ["bigint", "string", "timestamp", "date"])
def test_latest_per_key(spark, order_type):
    rng = random.Random(3)
    data = [
        (rng.choice([None, 0, 0, 0, *range(1, 30)]), rng.choice([None, "2024-01-01", "2024/02/01", "2023-01-01"]), i, f"v{i:03}")
        for i in range(300)
    ]
    df = spark.createDataFrame(data, "k int, d string, i bigint, v string")
    order = {
        "bigint": F.col("i"), "string": F.lpad(F.col("i").cast("string"), 5, "0"),
        "timestamp": F.timestamp_seconds("i"), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("i").cast("int")),
    }[order_type]
    df = df.withColumn("o", order)
    assert rows(snapshot.latest_per_key(df, "k", ["v"], "d", ("o",))) == sorted(reference_latest(data), key=repr)
    assert rows(snapshot.latest_per_key(df, "k", ["v"], None, ("o",))) == sorted(reference_latest(data, False), key=repr)
    counted = snapshot.latest_per_key(df, "k", ["v"], "d", ("o",), count_as="n")
    assert sum(x["n"] for x in counted.collect()) == sum(x[0] is not None for x in data)


def test_latest_without_tiebreak_is_stable(spark):
    df = spark.createDataFrame([(1, "2024", "a"), (1, "2024", "b"), (1, "2023", "z"), (2, None, "x")], "k int, d string, v string")
    assert rows(snapshot.latest_per_key(df, "k", ["v"], "d")) == [(1, "b"), (2, "x")]
    assert rows(snapshot.latest_per_key(df, "k", [])) == [(1,), (2,)]


def test_detect_date_column(spark):
    df = spark.createDataFrame(
        [("x", "2024-01-01", "2024.01.01"), ("y", "2024-02-01", None), ("2024-01-01", "2024-03-01\n", "2024/01/02"), ("z", "2024-03-01", None),
         ("z", "2024-03-01", "no")],
        "a string, b string, c string",
    )
    assert snapshot.detect_date_column(df) == "b"  # four of five
    assert snapshot.detect_date_column(df, "c") == "b"  # two of three are not enough
    assert snapshot.detect_date_column(df.limit(4), "c") == "c"
    assert snapshot.detect_date_column(df, "missing") == "b"
    assert snapshot.detect_date_column(df.select("a")) is None
    assert snapshot.detect_date_column(df.select(F.lit(1).alias("n"))) is None


HITS = [
    (1, 1, "r", ("A", None)), (1, 2, "r", ("B", "x")), (1, 3, "r", (None, "y")), (1, 4, "a", ("tag", "")),
    (2, 5, "d", (None, None)), (2, 4, "a", ("tag", "")), (3, 6, "a", ("B, Z", "q")), (3, 7, "a", ("a", "q")), (3, 1, "r", ("A", None)),
    (4, 8, "r", ("", None)), (5, 9, "?", ("n", "n")),
]


def hits(spark):
    return spark.createDataFrame(HITS, "id int, rule_id int, action string, labels struct<c:string,d:string>")


def test_actions(spark):
    df = hits(spark)
    table = spark.createDataFrame([(i, None, None) for i in range(1, 7)], "id int, c string, d string")
    assert rows(actions.resolve(df, ["c", "d"])) == [
        (1, False, "tag", "y"), (2, True, "tag", None), (3, False, "B, Z, a", "q"), (4, False, "", None), (5, False, None, None)
    ]
    assert rows(actions.resolve(df, ["c", "d"], add_mode="append"))[0] == (1, False, "B, tag", "y")
    assert rows(actions.apply_delete(table, "id", df).select("id")) == [(1,), (3,), (4,), (5,), (6,)]
    assert rows(actions.apply_replace(table, "id", df, ["c", "d"]))[:4] == [(1, "B", "y"), (2, None, None), (3, "A", None), (4, "", None)]
    assert rows(actions.tag_table(df, ["c", "d"])) == [(1, "c", "tag"), (2, "c", "tag"), (3, "c", "B, Z"), (3, "c", "a"), (3, "d", "q")]
    assert rows(actions.used_columns(actions.tag_table(df, ["c", "d"]))) == [("c",), ("d",)]
    assert rows(actions.join_tags(actions.tag_table(df, ["c", "d"]), "+"))[2] == (3, "c", "B, Z+a")
    assert rows(actions.last_rule(df).select("id", "rule_id")) == [(1, 4), (2, 5), (3, 7), (4, 8), (5, 9)]


def test_documented_add_examples(spark):
    cases = [("ELECTRONICS", "SMARTPHONES", "ELECTRONICS, SMARTPHONES"), ("BRAND1, BRAND3", "BRAND2", "BRAND1, BRAND2, BRAND3"),
             ("YANDEX MARKET", "YANDEX MARKET", "YANDEX MARKET")]
    for old, new, expected in cases:
        df = spark.createDataFrame([(1, 1, "r", (old,)), (1, 2, "a", (new,))], "id int, rule_id int, action string, labels struct<c:string>")
        assert rows(actions.resolve(df, ["c"], add_mode="append"))[0][2] == expected


def test_sync(spark):
    target = spark.createDataFrame([(1, "a", "old"), (1, "b", "old"), (2, "c", "old"), (None, "d", "old")], "k int, v string, l string")
    source = spark.createDataFrame([(1, "new"), (3, "only"), (None, "null")], "k int, l string")
    hot = skew.hot_keys(target, ["k"], 1)
    for h in (None, hot):
        assert rows(sync.update_from(target, source, "k", ["k", "l"], h)) == [(1, "a", "new"), (1, "b", "new"), (2, "c", "old"), (None, "d", "old")]
    assert rows(sync.missing_rows(source, target, "k")) == [(3, "only"), (None, "null")]
    assert rows(sync.insert_missing(target, source, "k", ["l"]))[-3:] == [
        (None, "d", "old"), (None, None, "null"), (None, None, "only")
    ]
    assert rows(sync.delete_missing(target, source, "k")) == [(1, "a", "old"), (1, "b", "old")]
    assert rows(sync.sync_tables(target, source, "k", ["l"])) == [(1, "a", "new"), (1, "b", "new")]


def test_unmapped(spark):
    df = spark.createDataFrame([("s", None, "x"), ("s", None, "x"), ("t", "a", "b"), ("u", None, None)], "s string, c string, d string")
    assert rows(sync.unmapped_rows(df, ["s"], ["c", "d"])) == [("s", None, "x"), ("u", None, None)]
    assert rows(sync.unmapped_rows(df, ["s"], ["c", "d"], "all")) == [("u", None, None)]
    assert sync.unmapped_rows(df, ["s"], []).count() == 0


def test_hot_keys_are_split(spark):
    many = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    per_key = spark.range(0, 9_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = skew.hot_keys(many, ["k"], 500)
    assert rows(hot) == [(0, 7)]
    for how in ("inner", "left"):
        plain = many.join(per_key, "k", how)
        split = skew.join_per_key(many, per_key, ["k"], how, hot)
        assert rows(split.select(plain.columns)) == rows(plain)


def test_adaptive_execution_splits_hot_keys(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        many = spark.range(0, 60_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        # grouped by the key already, as resolved labels are
        per_key = spark.range(60_000).groupBy(F.col("id").alias("k")).agg(F.max("id").alias("w"))
        joined = skew.join_per_key(many, per_key, ["k"], "left").agg(F.count("v").alias("n"), F.sum("w").alias("s"))
        assert rows(joined) == [(60_000, sum(i for i in range(60_000) if i % 3))]
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
        assert skew.adaptive_split(many)
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        assert not skew.adaptive_split(many)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        for name, value in before.items():
            spark.conf.set(name, value)


def test_snapshot_of_a_folder_job_scans_once(spark, tmp_path):
    from rulemark.operators.compiled import compile_rules
    from rulemark.plans.folder import resolved_snapshot

    path = str(tmp_path / "data")
    spark.range(100).select(F.lit("x").alias("a"), (F.col("id") % 7).alias("k"), "id").write.parquet(path)
    raw = spark.createDataFrame([(1, "r", "f", "0", None, "X", "t")], "n int, action string, match string, search string, note string, term string, l string")
    data = spark.read.parquet(path)
    state = resolved_snapshot(data, compile_rules(raw, data.columns, ["n"]), "k", None, ("id",))
    assert {(r["l"], r["_is_deleted"]) for r in state.collect()} == {("t", False)}
    assert sum(r["_rows"] for r in state.collect()) == 100
    state.collect()
    plan = state._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


RULE_SCHEMA = "n int, action string, match string, search string, note string, term string"


def job(spark, rules, schema="", **options):
    from rulemark.operators.compiled import compile_rules
    from rulemark.options import LabelOptions
    from rulemark.plans.label import label_table

    data = spark.createDataFrame(
        [("x", 1, True), ("y", 1, None), ("x", None, None), ("z", 2, False)], "a string, k int, is_deleted boolean"
    )
    raw = spark.createDataFrame(rules, RULE_SCHEMA + schema)
    compiled = compile_rules(raw, data.columns, ["n"], LabelOptions(**options))
    return label_table(data, compiled, "k", None)


def test_job_without_rules(spark):
    result = job(spark, [])
    assert rows(result.labelled) == [("x", 1, True), ("y", 1, None), ("z", 2, False)]
    assert result.hits.count() == result.tags.count() == result.unmapped.count() == 0


def test_job_that_only_deletes(spark):
    result = job(spark, [(1, "d", "f", "0", None, "Z")])
    assert rows(result.labelled) == [("x", 1, True), ("y", 1, None)]
    assert result.labelled.columns == ["a", "k", "is_deleted"] and rows(result.hits) == [(2, 1)]


def test_job_keeps_rows_without_id_if_asked(spark):
    rules = [(1, "r", "p", "0", None, "z", "Z")]
    assert rows(job(spark, rules, ", l string").labelled) == [("x", 1, True, None), ("y", 1, None, None), ("z", 2, False, "Z")]
    kept = rows(job(spark, rules, ", l string", keep_null_ids=True).labelled)
    assert kept == [("x", 1, True, None), ("x", None, None, None), ("y", 1, None, None), ("z", 2, False, "Z")]


def test_job_needs_its_id_and_free_label_names(spark):
    from rulemark.errors import RuleError, SettingsError
    from rulemark.operators.compiled import compile_rules
    from rulemark.plans.label import label_table

    raw = spark.createDataFrame([(1, "r", "f", "0", None, "z", "Z")], RULE_SCHEMA + ", ID string")
    with pytest.raises(RuleError):
        compile_rules(raw, ["a"], ["n"])
    rules = compile_rules(raw.withColumnRenamed("ID", "l"), ["a"], ["n"])
    with pytest.raises(SettingsError):
        label_table(spark.createDataFrame([("x",)], "a string"), rules, "k")
