"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target of words. A document's copies are its source's rate (target by size)
rounded so that the expected number is kept and the words of the source come out near the target:
fractional copies are paired, and mass (copies x words) moves from one of a pair to the
other, at random and without change of either's mean, until one of the two is integral. The other
one goes on to the next pair.

- Documents of more than 1 / ``LARGE`` of their source, fewer than ``LARGE`` of them, are paired
  first, the largest first, each with the pool of all smaller ones: the pool's common rate
  takes up what the document leaves.
- The others are dealt by a hash to buckets of about ``BUCKET``, paired within them, and the one
  residual of each bucket goes up a tree, ``FAN`` residuals at a node, to a single one per source,
  which is drawn.

So a source misses its target by less than one of its small documents. One thing is not left to
chance: where the pool could not make up for one of the two outcomes of a large document,
and the source would miss its target by more than ``TOLERANCE`` of it, the document takes the
other (or the nearer) outcome. Only there the mean is not kept.

Documents equal in id, source and text count as one row with a number; large numbers are dealt
in parts of ``BUCKET``. The hash decides, not the place of a row: reruns agree however the
table is divided. Texts are not shuffled; each level of the tree goes to ``spark.checkpoint.dir``.

A null text has no words and is never taken. The null source is one source, the last. Targets are
found by rounds over the table of sources; three sums of each round reach the driver. An empty
table gives no rows, a source without words has the target 0. Other columns are not read.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import SPACES, cut, query, same, table, text_hash
from rulemark.operators.ordering import number_rows

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
LARGE, BUCKET, FAN = 1024, 2048, 1024
#: How far a source may be off its target for the sake of a large document's mean.
TOLERANCE = 1 / 256
SEED = 13

KEY = ["doc_id", "text_hash", "source", "size", "source_size", "target", "base"]
#: Rows of a key that get ``base`` copies, rows that get one more, or one row of a fractional rate.
UNITS = ["part", "bucket", "low", "high", "rate"]


def words() -> Column:
    """Number of words of a text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(marks, SPACES, "")).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``n`` with their ``target``: by weight, at most ``most`` times the size."""
    numbered = number_rows(sizes.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_rank").drop("_null")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    sources = cut(numbered.withColumn("_weight", weight.cast("double")).drop("_rank"))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        # sources below the level are full: what they cannot take goes to the others
        over = F.col("source_size") * most < F.col("_weight") * level
        sums = sources.agg(
            F.sum(F.when(over, F.col("source_size") * most).otherwise(0)), F.sum(F.when(over, 0.0).otherwise(F.col("_weight"))), F.count_if(over)
        ).first()
        if not sums[1] or sums[2] == full:
            break
        full, level = sums[2], (share * total - sums[0]) / sums[1]
    capped = F.least((F.col("source_size") * most).cast("double"), F.col("_weight") * level)
    return sources.select("source", "source_size", "n", capped.alias("target"))


def moved(p: float, s: float, q: float, t: float, draw: float) -> tuple[float, float]:
    """Two rates after mass went from one to the other; one of them is 0 or 1 then."""
    up, down = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
    if up + down <= 0:
        return p, q
    if draw * (up + down) < down:
        return (1.0, max(0.0, q - up / t)) if up == (1 - p) * s else (p + up / s, 0.0)
    return (0.0, min(1.0, q + down / t)) if down == p * s else (p - down / s, 1.0)


def _arrow(like: pa.Table, columns: dict[str, list]) -> pa.Table:
    schema = pa.schema([like.schema.field(n) for n in [*KEY, *UNITS]])
    return pa.Table.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def _settle_large(found: pa.Table) -> pa.Table:
    """The large documents of a source, each paired with the pool of the smaller ones; and the pool's rate."""
    found = found.sort_by([("size", "descending"), ("text_hash", "ascending"), ("doc_id", "ascending")])
    rows = found.to_pylist()
    draws = random.Random(rows[0]["text_hash"] * 31 + SEED)
    pool, rate, slack = rows[0]["source_size"], rows[0]["rate"], rows[0]["target"] * TOLERANCE
    for r in rows:
        high, size = 0, r["size"]
        for _ in range(r["low"]):
            pool -= size
            if not 0 < rate < 1:
                high += rate == 1
                continue
            # the mass that the pool cannot give, or take
            up, down = (1 - rate) * size - rate * pool, rate * size - (1 - rate) * pool
            taken = draws.random() < rate if max(up, down) <= slack else up <= down
            high += taken
            mass = rate * pool - (1 - rate) * size if taken else rate * pool + rate * size
            rate = min(1.0, max(0.0, mass / pool)) if pool else 0.0
        r["high"], r["low"] = high, r["low"] - high
    rest = dict.fromkeys([*KEY, *UNITS]) | {n: rows[0][n] for n in ("source", "source_size", "target", "base")} | {"part": -1, "rate": rate}
    rows.append(rest)
    return _arrow(found, {n: [r[n] for r in rows] for n in [*KEY, *UNITS]})


def _settle(found: pa.Table) -> pa.Table:
    """The rows of a bucket in pairs: all are settled but at most one, the residual."""
    found = found.sort_by([("size", "descending"), ("text_hash", "ascending"), ("doc_id", "ascending"), ("part", "ascending")])
    rows = found.to_pylist()
    draws = random.Random(rows[0]["text_hash"] * 31 + rows[0]["bucket"] + SEED)
    open_row, open_rate, out = None, 0.0, []

    def closed(row, rate):
        row["high" if rate == 1 else "low"] += 1

    for r in rows:
        units, rate, r["low"], r["high"], r["rate"] = r["low"], r["rate"], 0, 0, None
        out.append(r)
        if not 0 < rate < 1 or not r["size"]:
            r["high" if rate == 1 else "low"] += units
            continue
        for _ in range(units):
            if open_row is None:
                open_row, open_rate = r, rate
                continue
            open_rate, here = moved(open_rate, open_row["size"], rate, r["size"], draws.random())
            if 0 < here < 1:
                closed(open_row, open_rate)
                open_row, open_rate = r, here
            else:
                closed(r, here)
                if not 0 < open_rate < 1:
                    closed(open_row, open_rate)
                    open_row = None
    out = [r for r in out if r["low"] or r["high"]]
    if open_row is not None:
        out.append(open_row | {"low": 1, "high": 0, "rate": open_rate})
    return _arrow(found, {n: [r[n] for r in out] for n in [*KEY, *UNITS]})


def copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Rows of ``KEY`` with ``low`` documents taken ``base`` times and ``high`` taken once more."""
    keys = docs.select("doc_id", text_hash().alias("text_hash"), "source", words().alias("size"))
    keys = cut(keys.groupBy("doc_id", "text_hash", "source", "size").agg(F.count("*").alias("low")))
    sizes = keys.groupBy("source").agg(F.sum(F.col("size") * F.col("low")).alias("source_size"), F.sum("low").alias("n"))
    sources = targets(sizes, weights, share, most)
    exact = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = cut(
        sources.withColumn("base", F.floor(exact)).withColumn("rate", exact - F.col("base")).withColumn("buckets", F.ceil(F.col("n") / BUCKET))
    )
    named = sources.withColumnRenamed("source", "_source")
    units = keys.join(named, same(F.col("source"), F.col("_source"))).withColumn("high", F.lit(0).cast("bigint"))
    large = F.col("size") * LARGE > F.col("source_size")
    kinds = dict(units.dtypes) | {"part": "bigint", "bucket": "bigint"}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in [*KEY, *UNITS])
    none = F.lit(0).cast("bigint")
    biggest = units.filter(large).withColumns({"part": none, "bucket": none}).select(*KEY, *UNITS)
    settled = cut(biggest.groupBy("source").applyInArrow(_settle_large, schema))
    pools = settled.filter("part = -1").select(F.col("source").alias("_pool"), F.col("rate").alias("_rate"))
    decided = settled.filter("part >= 0")

    parts = F.explode(F.sequence(none, F.floor((F.col("low") - 1) / BUCKET)))
    small = units.filter(~large).join(pools, same(F.col("source"), F.col("_pool")), "left")
    small = small.withColumn("rate", F.coalesce("_rate", "rate")).withColumn("part", parts)
    small = small.withColumn("low", F.least(F.lit(BUCKET), F.col("low") - F.col("part") * BUCKET).cast("bigint"))
    small = small.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash", "part", F.lit(SEED)), F.col("buckets")))
    level = small.select(*KEY, *UNITS)
    most_buckets = sources.agg(F.max("buckets")).first()[0] or 0
    while True:
        done = cut(level.groupBy("source", "bucket").applyInArrow(_settle, schema))
        decided = decided.union(done.filter("rate IS NULL"))
        level = done.filter("rate IS NOT NULL")
        if most_buckets <= 1:
            break
        level = level.withColumn("bucket", F.floor(F.col("bucket") / FAN)).select(*KEY, *UNITS)
        most_buckets = -(-most_buckets // FAN)
    # one residual per source is left
    draw = F.pmod(F.xxhash64("source", "doc_id", "text_hash", F.lit(SEED)), F.lit(1 << 30)) / (1 << 30)
    last = level.withColumn("high", (draw < F.col("rate")).cast("bigint")).withColumn("low", 1 - F.col("high"))
    return decided.union(last.select(*KEY, *UNITS)).select(*KEY, "low", "high")


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: its words, its source's words and target, and the words taken of it."""
    found = copies(docs, **settings)
    often = F.concat(F.array_repeat(F.col("base"), F.col("low").cast("int")), F.array_repeat(F.col("base") + 1, F.col("high").cast("int")))
    rows = found.withColumn("copies", F.explode(often))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: ``doc_id``, ``source`` and ``text``, a row for each copy taken."""
    found = copies(docs, **settings).filter("size > 0")
    taken = F.sum(F.col("low") * F.col("base") + F.col("high") * (F.col("base") + 1))
    found = found.groupBy("doc_id", "text_hash", "source").agg(taken.alias("_taken")).filter("_taken > 0")
    found = found.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "source": "_source"})
    texts = docs.select("doc_id", "source", "text", text_hash().alias("_text_hash")).dropDuplicates(["doc_id", "source", "_text_hash"])
    met = same(F.col("doc_id"), F.col("_id")) & same(F.col("source"), F.col("_source")) & (F.col("_text_hash") == F.col("_hash"))
    return texts.join(found, met).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_taken")))).select("doc_id", "source", "text")


@query()
def op13_mixing(spark, sf):
    return mixture(table(spark, sf, "documents"))
