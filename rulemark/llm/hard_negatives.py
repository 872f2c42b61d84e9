"""Hard negatives found by summaries of vector segments.

Every vector is divided into segments, coarse and then fine ones (``LEVELS``); a segment's summary is
its mean and deviation. The part of an inner product in a segment of m components is
m (mean x mean + covariance), and the covariance is at most the product of the deviations, so

    m (mean x mean - deviation x deviation) <= part <= m (mean x mean + deviation x deviation).

The sums over the segments bound a score from both sides. Pairs whose bounds rule them out go
after the coarse level, others after the fine one, and only the rest is scored exactly. Bounds
are widened by more than their rounding error, so no pair is lost.

Anchors and rows meet in a grid: a cell is a block of some ``ANCHORS`` anchors and a block of some
``ROWS`` rows, dealt by the hash of a row's number, so no label or vector gathers in a task. The first
pass finds each anchor's best rows of its label in every cell, then among the cells: a row is left
out if its upper bound is below the fifth best score known in the cell. The second finds, for each
positive, the best rows of other labels within its range of scores: bounds below or above all
ranges of the anchor rule a row out. A cell gives ``POSITIVES`` rows an anchor at most, or
``NEGATIVES`` a positive, so the choice among cells is over few rows.

The work of this contract is every fiftieth row against all rows, so it grows with the square of the
table, and so do the rows sent to the grid: rows x blocks of anchors + anchors x blocks of rows.

Rows without a label or vector, or with a component that is null or not finite, take no part. Shorter
vectors count as filled up with zeros; whole numbers beyond ``LARGEST`` count as that, so that scores
fit a long. Rows are told apart by a number, so a repeated row is another row; null ids come last
among ties and are no anchors. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rulemark.llm.common import cut, query, table

POSITIVES, NEGATIVES = 5, 3
#: A negative's score is between these hundredths of the positive's.
LEAST, MOST = 50, 95
#: Sizes of a cell of the grid, and anchors that are bounded at once.
ANCHORS, ROWS, AT_ONCE = 2048, 8192, 128
#: Components of a segment, coarse to fine.
LEVELS = (16, 4)
#: Pairs refined at once, and the share of pairs from which on a product of matrices is cheaper.
PAIRS, DENSE = 1 << 16, 0.1
#: The largest whole number of a component.
LARGEST = 1 << 27
#: Sums below this are exact in doubles.
EXACT = 1 << 53
LONG = (1 << 63) - 1


def prepared(embeddings: DataFrame) -> DataFrame:
    """The rows that take part: ``rid`` (a row's number), ``vec_id``, ``label`` after the change, ``vector``."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col("label").cast("bigint")
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * 256, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    rows = embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: whole(x).cast("int")).alias("vector"),
    )
    return cut(rows).withColumn("rid", F.monotonically_increasing_id())


class Block:
    """Rows of a cell with the summaries of their segments."""

    def __init__(self, rows: pa.Table, dims: int):
        self.vectors = np.zeros((rows.num_rows, dims))
        lists = rows.column("vector").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy()) if rows.num_rows else np.empty(0, int)
        places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.vectors[np.repeat(np.arange(rows.num_rows), lengths), places] = lists.flatten().to_numpy()
        self.labels = rows.column("label").to_numpy()
        self.rids = rows.column("rid").to_numpy()
        self.ids = rows.column("vec_id").fill_null(LONG).to_numpy()
        self.known = ~rows.column("vec_id").is_null().to_numpy()
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.levels = []
        for m in LEVELS:
            parts = np.pad(self.vectors, ((0, 0), (0, -dims % m))).reshape(rows.num_rows, -1, m)
            # times the root of m, so that a product of two carries the factor m
            self.levels.append((parts.mean(axis=2) * m**0.5, parts.std(axis=2) * m**0.5))


class Cell:
    """Anchors and rows that meet."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        longest = [pc.list_value_length(t.column("vector")).to_numpy().max(initial=1) for t in (anchors, rows)]
        self.a, self.b = (Block(t, int(max(longest))) for t in (anchors, rows))
        self.doubles = self.a.largest * self.b.largest * self.a.vectors.shape[1] < EXACT

    def bounds(self, part: slice, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all pairs of some anchors with all rows."""
        (am, ad), (bm, bd) = self.a.levels[level], self.b.levels[level]
        middle, off = am[part] @ bm.T, ad[part] @ bd.T
        off += 1e-9 * np.outer(self.a.norms[part], self.b.norms) + 1e-9
        return middle - off, middle + off

    def refined(self, i: np.ndarray, j: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of single pairs."""
        (am, ad), (bm, bd) = self.a.levels[level], self.b.levels[level]
        low, high = np.empty(len(i)), np.empty(len(i))
        for s in range(0, len(i), PAIRS):
            p, q = i[s : s + PAIRS], j[s : s + PAIRS]
            middle, off = np.einsum("pd,pd->p", am[p], bm[q]), np.einsum("pd,pd->p", ad[p], bd[q])
            off += 1e-9 * self.a.norms[p] * self.b.norms[q] + 1e-9
            low[s : s + PAIRS], high[s : s + PAIRS] = middle - off, middle + off
        return low, high

    def scored(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Exact scores of single pairs."""
        kind, out = float if self.doubles else np.int64, np.empty(len(i), np.int64)
        for s in range(0, len(i), PAIRS):
            left, right = self.a.vectors[i[s : s + PAIRS]].astype(kind), self.b.vectors[j[s : s + PAIRS]].astype(kind)
            out[s : s + PAIRS] = np.einsum("pd,pd->p", left, right)
        return out

    def surviving(self, part: slice, left: np.ndarray, low, high, keep) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs that their bounds never rule out, with exact scores, best first for each anchor.

        ``left`` marks the pairs to look at, ``low`` and ``high`` are their coarse bounds and
        ``keep(anchors, low, high)`` tells whether bounds let a pair stay.
        """
        anchors = np.arange(part.start, part.stop)
        left = left & keep(anchors[:, None], low, high)
        for level in range(1, len(LEVELS)):
            if left.mean() > DENSE:
                left &= keep(anchors[:, None], *self.bounds(part, level))
            else:
                i, j = np.nonzero(left)
                stay = keep(i + part.start, *self.refined(i + part.start, j, level))
                left[i, j] = stay
        i, j = np.nonzero(left)
        if left.mean() > DENSE and self.doubles:
            scores = (self.a.vectors[part] @ self.b.vectors.T)[i, j].astype(np.int64)
        else:
            scores = self.scored(i + part.start, j)
        order = np.lexsort((self.b.ids[j], ~self.b.known[j], -scores, i))
        return i[order] + part.start, j[order], scores[order]


def _parts(n: int):
    return (slice(s, min(s + AT_ONCE, n)) for s in range(0, n, AT_ONCE))


POSITIVE = "rid bigint, positive_id bigint, positive_score bigint"


def best_positives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """A cell's best rows of each anchor's label."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in POSITIVE.split(", ")])
    if not anchors.num_rows or not rows.num_rows:
        return schema.empty_table()
    cell = Cell(anchors, rows)
    a, b = cell.a, cell.b
    out = []
    for part in _parts(len(a.rids)):
        allowed = (a.labels[part, None] == b.labels[None, :]) & (a.rids[part, None] != b.rids[None, :])
        low, high = cell.bounds(part, 0)
        least = np.full(len(a.rids), -np.inf)
        if len(b.rids) > POSITIVES:
            # exact scores of the rows of the largest upper bounds: the fifth best is at least their least
            masked = np.where(allowed, high, -np.inf)
            first = np.argpartition(-masked, POSITIVES - 1, axis=1)[:, :POSITIVES]
            known = cell.scored(np.repeat(np.arange(part.start, part.stop), POSITIVES), first.ravel()).reshape(-1, POSITIVES).min(axis=1)
            full = np.take_along_axis(allowed, first, axis=1).all(axis=1)
            least[part] = np.where(full, known - np.abs(known) * 1e-12, -np.inf)
        i, j, scores = cell.surviving(part, allowed, low, high, lambda k, low, high: high >= least[k])
        place = np.arange(len(i)) - np.searchsorted(i, i)
        chosen = place < POSITIVES
        out.append((a.rids[i[chosen]], pa.array(b.ids[j[chosen]], mask=~b.known[j[chosen]]), scores[chosen]))
    return pa.concat_tables(pa.Table.from_arrays([pa.array(c) for c in columns], schema=schema) for columns in out)


NEGATIVE = "rid bigint, place int, negative_id bigint, negative_score bigint"


def best_negatives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """A cell's best rows of other labels within each of an anchor's ranges of scores (``low`` and ``high``)."""
    schema = pa.schema([("rid", pa.int64()), ("place", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])
    if not anchors.num_rows or not rows.num_rows:
        return schema.empty_table()
    cell = Cell(anchors, rows)
    a, b = cell.a, cell.b
    ranges = [list(zip(*r)) for r in zip(anchors.column("low").to_pylist(), anchors.column("high").to_pylist())]
    floor, roof = (np.array([f(r[end] for r in rs) for rs in ranges], float) for end, f in ((0, min), (1, max)))
    floor, roof = floor - np.abs(floor) * 1e-12, roof + np.abs(roof) * 1e-12
    out: list[tuple] = []
    for part in _parts(len(a.rids)):
        allowed = a.labels[part, None] != b.labels[None, :]
        low, high = cell.bounds(part, 0)
        i, j, scores = cell.surviving(part, allowed, low, high, lambda k, low, high: (high >= floor[k]) & (low <= roof[k]))
        edges = np.searchsorted(i, np.arange(part.start, part.stop + 1))
        for n, begin, end in zip(range(part.start, part.stop), edges, edges[1:]):
            if begin == end:
                continue
            falling = -scores[begin:end]
            for k, (least, most) in enumerate(ranges[n]):
                at = begin + int(np.searchsorted(falling, -most))
                for m in range(at, min(at + NEGATIVES, end)):
                    if scores[m] >= least:
                        out.append((int(a.rids[n]), k, int(b.ids[j[m]]) if b.known[j[m]] else None, int(scores[m])))
    return pa.Table.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(schema)], schema=schema)


def _grid(anchors: DataFrame, rows: DataFrame, find, schema: str) -> DataFrame:
    """``find`` in each cell of anchors and rows."""
    across, down = (max(1, -(-df.count() // size)) for df, size in ((anchors, ANCHORS), (rows, ROWS)))
    block = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("column", block(across)).withColumn("line", every(down))
    right = rows.withColumn("line", block(down)).withColumn("column", every(across))
    return left.groupBy("column", "line").cogroup(right.groupBy("column", "line")).applyInArrow(find, schema)


def _first(df: DataFrame, by: list[str], score: str, name: str, n: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.desc(score), F.asc_nulls_last(name))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(embeddings: DataFrame, every: int = 50) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``."""
    rows = prepared(embeddings)
    anchors = rows.filter(F.col("vec_id") % every == 0)
    found = _grid(anchors, rows, best_positives, POSITIVE)
    best = _first(found, ["rid"], "positive_score", "positive_id", POSITIVES)
    ranged = best.filter("positive_score >= 0").withColumns(  # below 0 the range is empty
        {
            "_low": F.expr(f"(cast(positive_score as decimal(25,0)) * {LEAST} + 99) div 100"),
            "_high": F.expr(f"(cast(positive_score as decimal(25,0)) * {MOST}) div 100"),
        }
    )
    one = F.struct("rank", "positive_id", "positive_score", "_low", "_high")
    lists = ranged.groupBy("rid").agg(F.sort_array(F.collect_list(one)).alias("positives"))  # at most POSITIVES
    wanted = cut(anchors.join(lists, "rid").withColumns({"low": F.col("positives._low"), "high": F.col("positives._high")}))
    negatives = _grid(wanted.drop("positives"), rows, best_negatives, NEGATIVE)
    chosen = _first(negatives, ["rid", "place"], "negative_score", "negative_id", NEGATIVES)
    positive = F.col("positives")[F.col("place")]
    return chosen.join(wanted.select("rid", F.col("vec_id").alias("anchor_id"), "positives"), "rid").select(
        "anchor_id",
        positive["positive_id"].alias("positive_id"),
        "rank",
        "negative_id",
        positive["positive_score"].alias("positive_score"),
        "negative_score",
    )


@query()
def op11_hard_negatives(spark, sf):
    return hard_negatives(table(spark, sf, "embeddings"))
