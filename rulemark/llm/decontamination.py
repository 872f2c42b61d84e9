"""Benchmark passages in documents by latent semantic retrieval.

Words are runs of letters and digits in lower case. Document frequencies of the
benchmark's terms are counted over all documents, and in the same reading within each passage
(``FIT_WINDOW`` words). Passages of all items and documents make a TF-IDF matrix A, of which a distributed
randomised SVD finds the leading right singular vectors: tasks sum A'(AQ) over their
passages, the driver makes Q orthogonal, some times over. Then every document is
read once more: its windows are projected into that space, and those whose cosine to an item
reaches ``COSINE`` are candidates. The space has few dimensions, so a window far from an item
may hold it all the same. Hence windows with one of an item's rarest terms are candidates too,
of so many of them that what holds ``PARAPHRASED`` of the terms cannot lack all: whatever
would be verified word for word is a candidate. A candidate is verified by the longest common subsequence:
first of the terms alone, then of all words, with each run of words around the window
that is ``SPAN`` times as long as the item. It counts if one run covers ``PARAPHRASED`` of the
item's words and of its terms, and either ``COPIED`` of its words or ``ANSWERED`` of its
answer (its last sentence). A window that reaches the cosine may tell the item in other words:
there ``RETOLD`` of its words, of its terms and of the words before its answer are enough, if
the run holds the answer word for word. Only the space leads to these.

A window is three blocks of words, each half as long as a size; sizes go up from 16 by half.
Each item is sought with the least size that is not below its length, so it stands wholly in
a window of 2.25 times its length (of 24 words for the shortest). Items go in blocks of
``BLOCK_ITEMS``, a fixed bound of what a task holds; a larger benchmark takes more passes.
Candidates are not limited. Documents are not shuffled. A very long one is searched in parts
of ``PART_WORDS`` words that overlap by the longest window, so no item falls between two.

Items and documents without words match nothing. Repeated rows each give their rows.
Rows without an id are searched like others. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import cut, query, small_batches, table, text_hash, without_rows

#: Items of one pass.
BLOCK_ITEMS = 20_000
#: Words of a passage on which the space is fitted (at most 255), and tasks that multiply them.
FIT_WINDOW, FIT_TASKS = 64, 32
#: Dimensions of the space, further ones while it is sought, and rounds.
RANK, OVER, ROUNDS, SEED = 96, 16, 3, 7
#: Passages that are multiplied at once, as a dense matrix of the terms they hold.
DENSE = 48
#: Terms whose rows of a product are summed together.
TERM_ROWS = 1024
#: Terms on a greater share of documents tell nothing, but an item keeps its rarest terms.
COMMON, RAREST = 0.05, 10
#: Least cosine of a candidate.
COSINE = 0.5
#: Shares of an item, and of its answer, in common with the document.
COPIED, PARAPHRASED, RETOLD, ANSWERED = 0.8, 0.7, 0.5, 0.8
#: Length of a run that is compared, in lengths of the item, and how far apart runs start.
SPAN, STEP = 1.5, 0.25
#: Least words of an answer.
ANSWER_WORDS = 3
#: Words of a document whose vectors are held at once; parts overlap by the longest window.
PART_WORDS = 1 << 16
#: Words of short documents that are searched at once.
GROUP_WORDS = 1 << 13
#: The unit of vectors is 1 / UNIT. Cosines of all windows are in single precision, off by less than MARGIN; candidates' in double.
UNIT, MARGIN = 1 << 16, 1e-4

PLAIN = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
COUNTED = pa.schema([("term", pa.int64()), ("n", pa.int64()), *((n, pa.binary()) for n in ("terms", "counts", "held"))])
FOUND = "doc_id bigint, text_hash bigint, item_id bigint, cosine double, lcs double, answer double"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(PLAIN).split()


def answer_of(text: str) -> int:
    """Words of the last sentence of an item, at least ``ANSWER_WORDS`` if it has them."""
    n = 0
    for part in reversed(re.split(r"[.!?\n]+", text)):
        n += len(words_of(part))
        if n >= ANSWER_WORDS:
            break
    return n


def lcs_masks(words: list[bytes]) -> dict[bytes, int]:
    masks: dict[bytes, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def lcs(masks: dict[bytes, int], n: int, other: list[bytes]) -> int:
    """Length of the longest common subsequence, a bit for each of the ``n`` words behind ``masks``."""
    row = full = (1 << n) - 1
    for w in other:
        if m := masks.get(w):
            both = row & m
            row = ((row + both) | (row - both)) & full
    return n - row.bit_count()


def spelled(words: list[bytes]) -> bytes:
    """The words as one text in which whole runs of words can be looked for."""
    return b" %s " % b" ".join(words)


def rarest_needed(terms: list[bytes], weights: dict[bytes, tuple[int, float]]) -> set[int]:
    """Numbers of the rarest terms of an item: who shares ``PARAPHRASED`` of its terms has one of them."""
    ordered = sorted(terms, key=lambda w: (-weights[w][1], w))
    return {weights[w][0] for w in ordered[: len(terms) - math.ceil(PARAPHRASED * len(terms)) + 1]}


def _count_terms(vocabulary: dict[bytes, int]):
    """Of each batch the passages' terms, and at the end of a task the number of its texts with each term."""

    def count(batches):
        seen, total = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            texts = list(map(words_of, batch.column(0).to_pylist()))
            total += len(texts)
            numbers = np.fromiter(map(vocabulary.get, chain.from_iterable(texts), repeat(-1)), np.int64)
            lengths = np.array([len(words) for words in texts], np.int64)
            places = np.flatnonzero(numbers >= 0)
            owner = np.repeat(np.arange(len(texts)), lengths)[places]
            # passages are numbered through the batch; none reaches across texts
            own = -(-lengths // FIT_WINDOW)
            passage = (places - (np.cumsum(lengths) - lengths)[owner]) // FIT_WINDOW + (np.cumsum(own) - own)[owner]
            codes, counts = np.unique(passage * len(vocabulary) + numbers[places], return_counts=True)
            passage, terms = np.divmod(codes, max(1, len(vocabulary)))
            here = np.zeros((len(texts), len(vocabulary)), bool)
            here[np.repeat(np.arange(len(texts)), own)[passage], terms] = True
            seen += here.sum(axis=0)
            held = np.bincount(passage)
            parts = (terms.astype(np.int32), counts.astype(np.uint8), held[held > 0].astype(np.uint8))
            yield pa.RecordBatch.from_pylist([dict(zip(("terms", "counts", "held"), (x.tobytes() for x in parts)))], COUNTED)
        at = np.flatnonzero(seen)
        rows = pa.table({"term": np.append(at, -1), "n": np.append(seen[at], total)}).to_batches()[0]
        blank = pa.nulls(len(rows), pa.binary())
        yield pa.RecordBatch.from_arrays([*rows.columns, blank, blank, blank], schema=COUNTED)

    return count


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Of all documents: numbers of those with a ``term`` (-1: of all), and terms of their passages with counts, by batch."""
    types = "term bigint, n bigint, terms binary, counts binary, held binary"
    return small_batches(docs).select("text").mapInArrow(_count_terms(vocabulary), types)


def frequencies(counts: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """Number of documents with each term, and of all documents."""
    df, total = np.zeros(terms, np.int64), 0
    for r in counts.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r["term"] < 0:
            total = r["n"]
        else:
            df[r["term"]] = r["n"]
    return df, total


def _weighted(number: np.ndarray, weight: np.ndarray):
    def passages(batches):
        for batch in batches:
            for blobs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                terms, counts, held = (np.frombuffer(x, t) for x, t in zip(blobs, (np.int32, np.uint8, np.uint8)))
                passage = np.repeat(np.arange(len(held)), held)
                kept = np.flatnonzero(number[terms] >= 0)
                if not len(kept):
                    continue
                terms, passage = terms[kept], passage[kept]
                values = counts[kept] * weight[terms]
                values /= np.sqrt(np.bincount(passage, values * values))[passage]
                lengths = np.bincount(passage)
                ends = np.append(0, np.cumsum(lengths[lengths > 0])).astype(np.int32)
                lists = (pa.ListArray.from_arrays(ends, x) for x in (number[terms], values))
                yield pa.RecordBatch.from_arrays(list(lists), ["terms", "weights"])

    return passages


def weighted_passages(counts: DataFrame, vocabulary: dict[bytes, int], weights: dict[bytes, tuple[int, float]]) -> DataFrame:
    """The passages as rows of the TF-IDF matrix: ``terms`` that tell something, and their ``weights``."""
    number, weight = np.full(len(vocabulary), -1, np.int64), np.zeros(len(vocabulary))
    for w, (i, v) in weights.items():
        number[vocabulary[w]], weight[vocabulary[w]] = i, v
    held = counts.filter("terms IS NOT NULL").select("terms", "counts", "held")
    return held.mapInArrow(_weighted(number, weight), "terms array<bigint>, weights array<double>")


def _apply(q: np.ndarray):
    def apply(batches):
        total = np.zeros_like(q)
        for batch in batches:
            lengths = batch.column(0).value_lengths().to_numpy()
            terms, weights = (batch.column(i).flatten().to_numpy() for i in range(2))
            ends = np.append(0, np.cumsum(lengths))
            for at in range(0, len(lengths), DENSE):
                held = lengths[at : at + DENSE]
                here = slice(ends[at], ends[at + len(held)])
                those, column = np.unique(terms[here], return_inverse=True)
                matrix = np.zeros((len(held), len(those)))
                matrix[np.repeat(np.arange(len(held)), held), column] = weights[here]
                total[those] += matrix.T @ (matrix @ q[those])
        parts = [total[at : at + TERM_ROWS].tobytes() for at in range(0, len(total), TERM_ROWS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())], ["part", "total"])

    return apply


def _sum_part(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(t.as_buffer()) for t in table.column("total")], axis=0)
    return pa.table({"part": table.column("part")[:1], "total": pa.array([total.tobytes()], pa.binary())})


def singular_vectors(passages: DataFrame, terms: int, rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the passages' matrix (``terms``, ``weights``).

    The products of ``FIT_TASKS`` tasks at most are summed by Spark, ``TERM_ROWS`` terms at a time, so the
    driver gets one matrix of terms x (rank + OVER) a round, in rows of ``TERM_ROWS``.
    """
    width = min(terms, rank + OVER)
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((terms, width)))[0]
    dealt = cut(passages).coalesce(FIT_TASKS)
    for i in range(ROUNDS):
        parts = dealt.mapInArrow(_apply(q), "part bigint, total binary").groupBy("part")
        product = np.zeros_like(q)
        for r in parts.applyInArrow(_sum_part, "part bigint, total binary").collect():
            at = r["part"] * TERM_ROWS
            product[at : at + TERM_ROWS] = np.frombuffer(r["total"]).reshape(-1, width)
        if i < ROUNDS - 1:
            q = np.linalg.qr(product)[0]
    values, vectors = np.linalg.eigh(q.T @ product)
    return q @ vectors[:, np.argsort(-values)[:rank]]


class Items:
    """The benchmark's items in the space, by window size."""

    def __init__(self, items: list[tuple], weights: dict[bytes, tuple[int, float]], space: np.ndarray):
        self.numbers = {w: i for i, w in enumerate(weights)}
        self.vectors = np.rint(np.stack([space[t] * v for t, v in weights.values()]) * UNIT).astype(np.float32) / np.float32(UNIT)
        self.items = []
        by_size, rare = defaultdict(list), []
        for key, text in items:
            words = words_of(text)
            terms = [w for w in words if w in self.numbers]
            if not terms:
                continue
            vector = self.vectors[[self.numbers[w] for w in terms]].sum(axis=0)
            size = 16
            while size < len(words):
                size = size * 3 // 4 * 2
            by_size[size].append((len(self.items), vector / max(np.linalg.norm(vector), 1e-9)))
            rare.append(rarest_needed(terms, weights))
            asked = words[: len(words) - answer_of(text)]
            answer = words[len(asked) :]
            parts = [x for p in (terms, words, answer, asked) for x in (lcs_masks(p), len(p))]
            self.items.append((key, *parts, spelled(answer)))
        self.by_size = {}
        for size, members in by_size.items():
            shared = np.array([self.items[i][2] for i, _ in members])
            self.by_size[size] = ([i for i, _ in members], shared, np.array([x for _, x in members]).T.copy())
        self.sizes = list(self.by_size)
        self.size_of, self.column_of = np.zeros((2, len(self.items)), np.int64)
        for k, (members, _, _) in enumerate(self.by_size.values()):
            self.size_of[members], self.column_of[members] = k, np.arange(len(members))
        pairs = np.array(sorted((t, i) for i, terms in enumerate(rare) for t in terms), np.int64).reshape(-1, 2)
        self.starts, self.with_term = pairs[:, 0].searchsorted(np.arange(len(weights) + 1)), pairs[:, 1].copy()

    def by_rarest(self, terms: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By size, which of the terms are among the rarest of an item, and the items' columns."""
        first = self.starts[terms]
        counts = self.starts[terms + 1] - first
        ends = np.cumsum(counts)
        if not ends[-1]:
            return {}
        items = self.with_term[np.arange(ends[-1]) + np.repeat(first - ends + counts, counts)]
        at, sizes, out = np.repeat(np.arange(len(terms)), counts), self.size_of[items], {}
        for k, size in enumerate(self.sizes):
            here = sizes == k
            if here.any():
                out[size] = (at[here], self.column_of[items[here]])
        return out

    def search(self, words: list[bytes]) -> list[tuple]:
        """(item, cosine, lcs, answer) of the items found in a document."""
        return next(self.search_all([words]))

    def search_all(self, documents):
        """For each document (its words), (item, cosine, lcs, answer) of the items found, each with its best window.

        Short documents are searched ``GROUP_WORDS`` at once, which changes no row.
        """
        overlap = max(self.by_size, default=0) * 3 // 2
        waiting, parts, size = [], [], 0
        for words in documents:
            found: dict[int, tuple] = {}
            waiting.append(found)
            for at in range(0, len(words), PART_WORDS):
                parts.append((found, words[at : at + PART_WORDS + overlap]))
                size += len(parts[-1][1])
                if size >= GROUP_WORDS:
                    self.search_parts(parts)
                    parts, size = [], 0
            if not parts:
                yield from map(self.rows, waiting)
                waiting = []
        if parts:
            self.search_parts(parts)
        yield from map(self.rows, waiting)

    def rows(self, found: dict[int, tuple]) -> list[tuple]:
        return [(self.items[i][0], c, s, a) for i, (s, a, c) in found.items()]

    def search_parts(self, parts: list[tuple[dict, list[bytes]]]) -> None:
        words = [w for _, part in parts for w in part]
        lengths = np.array([len(part) for _, part in parts])
        offsets = np.cumsum(lengths) - lengths
        numbers = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        places = np.flatnonzero(numbers >= 0)
        if not len(places):
            return
        numbers = numbers[places]
        owner = offsets.searchsorted(places, "right") - 1
        local = places - offsets[owner]
        # of fixed point numbers, so that a window's sum does not depend on what stands before it
        sums = np.zeros((len(places) + 1, self.vectors.shape[1]))
        np.cumsum(self.vectors[numbers], axis=0, out=sums[1:])
        terms = [words[i] for i in places.tolist()]
        sought = self.by_rarest(numbers)
        for size, (members, shared, matrix) in self.by_size.items():
            half, least, fewest = size // 2, PARAPHRASED * shared, RETOLD * shared
            # Each part has blocks of its own, and two empty ones before it; a window is named by its first block.
            own = -(-lengths // half) + 2
            base = np.cumsum(own) - own + 2
            block = local // half + base[owner]
            before = np.zeros(base[-1] + own[-1] + 2, np.int64)
            np.cumsum(np.bincount(block, minlength=len(before) - 1), out=before[1:])
            count = before[3:] - before[:-3]
            # A window with fewer terms than an item must share is no candidate.
            first = np.flatnonzero(count >= max(1, fewest.min()))
            if not len(first):
                continue
            left, count = before[first], count[first]
            right = left + count
            rare = np.zeros(0, np.int64)
            if size in sought:
                # All windows that hold the term of an item start in one of three blocks.
                at, item_columns = sought[size]
                starts = np.concatenate((block[at], block[at] - 1, block[at] - 2))
                item_columns = np.concatenate((item_columns,) * 3)
                window = np.minimum(first.searchsorted(starts), len(first) - 1)
                fits = (first[window] == starts) & (count[window] >= least[item_columns])
                rare = np.unique(window[fits] * len(members) + item_columns[fits])
            for at in range(0, len(first), 4096):
                here = slice(at, at + 4096)
                windows = (sums[right[here]] - sums[left[here]]).astype(np.float32)
                norms = np.maximum(np.sqrt(np.einsum("ij,ij->i", windows, windows)), 1e-9)
                window, column = np.nonzero(windows @ matrix >= (COSINE - MARGIN) * norms[:, None])
                fits = count[here][window] >= fewest[column]
                low, high = rare.searchsorted((at * len(members), (at + 4096) * len(members)))
                close = {*((window[fits] + at) * len(members) + column[fits]).tolist(), *rare[low:high].tolist()}
                for n, i in (divmod(c, len(members)) for c in sorted(close)):
                    total = sums[right[n]] - sums[left[n]]
                    cosine = float((total * matrix[:, i]).sum() / max(np.sqrt((total * total).sum()), 1e-9))
                    part = owner[left[n]]
                    found, begin = parts[part][0], int(first[n] - base[part]) * half
                    span = words[offsets[part] + max(0, begin) : offsets[part] + min(lengths[part], begin + 3 * half)]
                    if hit := self.verified(members[i], terms[left[n] : right[n]], span, cosine >= COSINE):
                        hit = (*hit, cosine)
                        found[members[i]] = max(found.get(members[i], hit), hit)

    def verified(self, item: int, held: list[bytes], span: list[bytes], near: bool) -> tuple[float, float] | None:
        """Shares of the item and of its answer in the best run of the span, if it counts.

        ``held`` are the terms in the span, ``near`` tells that it reaches the cosine.
        """
        _, terms, t, masks, n, answer, m, asked, k, told = self.items[item]
        # told in other words, the answer must be there all the same
        retold = near and told in spelled(span)
        least = (RETOLD if retold else PARAPHRASED) * t
        if len(held) < least or lcs(terms, t, held) < least:
            return None
        length, step = int(SPAN * n) + 1, max(1, int(STEP * n))
        best = None
        for at in range(0, max(1, len(span) - length + step), step):
            run = span[at : at + length]
            share = lcs(masks, n, run) / n
            if share * t >= least and (in_run := lcs(terms, t, run)) >= least:
                answered = lcs(answer, m, run) / m
                literal = min(share, in_run / t) >= PARAPHRASED and (share >= COPIED or answered >= ANSWERED)
                if literal or retold and answered == 1 and told in spelled(run) and lcs(asked, k, run) >= RETOLD * k:
                    best = max(best or (0.0, 0.0), (share, answered))
        return best


def _search(make):
    def search(batches):
        items = make()
        for batch in batches:
            out: list[tuple] = []
            docs, keys, texts = (batch.column(i).to_pylist() for i in range(3))
            for doc, key, hits in zip(docs, keys, items.search_all(map(words_of, texts))):
                out += ((doc, key, *hit) for hit in hits)
            columns = list(zip(*out)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds)], [c.split()[0] for c in FOUND.split(", ")]
            )

    return search


def weighted_terms(items: list[tuple], vocabulary: dict[bytes, int], df: np.ndarray, total: int) -> dict[bytes, tuple[int, float]]:
    """Number and inverse document frequency of the terms that tell something."""
    kept: set[bytes] = set()
    for _, text in items:
        terms = sorted(set(words_of(text)), key=lambda w: (df[vocabulary[w]], w))
        kept.update(terms[:RAREST], (w for w in terms if df[vocabulary[w]] <= COMMON * total))
    ordered = sorted(kept)
    return {w: (i, float(np.log((2 + total) / (1 + df[vocabulary[w]])))) for i, w in enumerate(ordered)}


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item it holds: ``doc_id``, ``text_hash``, ``item_id``, ``cosine``, ``lcs``, ``answer``."""
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("text_hash"), "text")
    result = docs.sparkSession.createDataFrame([], FOUND)
    for items in blocks(benchmark):
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, t in items for w in words_of(t)}))}
        if not vocabulary:
            continue
        counts = cut(counted(docs, vocabulary))
        df, total = frequencies(counts, len(vocabulary))
        weights = weighted_terms(items, vocabulary, df, total)
        known = docs.sparkSession.createDataFrame([(t,) for _, t in items], "text string")
        passages = weighted_passages(counts.union(counted(known, vocabulary)), vocabulary, weights)
        space = singular_vectors(passages, len(weights)).astype(np.float32)
        found = rows.mapInArrow(_search(lambda i=items, w=weights, s=space: Items(i, w, s)), FOUND)
        result = result.union(found)
    return result


def blocks(benchmark: DataFrame):
    """The benchmark's items (id, text) in blocks that fit a task; each item once."""
    known = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    count = max(1, -(-known.count() // BLOCK_ITEMS))
    known = cut(known) if count > 1 else known
    for i in range(count):
        here = known.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(count)) == i)
        yield sorted(((r["item_id"], r["text"]) for r in here.collect()), key=lambda r: (r[0] is None, r[0], r[1]))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    return without_rows(docs, cut(find_passages(docs, benchmark).select("doc_id", "text_hash").distinct()))


@query()
def op8_decontamination(spark, sf):
    found = find_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "lcs", "answer", F.lit(True).alias("contaminated"))
