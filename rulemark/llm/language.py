"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. The vector of
three characters in a row binds (multiplies) those of its letters, the first permuted
twice and the second once, so that order counts. A document bundles (adds) the vectors of
all its trigrams, a language those of all its documents; the language with the greatest
cosine wins. Texts are lower-cased, and all that is not a letter counts as one blank.

A document's bundle is linear in its trigram counts, so a task counts the trigrams of a
batch and multiplies once. Learning sums whole numbers, one vector per language and task,
so the prototypes don't depend on the order of tasks; only they reach the driver
(languages x ``SIZE`` numbers).

A null text and one without a letter are ``und`` with score 0. Ties go to the language
that sorts first. Without a row to learn from, all is ``und``. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import cut, kept_by_worker, query, small_batches, table, text_hash, without_rows

#: Length of the vectors, and the seed of the letters.
SIZE, SEED = 1024, 20240601
#: Least score of the pipeline, three standard deviations of the cosine of unrelated vectors, and the
#: least number of trigrams of a text that is rejected by its score.
CHANCE, ENOUGH = 3 / SIZE**0.5, 64
#: More letters than this in a batch are counted by sorting instead of by place.
DENSE_LETTERS = 96
#: Characters of a batch that are counted at once, and different trigrams whose vectors are held at once.
BLOCK_CHARS, PIECE_GRAMS = 1 << 20, 1 << 14
#: The unit of the sums: a language may have 2**63 / SIZE trigrams.
SCHEMA = "lang string, place int, total bigint"


def letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng((SEED, code)).integers(0, 2, SIZE, np.int8) * 2 - 1


def letters_table() -> np.ndarray:
    """For each code point, itself if it is a letter, else a blank."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = c
    return out


class Counter:
    """Trigram counts of texts, and the vectors of the trigrams."""

    def __init__(self):
        self.letters, self.vectors = kept_by_worker("letters", letters_table), kept_by_worker("letter_vectors", dict)

    def codes(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        codes = self.letters[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
        codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
        return codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]

    def vector(self, code: int) -> np.ndarray:
        if code not in self.vectors:
            if len(self.vectors) > 50_000:
                self.vectors.clear()
            self.vectors[code] = letter_vector(code)
        return self.vectors[code]

    def blocks(self, texts: list[str | None]):
        """Runs of whole texts, as (first, counts by text and trigram, trigram vectors).

        A run with more than ``PIECE_GRAMS`` different trigrams comes in pieces, each with some of
        them: its bundles are the sums over the pieces. This bounds the memory whatever the script.
        """
        at, size, held = 0, 0, []
        for i, text in enumerate(texts):
            held.append(self.codes(text))
            size += len(held[-1])
            if size >= BLOCK_CHARS or i == len(texts) - 1:
                for counts, vectors in self.pieces(held):
                    yield at, counts, vectors
                at, size, held = i + 1, 0, []

    def pieces(self, held: list[np.ndarray]):
        owner = np.repeat(np.arange(len(held)), [max(len(h) - 2, 0) for h in held])
        if not len(owner):
            yield np.zeros((len(held), 0)), np.zeros((0, SIZE), np.float32)
            return
        flat = np.concatenate(held)
        known = np.zeros(0x110000, bool)
        known[flat] = True
        alphabet = np.flatnonzero(known)
        number = np.zeros(0x110000, np.int64)
        number[alphabet] = np.arange(len(alphabet))
        n = len(alphabet)
        grams = []
        for h in held:
            x = number[h]
            grams.append((x[:-2] * n + x[1:-1]) * n + x[2:])
        grams = np.concatenate(grams)
        if n <= DENSE_LETTERS:
            seen = np.zeros(n**3, bool)
            seen[grams] = True
            distinct = np.flatnonzero(seen)
            place = np.zeros(n**3, np.int64)
            place[distinct] = np.arange(len(distinct))
            place = place[grams]
        else:
            distinct, place = np.unique(grams, return_inverse=True)
        if len(distinct) > PIECE_GRAMS:
            order = np.argsort(place, kind="stable")
            owner, place = owner[order], place[order]
        base = np.stack([self.vector(int(c)) for c in alphabet])
        first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
        for low in range(0, len(distinct), PIECE_GRAMS):
            some = distinct[low : low + PIECE_GRAMS]
            here = slice(None) if len(some) == len(distinct) else slice(*place.searchsorted([low, low + len(some)]))
            counts = np.bincount(owner[here] * len(some) + place[here] - low, minlength=len(held) * len(some))
            vectors = first[some // (n * n)] * second[some // n % n] * base[some % n]
            yield counts.reshape(len(held), -1), vectors.astype(np.float32)


def _learn(batches):
    counter, sums = Counter(), {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for at, counts, vectors in counter.blocks(batch.column("text").to_pylist()):
            here = np.array(langs[at : at + len(counts)], object)
            for lang in set(here):
                # Counts stay far below 2**24 x vectors of one block, exact in double precision.
                total = counts[here == lang].sum(axis=0, dtype=np.float64) @ vectors.astype(np.float64)
                sums[lang] = sums.get(lang, 0) + np.rint(total).astype(np.int64)
    for lang, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * SIZE), pa.array(range(SIZE), pa.int32()), pa.array(total)], ["lang", "place", "total"]
        )


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> dict[str, np.ndarray]:
    """A prototype for each language of the given rows (``text``, ``lang``), of length 1."""
    rows = small_batches(docs).filter("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    sums = rows.mapInArrow(_learn, SCHEMA).groupBy("lang", "place").agg(F.sum("total").alias("total"))
    found: dict[str, np.ndarray] = {}
    for r in sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "total"))).alias("v")).collect():
        vector = np.array([x["total"] for x in r["v"]], np.float64)
        if vector.any():
            found[r["lang"]] = vector / np.linalg.norm(vector)
    return dict(sorted(found.items()))


def predictor(prototypes: dict[str, np.ndarray]):
    names, matrix = list(prototypes), np.array(list(prototypes.values())).reshape(-1, SIZE).T

    def predict(batches):
        counter = Counter()
        for batch in batches:
            langs, scores = [], []
            bundles, grams = np.zeros((len(batch), SIZE), np.float32), np.zeros(len(batch), np.int64)
            for at, counts, vectors in counter.blocks(batch.column("text").to_pylist()):
                bundles[at : at + len(counts)] += counts.astype(np.float32) @ vectors
                grams[at : at + len(counts)] += counts.sum(axis=1).astype(np.int64)
            norms = np.linalg.norm(bundles, axis=1)
            cosines = (bundles @ matrix) / np.maximum(norms, 1e-9)[:, None]
            for some, row in zip(grams, cosines):
                best = int(row.argmax()) if some and names else -1
                langs.append(names[best] if best >= 0 else "und")
                scores.append(min(1.0, max(0.0, float(row[best]))) if best >= 0 else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(grams)],
                ["doc_id", "text_hash", "held_out", "lang_pred", "score", "grams"],
            )

    return predict


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``held_out``, ``lang_pred``, ``score``, ``grams`` (its trigrams).

    Learns from the rows that are not held out.
    """
    return _predicted(docs, learn(docs.filter(~held_out())))


def _predicted(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    rows = small_batches(docs).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("text_hash"), held_out().alias("held_out"), "text"
    )
    schema = "doc_id bigint, text_hash bigint, held_out boolean, lang_pred string, score double, grams bigint"
    return rows.mapInArrow(predictor(prototypes), schema)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that have a language, with all their columns.

    Without a letter there is none, nor where the score stays below ``CHANCE``, as it would with
    random letters. Texts of less than ``ENOUGH`` trigrams tell too little to be
    rejected by their score. Where no language can be learnt, those that have a letter are kept.
    """
    prototypes = learn(docs.filter(~held_out()))
    rejected = F.col("grams") == 0
    if prototypes:
        rejected |= (F.col("score") < CHANCE) & (F.col("grams") >= ENOUGH)
    return without_rows(docs, cut(_predicted(docs, prototypes).filter(rejected).select("doc_id", "text_hash")))


@query()
def op6_language_id(spark, sf):
    return identify(table(spark, sf, "documents")).drop("text_hash", "grams")
