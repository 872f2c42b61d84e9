"""Packing into sequences of 2048 tokens by the sum-of-squares rule.

Documents are tokenized in parallel. Each is cut into full pieces, which are sequences of
their own, and a rest. Rests are placed one by one: a task keeps the number of open
windows at each fill level, and puts a rest into the level (or a new window) for which
the sum of the squares of those numbers becomes least. This keeps the levels
even, so that a fitting window is nearly always at hand, and no rest is moved later.

Rests are dealt to tasks by a hash of the document, about ``RESTS_PER_TASK`` each, in
the order of their ids: a task that runs again gives the same windows. A task
holds lengths only, never tokens. Pieces of a task's last open windows are padded.

A null text is empty: its document is the end token alone. Other columns are not read.
Repeated rows are packed once each.
"""

from __future__ import annotations

import contextlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import cut, kept_by_worker, query, small_batches, table

LENGTH, END = 2048, 1
VOCABULARY = "word_bpe_49k.json"
#: Rests placed by one task; the sequences it leaves open are some dozens whatever the number.
RESTS_PER_TASK = 50_000
#: Parts of texts whose ids a worker remembers.
CACHE = 500_000


def _listed(kind: str) -> str:
    """The characters a simple text may hold of a kind, one by one: a class of them is searched faster."""
    return "".join(re.escape(c) for c in map(chr, range(0x180)) if re.fullmatch(kind, c))


#: Fixed value: how the vocabulary divides a simple text in lower case.
PARTS = re.compile(rf"[{_listed(r'[^\W\d_]')}]++|\d|'(?:s|t|re|ve|m|ll|d)|[{_listed(r'[^\w\s]|_')}]++")
#: Simple texts: letters up to here are composed and have one lower case whatever stands by
#: them. Left out are marks that only one of Python and the vocabulary takes for a blank, and
#: numbers that Python takes for letters.
SIMPLE = re.compile(r"[\x00-\x1B\x20-\xB1\xB4-\xB8\xBA\xBB\xBF-\u012F\u0131-\u017E]*+")

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PLACED = "piece bigint, sequence_id bigint, offset bigint"
#: Bits of a sequence id that tell the task.
TASK_BITS = 24


def encoder(vocabulary: str):
    """A function from a text to its ids, as little-endian bytes of four each.

    The vocabulary divides a text into parts before it looks at them, so the ids of a
    simple text are those of its parts. Others are encoded word by word: no
    part reaches across a blank.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    parts: dict[str, bytes] = {}

    def learn(new: list[str]) -> None:
        """Encode many parts as one text; each of them is one of its words."""
        encoded = tokenizer.encode(" ".join(new), add_special_tokens=False)
        ends = np.cumsum(np.bincount(encoded.word_ids, minlength=len(new))) * 4
        ids, start = np.array(encoded.ids, "<u4").tobytes(), 0
        for p, end in zip(new, ends.tolist()):
            parts[p] = ids[start:end]
            start = end

    def simple(text: str) -> bytes:
        found = PARTS.findall(text.lower())
        ids = list(map(parts.get, found))
        missing = []
        with contextlib.suppress(ValueError):
            while True:
                missing.append(ids.index(None, missing[-1] + 1 if missing else 0))
        if missing:
            if len(parts) > CACHE:
                parts.clear()
            learn(list({found[i]: None for i in missing}))
            for i in missing:
                ids[i] = parts[found[i]]
        return b"".join(ids)

    def encode(text: str) -> bytes:
        if any(s in text for s in special):
            return other(text)  # as the contract's call reads them, wherever they stand
        if SIMPLE.fullmatch(text):
            return simple(text)
        words = [simple(w) if SIMPLE.fullmatch(w) else other(w) for w in re.split("[ \\t-\\r]+", text)]
        return b"".join(words)

    def other(word: str) -> bytes:
        return np.array(tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    return encode


def cutter(vocabulary: str, length: int):
    def pieces(batches):
        encode = kept_by_worker(f"encoder of {vocabulary}", lambda: encoder(vocabulary))
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text or "") + end
                total = len(ids) // 4
                for start in range(0, total, length):
                    part = ids[4 * start : 4 * (start + length)]
                    out.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], names)

    return pieces


def sum_of_squares(lengths: list[int], length: int) -> tuple[list[int], list[int]]:
    """Window and offset of each length (1 to ``length``), placed in this order."""
    counts = np.zeros(length + 1, np.int64)  # open windows by level; those full or empty count nothing
    held: list[list[int]] = [[] for _ in range(length + 1)]
    windows, offsets, used = [], [], 0
    for size in lengths:
        # Change of the sum of squares: a window leaves a level (1 - 2n) and reaches one (1 + 2n).
        levels = length - size
        reach = 2 * counts[size : length + 1] + 1
        reach[-1] = 0  # a full window leaves the array
        cost = reach + 1 - 2 * counts[: levels + 1]
        cost[0] = reach[0]  # a new one leaves no level
        open_now = counts[: levels + 1] > 0
        open_now[0] = True
        cost = np.where(open_now, cost, np.iinfo(np.int64).max)
        best = levels - int(cost[::-1].argmin())  # of equals the fullest
        if best == 0:
            window, used = used, used + 1
        else:
            window = held[best].pop()
            counts[best] -= 1
        windows.append(window)
        offsets.append(best)
        if best + size < length:
            held[best + size].append(window)
            counts[best + size] += 1
    return windows, offsets


def placer(length: int):
    def place(key, rests):
        rests = rests.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        windows, offsets = sum_of_squares(rests["length"].to_pylist(), length)
        ids = [(w << TASK_BITS | key[0].as_py()) * 2 + 1 for w in windows]
        columns = [rests["piece"], pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())]
        return pa.table(columns, ["piece", "sequence_id", "offset"])

    return place


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Sequence ids are unique and not gapless: full pieces have even ones, packed windows odd ones.
    """
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    cut_up = rows.mapInArrow(cutter(vocabulary, length), PIECES)
    pieces = cut(cut_up.withColumn("piece", F.monotonically_increasing_id()))
    rests = pieces.filter(F.col("length") < length)
    tasks = max(1, round(rests.count() / RESTS_PER_TASK))
    task = F.expr(f"pmod(xxhash64(doc_id, piece), {tasks})")
    placed = rests.select("piece", "doc_id", "length", task.alias("task")).groupBy("task")
    placed = placed.applyInArrow(placer(length), PLACED).withColumnRenamed("piece", "_piece")
    packed = rests.join(placed, F.col("piece") == F.col("_piece"))
    full = pieces.filter(F.col("length") == length).withColumn("sequence_id", F.col("piece") * 2)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.select(columns).union(full.withColumn("offset", F.lit(0).cast("bigint")).select(columns))


@query()
def op9_packing(spark, sf):
    return pack(table(spark, sf, "documents"))
