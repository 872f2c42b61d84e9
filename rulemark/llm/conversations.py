"""Repair of the structure of conversations by aligning turns with the alternating grammar.

A conversation is in order if its role initials read ``(s?(ua)+)?``. Rows are kept, given
another role, deleted or inserted at a cost; the cheapest sequence of edits (the audit) wins, of
equally cheap ones the least by ASCII. Blank and repeated rows must be deleted.

The turns are aligned with the grammar's string of every feasible length (Wagner-Fischer). The
cost of the best alignment so far, the incumbent, bounds the lengths to try and the band of cells
of each table (Ukkonen): a cell so far off the diagonal that its deletions or insertions alone
cost more is left out. Each table is traced back, and audits of equal cost are compared.

Rows are first numbered by ranges of (conversation, turn, role, digest of role and text), so that
a conversation of any length is spread over tasks. Within a range it is cut into blocks of
``BLOCK`` rows; a block is aligned with the grammar's strings between every two states of the
grammar, and one pass over a conversation's blocks joins them. Since no insertion ends a block,
block audits are never prefixes of each other, and choosing the least block by block gives the
least whole. Texts are shuffled once, sorted, and hashed as a stream beside the audit: a SHA-256
of one conversation can only be made by one task, but holds no text longer than a batch. Per
conversation the join of blocks holds some 30 bytes a row, the hash one byte a row.

Nulls are one space (a role of that kind cannot be kept). Rows of the same turn go by role, then by
digest. A row repeated in the table is a duplicate. The null conversation is one too. Roles
without a first letter cannot be kept. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemark.llm.common import query, same, small_batches, table

#: Rows of a block.
BLOCK = 64
#: Signatures whose alignments a worker remembers.
CACHE = 20_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
WHITE = " \t\n\x0b\f\r"
INFINITE = 1 << 60

#: States of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What completes a conversation that ends in a state: cost and audit.
CLOSING = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}
NEXT = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def targets(start: int, longest: int) -> Iterator[tuple[str, int]]:
    """The grammar's strings from a state, of at most this length, and the states they end in."""
    heads = ["", "s"] if start == START else [""]
    turns = "au" if start == USER else "ua"
    for head in heads:
        for n in range(longest - len(head) + 1):
            target = head + (turns * (n // 2 + 1))[:n]
            yield target, NEXT[target[-1]] if target else start


def aligned(rows: str, target: str, most: int, closed: bool) -> tuple[int, str] | None:
    """Cost and least audit of turning rows into the target, if the cost is at most ``most``.

    ``rows`` has an initial for each row that need not go, upper case if it is truncated. Without
    ``closed`` the audit does not end with an insertion.
    """
    n, m = len(rows), len(target)

    def apart(i: int, j: int) -> int:
        return (j - i) * INSERT if j > i else (i - j) * DELETE

    # cost[i][j - low[i]]: from row i and place j to the end, for the cells of the band only
    cost: list[list[int]] = [[]] * (n + 1)
    low = [0] * (n + 1)
    for i in range(n, -1, -1):
        band = [j for j in range(m + 1) if apart(i, j) + apart(n - i, m - j) <= most]
        if not band:
            return None
        low[i], high = band[0], band[-1]
        line = [INFINITE] * (high - low[i] + 1)
        below, at = (cost[i + 1], low[i + 1]) if i < n else ([], 0)
        for j in range(high, low[i] - 1, -1):
            if i == n:
                best = 0 if j == m else INFINITE if not closed or target[j] == "s" else line[j + 1 - low[i]] + INSERT
            else:
                row = rows[i]
                late = TRUNCATED if row.isupper() else 0
                best = below[j - at] + DELETE if 0 <= j - at < len(below) else INFINITE
                if j < m:
                    if 0 <= j + 1 - at < len(below):
                        if row.lower() == target[j]:
                            best = min(best, below[j + 1 - at] + KEEP + late)
                        elif target[j] != "s":
                            best = min(best, below[j + 1 - at] + REROLE + late)
                    if j < high and target[j] != "s":
                        best = min(best, line[j + 1 - low[i]] + INSERT)
            line[j - low[i]] = best
        cost[i] = line
    if low[0] or cost[0][0] > most:
        return None

    def rest(i: int, j: int) -> int:
        return cost[i][j - low[i]] if i <= n and 0 <= j - low[i] < len(cost[i]) else INFINITE

    i, j, audit = 0, 0, []
    while i < n or j < m:
        now = rest(i, j)
        late = TRUNCATED if i < n and rows[i].isupper() else 0
        if i < n and rest(i + 1, j) + DELETE == now:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and rest(i, j + 1) + INSERT == now:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if rows[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost[0][0], "".join(audit)


def plainly(rows: str, target: str, closed: bool) -> int:
    """The cost of matching rows to places in order, then deleting or inserting the rest."""
    total = 0
    for row, place in zip(rows, target):
        if row.lower() != place:
            total += INFINITE if place == "s" else REROLE
        total += TRUNCATED if row.isupper() else 0
    over = len(target) - len(rows)
    if over > 0:
        return total + over * INSERT if closed and "s" not in target[len(rows) :] else INFINITE
    return total - over * DELETE


@lru_cache(CACHE)
def alignments(signature: str, start: int, closed: bool) -> dict[int, tuple[int, str]]:
    """For each state of the grammar the block can end in, the least cost and its least audit.

    ``signature`` has a letter for each row: its initial (``x`` for other ones), upper case if it
    is truncated, or ``-`` if it must go. With ``closed`` only complete conversations count.
    """
    rows = signature.replace("-", "")
    best: dict[int, tuple[int, str]] = {}
    # At any length beyond, the insertions alone cost more than deleting every row and the
    # shortest completion would.
    longest = len(rows) + (len(rows) * DELETE + 2 * INSERT) // INSERT
    tried = [(t, end) for t, end in targets(start, longest) if not closed or end in (START, ASSISTANT)]
    incumbent: dict[int, int] = {}
    for target, end in tried:
        found = plainly(rows, target, closed)
        at = START if closed else end
        if found < incumbent.get(at, INFINITE):
            incumbent[at] = found
    for target, end in sorted(tried, key=lambda t: abs(len(t[0]) - len(rows))):
        at = START if closed else end
        least = (len(target) - len(rows)) * INSERT if len(target) > len(rows) else (len(rows) - len(target)) * DELETE
        most = incumbent.get(at, 3 * INFINITE)
        if least > most:
            continue
        found = aligned(rows, target, min(most, (len(rows) + len(target)) * DELETE), closed)
        if found and found[0] < INFINITE and (at not in best or found < best[at]):
            best[at] = found
            incumbent[at] = min(most, found[0])
    gone = signature.count("-") * DELETE
    return {end: (cost + gone, _with_deleted(signature, audit)) for end, (cost, audit) in best.items()}


def _with_deleted(signature: str, audit: str) -> str:
    """The audit of all rows; rows that must go come before insertions at their place, as D < I."""
    out, at = [], 0
    for letter in signature:
        if letter == "-":
            out.append("D")
            continue
        while audit[at] == "I":
            out.append("I")
            at += 1
        out.append(audit[at])
        at += 1
    return "".join(out) + audit[at:]


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as the contract damages them; ``times`` is 0 for dropped ones and 2 for repeated ones."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), case.alias("case"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("case") == 0, 0).when(F.col("case") == 3, 2).otherwise(1).alias("times"),
    )


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, for ``repaired``."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    return conversations.select("conv_id", "turn", text("role"), text("text"), F.lit(1).alias("times"))


def _digested(rows: DataFrame) -> DataFrame:
    role = F.col("role")
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.col("text")).cast("binary"), 256))
    return rows.withColumn("digest", digest)


def _keys(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one, with their number and fault; a conversation's dropped rows as one of number 0."""
    here = F.col("times") > 0
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    keys = (
        _digested(rows)
        .select(
            "conv_id",
            F.when(here, F.col("turn")).alias("turn"),
            F.when(here, F.col("role")).otherwise("").alias("role"),
            F.when(here, F.col("digest")).alias("digest"),
            F.when(~here, "").when(end == "", "B").when(F.substring(end, -1, 1).isin(*".!?"), "").otherwise("T").alias("fault"),
            "times",
        )
        .groupBy("conv_id", "turn", "role", "digest", "fault")
        .agg(F.sum("times").alias("n"))
    )
    # the first turn of a role and text; null comes first
    first = keys.groupBy("conv_id", "digest").agg(
        F.min("turn").alias("_turn"), F.max(F.col("turn").isNull()).alias("_null"), F.count("*").alias("_turns")
    )
    first = first.filter("_turns > 1").withColumnsRenamed({"conv_id": "_conv", "digest": "_digest"})
    joined = keys.join(first, same(F.col("conv_id"), F.col("_conv")) & same(F.col("digest"), F.col("_digest")), "left")
    later = F.col("turn").isNotNull() & (F.col("_null") | (F.col("turn") > F.col("_turn")))
    return joined.select("conv_id", "turn", "role", "digest", "fault", "n", F.coalesce(later, F.lit(False)).alias("later"))


ORDER = ["conv_id", "turn", "role", "digest"]
COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
BLOCKS = (
    "turn bigint, role string, digest binary, seq bigint, first string, last string, first_turn bigint, last_turn bigint, "
    + ", ".join(f"{c} bigint" for c in COUNTS)
    + ", rows bigint, alignments string"
)
LEGAL = {"su", "ua", "au"}


class _Block:
    """Rows of one conversation in order, and what is counted among them."""

    def __init__(self, conv, turn, role, digest, seq):
        self.at = (conv, turn, role, digest, seq)
        self.letters: list[str] = []
        self.first = self.last = None
        self.first_turn = self.last_turn = None
        self.counts = dict.fromkeys(COUNTS, 0)

    def add(self, turn, initial, fault):
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.counts["turns"] += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if fault:
            self.counts[fault] += 1
        letter = initial if initial in NEXT else "x"
        self.letters.append("-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter)

    def record(self, whole: bool) -> tuple:
        signature = "".join(self.letters)
        starts = [START] if whole else [START, SYSTEM, USER, ASSISTANT]
        table = [[p, q, *found] for p in starts for q, found in alignments(signature, p, whole).items()]
        edges = (self.first, self.last, self.first_turn, self.last_turn)
        return (*self.at, *edges, *self.counts.values(), len(self.letters), json.dumps(table))


def _blocks(batches):
    """Blocks of sorted keys. A conversation that lies within the task and in one block is aligned as a whole."""
    block, opening, out, schema = None, True, [], None
    for batch in batches:
        schema = schema or _schema(batch.schema.field("conv_id"), BLOCKS)
        for conv, turn, role, digest, fault, n, later in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if block is None or block.at[0] != conv:
                if block is not None:
                    # the task's first conversation may have begun in another task
                    out.append(block.record(not opening and block.at[-1] == 0))
                    opening = False
                block = _Block(conv, turn, role, digest, 0)
            names = {"B": "blank", "T": "truncated"}
            for k in range(n):
                if len(block.letters) == BLOCK:
                    out.append(block.record(False))
                    block = _Block(conv, turn, role, digest, block.at[-1] + 1)
                block.add(turn, role[:1], "blank" if fault == "B" else "duplicate" if later or k else names.get(fault))
                if len(out) >= 1000:
                    yield _batch(out, schema)
                    out = []
    if block is not None:
        out.append(block.record(False))
    if out:
        yield _batch(out, schema)


def _schema(conv: pa.Field, rest: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([pa.field("conv_id", conv.type)] + [pa.field(n, kinds[k]) for n, k in (c.split() for c in rest.split(", "))])


def _batch(records: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*records), schema)], schema=schema)


SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def joined_audit(tables: list[list]) -> tuple[int, str]:
    """The cheapest and then least way through the blocks' alignments ([from, to, cost, audit] each)."""
    rest = [{q: c[0] for q, c in CLOSING.items()}]
    for table in reversed(tables):
        before: dict[int, int] = {}
        for p, q, cost, _ in table:
            before[p] = min(before.get(p, INFINITE), cost + rest[-1].get(q, INFINITE))
        rest.append(before)
    rest.reverse()
    state, out = START, []
    for k, table in enumerate(tables):
        audit, state = min((a, q) for p, q, cost, a in table if p == state and cost + rest[k + 1].get(q, INFINITE) == rest[k][p])
        out.append(audit)
    return rest[0][START], "".join(out) + CLOSING[state][1]


class _Conversation:
    """Blocks of a conversation in order."""

    def __init__(self, conv):
        self.conv, self.tables, self.counts = conv, [], dict.fromkeys(COUNTS, 0)
        self.last = self.first_turn = self.last_turn = None

    def add(self, first, last, first_turn, last_turn, blank, duplicate, truncated, illegal, turns, rows, table):
        if not rows:
            return
        if self.last is not None and self.last + first not in LEGAL:
            illegal += 1
        if first_turn is not None and first_turn == self.last_turn:
            turns -= 1
        self.last = last
        self.first_turn = first_turn if self.first_turn is None else self.first_turn
        self.last_turn = last_turn if last_turn is not None else self.last_turn
        for name, value in zip(COUNTS, (blank, duplicate, truncated, illegal, turns)):
            self.counts[name] += value
        self.tables.append(table)

    def record(self) -> tuple:
        c = self.counts
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - c["turns"]
        tables = map(json.loads, self.tables)
        cost, audit = joined_audit(list(tables)) if self.tables else (0, "")
        return (self.conv, min(gaps, (1 << 63) - 1), c["blank"], c["duplicate"], c["truncated"], c["illegal"], cost, audit)


def _audited(batches):
    now, out, schema = None, [], None
    for batch in batches:
        schema = schema or _schema(batch.schema.field("conv_id"), SUMMARY)
        for conv, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.record())
                now = _Conversation(conv)
            now.add(*rest)
            if len(out) >= 1000:
                yield _batch(out, schema)
                out = []
    if now is not None:
        out.append(now.record())
    if out:
        yield _batch(out, schema)


class _Repair:
    """Applies an audit to rows as they come, and hashes the result."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.hash, self.empty = hashlib.sha256(), True

    def line(self, role: str, text: str) -> None:
        if not self.empty:
            self.hash.update(b"\n")
        self.empty = False
        self.hash.update(role.encode())
        self.hash.update(b":")
        self.hash.update(text.encode())
        self.state = NEXT[role[0]]

    def due(self) -> str:
        return "assistant" if self.state == USER else "user"

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.line(self.due(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.line(role if edit == "K" else self.due(), text)

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def _hashed(batches):
    """Each conversation's summary comes first, then its rows in order."""
    summary, repair, out, schema = None, None, [], None
    for batch in batches:
        schema = schema or _schema(batch.schema.field("conv_id"), SUMMARY + ", repaired_sha256 string")
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv, part, role, text, times, *numbers in zip(*columns):
            if part == 0:
                if summary:
                    out.append((*summary, repair.digest()))
                summary, repair = (conv, *numbers, text), _Repair(text)
            else:
                for _ in range(times):
                    repair.row(role, text)
        if len(out) >= 1000:
            yield _batch(out, schema)
            out = []
    if summary:
        out.append((*summary, repair.digest()))
    if out:
        yield _batch(out, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``, ``times``): what is
    wrong with it, the cost and audit of its repair, and the digest of the repaired conversation."""
    conv = f"conv_id {dict(rows.dtypes)['conv_id']}"
    keys = small_batches(_keys(rows)).select(*ORDER, "fault", "n", "later")
    blocks = keys.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(_blocks, f"{conv}, {BLOCKS}")
    ordered = blocks.repartition("conv_id").sortWithinPartitions(*ORDER, "seq")
    audits = ordered.drop("turn", "role", "digest", "seq").mapInArrow(_audited, f"{conv}, {SUMMARY}")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    heads = audits.select(
        "conv_id", F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.col("audit").alias("text"), F.lit(1).alias("times"), *numbers,
    )
    turns = _digested(rows.filter("times > 0")).select(
        "conv_id", F.lit(1).alias("part"), "turn", "role", "digest", "text", "times", *(F.lit(None).cast("bigint").alias(c) for c in numbers)
    )
    both = heads.union(turns).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "digest")
    wanted = ["conv_id", "part", "role", "text", "times", *numbers]
    return small_batches(both).select(*wanted).mapInArrow(_hashed, f"{conv}, {SUMMARY}, repaired_sha256 string")


@query()
def op12_conversation_repair(spark, sf):
    return repaired(damaged(table(spark, sf, "conversations")))
