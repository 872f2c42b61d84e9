"""Repair of conversations against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest

from rulemark.llm import conversations as C

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, seq string, part string, digest string"
WHITE = " \t\n\x0b\f\r"


def brute(letters):
    """Cost and least audit by Dijkstra's order over all edit sequences of the automaton."""
    # state after n rows: least (cost, audit) by plain relaxation, at most two insertions in a row
    best = {C.START: (0, "")}
    step = {(C.START, "s"): C.SYSTEM, **{(s, "u"): C.USER for s in (C.START, C.SYSTEM, C.ASSISTANT)}, (C.USER, "a"): C.ASSISTANT}

    def put(into, state, value):
        if state not in into or value < into[state]:
            into[state] = value

    def inserted(states):
        out = dict(states)
        for _ in range(6):
            for s, (cost, audit) in list(out.items()):
                for letter in "ua":
                    if (s, letter) in step:
                        put(out, step[s, letter], (cost + 2, audit + "I"))
        return out

    for letter in letters:
        after = {}
        for s, (cost, audit) in inserted(best).items():
            put(after, s, (cost + 3, audit + "D"))
            if letter == "-":
                continue
            late = letter.isupper()
            if (s, letter.lower()) in step:
                put(after, step[s, letter.lower()], (cost + late, audit + "K"))
            for other in "ua":
                if other != letter.lower() and (s, other) in step:
                    put(after, step[s, other], (cost + 2 + late, audit + "R"))
        best = after
    best = inserted(best)
    return min(best[s] for s in (C.START, C.ASSISTANT) if s in best)


def blocked(letters, size):
    """The audit by blocks of this size."""
    tables = []
    for i in range(0, len(letters), size):
        part = letters[i : i + size]
        tables.append([[p, q, *found] for p in range(4) for q, found in C.alignments(part, p, False).items()])
    return C.joined_audit(tables)


def test_every_short_conversation():
    for n in range(5):
        for letters in map("".join, itertools.product("suax-SUA", repeat=n)):
            wanted = brute(letters)
            assert C.alignments(letters, C.START, True)[C.START] == wanted, letters
            assert blocked(letters, 2) == wanted, letters


def test_long_conversations_by_blocks():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(5, 60)
        letters = "".join(rng.choice("uauauauasx-UA") if rng.random() < 0.5 else "ua"[i % 2] for i in range(n))
        wanted = brute(letters)
        assert C.alignments(letters, C.START, True)[C.START] == wanted, letters
        assert blocked(letters, rng.choice([1, 3, 7, 16])) == wanted, letters


def expected(rows):
    """What the contract asks for, conversation by conversation."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, turns in groups.items():
        after = []
        for turn, role, text in turns:
            case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if case == 1:
                text = ""
            if case == 2:
                text = text.translate({ord(c): None for c in ".!?"})
            if case == 4:
                role = "user"
            after += [(turn, role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
        digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))
        seen, letters, counts = set(), "", defaultdict(int)
        for _, role, text in after:
            end = text.rstrip(WHITE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(after))
        numbers = {t for t, _, _ in after if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = brute(letters)
        lines, left = [], list(after)
        for edit in audit:
            due = "assistant" if lines and lines[-1][0] == "u" else "user"
            if edit == "I":
                lines.append(f"{due}:")
                continue
            _, role, text = left.pop(0)
            if edit != "D":
                lines.append(f"{role if edit == 'K' else due}:{text}")
        assert not left
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha))
    return sorted(out, key=repr)


def made(df):
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_the_table(spark):
    read = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert made(C.op12_conversation_repair(spark, SF)) == expected([tuple(r) for r in read.collect()])


def test_nulls_ties_repeats_and_one_long_conversation(spark):
    rng = random.Random(7)
    text = lambda: rng.choice(["Yes.", "No!", "why", "", " \t\n", "One. Two?", "end  ", None, "so. \n"])
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "Ü", None])
    rows = [(c, t, role(), text()) for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(100, t, ("user", "assistant")[t % 2], f"Turn {t}" + rng.choice([".", "."," "])) for t in range(700)]
    rows += [(101, None, role(), text()) for _ in range(30)] + [(None, rng.randrange(9), role(), text()) for _ in range(40)]
    rows += [(102, 5, "user", "Same.")] * 200 + [(103, t, "user", "Same.") for t in range(150)]
    rows += [(104, 2, "user", "x." * 40_000), (105, None, None, None), (106, -5, "assistant", "A."), (106, 7, "user", "B.")]
    dropped = next(t for t in range(99) if zlib.crc32(f"107:{t}".encode()) % 20 == 0)
    rows += [(107, dropped, "user", "Gone.")]
    df = spark.createDataFrame([(*r, "7", "7", "7") for r in rows], SCHEMA).repartition(5)
    got = made(C.repaired(C.damaged(df)))
    assert got == expected(rows)
    gone = next(r for r in got if r[0] == 107)
    assert gone[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert made(C.repaired(C.damaged(empty))) == []


@pytest.mark.parametrize("roles, audit", [("ua", "KK"), ("sua", "KKK"), ("u", "KI"), ("au", "IKKI"), ("uua", "KIKK"), ("s", "D")])
def test_rows_that_are_not_damaged(spark, roles, audit):
    names = {"u": "user", "a": "assistant", "s": "system"}
    df = spark.createDataFrame([(1, i, names[r], f"Turn {i}.") for i, r in enumerate(roles)], "conv_id bigint, turn bigint, role string, text string")
    (row,) = C.repaired(C.undamaged(df)).collect()
    assert (row["cost"], row["audit"]) == brute(roles) and row["audit"] == audit
    assert row["blank"] == row["duplicate"] == row["truncated"] == 0
