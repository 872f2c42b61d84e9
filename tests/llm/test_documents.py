"""Operators over documents against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from corpus_helpers import frame, prose
from rulemark.llm import decontamination, exact_dedup, language, licenses, packing, pii, sharding, simhash

SF = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict() for r in df.collect()]


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# exact duplicates


def test_exact_dedup(docs, texts):
    groups = defaultdict(list)
    for i, t, _ in texts:
        groups[hashlib.sha256(plain(t).encode()).hexdigest()].append(i)
    found = rows(exact_dedup.exact_dedup(docs))
    assert sorted(repr(r["doc_id"]) for r in found) == sorted(repr(i) for i, _, _ in texts)
    for r in found:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == min((i for i in ids if i is not None), default=None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in found) == len(groups)


def test_exact_dedup_does_not_depend_on_the_history(docs):
    from pyspark.sql import functions as F

    first = sorted(map(repr, rows(exact_dedup.exact_dedup(docs))))
    for part in (F.lit(True), F.lit(False), F.col("doc_id") % 3 == 0):
        assert sorted(map(repr, rows(exact_dedup.exact_dedup(docs, part)))) == first


def test_perfect_hash_is_minimal():
    for n in (1, 2, 63, 5000):
        keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
        levels, slots = exact_dedup.perfect_hash(keys)
        assert sorted(slots) == list(range(n))
        assert (exact_dedup.look_up(levels, keys) == slots).all()


def test_kept_rows(docs, texts):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({plain(t) for _, t, _ in texts})


# fingerprints


def brute_fingerprint(text, size=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashed = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashed) * 2 > len(hashed))


def brute_components(fps):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    names = list(parent)
    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    return {f: root(f) for f in names}


def check_groups(found, texts, fps):
    assert Counter(repr(r["doc_id"]) for r in found) == Counter(repr(i) for i, _, _ in texts)
    roots = brute_components(set(fps.values()))
    least = defaultdict(list)
    for i, t, _ in texts:
        if i is not None:
            least[roots[fps[t]]].append(i)
    expected = Counter((i, f"{fps[t]:016x}", min(least[roots[fps[t]]], default=None)) for i, t, _ in texts)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == expected


@pytest.mark.parametrize("limit", [32, 1])
def test_simhash(docs, texts, monkeypatch, limit):
    monkeypatch.setattr(simhash, "PAIR_LIMIT", limit)
    check_groups(rows(simhash.simhash_groups(docs)), texts, {t: brute_fingerprint(t) for _, t, _ in texts})


def test_simhash_on_the_table(spark):
    texts = [(r["doc_id"], r["text"], None) for r in table(spark, "documents").select("doc_id", "text").collect()]
    check_groups(rows(simhash.simhash_groups(table(spark, "documents"))), texts, {t: brute_fingerprint(t) for _, t, _ in texts})


def test_golay_keys_meet():
    rng = random.Random(1)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        at, keys = simhash.keys(np.array([a, b], np.uint64).view(np.int64))
        assert set(keys[at == 0]) & set(keys[at == 1])
    patterns = (simhash.ERRORS >= 0).sum(axis=1)
    assert set(patterns.tolist()) == {1, 6} and patterns.sum() == 1 + 23 + 253 + 1771 + 8855


def test_links_of_a_dense_cloud(spark):
    """Both ways to link have the components of all pairs."""
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps)[:8]:
        for _ in range(60):
            f ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            fps.add(f)
    signed = [(simhash._signed(f),) for f in fps]
    roots = brute_components(fps)
    from rulemark.llm.components import components

    for limit in (2, 1000):
        simhash.PAIR_LIMIT, before = limit, simhash.PAIR_LIMIT
        found = components(simhash.links(spark.createDataFrame(signed, "fp bigint")))
        simhash.PAIR_LIMIT = before
        of = {r["node"] % (1 << 64): r["component"] for r in found.collect()}
        groups = defaultdict(set)
        for f in fps:
            groups[of.get(f, f)].add(f)
        expected = defaultdict(set)
        for f in fps:
            expected[roots[f]].add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_representatives(docs, texts):
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert 300 in ids and not {201, 202, 401} & set(ids) and 400 in ids


# shards


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_sharding(docs, texts, shards):
    found = rows(sharding.shard_by_bytes(docs, shards))
    sizes = Counter((repr(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in texts)
    assert Counter((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == sizes
    by = defaultdict(list)
    for r in found:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(shards))
    for members in by.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    total, largest = sum(r["size"] for r in found), max(r["size"] for r in found)
    for members in by.values():
        assert sum(r["size"] for r in members) <= total / shards * (1 + 2 * sharding.TOLERANCE) + largest


def test_shards_are_balanced(spark):
    rng = random.Random(2)
    hot = prose(rng, 50)
    many = [(i, hot if i % 3 == 0 else prose(rng, rng.randint(1, 60)), None) for i in range(3000)]
    sizes = Counter()
    for r in rows(sharding.shard_by_bytes(frame(spark, many), 16)):
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) < 0.1 * mean


def test_repeated_rows_are_divided(spark, monkeypatch):
    """A third of the table is one row again and again."""
    rng = random.Random(8)
    same = prose(rng, 3)
    many = [(i, prose(rng, rng.randint(1, 6)), None) for i in range(600)] + [(7, same, None)] * 200 + [(None, None, None)] * 100
    monkeypatch.setattr(sharding, "ROWS_PER_TASK", 5)
    sizes, slots = Counter(), defaultdict(list)
    for r in rows(sharding.shard_by_bytes(frame(spark, many), 16)):
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) < 0.15 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# licenses


def license_words(text):
    low = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def test_license_base(spark, docs, texts):
    more = [
        (500, "Under the MIT-License! under, the mit license", None), (501, "under the the mit license apache license version 2", None),
        (502, "CC-BY-NC cc by nc nc", None), (503, "under the mıt license", None), (504, "cc by", None),
    ]
    all_texts = texts + more
    found = rows(licenses.license_scan(frame(spark, all_texts)))
    expected = Counter()
    for i, t, _ in all_texts:
        w = license_words(t)
        places = [(p, label) for phrase, label in licenses.PHRASES for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        starts = [p for p, _ in places]
        labels = ",".join(sorted({x for _, x in places}))
        expected[(i, len(w), len(places), min(starts, default=None), max(starts, default=None), labels)] += 1
    names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert Counter(tuple(r[n] for n in names) for r in found) == expected
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in found)


def test_license_method(spark):
    full = licenses.TEXTS[0][0].split()
    changed = full[:8] + ["extra", "words"] + full[8:]
    half = full[: len(full) // 2]
    data = [(1, "x y " + " ".join(full), None), (2, " ".join(changed).upper(), None), (3, " ".join(half), None), (4, None, None)]
    found = {r["doc_id"]: r for r in rows(licenses.license_scan(frame(spark, data)))}
    assert found[1]["labels"] == found[2]["labels"] == "mit" and found[1]["score"] == 1 and found[1]["n_base"] == 0
    assert found[3]["labels"] == found[4]["labels"] == "" and found[4]["n_words"] == 0


# language


def test_language(spark, docs, texts):
    found = rows(language.identify(docs))
    assert len(found) == len(texts)
    for r in found:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    by = {r["doc_id"]: r for r in found}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (400, 401, 402, 403, 404))
    assert all(by[100 + i]["lang_pred"] == "de" for i in range(12))


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in rows(language.identify(docs)) if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held) > 100


def test_language_vectors_are_those_of_the_definition():
    counter = language.Counter()
    _, counts, vectors = next(counter.blocks(["Abc, ab!"]))
    expected = np.zeros(language.SIZE)
    text = " abc ab "
    for a, b, c in zip(text, text[1:], text[2:]):
        expected += np.roll(language.letter_vector(ord(a)), 2) * np.roll(language.letter_vector(ord(b)), 1) * language.letter_vector(ord(c)).astype(int)
    assert np.array_equal(counts[0] @ vectors, expected)


def test_language_in_pieces(monkeypatch):
    """Texts of many different trigrams are counted in pieces that add up to the same."""
    import pyarrow as pa

    rng = random.Random(11)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n)) for n in (1, 50, 3000)] + ["plain words", "", None, "1"]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": list(range(7)), "text_hash": [0] * 7, "held_out": [False] * 7, "text": texts, "lang": ["zh"] * 3 + ["en"] * 4}
    )

    def outcome(size):
        monkeypatch.setattr(language, "PIECE_GRAMS", size)
        held = [len(vectors) for _, _, vectors in language.Counter().blocks(texts)]
        assert max(held) <= size and (size > 1000 or len(held) > 1)
        sums = {b["lang"][0].as_py(): np.array(b["total"]) for b in language._learn([batch])}
        prototypes = {k: v / np.linalg.norm(v) for k, v in sorted(sums.items())}
        return sums, next(language.predictor(prototypes)([batch])).to_pydict()

    whole, pieces = outcome(1 << 14), outcome(100)
    assert all(np.array_equal(whole[0][k], pieces[0][k]) for k in ("zh", "en"))
    assert whole[1]["lang_pred"] == pieces[1]["lang_pred"] == ["zh"] * 3 + ["en"] + ["und"] * 3
    assert np.allclose(whole[1]["score"], pieces[1]["score"])


def test_language_keeps_what_has_letters(docs, texts):
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    expected = Counter(repr(i) for i, t, _ in texts if t and re.search(r"[^\W\d_]", t))
    assert Counter(repr(r["doc_id"]) for r in kept.select("doc_id").collect()) == expected


def test_language_drops_what_is_no_more_like_a_language_than_chance(spark):
    rng = random.Random(23)
    noise = lambda n: "".join(rng.choice("bcdfghjklmnpqrstvwxz     0123456789#") for _ in range(n))
    clean = [(i, prose(rng, 80), "en") for i in range(60)] + [(60 + i, "Ärger über süße Öfen und Straßen " + prose(rng, 3), "de") for i in range(20)]
    junk = [(100 + i, noise(1500), None) for i in range(20)]
    short = [(200 + i, noise(20) + "q", None) for i in range(20)]
    kept = {r["doc_id"] for r in language.keep_identified(frame(spark, clean + junk + short)).select("doc_id").collect()}
    assert kept >= {i for i, _, _ in clean + short}
    assert len(kept & {i for i, _, _ in junk}) <= 1


def test_language_keeps_letters_where_nothing_is_learnt(spark):
    """Without a labelled row the stage cannot judge languages, so clean documents stay."""
    data = [(1, "clean words of a document", None), (2, "12 34 !!", None), (3, None, None), (4, "Ärger", None)]
    kept = language.keep_identified(frame(spark, data))
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {1, 4}
    assert {r["lang_pred"] for r in rows(language.identify(frame(spark, data)))} == {"und"}


# packing


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check_packing(found, texts):
    encode = tokenizer()
    ids = Counter()
    for i, t, _ in texts:
        all_ids = encode.encode(t or "", add_special_tokens=False).ids + [1]
        ids[(i, len(all_ids), zlib.crc32(np.array(all_ids[:2048], "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["doc_tokens"], r["ids_crc32"]) for r in found if not r["start"]) == ids
    assert sum(r["length"] for r in found) == sum(n * c for (_, n, _), c in ids.items())
    by = defaultdict(list)
    for r in found:
        by[r["sequence_id"]].append(r)
        assert 0 < r["length"] <= 2048
    for members in by.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    return by


def test_special_strings_are_read_as_by_the_plain_call():
    plain, encode = tokenizer(), packing.encoder(packing.VOCABULARY)
    for text in ("a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|>", "中 <|startoftext|> it's <|endoftext|>", "<|ENDOFTEXT|> <|", "a <|endoftext |> b"):
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert np.frombuffer(encode("a <|endoftext|> b"), "<u4").tolist() == [320, 49407, 321]


def test_parts_of_simple_texts_are_those_of_the_general_pattern():
    """Every character of simple texts beside every kind of neighbour; listed classes take under two thirds of the time."""
    general = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
    simple = [c for c in map(chr, range(0x250)) if packing.SIMPLE.fullmatch(c)]
    assert len(simple) > 350
    for c in simple:
        for before in ("", "a", "ß", "7", "'", ",", "_", " ", "don'"):
            text = f"{before}{c}s'll {c}{c}'{c}.{c}9{c}".lower()
            assert packing.PARTS.findall(text) == general.findall(text), text
    text = prose(random.Random(6), 200_000)

    def seconds(pattern):
        before = time.process_time()
        pattern.findall(text)
        return time.process_time() - before

    assert min(seconds(packing.PARTS) for _ in range(5)) < min(seconds(general) for _ in range(5)) * 2 / 3


def test_packing(docs, texts):
    found = rows(packing.pack(docs))
    check_packing(found, texts)
    whole = [r for r in found if r["doc_id"] == 408]
    ids = tokenizer().encode(next(t for i, t, _ in texts if i == 408), add_special_tokens=False).ids + [1]
    for r in whole:
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())


def test_packing_wastes_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [(r["doc_id"], r["text"], None) for r in docs.select("doc_id", "text").collect()]
    by = check_packing(rows(packing.pack(docs)), texts)
    tokens = sum(r["length"] for m in by.values() for r in m)
    assert len(by) * 2048 < 1.06 * tokens


def test_sum_of_squares_rule():
    rng = random.Random(4)
    sizes = [rng.randint(1, 15) for _ in range(400)]
    windows, offsets = packing.sum_of_squares(sizes, 16)
    counts, level = Counter(), {}
    for size, w, o in zip(sizes, windows, offsets):
        def squares(at):
            after = counts.copy()
            if at:
                after[at] -= 1
            if at + size < 16:
                after[at + size] += 1
            return sum(c * c for c in after.values())

        choices = [0] + [at for at in range(1, 17 - size) if counts[at] > 0]
        assert squares(o) == min(map(squares, choices))
        assert level.get(w, 0) == o
        if o:
            counts[o] -= 1
        level[w] = o + size
        if o + size < 16:
            counts[o + size] += 1


# personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    luhn = lambda d: sum(int(x) if i % 2 == 0 else sum(map(int, str(2 * int(x)))) for i, x in enumerate(d[::-1])) % 10 == 0
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(6)
    pieces = ["a", "b.c", "@", ".", "x@y.z", "1", "22", "255", "256", "007", "+1", " ", "-", "(", ")", "é", "%", "1.2.3.4", "4111111111111111", "4111 1111 1111 1111", "+1 (771) 555-1655"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert pii.spans(text) == brute_spans(text), text
    long = "a" * 200_000 + " " + "1" * 200_000 + "@" * 1000 + "1." * 50_000
    assert pii.spans(long) is not None


def test_pii_learns_what_gives_away(spark):
    rng = random.Random(7)
    data = [(i, prose(rng, 60), None) for i in range(300)]
    data += [(1000 + i, f"{prose(rng, 20)} Zanzibar {prose(rng, 2)} mail ann@example.org {prose(rng, 3)} {prose(rng, 20)}", None) for i in range(6)]
    data += [(2000 + i, "copied Lonely words bob@example.org here", None) for i in range(20)]
    data += [(3000, None, None), (3001, "", None), (None, "ann@example.org Zanzibar", None)]
    found = {r["doc_id"]: r for r in rows(pii.find_private(frame(spark, data)))}
    assert len(found) == len(data)
    for i, t, _ in data:
        base = pii.joined(brute_spans(t or ""))
        assert found[i]["base"] == base and found[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    texts = {i: t for i, t, _ in data}
    for i in range(1000, 1006):
        assert "Zanzibar" in {texts[i][t["start"] : t["end"]] for t in found[i]["terms"]}
    assert not any(found[2000 + i]["terms"] for i in range(20))  # copies are one context
    clean = {r["doc_id"]: r["text"] for r in rows(pii.sanitise(frame(spark, data)))}
    assert "Zanzibar" not in clean[1001] and "[EMAIL]" in clean[1001] and clean[3000] is None and clean[0] == texts[0]


def test_pii_copies_dilute_nothing(spark, monkeypatch):
    """A name found only by one address is taken out, also if one of its documents has many copies."""
    rng = random.Random(8)
    data = [(i, prose(rng, 60), None) for i in range(300)]
    named = [f"{prose(rng, 20)} Zanzibar {prose(rng, 2)} mail ann@example.org {prose(rng, 3)} {prose(rng, 20)}" for _ in range(4)]
    data += [(1000 + i, t, None) for i, t in enumerate(named)] + [(2000 + i, named[0], None) for i in range(200)]
    for limit in (500_000, 0):
        monkeypatch.setattr(pii, "BROADCAST_HASHES", limit, raising=False)
        found = {r["doc_id"]: r for r in rows(pii.find_private(frame(spark, data).repartition(5)))}
        for i, t, _ in data[300:]:
            assert "Zanzibar" in {t[x["start"] : x["end"]] for x in found[i]["terms"] or ()}


def test_pii_on_edges(docs, texts):
    from rulemark.llm.common import QUERIES  # noqa: F401

    found = rows(pii.find_private(docs))
    assert Counter(repr(r["doc_id"]) for r in found) == Counter(repr(i) for i, _, _ in texts)


# decontamination


def items(spark, values):
    return spark.createDataFrame(values, "item_id bigint, text string")


def test_lcs():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.choice(b"abcd") for _ in range(rng.randint(1, 20))] for _ in range(2))
        grid = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                grid[i + 1, j + 1] = grid[i, j] + 1 if x == y else max(grid[i, j + 1], grid[i + 1, j])
        assert decontamination.lcs(decontamination.lcs_masks(a), len(a), b) == grid[-1, -1]


def test_decontamination_recall(spark):
    """Exact and paraphrased passages are found, clean documents are left alone."""
    rng = random.Random(9)
    vocabulary = [f"{a}{b}{c}" for a in "bdgkl" for b in ("an", "or", "ish", "ul") for c in ("a", "eto", "im", "us", "")]
    text = lambda n: " ".join(rng.choice(vocabulary + WORDS_OFTEN) for _ in range(n))
    bench = [(i, f"{text(rng.randint(12, 40))}. {text(5)}.") for i in range(30)]
    data, truth = [], set()
    for d in range(200):
        body = text(rng.randint(50, 700)).split()
        if d % 4 == 0:
            i = rng.randrange(30)
            passage = bench[i][1].split()
            if d % 8 == 0:  # a paraphrase: some words changed, the answer kept
                for _ in range(len(passage) // 6):
                    passage[rng.randrange(len(passage) - 5)] = "changed"
            at = rng.randrange(len(body))
            body[at:at] = passage
            truth.add((d, i))
        data.append((d, " ".join(body).upper() if d % 3 == 0 else " ".join(body), None))
    bench += [(90, None), (91, ""), (92, "..."), (0, bench[0][1])]
    found = {(r["doc_id"], r["item_id"]) for r in rows(decontamination.find_passages(frame(spark, data), items(spark, bench)))}
    assert len(found & truth) >= 0.95 * len(truth)
    assert not {d for d, _ in found} - {d for d, _ in truth}
    kept = decontamination.keep_clean(frame(spark, data), items(spark, bench))
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _, _ in data} - {d for d, _ in found}


WORDS_OFTEN = ["the", "of", "and", "in"] * 30


def test_decontamination_against_all_windows(spark):
    """Recall against the longest common subsequence with every window of every document."""
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    found = {(r["doc_id"], r["item_id"]) for r in rows(decontamination.find_passages(docs, bench))}
    brute = set()
    known = [(r["item_id"], decontamination.words_of(r["text"])) for r in bench.collect()]
    known = [(i, w, decontamination.lcs_masks(w)) for i, w in known]
    for r in docs.collect():
        words = decontamination.words_of(r["text"])
        for i, item, masks in known:
            n = len(item)
            if len(set(item) & set(words)) < 0.6 * len(set(item)):
                continue
            if any(decontamination.lcs(masks, n, words[at : at + 2 * n]) >= 0.8 * n for at in range(0, max(1, len(words) - n // 2), max(1, n // 4))):
                brute.add((r["doc_id"], i))
    assert brute and len(found & brute) >= 0.9 * len(brute)
    assert len(found - brute) <= 0.1 * len(found)


def test_items_between_parts_of_a_long_text(monkeypatch):
    """An item is found wherever it stands, however the document is cut into parts."""
    rng = random.Random(12)
    known = [(1, " ".join(f"x{i}" for i in range(21))), (2, " ".join(f"y{i}" for i in range(12)))]
    weights = {w: (i, 1.0) for i, w in enumerate(sorted({w for _, t in known for w in decontamination.words_of(t)}))}
    items = decontamination.Items(known, weights, np.eye(len(weights)))
    body = [f"z{rng.randrange(500)}" for _ in range(400)]
    monkeypatch.setattr(decontamination, "PART_WORDS", 37)
    for key, text in known:
        for at in range(len(body) + 1):
            words = decontamination.words_of(" ".join([*body[:at], text, *body[at:]]))
            assert [(h[0], h[2], h[3]) for h in items.search(words)] == [(key, 1.0, 1.0)]


@pytest.mark.parametrize("rank", [0, 4])
def test_copies_are_found_far_from_their_items(rank):
    """Among thousands of items, in a space that tells nothing (rank 0) or hardly anything."""
    rng = random.Random(4)
    known = [(i, " ".join(f"w{int(rng.paretovariate(0.4)) % 6000}" for _ in range(rng.randint(15, 59)))) for i in range(2000)]
    words = sorted({w for _, t in known for w in decontamination.words_of(t)})
    counts = Counter(w for _, t in known for w in set(decontamination.words_of(t)))
    weights = {w: (i, float(np.log(2002 / (1 + counts[w])))) for i, w in enumerate(words)}
    space = np.random.default_rng(1).standard_normal((len(weights), max(1, rank))) * (rank > 0)
    items = decontamination.Items(known, weights, space)
    for i, text in known[::20]:
        n, held = len(text.split()), text.split()
        held[rng.randrange(n)] = "zzz"
        for body in (text, " ".join(held)):
            before = " ".join(f"w{rng.randrange(6000)}" for _ in range(rng.randrange(90)))
            found = {item for item, *_ in items.search(decontamination.words_of(f"{before} {body} and so on"))}
            assert i in found


def test_only_the_space_finds_retold_items(monkeypatch):
    """Half of what is asked in other words of the topic, the answer kept: found among 2,000 items by cosine alone."""
    rng = random.Random(14)
    topics = [[f"t{k}w{j}" for j in range(60)] for k in range(80)]
    spread = [f"g{j}" for j in range(400)]

    def told(k, n):
        return [rng.choice(topics[k]) if rng.random() < 0.8 else rng.choice(spread) for _ in range(n)]

    asked, answers = [told(i % 80, rng.randint(16, 40)) for i in range(2000)], [told(i % 80, 5) for i in range(2000)]
    known = [(i, f"{' '.join(a)}. {' '.join(b)}.") for i, (a, b) in enumerate(zip(asked, answers))]
    counts = Counter(w for _, t in known for w in set(decontamination.words_of(t)))
    weights = {w: (i, float(np.log(2002 / (1 + counts[w])))) for i, w in enumerate(sorted(counts))}
    matrix = np.zeros((2000, len(weights)))
    for i, t in known:
        for w in decontamination.words_of(t):
            matrix[i, weights[w][0]] += weights[w][1]
    space = np.linalg.svd(matrix / np.linalg.norm(matrix, axis=1)[:, None], full_matrices=False)[2][:96].T
    items = decontamination.Items(known, weights, space)

    retold, without = {}, {}
    for i in range(0, 2000, 25):
        words, n = list(asked[i]), len(asked[i])
        for j in rng.sample(range(n), int(0.45 * n)):
            words[j] = rng.choice(topics[i % 80])
        retold[i] = [*told((i + 7) % 80, 60), *words, *answers[i], *told((i + 9) % 80, 60)]
        without[i] = [*told((i + 7) % 80, 60), *words, *told(i % 80, 60)]

    def found(texts):
        return {(i, item) for i, words in texts.items() for item, *_ in items.search(decontamination.words_of(" ".join(words)))}

    hits = found(retold)
    assert len({i for i, item in hits if i == item}) >= 0.9 * len(retold)
    assert all(i == item for i, item in hits)
    # the topic without the answer is no item
    assert not found(without)
    monkeypatch.setattr(decontamination, "COSINE", 2.0)
    assert len(found(retold)) <= 0.3 * len(retold)


def test_singular_vectors(spark):
    rng = np.random.default_rng(0)
    matrix = rng.standard_normal((60, 6)) @ rng.standard_normal((6, 30))
    passages = spark.createDataFrame([(list(range(30)), r.tolist()) for r in matrix], "terms array<bigint>, weights array<double>")
    space = decontamination.singular_vectors(passages, 30, 6)
    assert np.allclose(matrix @ space @ space.T, matrix)


def test_singular_vectors_in_parts(spark):
    """Rows of the products are summed by parts of the terms, the last one short."""
    rng = np.random.default_rng(3)
    terms = decontamination.TERM_ROWS + 10
    dense = np.zeros((40, terms))
    held = [sorted(rng.choice(terms, 6, replace=False).tolist()) for _ in range(39)] + [[terms - 1, terms - 2]]
    for r, t in zip(dense, held):
        r[t] = 1.0
    passages = spark.createDataFrame([(t, [1.0] * len(t)) for t in held], "terms array<bigint>, weights array<double>")
    space = decontamination.singular_vectors(passages, terms, 40)
    assert space.shape == (terms, 40)
    assert np.allclose(dense @ space @ space.T, dense, atol=1e-6)


def test_space_is_fitted_on_all_documents(spark, monkeypatch):
    """Every passage of every document and item is a row of the matrix, however many documents there are."""
    rng = random.Random(41)
    item, other = [f"w{i}" for i in range(40)], [f"x{i}" for i in range(400)]
    texts = [" ".join(rng.choice(item if rng.random() < 0.02 else other) for _ in range(rng.choice((0, 5, 64, 150)))) for _ in range(9000)]
    weights = {}
    weighted = decontamination.weighted_terms
    monkeypatch.setattr(decontamination, "weighted_terms", lambda *a: weights.update(weighted(*a)) or weights)
    fitted, vectors = [], decontamination.singular_vectors
    monkeypatch.setattr(decontamination, "singular_vectors", lambda p, *a: fitted.extend(map(tuple, p.collect())) or vectors(p, *a))
    docs = frame(spark, [(i, t, None) for i, t in enumerate(texts)])
    decontamination.find_passages(docs, items(spark, [(1, " ".join(item))]))
    rows = Counter()
    seen = Counter(w for t in texts for w in set(t.split()))
    assert all(np.isclose(v, np.log(9002 / (1 + seen[w.decode()]))) for w, (_, v) in weights.items())
    for words in (t.split() for t in [*texts, " ".join(item)]):
        for at in range(0, len(words), decontamination.FIT_WINDOW):
            held = Counter(weights[w.encode()] for w in words[at : at + decontamination.FIT_WINDOW] if w.encode() in weights)
            norm = sum((n * v) ** 2 for (_, v), n in held.items()) ** 0.5
            rows[tuple(sorted((t, round(n * v / norm, 9)) for (t, v), n in held.items()))] += bool(held)
    assert len(fitted) > 5000
    assert Counter(tuple(sorted((t, round(v, 9)) for t, v in zip(*r))) for r in fitted) == +rows


# all of them


@pytest.mark.parametrize("which", ["empty", "nothing"])
def test_tables_without_text(spark, request, which):
    docs = request.getfixturevalue(which)
    n = docs.count()
    assert exact_dedup.exact_dedup(docs).count() == n
    assert simhash.simhash_groups(docs).count() == n
    assert sharding.shard_by_bytes(docs).count() == n
    assert licenses.license_scan(docs).count() == n
    assert language.identify(docs).count() == n
    assert packing.pack(docs).count() == n
    assert pii.find_private(docs).count() == n
    assert pii.sanitise(docs).count() == n
    assert decontamination.find_passages(docs, items(spark, [(1, "some words of an item")])).count() == 0
    assert decontamination.find_passages(docs, items(spark, [])).count() == 0
    assert exact_dedup.keep_first(docs).count() == min(n, 1)
    assert language.keep_identified(docs).count() == 0


def test_columns_named_like_those_of_the_operators(spark):
    """Stages return the columns of the input with its values, whatever their names."""
    from pyspark.sql import functions as F

    names = ("_digest", "_sha", "_id", "_gone_id", "_gone_hash", "text_hash", "digest", "kept", "fp", "lang_pred", "item_id", "count")
    long = [(1, "one text of five words"), (1, "one text of  five words"), (2, "one text of five words"), (3, "another text"), (None, "no id")]
    docs = spark.createDataFrame(long, "doc_id bigint, text string").withColumn("lang", F.lit("en"))
    docs = docs.select("*", *[F.concat(F.lit(n), "text").alias(n) for n in names])
    bench = items(spark, [(1, "one text of five words")])
    stages = {
        "language": (language.keep_identified(docs), [None, 1, 1, 2, 3]),
        "exact": (exact_dedup.keep_first(docs), [None, 1, 3]),
        "near": (simhash.keep_representatives(docs), None),
        "clean": (decontamination.keep_clean(docs, bench), [None, 3]),
    }
    for name, (kept, ids) in stages.items():
        assert kept.columns == docs.columns
        found = rows(kept)
        assert ids is None or sorted(map(repr, (r["doc_id"] for r in found))) == sorted(map(repr, ids)), name
        assert found and all(r[n] == n + r["text"] for r in found for n in names)


def test_exact_dedup_sql(spark):
    from rulemark.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    names = ["doc_id", "group_size", "keep_id", "kept", "text_sha256"]
    for name, sql in ORACLES.items():
        found = QUERIES[name](spark, SF).select(names).collect()
        assert sorted(map(tuple, found)) == sorted(con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall())


def test_documents_searched_together_give_the_rows_of_each_alone(monkeypatch):
    """Windows never cross documents, and a cosine does not depend on what stands before."""
    rng = random.Random(31)
    known = [(i, prose(rng, rng.randint(8, 70)) + f" only{i} here{i}.") for i in range(60)]
    vocabulary = sorted({w for _, t in known for w in decontamination.words_of(t)})
    weights = {w: (i, 1 + i % 7 / 3) for i, w in enumerate(vocabulary)}
    space = np.linalg.qr(np.random.default_rng(1).standard_normal((len(weights), 24)))[0]
    items = decontamination.Items(known, weights, space)
    texts = ["", "unknown", *(prose(rng, rng.randint(0, 200)) + " " + rng.choice(known)[1] * rng.randint(0, 2) for _ in range(150))]
    texts += [known[0][1][:-20], known[0][1][-20:]]  # halves of an item, one after the other
    documents = [decontamination.words_of(t) for t in texts]
    alone = [items.search(d) for d in documents]
    assert sum(map(bool, alone)) > 60 and alone[-1] == alone[-2] == []
    for words in (1, 500, 1 << 13, 1 << 20):
        monkeypatch.setattr(decontamination, "GROUP_WORDS", words)
        assert list(items.search_all(documents)) == alone
