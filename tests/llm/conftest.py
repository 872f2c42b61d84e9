import random

import pytest
from corpus_helpers import frame, prose


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text, lang): nulls, empties, ties, repeated rows, a long text, near copies."""
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(1, 120)), "en") for i in range(60)]
    rows += [(100 + i, "Ärger über süße Öfen und Straßen " + prose(rng, 3), "de") for i in range(12)]
    rows += [(200 + i, rows[3][1], "en") for i in range(9)]
    base = prose(rng, 300).split()
    for i in range(40):
        changed = list(base)
        changed[rng.randrange(len(changed))] = f"w{i}"
        rows.append((300 + i, " ".join(changed), "en"))
    rows += [
        (400, None, None), (401, "", "en"), (402, " \t\n ", None), (403, None, "de"), (404, "12 34 !!", "en"),
        (405, "two words", None), (405, "two words", None), (None, "no id here", "en"), (None, "no id here", "en"),
        (406, "a\tb  c\n", "en"), (407, "a b c ", "en"), (408, prose(rng, 30_000), "en"), (409, "x" * 50_000, "en"),
        (410, "K İ mixed KELVIN Under The MIT License", "en"),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    return frame(spark, texts)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [(1, None, None), (2, None, None)])
