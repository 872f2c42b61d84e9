"""Quoted fields with line breaks, read by many tasks, against the one-task reader."""

import dataclasses
import random

import numpy as np
import pytest
from helpers import rows

from rulemark.options import ReadOptions
from rulemark.sources import files, quoted

ONE_TASK = ReadOptions(split_quoted=False, ignore_errors=True)
MANY = dataclasses.replace(ONE_TASK, split_quoted=True)


@pytest.fixture
def small_blocks(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, str(size)) for n in names]
    for n, value in before.items():
        spark.conf.set(n, value)


def field(rng):
    text = lambda: "".join(rng.choice(["a", "b c", "ü", ";", '""', "\n", "\r\n", " ", "x" * 9]) for _ in range(rng.randint(0, 9)))
    plain = lambda: rng.choice(["", "one", "5 m", 'a 5" pipe', "it's", "two words", 'b"', "x" * 30])
    return f'"{text()}"' if rng.random() < 0.4 else plain()


def file_of(rng, n, end="\n"):
    lines = ["id;v;w"] + [f"{i};{field(rng)};{field(rng)}" for i in range(n)]
    return end.join(lines) + (end if rng.random() < 0.5 else "")


@pytest.mark.parametrize("size", [16, 200, 1 << 27])
def test_same_rows_as_one_task(spark, tmp_path, small_blocks, size):
    rng = random.Random(size)
    for i in range(3):
        (tmp_path / f"{i}.csv").write_bytes(("\n\n" * (i == 1) + file_of(rng, 60)).encode())
    (tmp_path / "3.csv").write_bytes(b'id;v;w\n1;"' + b"long\nfield;\n" * 200 + b'";z\n2;"open at the end\n of the file')
    (tmp_path / "4.csv").write_bytes(b"")
    wanted = rows(files.read_folder(spark, str(tmp_path), options=ONE_TASK).select("id", "v", "w"))
    small_blocks(size)
    read = files.read_folder(spark, str(tmp_path), options=MANY)
    assert rows(read.select("id", "v", "w")) == wanted
    if size == 16:
        lines = quoted._lines(spark, str(tmp_path), ";", {})
        assert lines.select("_src_file", "_src_part").distinct().count() > 100
    # the load order is that of the file
    for path in (f"{tmp_path}/0.csv", f"{tmp_path}/1.csv"):
        placed = read.filter(read["_src_file"].endswith(path)).orderBy(*files.LOAD_ORDER)
        assert [r["id"] for r in placed.collect()] == [str(i) for i in range(60)]


def test_other_lines_and_no_header(spark, tmp_path, small_blocks):
    rng = random.Random(8)
    (tmp_path / "a.csv").write_bytes((file_of(rng, 50, "\r\n").rstrip("\r\n") + "\r\n").encode())
    options = dataclasses.replace(MANY, has_header=False)
    wanted = rows(files.read_folder(spark, str(tmp_path), options=dataclasses.replace(options, split_quoted=False)).drop("_src_row", "_src_part"))
    small_blocks(40)
    assert rows(files.read_folder(spark, str(tmp_path), options=options).drop("_src_row", "_src_part")) == wanted


def test_blocks_without_a_table_that_is_broadcast(spark, tmp_path, small_blocks, monkeypatch):
    (tmp_path / "a.csv").write_bytes(file_of(random.Random(4), 80).encode())
    wanted = rows(files.read_folder(spark, str(tmp_path), options=ONE_TASK).select("id", "v", "w"))
    small_blocks(50)
    monkeypatch.setattr(quoted, "MANY_BLOCKS", 0)
    assert rows(files.read_folder(spark, str(tmp_path), options=MANY).select("id", "v", "w")) == wanted


def test_states_are_composed():
    rng = np.random.default_rng(0)
    for n in range(40):
        does, begin = rng.choice([quoted.SAME, quoted.SAME, quoted.INTO, quoted.OUT, quoted.TURN], n), int(rng.integers(2))
        state, wanted = begin, [begin]
        for d in does:
            state = int(d) >> state & 1
            wanted.append(state)
        assert quoted.states(does, begin).tolist() == wanted


def test_a_record_over_many_lines_of_one_task(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;v\n1;"' + '""\n' * 30_000 + '"\n2;' + "x;" * 50 + "\n")
    first = files.read_folder(spark, str(tmp_path), options=MANY).filter("id = '1'").first()
    assert first["v"] == '"\n' * 30_000
