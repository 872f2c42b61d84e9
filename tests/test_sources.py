import gzip
import os
from datetime import datetime

import pytest

from helpers import rows
from interpreter import hits, labels
from rulemark.errors import RuleError, SettingsError
from rulemark.operators.compiled import compile_rules
from rulemark.operators.snapshot import latest_per_key
from rulemark.options import FolderOptions, LabelOptions, ReadOptions, WriteOptions
from rulemark.plans.folder import label_folder
from rulemark.sources import dictionary, export, files, storage
from rulemark.streaming.label_stream import label_stream, labelled_so_far, stream_folder

TRICKY = [
    ("1", "plain", None), ("2", "", " both "), ("3", 'say "hi"', "a;b"), ("4", "two\nlines", "\ttab"), ("5", None, "кот"),
    ("6", "back\\slash", "'"), ("7", "crlf\r\nin", "#"),
]


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if str(path).endswith(".gz") else open
    with opener(path, "wb") as out:
        out.write(text.encode(encoding))


def parts(folder):
    return sorted(f for f in os.listdir(folder) if f.startswith("part-"))


@pytest.mark.parametrize("compression", [None, "gzip", "bz2"])
def test_round_trip(spark, tmp_path, compression):
    df = spark.createDataFrame(TRICKY, "id string, a string, b string").coalesce(1)
    options = WriteOptions(compression=compression, chunk_size=3, include_bom=True)
    done = export.export_csv(df, str(tmp_path), "out", options, datetime(2024, 1, 2, 3, 4, 5))
    assert done.rows == 7 and os.path.basename(done.path) == "out_20240102-030405"
    found = parts(done.path)
    assert len(found) == 3 and all(f.endswith(export.file_suffix(compression)) for f in found)
    extension = found[0].rsplit(".", 1)[1]
    back = files.read_folder(spark, done.path, extension)
    assert back.columns == ["id", "a", "b", files.FILE, *files.LOAD_ORDER]
    assert rows(back.select("id", "a", "b")) == sorted(TRICKY, key=repr)


def test_bom_and_empty_export(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, "id string, a string, b string")
    plain = WriteOptions(compression=None, include_bom=True)
    done = export.export_csv(df.coalesce(1), str(tmp_path), "bom", plain)
    with open(os.path.join(done.path, parts(done.path)[0]), "rb") as f:
        assert f.read(5) == b"\xef\xbb\xbfid"
    empty = export.export_csv(df.limit(0), str(tmp_path), "none", plain)
    assert empty == export.Export(None, 0) and os.listdir(tmp_path) == [os.path.basename(done.path)]


def test_suffixes():
    assert [export.file_suffix(c) for c in ("gzip", "bz2", None, "xz", "zip", "zstd", "GZ")] == [
        ".csv.gz", ".csv.bz2", ".csv", ".csv.xz", ".csv.zip", ".csv.zst", ".csv.gz"
    ]
    with pytest.raises(SettingsError):
        export.codec("zstd")


def test_folder_of_files(spark, tmp_path):
    folder = str(tmp_path / "raw")
    write(f"{folder}/a.csv.gz", "﻿Ad Id;Имя\r\n1;x\r\n2;\r\n")
    write(f"{folder}/b.csv.gz", 'other;header\n3;"y;""z"""\n')
    write(f"{folder}/note.txt", "no;data\n")
    write(f"{folder}/sub/c.csv.gz", "q;w\n4;deep\n")
    read = files.read_folder(spark, folder, "gz")
    assert read.columns[:2] == ["AdId", "Imia"]
    assert rows(read.select("AdId", "Imia")) == [("1", "x"), ("2", None), ("3", 'y;"z"')]
    deep = files.read_folder(spark, folder, ".gz", ReadOptions(include_subfolders=True))
    assert deep.count() == 4
    with pytest.raises(SettingsError, match="no files"):
        files.read_folder(spark, folder, "csv")
    with pytest.raises(SettingsError, match="no files"):
        files.read_folder(spark, str(tmp_path / "missing"), "csv")


def test_repeated_and_empty_header_names(spark, tmp_path):
    write(f"{tmp_path}/x/a.csv", "\ufefftag;tag;;Tag;\"a;b\"\n1;2;3;4;5\n")
    read = files.read_folder(spark, f"{tmp_path}/x", "csv")
    assert read.columns[:5] == ["tag", "tag_1", "col_2", "Tag_2", "ab"]
    assert rows(read.select(read.columns[:5])) == [("1", "2", "3", "4", "5")]
    rules = dictionary.read_dictionary(spark, f"{tmp_path}/x/a.csv")
    assert rules.drop(*dictionary.ORDER).first() == ("1", "2", "3", "4", "5")


def test_malformed_lines_and_encoding(spark, tmp_path):
    write(f"{tmp_path}/x/a.csv", "a;b\n1;2\n3;4;5\n6\n", "utf-16")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_folder(spark, f"{tmp_path}/x", "csv", ReadOptions(encoding="utf-16")).collect()
    lenient = files.read_folder(spark, f"{tmp_path}/x", "csv", ReadOptions(encoding="utf-16", ignore_errors=True))
    assert rows(lenient.select("a", "b")) == [("1", "2"), ("3", "4"), ("6", None)]


def test_skip_rows_in_split_files(spark, tmp_path):
    for n in range(3):
        body = "".join(f'{n}-{i};"v ""{i}"""\n' for i in range(400))
        write(f"{tmp_path}/s/{n}.csv", f"junk\nmore;junk;here\nid;value\n{body}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        read = files.read_folder(spark, f"{tmp_path}/s", "csv", ReadOptions(skip_rows=2))
        assert read.columns[:2] == ["id", "value"]
        got = rows(read.select("id", "value"))
        assert got == sorted(((f"{n}-{i}", f'v "{i}"') for n in range(3) for i in range(400)), key=repr)
        no_header = files.read_folder(spark, f"{tmp_path}/s", "csv", ReadOptions(skip_rows=3, has_header=False))
        assert no_header.columns[:2] == ["column_1", "column_2"] and no_header.count() == 1200
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_merged_dictionary(spark, tmp_path):
    folder = f"{tmp_path}/dict"
    head = "action;match;search_column_idx;note;term;cat\n"
    write(f"{folder}/one.csv", head + "r;f;2;;B;x\na;f;10;;A;y\n")
    write(f"{folder}/two.csv", head + 'r;f;2;;B;x\nr;f;2;;A;""\n')
    merged = dictionary.get_dictionary(spark, folder)
    order = merged.orderBy(*dictionary.ORDER).select("search_column_idx", "term", "cat").collect()
    assert [tuple(x) for x in order] == [("10", "A", "y"), ("2", "A", ""), ("2", "B", "x")]
    again = dictionary.get_dictionary(spark, folder)  # read back, not merged again
    assert again.count() == 3
    write(f"{folder}/three.csv", "action;other\nr;f\n")
    with pytest.raises(RuleError):
        dictionary.merge([merged.drop(*dictionary.ORDER), merged.select("term")])
    with pytest.raises(SettingsError):
        dictionary.get_dictionary(spark, f"{tmp_path}/nothing")


COLUMNS = ["AdId", "day", "brand", "article", "media"]
RULES = [
    (1, "d", "f", "2", None, "DELETE ME", None, None), (2, "r", "p", "3", None, "phone", "PHONES", None),
    (3, "r", "fts", "2|3", None, "OZON|MARKET", "SHOP", None), (4, "a", "s", "3", None, "smart", None, "smart"),
    (5, "a", "e", "3", None, "16", None, "sixteen"), (6, "a", "fts", "2", None, "(APPLE OR SAMSUNG)", None, "big, two"),
]


def data_rows():
    names = ["APPLE INC", "SAMSUNG", "OZON RU", "DELETE ME", "none"]
    articles = ["SMARTPHONE 16", "OZON MARKET", "TV", "PHONE\nBOX", ""]
    result = []
    for i in range(200):
        key = "" if i % 41 == 0 else str(i % 37)
        result.append((key, f"2024-01-{i % 28 + 1:02}", names[i % 5], articles[(i // 5) % 5], f"m{i}"))
    return result


def field(value):
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in ';"\n') else value


@pytest.mark.parametrize("label", [LabelOptions(), LabelOptions(broadcast_bytes=0, hot_id_rows=3)], ids=["broadcast", "split"])
def test_label_folder(spark, tmp_path, label):
    base, data = str(tmp_path), data_rows()
    lines = [";".join(map(field, row)) + "\n" for row in data]
    head = "Ad Id;day;brand;article;media\n"
    write(f"{base}/raw_data/1.csv.gz", head + "".join(lines[:120]))
    write(f"{base}/raw_data/2.csv.gz", head + "".join(lines[120:]))
    rules = "".join(";".join("" if v is None else v for v in r[1:]) + "\n" for r in RULES)
    write(f"{base}/dict/merged_dictionary.csv", "action;match;idx;note;term;cat;tags\n" + rules)
    options = FolderOptions(id_column="Ad Id", date_column="day", label=label, write=WriteOptions(chunk_size=50))
    result = label_folder(spark, base, options)
    assert result.rows_read == len(data) and result.date_column == "day" and result.rejected.count() == 0

    latest = {}
    for row in data:
        if row[0] and (row[0] not in latest or row[1] > latest[row[0]][1]):
            latest[row[0]] = row
    table = {int(k): [*v[:3], v[3] or None, v[4]] for k, v in latest.items()}
    plain = [(r[0], r[1], r[2], r[3], r[5], *r[6:]) for r in RULES]
    found = labels(hits(table, COLUMNS, plain), plain, 2)
    expected = []
    for row in data:
        cells = found.get(int(row[0] or -1), [None, None])
        if row[0] and cells is not None:
            expected.append((*[v or None for v in row], *cells))
    back = files.read_folder(spark, result.labelled.path, "gz")
    assert rows(back.select(*COLUMNS, "cat", "tags")) == sorted(expected, key=repr)
    assert result.labelled.rows == len(expected) and os.path.dirname(result.labelled.path) == f"{base}/clean_data"
    assert len(parts(result.labelled.path)) >= 3

    left = {
        (v[2], v[3], *found.get(k, [None, None])) for k, v in table.items() if found.get(k, [None]) is not None
    }
    left = sorted((r for r in left if None in r[2:]), key=repr)
    nulls = files.read_folder(spark, result.unmapped.path, "gz")
    assert rows(nulls.select("brand", "article", "cat", "tags")) == left
    assert os.path.basename(result.unmapped.path).startswith("null_data_")
    shared = storage.shared_folder(spark)
    assert not [d for d in os.listdir(f"{shared}/rulemark") if d.startswith("snapshot")]


def test_label_folder_needs_its_id(spark, tmp_path):
    write(f"{tmp_path}/raw_data/1.csv.gz", "a;b\n1;2\n")
    with pytest.raises(SettingsError, match="id column"):
        label_folder(spark, str(tmp_path), FolderOptions(id_column="AdId"))


def test_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    head = "AdId;day;brand;article;media\n"
    write(f"{folder}/1.csv", head + "1;2024-01-01;OZON;MARKET PHONE;m\n2;2024-01-01;DELETE ME;x;m\n")
    raw = spark.createDataFrame(RULES, "n int, action string, match string, search string, note string, term string, cat string, tags string")
    rules = compile_rules(raw, COLUMNS, ["n"])

    def run():
        stream = stream_folder(spark, folder, COLUMNS, files_per_batch=1)
        query = label_stream(stream, rules, "AdId", str(tmp_path / "out"), str(tmp_path / "state"), "day")
        query.awaitTermination(120)
        return rows(labelled_so_far(spark, str(tmp_path / "out"), rules, "AdId").select("AdId", "cat"))

    assert run() == [("1", "SHOP")]
    write(f"{folder}/2.csv", head + "1;2024-01-02;none;SMARTPHONE;m\n")
    write(f"{folder}/3.csv", head + '3;2024-01-02;none;"";m\n')
    assert run() == [("1", "PHONES"), ("1", "PHONES"), ("3", None)]
    out = labelled_so_far(spark, str(tmp_path / "out"), rules, "AdId")
    assert out.filter("AdId = '3'").first()["article"] == ""
    with pytest.raises(SettingsError):
        stream_folder(spark, folder, COLUMNS, options=ReadOptions(skip_rows=1))
    assert run() == [("1", "PHONES"), ("1", "PHONES"), ("3", None)]


def compiled_rules(spark):
    raw = spark.createDataFrame(RULES, "n int, action string, match string, search string, note string, term string, cat string, tags string")
    return compile_rules(raw, COLUMNS, ["n"])


@pytest.mark.parametrize("files_per_batch", [1, 2, 100])
def test_stream_does_not_depend_on_batches(spark, tmp_path, files_per_batch):
    """A later deletion, a later date and an older row that comes late."""
    folder, head = str(tmp_path / "in"), "AdId;day;brand;article;media\n"
    write(f"{folder}/1.csv", head + "1;2024-01-01;OZON;MARKET PHONE;m\n2;2024-01-03;none;SMARTPHONE;m\n3;2024-01-01;none;SMARTPHONE;m\n")
    write(f"{folder}/2.csv", head + "1;2024-01-02;DELETE ME;x;m\n2;2024-01-01;DELETE ME;x;m\n")
    write(f"{folder}/3.csv", head + "3;2024-01-02;OZON;MARKET PHONE;m\n")
    rules = compiled_rules(spark)
    stream = stream_folder(spark, folder, COLUMNS, files_per_batch=files_per_batch)
    label_stream(stream, rules, "AdId", str(tmp_path / "out"), str(tmp_path / "state"), "day").awaitTermination(120)
    found = rows(labelled_so_far(spark, str(tmp_path / "out"), rules, "AdId").select("AdId", "day", "cat"))
    assert found == [
        ("2", "2024-01-01", "PHONES"), ("2", "2024-01-03", "PHONES"), ("3", "2024-01-01", "SHOP"), ("3", "2024-01-02", "SHOP"),
    ]


@pytest.mark.parametrize("size", ["64", "128m"])
@pytest.mark.parametrize("multi_line", [True, False])
def test_first_loaded_wins_across_files(spark, tmp_path, size, multi_line):
    """Whatever the size of the files and the tasks they are read in."""
    folder, head = f"{tmp_path}/a folder", "id;v\n"
    write(f"{folder}/a.csv", head + "1;red\n")
    write(f"{folder}/b.csv", head + "1;blue\n" + "".join(f"{i};x\n" for i in range(2, 60)) + "2;y\n1;green\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        data = files.read_folder(spark, folder, options=ReadOptions(multi_line=multi_line))
        found = dict(rows(latest_per_key(data, "id", ["v"], None, files.LOAD_ORDER)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found["1"] == "red" and found["2"] == "x"
