import pytest

from helpers import rows
from pyspark.sql import functions as F
from rulemark.errors import RuleError, SettingsError
from rulemark.functions.names import clean_names
from rulemark.functions.text import pad_tokens, tokens
from rulemark.operators import columns, ordering, rules as r
from rulemark.operators.compiled import compile_rules
from rulemark.options import LabelOptions, RuleColumns

SAMPLE = [
    ("a", "f", "3", None, "Coca-Cola", "brand"),
    ("r", "p", "1", None, "канал", "channelName"),
    ("r", "s", "1", None, "Первый", "channelName"),
    ("d", "f", "5", None, "Удалить", None),
    ("a", "f", "4", None, "Спонсор", "sponsor_tag"),
]
MAIN = ["adId", "researchDate", "programName", "channelName", "brand"]


def sample(spark):
    data = [(i, *row) for i, row in enumerate(SAMPLE)]
    return spark.createDataFrame(data, "n int, action string, match string, search string, extra string, term string, tag string")


def test_patterns(spark):
    table = r.rule_table(sample(spark), ["n"], RuleColumns())
    like, text = r.split_by_match(table)
    built = r.like_patterns(r.resolve_columns(like, [*MAIN, "brand_normalized"]))
    got = rows(built.select("rule_id", "column_name", "pattern"))
    assert got == [
        (1, "channelName", "COCA-COLA"),
        (2, "researchDate", "%КАНАЛ%"),
        (3, "researchDate", "ПЕРВЫЙ%"),
        (4, "brand_normalized", "УДАЛИТЬ"),
        (5, "brand", "СПОНСОР"),
    ]
    assert text.count() == 0


def test_compile_sample(spark):
    compiled = compile_rules(sample(spark), MAIN, ["n"])
    assert compiled.label_columns == ["tag"]
    assert compiled.search_columns == ["researchDate", "channelName", "brand"]
    assert compiled.actions == {"a", "r", "d"} and compiled.broadcastable and compiled.single_clause


def test_unknown_codes_and_missing_terms_are_inert(spark):
    data = [(1, "a", "q", "0", None, "X", "t"), (2, "a", None, "0", None, "X", "t"), (3, "a", "f", "0", None, None, "t"),
            (4, "a", "f", "9", None, "X", "t"), (5, "a", "f", "-1", None, "X", "t")]
    raw = spark.createDataFrame(data, "n int, a string, m string, s string, e string, t string, tag string")
    compiled = compile_rules(raw, ["c"], ["n"])
    assert compiled.keyed.count() == 0 and compiled.search_columns == ["c"]


def test_bad_index_fails_or_is_skipped(spark):
    raw = spark.createDataFrame([(1, "a", "f", "x", None, "X", "t"), (2, "a", "f", "0", None, "Y", "t")],
                                "n int, a string, m string, s string, e string, t string, tag string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        compile_rules(raw, ["c"], ["n"])
    compiled = compile_rules(raw, ["c"], ["n"], LabelOptions(on_bad_rule="skip"))
    assert rows(compiled.rejected) == [(1, "search index is not a number")]
    assert compiled.keyed.count() == 1


def test_text_clauses(spark):
    data = [
        (1, "0|1", "OZON|MARKET"), (2, "0|1", "OZON"), (3, "x", "OZON"), (4, "7", "OZON"), (5, "-1", "OZON"),
        (6, "0", '"Ozon" Rocket'), (7, "0", "(a OR b)"), (8, "0", "(a b* ^c)"), (9, "0", "(a NOT b NOT c_d)"),
        (10, "0", "NEAR(a b, 3)"), (11, "0", "NEAR(a b)"), (12, "0", "(a OR (b c))"), (13, "0", "(a + b)"),
        (14, "0", "(a NOT b c)"), (15, "0", "(a-b)"), (16, "0", None), (17, "0", "..."), (18, "0", "x (b)"),
    ]
    table = spark.createDataFrame(data, "rule_id int, search string, term string")
    got = {(x["rule_id"], x["clause_no"]): x for x in r.text_clauses(table, ["c0", "c1"]).collect()}

    def parts(i, n=1):
        x = got[i, n]
        return x["column_name"], x["all_of"], x["any_of"], x["none_of"], x["near"]

    assert parts(1) == ("c0", [" ozon "], [], [], None) and parts(1, 2) == ("c1", [" market "], [], [], None)
    reasons = {i: got[i, 1]["reason"] for i in range(1, 19) if got[i, 1]["reason"]}
    assert reasons == {
        2: "search and term differ in length", 3: "search index is not a number",
        4: "search index is outside the table", 5: "search index is outside the table",
        12: "term is not a flat form", 14: "term is not a flat form", 15: "term is not a flat form",
        16: "search and term differ in length", 18: "term is not a flat form",
    }
    assert parts(6)[1] == [" ozon rocket "]
    assert parts(7)[1:3] == ([], [" a ", " b "])
    assert parts(8)[1] == [" a ", " b", "^ c "]
    assert parts(9)[1:4] == ([" a "], [], [" b ", " c d "])
    assert parts(10)[1] == [" a ", " b "] and parts(10)[4] == 3 and parts(11)[4] == 10
    assert parts(13)[1] == [" a b "]
    assert parts(17)[1:4] == ([], [], [])


def test_other_separators(spark):
    for separator in ("&", "||", ".", "§"):
        table = spark.createDataFrame([(1, separator.join("01"), separator.join("ab"))], "rule_id int, search string, term string")
        assert r.text_clauses(table, ["c0", "c1"], separator).filter("reason is null").count() == 2


def test_runs(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 2, None), (3, 3, 4), (4, None, None), (5, None, None), (6, 1, None)], "rule_id int, a int, b int")
    expected = [(1, 1), (2, 1), (3, 2), (4, 3), (5, 3), (6, 4)]
    assert rows(r.rule_runs(df, ["a", "b"]).select("rule_id", "run_id")) == expected


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int")
    assert r.drop_empty_columns(df).columns == ["a"]


@pytest.mark.parametrize("bucket_rows", [7, 100, 10_000])
def test_numbering_in_ranges(spark, bucket_rows):
    df = spark.range(500).select(
        F.when(F.col("id") == 3, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(20))).cast("string").alias("s"), (-F.col("id")).alias("n")
    )
    numbered = ordering.number_rows(df, ["s", "n"], bucket_rows=bucket_rows).collect()
    in_order = sorted(numbered, key=lambda x: (x["s"] is not None, x["s"] or "", x["n"]))
    assert [x["rule_id"] for x in in_order] == list(range(1, 501))
    summed = ordering.running_sum(spark.range(1, 501).select(F.col("id").alias("p"), F.lit(2).alias("v")), "p", "v", "t", bucket_rows)
    assert all(x["t"] == 2 * x["p"] for x in summed.collect())


def test_control_columns():
    with pytest.raises(SettingsError):
        RuleColumns(action=1)
    with pytest.raises(RuleError):
        r.split_columns(["a", "b"], RuleColumns())
    assert r.split_columns(list("abcdefg"), RuleColumns()) == (["a", "b", "c", "e"], ["f", "g"])
    assert r.split_columns(list("abcdefg"), RuleColumns(3, 2, 1, 0)) == (["d", "c", "b", "a"], ["e", "f", "g"])


def test_clean_names():
    dirty = ["wrong column!", "Неправильно с пробелами", "12*&&*invalid", "already_valid", "1 starts with digit",
             " leading space", "tag", "duplicate_tag", "tag", "TAG", "!!!", "Größe", "Щи Ёж"]
    assert clean_names(*dirty) == [
        "wrongcolumn", "Nepravilnosprobelami", "12invalid", "already_valid", "1startswithdigit", "leadingspace",
        "tag", "duplicate_tag", "tag_1", "TAG_2", "col_10", "Grosse", "ShchiIozh",
    ]


def test_clean_names_of_other_scripts():
    dirty = ["Ελληνικά", "ΨΥΧΉ", "საქართველო", "Հայերեն", "price €", "ﬁeld½", "日本", "Ё"]
    assert clean_names(*dirty) == ["Ellenika", "PsUKhE", "sakartvelo", "Hayeren", "priceEUR", "field12", "col_6", "Io"]


def test_label_and_typed_columns(spark):
    df = spark.createDataFrame([(1, "a")], "id int, `na me` string")
    labelled = columns.add_label_columns(df, "tag", "ID")
    assert labelled.columns == ["id", "name", "tag", "ID_1"]
    typed = columns.add_columns(df, n="integer", r="REAL", b="BLOB", t="text", m="numeric")
    assert [t for _, t in typed.dtypes][2:] == ["bigint", "double", "binary", "string", "double"]
    with pytest.raises(SettingsError):
        columns.add_columns(df, n="DATE")


def test_tokens(spark):
    texts = ["Ünïcode naïve", "Ёлка-йога", "ΑΣ Άλφα", "été", "a_b 1²x", "İstanbul ſ", ""]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [x[0] for x in df.select(tokens(F.col("s"))).collect()]
    assert got == [["unicode", "naive"], ["ёлка", "йога"], ["ασ", "άλφα"], ["ete"], ["a", "b", "1²x"], ["istanbul", "s"], []]
    assert df.select(pad_tokens(tokens(F.col("s")))).first()[0] == "^ unicode naive "
