"""Rule dictionaries made from the part table: every part gives a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from query_suite.base import ORACLES, query, table, tokens_sql
from rulemark.operators import ordering, rules as r
from rulemark.options import RuleColumns, WriteOptions
from rulemark.sources.dictionary import ORDER, get_dictionary, merge
from rulemark.sources.export import csv_writer
from rulemark.sources.storage import new_folder

COLUMNS = ["name", "brand", "type", "size"]
LABELS = ["category", "tags", "unused"]

# the dictionary, in words that Spark and DuckDB share
RAW = """
SELECT p_partkey,
       CASE WHEN p_type = 'PROMO' THEN 'd' WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'r'
            WHEN p_type IN ('LARGE', 'SMALL') THEN 'a' ELSE 'q' END AS action,
       CASE WHEN p_size <= 10 THEN 'f' WHEN p_size <= 20 THEN 'p' WHEN p_size <= 30 THEN 's'
            WHEN p_size <= 40 THEN 'e' WHEN p_size <= 48 THEN 'fts' END AS match,
       CASE WHEN p_size BETWEEN 41 AND 48 AND length(p_brand) = 8 THEN '0|2'
            ELSE CAST(length(p_name) - 8 AS {text}) END AS search,
       CAST(NULL AS {text}) AS note,
       CASE WHEN p_size BETWEEN 41 AND 46 THEN p_name || '|' || p_type ELSE p_name END AS term,
       CASE WHEN p_size BETWEEN 10 AND 35 THEN p_brand END AS category,
       CASE WHEN p_size > 25 THEN p_type END AS tags,
       CAST(NULL AS {text}) AS unused
FROM part"""
RAW_SQL = RAW.format(text="VARCHAR")
NUMBERED = f"raw AS ({RAW_SQL}), rules AS (SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS INT) AS rule_id, * FROM raw)"
NAME_SQL = "CASE search " + " ".join(f"WHEN '{i}' THEN '{c}'" for i, c in enumerate([*COLUMNS, *LABELS])) + " END"


def raw(spark, sf) -> DataFrame:
    return spark.sql(RAW.format(text="STRING").replace("FROM part", "FROM {part}"), part=table(spark, sf, "part"))


def rule_table(spark, sf) -> DataFrame:
    return r.rule_table(raw(spark, sf), ["p_partkey"], RuleColumns())


@query(f"WITH {NUMBERED} SELECT rule_id, action, match, search, term FROM rules")
def rule_numbering(spark, sf):
    return rule_table(spark, sf).drop("labels")


@query(f"WITH {NUMBERED} SELECT rule_id, category, tags FROM rules")
def rule_labels(spark, sf):
    """Label columns by position, without those that hold nothing."""
    flat = rule_table(spark, sf).select("rule_id", "labels.*")
    return r.drop_empty_columns(flat)


@query(
    f"""WITH {NUMBERED} SELECT rule_id, {NAME_SQL} AS column_name,
    upper(CASE match WHEN 'f' THEN term WHEN 'p' THEN '%' || term || '%' WHEN 's' THEN term || '%'
    WHEN 'e' THEN '%' || term END) AS pattern FROM rules WHERE match <> 'fts'"""
)
def rule_patterns(spark, sf):
    like, _ = r.split_by_match(rule_table(spark, sf))
    named = r.resolve_columns(like, [*COLUMNS, *LABELS])
    return r.like_patterns(named).select("rule_id", "column_name", "pattern")


@query(
    f"""WITH {NUMBERED} SELECT match = 'fts' AS is_text, action, count(*) AS n FROM rules
    WHERE match IS NOT NULL AND action IN ('a', 'r', 'd') GROUP BY ALL"""
)
def rule_split(spark, sf):
    """Rules per kind of match and action; unknown actions and missing kinds fall out."""
    like, text = r.split_by_match(rule_table(spark, sf))
    parts = [
        r.rules_for_action(kind, action).select(F.lit(is_text).alias("is_text"), "action")
        for kind, is_text in ((like, False), (text, True))
        for action in (r.ADD, r.REPLACE, r.DELETE)
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("is_text", "action").agg(F.count("*").alias("n"))


@query(
    f"""WITH {NUMBERED}, split AS (SELECT rule_id, string_split(search, '|') AS w, string_split(term, '|') AS t
    FROM rules WHERE match = 'fts'),
    paired AS (SELECT rule_id, unnest(generate_series(1, CASE WHEN len(w) = len(t) THEN len(w) ELSE 1 END)) AS clause_no, w, t
    FROM split),
    clauses AS (SELECT rule_id, clause_no, CASE WHEN len(w) = len(t) THEN w[clause_no] END AS search,
    CASE WHEN len(w) = len(t) THEN t[clause_no] END AS term, len(w) = len(t) AS paired FROM paired)
    SELECT rule_id, CAST(clause_no AS INT) AS clause_no, {NAME_SQL} AS column_name,
    CASE WHEN paired THEN ' ' || array_to_string({tokens_sql('term')}, ' ') || ' ' ELSE '' END AS phrase,
    CASE WHEN NOT paired THEN 'search and term differ in length'
    WHEN {NAME_SQL} IS NULL THEN 'search index is outside the table' END AS reason FROM clauses"""
)
def rule_text_clauses(spark, sf):
    _, text = r.split_by_match(rule_table(spark, sf))
    clauses = r.text_clauses(text, [*COLUMNS, *LABELS])
    return clauses.select(
        "rule_id", "clause_no", "column_name", F.array_join("all_of", "").alias("phrase"), "reason"
    )


@query(
    f"""WITH {NUMBERED}, signed AS (SELECT rule_id, (category IS NOT NULL)::INT || '' || (tags IS NOT NULL)::INT AS filled FROM rules),
    starts AS (SELECT rule_id, CASE WHEN filled IS NOT DISTINCT FROM lag(filled) OVER (ORDER BY rule_id) THEN 0 ELSE 1 END AS s FROM signed)
    SELECT rule_id, CAST(sum(s) OVER (ORDER BY rule_id) AS INT) AS run_id FROM starts"""
)
def rule_runs(spark, sf):
    flat = rule_table(spark, sf).select("rule_id", "labels.category", "labels.tags")
    return r.rule_runs(flat, ["category", "tags"]).select("rule_id", "run_id")


@query(
    f"""WITH {NUMBERED} SELECT DISTINCT {NAME_SQL} AS column_name FROM rules
    WHERE match <> 'fts' AND {NAME_SQL} IN ('name', 'brand', 'type', 'size')"""
)
def search_columns(spark, sf):
    """Columns of the data that any LIKE rule looks at."""
    like, _ = r.split_by_match(rule_table(spark, sf))
    named = r.resolve_columns(like, [*COLUMNS, *LABELS]).select("column_name").distinct()
    return named.filter(F.col("column_name").isin(COLUMNS))


MERGED = """SELECT 'a' AS action, 'f' AS match, CAST(p_size AS {text}) AS search_column_idx, p_name AS term, p_brand AS category
FROM part UNION ALL SELECT 'a', 'f', CAST(p_size AS {text}), p_name, p_brand FROM part WHERE p_type = 'PROMO'"""


@query(
    f"""WITH u AS (SELECT DISTINCT * FROM ({MERGED.format(text='VARCHAR')}))
    SELECT CAST(row_number() OVER (ORDER BY search_column_idx, action, match, term, category) AS INT) AS rule_id, * FROM u"""
)
def rule_merge(spark, sf):
    """Two dictionaries as one: each rule once, sorted by the search index as text."""
    part = table(spark, sf, "part")
    rules = part.select(
        F.lit("a").alias("action"), F.lit("f").alias("match"), F.col("p_size").cast("string").alias("search_column_idx"),
        F.col("p_name").alias("term"), F.col("p_brand").alias("category"), "p_type",
    )
    promo = rules.filter(F.col("p_type") == "PROMO").drop("p_type")
    merged = merge([rules.drop("p_type"), promo])
    order = ["search_column_idx", "action", "match", "term", "category"]
    return ordering.number_rows(merged, order).select("rule_id", *merged.columns)


@query(ORACLES["rule_merge"])
def dictionary_build(spark, sf):
    """The same from two dictionary files: the merged file is built and read back."""
    rules = table(spark, sf, "part").select(
        F.lit("a").alias("action"), F.lit("f").alias("match"), F.col("p_size").cast("string").alias("search_column_idx"),
        F.col("p_name").alias("term"), F.col("p_brand").alias("category"), "p_type",
    )
    folder, plain = new_folder(spark, "dictionary"), WriteOptions(compression=None)
    csv_writer(rules.drop("p_type").coalesce(1), plain).save(f"{folder}/all.csv")
    csv_writer(rules.filter(F.col("p_type") == "PROMO").drop("p_type").coalesce(1), plain).save(f"{folder}/promo.csv")
    merged = get_dictionary(spark, folder)
    return ordering.number_rows(merged, ORDER).select("rule_id", "action", "match", "search_column_idx", "term", "category")
