"""Full-text rules over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from query_suite.base import compiled, literal, padded_sql, query, rule, table, tokens_sql
from rulemark.functions import text
from rulemark.operators.compiled import compile_rules
from rulemark.operators.matching import match_rules
from rulemark.operators.skew import spread

DOCUMENTS = f"d AS (SELECT doc_id AS id, {padded_sql('text')} AS t FROM documents)"


def documents(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id")


@query(f"SELECT doc_id, array_to_string(t, ' ') AS tokens, len(t) AS n FROM (SELECT doc_id, {tokens_sql('text')} AS t FROM documents)")
def fts_tokens(spark, sf):
    words = documents(spark, sf).select("doc_id", text.tokens(F.col("text")).alias("t"))
    return words.select("doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").cast("bigint").alias("n"))


def _register(name, forms):
    """A query of text rules over documents; ``forms``: (term, SQL condition on t)."""
    rules = [rule(i, "a", "fts", 0, term, "x") for i, (term, _) in enumerate(forms, 1)]
    parts = [f"SELECT id, CAST({i} AS INT) AS rule_id FROM d WHERE {test}" for i, (_, test) in enumerate(forms, 1)]

    def run(spark, sf):
        return match_rules(documents(spark, sf), "doc_id", compiled(spark, rules, ["tag"], ["text"]))

    query(f"WITH {DOCUMENTS} " + " UNION ALL ".join(parts), name)(run)


def has(item):
    return f"contains(t, {literal(item)})"


PHRASES = [("licensed under", has(" licensed under ")), ("Apache-License, Version 2.0", has(" apache license version 2 0 ")), ("and the", has(" and the ")), ("für", has(" fur ")), ("!!!", "false")]
_register("fts_phrase", PHRASES)
_register("fts_any", [("(license OR idiot)", f"{has(' license ')} OR {has(' idiot ')}"), ("(über OR être OR para)", " OR ".join(map(has, (" uber ", " etre ", " para "))))])
_register("fts_all", [("(the and)", f"{has(' the ')} AND {has(' and ')}"), ("(the AND idiot)", f"{has(' the ')} AND {has(' idiot ')}")])
_register("fts_none", [("(the NOT from)", f"{has(' the ')} AND NOT {has(' from ')}"), ("(and the NOT license NOT is)", f"{has(' and ')} AND {has(' the ')} AND NOT {has(' license ')} AND NOT {has(' is ')}")])
_register("fts_prefix", [("(licen*)", has(" licen")), ("(thon* OR que)", f"{has(' thon')} OR {has(' que ')}"), ("(a_the*)", has(" a the"))])
_register("fts_initial", [("(^the)", has("^ the ")), ("(^by the)", f"{has('^ by ')} AND {has(' the ')}"), ("(^th*)", has("^ th"))])


def near(a, b, distance):
    return f"""SELECT DISTINCT x.id FROM w x JOIN w y ON x.id = y.id AND x.word = '{a}' AND y.word = '{b}'
    AND abs(x.at - y.at) <= {distance + 1}"""


NEAR = [("the", "from", 1), ("license", "apache", 0), ("version", "licensed", 3), ("that", "and", 2)]


@query(
    f"WITH s AS (SELECT doc_id AS id, {tokens_sql('text')} AS t FROM documents), "
    "w AS (SELECT id, unnest(t) AS word, generate_subscripts(t, 1) AS at FROM s) "
    + " UNION ALL ".join(f"SELECT id, CAST({i} AS INT) AS rule_id FROM ({near(*n)})" for i, n in enumerate(NEAR, 1))
)
def fts_near(spark, sf):
    rules = [rule(i, "a", "fts", 0, f"NEAR({a} {b}, {n})", "x") for i, (a, b, n) in enumerate(NEAR, 1)]
    return match_rules(documents(spark, sf), "doc_id", compiled(spark, rules, ["tag"], ["text"]))


FAR = [("license", "apache", 600), ("version", "idiot", 2000), ("benchmark", "the", 900)]


@query(
    f"WITH s AS (SELECT doc_id AS id, {tokens_sql('text')} AS t FROM documents), "
    "w AS (SELECT id, unnest(t) AS word, generate_subscripts(t, 1) AS at FROM s) "
    + " UNION ALL ".join(f"SELECT id, CAST({i} AS INT) AS rule_id FROM ({near(*n)})" for i, n in enumerate(FAR, 1))
)
def fts_near_far(spark, sf):
    """Words some hundreds of words apart."""
    rules = [rule(i, "a", "fts", 0, f"NEAR({a} {b}, {n})", "x") for i, (a, b, n) in enumerate(FAR, 1)]
    return match_rules(documents(spark, sf), "doc_id", compiled(spark, rules, ["tag"], ["text"]))


@query(
    f"""WITH c AS (SELECT conv_id || '-' || turn AS id, {padded_sql('role')} AS r, {padded_sql('text')} AS t FROM conversations)
    SELECT id, CAST(1 AS INT) AS rule_id FROM c WHERE {has(' user ').replace('(t', '(r')} AND {has(' the ')}
    UNION ALL SELECT id, 2 FROM c WHERE {has(' assistant ').replace('(t', '(r')} AND ({has(' und ')} OR {has(' et ')})
    UNION ALL SELECT id, 3 FROM c WHERE {has(' de ')}"""
)
def fts_multi_column(spark, sf):
    """Rules whose clauses look at several columns; a clause without words is ignored beside others."""
    rules = [rule(1, "a", "fts", "0|1", "user|the", "x"), rule(2, "a", "fts", "0|1", "assistant|(und OR et)", "y"), rule(3, "a", "fts", "0|1", "--|de", "z")]
    turns = table(spark, sf, "conversations").withColumn("id", F.concat_ws("-", "conv_id", "turn"))
    return match_rules(turns, "id", compiled(spark, rules, ["tag"], ["role", "text"]))


@query(
    f"""WITH {DOCUMENTS}, b AS (SELECT CAST(row_number() OVER (ORDER BY item_id) AS INT) AS rule_id,
    ' ' || array_to_string({tokens_sql('text')}, ' ') || ' ' AS p FROM benchmark)
    SELECT id, rule_id FROM d JOIN b ON contains(t, p) WHERE length(p) > 2"""
)
def fts_passages(spark, sf):
    """Whole benchmark passages as phrases: a dictionary that grows with its table."""
    passages = table(spark, sf, "benchmark").select(
        "item_id", F.lit("a").alias("action"), F.lit("fts").alias("match"), F.lit("0").alias("search"),
        F.lit("").alias("note"), F.regexp_replace("text", r"[|(]", " ").alias("term"), F.lit("seen").alias("tag"),
    )
    rules = compile_rules(passages, ["text"], ["item_id"])
    return match_rules(documents(spark, sf), "doc_id", rules)
