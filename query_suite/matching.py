"""LIKE rules over parts, customers and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from query_suite.base import (
    LIKE_HITS,
    compiled,
    query,
    rule,
    rules_sql,
    table,
    tokens_sql,
    values_sql,
)
from rulemark.operators.compiled import compile_rules
from rulemark.operators.matching import match_rules, union_hits, with_payload
from rulemark.operators.skew import spread
from rulemark.options import LabelOptions

PART = ["p_name", "p_brand", "p_type"]
LABEL = ["tag"]


def _hits(spark, sf, rules, source, key, columns, **options):
    c = compiled(spark, rules, LABEL, columns, **options)
    return match_rules(spread(table(spark, sf, source), key), key, c)


def _sql(rules, source, key, columns):
    return f"WITH {rules_sql(rules, LABEL)}, {values_sql(source, key, columns)}, {LIKE_HITS} SELECT * FROM hits"


def _register(name, rules, source="part", key="p_partkey", columns=PART, **options):
    def run(spark, sf):
        return _hits(spark, sf, rules, source, key, columns, **options)

    query(_sql(rules, source, key, columns), name)(run)


FULL = [rule(1, "a", "f", 0, "Red Gear", "x"), rule(2, "a", "f", 2, "promo", "y"), rule(3, "a", "f", 1, "Brand#7", "z"), rule(4, "a", "f", 0, "gear", "-")]
CONTAINS = [rule(1, "a", "p", 0, "gear", "x"), rule(2, "a", "p", 0, "d b", "y"), rule(3, "a", "p", 1, "#1", "z"), rule(4, "a", "p", 2, "M", "m"), rule(5, "a", "p", 2, "", "all")]
PREFIX = [rule(1, "a", "s", 0, "red", "x"), rule(2, "a", "s", 0, "small widget", "y"), rule(3, "a", "s", 1, "brand#2", "z"), rule(4, "a", "s", 0, "o", "o")]
SUFFIX = [rule(1, "a", "e", 0, "bolt", "x"), rule(2, "a", "e", 0, "large widget", "y"), rule(3, "a", "e", 1, "5", "z"), rule(4, "a", "e", 2, "rd", "o")]
WILDCARD = [rule(1, "a", "f", 0, "%e_r", "x"), rule(2, "a", "p", 0, "o_d%n", "y"), rule(3, "a", "s", 1, "_rand#_", "z"), rule(4, "a", "e", 1, "#__", "o"), rule(5, "a", "f", 2, "_____", "five"), rule(6, "a", "f", 0, "%", "any")]
#: No literal, or only short ones: keys by length and place.
BLANKS = [rule(1, "a", "f", 0, "_" * 9, "x"), rule(2, "a", "f", 0, "_" * 11 + "%", "y"), rule(3, "a", "f", 1, "_r____#_", "z"), rule(4, "a", "s", 0, "__g_____", "s"), rule(5, "a", "f", 2, "%_____%__", "m"), rule(6, "a", "f", 0, "_e_ ____", "r"), rule(7, "a", "f", 0, "", "none"), rule(8, "a", "e", 2, "_" * 40, "long")]
_register("match_full", FULL)
_register("match_contains", CONTAINS)
_register("match_prefix", PREFIX)
_register("match_suffix", SUFFIX)
_register("match_wildcard", WILDCARD)
_register("match_blanks", BLANKS)
_register("match_customers", [rule(1, "a", "e", 0, "42", "x"), rule(2, "a", "p", 0, "#0000000", "y"), rule(3, "a", "f", 1, "Building", "z")], "customer", "c_custkey", ["c_name", "c_mktsegment"])
_register("match_ascii_case", [rule(1, "a", "p", 0, "thon", "x"), rule(2, "a", "p", 0, "été", "y"), rule(3, "a", "p", 0, "É", "z"), rule(4, "a", "s", 0, "über", "o"), rule(5, "a", "p", 0, "apache license", "l")], "documents", "doc_id", ["text"])
_register("match_generated_keys", [*CONTAINS, *[(n, *r[1:]) for n, r in enumerate(WILDCARD, 6)]], probe_limit=0)
_register("match_distinct_values", [*FULL, *[(n, *r[1:]) for n, r in enumerate(CONTAINS, 5)]], dedupe_values=True)

UNICODE = [rule(1, "a", "p", 0, "été", "x"), rule(2, "a", "p", 0, "ÜBER", "y"), rule(3, "a", "p", 0, "für", "z")]


@query(
    f"""WITH {rules_sql(UNICODE, LABEL)}, {values_sql('documents', 'doc_id', ['text'])}
    SELECT id, rule_id FROM vals JOIN rules USING (search) WHERE contains(upper(v), upper(term))"""
)
def match_unicode_case(spark, sf):
    """All letters folded, not only a-z."""
    return _hits(spark, sf, UNICODE, "documents", "doc_id", ["text"], case="unicode")


# a dictionary with a rule per supplier and one per customer segment and nation
MANY = """
SELECT s_suppkey AS n, 'a' AS action, CASE WHEN s_nationkey < 8 THEN 'p' WHEN s_nationkey < 16 THEN 'e' ELSE 's' END AS match,
       '0' AS search, '' AS note,
       CASE WHEN s_nationkey < 16 THEN right(s_name, 3) ELSE 'Customer#0000' || right(s_name, 3) END AS term, s_name AS tag
FROM supplier"""


def _many(spark, sf, by_data=False, **options):
    raw = spark.sql(MANY.replace("FROM supplier", "FROM {supplier}"), supplier=table(spark, sf, "supplier"))
    rules = compile_rules(raw, ["c_name"], ["n"], LabelOptions(**options), table(spark, sf, "customer") if by_data else None)
    hits = match_rules(table(spark, sf, "customer"), "c_custkey", rules)
    return hits


MANY_SQL = f"""WITH rules AS (SELECT CAST(row_number() OVER (ORDER BY n) AS INT) AS rule_id, * FROM ({MANY})),
{values_sql('customer', 'c_custkey', ['c_name'])}, {LIKE_HITS} SELECT * FROM hits"""


@query(MANY_SQL)
def match_many_rules(spark, sf):
    """More rules than are probed for: values are joined on the runs of characters they hold."""
    return _many(spark, sf, probe_limit=0)


@query(MANY_SQL)
def match_many_rules_shuffled(spark, sf):
    """The same with a dictionary taken for too large to broadcast."""
    return _many(spark, sf, probe_limit=0, broadcast_bytes=0)


@query(MANY_SQL)
def match_many_rules_by_data(spark, sf):
    """The same with the runs of characters that are rare in the data as keys."""
    return _many(spark, sf, by_data=True, probe_limit=0)


MIXED = [rule(1, "a", "p", 0, "gear", "x"), rule(2, "r", "fts", 0, "red bolt", "y"), rule(3, "d", "fts", 0, "(widget OR anvil)", None), rule(4, "a", "s", 0, "red", "z")]
TEXT_HITS = f"""SELECT p_partkey AS id, 2 AS rule_id FROM part WHERE ' ' || array_to_string({tokens_sql('p_name')}, ' ') || ' ' LIKE '% red bolt %'
UNION ALL SELECT p_partkey, 3 FROM part WHERE list_has_any({tokens_sql('p_name')}, ['widget', 'anvil'])"""
MIXED_SQL = f"""WITH {rules_sql(MIXED, LABEL)}, {values_sql('part', 'p_partkey', ['p_name'])}, {LIKE_HITS},
everything AS (SELECT id, rule_id FROM hits UNION SELECT id, CAST(rule_id AS INT) FROM ({TEXT_HITS}))"""


@query(f"{MIXED_SQL} SELECT * FROM everything")
def hits_union(spark, sf):
    """Hits of LIKE and text rules, matched apart, as one set."""
    like = [r for r in MIXED if r[2] != "fts"]
    text = [r for r in MIXED if r[2] == "fts"]
    apart = []
    for rules in (like, text):
        raw = spark.createDataFrame(rules, "n int, action string, match string, search string, note string, term string, tag string")
        found = match_rules(table(spark, sf, "part"), "p_partkey", compile_rules(raw, ["p_name"], ["n"]))
        numbers = F.array(*[F.lit(r[0]) for r in rules])
        apart.append(found.select("id", F.get(numbers, F.col("rule_id") - 1).alias("rule_id")))
    return union_hits(*apart)


@query(f"{MIXED_SQL} SELECT id, rule_id, action, tag FROM everything JOIN rules USING (rule_id)")
def hits_payload(spark, sf):
    c = compiled(spark, MIXED, LABEL, ["p_name"])
    paid = with_payload(match_rules(table(spark, sf, "part"), "p_partkey", c), c)
    return paid.select("id", "rule_id", "action", "labels.tag")
