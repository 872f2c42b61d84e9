"""DELETE, REPLACE and ADD over parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from query_suite.base import LIKE_HITS, compiled, query, rule, rules_sql, table, values_sql
from rulemark.operators import actions
from rulemark.operators.matching import match_rules, with_payload

COLUMNS = ["p_name", "p_brand", "p_type"]
LABELS = ["category", "tags"]
RULES = [
    rule(1, "d", "f", 2, "promo", None, None),
    rule(2, "r", "p", 0, "gear", "MACHINE", None),
    rule(3, "r", "s", 0, "red", "COLOURED", "red"),
    rule(4, "r", "f", 0, "red gear", "SPECIAL", None),
    rule(5, "r", "f", 2, "small", "", None),
    rule(6, "a", "e", 0, "bolt", None, "fastener"),
    rule(7, "a", "s", 0, "hot", "", "hot"),
    rule(8, "a", "p", 1, "#1", "ONE", "Brand 1x"),
    rule(9, "a", "p", 1, "#12", "ONE", "apart"),
    rule(10, "q", "f", 0, "old rod", "NEVER", "never"),
]
PAID = f"""WITH {rules_sql(RULES, LABELS)}, {values_sql('part', 'p_partkey', COLUMNS)}, {LIKE_HITS},
paid AS (SELECT * FROM hits JOIN rules USING (rule_id))"""
REPLACED = ", ".join(f"arg_max({c}, rule_id) FILTER (WHERE action = 'r' AND {c} IS NOT NULL) AS r_{c}" for c in LABELS)
TAGGED = ", ".join(
    f"string_agg(DISTINCT {c}, ', ' ORDER BY {c}) FILTER (WHERE action = 'a' AND {c} <> '') AS t_{c}" for c in LABELS
)
RESOLVED = f"{PAID}, res AS (SELECT id, bool_or(action = 'd') AS is_deleted, {REPLACED}, {TAGGED} FROM paid GROUP BY id)"


def _paid(spark, sf):
    c = compiled(spark, RULES, LABELS, COLUMNS)
    return with_payload(match_rules(table(spark, sf, "part"), "p_partkey", c), c)


def _parts(spark, sf):
    part = table(spark, sf, "part").select("p_partkey")
    return part.withColumns({c: F.lit(None).cast("string") for c in LABELS})


@query(f"{RESOLVED} SELECT p_partkey FROM part LEFT JOIN res ON id = p_partkey WHERE NOT coalesce(is_deleted, false)")
def action_delete(spark, sf):
    return actions.apply_delete(_parts(spark, sf), "p_partkey", _paid(spark, sf)).select("p_partkey")


@query(f"{RESOLVED} SELECT p_partkey, r_category AS category, r_tags AS tags FROM part LEFT JOIN res ON id = p_partkey")
def action_replace(spark, sf):
    c = compiled(spark, RULES, LABELS, COLUMNS)
    hits = with_payload(match_rules(table(spark, sf, "part"), "p_partkey", c), c)
    return actions.apply_replace(_parts(spark, sf), "p_partkey", hits, LABELS, c)


@query(f"{PAID} SELECT id, CAST(max(rule_id) AS INT) AS rule_id, arg_max(category, rule_id) FILTER (WHERE action = 'r') AS category FROM paid WHERE action = 'r' GROUP BY id".replace(" FILTER (WHERE action = 'r')", ""))
def action_replace_ranked(spark, sf):
    """The last matching REPLACE rule of each part, with the value it alone would set."""
    replacing = _paid(spark, sf).filter(F.col("action") == "r")
    return actions.last_rule(replacing).select("id", "rule_id", "labels.category")


def _added(merge):
    cells = ", ".join(f"{merge.format(c=c)} AS {c}" for c in LABELS)
    return f"{RESOLVED} SELECT p_partkey, {cells} FROM part LEFT JOIN res ON id = p_partkey"


@query(_added("coalesce(t_{c}, r_{c})"))
def action_add_tags(spark, sf):
    """Tags take the place of the value REPLACE has set."""
    paid = _paid(spark, sf)
    replaced = actions.apply_replace(_parts(spark, sf), "p_partkey", paid, LABELS)
    return actions.apply_add(replaced, "p_partkey", paid, LABELS)


APPEND = """CASE WHEN t_{c} IS NULL THEN r_{c} ELSE array_to_string(list_sort(list_distinct(
list_concat(coalesce(string_split(r_{c}, ', '), []), string_split(t_{c}, ', ')))), ', ') END"""


@query(_added(APPEND))
def action_add_append(spark, sf):
    """Tags join the value REPLACE has set."""
    paid = _paid(spark, sf)
    replaced = actions.apply_replace(_parts(spark, sf), "p_partkey", paid, LABELS)
    return actions.apply_add(replaced, "p_partkey", paid, LABELS, add_mode="append")


TAGS = f"""{PAID}, tall AS (SELECT id, 'category' AS column_name, category AS value, action FROM paid
UNION ALL SELECT id, 'tags', tags, action FROM paid),
tag AS (SELECT DISTINCT id, column_name, value FROM tall WHERE action = 'a' AND value <> '')"""


@query(f"{TAGS} SELECT * FROM tag")
def tag_table(spark, sf):
    return actions.tag_table(_paid(spark, sf), LABELS)


@query(f"{TAGS} SELECT DISTINCT column_name FROM tag")
def tag_columns(spark, sf):
    return actions.used_columns(actions.tag_table(_paid(spark, sf), LABELS))


@query(f"{TAGS} SELECT id, column_name, string_agg(value, ' + ' ORDER BY value) AS value FROM tag GROUP BY ALL")
def tag_lists(spark, sf):
    return actions.join_tags(actions.tag_table(_paid(spark, sf), LABELS), " + ")


KEPT = _added("coalesce(t_{c}, r_{c})") + " WHERE NOT coalesce(is_deleted, false)"


@query(KEPT)
def action_order(spark, sf):
    """All actions one after another."""
    return actions.apply_actions(_parts(spark, sf), "p_partkey", _paid(spark, sf), LABELS)


@query(f"{RESOLVED} SELECT id, is_deleted, coalesce(t_category, r_category) AS category, coalesce(t_tags, r_tags) AS tags FROM res")
def action_resolve(spark, sf):
    """All actions in one aggregation."""
    return actions.resolve(_paid(spark, sf), LABELS)
