"""Registry and helpers shared by the queries."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rulemark.operators.compiled import CompiledRules, compile_rules
from rulemark.options import LabelOptions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RULE_FIELDS = ["rule_id", "action", "match", "search", "note", "term"]


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with its SQL."""

    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rule(rule_id, action, match, search, term, *labels):
    return (rule_id, action, match, str(search), None, term, *labels)


def inline(spark: SparkSession, rules: list[tuple], labels: list[str]) -> DataFrame:
    fields = ["rule_id int"] + [f"`{c}` string" for c in [*RULE_FIELDS[1:], *labels]]
    return spark.createDataFrame(rules, ", ".join(fields))


def compiled(
    spark: SparkSession, rules: list[tuple], labels: list[str], columns: list[str], **options
) -> CompiledRules:
    return compile_rules(inline(spark, rules, labels), columns, ["rule_id"], LabelOptions(**options))


def literal(value) -> str:
    if value is None:
        return "CAST(NULL AS VARCHAR)"
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def rules_sql(rules: list[tuple], labels: list[str]) -> str:
    """The rules as a common table expression ``rules``."""
    lines = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rules)
    return f"rules({', '.join([*RULE_FIELDS, *labels])}) AS (VALUES {lines})"


def ascii_upper_sql(expression: str) -> str:
    return f"translate({expression}, '{string.ascii_lowercase}', '{string.ascii_uppercase}')"


PATTERN_SQL = (
    "upper(CASE match WHEN 'f' THEN term WHEN 's' THEN term || '%' "
    "WHEN 'e' THEN '%' || term WHEN 'p' THEN '%' || term || '%' END)"
)


def values_sql(source: str, key: str, columns: list[str]) -> str:
    """Tall values ``vals(id, search, v)`` of the searched columns."""
    parts = [
        f"SELECT {key} AS id, '{i}' AS search, {c} AS v FROM {source}" for i, c in enumerate(columns)
    ]
    return "vals AS (" + " UNION ALL ".join(parts) + ")"


LIKE_HITS = (
    "hits AS (SELECT DISTINCT id, rule_id FROM vals JOIN rules USING (search) "
    f"WHERE {ascii_upper_sql('v')} LIKE {PATTERN_SQL})"
)


def tokens_sql(expression: str) -> str:
    """Tokens of a text, as a list; the test tables hold Latin letters only."""
    return rf"regexp_extract_all(strip_accents(lower({expression})), '[\p{{L}}\p{{N}}]+')"


def padded_sql(expression: str) -> str:
    return f"'^ ' || array_to_string({tokens_sql(expression)}, ' ') || ' '"
