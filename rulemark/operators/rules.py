"""Rule dictionaries: numbering, columns, patterns and text clauses.

A rule table has ``rule_id, action, match, search, term`` and one struct
``labels`` with a field per label column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.errors import RuleError
from rulemark.functions import text
from rulemark.operators.ordering import number_rows, running_sum
from rulemark.options import RuleColumns

# Codes used in rule dictionaries.
ADD, REPLACE, DELETE = "a", "r", "d"
FULL, PART, STARTS, ENDS, TEXT = "f", "p", "s", "e", "fts"
CONTROL = ["action", "match", "search", "term"]

#: NEAR without a distance allows this many tokens in between.
DEFAULT_NEAR = 10
_WORD = r"(?:[0-9A-Za-z_]|[^\x00-\x7F])+"
_PHRASE = rf"(?!(?:AND|OR|NOT)(?:\s|$)){_WORD}(?:\+{_WORD})*\*?"
_ITEM = rf"\^?{_PHRASE}"
_ITEMS = rf"{_ITEM}(?:\s+(?:AND\s+)?{_ITEM})*"


# --- table level ---------------------------------------------------------------------


def non_null_counts(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.count(df[c]).alias(f"n{i}") for i, c in enumerate(columns)]


def drop_empty_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop the columns (of ``columns``, default all) that hold only NULLs."""
    columns = df.columns if columns is None else columns
    counts = df.agg(*non_null_counts(df, columns)).first() if columns else []
    empty = {c for c, n in zip(columns, counts) if n == 0}
    return df.select([c for c in df.columns if c not in empty])


def split_columns(names: list[str], at: RuleColumns) -> tuple[list[str], list[str]]:
    """Control columns (in the order of ``CONTROL``) and label columns, by position."""
    if len(names) < at.first_label:
        raise RuleError(f"the dictionary has {len(names)} columns, {at.first_label} are needed")
    return [names[i] for i in at.positions()], names[at.first_label :]


def rule_table(
    raw: DataFrame,
    order_by: list[str],
    at: RuleColumns,
    label_names: list[str] | None = None,
    labels: list[str] | None = None,
    count: int | None = None,
) -> DataFrame:
    """Number the rules and name their columns.

    ``labels`` are the label columns to keep, ``label_names`` their new names.
    """
    names = [c for c in raw.columns if c not in order_by]
    control, payload = split_columns(names, at)
    labels = payload if labels is None else labels
    label_names = label_names or labels
    fields = [F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(labels, label_names)]
    struct = F.struct(*fields) if fields else F.struct(F.lit(None).cast("string").alias("none"))
    return number_rows(raw, order_by, count=count).select(
        "rule_id",
        *[F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(control, CONTROL)],
        struct.alias("labels"),
    )


def split_by_match(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """LIKE rules and text rules; a rule without a match code is in neither."""
    is_text = F.col("match") == TEXT
    return rules.filter(~is_text), rules.filter(is_text)


def rules_for_action(rules: DataFrame, action: str) -> DataFrame:
    return rules.filter(F.col("action") == action)


def rule_runs(rules: DataFrame, columns: list[str]) -> DataFrame:
    """Number the runs of consecutive rules that fill the same ``columns`` (``run_id``)."""
    filled = F.concat(*[F.when(F.col(c).isNotNull(), "1").otherwise("0") for c in columns])
    signed = rules.withColumn("_filled", filled)
    previous = signed.select((F.col("rule_id") + 1).alias("rule_id"), F.col("_filled").alias("_before"))
    starts = signed.join(previous, "rule_id", "left").withColumn(
        "_start", (~F.col("_filled").eqNullSafe(F.col("_before"))).cast("int")
    )
    return running_sum(starts, "rule_id", "_start", "run_id").drop("_filled", "_before", "_start")


# --- LIKE rules ----------------------------------------------------------------------


def column_at(index: Column, columns: list[str]) -> Column:
    """Column name at a 0-based index, NULL outside the table."""
    inside = index.between(0, len(columns) - 1)
    return F.when(inside, F.get(F.array(*map(F.lit, columns)), index.cast("int")))


def resolve_columns(rules: DataFrame, columns: list[str], on_bad_rule: str = "fail") -> DataFrame:
    """Add ``column_name``. A search index that is no number fails the job or gives NULL."""
    # filters may be evaluated after this, so text rules are kept from the cast here
    search = F.when(F.col("match") != TEXT, F.col("search"))
    index = search.cast("bigint") if on_bad_rule == "fail" else search.try_cast("bigint")
    return rules.withColumn("column_name", column_at(index, columns))


def like_patterns(rules: DataFrame) -> DataFrame:
    """Add the upper-cased LIKE ``pattern``; NULL for an unknown match code or no term."""
    match, term, any_run = F.col("match"), F.col("term"), F.lit("%")
    pattern = (
        F.when(match == FULL, term)
        .when(match == PART, F.concat(any_run, term, any_run))
        .when(match == STARTS, F.concat(term, any_run))
        .when(match == ENDS, F.concat(any_run, term))
    )
    return rules.withColumn("pattern", F.upper(pattern))


# --- text rules ----------------------------------------------------------------------


def _item_pattern(item: Column) -> Column:
    """Padded form of one search item: ``^`` pins the first token, ``*`` opens the last."""
    return F.concat(
        F.when(item.startswith(text.START), text.START).otherwise(""),
        F.lit(" "),
        F.array_join(text.tokens(item), " "),
        F.when(item.endswith("*"), "").otherwise(" "),
    )


def _items(listing: Column, separator: str) -> Column:
    """Padded items of a list, without those that hold no token."""
    items = F.transform(F.split(listing, separator), _item_pattern)
    return F.filter(items, lambda item: F.length(F.trim(F.ltrim(item, F.lit(text.START)))) > 0)


def text_clauses(rules: DataFrame, columns: list[str], separator: str = "|") -> DataFrame:
    """One row per clause of a text rule, with the ``reason`` if it is unusable.

    ``search`` and ``term`` are split on ``separator`` and paired. A term is a
    phrase, or one flat form in brackets::

        (A B)  (A AND B)    all items        (A OR B)      any item
        (A NOT B NOT C)     A without B, C   NEAR(A B, 5)  at most 5 tokens between
        item: WORD   A+B (phrase)   WORD* (token starts with)   ^WORD (first token)

    ``all_of, any_of, none_of`` hold padded items, ``near`` the distance. A
    clause without items matches nothing, and is left out beside other clauses.
    """
    nothing = F.array().cast("array<string>")
    split_at = F.lit(separator_pattern(separator))
    parts = rules.select(
        "rule_id",
        F.split("search", split_at).alias("where"),
        F.split("term", split_at).alias("what"),
    )
    given = F.col("where").isNotNull() & F.col("what").isNotNull()
    paired = F.when(given, F.size("where") == F.size("what")).otherwise(False)
    one_null = F.array(F.lit(None).cast("string"))  # keeps an unpaired rule, to be reported
    pairs = F.arrays_zip(
        F.when(paired, F.col("where")).otherwise(one_null).alias("where"),
        F.when(paired, F.col("what")).otherwise(one_null).alias("what"),
    )
    # blanks around +, * and ^ mean nothing
    unquoted = F.replace(F.col("pair.what"), F.lit('"'), F.lit(""))
    compact = F.regexp_replace(
        F.regexp_replace(unquoted, r"\s*\+\s*", "+"), r"\s+(?=\*)|(?<=\^)\s+", ""
    )
    rows = parts.select("rule_id", paired.alias("paired"), F.posexplode(pairs).alias("at", "pair")).select(
        "rule_id",
        "paired",
        (F.col("at") + 1).alias("clause_no"),
        F.trim("pair.where").try_cast("int").alias("index"),
        F.trim(compact).alias("term"),
    )

    term = F.col("term")
    near_form = rf"^NEAR\s*\(\s*({_PHRASE}(?:\s+{_PHRASE})*)\s*(?:,\s*(\d+)\s*)?\)$"
    rows = rows.select(
        "*",
        F.regexp_extract(term, r"^\(\s*([^()]*?)\s*\)$", 1).alias("listing"),
        F.regexp_extract(term, near_form, 1).alias("near_items"),
        F.regexp_extract(term, near_form, 2).alias("near_size"),
    )
    listing = F.col("listing")
    form = (
        F.when(~F.contains(term, F.lit("(")), "phrase")
        .when(F.col("near_items") != "", "near")
        .when(listing.rlike(rf"^{_ITEMS}$"), "all")
        .when(listing.rlike(rf"^{_ITEM}(?:\s+OR\s+{_ITEM})+$"), "any")
        .when(listing.rlike(rf"^{_ITEMS}(?:\s+NOT\s+{_ITEM})+$"), "without")
        .otherwise("unknown")
    )
    is_form = {f: F.col("form") == f for f in ("phrase", "near", "all", "any", "without", "unknown")}
    phrase = F.array(_item_pattern(F.regexp_replace(term, r"[\^*]", " ")))
    sides = F.split(listing, r"\s+NOT\s+")
    both = r"\s+(?:AND\s+)?"
    all_of = (
        F.when(is_form["phrase"], F.filter(phrase, lambda p: F.length(F.trim(p)) > 0))
        .when(is_form["near"], _items(F.col("near_items"), r"\s+"))
        .when(is_form["all"], _items(listing, both))
        .when(is_form["without"], _items(F.get(sides, F.lit(0)), both))
    )
    any_of = F.when(is_form["any"], _items(listing, r"\s+OR\s+"))
    none_of = F.when(
        is_form["without"],
        _items(F.array_join(F.slice(sides, 2, F.greatest(F.size(sides), F.lit(1))), " "), r"\s+"),
    )
    near = F.coalesce(F.col("near_size").try_cast("int"), F.lit(DEFAULT_NEAR))
    reason = (
        F.when(~F.col("paired"), "search and term differ in length")
        .when(F.col("index").isNull(), "search index is not a number")
        .when(F.col("column_name").isNull(), "search index is outside the table")
        .when(is_form["unknown"], "term is not a flat form")
    )
    named = rows.withColumns({"form": form, "column_name": column_at(F.col("index"), columns)})
    return named.select(
        "rule_id",
        "clause_no",
        "column_name",
        F.coalesce(all_of, nothing).alias("all_of"),
        F.coalesce(any_of, nothing).alias("any_of"),
        F.coalesce(none_of, nothing).alias("none_of"),
        F.when(is_form["near"], near).alias("near"),
        reason.alias("reason"),
    )


def separator_pattern(separator: str) -> str:
    """The separator as a regular expression that means itself."""
    return "".join(f"\\{c}" if not c.isalnum() and not c.isspace() else c for c in separator)
