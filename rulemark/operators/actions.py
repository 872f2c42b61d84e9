"""DELETE, REPLACE and ADD: all at once (``resolve``) or one by one.

Hits come with the action and labels of their rule (``matching.with_payload``).
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulemark.functions.names import free_name, quoted
from rulemark.operators.rules import ADD, DELETE, REPLACE
from rulemark.operators.skew import join_small

if TYPE_CHECKING:
    from rulemark.operators.compiled import CompiledRules

TEXT_LIST = "array<string>"


def _label(name: str) -> Column:
    return F.col(f"labels.`{name}`")


def merge_tags(tags: Column, separator: str, current: Column | None = None) -> Column:
    """Distinct tags in byte order, joined; with ``current`` added to its parts."""
    if current is not None:
        parts = F.split(current, F.lit(rf"\Q{separator}\E"), -1)
        tags = F.array_union(F.coalesce(parts, F.array().cast(TEXT_LIST)), tags)
    return F.array_join(F.array_sort(tags), separator)


def resolve(
    hits: DataFrame,
    label_columns: list[str],
    separator: str = ", ",
    add_mode: str = "tags",
    actions: Iterable[str] = (ADD, REPLACE, DELETE),
    rules: CompiledRules | None = None,
) -> DataFrame:
    """``id, is_deleted, labels...`` of every id with hits, in one aggregation.

    REPLACE: per label the value of the last rule that has one. ADD: the sorted
    distinct tags, in place of that value ("tags") or added to it ("append"). With ``rules`` of
    a small dictionary only the numbers of rules are aggregated, in place and without
    sorting, and their values are looked up afterwards.
    """
    return _labels(_gather(hits, label_columns, actions, rules), label_columns, separator, add_mode)


def _labels(found: DataFrame, label_columns: list[str], separator: str, add_mode: str) -> DataFrame:
    final = [
        _written(F.col(f"r{i}"), F.col(f"t{i}"), separator, add_mode).alias(c) for i, c in enumerate(label_columns)
    ]
    return found.select("id", "is_deleted", *final)


def resolve_tests(tests: DataFrame, rules: CompiledRules) -> DataFrame:
    """``resolve`` from tests (``matching.match_tests``), whose rules are resolved once for all ids.

    What the rules of a test do is told by one row: if they delete, the last value and its number, and
    the set of tags. So an id has a row per test, however many rules share it.
    """
    labels, options, actions = rules.label_columns, rules.options, rules.usable().actions
    per_test, per_id = [F.max(F.col("action") == DELETE).alias("is_deleted")], [F.max("is_deleted").alias("is_deleted")]
    unused = []
    for i, name in enumerate(labels):
        value = _label(name)
        if REPLACE in actions:
            number = F.when((F.col("action") == REPLACE) & value.isNotNull(), F.col("rule_id"))
            per_test += [F.max(number).alias(f"n{i}"), F.max_by(value, number).alias(f"r{i}")]
            per_id.append(F.max(f"n{i}").alias(f"n{i}") if rules.broadcastable else F.max_by(f"r{i}", f"n{i}").alias(f"r{i}"))
        else:
            unused.append(F.lit(None).cast("string").alias(f"r{i}"))
        if ADD in actions:
            adds = (F.col("action") == ADD) & (value != "")
            per_test.append(F.collect_set(F.when(adds, value)).alias(f"t{i}"))
            sets = F.collect_set(F.when(F.size(f"t{i}") > 0, F.col(f"t{i}")))
            per_id.append(F.array_distinct(F.flatten(sets)).alias(f"t{i}"))
        else:
            unused.append(F.array().cast(TEXT_LIST).alias(f"t{i}"))
    done = rules.rules.groupBy("test").agg(*per_test).withColumnRenamed("test", "rule_id")
    if rules.broadcastable:
        done = done.drop(*[f"r{i}" for i in range(len(labels))])
    met = join_small(tests, done, "rule_id", rules.broadcastable, options.hot_id_rows)
    found = met.groupBy("id").agg(*per_id)
    if rules.broadcastable and REPLACE in actions:
        found = _looked_up(found, labels, rules)
    return _labels(found.select("*", *unused), labels, options.add_separator, options.add_mode)


def _gather(hits: DataFrame, label_columns: list[str], actions: Iterable[str], rules: CompiledRules | None = None) -> DataFrame:
    """``id, is_deleted``, and of each label ``r<i>``, what it is replaced by, and ``t<i>``, its tags."""
    by_number = rules is not None and rules.broadcastable and REPLACE in actions
    aggregates = [F.max(F.col("action") == DELETE).alias("is_deleted")]
    unused = []
    for i, name in enumerate(label_columns):
        value = _label(name)
        if REPLACE in actions:
            number = F.when((F.col("action") == REPLACE) & value.isNotNull(), F.col("rule_id"))
            aggregates.append(F.max(number).alias(f"n{i}") if by_number else F.max_by(value, number).alias(f"r{i}"))
        else:
            unused.append(F.lit(None).cast("string").alias(f"r{i}"))
        if ADD in actions:
            adds = (F.col("action") == ADD) & (value != "")
            aggregates.append(F.collect_set(F.when(adds, value)).alias(f"t{i}"))
        else:
            unused.append(F.array().cast(TEXT_LIST).alias(f"t{i}"))
    found = hits.groupBy("id").agg(*aggregates)
    if by_number:
        found = _looked_up(found, label_columns, rules)
    return found.select("*", *unused)


def _looked_up(found: DataFrame, label_columns: list[str], rules: CompiledRules) -> DataFrame:
    """The values ``r<i>`` of the rules with the numbers ``n<i>``."""
    table = rules.usable().rules.filter(F.col("action") == REPLACE)
    for i, name in enumerate(label_columns):
        values = table.filter(_label(name).isNotNull()).select(F.col("rule_id").alias(f"n{i}"), _label(name).alias(f"r{i}"))
        found = found.join(F.broadcast(values), f"n{i}", "left").drop(f"n{i}")  # measured to be small
    return found


def _written(current: Column, tags: Column, separator: str, add_mode: str) -> Column:
    """A label after ADD: its tags, if any, over ("tags") or into ("append") the current value."""
    merged = merge_tags(tags, separator, current if add_mode == "append" else None)
    return F.when(F.size(tags) > 0, merged).otherwise(current)


# --- one action at a time ------------------------------------------------------------


def apply_delete(rows: DataFrame, key: str, hits: DataFrame) -> DataFrame:
    """Drop rows hit by a DELETE rule."""
    doomed = hits.filter(F.col("action") == DELETE).select(F.col("id").alias(key)).distinct()
    return rows.join(doomed, key, "left_anti")


def last_rule(hits: DataFrame) -> DataFrame:
    """Of the hits of each id the one with the highest rule number."""
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("rule_id")))
    return hits.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def apply_replace(rows: DataFrame, key: str, hits: DataFrame, label_columns: list[str], rules: CompiledRules | None = None) -> DataFrame:
    """Set labels from REPLACE rules; later rules win, NULL labels change nothing."""
    replacing = hits.filter(F.col("action") == REPLACE)
    return _override(rows, key, resolve(replacing, label_columns, actions=(REPLACE,), rules=rules), label_columns)


def _override(rows: DataFrame, key: str, values: DataFrame, label_columns: list[str]) -> DataFrame:
    new = values.select(
        F.col("id").alias(key), *[F.col(c).alias(f"_new{i}") for i, c in enumerate(label_columns)]
    )
    joined = rows.join(new, key, "left")
    position = {c: i for i, c in enumerate(label_columns)}
    return joined.select(
        *[
            F.coalesce(F.col(f"_new{position[c]}"), F.col(c)).alias(c) if c in position else F.col(c)
            for c in rows.columns
        ]
    )


def tag_table(hits: DataFrame, label_columns: list[str]) -> DataFrame:
    """``id, column_name, value``: every distinct tag of the ADD rules, in long form."""
    cells = [F.struct(F.lit(c).alias("column_name"), _label(c).alias("value")) for c in label_columns]
    if not cells:
        cells = [F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("value"))]
    return (
        hits.filter(F.col("action") == ADD)
        .select("id", F.explode(F.array(*cells)).alias("c"))
        .select("id", "c.*")
        .filter(F.col("value") != "")
        .distinct()
    )


def used_columns(tags: DataFrame) -> DataFrame:
    """Label columns that have any tag."""
    return tags.select("column_name").distinct()


def join_tags(tags: DataFrame, separator: str = ", ") -> DataFrame:
    """``id, column_name, value`` with the tags of each cell sorted and joined."""
    return tags.groupBy("id", "column_name").agg(
        merge_tags(F.collect_set("value"), separator).alias("value")
    )


def apply_add(
    rows: DataFrame,
    key: str,
    hits: DataFrame,
    label_columns: list[str],
    separator: str = ", ",
    add_mode: str = "tags",
) -> DataFrame:
    """Write the tags of ADD rules over ("tags") or into ("append") the current labels."""
    tags = tag_table(hits, label_columns)
    wide = tags.groupBy("id").agg(
        *[
            F.collect_set(F.when(F.col("column_name") == c, F.col("value"))).alias(f"_t{i}")
            for i, c in enumerate(label_columns)
        ]
    )
    joined = rows.join(wide.withColumnRenamed("id", key), key, "left")
    position = {c: i for i, c in enumerate(label_columns)}

    def written(name: str) -> Column:
        if name not in position:
            return F.col(name)
        found = F.col(f"_t{position[name]}")
        merged = merge_tags(found, separator, F.col(name) if add_mode == "append" else None)
        return F.when(F.size(found) > 0, merged).otherwise(F.col(name))

    return joined.select(*[written(c).alias(c) for c in rows.columns])


def apply_actions(
    rows: DataFrame,
    key: str,
    hits: DataFrame,
    label_columns: list[str],
    separator: str = ", ",
    add_mode: str = "tags",
) -> DataFrame:
    """DELETE, then REPLACE, then ADD, as one aggregation of the hits and one join."""
    found = _gather(hits, label_columns, (ADD, REPLACE, DELETE))
    names = {c: free_name(f"_{c}", rows.columns) for c in found.columns if c != "id"}
    found = found.select(F.col("id").alias(key), *[F.col(c).alias(n) for c, n in names.items()])
    joined = rows.join(found, key, "left").filter(~F.coalesce(names["is_deleted"], F.lit(False)))
    position = {c: i for i, c in enumerate(label_columns)}

    def after(name: str) -> Column:
        current = F.col(quoted(name))
        if name not in position:
            return current
        i = position[name]
        return _written(F.coalesce(names[f"r{i}"], current), F.col(names[f"t{i}"]), separator, add_mode)

    return joined.select(*[after(c).alias(c) for c in rows.columns])
