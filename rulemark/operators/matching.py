"""Match compiled rules to values: one keyed join, then a check of every pair."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.functions import text
from rulemark.operators import keys
from rulemark.operators.compiled import CompiledRules
from rulemark.operators.skew import join_lists, join_many, join_small

TEXT_CLASSES = ("t", "x")
#: Characters up to which the texts of an id go with each of their keys. Such a key takes no more than
#: three times the place, and its pairs are checked where they meet.
SHORT = 64


def _is_text(klass: str) -> bool:
    return klass[0] in TEXT_CLASSES


def values_by_column(snapshot: DataFrame, id_column: str, rules: CompiledRules) -> DataFrame:
    """One row per id and searched column that holds a value.

    ``folded`` is the value for LIKE rules, ``padded`` its tokens for text rules;
    each only where rules need it.
    """
    return values_of(snapshot, rules.key_classes, rules.options.case, F.col(f"`{id_column}`").alias("id"))


def values_of(rows: DataFrame, key_classes: dict, case: str, *kept: Column) -> DataFrame:
    """``kept, column_name, folded, padded`` of the columns in ``key_classes``, with what their classes need."""
    per_column = []
    nothing = F.lit(None).cast("string")
    for name, classes in key_classes.items():
        value = F.col(f"`{name}`").cast("string")
        like = any(not _is_text(k) for k in classes)
        words = any(_is_text(k) for k in classes)
        per_column.append(
            F.struct(
                F.lit(name).alias("column_name"),
                (text.fold_case(value, case) if like else nothing).alias("folded"),
                (text.pad_tokens(text.tokens(value)) if words else nothing).alias("padded"),
            )
        )
    if not per_column:
        per_column.append(
            F.struct(nothing.alias("column_name"), nothing.alias("folded"), nothing.alias("padded"))
        )
    exploded = rows.select(*kept, F.explode(F.array(*per_column)).alias("v"))
    tall = exploded.select(*[c for c in exploded.columns if c != "v"], "v.*")
    return tall.filter(F.col("folded").isNotNull() | F.col("padded").isNotNull())


def _keys_of(rules: CompiledRules) -> Column:
    folded, padded = F.col("folded"), F.col("padded")
    none = F.array().cast("array<string>")
    result = none
    for name, classes in rules.key_classes.items():
        arrays = [
            F.coalesce(keys.value_keys(folded, padded, k, probes), none) for k, probes in classes.items()
        ]
        result = F.when(F.col("column_name") == name, F.concat(*arrays)).otherwise(result)
    return result


def _near(items: Column, padded: Column, distance: Column) -> Column:
    """Do all items occur with at most ``distance`` tokens between first and last?

    True if there is a place such that every item of n tokens starts there or at
    most n + distance tokens before. The starts of all items are passed once in
    order, with the last start of each item at hand, so the time does not grow
    with the distance.
    """
    words = F.split(F.trim(F.ltrim(padded, F.lit(text.START))), " ")
    never = F.lit(-(1 << 31)).cast("bigint")

    def starts(words: Column, item: Column, number: Column) -> Column:
        parts = F.split(F.trim(item), " ")
        n, first, closed = F.size(parts), F.element_at(parts, 1), item.endswith(" ")
        run = lambda p: F.concat(F.lit(" "), F.array_join(F.slice(words, p, n), " "), F.lit(" "))
        whole = lambda p: F.element_at(words, p) == first
        # words that cannot begin the item are told by the first word alone
        begins = lambda p: F.when(closed | (n > 1), whole(p)).otherwise(F.element_at(words, p).startswith(first))
        places = F.filter(F.sequence(F.lit(1), F.size(words)), lambda p: begins(p) & F.startswith(run(p), item))
        return F.transform(places, lambda p: F.struct(p.cast("bigint").alias("place"), number.alias("item")))

    def passed(state: Column, start: Column) -> Column:
        place = start["place"]
        last = F.transform(state["last"], lambda v, i: F.when(i == start["item"], place).otherwise(v))
        reach = F.zip_with(last, items, lambda at, item: at >= place - F.size(F.split(F.trim(item), " ")) - distance)
        return F.struct(last.alias("last"), (state["found"] | F.forall(reach, lambda ok: ok)).alias("found"))

    def holds(words: Column) -> Column:
        ordered = F.sort_array(F.flatten(F.transform(items, lambda item, i: starts(words, item, i))))
        none = F.struct(F.transform(items, lambda _: never).alias("last"), F.lit(False).alias("found"))
        return F.aggregate(ordered, none, passed, lambda state: state["found"])

    # the one-element array binds the words, so that they are split once per pair
    return F.exists(F.array(words), holds)


def pair_matches(rules: CompiledRules) -> Column:
    """Does the value of a joined row really match the clause?"""
    folded, padded, needle = F.col("folded"), F.col("padded"), F.col("needle")
    held = lambda item: F.contains(padded, item)
    items = (
        F.forall("all_of", held)
        & ((F.size("any_of") == 0) | F.exists("any_of", held))
        & ~F.exists("none_of", held)
    )
    checks = {
        "f": folded == needle,
        "s": folded.startswith(needle),
        "e": folded.endswith(needle),
        "p": F.contains(folded, needle),
        "w": F.like(folded, needle),
        "phrase": F.contains(padded, needle),
        "items": items,
    }
    if "near" in rules.kinds:
        checks["near"] = F.forall("all_of", held) & _near(F.col("all_of"), padded, F.col("near"))
    result = F.lit(False)
    for kind in sorted(rules.kinds):
        result = F.when(F.col("kind") == kind, checks[kind]).otherwise(result)
    return result


def candidates(values: DataFrame, rules: CompiledRules) -> DataFrame:
    """The pairs of a value and a clause that meet by a key, before they are checked: what keys cost."""
    probes = values.select("id", "column_name", F.explode(_keys_of(rules)).alias("block_key"))
    keyed = rules.keyed.select("column_name", "block_key", "rule_id", "clause_no")
    return join_many(probes, keyed, ["column_name", "block_key"], rules.options.hot_id_rows).select("id", "rule_id", "clause_no")


def match_clauses(values: DataFrame, rules: CompiledRules) -> DataFrame:
    """``id, rule_id, clause_no, n_clauses`` of every clause a value satisfies."""
    result = ["id", "rule_id", "clause_no", "n_clauses"]
    checks = [c for c in keys.CLAUSE if c != "column_name"]
    keyed = rules.keyed.select("column_name", "block_key", *checks)
    if rules.broadcastable:
        probes = values.select("*", F.explode(_keys_of(rules)).alias("block_key"))
        pairs = probes.join(F.broadcast(keyed), ["column_name", "block_key"])
        return pairs.filter(pair_matches(rules)).select(*result)

    # A dictionary too large to broadcast. Pairs outnumber values and rules by far, so those of
    # short texts are checked in the join that makes them and are never shuffled.
    split = rules.options.hot_id_rows
    texts = F.collect_list(F.struct("folded", "padded")).alias("texts")
    together = values.filter(F.col("id").isNotNull()).groupBy("id", "column_name").agg(texts)
    sizes = F.transform("texts", lambda t: sum(F.coalesce(F.length(t[c]), F.lit(0)) for c in ("folded", "padded")))
    size = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, n: total + n)
    apart = lambda rows: rows.select("id", "column_name", F.inline("texts"))

    short = together.filter(size <= SHORT)
    # a key of any text of an id is checked with all its texts
    held = short.select("id", "column_name", "texts", F.explode("texts").alias("t")).select("*", "t.*")
    probes = held.select("id", "column_name", "texts", F.explode(_keys_of(rules)).alias("block_key"))
    pairs = join_many(probes, keyed, ["column_name", "block_key"], split)
    found = pairs.select("*", F.inline("texts")).filter(pair_matches(rules)).select(*result)

    # Of long ones ids are joined by key, without the text, so that a key held by many
    # values can be split; then the text is fetched.
    long = apart(together.filter(size > SHORT))
    probes = long.select("id", "column_name", F.explode(_keys_of(rules)).alias("block_key"))
    pairs = join_many(probes, keyed, ["column_name", "block_key"], split).drop("block_key")
    fetched = join_many(pairs, long, ["id", "column_name"], split).filter(pair_matches(rules)).select(*result)
    return found.unionByName(fetched)


def match_rules(snapshot: DataFrame, id_column: str, rules: CompiledRules) -> DataFrame:
    """``hits(id, rule_id)``: every rule each row of a snapshot (one row per id) matches."""
    return all_rules(match_tests(snapshot, id_column, rules), rules)


def all_rules(tests: DataFrame, rules: CompiledRules) -> DataFrame:
    """The hits of all rules from those of tests (``match_tests``)."""
    if not rules.usable().shared:
        return tests
    tests, members = tests.withColumnRenamed("rule_id", "test"), rules.rules.select("test", "rule_id")
    if rules.broadcastable:
        return tests.join(F.broadcast(members), "test").select("id", "rule_id")
    return join_lists(tests, members, ["test"]).select("id", "rule_id")


def match_tests(snapshot: DataFrame, id_column: str, rules: CompiledRules) -> DataFrame:
    """``id, rule_id`` as ``match_rules``, but only the first of the rules that have the same test."""
    if rules.usable().options.dedupe_values:
        clauses = _match_distinct(snapshot, id_column, rules)
    else:
        clauses = match_clauses(values_by_column(snapshot, id_column, rules), rules)
    if rules.single_clause:
        # such a rule has one key, and the keys of a value differ: each pair comes up once
        return clauses.select("id", "rule_id")
    return all_clauses(clauses, rules.most_clauses)


#: Clauses whose numbers fit the bits of a long.
MASK = 63


def all_clauses(clauses: DataFrame, most: int) -> DataFrame:
    """``id, rule_id`` of the rules of which all clauses (numbered from 1) are satisfied.

    Clauses are bits of a mask, so repeated ones count once without a distinct count; rules of more than
    ``MASK`` clauses have several masks.
    """
    bit = F.expr(f"shiftleft(1L, cast((clause_no - 1) % {MASK} as int))")
    part = [] if most <= MASK else [F.floor((F.col("clause_no") - 1) / MASK).alias("part")]
    masks = clauses.groupBy("id", "rule_id", *part).agg(F.bit_or(bit).alias("mask"), F.max("n_clauses").alias("n_clauses"))
    held = F.bit_count("mask")
    if part:
        masks = masks.groupBy("id", "rule_id").agg(F.sum(held).alias("held"), F.max("n_clauses").alias("n_clauses"))
        held = F.col("held")
    return masks.filter(held == F.col("n_clauses")).select("id", "rule_id")


def _match_distinct(snapshot: DataFrame, id_column: str, rules: CompiledRules) -> DataFrame:
    """Match every distinct value of a column once, then give its matches to its ids."""
    names = list(rules.key_classes)
    cells = [
        F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("string").alias("value")) for n in names
    ]
    if not cells:
        return match_clauses(values_by_column(snapshot, id_column, rules), rules)
    tall = (
        snapshot.select(F.col(f"`{id_column}`").alias("id"), F.explode(F.array(*cells)).alias("c"))
        .select("id", "c.*")
        .filter(F.col("value").isNotNull())
    )
    distinct = tall.select("name", "value").distinct()
    wide = distinct.select(
        F.struct("name", "value").alias("_cell"),
        *[F.when(F.col("name") == n, F.col("value")).alias(n) for n in names],
    )
    matched = match_clauses(values_by_column(wide, "_cell", rules), rules)
    found = matched.select("id.name", "id.value", "rule_id", "clause_no", "n_clauses")
    joined = join_many(tall, found, ["name", "value"], rules.options.hot_id_rows)
    return joined.select("id", "rule_id", "clause_no", "n_clauses")


def with_payload(hits: DataFrame, rules: CompiledRules) -> DataFrame:
    """Hits with the action and labels of their rule."""
    payload = rules.usable().rules.select("rule_id", "action", "labels")
    return join_small(hits, payload, "rule_id", rules.broadcastable, rules.options.hot_id_rows)


def union_hits(*hits: DataFrame) -> DataFrame:
    """Hits of several matchers as one set."""
    return reduce(DataFrame.unionByName, hits).distinct()
