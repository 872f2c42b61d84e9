"""Block keys: the strings on which rules and data values are joined.

A value can only match a rule if it holds the rule's key, so every kind of
match becomes an equi-join followed by a check of the pair:

====== ============================ ==========================================
class  rule key                     value keys
====== ============================ ==========================================
f      the term                     the value
s<k>   first k characters           its first k characters
e<k>   last k characters            its last k characters
g<k>   one run of k characters      all its runs of k characters
t      one token                    all its tokens
x<k>   first k characters of a      first k characters of all its tokens
       token given as prefix
l      length of a pattern of       its length
       blanks (``_``) alone
v      length, place and character  length, place and character of each of
       of a pattern without ``%``   its characters
       whose runs are short
m      least length of a pattern    0 and the powers of 2 up to its length
       of blanks and ``%``, down to
       a power of 2
====== ============================ ==========================================

Only a pattern that every value matches (``%``) has a key that every value holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemark.functions import text
from rulemark.operators.rules import ENDS, FULL, STARTS

EDGE_SIZES = (16, 8, 4, 2, 1)
GRAM_SIZES = (3, 2, 1)
PREFIX_SIZES = (8, 4, 2, 1)
#: Keys counted to find the rarest, a bound of what is broadcast for it.
COUNTED = 100_000
#: Cells of the sketch that counts keys in the data, a bound of its rows.
SKETCH_CELLS = 1 << 18

OPTION = "struct<alternative:int,class:string,key:string>"
CLAUSE = ["rule_id", "clause_no", "n_clauses", "column_name", "kind", "needle",
          "all_of", "any_of", "none_of", "near"]


def _option(klass: Column, key: Column, alternative: Column | None = None) -> Column:
    alternative = F.lit(0) if alternative is None else alternative
    return F.struct(
        alternative.cast("int").alias("alternative"), klass.alias("class"), key.alias("key")
    )


def _powers(most: Column) -> Column:
    """0 and the powers of 2 up to a number."""
    return F.filter(F.array(*[F.lit(n) for n in (0, *(1 << k for k in range(31)))]), lambda n: n <= most)


def _size_of(value: Column, sizes: tuple[int, ...]) -> Column:
    """The largest of ``sizes`` that fits the value, 0 if none fits."""
    return F.array_max(F.filter(F.array(*map(F.lit, (*sizes, 0))), lambda k: k <= F.length(value)))


def like_clauses(like_rules: DataFrame) -> DataFrame:
    """LIKE rules (with ``pattern`` and ``column_name``) as clauses with key options."""
    upper_term = F.upper("term")
    wild = upper_term.rlike("[%_]")
    # the longest literal run of a wildcard pattern
    runs = F.transform(F.split(upper_term, "[%_]"), lambda r: F.struct(F.length(r).alias("n"), r.alias("run")))
    usable = like_rules.filter(F.col("pattern").isNotNull() & F.col("column_name").isNotNull())
    held = usable.select(
        "rule_id",
        "column_name",
        F.when(wild, "w").otherwise(F.col("match")).alias("kind"),
        F.when(wild, text.like_literal(F.col("pattern"))).otherwise(upper_term).alias("needle"),
        F.when(wild, F.array_max(runs)["run"]).otherwise(upper_term).alias("literal"),
        "pattern",
    )
    literal, kind = F.col("literal"), F.col("kind")
    pattern = F.upper("pattern")
    blanks = F.length(F.regexp_replace("pattern", "[^_]", ""))
    fixed_length = (kind == "w") & ~F.contains(pattern, F.lit("%"))
    first_letter = F.length(F.regexp_extract("pattern", "^(_*)", 1)) + 1
    place = F.concat_ws(":", F.length(pattern), first_letter, F.substring(pattern, first_letter, F.lit(1)))
    power = F.array_max(_powers(blanks))
    at_edge = kind.isin(STARTS, ENDS)
    sized = held.withColumn(
        "size",
        F.when(kind == FULL, F.lit(-1))
        .when(at_edge, _size_of(literal, EDGE_SIZES))
        .otherwise(_size_of(literal, GRAM_SIZES)),
    )
    size = F.col("size")
    edge = F.when(kind == STARTS, F.left(literal, size)).otherwise(F.right(literal, size))
    options = (
        F.when((size == 0) & fixed_length, F.array(_option(F.lit("l"), F.length(pattern).cast("string"))))
        .when(size == 0, F.array(_option(F.lit("m"), power.cast("string"))))
        .when(fixed_length & (size < GRAM_SIZES[0]), F.array(_option(F.lit("v"), place)))
        .when(kind == FULL, F.array(_option(F.lit("f"), literal)))
        .when(at_edge, F.array(_option(F.concat(kind, size), edge)))
        .otherwise(
            F.transform(text.grams(literal, size), lambda g: _option(F.concat(F.lit("g"), size), g))
        )
    )
    no_items = F.lit(None).cast("array<string>")
    return sized.select(
        "rule_id",
        F.lit(1).alias("clause_no"),
        F.lit(1).alias("n_clauses"),
        "column_name",
        "kind",
        "needle",
        *[no_items.alias(c) for c in ("all_of", "any_of", "none_of")],
        F.lit(None).cast("int").alias("near"),
        options.cast(f"array<{OPTION}>").alias("options"),
    )


def _item_options(item: Column, alternative: Column) -> Column:
    """Key options of one padded item: its whole tokens, and a prefix if its end is open."""
    words = F.split(F.trim(F.ltrim(item, F.lit(text.START))), " ")
    open_end = ~item.endswith(" ")
    whole = F.when(open_end, F.slice(words, 1, F.size(words) - 1)).otherwise(words)
    last = F.element_at(words, -1)
    size = _size_of(last, PREFIX_SIZES)
    prefix = _option(F.concat(F.lit("x"), size), F.left(last, size), alternative)
    return F.concat(
        F.transform(F.array_distinct(whole), lambda w: _option(F.lit("t"), w, alternative)),
        F.when(open_end, F.array(prefix)).otherwise(F.array().cast(f"array<{OPTION}>")),
    )


def token_clauses(clauses: DataFrame) -> DataFrame:
    """Usable text clauses (see ``rules.text_clauses``) with their key options.

    A clause that needs all its items may use any of their keys; one that needs
    any item has one set of options per item.
    """
    items = F.size("all_of") + F.size("any_of")
    usable = clauses.filter(F.col("reason").isNull()).withColumn("_items", items)
    per_rule = usable.groupBy("rule_id").agg(
        F.count_if(F.col("_items") > 0).cast("int").alias("n_clauses")
    )
    # a rule one clause of which is unusable is unusable as a whole
    broken = clauses.filter(F.col("reason").isNotNull()).select("rule_id").distinct()
    kept = (
        usable.filter(F.col("_items") > 0)
        .join(per_rule, "rule_id")
        .join(broken, "rule_id", "left_anti")
    )
    one_phrase = (
        (F.size("all_of") == 1) & (F.size("any_of") == 0) & (F.size("none_of") == 0) & F.col("near").isNull()
    )
    required = F.flatten(F.transform("all_of", lambda i: _item_options(i, F.lit(0))))
    alternatives = F.flatten(F.transform("any_of", lambda i, n: _item_options(i, n)))
    return kept.select(
        "rule_id",
        "clause_no",
        "n_clauses",
        "column_name",
        F.when(one_phrase, "phrase").when(F.col("near").isNotNull(), "near").otherwise("items").alias("kind"),
        F.when(one_phrase, F.get("all_of", F.lit(0))).alias("needle"),
        "all_of",
        "any_of",
        "none_of",
        "near",
        F.when(F.size("all_of") > 0, required).otherwise(alternatives).alias("options"),
    )


def cell(klass: Column, key: Column, column: Column) -> Column:
    """The cell of the sketch that counts a key."""
    return F.pmod(F.xxhash64(column, klass, key), F.lit(SKETCH_CELLS)).cast("int")


def _cells_of(klass: str) -> Column:
    """The cells of a value's keys."""
    tagged = value_keys(F.col("folded"), F.col("padded"), klass, None)
    key = lambda t: F.substr(t, F.lit(len(klass) + 2))
    return F.array_distinct(F.transform(tagged, lambda t: cell(F.lit(klass), key(t), F.col("column_name"))))


def key_sketch(values: DataFrame, classes: dict[str, list[str]]) -> DataFrame:
    """``cell, held``: how many values hold the keys of a cell, in one scan of ``values``.

    Keys share at most ``SKETCH_CELLS`` cells, so the table is bounded whatever the data; it is merged
    by adding. Keys of one cell are counted together: a count is never too small.
    """
    none, found = F.array().cast("array<int>"), F.array().cast("array<int>")
    for name, in_use in classes.items():
        arrays = []
        for klass in in_use:
            arrays.append(F.coalesce(_cells_of(klass), none))
        found = F.when(F.col("column_name") == name, F.concat(*arrays)).otherwise(found)
    return values.select(F.explode(found).alias("cell")).groupBy("cell").agg(F.count("*").alias("held"))


def choose_keys(clauses: DataFrame, n_rules: int, sketch: DataFrame | None = None) -> DataFrame:
    """One row per clause and key, with the rarest option of each alternative as key.

    Rarest is what the fewest values of the data hold by a ``sketch``, then what the fewest rules share.

    Only options shared by more than a thousandth of the rules are counted, and by
    more than one of ``COUNTED`` parts of all options: the count table has fewer than
    ``COUNTED`` rows, whatever the length of the terms, and is broadcast.
    """
    options = clauses.select("rule_id", "clause_no", "column_name", F.explode("options").alias("o")).select(
        "rule_id", "clause_no", "column_name", "o.*"
    )
    by_key = ["column_name", "class", "key"]
    frequent = options.groupBy(*by_key).agg(F.count("*").alias("n"))
    share = frequent.agg(F.sum("n")).scalar() / F.lit(COUNTED)
    frequent = frequent.filter((F.col("n") > F.lit(n_rules // 1000)) & (F.col("n") > share))
    held = F.lit(0)
    if sketch is not None:
        options = options.withColumn("cell", cell(F.col("class"), F.col("key"), F.col("column_name")))
        options = options.join(F.broadcast(sketch), "cell", "left").drop("cell")  # at most SKETCH_CELLS rows
        held = F.coalesce("held", F.lit(0))
    rank = F.struct(
        held, F.coalesce("n", F.lit(0)), F.col("class").startswith("x"), F.xxhash64("key"), F.col("key")
    )
    chosen = (
        options.join(F.broadcast(frequent), by_key, "left")
        .groupBy("rule_id", "clause_no", "alternative")
        .agg(F.min_by(F.struct("class", "key"), rank).alias("k"))
        .select("rule_id", "clause_no", F.col("k.class").alias("class"), F.col("k.key").alias("key"))
        .distinct()
    )
    return clauses.drop("options").join(chosen, ["rule_id", "clause_no"]).select(
        *CLAUSE, "class", "key", block_key(F.col("class"), F.col("key")).alias("block_key")
    )


def block_key(klass: Column, key: Column) -> Column:
    return F.concat(klass, F.lit(":"), key)


def value_keys(folded: Column, padded: Column, klass: str, probes: list[str] | None) -> Column:
    """Array of a value's block keys of one class.

    With ``probes`` (all keys in use, when they are few) the value is searched
    for each of them; otherwise every key it holds is generated.
    """
    tagged = lambda key: F.concat(F.lit(f"{klass}:"), key)
    kind, size = klass[0], int(klass[1:] or 0)
    if kind == "l":
        return F.array(tagged(F.length(folded).cast("string")))
    if kind == "m":
        return F.transform(_powers(F.length(folded)), lambda p: tagged(p.cast("string")))
    if kind == "v":
        at = F.sequence(F.lit(1), F.length(folded))
        keys = F.transform(at, lambda p: tagged(F.concat_ws(":", F.length(folded), p, F.substring(folded, p, F.lit(1)))))
        return F.when(F.length(folded) > 0, keys)
    if kind == "f":
        return F.array(tagged(folded))
    if kind in "se":
        cut = F.left if kind == "s" else F.right
        return F.when(F.length(folded) >= size, F.array(tagged(cut(folded, F.lit(size)))))
    if probes is not None:
        found = {
            "g": lambda key: F.contains(folded, F.lit(key)),
            "t": lambda key: F.contains(padded, F.lit(f" {key} ")),
            "x": lambda key: F.contains(padded, F.lit(f" {key}")),
        }[kind]
        return F.array_compact(F.array(*[F.when(found(k), F.lit(f"{klass}:{k}")) for k in probes]))
    if kind == "g":
        return F.transform(text.grams(folded, F.lit(size)), tagged)
    words = F.split(F.trim(F.ltrim(padded, F.lit(text.START))), " ")
    if kind == "x":
        words = F.transform(F.filter(words, lambda w: F.length(w) >= size), lambda w: F.left(w, F.lit(size)))
    return F.transform(F.array_distinct(words), tagged)
