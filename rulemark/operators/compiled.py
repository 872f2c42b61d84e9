"""Compile a rule dictionary against the columns of a table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulemark.errors import RuleError
from rulemark.functions.names import clean_names
from rulemark.operators import keys, rules as r
from rulemark.options import LabelOptions
from rulemark.sources.storage import delete_folder, materialize, shared_folder

#: Dictionaries up to this size are compiled once and kept as a local table.
LOCAL_RULES = 10_000
LOCAL_BYTES = 4 * 1024 * 1024
#: and terms up to this: a term has an option for each of its characters, some 16 times its size.
LOCAL_TERMS = 1024 * 1024
#: Columns of resolved ids beside the labels.
RESERVED = {"id", "is_deleted"}


@dataclass(frozen=True)
class CompiledRules:
    """A dictionary ready to be matched."""

    #: rule_id, test, action, match, search, term, labels STRUCT; rules of the same match, search and
    #: term are one test, which has the number of the first of them
    rules: DataFrame
    #: one row per clause and block key of each test
    keyed: DataFrame
    #: rule_id, reason of rules left out
    rejected: DataFrame
    label_columns: list[str]
    #: columns named by any rule, in table order
    search_columns: list[str]
    #: column -> key class -> keys in use, or None when they are many
    key_classes: dict[str, dict[str, list[str] | None]]
    actions: frozenset[str]
    #: kinds of check in use, see matching.pair_matches
    kinds: frozenset[str]
    single_clause: bool
    #: the largest number of a clause in its rule
    most_clauses: int
    broadcastable: bool
    options: LabelOptions
    #: have several rules the same test?
    shared: bool = False
    #: folders that hold the tables of a dictionary too large to be kept locally
    stored: tuple[str, ...] = ()

    #: says so once the rules are released
    _state: dict = field(default_factory=dict, repr=False, compare=False)

    def release(self) -> None:
        """Give up the rules and delete what is stored of them: they cannot be used afterwards.

        The same for a dictionary of any size; who compiles rules releases them when the last result is
        written, or uses ``with compile_rules(...) as rules``.
        """
        self._state["released"] = True
        for path in self.stored:
            delete_folder(self.rules.sparkSession, path)

    def usable(self) -> CompiledRules:
        """The rules, unless they are released."""
        if self._state:
            raise RuleError("these rules are released")
        return self

    def __enter__(self) -> CompiledRules:
        return self.usable()

    def __exit__(self, *_) -> None:
        self.release()


def compile_rules(
    raw: DataFrame,
    columns: list[str],
    order_by: list[str],
    options: LabelOptions = LabelOptions(),
    data: DataFrame | None = None,
) -> CompiledRules:
    """Compile ``raw`` for a table with ``columns``.

    ``order_by`` gives the rule order and must be unique; the other columns of
    ``raw`` are the dictionary, taken by position. With ``data`` (the table, or a part of it that is
    like it) rules are keyed by what is rare there, for one more scan of the columns they
    name; without, by what is rare among the rules. The hits are the same.

    A dictionary of any size needs the folder in ``spark.checkpoint.dir`` on a cluster, as a long one is
    stored there, and its owner releases it (``CompiledRules.release``).
    """
    shared_folder(raw.sparkSession)
    at = options.rule_columns
    names = [c for c in raw.columns if c not in order_by]
    control, payload = r.split_columns(names, at)
    action, match = (F.col(f"`{c}`").cast("string") for c in control[:2])
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in names), F.lit(64))
    term = F.coalesce(F.octet_length(F.col(f"`{control[3]}`").cast("string")), F.lit(0))
    seen = raw.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(width), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(term), F.lit(0)).alias("terms"),
        *[F.coalesce(F.max(action == a), F.lit(False)).alias(a) for a in (r.ADD, r.REPLACE, r.DELETE)],
        F.coalesce(F.max(match == r.TEXT), F.lit(False)).alias("text"),
        F.coalesce(F.max(match != r.TEXT), F.lit(False)).alias("like"),
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(payload)],
    ).first()
    kept = [c for i, c in enumerate(payload) if seen[f"c{i}"]]
    label_columns = clean_names(*columns, *kept)[len(columns) :]
    if RESERVED & {c.lower() for c in label_columns}:
        raise RuleError(f"label columns cannot be named {sorted(RESERVED)}: {label_columns}")

    small = seen["n"] <= LOCAL_RULES and seen["bytes"] <= LOCAL_BYTES and seen["terms"] <= LOCAL_TERMS
    stored: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        """The table as computed once, for the several uses it has."""
        if small:
            return local_copy(df)
        copy, path = materialize(df, "rules")
        stored.append(path)
        return copy

    test = F.min("rule_id").over(Window.partitionBy("match", "search", "term"))
    numbered = r.rule_table(raw, order_by, at, label_columns, kept, count=seen["n"])
    table = keep(numbered.select("rule_id", test.alias("test"), *numbered.columns[1:]))
    first = F.col("rule_id") == F.col("test")
    n_tests = table.filter(first).count()

    # rules may name label columns too; those are empty when rules are matched
    named = [*columns, *label_columns]
    like, text = r.split_by_match(table)
    in_table = F.col("column_name").isin(columns)
    searched, rejected, parts = [], [], []
    if seen["like"] or not seen["text"]:
        like = r.like_patterns(r.resolve_columns(like, named, options.on_bad_rule))
        bad = like.filter(F.col("search").try_cast("bigint").isNull())
        rejected.append(bad.select("rule_id", F.lit("search index is not a number").alias("reason")))
        searched.append(like.select("column_name"))
        parts.append(keys.like_clauses(like.filter(first)))
    if seen["text"]:
        clauses = keep(r.text_clauses(text, named, options.fts_separator))
        bad = clauses.filter(F.col("reason").isNotNull())
        rejected.append(bad.select("rule_id", "reason").distinct())
        searched.append(clauses.select("column_name"))
        tested = clauses.join(table.filter(first).select("rule_id"), "rule_id", "left_semi") if n_tests < seen["n"] else clauses
        parts.append(keys.token_clauses(tested))
    searched, rejected, parts = (reduce(DataFrame.unionByName, x) for x in (searched, rejected, parts))
    parts = keep(parts.filter(in_table))
    sketch = None if data is None else _sketch(data, parts, options)
    keyed = keep(keys.choose_keys(parts, n_tests, sketch))

    found = {row[0] for row in searched.filter(in_table).distinct().collect()}
    key_classes, size = _measure(keyed, options.probe_limit)
    return CompiledRules(
        rules=table,
        keyed=keyed,
        rejected=rejected,
        label_columns=label_columns,
        search_columns=[c for c in columns if c in found],
        key_classes={c: key_classes[c] for c in columns if c in key_classes},
        actions=frozenset(a for a in (r.ADD, r.REPLACE, r.DELETE) if seen[a]),
        kinds=frozenset(size["kinds"]),
        most_clauses=size["last"],
        single_clause=size["clauses"] <= 1 and not size["repeated"],
        broadcastable=max(size["bytes"], seen["bytes"]) <= options.broadcast_bytes,
        options=options,
        shared=n_tests < seen["n"],
        stored=tuple(stored),
    )


def _sketch(data: DataFrame, clauses: DataFrame, options: LabelOptions) -> DataFrame:
    """How many values of the data hold the keys that clauses may choose among."""
    from rulemark.operators.matching import values_of

    several = clauses.filter(F.size("options") > 1).select("column_name", F.explode("options.class").alias("class")).distinct()
    classes: dict[str, list[str]] = {}
    for row in sorted(several.collect()):  # a few classes of each column
        classes.setdefault(row["column_name"], []).append(row["class"])
    return keys.key_sketch(values_of(data, classes, options.case), classes)


def local_copy(df: DataFrame) -> DataFrame:
    """The same rows as a local table in one partition; only for data measured to be small."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema).coalesce(1)


def _measure(keyed: DataFrame, probe_limit: int):
    """Key classes per column, with the keys where they are few, and sizes."""
    by_class = Window.partitionBy("column_name", "class").orderBy("key")
    few = (
        keyed.select("column_name", "class", "key")
        .distinct()
        .withColumn("n", F.row_number().over(by_class))
        .filter(F.col("n") <= probe_limit + 1)
        .collect()
    )
    classes: dict[str, dict[str, list[str] | None]] = {}
    for row in sorted(few):
        classes.setdefault(row["column_name"], {}).setdefault(row["class"], []).append(row["key"])
    for by_name in classes.values():
        for name, in_use in by_name.items():
            if len(in_use) > probe_limit or name[0] not in "gtx":
                by_name[name] = None

    lists = ("all_of", "any_of", "none_of")
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("needle", "block_key")), F.lit(128))
    width = sum((F.coalesce(F.octet_length(F.array_join(c, " ")), F.lit(0)) for c in lists), width)
    size = keyed.agg(
        F.coalesce(F.sum(width), F.lit(0)).alias("bytes"),
        F.collect_set("kind").alias("kinds"),
        F.coalesce(F.max("n_clauses"), F.lit(0)).alias("clauses"),
        F.coalesce(F.max("clause_no"), F.lit(0)).alias("last"),
        F.coalesce(F.max(F.size("any_of") > 0), F.lit(False)).alias("repeated"),
    ).first()
    return classes, size
