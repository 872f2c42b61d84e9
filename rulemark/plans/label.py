"""The whole job on DataFrames: snapshot, match, resolve, carry back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemark.errors import SettingsError
from rulemark.functions.names import free_name, quoted
from rulemark.operators.actions import resolve, resolve_tests, tag_table
from rulemark.operators.compiled import CompiledRules
from rulemark.operators.matching import all_rules, match_tests, with_payload
from rulemark.operators.skew import adaptive_split, hot_keys, join_per_key
from rulemark.operators.snapshot import latest_per_key
from rulemark.operators.sync import unmapped_rows


@dataclass(frozen=True)
class LabelResult:
    """Results of a labelling job, all lazy: they need the rules until they are written."""

    #: all rows of ids that were not deleted, with their labels
    labelled: DataFrame
    #: distinct search and label values that still lack a label
    unmapped: DataFrame
    #: id, column_name, value of the ADD rules
    tags: DataFrame
    #: id, rule_id
    hits: DataFrame
    #: id, is_deleted, labels of every id with hits
    resolved: DataFrame


def snapshot_of(
    data: DataFrame,
    rules: CompiledRules,
    id_column: str,
    date_column: str | None = None,
    tiebreak: tuple[str, ...] = (),
) -> DataFrame:
    """One row per id with the columns any rule looks at."""
    if id_column not in data.columns:
        raise SettingsError(f"id column {id_column!r} is not in {data.columns}")
    return latest_per_key(data, id_column, rules.search_columns, date_column, tiebreak)


def resolved_of(tests: DataFrame, rules: CompiledRules) -> DataFrame:
    """``id, is_deleted, labels`` of every id with hits, from the tests of the ids (``match_tests``)."""
    if rules.shared:
        return resolve_tests(tests, rules)
    options = rules.options
    paid = with_payload(tests, rules)  # a test has one rule, of the same number
    return resolve(paid, rules.label_columns, options.add_separator, options.add_mode, rules.actions, rules)


def carry_back(
    data: DataFrame,
    resolved: DataFrame,
    rules: CompiledRules,
    id_column: str,
    hot: DataFrame | None = None,
    broadcast: bool = False,
) -> DataFrame:
    """Give every row the labels of its id; drop deleted ids and rows without id.

    ``broadcast`` is for a ``resolved`` measured to be small, ``hot`` splits
    frequent ids (``skew.join_per_key``).
    """
    deleted = free_name("_is_deleted", data.columns, resolved.columns)
    per_id = _by_id(resolved, id_column, deleted)
    rows = data.filter(F.col(quoted(id_column)).isNotNull())
    if broadcast:
        joined = rows.join(F.broadcast(per_id), id_column, "left")
    else:
        joined = join_per_key(rows, per_id, [id_column], "left", hot)
    labelled = _undeleted(joined, deleted).select(*map(quoted, [*data.columns, *rules.label_columns]))
    if not rules.options.keep_null_ids:
        return labelled
    without = data.filter(F.col(quoted(id_column)).isNull())
    return labelled.unionByName(
        without.withColumns({c: F.lit(None).cast("string") for c in rules.label_columns})
    )


def _by_id(resolved: DataFrame, id_column: str, deleted: str) -> DataFrame:
    # the data may have a column is_deleted of its own
    return resolved.withColumnsRenamed({"id": id_column, "is_deleted": deleted})


def _undeleted(rows: DataFrame, deleted: str) -> DataFrame:
    return rows.filter(~F.coalesce(deleted, F.lit(False)))


def label_table(
    data: DataFrame,
    rules: CompiledRules,
    id_column: str,
    date_column: str | None = None,
    tiebreak: tuple[str, ...] = (),
) -> LabelResult:
    """Label ``data`` by the rules that match the latest row of each id.

    The rules are the caller's: release them when the results are written.
    """
    options = rules.options
    snapshot = snapshot_of(data, rules, id_column, date_column, tiebreak)
    tests = match_tests(snapshot, id_column, rules)
    hits = all_rules(tests, rules)
    resolved = resolved_of(tests, rules)
    # both have one row per id and are partitioned by it
    deleted = free_name("_is_deleted", snapshot.columns, resolved.columns)
    labelled_snapshot = _undeleted(snapshot.join(_by_id(resolved, id_column, deleted), id_column, "left"), deleted)
    # counting the ids costs a scan: only where adaptive execution does not split
    hot = None
    if options.hot_id_rows and not adaptive_split(data):
        hot = hot_keys(data, [id_column], options.hot_id_rows)
    return LabelResult(
        labelled=carry_back(data, resolved, rules, id_column, hot),
        unmapped=unmapped_rows(
            labelled_snapshot, rules.search_columns, rules.label_columns, options.unmapped_mode
        ),
        tags=tag_table(with_payload(hits, rules), rules.label_columns),
        hits=hits,
        resolved=resolved,
    )
