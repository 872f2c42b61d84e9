"""The whole job on a report folder: read, label, export."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rulemark.errors import SettingsError
from rulemark.functions.names import clean_names
from rulemark.operators.compiled import CompiledRules, compile_rules
from rulemark.operators.matching import match_tests
from rulemark.operators.skew import hot_of
from rulemark.operators.snapshot import detect_date_column, latest_per_key
from rulemark.operators.sync import unmapped_rows
from rulemark.options import FolderOptions, LabelOptions
from rulemark.plans.label import carry_back, resolved_of
from rulemark.sources.dictionary import ORDER, get_dictionary
from rulemark.sources.export import Export, export_csv
from rulemark.sources.files import FILE, LOAD_ORDER, PART, first_file, read_files, read_folder, read_header
from rulemark.sources.storage import delete_folder, detached, materialize

# columns of a resolved snapshot beside the id, the searched columns and the labels
ROWS, DELETED = "_rows", "_is_deleted"


@dataclass(frozen=True)
class FolderResult:
    #: rows read from the data files
    rows_read: int
    labelled: Export
    unmapped: Export
    date_column: str | None
    #: rule_id, reason of rules left out
    rejected: DataFrame


def choose_date_column(spark: SparkSession, options: FolderOptions, folder: str) -> str | None:
    """The date column, judged by the first rows of the first file."""
    sample = first_file(spark, folder, options.data_extension, options.read.include_subfolders)
    header = read_header(spark, sample, options.read)
    names = clean_names(*header)
    preferred = dict(zip(header, names)).get(options.date_column, options.date_column)
    # the rows of its first part, in which they are read in order
    first = read_files(spark, sample, names, options.read).filter(F.col(PART) == 0).drop(FILE, *LOAD_ORDER)
    return detect_date_column(first, preferred)


def resolved_snapshot(
    data: DataFrame,
    rules: CompiledRules,
    id_column: str,
    date_column: str | None,
    tiebreak: tuple[str, ...],
) -> DataFrame:
    """The snapshot with its deletions (``_is_deleted``), labels and the number of source rows of each id."""
    snapshot = latest_per_key(data, id_column, rules.search_columns, date_column, tiebreak, count_as=ROWS)
    # always true; it keeps the count in both uses of the snapshot below, which are
    # then the same shuffle and made in one scan
    snapshot = snapshot.filter(F.col(ROWS) > 0)
    resolved = resolved_of(match_tests(snapshot, id_column, rules), rules).withColumnsRenamed({"id": id_column, "is_deleted": DELETED})
    joined = snapshot.join(resolved, id_column, "left")
    return joined.withColumn(DELETED, F.coalesce(DELETED, F.lit(False)))


def labelled_rows(
    data: DataFrame, state: DataFrame, rules: CompiledRules, id_column: str
) -> DataFrame:
    """Carry a materialized ``resolved_snapshot`` back to all rows.

    Only ids with something to tell are joined. They are broadcast if their
    measured size allows, else joined by id with the frequent ids split.
    """
    labels = [F.col(f"`{c}`") for c in rules.label_columns]
    told = F.col(DELETED)
    width = F.lit(64) + F.octet_length(F.col(id_column).cast("string"))
    for label in labels:
        told = told | label.isNotNull()
        width = width + F.coalesce(F.octet_length(label), F.lit(0))
    per_id = state.filter(told).select(F.col(id_column).alias("id"), F.col(DELETED).alias("is_deleted"), *labels)
    size = state.filter(told).agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    if size <= rules.options.broadcast_bytes:
        return carry_back(data, per_id, rules, id_column, broadcast=True)
    split = rules.options.hot_id_rows
    hot = None
    if split:
        hot = hot_of(state.select(id_column, F.col(ROWS).alias("_n")), [id_column], split)
    return carry_back(data, per_id, rules, id_column, hot)


def label_folder(
    spark: SparkSession, base: str, options: FolderOptions, at: datetime | None = None
) -> FolderResult:
    """Label the files of ``base`` and export all rows and the unmapped values.

    ``base`` holds the data, dictionary and export folders named in ``options``.
    The resolved snapshot is written once to the shared folder and read by both
    exports; the source is scanned twice, for the snapshot and for the rows.
    """
    base = base.rstrip("/")
    folder = f"{base}/{options.import_folder}"
    data = read_folder(spark, folder, options.data_extension, options.read)
    columns = [c for c in data.columns if c not in (FILE, *LOAD_ORDER)]
    date_column = choose_date_column(spark, options, folder)
    id_column = clean_names(options.id_column)[0]
    if id_column not in columns:
        raise SettingsError(f"id column {options.id_column!r} is not in {columns}")

    dictionary = get_dictionary(
        spark, f"{base}/{options.dict_folder}", options.dict_name, options.dict_extension, options.read
    )
    rules = compile_rules(dictionary, columns, ORDER, options.label)
    used = [id_column, *rules.search_columns, *([date_column] if date_column else []), *LOAD_ORDER]
    read = Observation()
    counted = data.select(*dict.fromkeys(used)).observe(read, F.count(F.lit(1)).alias("rows"))
    snapshot = resolved_snapshot(counted, rules, id_column, date_column, LOAD_ORDER)
    paths = list(rules.stored)
    try:
        state, state_path = materialize(snapshot, "snapshot")
        paths.append(state_path)
        kept = state.filter(~F.col(DELETED))
        unmapped = unmapped_rows(kept, rules.search_columns, rules.label_columns, options.label.unmapped_mode)
        null_data = export_csv(unmapped, base, "null_data", options.write, at)
        rows = labelled_rows(data.select(*columns), state, rules, id_column)
        labelled = export_csv(rows, f"{base}/{options.export_folder}", options.table_name, options.write, at)
        rejected = detached(rules.rejected) if rules.stored else rules.rejected
    finally:
        for path in paths:
            delete_folder(spark, path)
    return FolderResult(read.get["rows"], labelled, null_data, date_column, rejected)
