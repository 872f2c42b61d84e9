"""Options, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

from rulemark.errors import SettingsError


@dataclass(frozen=True)
class RuleColumns:
    """0-based positions of the control columns in a rule dictionary.

    Every column after the highest position is a label column.
    """

    action: int = 0
    match: int = 1
    search: int = 2
    term: int = 4

    def __post_init__(self):
        positions = self.positions()
        if min(positions) < 0 or len(set(positions)) != 4:
            raise SettingsError(f"control column positions must be distinct and >= 0: {positions}")

    def positions(self) -> list[int]:
        return [self.action, self.match, self.search, self.term]

    @property
    def first_label(self) -> int:
        return max(self.positions()) + 1


@dataclass(frozen=True)
class LabelOptions:
    """How rules are compiled, matched and applied."""

    rule_columns: RuleColumns = field(default_factory=RuleColumns)
    add_separator: str = ", "
    fts_separator: str = "|"
    #: "tags": ADD overwrites the value REPLACE set; "append": ADD extends it.
    add_mode: str = "tags"
    #: "ascii": data is folded a-z only; "unicode": data is upper-cased.
    case: str = "ascii"
    #: what a non-integer search index of a non-text rule does: "fail" or "skip".
    on_bad_rule: str = "fail"
    #: a row is unmapped when "any" or "all" of its labels are NULL.
    unmapped_mode: str = "any"
    #: keep rows without an id (never labelled) instead of dropping them.
    keep_null_ids: bool = False
    #: match each distinct value once; for label columns that repeat heavily.
    dedupe_values: bool = False
    #: rules are broadcast up to this measured size, joined with salt above it.
    broadcast_bytes: int = 64 * 1024 * 1024
    #: up to this many block keys per column and kind, values are probed for the
    #: keys directly; above it all keys of the value are generated.
    probe_limit: int = 32
    #: ids with more source rows than this are split when labels are joined back, and
    #: block keys with more values when rules are joined by shuffling, where
    #: their counts are at hand or adaptive execution does not split them.
    hot_id_rows: int | None = 1_000_000

    def __post_init__(self):
        for name, allowed in (
            ("add_mode", ("tags", "append")),
            ("case", ("ascii", "unicode")),
            ("on_bad_rule", ("fail", "skip")),
            ("unmapped_mode", ("any", "all")),
        ):
            if getattr(self, name) not in allowed:
                raise SettingsError(f"{name} must be one of {allowed}, got {getattr(self, name)!r}")


@dataclass(frozen=True)
class ReadOptions:
    """Delimited text input. Every column is read as text."""

    separator: str = ";"
    encoding: str = "utf-8"
    has_header: bool = True
    skip_rows: int = 0
    #: False: a malformed line fails the job; True: it is padded or cut to the schema.
    ignore_errors: bool = False
    #: quoted fields may contain line breaks.
    multi_line: bool = True
    #: read a plain file by many tasks even so (UTF-8, lines that end with a line feed);
    #: False reads it in one task.
    split_quoted: bool = True
    include_subfolders: bool = False


@dataclass(frozen=True)
class WriteOptions:
    """Delimited text output."""

    separator: str = ";"
    include_header: bool = True
    include_bom: bool = False
    chunk_size: int = 100_000
    compression: str | None = "gzip"


@dataclass(frozen=True)
class FolderOptions:
    """A report folder: where its data, dictionary and results lie."""

    id_column: str
    date_column: str | None = None
    import_folder: str = "raw_data"
    export_folder: str = "clean_data"
    dict_folder: str = "dict"
    dict_name: str = "merged_dictionary"
    data_extension: str = "gz"
    dict_extension: str = "csv"
    table_name: str = "data_table"
    read: ReadOptions = field(default_factory=ReadOptions)
    write: WriteOptions = field(default_factory=WriteOptions)
    label: LabelOptions = field(default_factory=LabelOptions)
