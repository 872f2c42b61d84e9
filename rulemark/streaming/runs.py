"""State of a stream as a few runs that are merged in tiers.

Every batch adds a run; ``fan`` runs of a tier are merged into one of the next, so after n batches
there are fewer than ``fan`` runs in each of log n tiers. A manifest per batch lists the runs
that hold the state after it. It is written last and under its name only when whole, so a batch that
fails at any point, merges included, leaves the state before it in force and runs again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulemark.errors import SettingsError
from rulemark.functions.names import quoted
from rulemark.sources.storage import delete_folder, file_names, read_text, write_text

MANIFESTS = "manifest"
#: Number of the batch a row of the state is from.
BATCH = "_batch"


@dataclass(frozen=True)
class Run:
    """The state that batches ``first`` to ``last`` left."""

    tier: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"tier-{self.tier}-batches-{self.first}-{self.last}"


class RunStore:
    """Tables of runs below ``folder``; each has one row per id and batch at most."""

    def __init__(self, spark: SparkSession, folder: str, tables: Iterable[str], fan: int = 8):
        if fan < 2:
            raise SettingsError(f"at least 2 runs are merged, not {fan}")
        self.spark, self.folder, self.tables, self.fan = spark, folder, tuple(tables), fan

    def path(self, table: str, run: Run) -> str:
        return f"{self.folder}/{table}/{run.name}"

    def _manifest(self, batch: int) -> str:
        return f"{self.folder}/{MANIFESTS}/{batch}.json"

    def batches(self) -> list[int]:
        """Batches that have a manifest, in order."""
        names = file_names(self.spark, f"{self.folder}/{MANIFESTS}")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def runs(self, batch: int) -> list[Run]:
        """Runs after a batch, oldest first."""
        return [Run(*r) for r in json.loads(read_text(self.spark, self._manifest(batch)))]

    def before(self, batch: int) -> list[Run]:
        """Runs that a batch builds on."""
        known = self.batches()
        if batch == 0:
            if any(b > 0 for b in known):
                raise SettingsError(f"{self.folder} holds the output of another stream")
            return []
        if batch - 1 not in known:
            raise SettingsError(f"{self.folder} has no state of batch {batch - 1}")
        return self.runs(batch - 1)

    def latest(self) -> list[Run]:
        known = self.batches()
        return self.runs(known[-1]) if known else []

    def read(self, table: str, runs: list[Run], schema) -> DataFrame:
        """Rows of the runs."""
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.path(table, r) for r in runs])

    def commit(self, batch: int, runs: list[Run], keys: dict[str, str], schemas: dict) -> list[Run]:
        """Merge what is to be merged after a batch, and put the result in force.

        ``runs`` are those before the batch and its own, written already.
        """
        runs, made = list(runs), [runs[-1]]
        while len(same := [r for r in runs if r.tier == runs[-1].tier]) >= self.fan:
            merged = Run(runs[-1].tier + 1, same[0].first, same[-1].last)
            for table in self.tables:
                newest_per_key(self.read(table, same, schemas[table]), keys[table]).write.mode("overwrite").parquet(self.path(table, merged))
            runs = [*runs[: -len(same)], merged]
            made.append(merged)
        write_text(self.spark, self._manifest(batch), json.dumps([[r.tier, r.first, r.last] for r in runs]))
        self._forget(batch, runs, made)
        return runs

    def _forget(self, batch: int, runs: list[Run], made: list[Run]) -> None:
        """Delete what neither this batch nor the one before needs: this one may have to run again."""
        needed = {*runs, *(self.runs(batch - 1) if batch else ())}
        old = [b for b in self.batches() if b < batch - 1]
        for run in {*made, *(r for b in old for r in self.runs(b))} - needed:
            for table in self.tables:
                delete_folder(self.spark, self.path(table, run))
        for b in old:
            delete_folder(self.spark, self._manifest(b))


def newest_per_key(rows: DataFrame, key: str) -> DataFrame:
    """Of the rows of each key those of the last batch.

    Only key and batch number are aggregated, in place; the rows are fetched by a join.
    """
    newest = rows.groupBy(quoted(key)).agg(F.max(BATCH).alias(BATCH))
    return rows.join(newest, [key, BATCH], "left_semi")
