"""Label arriving files with a fixed dictionary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rulemark.errors import SettingsError
from rulemark.functions.names import quoted
from rulemark.operators.compiled import CompiledRules
from rulemark.operators.matching import match_tests
from rulemark.operators.snapshot import latest_per_key
from rulemark.options import ReadOptions
from rulemark.plans.label import carry_back, resolved_of
from rulemark.sources.files import QUOTED_EMPTY, csv_options, restore_empty
from rulemark.streaming.runs import BATCH, Run, RunStore, newest_per_key

#: Tables below the output of a stream.
ROWS, SNAPSHOT, LABELS = "rows", "snapshot", "labels"
#: The folders of ``rows`` are named by their batch.
ROWS_OF = "of_stream_batch"
#: Runs of a tier that are merged.
FAN = 8


def stream_folder(
    spark: SparkSession,
    folder: str,
    names: list[str],
    extension: str = "csv",
    options: ReadOptions = ReadOptions(),
    files_per_batch: int = 100,
) -> DataFrame:
    """Files of a folder as they arrive, as text columns ``names``."""
    if options.skip_rows:
        raise SettingsError("a stream of files cannot skip first lines")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return (
        spark.readStream.schema(schema)
        .options(**csv_options(options))
        .option("header", options.has_header)
        .option("emptyValue", QUOTED_EMPTY)
        .option("pathGlobFilter", f"*.{extension.strip('.')}")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .select(*[restore_empty(n) for n in names])
    )


def label_stream(
    stream: DataFrame,
    rules: CompiledRules,
    id_column: str,
    output: str,
    checkpoint: str,
    date_column: str | None = None,
    tiebreak: tuple[str, ...] = (),
    available_now: bool = True,
    fan: int = FAN,
) -> StreamingQuery:
    """Label arriving rows by the latest row of their id over all batches.

    Every batch adds the folder of its ``rows`` below ``output``, and a run to each of two tables:
    ``snapshot`` with the latest row so far of each id in the batch, and ``labels`` of those ids.
    Runs are merged in tiers of ``fan`` (``runs.RunStore``), so a batch reads a number of runs that
    grows with the logarithm of the batches, and each id at most once in each of them.
    ``labelled_so_far`` puts the tables together, so what a row gets does not depend on how the files
    fell into batches. A batch that is run again after a failure builds on the state of the
    batch before it and overwrites its own folders.
    """
    sink = LabelSink(rules, id_column, output, date_column, tiebreak, fan)
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


@dataclass(frozen=True)
class LabelSink:
    """Takes the batches of ``label_stream``."""

    rules: CompiledRules
    id_column: str
    output: str
    date_column: str | None = None
    tiebreak: tuple[str, ...] = ()
    fan: int = FAN

    def store(self, spark: SparkSession) -> RunStore:
        return RunStore(spark, self.output, (SNAPSHOT, LABELS), self.fan)

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, rules, key = batch.sparkSession, self.rules, self.id_column
        store = self.store(spark)
        before = store.before(number)
        own = Run(0, number, number)
        path = f"{self.output}/{ROWS}/{ROWS_OF}={number}"
        batch.write.mode("overwrite").parquet(path)
        rows = spark.read.schema(batch.schema).parquet(path)
        dated = [self.date_column] if self.date_column else []
        kept = list(dict.fromkeys([key, *rules.search_columns, *dated, *self.tiebreak]))
        new = rows.select(*map(quoted, kept)).filter(F.col(quoted(key)).isNotNull())
        schema = T.StructType([*new.schema.fields, T.StructField(BATCH, T.LongType())])
        if before:
            state = store.read(SNAPSHOT, before, schema).drop(BATCH)
            new = new.unionByName(state.join(new.select(quoted(key)).distinct(), key, "left_semi"))
        # The latest of the latest rows is the latest row: the order is total.
        latest = latest_per_key(new, key, kept, self.date_column, self.tiebreak)
        latest.withColumn(BATCH, F.lit(number).cast("bigint")).write.mode("overwrite").parquet(store.path(SNAPSHOT, own))
        snapshot = store.read(SNAPSHOT, [own], schema)
        found = resolved_of(match_tests(snapshot.drop(BATCH), key, rules), rules)
        ids = snapshot.select(F.col(quoted(key)).alias("id"), BATCH).join(found, "id", "left")
        ids.write.mode("overwrite").parquet(store.path(LABELS, own))
        store.commit(number, [*before, own], {SNAPSHOT: key, LABELS: "id"}, {SNAPSHOT: schema, LABELS: ids.schema})


def labelled_so_far(spark: SparkSession, output: str, rules: CompiledRules, id_column: str) -> DataFrame:
    """All rows that have arrived at ``output``, with the labels their ids have now."""
    store = RunStore(spark, output, (SNAPSHOT, LABELS))
    paths = [store.path(LABELS, r) for r in store.latest()]
    if not paths:
        raise SettingsError(f"no batch has arrived at {output!r}")
    per_id = newest_per_key(spark.read.parquet(*paths), "id").drop(BATCH)
    return carry_back(spark.read.parquet(f"{output}/{ROWS}").drop(ROWS_OF), per_id, rules, id_column)
