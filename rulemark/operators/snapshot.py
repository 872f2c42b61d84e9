"""One row per key, and the choice of the date column that orders rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulemark.functions.names import free_name, quoted

# Form of a date, rows sampled and share that must be dates.
DATE_PATTERN = r"\A\p{Nd}{4}[-/.]\p{Nd}{2}[-/.]\p{Nd}{2}\z"
DATE_SAMPLE_ROWS = 500
DATE_SHARE = 0.8


def latest_per_key(
    df: DataFrame,
    key: str,
    columns: list[str],
    date: str | None = None,
    tiebreak: tuple[str, ...] = (),
    count_as: str | None = None,
) -> DataFrame:
    """``key, columns`` of the row with the greatest ``date`` per key.

    Of rows with the same date the one smallest in ``tiebreak`` is taken, so with
    the load order as tie-break the first loaded; without any date in a key the
    last loaded. Rows equal in that too are told apart by their content.
    Without ``date`` the row smallest in ``tiebreak`` is taken. ``count_as`` adds
    the number of rows of the key.
    """
    columns = [c for c in columns if c != key]
    rows = df.filter(F.col(quoted(key)).isNotNull())
    backwards = [_reversed(rows, c) for c in tiebreak]
    if any(b is None for b in backwards):
        latest = _latest_by_window(rows, key, columns, date, tiebreak)
        if count_as is None:
            return latest
        return latest.join(rows.groupBy(quoted(key)).agg(F.count("*").alias(count_as)), key)
    content = [F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)]
    order = list(backwards)
    if date is not None:
        dates = F.col(quoted(date))
        # a row without a tie-break loses to rows with one, whatever its type
        order = [dates] + [F.when(dates.isNull(), _opposite(rows, c, b)).otherwise(b) for c, b in zip(tiebreak, backwards)]
    # one partial aggregate per task: a hot key leaves each task as one row
    fields = [*[o.alias(f"o{i}") for i, o in enumerate(order)], *content, F.lit(0).alias("last")]
    aggregates = [F.max(F.struct(*fields)).alias("_best")]
    if count_as is not None:
        aggregates.append(F.count("*").alias(count_as))
    found = rows.groupBy(quoted(key)).agg(*aggregates)
    best = [F.col(f"_best.c{i}").alias(c) for i, c in enumerate(columns)]
    return found.select(quoted(key), *best, *([count_as] if count_as else []))


def _reversed(df: DataFrame, column: str) -> Column | None:
    """A number that falls as the column rises; None if the type has none.

    Flipping the bits of a whole number reverses its order, without an overflow.
    """
    kind, value = df.schema[column].dataType, F.col(quoted(column))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.bitwise_not(F.unix_micros(value.cast("timestamp")))
    if isinstance(kind, T.DateType):
        return F.bitwise_not(F.unix_date(value))
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(value)
    if isinstance(kind, T.NumericType):
        return -value
    return None


def _opposite(df: DataFrame, column: str, backwards: Column) -> Column:
    """A number of the type of ``_reversed`` that rises with the column."""
    fraction = isinstance(df.schema[column].dataType, T.NumericType) and not isinstance(df.schema[column].dataType, T.IntegralType)
    return -backwards if fraction else F.bitwise_not(backwards)


def _latest_by_window(df, key, columns, date, tiebreak):
    ties = [F.col(quoted(c)) for c in tiebreak]
    first, last = [c.asc_nulls_last() for c in ties], []
    if date is not None:
        dated = F.col(quoted(date)).isNotNull()
        last = [F.when(~dated, c).desc_nulls_last() for c in ties]
        first = [F.col(quoted(date)).desc_nulls_last()] + [F.when(dated, c).asc_nulls_last() for c in ties]
    content = [F.col(quoted(c)).desc() for c in columns]
    rank = F.row_number().over(Window.partitionBy(quoted(key)).orderBy(*first, *last, *content))
    name = free_name("_rank", df.columns)
    return df.withColumn(name, rank).filter(F.col(name) == 1).select(*map(quoted, [key, *columns]))


def date_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column_name, share``: the part of the non-NULL values that look like a date."""
    columns = columns or df.columns
    shares = [
        F.avg(F.col(f"`{c}`").rlike(DATE_PATTERN).cast("int")).alias(f"s{i}") for i, c in enumerate(columns)
    ]
    tall = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("share")) for i, c in enumerate(columns)]
        )
    )
    return df.agg(*shares).select(tall.alias("r")).select("r.*")


def detect_date_column(
    df: DataFrame, preferred: str | None = None, sample_rows: int | None = DATE_SAMPLE_ROWS
) -> str | None:
    """``preferred`` if it holds dates, else the first text column that does, else None.

    Looks at the first ``sample_rows`` rows; None looks at the whole table.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return None
    sample = df if sample_rows is None else df.limit(sample_rows)
    shares = {r["column_name"]: r["share"] for r in date_shares(sample.select(*[f"`{c}`" for c in texts])).collect()}
    dated = [c for c in texts if shares[c] is not None and shares[c] >= DATE_SHARE]
    if preferred in dated:
        return preferred
    return dated[0] if dated else None
