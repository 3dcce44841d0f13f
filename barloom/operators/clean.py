"""Cleaning, type conversion and projection of bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.numeric import no_nan, to_decimal, to_decimal_exact
from barloom.functions.text import clean_text
from barloom.functions.times import local_naive, to_time, utc_naive
from barloom.operators.series import join_back
from barloom.schema import CORE_PRICES, SERIES_KEYS


def drop_row_stamps(df: DataFrame) -> DataFrame:
    return df.drop("created_at", "updated_at")


def coerce_prices(df: DataFrame, columns: Sequence[str] = CORE_PRICES) -> DataFrame:
    """Prices of any type to double; what is not a number becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in present})


def _cleaned(field: T.StructField) -> Column:
    column = F.col(field.name)
    match field.dataType:
        case T.DecimalType():
            return column.cast("double")
        case T.DoubleType() | T.FloatType():
            return no_nan(column)
        case T.StringType():
            return clean_text(column)
        case T.TimestampType():
            return utc_naive(column)
        case T.BooleanType():
            return F.coalesce(column, F.lit(False))
        case _:
            return column


def clean_rows(df: DataFrame) -> DataFrame:
    """Decimals to double, texts trimmed, times to naive UTC, and no row without prices."""
    cleaned = df.select(*(_cleaned(f).alias(f.name) for f in df.schema.fields))
    prices = [c for c in CORE_PRICES if c in cleaned.columns]
    return cleaned.dropna(subset=prices) if prices else cleaned


def add_date_range(df: DataFrame, keys: tuple[str, ...] = SERIES_KEYS) -> DataFrame:
    """Add the trade date and the first and last trade date of each series.

    The range is a small aggregate joined back, so that a huge series is not
    gathered in one window partition. Null keys form a series too.
    """
    dated = df.withColumn("trade_time_date", F.to_date("trade_time"))
    ranges = dated.groupBy(*keys).agg(
        F.min("trade_time_date").alias("start_date"), F.max("trade_time_date").alias("end_date")
    )
    return join_back(dated, ranges, keys)


def doubles_to_decimal(df: DataFrame, precision: int | None = None) -> DataFrame:
    """Every double column to decimal: exact text form, or rounded to `precision`."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    if precision is None:
        return df.withColumns({c: to_decimal_exact(F.col(c)) for c in doubles})
    return df.withColumns({c: to_decimal(F.col(c), precision) for c in doubles})


def column_to_time(
    df: DataFrame, column: str = "trade_time", failed: str | None = None, failures: Observation | None = None
) -> DataFrame:
    """Mixed values to times; what cannot be read becomes null. `failed` names a column that marks those rows, and
    `failures` gets their number as `failed`, once an action has run."""
    mark = failed or "_failed"
    read = df.withColumn("_time", to_time(F.col(column))).withColumn(mark, F.col(column).isNotNull() & F.col("_time").isNull())
    if failures is not None:
        read = read.observe(failures, F.count_if(mark).alias("failed"))
    timed = read.withColumn(column, F.col("_time")).drop("_time")
    return timed if failed else timed.drop(mark)


def drop_zone(df: DataFrame, columns: Sequence[str] | None = None, zone: str = "UTC") -> DataFrame:
    """Zoned time columns to naive wall time in `zone`."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    chosen = zoned if columns is None else [c for c in columns if c in zoned]
    return df.withColumns({c: local_naive(F.col(c), zone) for c in chosen})


def select_once(df: DataFrame, *groups: Sequence[str]) -> DataFrame:
    """Select columns in the given order, each name once."""
    return df.select(*dict.fromkeys(name for group in groups for name in group))


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def newest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the one with the greatest `newest_by`.

    An aggregate, not a row number: copies are combined before the shuffle, so a key
    with very many copies costs one row per input partition.
    """
    rank = F.struct(*newest_by)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), rank).alias("_row"))
    return best.select("_row.*")


def first_per_date(
    df: DataFrame, keys: tuple[str, ...] = SERIES_KEYS, order: Sequence[str] = ("trade_time", "id")
) -> DataFrame:
    """One row per series and calendar date: the earliest."""
    present = [c for c in order if c in df.columns]
    dated = df.withColumn("_date", F.to_date("trade_time"))
    first = dated.groupBy(*keys, "_date").agg(F.min_by(F.struct(*df.columns), F.struct(*present)).alias("_row"))
    return first.select("_row.*")


def distinct_pairs(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Distinct (code, candle) as text, without nulls."""
    missing = [c for c in SERIES_KEYS if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    pairs = df.select(*(F.col(c).cast("string").alias(c) for c in SERIES_KEYS)).dropna().distinct()
    return pairs.orderBy(*SERIES_KEYS) if ordered else pairs
