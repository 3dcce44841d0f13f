"""Loading bars from files or a database table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.text import parse_codes
from barloom.operators.clean import coerce_prices
from barloom.operators.series import SeriesSpec, with_index
from barloom.operators.validate import EmptyDataSet, require
from barloom.schema import BAR_SCHEMA
from barloom.session import prepare

__all__ = ["ALL_CODES", "EmptyDataSet", "in_numbered_order", "in_time_order", "load_bars", "read_table", "select_bars", "write_in_time_order"]

ALL_CODES = "*"


def read_table(spark: SparkSession, path: str | None = None, form: str = "parquet", **options: str) -> DataFrame:
    """A table of any Spark source: parquet, orc, csv, json, jdbc, ...

    For jdbc pass url, dbtable and, to read in parallel, partitionColumn, lowerBound,
    upperBound and numPartitions. Filters of `select_bars` are pushed down to it.
    """
    reader = prepare(spark).read.format(form).options(**options)
    return reader.load() if path is None else reader.load(path)


def _midnight(value: str | date) -> datetime:
    if isinstance(value, str):
        return datetime.strptime(value, "%Y-%m-%d")
    return datetime(value.year, value.month, value.day)


def select_bars(
    df: DataFrame,
    codes: str | Sequence[object] = ALL_CODES,
    start_time: str | date | None = None,
    end_time: str | date | None = None,
    candle: str | None = None,
    time_column: str = "trade_time",
) -> DataFrame:
    """Bars by code, inclusive time range (UTC midnights) and candle, prices as doubles.

    "*" and an empty code list both mean all codes. The filters are plain comparisons
    on source columns, so they reach the scan.
    """
    wanted = [] if codes == ALL_CODES else parse_codes(codes)
    if wanted:
        df = df.where(F.col("code").isin(*wanted))
    # naive UTC bounds; a zoned column is compared in the session's zone, UTC
    for bound, keep in ((start_time, "ge"), (end_time, "le")):
        if bound is not None:
            limit = F.lit(f"{_midnight(bound):%Y-%m-%d %H:%M:%S}").cast(dict(df.dtypes)[time_column])
            df = df.where(F.col(time_column) >= limit if keep == "ge" else F.col(time_column) <= limit)
    if candle is not None:
        df = df.where(F.col("candle") == candle)
    return coerce_prices(df)


def in_time_order(df: DataFrame, column: str = "trade_time") -> DataFrame:
    """Sorted output, for the edge of a program only: the order costs a range shuffle."""
    return df.orderBy(column)


TIME_ORDER = SeriesSpec(keys=(), tie=("code", "candle", "id"))


def in_numbered_order(df: DataFrame, spec: SeriesSpec = TIME_ORDER, position: str = "position") -> DataFrame:
    """All rows with their place in the order of time, from 0. Counts per slice of time give it, so nothing is sorted as a whole."""
    return with_index(df, spec, position)


def write_in_time_order(df: DataFrame, path: str, spec: SeriesSpec = TIME_ORDER) -> None:
    """Parquet files that hold ranges of the order of time, each sorted, with every row's place in it."""
    numbered = in_numbered_order(df, spec)
    numbered.repartitionByRange("position").sortWithinPartitions("position").write.mode("overwrite").parquet(path)


def load_bars(df: DataFrame, **filters) -> DataFrame:
    """Select bars and pass them through the load gate: not empty, right types, no missing values. The gate is
    a pass of its own here; a `PrepareJob` over `select_bars` counts while it writes."""
    return require(select_bars(df, **filters), BAR_SCHEMA, not_empty=True)
