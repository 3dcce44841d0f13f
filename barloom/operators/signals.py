"""Strategies: trading signals, their levels and the rows a strategy reads."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.numeric import calendar_days
from barloom.operators.candles import add_trend_direction
from barloom.operators.clean import select_once
from barloom.operators.indicators import Indicator, apply_indicators
from barloom.operators.series import BARS, POSITION, SEEN, Frame, SeriesSpec, over_rows

# Trade actions, and the columns every strategy reads.
BUY, SELL, NO_ACTION = 1, -1, 0
STRATEGY_COLUMNS = ("trade_time", "open", "high", "low", "close", "volume", "direction")

Rule = Callable[[], Column]
Levels = Callable[[], tuple[Column, Column]]


@dataclass(frozen=True)
class ExitFactors:
    """Take-profit and stop-loss as fractions of the entry price; loss is negative."""

    profit_factor: float
    loss_factor: float

    def levels(self) -> tuple[Column, Column]:
        marked = F.col("SIGNAL") != NO_ACTION

        def level(factor: float) -> Column:
            return F.when(marked, F.col("open") * (1 + F.lit(factor))).otherwise(F.lit(0.0))

        return level(self.profit_factor), level(self.loss_factor)


@dataclass(frozen=True)
class Strategy:
    """A named rule with the indicators it reads.

    `rule` returns the signal of a row as a column: 1 buy, -1 sell, 0 nothing. A
    vectorised pandas function is accepted too where no column expression fits.
    """

    name: str
    rule: Rule
    indicators: Sequence[Indicator] = field(default_factory=tuple)
    extra_columns: Sequence[str] = field(default_factory=tuple)
    look_back: int = 0

    def first_time(self, start: datetime) -> datetime:
        """Start of the bars to load so that indicators are warm at `start`."""
        return start - timedelta(days=calendar_days(self.look_back))


def prepare_bars(df: DataFrame, strategy: Strategy, spec: SeriesSpec = BARS) -> DataFrame:
    """Direction, indicators, the columns the strategy reads, and an empty signal."""
    ready = apply_indicators(add_trend_direction(df), strategy.indicators, spec)
    shown = [name for indicator in strategy.indicators for name in indicator.info.display_name]
    tie = [c for c in (*spec.tie, POSITION, SEEN) if c in df.columns]
    chosen = select_once(ready, spec.keys, tie, STRATEGY_COLUMNS, shown, strategy.extra_columns)
    return chosen.withColumn("SIGNAL", F.lit(NO_ACTION))


def mark_signals(df: DataFrame, rule: Rule, shift: bool = False, fill: bool = True, spec: SeriesSpec = BARS) -> DataFrame:
    """Set SIGNAL by the rule. With `shift` a signal acts on the next bar of its series.

    Shifting also turns nulls of all numeric columns into 0, but for those that order
    the series; `fill=False` keeps them and only fills SIGNAL.
    """
    marked = df.withColumn("SIGNAL", F.coalesce(rule(), F.lit(NO_ACTION)).cast("int"))
    if not shift:
        return marked

    def compute(rows: DataFrame, frame: Frame) -> DataFrame:
        return rows.withColumn("SIGNAL", F.lag("SIGNAL", 1).over(frame.ordered()))

    shifted = over_rows(marked, 1, compute, spec)
    placing = {*spec.keys, *spec.order(df), POSITION, SEEN}
    numeric = [f.name for f in shifted.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in placing]
    return shifted.fillna(NO_ACTION, subset=numeric if fill else ["SIGNAL"])


def add_levels(df: DataFrame, levels: Levels) -> DataFrame:
    """Take-profit and stop-loss price of each row, 0 where there is no signal."""
    take_profit, stop_loss = levels()
    return df.withColumns({"TP": take_profit, "SL": stop_loss})


def last_rows(df: DataFrame, k: int, spec: SeriesSpec = BARS) -> DataFrame:
    """The newest k rows of each series. Up to the session's window group limit (k of 1,000 by default) each input
    partition keeps at most k rows per series before the shuffle; with a greater k a series is sorted in one task."""
    newest_first = Window.partitionBy(*spec.keys).orderBy(*(F.desc(c) for c in spec.order(df)))
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def last_signals(
    df: DataFrame,
    column: str = "SIGNAL",
    look_back: int = 5,
    default: int = NO_ACTION,
    spec: SeriesSpec = BARS,
) -> DataFrame:
    """Per series, the newest signal that is not 0 among the last `look_back` rows."""
    signal = F.when(F.col(column) != NO_ACTION, F.col(column))
    recent = last_rows(df, look_back, spec).withColumn("_at", F.when(signal.isNotNull(), F.struct(*spec.order(df))))
    found = recent.groupBy(*spec.keys).agg(F.max_by(signal, F.col("_at")).alias("last_signal"))
    return found.withColumn("last_signal", F.coalesce(F.col("last_signal"), F.lit(default)).cast("int"))
