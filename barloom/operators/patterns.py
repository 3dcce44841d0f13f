"""Candlestick patterns as boolean columns over candle features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.series import BARS, Frame, SeriesSpec, over_rows

# Pattern thresholds, in percent of the bar's range unless noted.
MARUBOZU_BODY = 98
HANGING_MAN_BOTTOM, HANGING_MAN_BODY = 75, 15
SHOOTING_STAR_TOP, SHOOTING_STAR_BODY = 25, 15
SPINNING_TOP_UPPER, SPINNING_TOP_LOWER, SPINNING_TOP_BODY = 60, 40, 15
ENGULFING_FACTOR = 1.1  # body size against the bar before
TWEEZER_BODY_CHANGE, TWEEZER_PRICE_CHANGE = 15, 0.01  # percent change
TWEEZER_TOP, TWEEZER_BOTTOM = 40, 60
STAR_FIRST_BODY, STAR_MIDDLE_BODY = 90, 10


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def marubozu() -> Column:
    return _known(F.col("body_perc") > MARUBOZU_BODY)


def hanging_man() -> Column:
    return _known((F.col("body_bottom_perc") > HANGING_MAN_BOTTOM) & (F.col("body_perc") < HANGING_MAN_BODY))


def shooting_star() -> Column:
    return _known((F.col("body_top_perc") < SHOOTING_STAR_TOP) & (F.col("body_perc") < SHOOTING_STAR_BODY))


def spinning_top() -> Column:
    return _known(
        (F.col("body_top_perc") < SPINNING_TOP_UPPER)
        & (F.col("body_bottom_perc") > SPINNING_TOP_LOWER)
        & (F.col("body_perc") < SPINNING_TOP_BODY)
    )


def _turned() -> Column:
    return F.col("direction") != F.col("direction_prev")


def engulfing(factor: float = ENGULFING_FACTOR) -> Column:
    return _known(_turned() & (F.col("body_size") > F.col("body_size_prev") * factor))


def _tweezer(direction: int, edge: Column) -> Column:
    return _known(
        (F.abs("body_size_change") < TWEEZER_BODY_CHANGE)
        & (F.col("direction") == direction)
        & _turned()
        & (F.abs("low_change") < TWEEZER_PRICE_CHANGE)
        & (F.abs("high_change") < TWEEZER_PRICE_CHANGE)
        & edge
    )


def tweezer_top() -> Column:
    return _tweezer(-1, F.col("body_top_perc") < TWEEZER_TOP)


def tweezer_bottom() -> Column:
    return _tweezer(1, F.col("body_bottom_perc") > TWEEZER_BOTTOM)


def star(direction: int = 1) -> Column:
    """Morning star (direction 1) or evening star (direction -1)."""
    close, middle = F.col("close"), F.col("mid_point_prev_2")
    return _known(
        (F.col("body_perc_prev_2") > STAR_FIRST_BODY)
        & (F.col("body_perc_prev") < STAR_MIDDLE_BODY)
        & (F.col("direction") == direction)
        & (F.col("direction_prev_2") != direction)
        & (close > middle if direction == 1 else close < middle)
    )


# Patterns of one bar, and patterns that also read the bars before.
BAR_PATTERNS = {
    "marubozu": marubozu,
    "hanging_man": hanging_man,
    "shooting_star": shooting_star,
    "spinning_top": spinning_top,
}
SEQUENCE_PATTERNS = {
    "engulfing": engulfing,
    "tweezer_top": tweezer_top,
    "tweezer_bottom": tweezer_bottom,
    "morning_star": lambda: star(1),
    "evening_star": lambda: star(-1),
}

_PREV = ("direction", "body_size", "body_perc")
_PREV_2 = ("direction", "body_perc", "mid_point")
_CHANGE = ("body_size", "low", "high")


def add_previous(df: DataFrame, frame: Frame) -> DataFrame:
    """The features of the last two bars and the percent changes patterns compare."""
    ordered = frame.ordered()
    columns = {f"{c}_prev": F.lag(c, 1).over(ordered) for c in _PREV}
    columns |= {f"{c}_prev_2": F.lag(c, 2).over(ordered) for c in _PREV_2}
    for c in _CHANGE:
        before = F.lag(c, 1).over(ordered)
        columns[f"{c}_change"] = F.try_divide(F.col(c) - before, before) * 100
    return df.withColumns(columns)


def add_bar_patterns(df: DataFrame) -> DataFrame:
    return df.withColumns({name: pattern() for name, pattern in BAR_PATTERNS.items()})


def add_sequence_patterns(
    df: DataFrame, names: Sequence[str] = tuple(SEQUENCE_PATTERNS), spec: SeriesSpec = BARS
) -> DataFrame:
    """Patterns over up to three bars; needs the candle features."""
    kept = df.columns

    def compute(rows: DataFrame, frame: Frame) -> DataFrame:
        widened = add_previous(rows, frame)
        flagged = widened.withColumns({name: SEQUENCE_PATTERNS[name]() for name in names})
        return flagged.select(*rows.columns, *names)

    return over_rows(df, 2, compute, spec).select(*kept, *names)
