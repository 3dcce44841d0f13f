"""Candle features of single bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.numeric import half_even


def add_candle_features(df: DataFrame) -> DataFrame:
    """Direction, body and range of each bar. Row-local, so it also runs on streams."""
    open_, close, high, low = (F.col(c) for c in ("open", "close", "high", "low"))
    body = F.abs(close - open_)
    span = high - low
    upper, lower = F.greatest(close, open_), F.least(close, open_)

    def share(part):
        """Part of the bar's range, 0 for a bar without range."""
        return F.coalesce(F.try_divide(part, span), F.lit(0.0))

    return df.withColumns(
        {
            "body_lower": lower,
            "body_upper": upper,
            "body_bottom_perc": share(lower - low) * 100,
            "body_top_perc": F.lit(100.0) - share(high - upper) * 100,
            "body_perc": half_even(F.coalesce(F.try_divide(body, span) * 100, F.lit(0.0)), 2),
            "direction": F.when(close - open_ >= 0, 1).otherwise(-1),
            "body_size": body,
            "mid_point": span / 2 + low,
            "daily_range": span,
        }
    )


def add_trend_direction(df: DataFrame) -> DataFrame:
    """Direction used by strategies: 1 up, -1 down, 0 unchanged."""
    if not {"open", "close"} <= set(df.columns):
        raise ValueError("bars need the columns open and close")
    rising, falling = F.col("close") > F.col("open"), F.col("close") < F.col("open")
    return df.withColumn("direction", F.when(rising, 1).when(falling, -1).otherwise(0))
