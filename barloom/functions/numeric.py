"""Numeric column functions with the rounding and null rules of the engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def half_even(value: Column, digits: int = 2) -> Column:
    """Round the scaled double half to even, as array libraries do."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def no_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def safe_ln(value: Column) -> Column:
    """Natural logarithm; null where the value is not positive."""
    number = value.cast("double")
    return F.when(number > 0, F.ln(number))


def exact_round(value: Column, digits: int = 2) -> Column:
    """Round the binary value itself, so 2.675, which is a little less, gives 2.67.

    Near a midpoint the product with the scale may round onto it. Splitting the value
    into two short parts keeps both products exact and tells the side.
    """
    doubled = F.lit(2.0 * 10**digits)
    steps = F.rint(value * doubled)
    short = value.cast("float").cast("double")
    above = (short * doubled - steps) + (value - short) * doubled
    halfway = F.when(above > 0, steps + 1).when(above < 0, steps - 1).otherwise(F.rint(steps / 2) * 2)
    return F.when(steps % 2 == 0, steps).otherwise(halfway) / doubled


def to_decimal(value: Column, precision: int = 2) -> Column:
    """Double to decimal, rounded to `precision` digits."""
    return exact_round(value, precision).cast(T.DecimalType(10 + precision, precision))


def to_decimal_exact(value: Column, scale: int = 18) -> Column:
    """Double to decimal through its shortest text form, so 0.1 stays 0.1."""
    return value.cast("string").cast(T.DecimalType(38, scale))


def calendar_days(trading_days: int) -> int:
    """Calendar days that safely cover a number of trading days (factor 2.5)."""
    return 0 if trading_days <= 0 else round(trading_days * 2.5)


def calendar_days_column(trading_days: Column) -> Column:
    days = F.bround(trading_days * F.lit(2.5)).cast("int")
    return F.when(trading_days <= 0, F.lit(0)).otherwise(days)
