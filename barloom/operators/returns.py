"""Returns, growth and risk of bar series."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.numeric import safe_ln
from barloom.functions.times import to_time
from barloom.operators.clean import drop_incomplete, first_per_date
from barloom.operators.series import BARS, Frame, SeriesSpec, over_rows, running_sum

Basis = Literal["rows", "calendar"]
DAYS_PER_YEAR = 365.25


def add_log_returns(df: DataFrame, price: str = "close", out: str = "log_returns", spec: SeriesSpec = BARS) -> DataFrame:
    """ln(price / price before); null on the first bar and where the ratio is not positive."""

    def compute(rows: DataFrame, frame: Frame) -> DataFrame:
        before = F.lag(price, 1).over(frame.ordered())
        return rows.withColumn(out, safe_ln(F.try_divide(F.col(price), before)))

    return over_rows(df, 1, compute, spec)


def add_growth(df: DataFrame, returns: str = "log_returns", out: str = "cusum_rewards", spec: SeriesSpec = BARS) -> DataFrame:
    """Growth since the start of the series: exp of the summed log returns."""
    summed = running_sum(df, returns, "_summed", spec)
    return summed.withColumn(out, F.exp("_summed")).drop("_summed")


def preprocess_bars(df: DataFrame, spec: SeriesSpec = BARS) -> DataFrame:
    """Complete rows, one per series and date, with log returns and growth."""
    typed = drop_incomplete(df).withColumn("code", F.col("code").cast("string"))
    if dict(df.dtypes)["trade_time"] == "string":
        typed = typed.withColumn("trade_time", to_time(F.col("trade_time"))).dropna(subset=["trade_time"])
    daily = first_per_date(typed, spec.keys, (spec.time, *spec.tie))
    returns = add_log_returns(daily, spec=spec)
    return add_growth(returns, spec=spec).drop("id")


def _years(basis: Basis):
    """Length of a series in years: counted rows, or calendar days."""
    if basis == "rows":
        return (F.count(F.lit(1)) - 1) / F.lit(DAYS_PER_YEAR)
    return F.datediff(F.max("trade_time"), F.min("trade_time")) / F.lit(DAYS_PER_YEAR)


def risk_metrics(
    df: DataFrame,
    returns: str = "log_returns",
    risk_free_rate: float = 0.02,
    basis: Basis = "rows",
    periods_per_year: float | None = None,
    spec: SeriesSpec = BARS,
) -> DataFrame:
    """Annualised return, risk and Sharpe ratio per series, in one aggregate.

    Risk scales the sample deviation by the square root of the years covered.
    `periods_per_year` gives the usual scaling instead.
    """
    summary = df.groupBy(*spec.keys).agg(
        F.sum(returns).alias("_total"),
        F.stddev_samp(returns).alias("_dev"),
        F.count(F.lit(1)).alias("bars"),
        _years(basis).alias("_years"),
    )
    scale = F.col("_years") if periods_per_year is None else F.lit(float(periods_per_year))
    annual = F.exp(F.try_divide(F.col("_total"), F.col("_years"))) - 1
    risk = F.col("_dev") * F.sqrt(scale)
    return summary.select(
        *spec.keys,
        "bars",
        (annual * 100).alias("annualized_return"),
        (risk * 100).alias("annualized_risk"),
        F.try_divide(annual - risk_free_rate, risk).alias("sharpe_ratio"),
    )


def growth_rate(
    df: DataFrame, returns: str = "log_returns", basis: Basis = "rows", spec: SeriesSpec = BARS
) -> DataFrame:
    """Compound annual growth rate per series, in percent."""
    summary = df.groupBy(*spec.keys).agg(F.sum(returns).alias("_total"), _years(basis).alias("_years"))
    annual = F.exp(F.try_divide(F.col("_total"), F.col("_years"))) - 1
    return summary.select(*spec.keys, (annual * 100).alias("cagr"))
