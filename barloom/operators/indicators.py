"""Technical indicators. All of a list share one shuffle and, per frame, one order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import partial
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.numeric import half_even
from barloom.operators.ewm import Decay, Ewm, add_ewms, drop_run_columns, run_name, with_run
from barloom.operators.patterns import ENGULFING_FACTOR
from barloom.operators.series import BARS, Frame, SeriesSpec, over_rows


@dataclass(frozen=True)
class IndicatorInfo:
    """Name, output columns and parameters of an indicator."""

    name: str
    display_name: tuple[str, ...]
    params: dict[str, float] = field(default_factory=dict)


class Indicator(Protocol):
    """What an indicator offers; users may add their own."""

    @property
    def info(self) -> IndicatorInfo: ...

    @property
    def back(self) -> int:
        """Earlier rows a value depends on."""
        ...

    def means(self, columns: Sequence[str]) -> list[Ewm]:
        """Exponential means of bar columns it needs. They are computed together for
        all indicators, before any `steps`. `columns` are those already there."""
        ...

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        """Add the output columns, with windows of the frame."""
        ...


def apply_indicators(df: DataFrame, indicators: Sequence[Indicator], spec: SeriesSpec = BARS) -> DataFrame:
    """Apply the indicators in list order, over one layout of the data."""
    if not indicators:
        return df

    def compute(rows: DataFrame, frame: Frame) -> DataFrame:
        given = rows.columns
        needed = {m.out: m for i in indicators for m in i.means(given)}
        runs = max((m.decay.run_rows for m in needed.values()), default=0)
        if runs:
            rows = with_run(rows, frame, runs)
            frame = replace(frame, lead=(run_name(runs),))
        rows = add_ewms(rows, frame, list(needed.values()))
        for indicator in indicators:
            rows = indicator.steps(rows, frame)
        helpers = [out for out in needed if out.startswith("_")]
        return drop_run_columns(rows.drop(*helpers), given)

    return over_rows(df, max(i.back for i in indicators), compute, spec)


class _Applied:
    def apply(self, df: DataFrame, spec: SeriesSpec = BARS) -> DataFrame:
        return apply_indicators(df, [self], spec)

    def means(self, columns: Sequence[str]) -> list[Ewm]:
        return []


def _full(value: Column, n: int, frame: Frame, result: Column) -> Column:
    """`result` where the last n rows hold n values."""
    return F.when(F.count(value).over(frame.last_rows(n)) == n, result)


def _mean(value: Column, n: int, frame: Frame) -> Column:
    return _full(value, n, frame, F.avg(value).over(frame.last_rows(n)))


def _span_mean(out: str, span: int) -> Ewm:
    return Ewm(out, lambda frame: F.col("close"), Decay.of_span(span), span)


@dataclass(frozen=True)
class BollingerBands(_Applied):
    n: int = 20
    s: float = 2

    @property
    def info(self) -> IndicatorInfo:
        return IndicatorInfo("BollingerBands", ("BB_MA", "BB_UP", "BB_LW"), {"n": self.n, "s": self.s})

    @property
    def back(self) -> int:
        return self.n

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        typical = (F.col("close") + F.col("high") + F.col("low")) / 3
        deviation = F.stddev_samp(typical).over(frame.last_rows(self.n))
        df = df.withColumns(
            {"BB_MA": _mean(typical, self.n, frame), "_bb_dev": _full(typical, self.n, frame, deviation)}
        )
        spread = F.col("_bb_dev") * self.s
        return df.withColumns({"BB_UP": F.col("BB_MA") + spread, "BB_LW": F.col("BB_MA") - spread}).drop("_bb_dev")


@dataclass(frozen=True)
class ATR(_Applied):
    n: int = 14

    @property
    def info(self) -> IndicatorInfo:
        return IndicatorInfo("ATR", (f"ATR_{self.n}",), {"period": self.n})

    @property
    def back(self) -> int:
        return self.n + 1

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        before = F.lag("close", 1).over(frame.ordered())
        high, low = F.col("high"), F.col("low")
        ranged = df.withColumn("_range", F.greatest(high - low, F.abs(high - before), F.abs(before - low)))
        return ranged.withColumn(f"ATR_{self.n}", _mean(F.col("_range"), self.n, frame)).drop("_range")


@dataclass(frozen=True)
class EMA(_Applied):
    n: int = 10

    @property
    def info(self) -> IndicatorInfo:
        return IndicatorInfo("EMA", (f"EMA_{self.n}",), {"period": self.n})

    @property
    def back(self) -> int:
        return Decay.of_span(self.n).reach + self.n

    def means(self, columns: Sequence[str]) -> list[Ewm]:
        return [_span_mean(f"EMA_{self.n}", self.n)]

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        return df


@dataclass(frozen=True)
class MA(_Applied):
    n: int = 10

    @property
    def info(self) -> IndicatorInfo:
        return IndicatorInfo("MA", (f"MA_{self.n}",), {"period": self.n})

    @property
    def back(self) -> int:
        return self.n

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        return df.withColumn(f"MA_{self.n}", _mean(F.col("close"), self.n, frame))


@dataclass(frozen=True)
class KeltnerChannels(_Applied):
    n_ema: int = 20
    n_atr: int = 10

    @property
    def info(self) -> IndicatorInfo:
        return IndicatorInfo(
            "KeltnerChannels", ("KeUp", "KeLo"), {"ema_period": self.n_ema, "atr_period": self.n_atr}
        )

    @property
    def back(self) -> int:
        return max(EMA(self.n_ema).back, ATR(self.n_atr).back)

    def means(self, columns: Sequence[str]) -> list[Ewm]:
        return EMA(self.n_ema).means(columns)

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        df = ATR(self.n_atr).steps(df, frame)
        middle, reach = F.col(f"EMA_{self.n_ema}"), F.col(f"ATR_{self.n_atr}") * 2
        return df.withColumns({"KeUp": middle + reach, "KeLo": middle - reach})


@dataclass(frozen=True)
class RSI(_Applied):
    n: int = 14

    @property
    def info(self) -> IndicatorInfo:
        return IndicatorInfo("RSI", (f"RSI_{self.n}",), {"period": self.n})

    @property
    def back(self) -> int:
        return Decay(1 / self.n).reach + self.n + 1

    def means(self, columns: Sequence[str]) -> list[Ewm]:
        def part(sign: int, frame: Frame) -> Column:
            move = (F.col("close") - F.lag("close", 1).over(frame.ordered())) * sign
            return F.when(move.isNotNull(), F.greatest(move, F.lit(0.0)))

        signs = {f"_gain_{self.n}": 1, f"_loss_{self.n}": -1}
        decay = Decay(1 / self.n)
        return [Ewm(out, partial(part, sign), decay, self.n, adjust=False, nulls=f"move_{self.n}") for out, sign in signs.items()]

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        up, down = F.col(f"_gain_{self.n}"), F.col(f"_loss_{self.n}")
        # no loss gives 100 and no movement at all gives null, without dividing by 0
        index = F.when((down == 0) & (up > 0), F.lit(100.0)).when(
            down != 0, F.lit(100.0) - F.lit(100.0) / (1 + F.try_divide(up, down))
        )
        return df.withColumn(f"RSI_{self.n}", half_even(index, 2))


@dataclass(frozen=True)
class MACD(_Applied):
    n_slow: int = 26
    n_fast: int = 12
    n_signal: int = 9

    @property
    def info(self) -> IndicatorInfo:
        periods = {"slow_period": self.n_slow, "fast_period": self.n_fast, "signal_period": self.n_signal}
        return IndicatorInfo("MACD", ("MACD", "MACD_SIGNAL", "HIST"), periods)

    @property
    def back(self) -> int:
        return max(EMA(self.n_slow).back, EMA(self.n_fast).back) + EMA(self.n_signal).back

    def means(self, columns: Sequence[str]) -> list[Ewm]:
        return [_span_mean(f"_ema_{n}", n) for n in (self.n_fast, self.n_slow)]

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        df = df.withColumn("MACD", F.col(f"_ema_{self.n_fast}") - F.col(f"_ema_{self.n_slow}"))
        # the signal starts at the first bar that has a MACD value
        signal = Ewm("MACD_SIGNAL", lambda frame: F.col("MACD"), Decay.of_span(self.n_signal), self.n_signal)
        df = add_ewms(df, frame, [signal])
        return df.withColumn("HIST", F.col("MACD") - F.col("MACD_SIGNAL"))


@dataclass(frozen=True)
class BIAS(_Applied):
    n_ema: int = 20

    @property
    def info(self) -> IndicatorInfo:
        return IndicatorInfo("BIAS", (f"BIAS_{self.n_ema}",), {"period": self.n_ema})

    @property
    def back(self) -> int:
        return EMA(self.n_ema).back

    def means(self, columns: Sequence[str]) -> list[Ewm]:
        return [] if f"EMA_{self.n_ema}" in columns else EMA(self.n_ema).means(columns)

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        mean = f"EMA_{self.n_ema}"
        gap = F.try_divide(F.col("close") - F.col(mean), F.col(mean)) * 100
        return df.withColumn(f"BIAS_{self.n_ema}", gap)


@dataclass(frozen=True)
class Engulfing(_Applied):
    factor: float = ENGULFING_FACTOR

    @property
    def info(self) -> IndicatorInfo:
        return IndicatorInfo("Engulfing", ("ENGULFING",), {"factor": self.factor})

    @property
    def back(self) -> int:
        return 1

    def steps(self, df: DataFrame, frame: Frame) -> DataFrame:
        change = F.col("close") - F.col("open")
        side, size = F.when(change >= 0, 1).otherwise(-1), F.abs(change)
        ordered = frame.ordered()
        engulfs = (side != F.lag(side, 1).over(ordered)) & (size > F.lag(size, 1).over(ordered) * self.factor)
        return df.withColumn("ENGULFING", F.coalesce(engulfs, F.lit(False)))
