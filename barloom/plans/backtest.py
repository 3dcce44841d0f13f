"""Whole back-tests: signals, levels, trades, summaries and report rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.series import BARS, SEEN, SeriesSpec, join_back, laid_out, longest_series
from barloom.operators.signals import ExitFactors, Strategy, add_levels, last_signals, mark_signals, prepare_bars
from barloom.operators.trades import find_trades, trade_summary
from barloom.plans.results import report_rows, strategy_json


@dataclass(frozen=True)
class BackTest:
    """A strategy with its exits. All series of the input are tested in one plan."""

    strategy: Strategy
    exits: ExitFactors
    shift_signal: bool = True
    spec: SeriesSpec = BARS

    def marked(self, bars: DataFrame, store: str | None = None) -> DataFrame:
        """Bars with indicators, SIGNAL, TP and SL.

        Trades read the marked bars several times. With `store` they are written there
        once and read back; without it they are computed again each time.
        """
        spec = self.spec
        prepared = prepare_bars(laid_out(bars, spec), self.strategy, spec)
        shifted = mark_signals(prepared, self.strategy.rule, self.shift_signal, spec=spec)
        levelled = add_levels(shifted, self.exits.levels).drop(SEEN)
        if store is None:
            return levelled
        levelled.write.mode("overwrite").parquet(store)
        return bars.sparkSession.read.schema(levelled.schema).parquet(store)

    def trades(self, bars: DataFrame, store: str | None = None) -> DataFrame:
        longest = longest_series(bars, self.spec)
        return find_trades(self.marked(bars, store), spec=self.spec, longest=longest)

    def summaries(self, bars: DataFrame, store: str | None = None) -> DataFrame:
        """One row per series, also for series without trades."""
        spec, keys = self.spec, self.spec.keys
        marked = self.marked(bars, store)
        spans = marked.groupBy(*keys).agg(
            F.min("trade_time").alias("start_time"), F.max("trade_time").alias("end_time")
        )
        # one row per series on every side of these joins
        summed = trade_summary(find_trades(marked, spec=spec, longest=longest_series(bars, spec)), spec)
        joined = join_back(join_back(spans, summed, keys, "left"), last_signals(marked, spec=spec), keys, "left")
        return joined.fillna(0, subset=["trades", "closed", "wins", "total_return", "total_return_rate"])

    def reports(
        self, bars: DataFrame, task_id: Column, base: str, at: Column, store: str | None = None
    ) -> DataFrame:
        """Rows of the results table, one per series, with filled summaries."""
        day = "yyyy-MM-dd"
        model = {
            "code": F.col("code"),
            "candle": F.col("candle"),
            "start_time": F.date_format("start_time", day),
            "end_time": F.date_format("end_time", day),
        }
        factors = F.struct(
            F.lit(self.exits.profit_factor).alias("profit_factor"), F.lit(self.exits.loss_factor).alias("loss_factor")
        )
        tester = {"shift_signal": F.lit(self.shift_signal)}
        rows = self.summaries(bars, store).select(
            task_id.alias("task_id"),
            strategy_json(F.lit(self.strategy.name), model, factors).alias("strategy_parms"),
            F.to_json(F.struct(*(value.alias(name) for name, value in tester.items()))).alias("tester_params"),
            "total_return",
            "total_return_rate",
            at.alias("completed_at"),
        )
        return report_rows(rows, base, tester, at)
