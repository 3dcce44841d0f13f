import numpy as np
import pandas as pd
import pytest
from barsets import LAYOUTS, assert_same, flat, market, per_series, spark_bars, walk
from pyspark.sql import functions as F

from barloom.operators import signals
from barloom.operators.indicators import MA
from barloom.operators.trades import find_trades, no_trades, tree_height, trade_summary
from barloom.plans.backtest import BackTest
from barloom.schema import TRADE_SCHEMA

FACTORS = signals.ExitFactors(0.01, -0.01)
COLUMNS = ["close_index", "start_price", "TP", "SL", "close_price", "total_return", "total_return_rate"]


def rule():
    change = F.col("close") - F.col("open")
    return F.when(change > 0.5, signals.BUY).when(change < -0.5, signals.SELL).otherwise(0)


def plain_marks(g):
    change = g.close - g.open
    g = g.assign(SIGNAL=np.where(change > 0.5, 1, np.where(change < -0.5, -1, 0)))
    return g.assign(
        TP=np.where(g.SIGNAL != 0, g.open * 1.01, 0.0), SL=np.where(g.SIGNAL != 0, g.open * 0.99, 0.0)
    )


def plain_trades(g):
    """Each entry followed by a loop over the later bars."""
    g = plain_marks(g)
    rows = []
    for i in g.index[g.SIGNAL == 1]:
        entry, out = g.loc[i], None
        for j in range(i + 1, len(g)):
            bar = g.loc[j]
            if bar.SIGNAL == -1 and (bar.high >= entry.TP or bar.low <= entry.SL):
                out = (j, bar.trade_time, bar.high if bar.high >= entry.TP else bar.low, "close")
                break
        if out is None:
            out = (len(g) - 1, g.trade_time.iloc[-1], g.close.iloc[-1], "open")
        gain = out[2] - entry.open
        rows.append(
            dict(code=entry.code, candle=entry.candle, start_index=i, close_index=out[0], start_time=entry.trade_time,
                 end_time=out[1], start_price=entry.open, TP=entry.TP, SL=entry.SL, close_price=out[2],
                 total_return=gain or None, total_return_rate=(gain / entry.open) or None, status=out[3])
        )
    return pd.DataFrame(rows)


def marked(spark, pdf):
    return signals.add_levels(signals.mark_signals(spark_bars(spark, pdf), rule), FACTORS.levels)


@pytest.mark.parametrize("layout, fan", [("whole", 3), ("whole", 128), ("blocks", 9), ("longer_blocks", 128)])
def test_trades_equal_a_plain_loop(spark, layout, fan):
    pdf = market()
    got = find_trades(marked(spark, pdf), spec=LAYOUTS[layout], fan=fan)
    want = per_series(pdf, plain_trades)
    assert_same(got, want, COLUMNS, keys=("code", "candle", "start_index", "end_time", "status"))
    assert got.columns == ["code", "candle", *TRADE_SCHEMA.names]


def test_falling_series_sends_all_entries_to_one_bar(spark):
    """Entries that no bar closes until a single last one: the worst case for a target bar."""
    n = 300
    pdf = flat("ONE", n, price=100.0).assign(high=100.0, low=100.0)
    pdf["open"], pdf["close"] = 100.0, 101.0
    pdf.loc[n - 1, ["open", "close", "high", "low"]] = [100.0, 90.0, 100.0, 90.0]
    got = find_trades(marked(spark, pdf), fan=4).toPandas()
    assert len(got) == n - 1
    assert set(got.close_index) == {n - 1} and set(got.status) == {"close"} and set(got.close_price) == {90.0}


def test_open_trades_keep_nulls_without_forced_close(spark):
    pdf = flat("UP", 10, price=100.0).assign(close=101.0)
    got = find_trades(marked(spark, pdf), close_open_trades=False).toPandas()
    assert len(got) == 10 and got.close_price.isna().all() and set(got.status) == {"open"}


def test_no_entries_and_empty_result(spark):
    pdf = flat("FLAT", 10)
    assert find_trades(marked(spark, pdf)).count() == 0
    assert no_trades(spark).columns == TRADE_SCHEMA.names


def test_tree_height():
    assert [tree_height(n, 4) for n in (0, 1, 4, 5, 16, 17, 64, 65)] == [1, 1, 1, 2, 2, 3, 3, 4]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_shift_moves_signals_and_fills(spark, layout):
    pdf = market()
    averaged = MA(3).apply(spark_bars(spark, pdf), LAYOUTS[layout])
    got = signals.mark_signals(averaged, rule, shift=True, spec=LAYOUTS[layout])

    def plain(g):
        g = plain_marks(g).assign(MA_3=g.close.rolling(3).mean().fillna(0))
        return g.assign(SIGNAL=g.SIGNAL.shift(1).fillna(0))

    assert_same(got, per_series(pdf, plain), ["SIGNAL", "MA_3"])
    kept = signals.mark_signals(averaged, rule, shift=True, fill=False, spec=LAYOUTS[layout])
    assert kept.where("MA_3 is null").count() > 0 and kept.where("SIGNAL is null").count() == 0


def test_last_signals(spark):
    pdf = walk("A", 30, 2).assign(SIGNAL=0)
    pdf.loc[24, "SIGNAL"] = 1
    other = walk("B", 30, 3).assign(SIGNAL=0)
    other.loc[[25, 27], "SIGNAL"] = [1, -1]
    both = spark_bars(spark, pd.concat([pdf, other]))
    assert {r.code: r.last_signal for r in signals.last_signals(both).collect()} == {"A": 0, "B": -1}
    assert {r.code: r.last_signal for r in signals.last_signals(both, look_back=6).collect()} == {"A": 1, "B": -1}
    assert {r.code: r.last_signal for r in signals.last_signals(both, default=7).collect()} == {"A": 7, "B": -1}


def test_last_rows_are_limited_before_the_shuffle(spark):
    plan = signals.last_rows(spark_bars(spark, market()), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_backtest_reports_cover_every_series(spark):
    pdf = market()
    test = BackTest(signals.Strategy("demo", rule, [MA(3)]), FACTORS)
    rows = test.reports(spark_bars(spark, pdf), F.col("code"), "/out", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    found = rows.toPandas()
    assert len(found) == pdf.groupby(["code", "candle"]).ngroups
    assert found.key_string.is_unique and found.summary.notna().all()


def test_trade_summary(spark):
    pdf = market()
    got = trade_summary(find_trades(marked(spark, pdf))).toPandas().set_index(["code", "candle"])
    want = per_series(pdf, plain_trades).groupby(["code", "candle"]).agg(trades=("start_index", "size"), total=("total_return", "sum"))
    assert (got.trades.sort_index() == want.trades.sort_index()).all()
    np.testing.assert_allclose(got.total_return.sort_index(), want.total.sort_index())


def test_look_back():
    from datetime import datetime

    strategy = signals.Strategy("s", rule, look_back=5)
    assert strategy.first_time(datetime(2024, 1, 13)) == datetime(2024, 1, 1)
    assert signals.calendar_days(3) == 8 and signals.calendar_days(1) == 2 and signals.calendar_days(-1) == 0
