import numpy as np
import pandas as pd
import pytest
from barsets import LAYOUTS, assert_same, flat, market, per_series, spark_bars, walk
from pyspark.sql import functions as F

from barloom.operators.candles import add_candle_features
from barloom.operators.ewm import Decay, Ewm, add_ewms, drop_run_columns
from barloom.operators.indicators import (
    ATR, BIAS, EMA, MA, MACD, RSI, BollingerBands, Engulfing, KeltnerChannels, apply_indicators,
)
from barloom.operators.patterns import add_sequence_patterns
from barloom.operators.returns import add_log_returns
from barloom.operators.series import SeriesSpec, block_rows, over_rows, running_sum, with_index
from barloom.operators.signals import mark_signals

ALL = [BollingerBands(), ATR(), KeltnerChannels(), RSI(), MACD(), EMA(), MA(), BIAS(), Engulfing()]


def ema(x, n):
    return x.ewm(span=n, min_periods=n).mean()


def plain(g):
    g = g.copy()
    typical = (g.close + g.high + g.low) / 3
    g["BB_MA"] = typical.rolling(20).mean()
    dev = typical.rolling(20).std()
    g["BB_UP"], g["BB_LW"] = g.BB_MA + 2 * dev, g.BB_MA - 2 * dev
    prev = g.close.shift(1)
    tr = pd.concat([g.high - g.low, (g.high - prev).abs(), (prev - g.low).abs()], axis=1).max(axis=1)
    g["ATR_14"], g["ATR_10"] = tr.rolling(14).mean(), tr.rolling(10).mean()
    g["EMA_20"], g["EMA_10"] = ema(g.close, 20), ema(g.close, 10)
    g["KeUp"], g["KeLo"] = g.EMA_20 + 2 * g.ATR_10, g.EMA_20 - 2 * g.ATR_10
    move = g.close.diff()
    up = move.clip(lower=0).ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
    down = (-move.clip(upper=0)).ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
    with np.errstate(all="ignore"):
        g["RSI_14"] = (100 - 100 / (1 + up / down)).round(2)
    g["MACD"] = ema(g.close, 12) - ema(g.close, 26)
    g["MACD_SIGNAL"] = ema(g.MACD, 9)
    g["HIST"] = g.MACD - g.MACD_SIGNAL
    g["MA_10"] = g.close.rolling(10).mean()
    g["BIAS_20"] = (g.close - g.EMA_20) / g.EMA_20 * 100
    change = g.close - g.open
    side = pd.Series(np.where(change >= 0, 1, -1), index=g.index)
    size = change.abs()
    g["ENGULFING"] = (side != side.shift(1)) & side.shift(1).notna() & (size > size.shift(1) * 1.1)
    return g


COLUMNS = [
    "BB_MA", "BB_UP", "BB_LW", "ATR_14", "ATR_10", "EMA_20", "EMA_10", "KeUp", "KeLo", "RSI_14",
    "MACD", "MACD_SIGNAL", "HIST", "MA_10", "BIAS_20", "ENGULFING",
]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_all_indicators_equal_pandas(spark, layout):
    pdf = market()
    got = apply_indicators(spark_bars(spark, pdf), ALL, LAYOUTS[layout])
    assert_same(got, per_series(pdf, plain), COLUMNS)
    assert not [c for c in got.columns if c.startswith("_")]


@pytest.mark.parametrize("indicator", ALL, ids=lambda i: i.info.name)
def test_single_indicator(spark, indicator):
    pdf = walk("2330", 400, 9)
    got = indicator.apply(spark_bars(spark, pdf))
    assert_same(got, per_series(pdf, plain), list(indicator.info.display_name))


def test_long_series_crosses_many_runs(spark):
    pdf = walk("LONG", 9000, 11, step="1h")
    for layout in ("whole", "blocks"):
        got = apply_indicators(spark_bars(spark, pdf), [MACD(), EMA(2), EMA(200)], LAYOUTS[layout])
        want = pdf.assign(EMA_2=ema(pdf.close, 2), EMA_200=ema(pdf.close, 200))
        want["MACD"] = ema(pdf.close, 12) - ema(pdf.close, 26)
        want["MACD_SIGNAL"] = ema(want.MACD, 9)
        assert_same(got, want, ["EMA_2", "EMA_200", "MACD", "MACD_SIGNAL"])


def test_span_one_is_the_value(spark):
    pdf = walk("A", 20, 1)
    assert_same(EMA(1).apply(spark_bars(spark, pdf)), pdf.assign(EMA_1=pdf.close), ["EMA_1"])


def test_rsi_of_one_sided_series(spark):
    pdf = pd.concat([flat("RISE", 40, slope=1.0), flat("FLAT", 40), flat("FALL", 40, price=90, slope=-1.0)])
    rows = RSI().apply(spark_bars(spark, pdf)).where("RSI_14 is not null").toPandas()
    assert set(rows[rows.code == "RISE"].RSI_14) == {100.0}
    assert set(rows[rows.code == "FALL"].RSI_14) == {0.0}
    assert len(rows[rows.code == "FLAT"]) == 0
    assert len(rows[rows.code == "RISE"]) == 40 - 14


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("gaps", ["few", "long", "most"])
def test_nulls_between_values(spark, layout, gaps):
    pdf = walk("A", 900, 4)
    holes = {"few": [20, 21, 35, 300], "long": [*range(3), *range(40, 430), 500], "most": [i for i in range(900) if i % 5 and i % 7]}
    pdf.loc[holes[gaps], "close"] = np.nan
    bars = spark_bars(spark, pdf).withColumn("close", F.when(~F.isnan("close"), F.col("close")))
    means = [
        Ewm(f"m{span}_{adjust}", lambda frame: F.col("close"), Decay.of_span(span), 5, adjust=adjust)
        for span in (2, 5, 40) for adjust in (True, False)
    ]
    got = over_rows(
        bars, 1 + max(m.decay.reach for m in means), lambda d, f: drop_run_columns(add_ewms(d, f, means), d.columns), LAYOUTS[layout]
    )
    want = pdf.assign(**{
        m.out: pdf.close.ewm(alpha=m.decay.alpha, min_periods=5, adjust=m.adjust).mean() for m in means
    })
    assert_same(got, want, [m.out for m in means])


@pytest.mark.parametrize("layout", LAYOUTS)
def test_index_and_running_sum(spark, layout):
    pdf = market()
    bars = spark_bars(spark, pdf)
    want = per_series(pdf, lambda g: g.assign(i=np.arange(len(g)), s=g.close.cumsum()))
    assert_same(with_index(bars, LAYOUTS[layout], "i"), want, ["i"])
    assert_same(running_sum(bars, "close", "s", LAYOUTS[layout]), want, ["s"], atol=1e-7)


def test_bias_uses_a_given_mean(spark):
    pdf = walk("A", 40, 5).assign(EMA_20=50.0)
    got = BIAS().apply(spark_bars(spark, pdf))
    assert_same(got, pdf.assign(BIAS_20=(pdf.close - 50) / 50 * 100), ["BIAS_20", "EMA_20"])


def test_null_keys_are_a_series_in_both_layouts(spark):
    pdf = pd.concat([walk("A", 20, 1), walk("A", 9, 2).assign(code=None)])
    rows = {
        name: sorted(map(repr, MA(3).apply(spark_bars(spark, pdf), layout).select("id", "code", "MA_3").collect()))
        for name, layout in LAYOUTS.items()
    }
    assert len(rows["whole"]) == 29
    assert all(found == rows["whole"] for found in rows.values())
    assert sum("code=None" in row and "MA_3=None" not in row for row in rows["whole"]) == 7


def test_layout_follows_the_rows(spark):
    """Uneven times, rows without time, series of other density: the same rows, in blocks of a bounded size."""
    hot = walk("HOT", 900, 1, step="7min")
    # half of the rows within three minutes
    hot.loc[:449, "trade_time"] = hot.trade_time[0] - pd.to_timedelta(np.arange(450)[::-1] * 400, unit="ms")
    pdf = pd.concat([hot, walk("A", 50, 2), walk("B", 200, 3, step="90D").head(90)])
    tight = SeriesSpec(block_rows=64)
    got = apply_indicators(spark_bars(spark, pdf), [MA(5), EMA(3)], tight)
    want = per_series(pdf, lambda g: g.assign(MA_5=g.close.rolling(5).mean(), EMA_3=ema(g.close, 3)))
    assert_same(got, want, ["MA_5", "EMA_3"])
    timeless = pdf.assign(trade_time=pdf.trade_time.where(pdf.id % 90 != 7))
    index = with_index(spark_bars(spark, timeless), tight, "i").toPandas()
    for _, rows in index.groupby("code"):
        ordered = rows.sort_values(["trade_time", "id"], na_position="first")
        assert ordered.i.tolist() == list(range(len(rows)))


def test_no_job_runs_before_the_action(spark):
    bars = spark_bars(spark, market())
    bars.count()
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    frames = [
        apply_indicators(bars, [MA(5), EMA(3), RSI(7)]), running_sum(bars, "close", "s"), add_log_returns(bars),
        add_sequence_patterns(add_candle_features(bars)), mark_signals(bars, lambda: F.lit(1), shift=True),
    ]
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert all(frame.columns for frame in frames)


def test_blocks_follow_the_session(spark):
    bars = spark_bars(spark, walk("A", 5, 1))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    given = spark.conf.get(name)
    try:
        sizes = []
        for text in ("64MB", "67108864", "67108864b", "1g"):
            spark.conf.set(name, text)
            sizes.append(block_rows(bars, SeriesSpec()))
    finally:
        spark.conf.set(name, given)
    assert sizes[0] == sizes[1] == sizes[2] == sizes[3] // 16 > 100_000
    assert block_rows(bars, SeriesSpec(block_rows=7)) == 7


def test_indicator_info():
    assert MACD().info.display_name == ("MACD", "MACD_SIGNAL", "HIST")
    assert RSI(7).info.params == {"period": 7}
    assert KeltnerChannels().info.params == {"ema_period": 20, "atr_period": 10}
