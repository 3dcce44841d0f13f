"""Generated bar series and plain pandas versions of the series operators."""

import numpy as np
import pandas as pd

from barloom.operators.series import SeriesSpec

# Block sizes every series operator must agree on: whole series, and series cut into blocks and slices.
LAYOUTS = {
    "whole": SeriesSpec(),
    "blocks": SeriesSpec(block_rows=16),
    "longer_blocks": SeriesSpec(block_rows=64),
}


def walk(code, n, seed, candle="d1", step="1D"):
    rng = np.random.default_rng(seed)
    close = 100 + np.cumsum(rng.normal(0, 1, n)).round(2)
    close = np.where(rng.random(n) < 0.1, np.roll(close, 1), close)
    open_ = (close + rng.normal(0, 0.8, n)).round(2)
    high = (np.maximum(open_, close) + rng.random(n).round(2)).round(2)
    low = (np.minimum(open_, close) - rng.random(n).round(2)).round(2)
    return pd.DataFrame(
        {
            "id": np.arange(n) + seed * 100_000,
            "code": code,
            "candle": candle,
            "open": open_,
            "close": close,
            "high": high,
            "low": low,
            "trade_time": pd.Timestamp("2024-01-02 09:00") + pd.to_timedelta(np.arange(n) * pd.Timedelta(step)),
            "volume": rng.integers(1, 1000, n),
        }
    )


def flat(code, n, price=10.0, slope=0.0):
    close = price + slope * np.arange(n)
    return walk(code, n, 77).assign(code=code, open=close, close=close, high=close, low=close)


def market():
    """Long, medium, short and one-row series; flat, rising and falling ones; two candles."""
    return pd.concat(
        [
            walk("2330", 700, 1),
            walk("0050", 130, 2),
            walk("0050", 90, 3, candle="h1", step="1h"),
            walk("1101", 20, 4),
            walk("9999", 1, 5),
            flat("FLAT", 60),
            flat("RISE", 60, slope=1.0),
            flat("FALL", 60, price=100.0, slope=-1.0),
        ],
        ignore_index=True,
    )


def spark_bars(spark, pdf, parts=5):
    shuffled = pdf.sample(frac=1.0, random_state=3)
    return spark.createDataFrame(shuffled).repartition(parts)


def per_series(pdf, fn):
    ordered = pdf.sort_values(["code", "candle", "trade_time", "id"])
    return pd.concat([fn(g.reset_index(drop=True)) for _, g in ordered.groupby(["code", "candle"])], ignore_index=True)


def assert_same(df, expected, columns, keys=("code", "candle", "trade_time"), atol=1e-9):
    keys = list(keys)
    got = df.select(*keys, *columns).toPandas().sort_values(keys).reset_index(drop=True)
    want = expected[keys + list(columns)].sort_values(keys).reset_index(drop=True)
    assert len(got) == len(want)
    for c in keys:
        assert (got[c].astype(str) == want[c].astype(str)).all(), c
    for c in columns:
        if got[c].dtype == bool or want[c].dtype == bool:
            assert (got[c].astype(bool) == want[c].astype(bool)).all(), c
        else:
            np.testing.assert_allclose(
                got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=atol, equal_nan=True, err_msg=c
            )
