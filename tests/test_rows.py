from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from barsets import LAYOUTS, assert_same, market, per_series, spark_bars, walk
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barloom.functions import numeric, text, times
from barloom.operators import candles, clean, patterns, returns, series, validate
from barloom.schema import BAR_SCHEMA


def one(spark, column, **inputs):
    return spark.createDataFrame(pd.DataFrame({k: [v] for k, v in inputs.items()})).select(column.alias("r")).first().r


def plain_features(g):
    change, span = g.close - g.open, g.high - g.low
    safe = span.replace(0, np.nan)
    upper, lower = g[["close", "open"]].max(axis=1), g[["close", "open"]].min(axis=1)
    return g.assign(
        body_perc=((change.abs() / safe) * 100).fillna(0).round(2),
        body_bottom_perc=((lower - g.low) / safe).fillna(0) * 100,
        body_top_perc=100 - ((g.high - upper) / safe).fillna(0) * 100,
        direction=np.where(change >= 0, 1, -1),
        body_size=change.abs(), mid_point=span / 2 + g.low, daily_range=span, body_upper=upper, body_lower=lower,
    )


def test_features_equal_pandas(spark):
    pdf = market()
    got = candles.add_candle_features(spark_bars(spark, pdf))
    new = ["body_perc", "body_bottom_perc", "body_top_perc", "direction", "body_size", "mid_point", "daily_range"]
    assert_same(got, per_series(pdf, plain_features), new)


def test_feature_values_by_hand(spark):
    bar = walk("T2330", 1, 1).assign(open=100.0, close=101.0, high=102.0, low=99.0)
    row = candles.add_candle_features(spark_bars(spark, bar, 1)).first()
    assert (row.body_size, row.daily_range, row.body_perc, row.mid_point, row.direction) == (1.0, 3.0, 33.33, 100.5, 1)
    assert row.body_bottom_perc == pytest.approx(100 / 3) and row.body_top_perc == pytest.approx(200 / 3)


def test_trend_direction(spark):
    pdf = pd.concat([walk("A", 1, i).assign(open=o, close=c) for i, (o, c) in enumerate([(1.0, 2.0), (2.0, 1.0), (1.0, 1.0)])])
    got = candles.add_trend_direction(spark_bars(spark, pdf, 1)).orderBy("id").toPandas()
    assert list(got.direction) == [1, -1, 0]
    with pytest.raises(ValueError):
        candles.add_trend_direction(spark.range(1))


def plain_patterns(g):
    g = plain_features(g)
    prev, prev2 = g.shift(1), g.shift(2)
    turned = (g.direction != prev.direction) & prev.direction.notna()

    def change(c):
        return (g[c] - prev[c]) / prev[c].replace(0, np.nan) * 100

    near = (change("body_size").abs() < 15) & (change("low").abs() < 0.01) & (change("high").abs() < 0.01)
    doji = (prev2.body_perc > 90) & (prev.body_perc < 10)
    return g.assign(
        marubozu=g.body_perc > 98,
        hanging_man=(g.body_bottom_perc > 75) & (g.body_perc < 15),
        shooting_star=(g.body_top_perc < 25) & (g.body_perc < 15),
        spinning_top=(g.body_top_perc < 60) & (g.body_bottom_perc > 40) & (g.body_perc < 15),
        engulfing=turned & (g.body_size > prev.body_size * 1.1),
        tweezer_top=near & (g.direction == -1) & turned & (g.body_top_perc < 40),
        tweezer_bottom=near & (g.direction == 1) & turned & (g.body_bottom_perc > 60),
        morning_star=doji & (g.direction == 1) & (prev2.direction != 1) & (g.close > prev2.mid_point),
        evening_star=doji & (g.direction == -1) & (prev2.direction != -1) & (g.close < prev2.mid_point),
    )


def staged_patterns():
    """Bars built to show every pattern of several bars."""
    bars = [
        (30, 20, 30, 20), (20, 20.1, 25, 15), (24, 29, 30, 23),  # morning star
        (20, 30, 30, 20), (30, 30.1, 35, 25), (26, 21, 27, 20),  # evening star
        (11, 12, 20, 10), (12, 11, 20.0005, 10.0005),  # tweezer top
        (19, 18, 20, 10), (18, 19, 20, 10),  # tweezer bottom
        (1, 1, 1, 1), (10, 20, 20, 10),
    ]
    pdf = walk("P", len(bars), 1)
    pdf[["open", "close", "high", "low"]] = np.array(bars, dtype=float)
    return pdf


@pytest.mark.parametrize("layout", LAYOUTS)
def test_patterns_equal_pandas(spark, layout):
    pdf = pd.concat([market(), staged_patterns()], ignore_index=True)
    featured = candles.add_candle_features(spark_bars(spark, pdf))
    got = patterns.add_sequence_patterns(patterns.add_bar_patterns(featured), spec=LAYOUTS[layout])
    want = per_series(pdf, plain_patterns)
    names = [*patterns.BAR_PATTERNS, *patterns.SEQUENCE_PATTERNS]
    assert_same(got, want, names)
    assert all(want[n].any() for n in names if n not in ("hanging_man",)), want[names].sum().to_dict()


def test_clean_rows(spark):
    schema = "id long, code string, open double, high decimal(10,2), low double, close double, at timestamp, flag boolean"
    at = datetime(2024, 1, 1, 12)
    rows = [
        (1, " \t\u3000x\n", 1.0, Decimal("2.50"), 0.5, 1.5, at, None),
        (2, " None", 1.0, Decimal("2.00"), 0.5, 1.5, at, True),
        (3, "y", float("nan"), Decimal("2.00"), 0.5, 1.5, at, True),
        (4, "y", 1.0, None, 0.5, 1.5, at, True),
    ]
    got = clean.clean_rows(spark.createDataFrame(rows, schema)).orderBy("id")
    assert dict(got.dtypes)["high"] == "double" and dict(got.dtypes)["at"] == "timestamp_ntz"
    assert [tuple(r) for r in got.collect()] == [
        (1, "x", 1.0, 2.5, 0.5, 1.5, at, False), (2, None, 1.0, 2.0, 0.5, 1.5, at, True),
    ]


def test_date_range_groups_null_keys(spark):
    pdf = pd.concat([walk("A", 4, 1), walk("A", 3, 2).assign(code=None)])
    got = clean.add_date_range(spark_bars(spark, pdf)).toPandas()
    assert len(got) == 7
    assert set(got[got.code.isna()].end_date) == {date(2024, 1, 4)}
    assert set(got[got.code == "A"].end_date) == {date(2024, 1, 5)}


def test_first_per_date_and_newest_per_key(spark):
    pdf = walk("A", 50, 1, step="1h")
    got = clean.first_per_date(spark_bars(spark, pdf)).toPandas()
    want = pdf.sort_values("trade_time").groupby(pdf.trade_time.dt.date).first()
    assert sorted(got.id) == sorted(want.id)
    copies = spark_bars(spark, pd.concat([pdf.assign(id=i, volume=i) for i in range(3)]))
    newest = clean.newest_per_key(copies, ["code", "trade_time"], ["id"]).toPandas()
    assert len(newest) == 50 and set(newest.volume) == {2}


def test_returns_equal_pandas(spark):
    pdf = walk("A", 60, 1, step="12h")
    pdf.loc[5, "volume"] = None
    bars = spark.createDataFrame(pdf.astype({"volume": "Int64"})).repartition(3)
    got = returns.preprocess_bars(bars)
    want = pdf.dropna().sort_values("trade_time")
    want = want[~want.trade_time.dt.date.duplicated()].reset_index(drop=True)
    want["log_returns"] = np.log(want.close / want.close.shift(1))
    want["cusum_rewards"] = np.exp(want.log_returns.cumsum())
    assert_same(got, want, ["log_returns", "cusum_rewards"])
    assert "id" not in got.columns

    r, years = want.log_returns, (len(want) - 1) / 365.25
    annual = np.exp(r.sum() / years) - 1
    row = returns.risk_metrics(got).first()
    assert row.annualized_return == pytest.approx(annual * 100)
    assert row.annualized_risk == pytest.approx(r.std() * np.sqrt(years) * 100)
    assert row.sharpe_ratio == pytest.approx((annual - 0.02) / (r.std() * np.sqrt(years)))
    assert returns.growth_rate(got).first().cagr == pytest.approx(annual * 100)
    usual = returns.risk_metrics(got, periods_per_year=252).first()
    assert usual.annualized_risk == pytest.approx(r.std() * np.sqrt(252) * 100)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_growth_in_every_layout(spark, layout):
    pdf = market()
    pdf[["open", "high", "low", "close"]] = pdf[["open", "high", "low", "close"]].abs() + 1
    spec = LAYOUTS[layout]
    got = returns.add_growth(returns.add_log_returns(spark_bars(spark, pdf), spec=spec), spec=spec)
    want = per_series(pdf, lambda g: g.assign(cusum_rewards=g.close / g.close.iloc[0]))
    first = want.groupby(["code", "candle"]).trade_time.transform("min") == want.trade_time
    want.loc[first, "cusum_rewards"] = np.nan
    assert_same(got, want, ["cusum_rewards"], atol=1e-7)


def test_returns_of_bad_prices_are_null(spark):
    pdf = walk("A", 4, 1).assign(close=[1.0, 0.0, 2.0, -1.0])
    assert returns.add_log_returns(spark_bars(spark, pdf)).where("log_returns is not null").count() == 0


def test_gates(spark):
    pdf = walk("A", 5, 1).assign(
        volume_weight=1, updated_at=pd.Timestamp("2024-01-01"), created_at=pd.Timestamp("2024-01-01")
    )
    bars = spark_bars(spark, pdf)
    assert validate.require_bars(bars).count() == 5
    broken = bars.withColumn("open", F.when(F.col("id") % 2 == 0, F.col("open"))).withColumn(
        "code", F.lit(None).cast("string")).withColumn("high", F.col("high").cast("string")).drop("candle")
    with pytest.raises(validate.SchemaError) as error:
        validate.require_bars(broken)
    for part in ("open: 2 nulls", "code: 5 nulls", "high: type string", "candle: missing"):
        assert part in str(error.value)
    assert not [f for f in validate.type_failures(bars.withColumn("more", F.lit(1)), BAR_SCHEMA)]


def test_key_reference_and_domain_checks(spark):
    pdf = pd.concat([walk("A", 3, 1), walk("A", 1, 2)])
    assert [r.n for r in validate.repeated_keys(spark_bars(spark, pdf)).collect()] == [2]
    children = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, ref string")
    parents = spark.createDataFrame([("a",), ("a",)], "key string")
    assert [r.id for r in validate.orphans(children, "ref", parents, "key").collect()] == [2]
    assert [tuple(r) for r in validate.outside_domain(children, "ref", ["a"]).collect()] == [("b", 1)]


def test_code_lists(spark):
    cases = {'["1103", "1104"]': ["1103", "1104"], "[2330, 2317]": ["2330", "2317"], "2330": ["2330"], "[]": [], " ": []}
    for given, want in cases.items():
        assert text.parse_codes(given) == want
        assert one(spark, text.parse_codes_column(F.col("c")), c=given) == want
    assert text.parse_codes([2330, 2317]) == ["2330", "2317"]


def test_numbers(spark):
    assert one(spark, numeric.half_even(F.col("x")), x=0.125) == 0.12
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(-10**6, 10**6, 3000) / 1000 * 1.0, rng.integers(0, 10**5, 2000) / 8, [2.675, 1.005, 0.125]])
    frame = spark.createDataFrame(pd.DataFrame({"x": values}))
    for digits in (0, 2, 4):
        got = frame.select("x", numeric.to_decimal(F.col("x"), digits).alias("r")).toPandas()
        assert all(Decimal(str(round(x, digits))) == r for x, r in zip(got.x, got.r))
    assert one(spark, numeric.to_decimal_exact(F.col("x")), x=0.1) == Decimal("0.1")
    assert one(spark, numeric.safe_ln(F.col("x")), x=-1.0) is None
    assert one(spark, numeric.calendar_days_column(F.col("x")), x=3) == 8
    assert one(spark, numeric.calendar_days_column(F.col("x")), x=1) == 2


def test_times(spark):
    assert one(spark, times.utc_midnight(F.col("d")), d="2024-02-03") == datetime(2024, 2, 3)
    assert one(spark, times.utc_midnight(F.col("d"), strict=False), d="2024-02-30") is None
    with pytest.raises(PySparkException, match="not a YYYY-MM-DD"):
        one(spark, times.utc_midnight(F.col("d")), d="03.02.2024")
    assert one(spark, times.rfc3339(F.col("t")), t=datetime(2024, 2, 3, 4, 5)) == "2024-02-03T00:00:00Z"
    assert one(spark, times.to_time(F.col("t")), t="20240203") == datetime(2024, 2, 3)
    assert one(spark, times.to_time(F.col("t")), t="soon") is None
    local = one(spark, times.local_naive(F.col("t").cast("timestamp"), "Asia/Taipei"), t="2024-01-01T00:00:00Z")
    assert local == datetime(2024, 1, 1, 8)


def test_texts(spark):
    name = "gs://lake/bars/T_X_1d_2024-01-01_2024-01-03.parquet/part-00000.snappy.parquet"
    parsed = one(spark, text.parse_dataset(F.col("p")), p=name)
    assert tuple(parsed) == ("T_X", "1d", date(2024, 1, 1), date(2024, 1, 3))
    assert one(spark, text.parse_dataset(F.col("p")), p=name.replace("T_X", "TEMP_T")) is None
    assert one(spark, text.parse_dataset(F.col("p")), p="other/file.parquet") is None
    assert one(spark, text.merge_json(F.col("a"), F.col("b")), a='{"a":1,"c":[1]}', b='{"b":2,"a":null}') == '{"c":[1],"a":null,"b":2}'
    assert tuple(one(spark, text.split_object_path(F.col("u")), u="s3://b/k/x/")) == ("b", "k/x")
    assert one(spark, text.split_object_path(F.col("u")), u="gs://b") is None
    import hashlib
    import json

    fields = {"name": "策略", "code": "0050", "n": 3, "gone": None}
    want = hashlib.md5(json.dumps(fields, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    columns = {"name": F.lit("策略"), "code": F.lit("0050"), "n": F.lit(3), "gone": F.lit(None).cast("string")}
    assert one(spark, text.deterministic_key(columns), x=1) == want


def test_slices_of_a_long_span(spark):
    # microseconds of the whole calendar times the rows of a block are beyond a long
    pdf = walk("A", 40, 1).drop(columns="trade_time")
    year = F.make_date(F.pmod(F.col("id"), F.lit(40)).cast("int") * 250 + 1, F.lit(1), F.lit(1))
    bars = spark.createDataFrame(pdf).withColumn("trade_time", year.cast("timestamp"))
    got = series.with_index(bars, series.SeriesSpec(block_rows=35)).select("id", "_pos").collect()
    assert {row.id % 40: row._pos for row in got} == {n: n for n in range(40)}
