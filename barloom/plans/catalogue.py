"""The query catalogue: every operator over the test tables, as (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import numeric, text, times
from barloom.operators import (
    candles, clean, numbering, patterns, returns, series, signals, similar, trades, upsert, validate,
)
from barloom.operators.indicators import (
    ATR, BIAS, EMA, MA, MACD, RSI, BollingerBands, Engulfing, Indicator, KeltnerChannels, apply_indicators,
)
from barloom.plans import preprocess, results, tasks
from barloom.plans.backtest import BackTest
from barloom.plans.testbars import event_bars, month_bars, table
from barloom.schema import BAR_SCHEMA, FEATURE_SCHEMA, RUN_LOG_SCHEMA, TRADE_SCHEMA
from barloom.session import scratch_path
from barloom.sources import files
from barloom.sources.bars import select_bars, write_in_time_order
from barloom.sources.tables import BarTable, DatasetStore, KeyedTable
from barloom.streaming import bars as bar_stream
from barloom.streaming import messages

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}

SERIES = ("code", "candle", "trade_time")
FIXED_TIME = "2024-06-01 12:30:45"
LEVELS = signals.ExitFactors(0.05, -0.05)
FEATURES = (
    "direction", "body_size", "body_perc", "body_lower", "body_upper", "body_bottom_perc", "body_top_perc",
    "daily_range", "mid_point",
)


def query(function: Query) -> Query:
    """Register a query. Results carry naive UTC times, dates as text and doubles to 4 digits."""

    def finished(spark: SparkSession, folder: str) -> DataFrame:
        df = function(spark, folder)
        return df.select(*(_plain(f).alias(f.name) for f in df.schema.fields))

    CATALOGUE[function.__name__] = finished
    return function


def _plain(field: T.StructField) -> Column:
    column = F.col(field.name)
    match field.dataType:
        case T.TimestampType():
            return times.utc_naive(column)
        case T.DateType():
            return column.cast("string")
        case T.DoubleType() | T.DecimalType():
            return F.round(column.cast("double"), 4)
        case T.IntegerType() | T.ShortType():
            return column.cast("long")
        case _:
            return column


def _written(df: DataFrame, label: str) -> DataFrame:
    """The rows of a frame that several steps read, written to the shared folder once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fixed_time() -> Column:
    return F.lit(FIXED_TIME).cast("timestamp")


_uuid = text.uuid_from


# --- loading -----------------------------------------------------------------


@query
def load_filter(spark, folder):
    return select_bars(event_bars(spark, folder), "*", "2024-01-05", "2024-01-20", "h1")


@query
def load_codes(spark, folder):
    bars = select_bars(event_bars(spark, folder), '["click", " error ", "none"]', time_column="updated_at")
    return bars.select("id", *SERIES, "close", "volume")


@query
def coerce_prices(spark, folder):
    raw = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("open"),
        F.col("value").cast("decimal(10,2)").alias("close"),
    )
    return clean.coerce_prices(raw)


# --- cleaning and projection ---------------------------------------------------


@query
def candle_features(spark, folder):
    bars = clean.drop_row_stamps(event_bars(spark, folder))
    return candles.add_candle_features(bars)


@query
def clean_rows(spark, folder):
    kind = F.col("event_type")
    raw = table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "click", "  ").when(kind == "view", " nan").when(kind == "error", "None")
        .otherwise(F.concat(F.lit("  "), kind, F.lit(" "))).alias("label"),
        F.col("ts").cast("timestamp").alias("seen_at"),
        F.col("value").cast("decimal(12,2)").alias("open"),
        F.when(F.col("value") < 5, F.lit(float("nan"))).when(F.col("value") > 5, F.col("value")).alias("close"),
        F.when(F.col("value") < 50, F.col("value") > 20).alias("flag"),
    )
    return clean.clean_rows(raw)


@query
def date_range(spark, folder):
    ranged = clean.add_date_range(month_bars(spark, folder))
    return ranged.select("id", *SERIES, "trade_time_date", "start_date", "end_date")


@query
def prepared_bars(spark, folder):
    return preprocess.run_stages(event_bars(spark, folder))


@query
def decimals(spark, folder):
    values = table(spark, folder, "events").select("event_id", (F.col("value") / 8).alias("share"), "value")
    exact = clean.doubles_to_decimal(values.select("event_id", "value"))
    rounded = clean.doubles_to_decimal(values.select("event_id", "share"), 2)
    return exact.select("event_id", F.col("value").cast("decimal(20,4)").cast("string").alias("exact")).join(
        rounded.select("event_id", F.col("share").cast("string").alias("rounded")), "event_id"
    )


@query
def mixed_times(spark, folder):
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    raw = table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "view", F.date_format(ts, "yyyy/MM/dd"))
        .when(kind == "error", F.lit("no date"))
        .when(F.col("event_id") % 11 == 0, F.concat(F.date_format(ts, "EEE, dd MMMM yyyy hh:mm:ss a"), F.lit(" +08:00")))
        .when(F.col("event_id") % 11 == 1, F.date_format(ts, "d'th' MMM, yyyy HH:mm'Z'"))
        # read as day first only where the day cannot be a month
        .when(F.col("event_id") % 11 == 2, F.date_format(ts, "dd.MM.yyyy HH:mm:ss"))
        .when(F.col("event_id") % 5 == 0, F.date_format(ts, "MMM d, yyyy"))
        .when(F.col("event_id") % 5 == 1, F.date_format(ts, "MM/dd/yyyy"))
        .when(F.col("event_id") % 5 == 2, F.date_format(ts, "yyyyMMdd HHmmss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).alias("trade_time"),
    )
    return clean.column_to_time(raw, failed="failed")


@query
def drop_zone(spark, folder):
    stamped = table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return clean.drop_zone(stamped, zone="Asia/Taipei")


@query
def strategy_rows(spark, folder):
    strategy = signals.Strategy("plain", lambda: F.lit(0), [MA(5), MA(5)], ["volume"])
    return signals.prepare_bars(month_bars(spark, folder), strategy)


@query
def drop_incomplete(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("day"),
    )
    return clean.drop_incomplete(rows)


@query
def task_lookup(spark, folder):
    """The tasks of all orders with a returned item, by id."""
    known = table(spark, folder, "orders").select(_uuid(F.col("o_orderkey")).alias("id"), "o_orderkey", "o_orderstatus")
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(_uuid(F.col("l_orderkey")))
    return upsert.lookup(known, returned)


# --- checks ----------------------------------------------------------------------


@query
def input_gate(spark, folder):
    bars = event_bars(spark, folder).withColumns(
        {
            "code": F.when(F.col("code") != "error", F.col("code")),
            "close": F.when(F.col("volume") > 1, F.col("close")),
        }
    )
    return validate.null_counts(bars, BAR_SCHEMA)


@query
def output_gate(spark, folder):
    return validate.null_counts(preprocess.run_stages(event_bars(spark, folder)), FEATURE_SCHEMA)


@query
def ordered_bars(spark, folder):
    """Bars written in the order of time, with their place in it."""
    path = scratch_path(spark, "ordered")
    write_in_time_order(month_bars(spark, folder), path)
    return spark.read.parquet(path).select("id", *SERIES, "close", "position")


@query
def load_gate(spark, folder):
    """What becomes of three loads: one that is fine, one that matches nothing and one with missing codes."""
    bars = event_bars(spark, folder)
    loads = {
        "all": lambda: select_bars(bars),
        "none": lambda: select_bars(bars, "nobody"),
        "gaps": lambda: bars.withColumn("code", F.when(F.col("code") != "error", F.col("code"))),
    }
    outcomes = []
    for name, load in loads.items():
        path = scratch_path(spark, "gated")
        job = preprocess.PrepareJob(load, lambda df, path=path: df.write.parquet(path), stages=preprocess.PREPARE_STAGES[1:2])
        try:
            job.run()
            outcomes.append((name, "stored", spark.read.parquet(path).count()))
            files.remove(spark, path)
        except preprocess.StageError as error:
            outcomes.append((name, str(error), 0))
    return spark.createDataFrame(outcomes, "name string, outcome string, bars long")


@query
def prepared_datasets(spark, folder):
    """Two loads of bars through the whole job: each is stored as datasets, whose series are merged afterwards and noted by
    a second action."""
    store = DatasetStore(spark, scratch_path(spark, "prepared"))
    noted = scratch_path(spark, "noted")
    actions = [preprocess.merge_written_pairs(store), lambda df: clean.distinct_pairs(df, ordered=False).write.mode("append").parquet(noted)]
    bars = event_bars(spark, folder)
    for load in (bars.where("hour(trade_time) < 12"), bars.where("hour(trade_time) >= 8 AND code <> 'view'")):
        preprocess.PrepareJob(lambda load=load: load, preprocess.into_datasets(store), actions=actions).run()
    loads = spark.read.parquet(noted).groupBy("code", "candle").agg(F.count(F.lit(1)).alias("loads"))
    stored = store.read().groupBy("code", "candle").agg(F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"))
    named = store.datasets().groupBy("code", "candle").agg(F.count(F.lit(1)).alias("datasets"), F.max("name").alias("name"))
    return stored.join(loads, ["code", "candle"]).join(named, ["code", "candle"])


@query
def repeated_keys(spark, folder):
    return validate.repeated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def orphans(spark, folder):
    known = table(spark, folder, "customer").where("c_acctbal > 0")
    return validate.orphans(table(spark, folder, "orders"), "o_custkey", known, "c_custkey")


@query
def outside_domain(spark, folder):
    return validate.outside_domain(table(spark, folder, "orders"), "o_orderstatus", ["O", "F"])


@query
def request_checks(spark, folder):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    requests = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_custkey").cast("string")).alias("code"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(day)
        .alias("start_time"),
        day.alias("end_time"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "w1").otherwise("d1").alias("candle"),
        F.when(F.col("o_totalprice") < 50000, 0).otherwise(12).alias("pca_components"),
    )
    return requests.select("o_orderkey", F.array_join(validate.request_problems(), ",").alias("problems"))


# --- patterns and indicators -----------------------------------------------------


@query
def bar_patterns(spark, folder):
    flagged = patterns.add_bar_patterns(candles.add_candle_features(event_bars(spark, folder)))
    return flagged.select("id", *SERIES, *patterns.BAR_PATTERNS)


@query
def sequence_patterns(spark, folder):
    featured = candles.add_candle_features(month_bars(spark, folder))
    flagged = patterns.add_sequence_patterns(featured)
    return flagged.select("id", *SERIES, *patterns.SEQUENCE_PATTERNS)


@query
def tick_patterns(spark, folder):
    """Sequence patterns over prices in five steps, where neighbours often share highs and lows."""

    def step(price: Column) -> Column:
        return (
            F.when(price < 500, 100.0).when(price < 1000, 200.0).when(price < 2000, 300.0).when(price < 8000, 400.0).otherwise(500.0)
        )

    ticks = {c: step(F.col(c)) for c in ("open", "high", "low", "close")}
    featured = candles.add_candle_features(month_bars(spark, folder).withColumns(ticks))
    return patterns.add_sequence_patterns(featured).select("id", *SERIES, *patterns.SEQUENCE_PATTERNS)


def _indicator(name: str, indicator: Indicator, *extra: str) -> None:
    def run(spark, folder):
        return indicator.apply(month_bars(spark, folder)).select("id", *SERIES, *indicator.info.display_name, *extra)

    run.__name__ = name
    query(run)


def _gapped(spark, folder) -> DataFrame:
    """Bars of which some have no close."""
    bars = month_bars(spark, folder).withColumn("close", F.when(F.col("volume") % 6 != 0, F.col("close")))
    # their positions, slices and values are read apart
    return _written(bars, "gapped")


@query
def ema_gaps(spark, folder):
    return EMA().apply(_gapped(spark, folder)).select("id", *SERIES, "EMA_10")


@query
def rsi_gaps(spark, folder):
    return RSI().apply(_gapped(spark, folder)).select("id", *SERIES, "RSI_14")


@query
def null_series(spark, folder):
    """Bars without a code are one series."""
    bars = month_bars(spark, folder).withColumn("code", F.when(F.col("id") % 300_000 >= 100_000, F.col("code")))
    return apply_indicators(bars, [MA(), Engulfing()]).select("id", *SERIES, "MA_10", "ENGULFING")


_indicator("engulfing", Engulfing())
_indicator("bollinger", BollingerBands())
_indicator("atr", ATR())
_indicator("moving_average", MA())
_indicator("ema", EMA())
_indicator("macd", MACD())
_indicator("keltner", KeltnerChannels(), "EMA_20", "ATR_10")
_indicator("rsi", RSI())
_indicator("bias", BIAS())

PANEL = (
    BollingerBands(), ATR(), KeltnerChannels(), RSI(), MACD(), EMA(), MA(), BIAS(), Engulfing(),
)


@query
def indicator_panel(spark, folder):
    shown = [c for indicator in PANEL for c in indicator.info.display_name]
    return apply_indicators(event_bars(spark, folder), PANEL).select("id", *SERIES, *shown)


@query
def prepared_trend(spark, folder):
    """Prepared hourly bars with EMA, MACD and RSI: the flagship."""
    ready = preprocess.run_stages(event_bars(spark, folder))
    trend = apply_indicators(ready, [EMA(), MACD(), RSI()])
    return trend.select(
        "code", "trade_time", "direction", "body_perc", "start_date", "end_date",
        "EMA_10", "MACD", "MACD_SIGNAL", "HIST", "RSI_14",
    )


# --- returns -----------------------------------------------------------------------


@query
def log_returns(spark, folder):
    return returns.add_log_returns(month_bars(spark, folder)).select("id", *SERIES, "log_returns")


@query
def growth(spark, folder):
    grown = returns.add_growth(returns.add_log_returns(month_bars(spark, folder)))
    return grown.select("id", *SERIES, "log_returns", "cusum_rewards")


@query
def first_per_date(spark, folder):
    return clean.first_per_date(event_bars(spark, folder)).select("id", *SERIES, "open", "close")


@query
def daily_returns(spark, folder):
    return returns.preprocess_bars(event_bars(spark, folder)).select(*SERIES, "close", "log_returns", "cusum_rewards")


@query
def risk_metrics(spark, folder):
    return returns.risk_metrics(returns.add_log_returns(event_bars(spark, folder)))


@query
def risk_by_calendar(spark, folder):
    return returns.risk_metrics(returns.add_log_returns(month_bars(spark, folder)), basis="calendar")


@query
def growth_rates(spark, folder):
    return returns.growth_rate(returns.add_log_returns(event_bars(spark, folder)))


@query
def growth_by_calendar(spark, folder):
    return returns.growth_rate(returns.add_log_returns(month_bars(spark, folder)), basis="calendar")


# --- strategies and trades -------------------------------------------------------


def turn_rule() -> Column:
    """Buy after a clear fall, sell after a clear rise within a bar."""
    change = F.try_divide(F.col("close") - F.col("open"), F.col("open"))
    return F.when(change < -0.02, signals.BUY).when(change > 0.02, signals.SELL).otherwise(signals.NO_ACTION)


TURN = signals.Strategy("turn", turn_rule, [MA(5)])
TURN_TEST = BackTest(TURN, LEVELS)


@query
def signal_levels(spark, folder):
    marked = signals.mark_signals(month_bars(spark, folder), turn_rule)
    return signals.add_levels(marked, LEVELS.levels).select("id", *SERIES, "SIGNAL", "TP", "SL")


@query
def shifted_signals(spark, folder):
    bars = series.laid_out(month_bars(spark, folder))
    marked = signals.mark_signals(MA(5).apply(bars), turn_rule, shift=True)
    return marked.select("id", *SERIES, "SIGNAL", "MA_5")


@query
def last_signals(spark, folder):
    return signals.last_signals(signals.mark_signals(month_bars(spark, folder), turn_rule))


@query
def last_bars(spark, folder):
    return signals.last_rows(month_bars(spark, folder), 5).select("id", *SERIES, "close")


@query
def open_trades(spark, folder):
    """Trades without the forced close at the last bar."""
    bars = _written(month_bars(spark, folder), "bars")
    marked = signals.add_levels(signals.mark_signals(bars, turn_rule), LEVELS.levels)
    return trades.find_trades(marked, close_open_trades=False)


@query
def backtest_trades(spark, folder):
    return TURN_TEST.trades(_written(month_bars(spark, folder), "bars"), scratch_path(spark, "marked"))


@query
def backtest_summaries(spark, folder):
    return TURN_TEST.summaries(_written(month_bars(spark, folder), "bars"), scratch_path(spark, "marked"))


def _reports(bars: DataFrame) -> DataFrame:
    task_id = _uuid(F.concat_ws("/", "code", "candle"))
    store = scratch_path(bars.sparkSession, "marked")
    return TURN_TEST.reports(bars, task_id, "/results", _fixed_time(), store)


@query
def backtest_reports(spark, folder):
    reports = _reports(_written(month_bars(spark, folder), "bars"))
    return reports.select(
        text.json_path(F.col("strategy_parms"), "data_model.code").alias("code"),
        text.json_path(F.col("strategy_parms"), "tpsl_parms.profit_factor").alias("profit_factor"),
        text.json_path(F.col("summary"), "total_return").cast("double").alias("total_return"),
        text.json_path(F.col("file"), "trade_res").alias("trade_res"),
        "key_string", "tester_params", "completed_at", "task_event_id",
    )


@query
def result_records(spark, folder):
    bars = _written(month_bars(spark, folder), "bars")
    signal = signals.last_signals(signals.mark_signals(bars, turn_rule)).select(
        _uuid(F.concat_ws("/", "code", "candle")).alias("task_event_id"), F.col("last_signal").cast("int").alias("last_signal")
    )
    rows = _reports(bars).join(signal, "task_event_id", "left").select(
        F.col("task_event_id").alias("task_id"), F.col("last_signal").isNotNull().alias("status"), "strategy_parms", "tester_params",
        "completed_at", "last_signal",
    )
    return results.result_records(rows)


@query
def trade_csv(spark, folder):
    path = scratch_path(spark, "csv")
    bars = _written(month_bars(spark, folder), "bars")
    found = TURN_TEST.trades(bars, scratch_path(spark, "marked")).withColumn("start_time", times.utc_naive(F.col("start_time")))
    found = found.withColumn("end_time", times.utc_naive(F.col("end_time")))
    files.write_csv(found.select(TRADE_SCHEMA.names), path, is_trade_result=True)
    return spark.read.schema(TRADE_SCHEMA).option("header", "true").csv(path)


@query
def look_back(spark, folder):
    days = numeric.calendar_days_column(F.col("l_quantity").cast("int") - 3)
    return table(spark, folder, "lineitem").groupBy("l_quantity").agg(F.min("l_shipdate").alias("first")).select(
        "l_quantity", days.alias("days"), F.date_sub(F.col("first"), days).alias("load_from")
    )


def _close_windows(spark, folder, size) -> DataFrame:
    closes = month_bars(spark, folder).select("id", *SERIES, "close")
    return similar.price_windows(_written(closes, "closes"), size)


@query
def similar_windows(spark, folder):
    """Nearest windows to the newest window of one series, in full-rank PCA space."""
    size = 24
    reduced = similar.reduce_windows(_close_windows(spark, folder, size), size)
    newest = reduced.orderBy("code", F.desc("end_time"))
    found = similar.similar_windows(reduced, newest, top=100)
    return found.select("sample_code", "candle", "code", "end_time", "similarity")


@query
def similar_reduced(spark, folder):
    """The same with 12 components, as by default."""
    reduced = similar.reduce_windows(_close_windows(spark, folder, 24))
    found = similar.similar_windows(reduced, reduced.orderBy("code", F.desc("end_time")), top=100)
    return found.select("sample_code", "candle", "code", "end_time", "similarity", F.size("values").alias("components"))


# --- merges and stored tables ------------------------------------------------------


def _generations(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Bars of open and of finished line items: two overlapping loads."""
    return tuple(month_bars(spark, folder, F.col("l_linestatus") == status) for status in ("O", "F"))


@query
def compact_bars(spark, folder):
    return upsert.merge_generations(_generations(spark, folder))


@query
def stored_bars(spark, folder):
    """The same merge through a stored bar table, second load repeated."""
    old, new = _generations(spark, folder)
    bars = BarTable(spark, scratch_path(spark, "bars"), buckets=4)
    for load in (old, new, new):
        bars.upsert(load)
    return bars.read()


@query
def stored_datasets(spark, folder):
    """The same merge through datasets named by date range: write, write, merge."""
    store = DatasetStore(spark, scratch_path(spark, "datasets"))
    for load in _generations(spark, folder):
        ranged = clean.add_date_range(load).drop("trade_time_date")
        store.write(ranged.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")}))
    store.merge()
    names = store.datasets().select("code", "candle", "start_date", "end_date", "name")
    bars = store.read().groupBy("code", "candle").agg(
        F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"), F.min("low").alias("low"), F.max("high").alias("high"),
    )
    return names.join(bars, ["code", "candle"])


@query
def merge_pairs(spark, folder):
    chosen = table(spark, folder, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").cast("string").alias("code"), F.lit("mo").alias("candle")
    )
    return upsert.only_pairs(upsert.merge_generations(_generations(spark, folder)), chosen)


@query
def multi_part_pairs(spark, folder):
    year = F.year("trade_time")
    names = month_bars(spark, folder).groupBy("code", "candle", year.alias("y")).agg(
        F.min("trade_time").alias("a"), F.max("trade_time").alias("b")
    ).select(text.dataset_name(F.col("code"), F.col("candle"), F.col("a"), F.col("b")).alias("name"))
    parts = names.select(
        F.concat(F.lit("gs://lake/bars/"), "name", F.lit("/part-00000.snappy.parquet")).alias("path")
    )
    parsed = parts.select(text.parse_dataset(F.col("path")).alias("p"), text.dataset_folder(F.col("path")).alias("dataset"))
    return upsert.multi_part_pairs(parsed.select("p.code", "p.candle", "dataset"))


@query
def dataset_ranges(spark, folder):
    """Names of the datasets after a merge: the date range of each series."""
    named = upsert.named_after_range(month_bars(spark, folder))
    name = text.dataset_name(F.col("code"), F.col("candle"), F.col("start_date"), F.col("end_date"))
    return named.select(name.alias("name")).distinct()


@query
def changed_columns(spark, folder):
    """A stored table after renaming and dropping columns."""
    path = scratch_path(spark, "columns")
    files.write_partitioned(month_bars(spark, folder), path, ["candle"])
    files.rename_columns(spark, path, {"volume": "shares", "absent": "other"}, ["candle"])
    files.drop_columns(spark, path, ["open", "absent"], ["candle"])
    return files.read_parquet_table(spark, path)


def _customer_results(spark, folder) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("k"), "c_custkey").alias("key_string"),
        F.col("c_mktsegment").alias("strategy_parms"),
        F.col("c_acctbal").cast("string").alias("summary"),
        F.lit("2020-01-01").cast("timestamp").alias("created_at"),
        F.lit("2020-01-01").cast("timestamp").alias("updated_at"),
    )


def _order_results(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        (F.col("o_custkey") + 1_000_000).alias("id"),
        F.concat(F.lit("k"), "o_custkey").alias("key_string"),
        F.col("o_orderpriority").alias("strategy_parms"),
        F.col("o_totalprice").cast("string").alias("summary"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.col("o_orderkey").alias("seq"),
    )


@query
def upsert_results(spark, folder):
    return upsert.upsert(
        _customer_results(spark, folder), _order_results(spark, folder), newest_by=("updated_at", "seq")
    )


@query
def stored_results(spark, folder):
    """The same upsert through a stored table."""
    stored = _customer_results(spark, folder)
    results_table = KeyedTable(spark, scratch_path(spark, "results"), "key_string", stored.schema)
    results_table.upsert(stored, upsert.RESULT_REPLACED)
    results_table.upsert(_order_results(spark, folder), upsert.RESULT_REPLACED, ("updated_at", "seq"))
    return results_table.read()


def _order_tasks(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.lit(None).cast("string").alias("error_message"),
    )


def _item_changes(spark, folder) -> DataFrame:
    returned = F.max("l_returnflag") == "R"
    return table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.when(returned, "failed").alias("status"),
        F.max("l_shipdate").cast("timestamp").alias("updated_at"),
        F.when(returned, F.concat(F.lit("returned "), F.count(F.lit(1)).cast("string"))).alias("error_message"),
    )


@query
def partial_update(spark, folder):
    return upsert.update_known(_order_tasks(spark, folder), _item_changes(spark, folder))


@query
def merged_metadata(spark, folder):
    def entries(name, key, value):
        return table(spark, folder, name).select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))

    return upsert.merge_metadata(entries("customer", "c_custkey", "c_mktsegment"), entries("supplier", "s_suppkey", "s_name"))


@query
def merged_json(spark, folder):
    new = F.when(
        F.col("event_type") == "click", F.to_json(F.struct(F.col("user_id").alias("k"), F.col("event_type").alias("t")))
    ).otherwise(F.to_json(F.struct(F.col("event_type").alias("t"))))
    merged = table(spark, folder, "events").select("event_id", text.merge_json(F.col("props"), new).alias("m"))
    return merged.select(
        "event_id",
        text.json_path(F.col("m"), "k").cast("long").alias("k"),
        text.json_path(F.col("m"), "t").alias("t"),
        F.json_object_keys("m").cast("array<string>").getItem(0).alias("first_key"),
    )


@query
def seed_tasks(spark, folder):
    """Seeding over tasks that exist for the first batch size and have run since."""
    suppliers = table(spark, folder, "supplier")
    first = F.lit("2024-01-01").cast("timestamp")
    stored = tasks.seed_tasks(suppliers, 55, first, code="s_suppkey")
    ended = F.length("source_meta_data") % 2 == 0
    stored = stored.withColumns({
        "event_stage": F.when(ended, "done").otherwise("run"), "status": F.when(ended, "completed").otherwise("failed"),
    })
    again = tasks.seed_tasks(suppliers, 20, _fixed_time(), code="s_suppkey")
    return upsert.upsert(stored, again, "id", upsert.SEED_REPLACED).drop("tpsl_params")


@query
def stamped_rows(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("timestamp")).alias("created_at")
    )
    return upsert.stamp_rows(rows, _fixed_time())


@query
def run_log(spark, folder):
    """Run history appended to a stored log and read back."""
    path = scratch_path(spark, "log")
    ts = F.col("ts").cast("timestamp")
    seconds = F.col("value").cast("int")
    rows = table(spark, folder, "events").select(
        _uuid(F.col("event_id")).alias("task_id"), F.col("event_type").alias("action"), F.lit("events").alias("module"),
        F.col("props").alias("args"), ts.alias("start_time"),
        (ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("end_time"),
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"),
        F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("result"),
    ).withColumn("duration", F.col("end_time") - F.col("start_time"))
    files.append_rows(rows, path, RUN_LOG_SCHEMA)
    log = spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    spent = F.col("duration").cast("interval second").cast("decimal(18,6)")
    return log.select("task_id", "action", "args", "start_time", "end_time", "status", spent.alias("seconds"))


# --- grouping, sorting, paging ---------------------------------------------------


@query
def distinct_pairs(spark, folder):
    both = event_bars(spark, folder).select("code", "candle").unionByName(month_bars(spark, folder).select("code", "candle"))
    return clean.distinct_pairs(both)


@query
def overall_dates(spark, folder):
    return month_bars(spark, folder).agg(
        F.to_date(F.min("trade_time")).alias("first"), F.to_date(F.max("trade_time")).alias("last")
    )


@query
def bar_index(spark, folder):
    return series.with_index(month_bars(spark, folder), name="position").select("id", *SERIES, "position")


@query
def batched_codes(spark, folder):
    return numbering.batch_codes(table(spark, folder, "orders"), 10, "o_custkey")


def _result_rows(spark, folder) -> DataFrame:
    model = F.struct(
        F.col("o_custkey").cast("string").alias("code"), F.lit("d1").alias("candle"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_time"),
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.to_json(F.struct(F.col("o_orderpriority").alias("name"), model.alias("data_model"))).alias("strategy_parms"),
        F.when(F.col("o_orderstatus") != "P", F.to_json(F.struct(F.col("o_totalprice").alias("total_return"))))
        .otherwise("{}").alias("summary"),
    )


def _shown(df: DataFrame) -> DataFrame:
    parms, summary = F.col("strategy_parms"), F.col("summary")
    return df.select(
        "id",
        text.json_path(parms, "name").alias("name"),
        text.json_path(parms, "data_model.code").alias("code"),
        text.json_path(parms, "data_model.start_time").alias("start_time"),
        text.json_path(summary, "total_return").cast("double").alias("total_return"),
    )


@query
def results_by_profit(spark, folder):
    page = results.ResultQuery(name="1-URGENT", candle="d1", sort_by="profit", descending=True, page=3)
    return _shown(results.list_results(_result_rows(spark, folder), page))


@query
def results_by_start(spark, folder):
    page = results.ResultQuery(sort_by="start_time", page=2, page_size=50)
    return _shown(results.list_results(_result_rows(spark, folder), page))


@query
def results_filtered(spark, folder):
    return _shown(results.filter_results(_result_rows(spark, folder), results.ResultQuery(name="3-MEDIUM", candle="d1")))


# --- scalar functions --------------------------------------------------------------


@query
def result_keys(spark, folder):
    # Numbers whose text differs from the one Spark gives them
    odd = F.get(F.array(*(F.lit(x) for x in (0.0001, 1e16, 1e-7, 5.0, -0.0))), (F.col("o_orderkey") % 5).cast("int"))
    fields = {
        "name": F.col("o_orderpriority"), "code": F.col("o_custkey").cast("string"), "n": F.col("o_orderkey"), "factor": odd,
        "half": F.col("o_orderkey") / 2,
    }
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        text.deterministic_key(fields).alias("digest"),
        text.file_key(fields, at).alias("file_key"),
    )


@query
def result_files(spark, folder):
    rows = _result_rows(spark, folder)
    key = results.result_digest(F.col("strategy_parms"), {})
    paths = rows.select("id", results.result_paths("/out", F.col("strategy_parms"), key).alias("p"))
    return paths.select("id", "p.*")


@query
def model_info(spark, folder):
    info = results.model_info(F.col("strategy_parms"))
    return _result_rows(spark, folder).select("id", *(c.alias(n) for n, c in info.items()))


@query
def date_functions(spark, folder):
    ts = F.col("ts").cast("timestamp")
    day = F.date_format(ts, "yyyy-MM-dd")
    return table(spark, folder, "events").select(
        "event_id",
        times.day_start(ts).alias("day_start"),
        times.day_end(ts).alias("day_end"),
        F.date_trunc("MINUTE", ts).alias("minute"),
        times.utc_midnight(day).alias("midnight"),
        times.utc_midnight(F.col("event_type"), strict=False).alias("no_midnight"),
        times.rfc3339(ts).alias("rfc3339"),
        times.date_text(ts, "yyyy/MM/dd").alias("slashed"),
        text.short_date(F.when(F.col("event_type") != "error", ts)).alias("short"),
    )


@query
def path_functions(spark, folder):
    uri = F.concat(
        F.when(F.col("event_type") == "click", "gs://").when(F.col("event_type") == "view", "s3://").otherwise(""),
        F.lit("lake/"), F.when(F.col("event_type") != "error", F.concat("event_type", F.lit("/"), "event_id", F.lit("/")))
        .otherwise(""),
    )
    split = text.split_object_path(F.col("uri"))
    return table(spark, folder, "events").select("event_id", uri.alias("uri")).select(
        "event_id", text.strip_scheme(F.col("uri")).alias("bare"),
        split["bucket"].alias("bucket"), split["key"].alias("object_key"),
    )


@query
def code_lists(spark, folder):
    raw = F.when(
        F.col("event_type") == "click", F.concat(F.lit('["'), "event_type", F.lit('", " '), "user_id", F.lit(' ", ""]'))
    ).when(F.col("event_type") == "view", F.concat(F.lit("["), "user_id", F.lit("]"))).otherwise(F.concat("event_type", F.lit(" ")))
    codes = text.parse_codes_column(raw)
    return table(spark, folder, "events").select("event_id", F.array_join(codes, "|").alias("codes"))


@query
def remapped_values(spark, folder):
    mapping = {"O": "pending", "F": "completed"}
    return table(spark, folder, "orders").select("o_orderkey", text.remap(F.col("o_orderstatus"), mapping).alias("status"))


@query
def decoded_bytes(spark, folder):
    bad = F.when(F.col("event_type") == "error", F.unhex(F.lit("FF"))).otherwise(F.lit("").cast("binary"))
    raw = F.concat(F.col("props").cast("binary"), bad)
    return table(spark, folder, "events").select("event_id", text.decode_utf8(raw).alias("decoded"))


# --- streams ---------------------------------------------------------------------


def _table_stream(spark, folder, name) -> DataFrame:
    schema = table(spark, folder, name).schema
    return messages.file_stream(spark, folder, schema, f"{name}.parquet")


def _orders_arriving(spark, folder) -> Iterator[DataFrame]:
    """The stream of a landing folder, after each of three loads of different orders has arrived there."""
    landing = scratch_path(spark, "landing")
    orders = table(spark, folder, "orders")
    for part in range(3):
        orders.where(F.col("o_orderkey") % 3 == part).write.mode("append").parquet(landing)
        yield messages.file_stream(spark, landing, orders.schema)


@query
def stream_messages(spark, folder):
    """Messages parsed from a stream into a table; bad ones keep their problem."""
    kind, task = F.col("event_type"), _uuid(F.col("user_id"))
    payload = (
        F.when(kind == "click", F.concat(F.lit('{"task_id": "'), task, F.lit('"}')))
        .when(kind == "view", F.concat(F.lit('{"task_id": "'), F.upper(F.replace(task, F.lit("-"), F.lit(""))), F.lit('"}')))
        .when(kind == "error", "not json")
        .when(kind == "purchase", '{"task_id": "x"}')
        .otherwise(F.concat(F.lit('{"task_id": "'), task, F.lit('", "more": 1}')))
    )
    stream = _table_stream(spark, folder, "events").select("event_id", payload.cast("binary").alias("value"))
    path = scratch_path(spark, "messages")
    parsed = messages.parse_messages(stream).select("event_id", "task_id", "problem")
    messages.run_available(parsed, lambda df, _: df.write.mode("append").parquet(path), f"{path}-checkpoint")
    return spark.read.parquet(path)


@query
def stream_claims(spark, folder):
    """Orders request their customer's task; pending tasks are claimed once."""
    known = table(spark, folder, "customer").select(
        _uuid(F.col("c_custkey")).alias("id"),
        F.when(F.col("c_acctbal") < 0, "failed").otherwise("pending").alias("status"),
        F.lit("2020-01-01").cast("timestamp").alias("updated_at"),
    )
    stored = KeyedTable(spark, scratch_path(spark, "tasks"), "id", known.schema, buckets=4)
    stored.upsert(known, ["status"])
    claims = scratch_path(spark, "claims")
    for arrived in _orders_arriving(spark, folder):
        requests = arrived.select(_uuid(F.col("o_custkey")).alias("task_id"))
        messages.run_available(requests, messages.ClaimJob(stored, claims), f"{claims}-checkpoint")
    # which batch claimed a task, next to its status
    claimed = spark.read.parquet(claims).select("id", F.col("batch").cast("int").alias("batch"))
    return stored.read().join(claimed, "id", "left").select("id", "status", "batch")


@query
def stream_status(spark, folder):
    """Newest status per task, from a stream of status rows that arrive in three loads, not in order of time."""
    log, path = None, scratch_path(spark, "status")
    for arrived in _orders_arriving(spark, folder):
        rows = arrived.select(
            F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderdate").cast("timestamp").alias("updated_at"), F.col("o_orderkey").alias("seq"),
        )
        log = messages.StatusLog(spark, path, "id", rows.schema, ("updated_at", "seq"))
        log.follow(rows, f"{path}-checkpoint")
    log.compact()
    return log.read()


@query
def stream_first_messages(spark, folder):
    """A customer's first order of each year is a message; repeats count as such for 60 days only."""
    orders = table(spark, folder, "orders").where("o_orderdate IS NOT NULL AND o_custkey IS NOT NULL")
    year = F.year("o_orderdate").alias("year")
    firsts = orders.groupBy("o_custkey", year).agg(F.min("o_orderdate").cast("timestamp").alias("at"))
    rows = firsts.select(F.col("o_custkey").cast("string").alias("task_id"), "at", "year")
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "firsts")
    for years in ("year < 1995", "year BETWEEN 1995 AND 1996", "year > 1996"):
        # a batch has one message of each customer, the latest of its years
        load = rows.where(years).groupBy("task_id").agg(F.max("at").alias("at"))
        load.write.mode("append").parquet(landing)
        stream = messages.first_messages(messages.file_stream(spark, landing, load.schema), "at", "60 days")
        messages.run_available(stream, lambda df, _: df.write.mode("append").parquet(path), f"{path}-checkpoint")
    return spark.read.parquet(path).select("task_id", F.to_date("at").alias("at"))


@query
def current_status(spark, folder):
    """Batch form of the same."""
    rows = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"), F.col("o_orderkey").alias("seq"),
    )
    return upsert.current_status(rows, order=("updated_at", "seq"))


@query
def stream_bars(spark, folder):
    """Two loads, the second repeated, arrive in a landing folder one after the other. The stream
    goes on from its checkpoint each time and merges what is new into a bar table."""
    landing = scratch_path(spark, "landing")
    bars = BarTable(spark, scratch_path(spark, "streamed"), buckets=4)
    old, new = _generations(spark, folder)
    for load in (old, new, new):
        load.write.mode("append").parquet(landing)
        stream = messages.file_stream(spark, landing, load.schema)
        messages.run_available(stream, bar_stream.UpsertJob(bars), f"{landing}-checkpoint")
    return bars.read()


@query
def stream_features(spark, folder):
    """Each event as a bar of its own, with features, through a stream."""
    events = _table_stream(spark, folder, "events")
    price = F.col("value")
    k = F.get_json_object("props", "$.k").cast("double")
    bars = events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("code"), F.lit("tick").alias("candle"),
        F.col("ts").cast("timestamp").alias("trade_time"), price.alias("open"), k.alias("close"),
        F.greatest(price, k).alias("high"), (F.least(price, k) / 2).alias("low"),
    )
    path = scratch_path(spark, "features")
    ready = bar_stream.stream_features(bars)
    messages.run_available(ready, lambda df, _: df.write.mode("append").parquet(path), f"{path}-checkpoint")
    return spark.read.parquet(path).select("id", *SERIES, *FEATURES)
