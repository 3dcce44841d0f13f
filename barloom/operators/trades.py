"""Trades: each entry is closed by the first later sell bar that reaches a level.

Pairing every entry with every later sell bar grows with the square of a series.
Instead sell bars are summarised in a tree: a node covers FAN consecutive nodes below
and knows their highest high and lowest low. An entry looks for the first child after
itself that reaches a level, one tree level at a time upwards, and then follows that
child down to the bar. Each step is an equi-join with arrays of at most FAN entries,
so the work is entries x tree height, and skewed nodes are split by adaptive joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.series import BARS, POSITION, SeriesSpec, join_back, longest_series, with_index
from barloom.operators.signals import BUY, SELL
from barloom.schema import TRADE_SCHEMA

FAN = 128


def tree_height(longest: int, fan: int = FAN) -> int:
    height = 1
    while fan**height < longest:
        height += 1
    return height


def _sell_levels(bars: DataFrame, keys: tuple[str, ...], height: int, fan: int) -> list[DataFrame]:
    """Per tree level a table (keys, node, kids): kids is sorted by position, at most `fan` long."""
    below = bars.where(F.col("SIGNAL") == SELL).select(
        *keys,
        F.col(POSITION).alias("at"),
        F.col("high").alias("hi"),
        F.col("low").alias("lo"),
        F.col("trade_time").alias("time"),
    )
    levels = []
    for _ in range(height):
        kid = F.struct("at", "hi", "lo", *(["time"] if "time" in below.columns else []))
        level = below.groupBy(*keys, F.floor(F.col("at") / fan).alias("node")).agg(
            F.sort_array(F.collect_list(kid)).alias("kids"), F.max("hi").alias("hi"), F.min("lo").alias("lo")
        )
        levels.append(level.select(*keys, "node", "kids"))
        below = level.select(*keys, F.col("node").alias("at"), "hi", "lo")
    return levels


def _first_reaching(kids: Column, after: Column | None) -> Column:
    def reaches(kid: Column) -> Column:
        hit = (kid["hi"] >= F.col("TP")) | (kid["lo"] <= F.col("SL"))
        return hit if after is None else (kid["at"] > after) & hit

    return F.get(F.filter(kids, reaches), F.lit(0))


def _find_exits(entries: DataFrame, levels: list[DataFrame], keys: tuple[str, ...], fan: int) -> DataFrame:
    """Add `exit` (at, hi, lo, time) to the entries, null where no bar closes them."""

    def search(rows: DataFrame, level: DataFrame, node: Column, wanted: Column, after: Column | None) -> DataFrame:
        # rows that need nothing here get a node number nobody has, spread by position
        probed = rows.withColumn("node", F.when(wanted, node).otherwise(-1 - F.col(POSITION)))
        joined = join_back(probed, level, (*keys, "node"), "left")
        return joined.withColumn("kid", _first_reaching(F.col("kids"), after)).drop("kids", "node")

    height = len(levels)
    exit_type = "struct<at: bigint, hi: double, lo: double, time: timestamp_ntz>"
    time_type = dict(entries.dtypes)["trade_time"]
    rows = entries.withColumns(
        {
            "cursor": F.col(POSITION),
            "found": F.lit(None).cast("int"),
            "exit": F.lit(None).cast(exit_type.replace("timestamp_ntz", time_type)),
        }
    )
    for step in range(1, height + 1):
        wanted = F.col("found").isNull()
        parent = F.floor(F.col("cursor") / fan)
        rows = search(rows, levels[step - 1], parent, wanted, F.col("cursor"))
        hit = wanted & F.col("kid").isNotNull()
        update = {
            "cursor": F.when(hit, F.col("kid.at")).when(wanted, parent).otherwise(F.col("cursor")),
            "found": F.when(hit, F.lit(step - 1)).otherwise(F.col("found")),
        }
        if step == 1:
            update["exit"] = F.when(hit, F.col("kid"))
        rows = rows.withColumns(update).drop("kid")
    for step in range(height - 1, 0, -1):
        wanted = F.col("found") == step
        rows = search(rows, levels[step - 1], F.col("cursor"), F.coalesce(wanted, F.lit(False)), None)
        update = {
            "cursor": F.when(wanted, F.col("kid.at")).otherwise(F.col("cursor")),
            "found": F.when(wanted, F.lit(step - 1)).otherwise(F.col("found")),
        }
        if step == 1:
            update["exit"] = F.when(wanted, F.col("kid")).otherwise(F.col("exit"))
        rows = rows.withColumns(update).drop("kid")
    return rows.drop("cursor", "found")


def _zero_to_null(value: Column) -> Column:
    return F.when(value != 0, value)


def find_trades(
    df: DataFrame,
    entry_signal: int = BUY,
    close_open_trades: bool = True,
    spec: SeriesSpec = BARS,
    fan: int = FAN,
    longest: int | None = None,
) -> DataFrame:
    """One row per entry bar, from bars with SIGNAL, TP and SL.

    A trade opens at the open of its entry bar. It closes on a later sell bar: at the
    high if that reaches TP, else at the low if that reaches SL. Entries do not limit
    each other. With `close_open_trades` the others are valued at the last close of
    their series and keep the status "open". Zero values become null. `longest` is the row count of the
    longest series, if known.
    """
    keys = spec.keys
    longest = longest_series(df, spec) if longest is None else longest
    bars = with_index(df, spec)
    levels = _sell_levels(bars, keys, tree_height(longest, fan), fan)
    entries = bars.where(F.col("SIGNAL") == entry_signal).select(*keys, POSITION, "trade_time", "open", "TP", "SL")
    closed = _find_exits(entries, levels, keys, fan)
    hit = F.col("exit").isNotNull()
    price = F.when(hit, F.when(F.col("exit.hi") >= F.col("TP"), F.col("exit.hi")).otherwise(F.col("exit.lo")))
    trades = closed.withColumns(
        {"close_index": F.col("exit.at"), "end_time": F.col("exit.time"), "close_price": price}
    )
    if close_open_trades:
        # the last bar needs no positions: its own is the row count less 1
        last_bar = F.struct(F.col("trade_time").alias("time"), "close")
        ends = df.groupBy(*keys).agg(
            F.max_by(last_bar, F.struct(*spec.order(df))).alias("end"), (F.count(F.lit(1)) - 1).alias("end_at")
        )
        trades = join_back(trades, ends, keys, "left").withColumns(
            {
                "close_index": F.coalesce("close_index", "end_at"),
                "end_time": F.coalesce("end_time", "end.time"),
                "close_price": F.coalesce("close_price", "end.close"),
            }
        )
    gain = F.col("close_price") - F.col("open")
    rate = F.when(F.col("open") == 0, F.lit(0.0)).otherwise(F.try_divide(gain, F.col("open")))
    return trades.select(
        *keys,
        F.col(POSITION).alias("start_index"),
        "close_index",
        F.col("trade_time").alias("start_time"),
        "end_time",
        _zero_to_null(F.col("open")).alias("start_price"),
        _zero_to_null(F.col("TP")).alias("TP"),
        _zero_to_null(F.col("SL")).alias("SL"),
        _zero_to_null(F.col("close_price")).alias("close_price"),
        _zero_to_null(gain).alias("total_return"),
        _zero_to_null(rate).alias("total_return_rate"),
        F.when(hit, F.lit("close")).otherwise(F.lit("open")).alias("status"),
    )


def no_trades(spark) -> DataFrame:
    """The empty trade result, with all its columns."""
    return spark.createDataFrame([], TRADE_SCHEMA)


def trade_summary(trades: DataFrame, spec: SeriesSpec = BARS) -> DataFrame:
    """Per series: number of trades, closed and winning ones, and the summed return."""
    return trades.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("trades"),
        F.count_if(F.col("status") == "close").alias("closed"),
        F.count_if(F.col("total_return") > 0).alias("wins"),
        F.coalesce(F.sum("total_return"), F.lit(0.0)).alias("total_return"),
        F.coalesce(F.avg("total_return_rate"), F.lit(0.0)).alias("total_return_rate"),
    )
