"""Bars from the test tables: hourly bars of events, monthly bars of line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import prepare


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def _ohlc(price: Column, order: Column) -> list[Column]:
    return [
        F.min_by(price, order).alias("open"),
        F.max_by(price, order).alias("close"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
    ]


def event_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars; the code is the event type and the price is the event value."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("long")
    bars = events.groupBy(F.col("event_type").alias("code"), F.date_trunc("HOUR", "ts").alias("trade_time")).agg(
        F.min("event_id").alias("id"),
        *_ohlc(F.col("value"), F.struct("ts", "event_id")),
        F.count(F.lit(1)).alias("volume"),
        F.sum(k).alias("volume_weight"),
        F.max("ts").alias("updated_at"),
        F.min("ts").alias("created_at"),
    )
    return bars.withColumn("candle", F.lit("h1")).select(
        "id", "code", "open", "close", "high", "low", "trade_time", "candle",
        "volume", "volume_weight", "updated_at", "created_at",
    )


def month_bars(spark: SparkSession, folder: str, of: Column | None = None) -> DataFrame:
    """Monthly bars of unit prices; the code is the supplier. `of` chooses line items."""
    items = table(spark, folder, "lineitem")
    if of is not None:
        items = items.where(of)
    # cut to cents by floor, which no engine rounds differently
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100.0) / 100.0
    # some line items share day, order and line: the price makes the order total
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", price.alias("p"))
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    bars = items.groupBy("l_suppkey", month.alias("month")).agg(
        *_ohlc(price, order), F.sum("l_quantity").cast("long").alias("volume")
    )
    number = F.year("month") * 12 + F.month("month")
    return bars.select(
        (F.col("l_suppkey") * 100000 + number).cast("long").alias("id"),
        F.col("l_suppkey").cast("string").alias("code"),
        "open", "close", "high", "low",
        F.col("month").cast("timestamp").alias("trade_time"),
        F.lit("mo").alias("candle"),
        "volume",
    )
