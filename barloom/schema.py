"""Schemas of the tables the engine works on."""

from __future__ import annotations

from pyspark.sql import types as T

CORE_PRICES = ("open", "high", "low", "close")
SERIES_KEYS = ("code", "candle")

BAR_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("code", T.StringType(), False),
        T.StructField("open", T.DoubleType(), False),
        T.StructField("close", T.DoubleType(), False),
        T.StructField("high", T.DoubleType(), False),
        T.StructField("low", T.DoubleType(), False),
        T.StructField("trade_time", T.TimestampType(), False),
        T.StructField("candle", T.StringType(), False),
        T.StructField("volume", T.LongType(), True),
        T.StructField("volume_weight", T.LongType(), True),
        T.StructField("updated_at", T.TimestampType(), False),
        T.StructField("created_at", T.TimestampType(), False),
    ]
)

# What the feature stages hand to the sink: the bar without its row timestamps,
# plus the candle features. Only `direction` must be present in every row.
FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), True),
        T.StructField("code", T.StringType(), True),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("trade_time", T.TimestampNTZType(), True),
        T.StructField("candle", T.StringType(), True),
        T.StructField("volume", T.LongType(), True),
        T.StructField("volume_weight", T.LongType(), True),
        T.StructField("direction", T.IntegerType(), False),
        T.StructField("body_size", T.DoubleType(), True),
        T.StructField("body_perc", T.DoubleType(), True),
        T.StructField("body_lower", T.DoubleType(), True),
        T.StructField("body_upper", T.DoubleType(), True),
        T.StructField("body_bottom_perc", T.DoubleType(), True),
        T.StructField("body_top_perc", T.DoubleType(), True),
        T.StructField("daily_range", T.DoubleType(), True),
        T.StructField("mid_point", T.DoubleType(), True),
    ]
)

# The columns of a trade result, in file order.
TRADE_SCHEMA = T.StructType(
    [
        T.StructField("start_index", T.LongType()),
        T.StructField("close_index", T.LongType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("start_price", T.DoubleType()),
        T.StructField("TP", T.DoubleType()),
        T.StructField("SL", T.DoubleType()),
        T.StructField("close_price", T.DoubleType()),
        T.StructField("total_return", T.DoubleType()),
        T.StructField("total_return_rate", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("key_string", T.StringType(), False),
        T.StructField("strategy_parms", T.StringType()),
        T.StructField("tester_params", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("task_event_id", T.StringType()),
    ]
)

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("task_id", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("module", T.StringType()),
        T.StructField("args", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("duration", T.DayTimeIntervalType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("result", T.StringType()),
    ]
)

# The domains of the enumerated columns, spelled as stored.
TASK_STATUSES = ("pending", "running", "completed", "failed")
TRIGGER_TYPES = ("manaual", "scheduled")
CANDLES = ("d1",)
