"""Date texts of many forms against pandas."""

from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Observation
from pyspark.sql import functions as F

from barloom.functions.times import to_time
from barloom.operators.clean import column_to_time

READ = [
    "2024-01-05", "2024-01-05 10:11:12", "2024-01-05T10:11:12.123456", "2024-01-05 10:11:12.5", "Jan 5, 2024", "5 January 2024 3:04 PM", "05/06/2024",
    "13/01/2024", "13.01.2024 10:11", "12/31/1999 23:59:59", "2024-01-05T10:11:12Z", "2024-01-05 10:11:12+08:00", "2024-01-05T10:11-0530",
    "Fri, 05 Jan 2024 10:11:12 GMT", "20240105", "20240105T101112", "20240105 101112", "2024/1/5", "Jan 2024", "2024", "5-Jan-24", "Sept 3 2021",
    "1/2/24", "March 3rd, 2020", "2024-01-05 12:00 AM", "2024-01-05 12:30 pm", "2024.01.05", "2024-1", "01-2024", "2 Feb 2024 00:00:01",
    "Tuesday, 29 February 2028", "2024 March 7", "7 MAY 2019", "  2024-02-29  ", "2024-01-05 1:02",
]
UNREADABLE = ["no date", "", "2024-13-01", "31/02/2024", "2023-02-29", "January 5 2024 EST", "24:00", "13/13/2024", "2024-01-05 25:00", "5", "2024-01-05 13:00 PM"]


def test_forms_equal_pandas(spark):
    frame = spark.createDataFrame([(text,) for text in READ], "t string")
    got = {row.t: row.at for row in frame.select("t", to_time(F.col("t")).alias("at").cast("string")).collect()}
    want = {}
    for text in READ:
        at = pd.to_datetime(text.strip())
        at = at.tz_convert("UTC").tz_localize(None) if at.tzinfo else at
        want[text] = str(at)
    assert {text: pd.Timestamp(at) if at else None for text, at in got.items()} == {text: pd.Timestamp(at) for text, at in want.items()}


def test_unreadable_texts_are_marked_and_counted(spark):
    frame = spark.createDataFrame([(text,) for text in [*UNREADABLE, *READ[:5], None]], "trade_time string")
    seen = Observation("dates")
    rows = column_to_time(frame, failed="bad", failures=seen).collect()
    assert [row.bad for row in rows] == [True] * len(UNREADABLE) + [False] * 6
    assert all(row.trade_time is None for row in rows if row.bad) and rows[-1].trade_time is None
    assert seen.get["failed"] == len(UNREADABLE)
    assert column_to_time(frame).columns == ["trade_time"]


def test_other_types(spark):
    at = datetime(2024, 1, 5, 10, 11, 12, tzinfo=UTC)
    frame = spark.createDataFrame([(at, at.date(), 20240105)], "a timestamp, b date, c int")
    row = frame.select(*(to_time(F.col(c)).cast("string").alias(c) for c in "abc")).first()
    assert tuple(row) == ("2024-01-05 10:11:12", "2024-01-05 00:00:00", "2024-01-05 00:00:00")


def test_a_text_is_taken_apart_once(spark):
    # each step is bound to a name: no pattern is repeated for each part of the date
    frame = spark.createDataFrame([("Tue, 2 January 2024 03:04:05 pm +08:00",)], "t string").select(to_time(F.col("t")).alias("at"))
    plan = frame._jdf.queryExecution().analyzed().toString()
    assert plan.count("(mon|tue|wed|thu|fri|sat|sun)") == 1 and plan.count("lower(") == 1
    assert frame.select(F.col("at").cast("string")).first()[0] == "2024-01-02 07:04:05"
