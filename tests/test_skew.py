"""One series with a third of all rows, and no broadcast: joins with what was found per series split its rows over tasks."""

import contextlib

import pytest
from pyspark.sql import functions as F

from barloom.operators.clean import add_date_range
from barloom.operators.series import SLICE, SeriesSpec, _slice_width, _sliced, join_back, over_rows, running_sum

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@contextlib.contextmanager
def forced(spark):
    before = {name: spark.conf.get(name, None) for name in FORCED}
    for name, value in FORCED.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def hot_bars(spark, rows=120_000):
    """Every third row is of one series."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, rows, 1, 8).select(
        "id", F.when(hot, "HOT").otherwise(F.concat(F.lit("c"), (F.col("id") % 997).cast("string"))).alias("code"), F.lit("m1").alias("candle"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("trade_time"),
        *(F.rand(i).alias(name) for i, name in enumerate(("open", "high", "low", "close"))),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    # the plan of a fresh run of the same frame, as adaptive execution left it
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


def test_group_values_are_joined_with_a_split(spark):
    with forced(spark):
        assert "skew=true" in final_plan(add_date_range(hot_bars(spark)))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_back_keeps_rows_and_null_keys(spark, how):
    rows = spark.createDataFrame([("a", None, 1), ("a", None, 2), (None, None, 3), ("b", "x", 4)], "k string, _key string, v int")
    found = rows.groupBy("k", "_key").agg(F.sum("v").alias("total"))
    assert sorted(map(tuple, join_back(rows, found, ["k", "_key"], how).collect()), key=repr) == sorted(
        [("a", None, 1, 3), ("a", None, 2, 3), (None, None, 3, 3), ("b", "x", 4, 4)], key=repr
    )


def test_a_hot_series_is_cut_into_bounded_slices_and_blocks(spark):
    bars, spec = hot_bars(spark), SeriesSpec(block_rows=2_000)
    longest = _sliced(bars, spec, _slice_width(bars, spec, 2_000)).groupBy("code", "candle", SLICE).count().agg(F.max("count")).first()[0]
    assert longest <= 2_001
    counted = over_rows(bars, 10, lambda rows, frame: rows.withColumn("n", F.count("close").over(frame.ordered())), spec)
    assert counted.count() == bars.count()
    assert counted.agg(F.max("n")).first()[0] <= 2_010
    summed = running_sum(bars.withColumn("one", F.lit(1.0)), "one", "s", spec).where("code = 'HOT'")
    assert summed.agg(F.max("s"), F.count_distinct("s")).first()[:] == (40_000.0, 40_000)
