"""Gates that count while rows are written."""

import pytest
from barsets import spark_bars
from pyspark.sql import functions as F
from test_tables import factory_rows

from barloom.operators.validate import EmptyDataSet, SchemaError, Watch
from barloom.plans import preprocess
from barloom.schema import BAR_SCHEMA
from barloom.session import scratch_path
from barloom.sources.files import exists


def passed(watch, df):
    watch.over(df).write.format("noop").mode("overwrite").save()
    watch.check()


def test_watch_counts_in_the_action_and_scans_once(spark):
    path = scratch_path(spark, "bars")
    spark_bars(spark, factory_rows()).write.parquet(path)
    watch = Watch(BAR_SCHEMA, not_empty=True)
    watched = watch.over(spark.read.parquet(path)).where("close > 0")
    plan = watched._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and plan.count("CollectMetrics") == 1
    # the filter stays above the gate, which sees all rows
    assert plan.index("Filter") < plan.index("CollectMetrics")
    watched.write.format("noop").mode("overwrite").save()
    watch.check()


def test_watch_reports_all_nulls_and_types(spark):
    bars = spark_bars(spark, factory_rows())
    holes = bars.withColumns({"code": F.lit(None).cast("string"), "open": F.when(F.col("id") > 1, F.col("open"))})
    with pytest.raises(SchemaError, match="code: 2 nulls; open: 1 nulls|open: 1 nulls; code: 2 nulls"):
        passed(Watch(BAR_SCHEMA), holes)
    with pytest.raises(EmptyDataSet, match="empty data set"):
        passed(Watch(BAR_SCHEMA, not_empty=True), bars.where("id < 0"))
    passed(Watch(BAR_SCHEMA), bars.where("id < 0"))
    with pytest.raises(SchemaError, match="candle: missing"):
        Watch(BAR_SCHEMA).over(bars.drop("candle"))


@pytest.mark.parametrize("broken, stage", [
    (lambda df: df.where("id < 0"), "load gate: empty data set"),
    (lambda df: df.withColumn("candle", F.lit(None).cast("string")), "load gate: candle: 2 nulls"),
    (lambda df: df.drop("high"), "load gate: high: missing"),
])
def test_a_refused_load_stores_nothing(spark, broken, stage):
    path, stored = scratch_path(spark, "refused"), []
    bars = spark_bars(spark, factory_rows())
    job = preprocess.PrepareJob(lambda: broken(bars), lambda df: df.write.parquet(path), actions=[stored.append])
    with pytest.raises(preprocess.StageError, match=stage):
        job.run()
    assert not exists(spark, path) and not stored
