"""Every catalogue query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from barloom.plans import catalogue
from barloom.plans.catalogue import CATALOGUE
from check_oracles import TABLES, compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


# Plan nodes that pair all rows, or leave the JVM row by row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas")


@pytest.mark.parametrize("name", list(CATALOGUE))
def test_query_equals_its_sql(spark, sql, name):
    df = contract.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    outcome = compare(sql, name, df)
    assert outcome.startswith(("equal", "rows only")), outcome


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["trade_csv", "result_records", "similar_windows", "ema_gaps"])
def test_bars_that_several_steps_read_are_made_once(spark, monkeypatch, name):
    folder, bars, made = FOLDER, catalogue.month_bars, spark.sparkContext.accumulator(0)

    def counted(spark, folder):
        def count(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        df = bars(spark, folder)
        return df.mapInArrow(count, df.schema)

    monkeypatch.setattr(catalogue, "month_bars", counted)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
    try:
        CATALOGUE[name](spark, folder).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert made.value == bars(spark, folder).count()
