from dataclasses import replace
from datetime import datetime

import pandas as pd
import pytest
from barsets import flat, market, spark_bars, walk
from pyspark.sql import functions as F

from barloom.operators import clean, numbering, upsert
from barloom.plans import preprocess
from barloom.schema import RESULT_SCHEMA, TRADE_SCHEMA
from barloom.session import prepare, scratch_path, shared_folder
from barloom.sources import bars as bar_source
from barloom.sources import files
from barloom.sources.tables import BarTable, DatasetStore, KeyedTable

BASE = pd.Timestamp("2024-01-02 09:00")


def factory_rows(code="T2330", candle="1d", n=2, first_id=1, start=BASE):
    prices = [(100.0, 101.0, 102.0, 99.0), (101.0, 103.0, 104.0, 100.5)]
    return pd.DataFrame(
        [
            dict(id=first_id + i, code=code, open=p[0], close=p[1], high=p[2], low=p[3], candle=candle,
                 trade_time=start + pd.Timedelta(days=i), volume=1000 + 100 * i, volume_weight=1000 + 100 * i,
                 updated_at=BASE, created_at=BASE)
            for i, p in enumerate(prices[:n])
        ]
    )


def two_series():
    weekly = factory_rows("T2317", "1w", 1, 3, BASE + pd.Timedelta(days=2)).assign(open=50.0, close=51.0, high=52.0, low=49.0)
    return pd.concat([factory_rows(), weekly], ignore_index=True)


def job(spark, pdf, store):
    bars = spark_bars(spark, pdf, 1)
    return preprocess.PrepareJob(
        load=lambda: bar_source.select_bars(bars),
        store=preprocess.into_datasets(store),
        actions=[preprocess.merge_written_pairs(store)],
    )


def names(store):
    return sorted(r["name"] for r in store.datasets().collect())


def test_one_dataset_per_series(spark):
    store = DatasetStore(spark, scratch_path(spark, "t"))
    job(spark, two_series(), store).run()
    assert names(store) == ["T2317_1w_2024-01-04_2024-01-04.parquet", "T2330_1d_2024-01-02_2024-01-03.parquet"]
    stored = store.read().toPandas()
    assert len(stored) == 3 and set(stored.direction) <= {1, -1}
    assert files.exists(spark, f"{store.path}/_SUCCESS")


def test_late_partition_is_merged(spark):
    store = DatasetStore(spark, scratch_path(spark, "t"))
    late = factory_rows("T2330M", n=1, first_id=99, start=BASE - pd.Timedelta(days=1))
    store.write(preprocess.run_stages(spark_bars(spark, late, 1)))
    job(spark, factory_rows("T2330M"), store).run()
    assert names(store) == ["T2330M_1d_2024-01-01_2024-01-03.parquet"]
    got = store.read().orderBy("trade_time").select("id", F.to_date("trade_time").cast("string").alias("d"))
    want = [(99, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-03")]
    assert [tuple(r) for r in got.collect()] == want
    job(spark, factory_rows("T2330M"), store).run()
    assert store.read().count() == 3 and len(names(store)) == 1


def test_dataset_of_same_name_keeps_rows_missing_from_the_batch(spark):
    store = DatasetStore(spark, scratch_path(spark, "t"))
    full = pd.concat([factory_rows(), factory_rows(n=1, first_id=7, start=BASE + pd.Timedelta(hours=1))])
    store.write(preprocess.run_stages(spark_bars(spark, full, 1)))
    newer = factory_rows().assign(close=102.0, id=[11, 12])
    job(spark, newer, store).run()
    got = {r.id: r.close for r in store.read().collect()}
    assert got == {11: 102.0, 12: 102.0, 7: 101.0}
    assert len(names(store)) == 1


def test_merge_of_listed_and_of_absent_series(spark):
    store = DatasetStore(spark, scratch_path(spark, "t"))
    store.merge()
    for day in (0, 5):
        for code in ("0050", "2330"):
            store.write(preprocess.run_stages(spark_bars(spark, factory_rows(code, first_id=day + 1, start=BASE + pd.Timedelta(days=day)), 1)))
    assert len(names(store)) == 4
    store.merge(spark.createDataFrame([("0050", "1d"), ("none", "1d")], "code string, candle string"))
    assert names(store)[0] == "0050_1d_2024-01-02_2024-01-08.parquet" and len(names(store)) == 3
    store.merge()
    assert len(names(store)) == 2 and store.read().count() == 8
    assert set(store.read().toPandas().code) == {"0050", "2330"}


def test_many_folders_are_removed_some_at_a_time(spark):
    root = scratch_path(spark, "many")
    spark.range(70).selectExpr("id", "id AS part").write.partitionBy("part").parquet(root)
    files.remove_all(spark, (f"{root}/part={i}" for i in range(69)), at_once=1)
    assert [row.id for row in spark.read.parquet(root).collect()] == [69]


def test_folders_of_datasets_grow_with_writes_not_with_series(spark):
    store = DatasetStore(spark, scratch_path(spark, "t"), buckets=2)
    rows = pd.concat([factory_rows(f"C{i:03d}", n=1, first_id=i) for i in range(90)])
    for days in (0, 5):
        moved = rows.assign(trade_time=rows.trade_time + pd.Timedelta(days=days), close=100.0 + days)
        store.write(preprocess.run_stages(spark_bars(spark, moved, 1)))
        assert files.list_parts(spark, store.path).select("folder").distinct().count() == 2 * (1 + days // 5)
    assert len(names(store)) == 180
    store.merge(spark.createDataFrame([("C007", "1d")], "code string, candle string"))
    # the other datasets of its bucket moved with it and are as they were
    assert len(names(store)) == 179 and "C007_1d_2024-01-02_2024-01-07.parquet" in names(store)
    assert store.read().count() == 180
    store.merge()
    assert files.list_parts(spark, store.path).select("folder").distinct().count() == 2
    assert len(names(store)) == 90 and store.read().groupBy("close").count().count() == 2


def test_a_merge_interrupted_before_the_removal_can_be_repeated(spark, monkeypatch):
    store = DatasetStore(spark, scratch_path(spark, "t"), buckets=1)
    for day, codes in ((0, ("A", "B")), (0, ("A",)), (5, ("A",))):
        rows = [factory_rows(code, first_id=day + 1, start=BASE + pd.Timedelta(days=day)).assign(close=102.0) for code in codes]
        store.write(preprocess.run_stages(spark_bars(spark, pd.concat(rows), 1)))
    want = sorted(tuple(r) for r in store.read().collect())
    with monkeypatch.context() as cut:
        cut.setattr("barloom.sources.tables.remove_all", lambda spark, paths: None)
        store.merge()
    assert sorted(tuple(r) for r in store.read().collect()) == want
    store.merge()
    assert sorted(tuple(r) for r in store.read().collect()) == want and len(names(store)) == 2
    assert files.read_parquet_table(spark, store.path).count() == len(want)


def test_store_needs_the_naming_columns(spark):
    with pytest.raises(ValueError, match="start_date"):
        DatasetStore(spark, scratch_path(spark, "t")).write(spark_bars(spark, factory_rows(), 1))


@pytest.mark.parametrize("period", ["YEAR", "MONTH"])
def test_bar_table_upsert(spark, period):
    table = BarTable(spark, scratch_path(spark, "bars"), buckets=2, period=period)
    old = pd.concat([walk("0050", 60, 1), walk("2330", 60, 2)])
    table.upsert(spark_bars(spark, old))
    changed = old[old.code == "0050"].iloc[10:20].assign(close=-1.0, id=lambda d: d.id + 1000)
    added = walk("0050", 5, 3).assign(trade_time=lambda d: d.trade_time + pd.Timedelta(days=400))
    batch = pd.concat([changed, added])
    for _ in range(2):
        table.upsert(spark_bars(spark, batch))
    got = table.read().toPandas()
    assert len(got) == 125 and (got.close == -1.0).sum() == 10
    assert not got.duplicated(["code", "candle", "trade_time"]).any()
    assert set(got.code) == {"0050", "2330"}


def test_bar_table_rewrites_touched_periods_only(spark):
    table = BarTable(spark, scratch_path(spark, "bars"), buckets=1, period="MONTH")
    table.upsert(spark_bars(spark, walk("A", 90, 1)))
    before = {r.file for r in files.list_parts(spark, table.path).collect()}
    table.upsert(spark_bars(spark, walk("A", 3, 2)))
    after = {r.file for r in files.list_parts(spark, table.path).collect()}
    assert {f for f in before - after} == {f for f in before if "2024-01" in f}


def test_new_columns_survive_an_upsert(spark):
    table = BarTable(spark, scratch_path(spark, "bars"), buckets=1)
    table.upsert(spark_bars(spark, walk("A", 3, 1)))
    table.upsert(spark_bars(spark, walk("A", 1, 2).assign(extra=5)))
    got = table.read().orderBy("trade_time").toPandas()
    assert len(got) == 3 and got.extra.tolist()[0] == 5 and got.extra.isna().sum() == 2


def test_rename_and_drop_columns(spark):
    path = scratch_path(spark, "tree")
    files.write_partitioned(spark_bars(spark, walk("A", 5, 1)), path, ["code"])
    files.write_partitioned(spark_bars(spark, walk("B b/+", 5, 2).drop(columns="volume").assign(shares=7)), path, ["code"])
    untouched = {r.file for r in files.list_parts(spark, path).where("file like '%code=B%'").collect()}
    files.rename_columns(spark, path, {"volume": "shares"}, ["code"])
    files.drop_columns(spark, path, ["absent"], ["code"])
    got = files.read_parquet_table(spark, path)
    assert "volume" not in got.columns and got.where("shares is null").count() == 0
    assert untouched == {r.file for r in files.list_parts(spark, path).where("file like '%code=B%'").collect()}
    files.drop_columns(spark, path, ["shares"], ["code"])
    assert "shares" not in files.table_columns(spark, path)
    assert files.read_parquet_table(spark, path).count() == 10
    assert set(files.read_parquet_table(spark, path).toPandas().code) == {"A", "B b/+"}


def test_rename_in_a_table_without_partitions(spark):
    path = scratch_path(spark, "flat")
    spark_bars(spark, walk("A", 5, 1)).write.parquet(path)
    files.rename_columns(spark, path, {"close": "last"})
    assert "last" in files.table_columns(spark, path) and files.read_parquet_table(spark, path).count() == 5


def test_partition_lists_beyond_the_limit_give_the_same(spark, monkeypatch):
    rows = spark.range(50).select((F.col("id") % 10).cast("string").alias("p"), "id")
    touched = spark.createDataFrame([("3",), ("4",), ("5",)], "p string")
    listed = sorted(r.id for r in files.in_partitions(rows, touched, ["p"]).collect())
    monkeypatch.setattr(files, "LISTED_PARTITIONS", 1)
    assert sorted(r.id for r in files.in_partitions(rows, touched, ["p"]).collect()) == listed
    assert len(listed) == 15


def result(key, at, **more):
    return {"id": None, "key_string": key, "strategy_parms": "{}", "tester_params": "{}", "summary": "{}", "file": "{}",
            "completed_at": at, "created_at": at, "updated_at": at, "task_event_id": "t", **more}


def test_result_upsert_keeps_id_and_created_at(spark):
    first, later = datetime(2024, 1, 1), datetime(2024, 2, 1)
    table = KeyedTable(spark, scratch_path(spark, "results"), "key_string", RESULT_SCHEMA, buckets=3)
    table.upsert(spark.createDataFrame([result("a", first, id=1), result("b", first, id=2)], RESULT_SCHEMA), upsert.RESULT_REPLACED)
    batch = [result("a", later, id=9, summary='{"x":1}'), result("a", first, summary="old"), result("c", later, id=3)]
    table.upsert(spark.createDataFrame(batch, RESULT_SCHEMA), upsert.RESULT_REPLACED)
    got = {r.key_string: r for r in table.read().collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"].id, got["a"].created_at, got["a"].updated_at, got["a"].summary) == (1, first, later, '{"x":1}')
    assert got["b"].updated_at == first and got["c"].id == 3


def test_partial_update(spark):
    tasks = spark.createDataFrame([("1", "pending", None), ("2", "pending", "e")], "id string, status string, error_message string")
    changes = spark.createDataFrame([("1", "failed", None), ("9", "failed", None)], "id string, status string, error_message string")
    got = {r.id: (r.status, r.error_message) for r in upsert.update_known(tasks, changes).collect()}
    assert got == {"1": ("failed", None), "2": ("pending", "e")}
    assert upsert.update_known(tasks, changes.select("id")) is tasks


def test_several_updates_of_one_row_act_in_order(spark):
    stamp = "updated_at timestamp"
    tasks = spark.createDataFrame([("1", "pending", None, None)], f"id string, status string, error_message string, {stamp}")
    steps = [("1", "failed", None, datetime(2024, 1, 3)), ("1", "running", "late", datetime(2024, 1, 2)), ("1", None, "x", None)]
    changes = spark.createDataFrame(steps, f"id string, status string, error_message string, {stamp}")
    got = upsert.update_known(tasks, changes).collect()
    assert [tuple(r) for r in got] == [("1", "failed", "late", datetime(2024, 1, 3))]


def test_claims(spark):
    at = datetime(2024, 1, 1)
    rows = [(s, s, at) for s in ("pending", "running", "completed", "failed")]
    tasks = spark.createDataFrame(rows, "id string, status string, updated_at timestamp")
    asked = spark.createDataFrame([("pending",), ("pending",), ("running",), ("failed",), ("unknown",)], "task_id string")
    claimed = upsert.claim_first(tasks, asked).collect()
    assert [(r.id, r.status) for r in claimed] == [("pending", "running")] and claimed[0].updated_at > at
    early = upsert.claim_first(tasks, asked, F.lit("2020-01-01").cast("timestamp")).first()
    assert early.updated_at == at


def test_csv_results(spark):
    path = scratch_path(spark, "csv")
    files.write_csv(spark.createDataFrame([], TRADE_SCHEMA), path, is_trade_result=True)
    texts = [r.value for r in spark.read.text(path).collect()]
    assert texts == [",".join(TRADE_SCHEMA.names)]
    with pytest.raises(ValueError):
        files.write_csv(spark.createDataFrame([], TRADE_SCHEMA), path)


def test_load_filters(spark):
    pdf = pd.concat([walk("0050", 10, 1), walk("2330", 10, 2, candle="h1", step="1h")])
    bars = spark_bars(spark, pdf)
    assert bar_source.select_bars(bars).count() == 20
    assert bar_source.select_bars(bars, "[]").count() == 20
    assert bar_source.select_bars(bars, "0050").count() == 10
    assert bar_source.select_bars(bars, '["0050", "2330"]', candle="h1").count() == 10
    midnight = bars.withColumn("trade_time", F.date_trunc("day", "trade_time"))
    assert bar_source.select_bars(midnight, ["0050"], "2024-01-03", "2024-01-05").count() == 3
    with pytest.raises(ValueError):
        bar_source.select_bars(bars, start_time="5 May")
    with pytest.raises(bar_source.EmptyDataSet):
        bar_source.load_bars(bars, codes="none")


def test_filters_reach_the_scan(spark):
    path = scratch_path(spark, "scan")
    spark_bars(spark, two_series()).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    picked = bar_source.select_bars(spark.read.parquet(path), ["T2330"], "2024-01-01", "2024-02-01", "1d").select("close")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("\n")[0]
    for part in ("EqualTo(candle,1d)", "T2330", "GreaterThanOrEqual(trade_time", "LessThanOrEqual(trade_time"):
        assert part in pushed
    assert "volume" not in plan.split("ReadSchema:")[1]


def test_stage_errors_name_the_stage(spark):
    def broken(df):
        raise ValueError("no")

    with pytest.raises(preprocess.StageError, match="second: no"):
        preprocess.run_stages(spark.range(1), [preprocess.Stage("first", lambda d: d), preprocess.Stage("second", broken)])
    store = DatasetStore(spark, scratch_path(spark, "t"))
    calls = []
    work = preprocess.PrepareJob(
        load=lambda: spark_bars(spark, factory_rows(), 1), store=store.write, actions=[broken, calls.append]
    )
    with pytest.raises(preprocess.StageError, match="action 1"):
        work.run()
    assert not calls


@pytest.mark.parametrize("cuts", [0, 1, 500])
def test_code_batches(spark, cuts):
    codes = [f"{c:04d}" for c in range(777)]
    frame = spark.createDataFrame([(c,) for c in codes * 2 + [None]], "code string").repartition(7)
    got = numbering.batch_codes(frame, 50, cuts=cuts).orderBy("batch").collect()
    want = [codes[i : i + 50] for i in range(0, len(codes), 50)]
    assert [r.code_list for r in got] == ["[" + ", ".join(w) + "]" for w in want]
    assert [r.codes for r in got] == [len(w) for w in want]
    with pytest.raises(ValueError):
        numbering.batch_codes(frame, 0)


def test_number_rows_with_one_slice_and_many(spark):
    frame = spark.createDataFrame([("x%05d" % i,) for i in range(2000)], "v string").repartition(5)
    for cuts in (0, 100, 5000):
        got = numbering.number_rows(frame, "v", cuts=cuts).orderBy("v").collect()
        assert [r.row for r in got] == list(range(2000))


def test_distinct_pairs(spark):
    pdf = pd.concat([market(), flat("X", 2).assign(code=None)])
    got = [tuple(r) for r in clean.distinct_pairs(spark_bars(spark, pdf)).collect()]
    assert got == sorted(got) and len(got) == market().groupby(["code", "candle"]).ngroups
    with pytest.raises(ValueError, match="candle"):
        clean.distinct_pairs(spark.range(1).withColumn("code", F.lit("a")))


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_tables_note_their_columns(spark, monkeypatch):
    bars = spark_bars(spark, walk("A", 30, 1))
    wider = spark_bars(spark, walk("B", 5, 2)).withColumn("venue", F.lit("x"))
    path = scratch_path(spark, "bars")
    table = BarTable(spark, path, buckets=2)
    table.upsert(bars)
    table.upsert(wider)
    table.upsert(bars)
    assert files.stored_schema(spark, path).names == [*bars.columns, "code_bucket", "trade_period", "venue"]
    assert table.read().where("venue = 'x'").count() == 5 and table.read().count() == 35
    # the columns are known without a look at the files
    monkeypatch.setattr(files, "prepare", lambda spark: pytest.fail("footers") if files.stored_schema(spark, path) is None else prepare(spark))
    assert "venue" in BarTable(spark, path, buckets=2).read().columns
    with pytest.raises(ValueError, match="venue of .* is string, not int"):
        table.upsert(bars.withColumn("venue", F.lit(1)))
    files.drop_columns(spark, path, ["venue"], BarTable.PARTITIONS)
    assert "venue" not in table.read().columns and table.read().count() == 35
    store = DatasetStore(spark, scratch_path(spark, "sets"))
    store.write(preprocess.run_stages(spark_bars(spark, factory_rows(), 1)))
    assert "body_perc" in files.stored_schema(spark, store.path).names


def test_tables_without_a_note_are_refused(spark):
    bars = spark_bars(spark, walk("A", 10, 1))
    path = scratch_path(spark, "old")
    bars.write.partitionBy("candle").parquet(path)
    with pytest.raises(ValueError, match="no note"):
        BarTable(spark, path).upsert(bars)
    assert files.read_parquet_table(spark, path).count() == 10


def test_rows_are_written_in_the_order_of_time(spark):
    pdf = pd.concat([walk("B", 90, 1, step="7h"), walk("A", 50, 2, step="13h")])
    for spec in (bar_source.TIME_ORDER, replace(bar_source.TIME_ORDER, block_rows=16)):
        path = scratch_path(spark, "ordered")
        bar_source.write_in_time_order(spark_bars(spark, pdf), path, spec)
        rows = spark.read.parquet(path).withColumn("file", F.input_file_name())
        ordered = rows.orderBy("position").toPandas()
        assert ordered.position.tolist() == list(range(140))
        want = pdf.sort_values(["trade_time", "code", "candle", "id"])
        assert ordered.id.tolist() == want.id.tolist()
        spans = rows.groupBy("file").agg(F.min("position").alias("a"), F.max("position").alias("b"), F.count("*").alias("n")).collect()
        assert all(row.b - row.a + 1 == row.n for row in spans)


def test_tables_refuse_another_layout(spark):
    rows = spark.createDataFrame([(str(i), i) for i in range(20)], "id string, v int")
    path = scratch_path(spark, "keyed")
    KeyedTable(spark, path, "id", rows.schema, buckets=4).upsert(rows, ["v"], newest_by=("v",))
    with pytest.raises(ValueError, match="layout"):
        KeyedTable(spark, path, "id", rows.schema, buckets=16).upsert(rows, ["v"], newest_by=("v",))
    again = KeyedTable(spark, path, "id", rows.schema, buckets=4)
    again.upsert(rows, ["v"], newest_by=("v",))
    assert again.read().count() == 20
    path = scratch_path(spark, "bars")
    bars = spark_bars(spark, walk("A", 30, 1))
    BarTable(spark, path, buckets=4).upsert(bars)
    for other in (BarTable(spark, path), BarTable(spark, path, buckets=4, period="DAY")):
        with pytest.raises(ValueError, match="layout"):
            other.upsert(bars)
    assert BarTable(spark, path, buckets=4).read().count() == 30
