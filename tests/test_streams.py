import json
import uuid
from datetime import datetime

import numpy as np
import pandas as pd
from barsets import spark_bars, walk
from pyspark.sql import functions as F

from barloom.operators import similar
from barloom.plans.results import ResultQuery, list_results
from barloom.plans.testbars import table
from barloom.session import scratch_path
from barloom.sources.files import complete_folders
from barloom.sources.tables import BarTable, KeyedTable
from barloom.streaming import bars as bar_stream
from barloom.streaming import messages

ID = "662f9522-f39c-42a5-b712-557766550001"


def test_message_forms(spark):
    cases = {
        json.dumps({"task_id": ID}).encode(): (ID, None),
        json.dumps({"task_id": uuid.UUID(ID).hex.upper()}).encode(): (ID, None),
        json.dumps({"task_id": f"urn:uuid:{ID}"}).encode(): (ID, None),
        b"{}": (None, "wrong fields"),
        json.dumps({"task_id": ID, "x": 1}).encode(): (None, "wrong fields"),
        b'{"task_id": "not-a-uuid"}': (None, "bad task_id"),
        b'{"task_id": null}': (None, "bad task_id"),
        b"no json": (None, "not JSON"),
        b"\xff\xfe": (None, "not UTF-8"),
    }
    raw = spark.createDataFrame([(bytearray(k),) for k in cases], "value binary")
    got = {bytes(r.value): (r.task_id, r.problem) for r in messages.parse_messages(raw).collect()}
    assert got == cases


def _claim_setup(spark):
    at = datetime(2024, 1, 1)
    tasks = spark.createDataFrame(
        [(str(i), "pending" if i < 6 else "failed", at) for i in range(8)], "id string, status string, updated_at timestamp"
    )
    stored = KeyedTable(spark, scratch_path(spark, "tasks"), "id", tasks.schema, buckets=2)
    stored.upsert(tasks, ["status"])
    return stored, messages.ClaimJob(stored, scratch_path(spark, "claims"))


def test_claims_over_batches_and_runs(spark):
    stored, job = _claim_setup(spark)
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    for ids in (["0", "1", "1", "7", "zz"], ["1", "2"]):
        spark.createDataFrame([(i,) for i in ids], "task_id string").coalesce(1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    messages.run_available(messages.file_stream(spark, landing, schema), job, checkpoint)
    claims = spark.read.parquet(job.claims_path)
    assert sorted(r.id for r in claims.collect()) == ["0", "1", "2"]
    spark.createDataFrame([("2",), ("3",)], "task_id string").coalesce(1).write.mode("append").parquet(landing)
    messages.run_available(messages.file_stream(spark, landing, schema), job, checkpoint)
    assert sorted(r.id for r in spark.read.parquet(job.claims_path).collect()) == ["0", "1", "2", "3"]
    status = {r.id: r.status for r in stored.read().collect()}
    assert [i for i, s in sorted(status.items()) if s == "running"] == ["0", "1", "2", "3"] and status["7"] == "failed"


def test_repeated_batch_claims_nothing_new(spark):
    stored, job = _claim_setup(spark)
    batch = spark.createDataFrame([("4",)], "task_id string")
    job(batch, 0)
    job(batch, 0)
    assert [r.id for r in spark.read.parquet(job.claims_path).collect()] == ["4"]
    assert stored.read().where("status = 'running'").count() == 1


def test_status_keeps_the_newest_even_if_late(spark):
    schema = "id string, status string, updated_at timestamp"
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "status")
    loads = [
        [("a", "running", datetime(2024, 1, 2)), ("b", "pending", datetime(2024, 1, 1)), ("c", "failed", datetime(2024, 1, 1))],
        [("a", "pending", datetime(2024, 1, 1)), ("b", "completed", datetime(2024, 1, 3))],
        [("d", "pending", datetime(2024, 1, 4))],
    ]
    log = None
    for n, load in enumerate(loads):
        spark.createDataFrame(load, schema).coalesce(1).write.mode("append").parquet(landing)
        rows = messages.file_stream(spark, landing, spark.createDataFrame([], schema).schema)
        log = messages.StatusLog(spark, path, "id", rows.schema)
        log.follow(rows, f"{path}-checkpoint")
        # a batch writes the tasks it has rows of, and no other
        written = spark.read.parquet(f"{path}/batch={n:09d}").collect()
        assert {r.id for r in written} == {row[0] for row in load}
    want = {"a": "running", "b": "completed", "c": "failed", "d": "pending"}
    assert {r.id: r.status for r in log.read().collect()} == want
    # a repeated batch, and compactions
    log(spark.createDataFrame(loads[2], schema), 2)
    log.compact()
    log.compact()
    assert {r.id: r.status for r in log.read().collect()} == want
    log(spark.createDataFrame([("d", "running", datetime(2024, 1, 5))], schema), 3)
    log.compact()
    assert {r.id: r.status for r in log.read().collect()} == {**want, "d": "running"}
    assert sorted(complete_folders(spark, path)) == ["base=000000002", "base=000000003", "batch=000000003"]
    empty = messages.StatusLog(spark, scratch_path(spark, "none"), "id", log.schema)
    assert empty.read().count() == 0
    empty.compact()


def test_bars_stream_with_late_and_repeated_bars(spark):
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    pdf = walk("0050", 30, 1)
    corrected = pdf.iloc[5:8].assign(close=-1.0, id=lambda d: d.id + 100)
    for part in (pdf.iloc[10:], pdf.iloc[:20], corrected):
        spark_bars(spark, part, 1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    bars = BarTable(spark, scratch_path(spark, "bars"), buckets=1)
    stream = bar_stream.stream_features(messages.file_stream(spark, landing, schema, files_per_batch=3))
    messages.run_available(stream, bar_stream.UpsertJob(bars), checkpoint)
    got = bars.read().toPandas()
    assert len(got) == 30 and (got.close == -1.0).sum() == 3 and got.direction.isin([1, -1]).all()


def test_a_batch_of_bars_is_computed_once(spark):
    table = BarTable(spark, scratch_path(spark, "bars"), buckets=2)
    passed = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            passed.add(len(frame))
            yield frame

    bars = spark_bars(spark, walk("A", 30, 1))
    upsert = bar_stream.UpsertJob(table)
    for batch_id in range(2):
        upsert(bars.mapInPandas(count, bars.schema), batch_id)
        assert passed.value == 30 * (batch_id + 1)
    upsert(bars.limit(0), 2)
    assert table.read().count() == 30


def test_first_messages_drop_repeats(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    rows = [("a", datetime(2024, 1, 1, 0, 1)), ("a", datetime(2024, 1, 1, 0, 2)), ("b", datetime(2024, 1, 1, 0, 3))]
    spark.createDataFrame(rows, "task_id string, at timestamp").write.parquet(landing)
    stream = messages.file_stream(spark, landing, spark.read.parquet(landing).schema)
    messages.run_available(messages.first_messages(stream, "at"), lambda df, _: df.write.mode("append").parquet(out), f"{out}-c")
    assert sorted(r.task_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_similar_windows_find_the_same_shape(spark):
    base = walk("A", 40, 1)
    pdf = pd.concat([base, base.assign(code="B", close=base.close * 3), walk("C", 40, 9)])
    windows = similar.price_windows(spark_bars(spark, pdf), 12)
    assert windows.count() == 3 * 29
    reduced = similar.reduce_windows(windows, 4)
    sample = reduced.where("code = 'A'").orderBy(F.desc("end_time"))
    first = similar.similar_windows(reduced, sample, top=3).first()
    assert first.code == "B" and abs(first.similarity - 1) < 1e-9 and len(first["values"]) == 4
    assert first.end_time == f"{base.trade_time.iloc[-1]:%Y-%m-%d}T00:00:00Z"


def test_reduced_values_equal_numpy(spark):
    pdf = pd.concat([walk("A", 200, 1), walk("B", 90, 2), walk("C", 60, 3)])
    windows = similar.price_windows(spark_bars(spark, pdf), 10)
    got = similar.reduce_windows(windows, 4).select("prices", "values").toPandas()
    prices = np.array(got.prices.tolist())
    shapes = prices / prices.mean(axis=1, keepdims=True) - 1
    weights, vectors = np.linalg.eigh(np.cov(shapes.T))
    first = vectors[:, np.argsort(-weights)[:4]]
    first *= np.sign(first[np.abs(first).argmax(axis=0), range(4)])
    np.testing.assert_allclose(np.array(got["values"].tolist()), shapes @ first, atol=1e-9)
    assert similar.reduce_windows(windows.where("code = 'none'"), 4).count() == 0


def test_reduced_values_do_not_depend_on_the_batch(spark):
    base = walk("A", 60, 1)
    pdf = pd.concat([base.assign(code=code) for code in "ABC"])
    windows = similar.price_windows(spark_bars(spark, pdf), 12).unionByName(
        spark.createDataFrame([("N", "d1", None, None)], "code string, candle string, end_time timestamp_ntz, prices array<double>")
        .withColumn("end_time", F.lit(None).cast(dict(similar.price_windows(spark_bars(spark, pdf), 12).dtypes)["end_time"]))
    )
    reduced = similar.reduce_windows(windows, 4)
    # the shape is a column of its own below the products, not computed for each component
    assert "MapInArrow" in reduced._jdf.queryExecution().optimizedPlan().toString()
    found = {}
    for size in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            rows = reduced.select("code", "end_time", "values").collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        found[size] = {(row.code, row.end_time): row["values"] for row in rows}
    assert found["7"] == found["10000"] and found["7"]["N", None] == [None] * 4
    assert all(found["7"]["A", at] == values == found["7"]["C", at] for (code, at), values in found["7"].items() if code == "B")


def test_similar_windows_name_the_sample_and_keep_null_codes(spark):
    base = walk("A", 40, 1)
    pdf = pd.concat([base, base.assign(code=None, close=base.close * 3)])
    reduced = similar.reduce_windows(similar.price_windows(spark_bars(spark, pdf), 12), 4)
    sample = reduced.where("code = 'A'").orderBy(F.desc("end_time"))
    found = similar.similar_windows(reduced, sample, top=100).collect()
    assert len(found) == 2 * 29 - 1 and found[0].code is None and abs(found[0].similarity - 1) < 1e-9
    assert {(row.window_size, tuple(row.sample_values)) for row in found} == {(12, tuple(sample.first()["values"]))}
    keyless = reduced.withColumn("candle", F.lit(None).cast("string"))
    assert similar.similar_windows(keyless, keyless.where("code IS NULL"), top=100).count() == 2 * 29 - 1


def test_pages_put_missing_profits_last_or_first(spark):
    rows = [(1, '{"name":"s"}', '{"total_return": 5}'), (2, '{"name":"s"}', "{}"), (3, '{"name":"s"}', '{"total_return": 10.5}'),
            (4, '{"name":"t"}', '{"total_return": 7}')]
    df = spark.createDataFrame(rows, "id long, strategy_parms string, summary string")

    def page(**k):
        return [r.id for r in list_results(df, ResultQuery(**k)).collect()]

    assert page(sort_by="profit") == [1, 4, 3, 2]
    assert page(sort_by="profit", descending=True) == [2, 3, 4, 1]
    assert page(name="s", sort_by="profit", page=2, page_size=2) == [2]
    assert page() == [1, 2, 3, 4]


def test_prepared_table_reads_needed_columns_only(spark):
    plan = table(spark, "/root/testdata/sf0.001", "lineitem").select("l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
