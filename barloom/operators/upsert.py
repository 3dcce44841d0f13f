"""Keyed merges of tables: compaction, upsert and partial update, as plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.clean import newest_per_key
from barloom.operators.series import join_back

BAR_KEY = ("code", "candle", "trade_time")

# What an upsert of a result replaces; its id and created_at stay.
RESULT_REPLACED = (
    "strategy_parms",
    "tester_params",
    "summary",
    "file",
    "completed_at",
    "updated_at",
    "task_event_id",
)
# What seeding replaces in a task that exists.
SEED_REPLACED = (
    "status", "updated_at", "event_name", "event_stage", "source_meta_data", "saver_params", "triggered_by",
)
# What a task update may change.
TASK_UPDATABLE = ("event_stage", "status", "updated_at", "error_message")


def merge_generations(
    generations: Sequence[DataFrame], keys: Sequence[str] = BAR_KEY, tie: Sequence[str] = ("id",)
) -> DataFrame:
    """Union of tables from oldest to newest with one row per key: newest table, then highest tie.

    Columns one table lacks are null in its rows.
    """
    union = None
    for age, table in enumerate(generations):
        aged = table.withColumn("_generation", F.lit(age))
        union = aged if union is None else union.unionByName(aged, allowMissingColumns=True)
    newest_by = ["_generation", *(c for c in tie if c in union.columns)]
    return newest_per_key(union, keys, newest_by).drop("_generation")


def only_pairs(df: DataFrame, pairs: DataFrame, keys: Sequence[str] = ("code", "candle")) -> DataFrame:
    """Rows of the listed series. Whether the list is broadcast is left to its size."""
    return df.join(pairs.select(*keys).distinct(), list(keys), "left_semi")


def upsert(
    table: DataFrame,
    batch: DataFrame,
    key: str = "key_string",
    replaced: Sequence[str] = RESULT_REPLACED,
    newest_by: Sequence[str] = ("updated_at",),
) -> DataFrame:
    """The table after the batch: new keys are added, known keys get the replaced columns.

    Other columns of a known key stay. If a key is repeated in the batch, the newest row counts.
    """
    incoming = newest_per_key(batch, [key], list(newest_by))
    renamed = incoming.select(*(F.col(c).alias(f"_n_{c}") for c in incoming.columns))
    joined = table.join(renamed, table[key] == renamed[f"_n_{key}"], "full_outer")
    arrived = F.col(f"_n_{key}").isNotNull()

    def merged(name: str) -> Column:
        if name not in incoming.columns:
            return F.col(name)
        if name in replaced:
            return F.when(arrived, F.col(f"_n_{name}")).otherwise(F.col(name))
        return F.coalesce(F.col(name), F.col(f"_n_{name}"))

    return joined.select(*(merged(c).alias(c) for c in table.columns))


def update_known(
    table: DataFrame,
    changes: DataFrame,
    key: str = "id",
    fields: Sequence[str] = TASK_UPDATABLE,
    newest_by: str = "updated_at",
) -> DataFrame:
    """Set the non-null fields of `changes` in the rows with the same key; nothing is added.

    Several changes of one key act as if applied in the order of `newest_by`: each field
    takes its newest value.
    """
    present = [c for c in fields if c in changes.columns]
    if not present:
        return table
    order = F.col(newest_by) if newest_by in changes.columns else F.lit(0)

    def newest(name: str) -> Column:
        known = F.col(name).isNotNull()
        # changes without a time count as the oldest
        return F.max_by(F.col(name), F.when(known, F.struct(order.isNotNull(), order))).alias(f"_n_{name}")

    reduced = changes.groupBy(F.col(key).alias("_n_key")).agg(*(newest(c) for c in present))
    joined = table.join(reduced, table[key] == reduced["_n_key"], "left")
    return joined.select(
        *(F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if c in present else F.col(c) for c in table.columns)
    )


def lookup(table: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The rows with the given ids. One id is a list of one row."""
    return table.join(ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_semi")


def merge_metadata(old: DataFrame, new: DataFrame, key: str = "key") -> DataFrame:
    """Key/value tables: entries of `new` win."""
    return merge_generations([old, new], [key], tie=())


def claim_first(tasks: DataFrame, requests: DataFrame, at: Column | None = None) -> DataFrame:
    """The tasks that the requests turn from pending to running.

    Repeated requests for one task count once; tasks that are not pending are left out.
    """
    wanted = requests.select(F.col("task_id").alias("id")).dropna().distinct()
    now = F.current_timestamp() if at is None else at
    pending = tasks.where(F.col("status") == "pending").join(wanted, "id", "left_semi")
    return pending.withColumns({"status": F.lit("running"), "updated_at": F.greatest("updated_at", now)})


def current_status(log: DataFrame, key: str = "id", order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """The newest row of each task from its status log."""
    return newest_per_key(log, [key], list(order))


def multi_part_pairs(datasets: DataFrame) -> DataFrame:
    """Series spread over more than one dataset, from rows (code, candle, dataset)."""
    counted = datasets.groupBy("code", "candle").agg(F.countDistinct("dataset").alias("datasets"))
    return counted.where("datasets > 1")


def named_after_range(df: DataFrame, keys: Sequence[str] = ("code", "candle")) -> DataFrame:
    """Recompute the date range that names a dataset after a merge."""
    ranges = df.groupBy(*keys).agg(
        F.min(F.to_date("trade_time")).alias("start_date"), F.max(F.to_date("trade_time")).alias("end_date")
    )
    return join_back(df.drop("start_date", "end_date"), ranges, tuple(keys))


def stamp_rows(df: DataFrame, at: Column) -> DataFrame:
    """Set the row times of a write: created_at once, updated_at always."""
    created = F.coalesce(F.col("created_at"), at) if "created_at" in df.columns else at
    return df.withColumns({"created_at": created, "updated_at": at})
