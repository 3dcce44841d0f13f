"""Task rows for batches of codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.text import uuid_from
from barloom.operators.numbering import batch_codes


def seed_tasks(
    df: DataFrame,
    size: int,
    at: Column,
    candle: str = "d1",
    start_time: str = "2025-01-01",
    end_time: str = "2025-12-31",
    saver_params: str = "{}",
    code: str = "code",
) -> DataFrame:
    """One pending preprocessing task per batch of codes. The id follows from the batch
    number, so seeding again updates the same tasks."""
    meta = F.to_json(
        F.struct(
            F.col("code_list").alias("code"),
            F.lit(candle).alias("candle"),
            F.lit(start_time).alias("start_time"),
            F.lit(end_time).alias("end_time"),
        )
    )
    # How a seeded task looks, spelled as stored.
    return batch_codes(df, size, code).select(
        uuid_from(F.concat(F.lit("seed-"), F.col("batch"))).alias("id"),
        F.lit("pending").alias("status"),
        F.lit("local_test").alias("tester_name"),
        F.lit("{}").alias("tester_params"),
        F.lit("sql_loader").alias("data_provider_name"),
        meta.alias("source_meta_data"),
        F.lit("").alias("tpsl_name"),
        F.lit(None).cast("string").alias("tpsl_params"),
        F.lit(saver_params).alias("saver_params"),
        F.lit("manaual").alias("trigger_type"),
        F.lit("test").alias("triggered_by"),
        F.lit("preprocessing").alias("event_name"),
        F.lit("init").alias("event_stage"),
        F.lit(False).alias("used_process_pool"),
        F.lit(False).alias("is_notify"),
        at.alias("created_at"),
        at.alias("updated_at"),
    )
