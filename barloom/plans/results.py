"""Back-test results: records, keys, paths, report rows and their listing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.text import deterministic_key, file_key, json_path

SortBy = Literal["name", "code", "profit", "profit_rate", "start_time", "end_time"]

_SORT_COLUMNS = {
    "name": ("strategy_parms", "name", None),
    "code": ("strategy_parms", "data_model.code", None),
    "profit": ("summary", "total_return", "decimal(38,10)"),
    "profit_rate": ("summary", "total_return_rate", "decimal(38,10)"),
    "start_time": ("strategy_parms", "data_model.start_time", None),
    "end_time": ("strategy_parms", "data_model.end_time", None),
}

MODEL_FIELDS = ("code", "candle", "start_time", "end_time")


@dataclass(frozen=True)
class ResultQuery:
    """Filters, order and page of a result listing; empty filters match all."""

    name: str = ""
    code: str = ""
    candle: str = ""
    sort_by: SortBy = "name"
    descending: bool = False
    page: int = 1
    page_size: int = 20


def filter_results(df: DataFrame, query: ResultQuery) -> DataFrame:
    wanted = {"name": query.name, "data_model.code": query.code, "data_model.candle": query.candle}
    for path, value in wanted.items():
        if value:
            df = df.where(json_path(F.col("strategy_parms"), path) == value)
    return df


def sort_key(by: SortBy) -> Column:
    column, path, kind = _SORT_COLUMNS[by]
    text = json_path(F.col(column), path)
    return text if kind is None else text.try_cast(kind)


def list_results(df: DataFrame, query: ResultQuery) -> DataFrame:
    """One page of results. Missing sort values come last, or first when descending;
    the id decides between equal ones."""
    key = sort_key(query.sort_by)
    order = key.desc_nulls_first() if query.descending else key.asc_nulls_last()
    ordered = filter_results(df, query).orderBy(order, F.col("id").asc())
    return ordered.offset((query.page - 1) * query.page_size).limit(query.page_size)


def model_info(strategy_parms: Column) -> dict[str, Column]:
    """Code, candle and time range of the data a result was made from, "" where absent."""
    return {
        name: F.coalesce(json_path(strategy_parms, f"data_model.{name}"), F.lit("")) for name in MODEL_FIELDS
    }


def result_key(strategy_parms: Column, tester_params: Mapping[str, Column], at: Column) -> Column:
    """File key of a result: digest of its name, data and tester parameters, then its time."""
    fields = {"name": json_path(strategy_parms, "name"), **model_info(strategy_parms), **tester_params}
    return file_key(fields, at)


def result_digest(strategy_parms: Column, tester_params: Mapping[str, Column]) -> Column:
    fields = {"name": json_path(strategy_parms, "name"), **model_info(strategy_parms), **tester_params}
    return deterministic_key(fields)


def result_paths(base: str, strategy_parms: Column, key: Column) -> Column:
    """Struct of the output paths of a result."""
    name = F.coalesce(json_path(strategy_parms, "name"), F.lit("default_strategy"))
    folder = F.concat_ws("/", F.lit(base), name, model_info(strategy_parms)["code"])

    def path(*parts: str | Column) -> Column:
        return F.concat(folder, *(F.lit(p) if isinstance(p, str) else p for p in parts))

    return F.struct(
        key.alias("file_key"),
        path("/trade_res_", key, ".csv").alias("trade_res"),
        path("/test_df_", key, ".csv").alias("test_df"),
        path("/chart/trade_res_", key, ".svg").alias("trade_chart"),
        F.lit(f"{base}/report_metadata.json").alias("final_report"),
    )


def strategy_json(name: Column, model: Mapping[str, Column], levels: Column) -> Column:
    """JSON of strategy name, data model and exit factors."""
    data_model = F.struct(*(column.alias(field) for field, column in model.items()))
    return F.to_json(
        F.struct(name.alias("name"), data_model.alias("data_model"), levels.alias("tpsl_parms")),
        {"ignoreNullFields": "false"},
    )


def result_records(df: DataFrame, last_signal: str = "last_signal") -> DataFrame:
    """Result rows with their parts taken from the JSON parameters."""
    done = F.coalesce(F.date_format("completed_at", "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    return df.select(
        "task_id",
        "status",
        json_path(F.col("strategy_parms"), "name").alias("strategy_name"),
        "tester_params",
        json_path(F.col("strategy_parms"), "tpsl_parms").alias("tpsl_parms"),
        done.alias("completed_at"),
        F.coalesce(F.col(last_signal), F.lit(0)).alias("last_data_signal"),
    )


def report_rows(df: DataFrame, base: str, tester_params: Mapping[str, Column], at: Column) -> DataFrame:
    """Rows of the results table, from (task_id, strategy_parms, tester_params,
    total_return, total_return_rate, completed_at)."""
    key = result_key(F.col("strategy_parms"), tester_params, at)
    stamped = df.withColumn("_key", key).withColumn("_paths", result_paths(base, F.col("strategy_parms"), F.col("_key")))
    return stamped.select(
        F.concat("_key", F.date_format(at, "yyyy-MM-dd HH:mm:ss 'UTC'")).alias("key_string"),
        "strategy_parms",
        "tester_params",
        F.to_json(F.struct("total_return", "total_return_rate")).alias("summary"),
        F.to_json("_paths").alias("file"),
        "completed_at",
        at.alias("updated_at"),
        F.col("task_id").alias("task_event_id"),
    )
