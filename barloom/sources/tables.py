"""Stored tables: bars with idempotent upsert, bar datasets, and keyed records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.text import dataset_name
from barloom.operators.clean import newest_per_key
from barloom.operators.upsert import (
    BAR_KEY,
    merge_generations,
    multi_part_pairs,
    named_after_range,
    only_pairs,
    update_known,
    upsert,
)
from barloom.sources.files import (
    has_files,
    in_partitions,
    keep_layout,
    list_parts,
    overwrite_staged,
    partition_value,
    read_parquet_table,
    remove_all,
    write_partitioned,
    written_once,
)


def hash_bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("string")


@dataclass(frozen=True)
class BarTable:
    """Bars partitioned by candle, code bucket and period, sorted by code and time.

    The period keeps partitions of a huge series apart, and lets a late bar rewrite its
    own period only. Buckets and period are noted with the table; a write with others is
    refused. One writer at a time.
    """

    spark: SparkSession
    path: str
    buckets: int = 16
    period: Literal["YEAR", "MONTH", "DAY"] = "YEAR"
    # columns of the bars; those noted with the table when not given
    schema: T.StructType | None = None

    PARTITIONS = ("candle", "code_bucket", "trade_period")

    def _placed(self, df: DataFrame) -> DataFrame:
        form = {"YEAR": "yyyy", "MONTH": "yyyy-MM", "DAY": "yyyy-MM-dd"}[self.period]
        return df.withColumns(
            {
                "code_bucket": hash_bucket(F.col("code"), self.buckets),
                "trade_period": F.date_format("trade_time", form),
            }
        )

    def is_empty(self) -> bool:
        return not has_files(self.spark, self.path)

    def read(self) -> DataFrame:
        return self._stored().drop("code_bucket", "trade_period")

    def _stored(self) -> DataFrame:
        return read_parquet_table(self.spark, self.path, self.schema)

    def upsert(self, batch: DataFrame) -> None:
        """Add bars; a bar with the key of a stored one replaces it, others stay.

        Running the same batch again changes nothing. If a key is repeated in the
        batch, the highest id counts.
        """
        placed = self._placed(batch)
        keep_layout(self.spark, self.path, {"buckets": str(self.buckets), "period": self.period}, placed.schema)
        if self.is_empty():
            merged = newest_per_key(placed, BAR_KEY, [c for c in ("id",) if c in placed.columns])
            write_partitioned(merged, self.path, self.PARTITIONS, ("code", "trade_time"))
            return
        stored = in_partitions(self._stored(), placed, self.PARTITIONS)
        merged = merge_generations([stored, placed])
        overwrite_staged(self.spark, merged, self.path, self.PARTITIONS, ("code", "trade_time"))


@dataclass(frozen=True)
class DatasetStore:
    """One dataset per (code, candle, start_date, end_date), merged afterwards.

    Every write is a new generation, so a dataset of the same name never hides rows
    that are missing from the new one; `merge` keeps the newest row per bar.

    The datasets of a bucket of series share files, sorted by dataset, and their names are columns: folders
    grow with writes and buckets, not with series. Each write and each merge is a commit that only adds folders.
    """

    spark: SparkSession
    path: str
    buckets: int = 32

    NAMED_BY = ("code", "candle", "start_date", "end_date")
    DATASET = (*NAMED_BY, "generation")
    PARTITIONS = ("commit", "dataset_bucket")

    def write(self, df: DataFrame) -> None:
        missing = [c for c in self.NAMED_BY if c not in df.columns]
        if missing:
            raise ValueError(f"missing columns for grouping: {missing}")
        number = 0 if self.is_empty() else self._last_commit() + 1
        self._append(df.withColumn("generation", self._numbered(number)), number)

    def _numbered(self, number: int) -> Column:
        return F.lit(f"{number:09d}")

    def _bucket(self) -> Column:
        return hash_bucket(F.struct("code", "candle"), self.buckets)

    def _append(self, df: DataFrame, number: int) -> None:
        """Write a commit. Its folders are new, so nothing stored is touched."""
        named = df.withColumns({c: F.col(c).cast("string") for c in self.NAMED_BY})
        placed = named.withColumns({"commit": self._numbered(number), "dataset_bucket": self._bucket()})
        keep_layout(self.spark, self.path, {"named_by": ",".join(self.NAMED_BY), "buckets": str(self.buckets)}, placed.schema)
        write_partitioned(placed, self.path, self.PARTITIONS, (*self.DATASET, "trade_time"), mode="append")

    def is_empty(self) -> bool:
        return not has_files(self.spark, self.path)

    def _folders(self) -> DataFrame:
        parts = list_parts(self.spark, self.path).select("folder").distinct()
        return parts.select("folder", *(partition_value(F.col("folder"), c).alias(c) for c in self.PARTITIONS))

    def _last_commit(self) -> int:
        return int(self._folders().agg(F.max("commit")).first()[0])

    def _stored(self) -> DataFrame:
        return read_parquet_table(self.spark, self.path)

    def datasets(self) -> DataFrame:
        """Stored datasets with their names, from the naming columns only."""
        name = dataset_name(F.col("code"), F.col("candle"), F.col("start_date"), F.col("end_date"))
        stored = self._stored().select(*self.DATASET).distinct().withColumn("name", name)
        return stored.withColumn("dataset", F.concat_ws("/", "name", "generation"))

    def read(self) -> DataFrame:
        """All bars, newest row per bar."""
        return self._resolved(self._stored())

    def _newest(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return newest_per_key(df, keys, ["generation", *(c for c in ("id",) if c in df.columns)])

    def _resolved(self, df: DataFrame) -> DataFrame:
        helpers = (*self.DATASET, *self.PARTITIONS)
        return self._newest(df, BAR_KEY).drop(*(c for c in helpers if c not in BAR_KEY))

    def merge(self, pairs: DataFrame | None = None) -> None:
        """Merge each listed series into one dataset; by default all spread over several.

        The buckets of these series are written anew, their other datasets as they are. That commit is complete before
        the old folders of the buckets are removed, so a reader and a repeated merge get the same bars at any point.
        """
        if self.is_empty():
            return
        many = multi_part_pairs(self.datasets())
        chosen = many if pairs is None else many.join(pairs.select("code", "candle").distinct(), ["code", "candle"])
        with written_once(chosen.select("code", "candle", self._bucket().alias("dataset_bucket")), "chosen") as listed:
            touched = [row[0] for row in listed.select("dataset_bucket").distinct().collect()]
            if not touched:
                return
            # fixed before the new commit adds folders; one row per commit and bucket
            superseded = [row[0] for row in self._folders().where(F.col("dataset_bucket").isin(touched)).select("folder").collect()]
            self._write_merged(listed, touched)
            remove_all(self.spark, superseded)

    def _write_merged(self, listed: DataFrame, touched: Sequence[str]) -> None:
        number = self._last_commit() + 1
        stored = self._stored().where(F.col("dataset_bucket").isin(*touched))
        merged = named_after_range(self._resolved(only_pairs(stored, listed)))
        dated = {c: F.date_format(c, "yyyy-MM-dd") for c in ("start_date", "end_date")}
        merged = merged.withColumns({**dated, "generation": self._numbered(number)})
        # a merge that was interrupted left rows twice
        others = stored.join(listed, ["code", "candle"], "left_anti").drop(*self.PARTITIONS)
        self._append(merged.unionByName(self._newest(others, (*self.DATASET, "trade_time"))), number)


@dataclass(frozen=True)
class KeyedTable:
    """Records with a unique key, stored in hash buckets of the key. The number of buckets is
    noted with the table; a write with another number is refused."""

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType
    buckets: int = 16

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("key_bucket", hash_bucket(F.col(self.key), self.buckets))

    def is_empty(self) -> bool:
        return not has_files(self.spark, self.path)

    def read(self) -> DataFrame:
        if self.is_empty():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def touched(self, changes: DataFrame) -> DataFrame:
        """Stored rows of the buckets that hold the keys of `changes`."""
        if self.is_empty():
            return self.read()
        placed = T.StructType([*self.schema.fields, T.StructField("key_bucket", T.StringType())])
        stored = self.spark.read.schema(placed).parquet(self.path)
        return in_partitions(stored, self._placed(changes), ["key_bucket"]).drop("key_bucket")

    def _replace(self, rows: DataFrame) -> None:
        keep_layout(self.spark, self.path, {"buckets": str(self.buckets), "key": self.key})
        ordered = rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema.fields))
        overwrite_staged(self.spark, self._placed(ordered), self.path, ["key_bucket"])

    def upsert(self, batch: DataFrame, replaced: Sequence[str], newest_by: Sequence[str] = ("updated_at",)) -> None:
        self._replace(upsert(self.touched(batch), batch, self.key, replaced, newest_by))

    def update(self, changes: DataFrame, fields: Sequence[str]) -> None:
        """Set non-null fields of known keys. No fields or no rows: nothing happens."""
        if self.is_empty() or not set(fields) & set(changes.columns) or changes.isEmpty():
            return
        self._replace(update_known(self.touched(changes), changes, self.key, fields))
