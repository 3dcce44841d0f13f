"""Files: existence and removal, staged overwrite, CSV results, listings and file schemas."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from itertools import batched

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import prepare, scratch_path

# Partition lists up to this size are turned into a filter; longer ones into a join.
LISTED_PARTITIONS = 2_000


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    system, location = _file_system(spark, path)
    return system.exists(location)


def remove(spark: SparkSession, path: str) -> None:
    system, location = _file_system(spark, path)
    system.delete(location, True)


def remove_all(spark: SparkSession, paths: Iterable[str], at_once: int = 16) -> None:
    """Remove many folders; the requests overlap, as each one mostly waits. The names are taken as they come, some at a time."""
    with ThreadPoolExecutor(at_once) as pool:
        for some in batched(paths, 64 * at_once):
            for _ in pool.map(lambda path: remove(spark, path), some):
                pass


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under a path whose write has ended."""
    system, location = _file_system(spark, path)
    if not system.exists(location):
        return []
    names = [status.getPath().getName() for status in system.listStatus(location) if status.isDirectory()]
    return [name for name in names if exists(spark, f"{path}/{name}/_SUCCESS")]


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds any part file; stops at the first one."""
    system, location = _file_system(spark, path)
    if not system.exists(location):
        return False
    found = system.listFiles(location, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def read_parquet_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table with the columns of all its files, those that the table's note names. Only for a table
    without note every footer is read."""
    reader = prepare(spark).read
    schema = schema or stored_schema(spark, path)
    if schema is not None:
        return reader.schema(schema).parquet(path)
    return reader.option("mergeSchema", "true").parquet(path)


LAYOUT_FILE = "_layout"
_SCHEMA = "schema"


def stored_layout(spark: SparkSession, path: str) -> dict[str, str]:
    """What a table says about how its rows are laid out; empty for a table without such a note."""
    return {name: value for name, value in _note(spark, path).items() if name != _SCHEMA}


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns that any write to the table had."""
    noted = _note(spark, path).get(_SCHEMA)
    return T.StructType.fromJson(json.loads(noted)) if noted else None


def _note(spark: SparkSession, path: str) -> dict[str, str]:
    fs, where = _file_system(spark, f"{path.rstrip('/')}/{LAYOUT_FILE}")
    if not fs.exists(where):
        return {}
    stream = fs.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _write_note(spark: SparkSession, path: str, note: dict[str, str]) -> None:
    fs, where = _file_system(spark, f"{path.rstrip('/')}/{LAYOUT_FILE}")
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(json.dumps(note, sort_keys=True).encode()))
    finally:
        stream.close()


def _with_columns_of(known: T.StructType | None, added: T.StructType, path: str) -> T.StructType:
    """The known columns, then new ones; a column of another type is refused."""
    types = {f.name: f.dataType for f in known.fields} if known else {}
    for f in added.fields:
        if types.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"{f.name} of {path} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def keep_layout(spark: SparkSession, path: str, layout: dict[str, str], schema: T.StructType | None = None) -> None:
    """Note the layout with the table, and the columns of a write that is to come. A table that has another layout is refused, and
    so is one that has rows but no note: rows placed by two rules would be stored twice. Readers pass over the file, as its name starts
    with `_`."""
    note = _note(spark, path)
    known = {name: value for name, value in note.items() if name != _SCHEMA}
    if known and known != layout:
        raise ValueError(f"{path} has the layout {known}, not {layout}")
    if not known and has_files(spark, path):
        raise ValueError(f"{path} has rows, but no note of their layout, so it cannot be {layout}")
    wanted = dict(layout)
    if schema is not None or _SCHEMA in note:
        noted = stored_schema(spark, path) if _SCHEMA in note else None
        wanted[_SCHEMA] = (_with_columns_of(noted, schema, path) if schema is not None else noted).json()
    if wanted != note:
        _write_note(spark, path, wanted)


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Overwrite the partitions the rows belong to, or append to them.

    Rows are rebalanced, not hash-partitioned: small partitions share a task and a
    huge one is split over several tasks and files.
    """
    balanced = df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *order)
    (
        balanced.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partitions)
        .parquet(path)
    )


@contextmanager
def written_once(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The rows of a frame, written to the shared folder, for a block that reads them several times. They are removed after it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def overwrite_staged(
    spark: SparkSession, df: DataFrame, path: str, partitions: Sequence[str], order: Sequence[str] = ()
) -> None:
    """Overwrite partitions of the table `df` was read from.

    The rows are first written in full to the shared folder. Only then are the
    partitions replaced, so nothing is read while it is being overwritten, and after a
    failed commit the staged rows are still there.
    """
    stage = scratch_path(spark, "stage")
    df.write.mode("overwrite").parquet(stage)
    write_partitioned(spark.read.schema(df.schema).parquet(stage), path, partitions, order)
    remove(spark, stage)


def in_partitions(df: DataFrame, touched: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of the touched partitions.

    A short list becomes a filter on partition columns, which prunes the scan; a long
    one a semi join. Either way the result is the same.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in partitions]
    label = F.concat_ws("\u0001", *texts)
    labels = touched.select(label.alias("label")).distinct()
    listed = [row["label"] for row in labels.limit(LISTED_PARTITIONS + 1).collect()]
    if len(listed) <= LISTED_PARTITIONS:
        return df.where(label.isin(*listed)) if listed else df.limit(0)
    tagged = df.withColumn("_label", label)
    return tagged.join(labels.withColumnRenamed("label", "_label"), "_label", "left_semi").drop("_label")


def write_csv(df: DataFrame, path: str, is_trade_result: bool = False) -> None:
    """CSV with a header. An empty trade result gives a file with the header only;
    any other empty result is an error."""
    if df.isEmpty():
        if not is_trade_result:
            raise ValueError("nothing to save")
        # one partition, so that the header is written
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", "true").option("encoding", "UTF-8").csv(path)


def append_rows(df: DataFrame, path: str, schema: T.StructType | None = None, rows_per_file: int = 1_000_000) -> None:
    """Append to a log table, columns in the order of its schema."""
    ordered = df if schema is None else df.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))
    ordered.write.mode("append").option("maxRecordsPerFile", str(rows_per_file)).parquet(path)


def append_jdbc(df: DataFrame, url: str, dbtable: str, page_size: int = 1000, **options: str) -> None:
    writer = df.write.format("jdbc").mode("append").options(url=url, dbtable=dbtable, **options)
    writer.option("batchsize", str(page_size)).save()


def list_parts(spark: SparkSession, path: str) -> DataFrame:
    """(file, folder) of the Parquet files under a path. Only names are read."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    folder = F.regexp_replace("path", "/[^/]+$", "")
    return listing.select(F.col("path").alias("file"), folder.alias("folder"))


def _footer_columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        columns = []
        for uri in batch["file"]:
            normal = uri.replace("file:///", "/").replace("file:/", "/") if uri.startswith("file:") else uri
            system, name = fs.FileSystem.from_uri(normal) if "://" in normal else (fs.LocalFileSystem(), normal)
            with system.open_input_file(name) as handle:
                columns.append(pq.read_schema(handle).names)
        yield batch.assign(columns=columns)


def file_columns(spark: SparkSession, path: str) -> DataFrame:
    """(file, folder, columns) from the file footers, read in tasks."""
    parts = list_parts(spark, path)
    return parts.mapInPandas(_footer_columns, "file string, folder string, columns array<string>")


def files_with(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The files that hold at least one of the columns."""
    wanted = F.array(*(F.lit(c) for c in columns))
    return file_columns(spark, path).where(F.arrays_overlap("columns", wanted))


def partition_value(folder: Column, name: str) -> Column:
    """Value of a partition column in a folder path."""
    found = F.regexp_extract(folder, f"/{name}=([^/]+)", 1)
    plain = F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
    return F.when(plain != "__HIVE_DEFAULT_PARTITION__", plain)


def _rewrite(spark: SparkSession, path: str, affected: DataFrame, partitions: Sequence[str], change) -> None:
    table = read_parquet_table(spark, path)
    note = _note(spark, path)
    if _SCHEMA in note:
        _write_note(spark, path, {**note, _SCHEMA: change(table).schema.json()})
    folders = affected.select("folder").distinct()
    if partitions:
        touched = folders.select(*(partition_value(F.col("folder"), c).alias(c) for c in partitions))
        overwrite_staged(spark, change(in_partitions(table, touched, partitions)), path, partitions)
        return
    stage = scratch_path(spark, "stage")
    change(table).write.parquet(stage)
    spark.read.parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    remove(spark, stage)


def drop_columns(spark: SparkSession, path: str, columns: Sequence[str], partitions: Sequence[str] = ()) -> None:
    """Drop columns from a Parquet table. Partitions without them are left alone."""
    affected = files_with(spark, path, columns)
    if not affected.isEmpty():
        _rewrite(spark, path, affected, partitions, lambda df: df.drop(*columns))


def rename_columns(
    spark: SparkSession, path: str, names: dict[str, str], partitions: Sequence[str] = ()
) -> None:
    """Rename columns of a Parquet table. Partitions without them are left alone; where
    files of old and new naming meet, their values end in one column."""
    if not names:
        return

    def change(df: DataFrame) -> DataFrame:
        for old, new in names.items():
            if old not in df.columns:
                continue
            if new in df.columns:
                df = df.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old)
            else:
                df = df.withColumnRenamed(old, new)
        return df

    affected = files_with(spark, path, list(names))
    if not affected.isEmpty():
        _rewrite(spark, path, affected, partitions, change)


def table_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of a table; reads the schema only."""
    return read_parquet_table(spark, path).columns
