"""Task messages as streams: parsing, first claim, current status."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.text import decode_utf8
from barloom.operators.upsert import TASK_UPDATABLE, claim_first
from barloom.sources.files import complete_folders, exists, remove_all
from barloom.sources.tables import KeyedTable

# The accepted ways to write a UUID (plain hex, with hyphens, in braces,
# as URN) and the fields of a message.
UUID_FORMS = r"^(?:urn:uuid:)?\{?([0-9a-f]{8})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{12})\}?$"
MESSAGE_FIELDS = ("task_id",)


def uuid_text(value: Column) -> Column:
    """UUID in lower case with hyphens; null when it is none."""
    lower = F.lower(value)
    parts = F.concat_ws("-", *(F.regexp_extract(lower, UUID_FORMS, group) for group in range(1, 6)))
    return F.when(lower.rlike(UUID_FORMS), parts)


def parse_messages(df: DataFrame, payload: str = "value") -> DataFrame:
    """Add task_id and problem to raw messages; exactly one of the two is set.

    Works on batch and streaming tables.
    """
    text = decode_utf8(F.col(payload)) if dict(df.dtypes)[payload] == "binary" else F.col(payload)
    parsed = df.withColumn("_text", text).withColumn("_fields", F.from_json("_text", "map<string,string>"))
    names = F.map_keys("_fields")
    known = F.array(*(F.lit(name) for name in MESSAGE_FIELDS))
    task_id = uuid_text(F.col("_fields")["task_id"])
    problem = (
        F.when(F.col("_text").isNull(), "not UTF-8")
        .when(F.col("_fields").isNull(), "not JSON")
        .when(names != known, "wrong fields")
        .when(task_id.isNull(), "bad task_id")
    )
    return parsed.withColumns({"problem": problem, "task_id": F.when(problem.isNull(), task_id)}).drop(
        "_text", "_fields"
    )


def first_messages(messages: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """Streaming form of "first message counts", with state bounded by the delay.

    Repeats that come later than the delay pass; `ClaimJob` has no such limit.
    """
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(["task_id"])


@dataclass(frozen=True)
class ClaimJob:
    """Turns requested pending tasks to running, each once, over all batches.

    The claims of a batch are written before the tasks change, so a repeated batch
    finds them and only repeats the change. Batches are numbered by the stream's
    checkpoint: a stream with a new checkpoint needs a new claims path.
    """

    tasks: KeyedTable
    claims_path: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{self.claims_path}/batch={batch_id}"
        if not exists(spark, f"{path}/_SUCCESS"):
            # repeated requests are dropped before anything is joined
            requests = batch.where("task_id is not null").select("task_id").distinct()
            stored = self.tasks.touched(requests.withColumnRenamed("task_id", self.tasks.key))
            claim_first(stored, requests).write.mode("overwrite").parquet(path)
        claimed = spark.read.schema(self.tasks.schema).parquet(path)
        self.tasks.update(claimed, TASK_UPDATABLE)


def newest_rows(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Newest row of each key. On a stream the state store holds that row per key, and a batch
    in update mode gives the keys it has rows of, late rows included."""
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return newest.select("_row.*")


@dataclass(frozen=True)
class StatusLog:
    """Current status per task from a stream of status rows.

    The stream's state knows the newest row of each task. What a batch changed is written next to what earlier ones did, so no task
    that it does not name is written again; a repeated batch replaces its own folder. Batches are numbered by the
    stream's checkpoint: a stream with a new checkpoint needs a new path. `compact` puts the newest rows of all
    batches so far into one base; readers see the old or the new base, as its marker is written last.
    """

    spark: SparkSession
    path: str
    key: str
    schema: T.StructType
    order: tuple[str, ...] = ("updated_at",)

    def follow(self, rows: DataFrame, checkpoint: str) -> None:
        """Take what has arrived on the stream."""
        run_available(newest_rows(rows, self.key, self.order), self, checkpoint, mode="update")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id:09d}")

    def _base(self) -> int | None:
        done = [int(name.removeprefix("base=")) for name in complete_folders(self.spark, self.path) if name.startswith("base=")]
        return max(done, default=None)

    def _parts(self) -> tuple[int | None, list[str], int]:
        """The base, the folders that hold it and what came later, and the last batch."""
        base, names = self._base(), complete_folders(self.spark, self.path)
        batches = sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))
        later = [n for n in batches if base is None or n > base]
        folders = [f"{self.path}/batch={n:09d}" for n in later]
        if base is not None:
            folders.append(f"{self.path}/base={base:09d}")
        return base, folders, max(later, default=-1 if base is None else base)

    def read(self) -> DataFrame:
        _, folders, _ = self._parts()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return newest_rows(self.spark.read.schema(self.schema).parquet(*folders), self.key, self.order).select(*self.schema.names)

    def compact(self) -> None:
        """Replace what was read by one base, and remove the folders that were read before the last compaction."""
        base, folders, last = self._parts()
        if len(folders) < 2:
            return
        self.read().write.mode("overwrite").parquet(f"{self.path}/base={last:09d}")
        kept = {f"base={last:09d}"} | {folder.rsplit("/", 1)[1] for folder in folders}
        stale = [name for name in complete_folders(self.spark, self.path) if name not in kept and not _after(name, last)]
        remove_all(self.spark, [f"{self.path}/{name}" for name in stale])


def _after(name: str, number: int) -> bool:
    return int(name.rsplit("=", 1)[1]) > number


def run_available(
    stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Process what is there and stop. A later run goes on from the checkpoint."""
    query = stream.writeStream.outputMode(mode).foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, names: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """The files of a folder as a stream, in order of arrival. A batch has all files that
    have arrived, or as many as stated."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", names)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
