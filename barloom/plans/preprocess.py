"""The bar preparation path: load, clean, add features, check, store, follow up."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from barloom.operators.candles import add_candle_features
from barloom.operators.clean import add_date_range, clean_rows, distinct_pairs, drop_row_stamps
from barloom.operators.validate import Watch
from barloom.schema import BAR_SCHEMA, FEATURE_SCHEMA
from barloom.session import scratch_path
from barloom.sources.files import remove
from barloom.sources.tables import BarTable, DatasetStore

Step = Callable[[DataFrame], DataFrame]
Action = Callable[[DataFrame], None]


class StageError(RuntimeError):
    """A stage failed; names the stage and keeps the cause."""

    def __init__(self, stage: str, cause: Exception):
        super().__init__(f"{stage}: {cause}")
        self.stage = stage


@dataclass(frozen=True)
class Stage:
    name: str
    step: Step


def _named(name: str, work: Callable, *args):
    try:
        return work(*args)
    except Exception as cause:
        raise StageError(name, cause) from cause


PREPARE_STAGES = (
    Stage("drop row stamps", drop_row_stamps),
    Stage("candle features", add_candle_features),
    Stage("clean rows", clean_rows),
    Stage("date range", add_date_range),
)


def run_stages(df: DataFrame, stages: Sequence[Stage] = PREPARE_STAGES) -> DataFrame:
    """Chain the stages into one lazy plan for all series."""
    for stage in stages:
        df = _named(stage.name, df.transform, stage.step)
    return df


@dataclass(frozen=True)
class PrepareJob:
    """Load, prepare, store and follow up; stops at the first error.

    The rows are written to the shared folder once, and both gates count them on the way there. Only if those find nothing are
    they stored; storing and the actions read the written rows.
    """

    load: Callable[[], DataFrame]
    store: Action
    stages: Sequence[Stage] = PREPARE_STAGES
    needs: StructType = BAR_SCHEMA
    gives: StructType = FEATURE_SCHEMA
    actions: Sequence[Action] = field(default_factory=tuple)

    def run(self) -> DataFrame:
        load_gate, output_gate = Watch(self.needs, not_empty=True), Watch(self.gives)
        loaded = _named("load gate", load_gate.over, _named("load", self.load))
        ready = _named("output gate", output_gate.over, run_stages(loaded, self.stages))
        spark, path = ready.sparkSession, scratch_path(ready.sparkSession, "prepared")
        try:
            _named("write", ready.write.parquet, path)
            _named("load gate", load_gate.check)
            _named("output gate", output_gate.check)
            written = spark.read.schema(ready.schema).parquet(path)
            _named("store", self.store, written)
            for number, action in enumerate(self.actions, 1):
                _named(f"action {number}", action, written)
        finally:
            remove(spark, path)
        return ready


def merge_written_pairs(store: DatasetStore) -> Action:
    """Follow-up that merges the series of the batch just written."""
    return lambda df: store.merge(distinct_pairs(df, ordered=False))


def into_datasets(store: DatasetStore) -> Action:
    return store.write


def into_table(table: BarTable) -> Action:
    """Store in the partitioned bar table; the date range belongs to datasets only."""
    return lambda df: table.upsert(df.drop("start_date", "end_date"))
