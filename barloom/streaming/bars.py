"""Bars arriving as a stream: prepared row by row, merged into a bar table per batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from barloom.operators.candles import add_candle_features
from barloom.operators.clean import clean_rows, drop_row_stamps
from barloom.sources.files import written_once
from barloom.sources.tables import BarTable


def stream_features(bars: DataFrame) -> DataFrame:
    """Cleaned bars with candle features; row-local, so it needs no state."""
    return clean_rows(add_candle_features(drop_row_stamps(bars)))


@dataclass(frozen=True)
class UpsertJob:
    """Merges each batch into the table. Late and repeated bars are no special case:
    the newest row per (code, candle, trade_time) stays.

    A batch is written to the shared folder first, so what leads to it runs once, though the merge looks at its rows,
    at the partitions they belong to and at their columns. An empty batch changes nothing."""

    table: BarTable

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with written_once(batch, "batch") as rows:
            if not rows.isEmpty():
                self.table.upsert(rows)
