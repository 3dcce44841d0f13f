"""Helpers the operators share: intermediate tables, word rules, columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import scratch_path
from barloom.sources.files import remove

# a word is a run of bytes other than these (space, tab to carriage return)
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# shuffle files of a finished write are of no more use; without this they stay
# until the driver happens to collect its garbage
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


_tracked: list[list[DataFrame]] = []


@contextmanager
def tracked() -> Iterator[list[DataFrame]]:
    """Collects the tables that `stored` writes meanwhile."""
    made: list[DataFrame] = []
    _tracked.append(made)
    try:
        yield made
    finally:
        _tracked.pop()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here, and
    executors lost later cost no recomputation of what came before."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with freed_shuffles(spark):
        df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    for made in _tracked:
        made.append(found)
    return found


def drop_stored(*frames: DataFrame) -> None:
    """Delete intermediate tables, as returned by `stored`, that no later plan reads."""
    for df in frames:
        remove(df.sparkSession, df.stored_at)


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def as_rows(docs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The whole input row as one struct `_row`, so that its columns can have any names,
    next to the given columns."""
    whole = F.struct(*[docs[name] for name in docs.columns]) if docs.columns else F.lit(None)
    return docs.select(whole.alias("_row"), *[column.alias(name) for name, column in columns.items()])


def original(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, also where the body is a lambda over it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def payloads(column: pa.Array) -> list[bytes]:
    """Values of a text or binary Arrow column as bytes, empty where null."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    cast = column.cast(kind) if not pa.types.is_large_binary(column.type) else column
    return [value or b"" for value in cast.to_pylist()]


def in_chunks(values: list[bytes], size: int) -> Iterator[slice]:
    """Slices of consecutive values of about `size` bytes; a longer value is a slice of its own."""
    start, total = 0, 0
    for i, value in enumerate(values):
        if total and total + len(value) > size:
            yield slice(start, i)
            start, total = i, 0
        total += len(value)
    if start < len(values):
        yield slice(start, len(values))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit values (multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
