"""Row-ordered work on bar series that stays parallel when one series is huge.

A window partitioned by (code, candle) puts a whole series into one task. Instead every row gets its
exact position in its series and the series is cut into blocks with equally many rows
that have a value (`observed`); the rows with the last `back` values of a block are copied in front of the next one.
Windows then run per block, so no task holds more than one block and the rows without value within it.

Positions come from counts per slice of time, never from a window over the whole series. How wide a slice is
follows from the rows themselves, by an aggregate within the query: as wide as a block's rows are on
average in the densest of the series that are longer than a block; without such a series there is one slice. Nothing is
measured while a plan is built. A block has as many rows as fit the session's advisory partition size. Where all
rows fit into that by the size the optimizer knows for its own choices, no series can be cut, and the steps that would find nothing to
cut are left out of the plan; the rows are the same.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

POSITION, SEEN, BLOCK, OWNED, SLICE, _SLOT = "_pos", "_seen", "_blk", "_own", "_slice", "_slot"
# rows without time come first
_BEFORE_ALL = -(2**62)
_UNITS = {"": 1, "b": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}


@dataclass(frozen=True)
class SeriesSpec:
    """How bars form series and when a series is cut into blocks."""

    keys: tuple[str, ...] = ("code", "candle")
    time: str = "trade_time"
    # breaks ties between rows of the same time; must make the order total
    tie: tuple[str, ...] = ("id",)
    # rows without this value do not count towards a block or the rows before it
    observed: str = "close"
    # rows of a block; None follows the session's advisory partition size
    block_rows: int | None = None

    def order(self, df: DataFrame) -> tuple[str, ...]:
        return (self.time, *(c for c in self.tie if c in df.columns))


BARS = SeriesSpec()


@dataclass(frozen=True)
class Frame:
    """The window partition a computation runs in: one block of a series."""

    parts: tuple[str, ...]
    by: tuple[str, ...]
    # a column that never falls along the series: sorting by it first changes nothing,
    # but lets windows share the sort of others that need it
    lead: tuple[str, ...] = ()

    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(*self.lead, *self.by)

    def last_rows(self, n: int) -> WindowSpec:
        return self.ordered().rowsBetween(-(n - 1), Window.currentRow)


def longest_series(df: DataFrame, spec: SeriesSpec = BARS) -> int:
    """Row count of the longest series (one map-side combined aggregate)."""
    counts = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def _row_bytes(schema: T.StructType) -> int:
    """A row's size as a plan assumes it: texts 20 bytes, other values 8."""
    return 8 + sum(20 if isinstance(f.dataType, (T.StringType, T.BinaryType)) else 8 for f in schema.fields)


def block_rows(df: DataFrame, spec: SeriesSpec) -> int:
    if spec.block_rows is not None:
        return spec.block_rows
    return max(1, _block_bytes(df) // _row_bytes(df.schema))


def _block_bytes(df: DataFrame) -> int:
    size = df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgt]?)b?", size.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def _fits_a_block(df: DataFrame, spec: SeriesSpec) -> bool:
    """Whether all rows are less than a block by the optimizer's estimate, which needs no job."""
    if spec.block_rows is not None:
        return False
    known = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(known) <= _block_bytes(df)


def _names_of(on: Sequence[str], column_names: Sequence[str]) -> str:
    name = "_key"
    while name in column_names or name in on:
        name += "_"
    return name


def join_back(df: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join an aggregate back to its rows; null keys match, as a null group is a group.

    The keys are compared as one struct, which makes nulls equal. It also gives the aggregate a shuffle of its own for the join
    (its keys' partitioning says nothing about the struct's), so adaptive execution can split a hot key's rows over
    tasks, which it does not where an aggregate is joined straight from its own shuffle.
    """
    key = _names_of(on, [*df.columns, *right.columns])
    keyed = right.select(F.struct(*on).alias(key), *(c for c in right.columns if c not in on))
    return df.withColumn(key, F.struct(*on)).join(keyed, key, how).drop(key)


def _micros(spec: SeriesSpec) -> Column:
    return F.unix_micros(F.col(spec.time).cast("timestamp"))


def _slice_width(df: DataFrame, spec: SeriesSpec, rows: int) -> Column:
    """Microseconds of a slice, one value for all rows; null where no series is longer than a block."""
    at = _micros(spec)
    series = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"), (F.max(at) - F.min(at)).alias("span"))
    # as doubles: microseconds times rows soon pass the range of a long
    wide = F.greatest(F.lit(1.0), F.col("span").cast("double") * rows / F.col("n"))
    return series.agg(F.min(F.when(F.col("n") > rows, wide))).scalar()


def _sliced(df: DataFrame, spec: SeriesSpec, width: Column) -> DataFrame:
    """Add the slice of time of each row: one for all where there is no width."""
    at = _micros(spec)
    number = F.when(width.isNull(), F.lit(0)).when(at.isNull(), F.lit(_BEFORE_ALL)).otherwise(F.floor(at / width))
    return df.withColumn(SLICE, number)


@dataclass(frozen=True)
class Running:
    """A sum along the series: of the rows before, or with the row itself."""

    value: Column
    with_own: bool = False


def _add_running(df: DataFrame, spec: SeriesSpec, sums: dict[str, Running], rows: int) -> DataFrame:
    """Add the sums (0 before the first value). Sums of slices are added up over the slices of a series, those within a slice by a window."""
    width = _slice_width(df, spec, rows)
    sliced = _sliced(df, spec, width)
    part = (*spec.keys, SLICE)
    # a single slice has nothing before it: then no row passes, and nothing is summed
    of_slices = sliced.where(width.isNotNull()).groupBy(*part).agg(*(F.sum(s.value).alias(f"_before{name}") for name, s in sums.items()))
    earlier = Window.partitionBy(*spec.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    key = F.struct(*part).alias(_SLOT)
    offsets = of_slices.select(key, *(F.sum(f"_before{name}").over(earlier).alias(f"_before{name}") for name in sums))
    # the join's shuffle serves the windows too
    joined = sliced.select("*", key).join(offsets, _SLOT, "left")
    inside = Window.partitionBy(_SLOT).orderBy(*spec.order(df))

    def total(name: str, s: Running) -> Column:
        frame = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow if s.with_own else -1)
        return F.coalesce(f"_before{name}", F.lit(0)) + F.coalesce(F.sum(s.value).over(frame), F.lit(0))

    return joined.withColumns({name: total(name, s) for name, s in sums.items()}).drop(SLICE, _SLOT, *(f"_before{name}" for name in sums))


def _whole(df: DataFrame, spec: SeriesSpec) -> Frame:
    return Frame(spec.keys, spec.order(df))


def with_index(df: DataFrame, spec: SeriesSpec = BARS, name: str = POSITION) -> DataFrame:
    """Add the 0-based position of each row in its series. A known position is kept."""
    if name in df.columns:
        return df
    if _fits_a_block(df, spec):
        return df.withColumn(name, F.row_number().over(_whole(df, spec).ordered()).cast("long") - 1)
    return _add_running(df, spec, {name: Running(F.lit(1).cast("long"))}, block_rows(df, spec))


def laid_out(df: DataFrame, spec: SeriesSpec = BARS) -> DataFrame:
    """Add the position of each row and the number of values before it, for several steps over the same rows; not where
    all rows fit a block, and steps need neither."""
    if _fits_a_block(df, spec):
        return df
    observed = F.col(spec.observed).isNotNull().cast("long") if spec.observed in df.columns else F.lit(1).cast("long")
    wanted = {POSITION: Running(F.lit(1).cast("long")), SEEN: Running(observed)}
    missing = {name: s for name, s in wanted.items() if name not in df.columns}
    return _add_running(df, spec, missing, block_rows(df, spec)) if missing else df


def over_rows(
    df: DataFrame,
    back: int,
    compute: Callable[[DataFrame, Frame], DataFrame],
    spec: SeriesSpec = BARS,
) -> DataFrame:
    """Run `compute` so that each row sees at least `back` earlier rows of its series that
    have a value, and all rows since.

    `compute` adds columns with windows taken from the frame it is given.
    """
    if _fits_a_block(df, spec):
        return compute(df, _whole(df, spec))
    block = max(block_rows(df, spec), 4 * back)
    own = F.floor(F.col(SEEN) / block)
    home = F.struct(own.alias("b"), F.lit(True).alias("o"))
    ahead = F.struct((own + 1).alias("b"), F.lit(False).alias("o"))
    in_tail = F.col(SEEN) % block >= block - back
    copies = F.when(in_tail, F.array(home, ahead)).otherwise(F.array(home))
    framed = (
        laid_out(df, spec)
        .withColumn("_copy", F.explode(copies))
        .withColumns({BLOCK: F.col("_copy.b"), OWNED: F.col("_copy.o")})
        .drop("_copy")
        # one shuffle by block serves all windows, also those with finer partitions
        .repartition(*spec.keys, BLOCK)
    )
    result = compute(framed, Frame((*spec.keys, BLOCK), (POSITION,))).where(F.col(OWNED))
    return result.drop(BLOCK, OWNED, *(c for c in (POSITION, SEEN) if c not in df.columns))


def running_sum(df: DataFrame, value: str, out: str, spec: SeriesSpec = BARS) -> DataFrame:
    """Cumulative sum along each series; nulls are skipped and stay null."""
    if _fits_a_block(df, spec):
        so_far = _whole(df, spec).ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.when(F.col(value).isNotNull(), F.sum(value).over(so_far)))
    summed = _add_running(df, spec, {out: Running(F.col(value), with_own=True)}, block_rows(df, spec))
    return summed.withColumn(out, F.when(F.col(value).isNotNull(), F.col(out)))
