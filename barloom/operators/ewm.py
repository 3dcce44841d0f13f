"""Exponentially weighted means as window sums.

With q = 1 - alpha everything follows from S_t = sum over i <= t of q^(t-i) x_i.
Rows are cut into runs of `run_rows` rows. Within a run S is a scaled running sum,
q^p * sum(x * q^-p), where p is the offset in the run. The end value of the run
before is carried in with q^(p+1); runs further back weigh less than 1e-24 and are
below double precision. So one ordered pass gives the mean, whatever the span.

A null between values keeps its place in the weights: the value before it weighs less at
the next one, and the mean holds in between.

Without adjustment the recursion is y = a y + (1 - a) x, where a = q^k / (q^k + alpha) after k
rows. It is the same kind of sum with the running sum of -log(a) in the place of the row
number; runs are cut where that has grown by `_CLOCK_RUN`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import POSITION, Frame

_SCALE_LIMIT = 100 * math.log(10)
_WEIGHT_LIMIT = 20 * math.log(10)
_CLOCK_RUN = 200.0
# a step that forgets more than this starts anew in double precision
_CLOCK_STEP = 60.0


@dataclass(frozen=True)
class Decay:
    """Weight loss per row: `alpha` is the weight of the newest value."""

    alpha: float

    @classmethod
    def of_span(cls, span: float) -> Decay:
        return cls(2.0 / (span + 1.0))

    @property
    def q(self) -> float:
        return 1.0 - self.alpha

    @property
    def run_rows(self) -> int:
        """Rows per run: a power of 4, so that similar spans share runs. 0 without memory."""
        if self.q <= 0:
            return 0
        rows = 4
        while rows * 4 * -math.log(self.q) <= _SCALE_LIMIT:
            rows *= 4
        return rows

    @property
    def reach(self) -> int:
        """Rows after which a value no longer shows in a double."""
        return 0 if self.q <= 0 else math.ceil(_WEIGHT_LIMIT / -math.log(self.q))


@dataclass(frozen=True)
class Ewm:
    """One mean: null until `min_periods` values were seen.

    `value` builds the input from the frame, so that its windows share the frame's order.
    `adjust` divides by the sum of the weights; without it the first value starts the
    recursion y = q * y + alpha * x. Means that name the same `nulls` have values in the
    same rows, and share windows.
    """

    out: str
    value: Callable[[Frame], Column]
    decay: Decay
    min_periods: int
    adjust: bool = True
    nulls: str = ""


def run_name(rows: int) -> str:
    return f"_run{rows}"


def with_run(df: DataFrame, frame: Frame, rows: int) -> DataFrame:
    """Add the run number of each row, and its position if that is missing."""
    if POSITION not in df.columns:
        df = df.withColumn(POSITION, F.row_number().over(frame.ordered()).cast("long") - 1)
    if run_name(rows) not in df.columns:
        df = df.withColumn(run_name(rows), F.floor(F.col(POSITION) / rows))
    return df


def drop_run_columns(df: DataFrame, given: Sequence[str]) -> DataFrame:
    """Remove the helper columns the means share, but for those in `given`."""
    helpers = [c for c in df.columns if c.startswith("_run") or c == POSITION]
    return df.drop(*(c for c in helpers if c not in given))


def add_ewms(df: DataFrame, frame: Frame, means: Sequence[Ewm]) -> DataFrame:
    """Add the means. Those with runs of one length share their windows."""
    recursive: dict[tuple, list[Ewm]] = {}
    for m in means:
        if not m.adjust and m.decay.run_rows:
            recursive.setdefault((m.decay, m.nulls or m.out), []).append(m)
    for group in recursive.values():
        df = _add_recursive(df, frame, group)
    means = [m for m in means if m.adjust or not m.decay.run_rows]
    for rows in sorted({m.decay.run_rows for m in means}, reverse=True):
        group = [m for m in means if m.decay.run_rows == rows]
        if rows == 0:
            df = df.withColumns({m.out: m.value(frame).cast("double") for m in group})
        else:
            df = _add_group(df, frame, group, rows)
    return df


def _add_group(df: DataFrame, frame: Frame, means: Sequence[Ewm], rows: int) -> DataFrame:
    df = with_run(df, frame, rows)
    run = run_name(rows)
    offset = F.col(POSITION) % rows
    in_run = (
        Window.partitionBy(*frame.parts, run)
        .orderBy(*frame.by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ordered = Window.partitionBy(*frame.parts).orderBy(run, *frame.by)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    run_end = offset == rows - 1

    inputs, sums, carried, results = {}, {}, {}, {}
    for m in means:
        out, q = m.out, F.lit(m.decay.q)
        up, down = F.pow(q, -offset), F.pow(q, offset)
        x, n = F.col(f"_x_{out}"), F.col(f"_n_{out}")
        inputs[f"_x_{out}"] = m.value(frame).cast("double")
        sums[f"_s_{out}"] = down * F.sum(F.coalesce(x, F.lit(0.0)) * up).over(in_run)
        sums[f"_w_{out}"] = down * F.sum(F.when(x.isNotNull(), up).otherwise(0.0)).over(in_run)
        carried[f"_n_{out}"] = F.count(x).over(so_far)

        def scan(part: str, out: str = out, down: Column = down, q: Column = q) -> Column:
            return F.col(f"_{part}_{out}") + down * q * F.coalesce(F.col(f"_c{part}_{out}"), F.lit(0.0))

        for part in ("s", "w"):
            end_value = F.when(run_end, F.col(f"_{part}_{out}"))
            carried[f"_c{part}_{out}"] = F.last(end_value, ignorenulls=True).over(before)
        # the last mean holds through a gap, however long
        mean = F.last(F.when(x.isNotNull(), F.try_divide(scan("s"), scan("w"))), ignorenulls=True).over(so_far)
        results[out] = F.when(n >= m.min_periods, mean)
    helpers = [*inputs, *sums, *carried]
    return df.withColumns(inputs).withColumns(sums).withColumns(carried).withColumns(results).drop(*helpers)


def _add_recursive(df: DataFrame, frame: Frame, means: Sequence[Ewm]) -> DataFrame:
    """Means without adjustment, of one decay and with values in the same rows."""
    alpha, name = means[0].decay.alpha, means[0].out
    given = df.columns
    if POSITION not in given:
        df = df.withColumn(POSITION, F.row_number().over(frame.ordered()).cast("long") - 1)
    so_far = frame.ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = frame.ordered().rowsBetween(Window.unboundedPreceding, -1)
    inputs = {f"_x_{m.out}": m.value(frame).cast("double") for m in means}
    here = F.col(f"_x_{name}").isNotNull()
    at, step, clock, run, n = (f"_{part}_{name}" for part in ("at", "step", "clock", "run", "n"))
    df = df.withColumns(inputs).withColumns(
        {at: F.last(F.when(here, F.col(POSITION)), ignorenulls=True).over(before), n: F.count(f"_x_{name}").over(so_far)}
    )
    # what the earlier mean still weighs against a new value of weight alpha
    kept = F.pow(F.lit(means[0].decay.q), F.col(POSITION) - F.col(at))
    first = F.col(at).isNull()
    forgotten = F.least(F.log(kept + alpha) - (F.col(POSITION) - F.col(at)) * math.log(means[0].decay.q), F.lit(_CLOCK_STEP))
    df = df.withColumn(step, F.when(here & ~first, forgotten).otherwise(0.0))
    df = df.withColumn(clock, F.sum(step).over(so_far)).withColumn(run, F.floor(F.col(clock) / _CLOCK_RUN))
    since = F.col(clock) - F.col(run) * _CLOCK_RUN
    in_run = Window.partitionBy(*frame.parts, run).orderBy(*frame.by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = Window.partitionBy(*frame.parts).orderBy(run, *frame.by)
    share = F.when(first, 1.0).otherwise(alpha / (kept + alpha))
    sums, ends, results = {}, {}, {}
    for m in means:
        x = F.col(f"_x_{m.out}")
        sums[f"_s_{m.out}"] = F.exp(-since) * F.sum(F.when(here, share * x * F.exp(since)).otherwise(0.0)).over(in_run)
    df = df.withColumns(sums)
    new_run = F.col(run) > F.lag(run, 1).over(ordered)
    for m in means:
        end = F.struct(F.lag(clock, 1).over(ordered).alias("c"), F.lag(f"_s_{m.out}", 1).over(ordered).alias("s"))
        ends[f"_e_{m.out}"] = F.when(new_run, end)
    df = df.withColumns(ends)
    carried = {
        f"_c_{m.out}": F.last(f"_e_{m.out}", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        for m in means
    }
    df = df.withColumns(carried)
    for m in means:
        end = F.col(f"_c_{m.out}")
        old = F.coalesce(end["s"] * F.exp(end["c"] - F.col(clock)), F.lit(0.0))
        results[m.out] = F.when((F.col(n) > 0) & (F.col(n) >= m.min_periods), F.col(f"_s_{m.out}") + old)
    helpers = [at, n, step, clock, run, *inputs, *sums, *ends, *carried]
    return df.withColumns(results).drop(*helpers)
