"""Checks on tables. Gates report all failures; a watched one counts while the rows pass it on their way to a sink."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.text import DATE_PATTERN
from barloom.schema import BAR_SCHEMA, FEATURE_SCHEMA


class SchemaError(ValueError):
    """Raised by a gate; lists every failed check."""


def type_failures(df: DataFrame, expected: T.StructType) -> list[tuple[str, str]]:
    """(column, failure) of columns that are missing or of another type. Other columns are allowed."""
    present = {f.name: f.dataType for f in df.schema.fields}
    times = (T.TimestampType, T.TimestampNTZType)
    failures = []
    for field in expected.fields:
        actual = present.get(field.name)
        both_times = isinstance(field.dataType, times) and isinstance(actual, times)
        both_whole = isinstance(field.dataType, T.IntegralType) and isinstance(actual, T.IntegralType)
        if actual is None:
            failures.append((field.name, "missing"))
        elif not (both_times or both_whole or actual == field.dataType):
            failures.append((field.name, f"type {actual.simpleString()}, not {field.dataType.simpleString()}"))
    return failures


class EmptyDataSet(ValueError):
    """The load matched no rows."""


def _required(df: DataFrame, expected: T.StructType) -> list[str]:
    return [f.name for f in expected.fields if not f.nullable and f.name in df.columns]


def _nulls_in(names: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in names]


def null_counts(df: DataFrame, expected: T.StructType) -> DataFrame:
    """(column, nulls) for each column that must not be null; one pass, one row per column."""
    required = _required(df, expected)
    counts = df.agg(*_nulls_in(required))
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in required))
    return counts.select(F.inline(pairs))


_ROWS = "rows passed"


def _judge(failures: list[tuple[str, str]], counted: dict[str, int], not_empty: bool) -> None:
    if not_empty and not counted[_ROWS]:
        raise EmptyDataSet("empty data set")
    failures = failures + [(name, f"{n} nulls") for name, n in counted.items() if n and name != _ROWS]
    if failures:
        raise SchemaError("; ".join(f"{name}: {what}" for name, what in failures))


def require(df: DataFrame, expected: T.StructType, not_empty: bool = False) -> DataFrame:
    """Return the table, or raise with all failures; one pass."""
    counted = df.agg(F.count(F.lit(1)).alias(_ROWS), *_nulls_in(_required(df, expected))).first()
    _judge(type_failures(df, expected), counted.asDict(), not_empty)
    return df


@dataclass
class Watch:
    """A gate that costs no pass of its own: rows are counted as they pass, and judged after the action that made them pass.

    Columns that are missing or of another type are refused at once. Put it on one frame only.
    """

    expected: T.StructType
    not_empty: bool = False
    _seen: Observation = field(default_factory=Observation, init=False)
    _gated: DataFrame | None = field(default=None, init=False)
    _counts: list[Column] = field(default_factory=list, init=False)

    def over(self, df: DataFrame) -> DataFrame:
        failures = type_failures(df, self.expected)
        if failures:
            raise SchemaError("; ".join(f"{name}: {what}" for name, what in failures))
        self._counts = [F.count(F.lit(1)).alias(_ROWS), *_nulls_in(_required(df, self.expected))]
        self._gated = df
        return df.observe(self._seen, *self._counts)

    def check(self) -> None:
        """Raise with all failures. Waits for an action over the frame."""
        try:
            counted = dict(self._seen.get)
        except Py4JJavaError:
            # a plan that is known to have no rows loses its counts; this pass reads nothing either
            counted = self._gated.agg(*self._counts).first().asDict()
        _judge([], counted, self.not_empty)


def require_bars(df: DataFrame) -> DataFrame:
    return require(df, BAR_SCHEMA)


def require_features(df: DataFrame) -> DataFrame:
    return require(df, FEATURE_SCHEMA)


def repeated_keys(df: DataFrame, keys: Sequence[str] = ("code", "candle", "trade_time")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(df: DataFrame, reference: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference has no parent row; null references are allowed."""
    keys = parents.select(F.col(parent_key).alias("_parent")).distinct()
    referring = df.where(F.col(reference).isNotNull())
    return referring.join(keys, F.col(reference) == F.col("_parent"), "left_anti")


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the domain with their row counts."""
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
    return bad.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def request_problems(
    code: str = "code", start: str = "start_time", end: str = "end_time", candle: str = "candle",
    components: str = "pca_components",
) -> Column:
    """Names of the fields of a similarity request that break its rules."""
    checks = {
        code: F.length(code) > 0,
        start: F.col(start).rlike(DATE_PATTERN),
        end: F.col(end).rlike(DATE_PATTERN),
        candle: F.col(candle).rlike("^d1$"),
        components: F.col(components) > 0,
    }
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    return F.array_compact(F.array(*failed))
