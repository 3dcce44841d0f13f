"""Similar price windows: windows of closes, reduced by PCA, ranked by cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.times import rfc3339
from barloom.operators.series import BARS, Frame, SeriesSpec, over_rows


def price_windows(df: DataFrame, size: int, spec: SeriesSpec = BARS) -> DataFrame:
    """(keys, end_time, prices) for each run of `size` bars of a series."""

    def compute(rows: DataFrame, frame: Frame) -> DataFrame:
        return rows.withColumn("prices", F.collect_list("close").over(frame.last_rows(size)))

    windows = over_rows(df.select(*spec.keys, *spec.order(df), "close"), size, compute, spec)
    return windows.where(F.size("prices") == size).select(
        *spec.keys, F.col(spec.time).alias("end_time"), "prices"
    )


def growth_shape(prices: Column) -> Column:
    """Prices relative to the mean of the window, less 1, so that level does not matter."""
    mean = F.aggregate(prices, F.lit(0.0), lambda total, p: total + p) / F.size(prices)
    # the mean is computed once per window, not for each price
    return F.element_at(F.transform(F.array(mean), lambda m: F.transform(prices, lambda p: p / m - 1)), 1)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, p: total + p)


def principal_components(shapes: DataFrame, components: int) -> np.ndarray:
    """The first principal components of a column of arrays of one length, a row each; of either sign the
    one whose largest entry is positive.

    One pass: each task adds up its products of all pairs of entries, and the tasks' sums are added by entry. What reaches
    the driver is one number per pair of places in a window.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            column = batch.column(0).drop_null()
            if len(column):
                rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
                extended = np.column_stack((np.ones(len(rows)), rows))
                found = extended.T @ extended
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["products"])

    parts = shapes.mapInArrow(sums, "products array<double>")
    summed = parts.select(F.posexplode("products").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).toPandas()
    size = round(len(summed) ** 0.5)
    if size < 2:
        return np.empty((0, 0))
    products = summed.sort_values("at")["x"].to_numpy().reshape(size, size)
    # the first row and column are sums, of ones at the corner
    count, means = products[0, 0], products[0, 1:] / products[0, 0]
    spread = (products[1:, 1:] - count * np.outer(means, means)) / max(1.0, count - 1)
    _, vectors = np.linalg.eigh(spread)
    chosen = vectors[:, ::-1][:, :components].T
    largest = chosen[np.arange(len(chosen)), np.abs(chosen).argmax(axis=1)]
    return chosen * np.where(largest < 0, -1.0, 1.0)[:, None]


def reduce_windows(windows: DataFrame, components: int = 12) -> DataFrame:
    """Add `values`: the window's shape in its first principal components.

    The products are added up entry by entry for a batch of windows at a time, so a window has the same values in any batch.
    """
    shape = growth_shape(F.col("prices"))
    found = principal_components(windows.select(shape.alias("shape")), components)
    if not len(found):
        return windows.withColumn("values", F.array().cast("array<double>"))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *given, column = batch.columns
            known = column.is_valid().to_numpy(zero_copy_only=False)
            entries = np.zeros((found.shape[1], len(batch)))
            if known.any():
                entries[:, known] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, found.shape[1]).T
            values = np.zeros((len(batch), len(found)))
            for place, axis in enumerate(found):
                for entry, weight in zip(entries, axis):
                    values[:, place] += entry * weight
            flat = pa.array(values.ravel(), mask=np.repeat(~known, len(found)))
            starts = np.arange(0, values.size + 1, len(found), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([*given, pa.ListArray.from_arrays(starts, flat)], names=[*batch.schema.names[:-1], "values"])

    given = windows.drop("values")
    schema = T.StructType([*given.schema.fields, T.StructField("values", T.ArrayType(T.DoubleType()))])
    return given.withColumn("_shape", shape).mapInArrow(projected, schema)


def similar_windows(reduced: DataFrame, sample: DataFrame, top: int = 20) -> DataFrame:
    """The `top` windows most similar to the first window in `sample`, the sample left out.

    `sample` has rows (code, candle, end_time, prices, values); one of them becomes constants, so
    the other windows are only scanned, not joined.
    """
    one = sample.select("code", "candle", "end_time", "values", F.size("prices").alias("size")).first()
    if one is None:
        raise ValueError("no sample window")
    wanted = F.array(*(F.lit(value) for value in one["values"]))
    length = F.sqrt(_dot(F.col("values"), F.col("values"))) * F.sqrt(_dot(wanted, wanted))
    # null keys form a series too
    is_sample = F.col("code").eqNullSafe(F.lit(one["code"])) & F.col("end_time").eqNullSafe(F.lit(one["end_time"]))
    others = reduced.where(F.col("candle").eqNullSafe(F.lit(one["candle"])) & ~is_sample)
    ranked = others.withColumn("similarity", F.try_divide(_dot(F.col("values"), wanted), length))
    return (
        ranked.orderBy(F.desc_nulls_last("similarity"), "code", "end_time")
        .limit(top)
        .select(
            F.lit(one["code"]).alias("sample_code"),
            "candle",
            # the sample's own
            F.lit(one["size"]).cast("int").alias("window_size"),
            wanted.alias("sample_values"),
            "code",
            rfc3339(F.col("end_time")).alias("end_time"),
            "similarity",
            "values",
        )
    )
