"""Global row numbers and batches without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# slices rows are numbered in, less one
CUTS = 511


def _cut_points(values: DataFrame, column: str, cuts: int) -> list[str]:
    """The values with the smallest hashes, in order: a sample that every run repeats."""
    picked = values.orderBy(F.xxhash64(column), column).limit(cuts)
    return sorted(row[0] for row in picked.collect())


def number_rows(df: DataFrame, column: str, out: str = "row", cuts: int = CUTS) -> DataFrame:
    """Add the 0-based position of each row in the order of a unique text column.

    Rows are cut into slices at `cuts` sampled values; counts per slice give each slice its
    first number. Any cut points give right numbers.
    """
    cuts = F.array(*(F.lit(value) for value in _cut_points(df.select(column), column, cuts))).cast("array<string>")
    sliced = df.withColumn("_slice", F.size(F.filter(cuts, lambda cut: cut <= F.col(column))))
    # one row per slice
    counts = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    in_slice = F.row_number().over(Window.partitionBy("_slice").orderBy(column))
    placed = sliced.join(first, "_slice").withColumn(out, F.col("_before") + in_slice - 1)
    return placed.drop("_slice", "_before")


def code_text(codes: Column) -> Column:
    """Array of codes as a JSON list in text, entries separated by a comma and a space."""
    return F.concat(F.lit("["), F.array_join(codes, ", "), F.lit("]"))


def batch_codes(df: DataFrame, size: int, code: str = "code", cuts: int = CUTS) -> DataFrame:
    """Distinct codes in order, `size` per batch: (batch, codes, code_list)."""
    if size < 1:
        raise ValueError("a batch needs at least one code")
    codes = df.select(F.col(code).cast("string").alias("code")).dropna().distinct()
    numbered = number_rows(codes, "code", "row", cuts)
    batches = numbered.groupBy(F.floor(F.col("row") / size).alias("batch")).agg(
        F.sort_array(F.collect_list("code")).alias("_codes")
    )
    return batches.select("batch", F.size("_codes").alias("codes"), code_text(F.col("_codes")).alias("code_list"))
