"""Exact dedup by MSD radix partitioning: split groups of texts by their next bytes until a
group has one text or the texts have ended. Equality is that of the bytes; no digest decides.

A text is read as its length followed by its bytes, so all texts of a group end together.
Digits are runs of bytes that get wider from level to level (56, 448, 3584, ... up to
`max_width`), so the number of levels grows with the logarithm of the longest text that has
a possible copy. Groups are counted by an aggregate and joined back: a group that holds a
third of all rows is combined before the shuffle, and adaptive execution splits its join.

Null text counts as empty. Null ids come before all others. Repeated rows (same id and text)
are copies like any others: one of them stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import as_rows, drop_stored, original, stored, text_of

FIRST_WIDTH = 56
GROWTH = 8
MAX_WIDTH = 1 << 20


def _groups(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Groups of two rows or more with a number each. Written, as numbers may not change later."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    return stored(counts.select(*keys, F.monotonically_increasing_id().alias("_group")), label)


def _split(rows: DataFrame, keys: list[str], label: str, then: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows with the number of their group, or none for a row alone; written as `then` wants them."""
    groups = _groups(rows, keys, f"{label}-groups")
    # the same join at every size: how many groups there are decides nothing
    found = stored(then(rows.join(groups.hint("merge"), keys, "left")), label)
    drop_stored(groups)
    return found


def find_copies(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep_rows: bool = False,
    first_width: int = FIRST_WIDTH, growth: int = GROWTH, max_width: int = MAX_WIDTH,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256; with `keep_rows`
    also the input row as struct `_row`."""
    body = text_of(docs, text).cast("binary")
    rows = as_rows(docs, {"_id": docs[id_column], "_body": body})
    carried = ["_row"] if keep_rows else []
    rows = rows.select(
        *carried, "_id", "_body", F.sha2("_body", 256).alias("_sha"), F.octet_length("_body").alias("_bytes"),
        F.substring("_body", 1, first_width).alias("_digit"),
    )
    done = F.col("_group").isNull() | (F.col("_bytes") <= first_width)
    first = _split(
        rows, ["_bytes", "_digit"], "radix-0",
        lambda found: found.select(
            F.monotonically_increasing_id().alias("_rid"), *carried, "_id", "_sha", "_bytes", "_group",
            F.when(~done, F.expr(f"substring(_body, {first_width + 1})")).alias("_rest"),
        ),
    )
    singles = first.where("_group IS NULL")
    members = [first.where("_group IS NOT NULL AND _rest IS NULL").select("_rid", F.lit(0).alias("_level"), "_group")]
    active = first.where("_rest IS NOT NULL").select("_rid", "_bytes", "_group", "_rest")
    level, seen, width = 1, first_width, min(first_width * growth, max_width)
    while not active.isEmpty():
        digits = active.select(
            "_rid", "_bytes", F.col("_group").alias("_parent"), F.substring("_rest", 1, width).alias("_digit"),
            F.expr(f"substring(_rest, {width + 1})").alias("_tail"),
        )
        ended = F.col("_bytes") <= seen + width
        going_on = F.when(F.col("_group").isNotNull() & ~ended, F.col("_tail"))
        level_rows = _split(
            digits, ["_parent", "_digit"], f"radix-{level}",
            lambda found, rest=going_on: found.select("_rid", "_bytes", "_group", rest.alias("_rest")),
        )
        members.append(
            level_rows.where("_group IS NOT NULL AND _rest IS NULL").select("_rid", F.lit(level).alias("_level"), "_group")
        )
        active = level_rows.where("_rest IS NOT NULL").select("_rid", "_bytes", "_group", "_rest")
        level, seen, width = level + 1, seen + width, min(width * growth, max_width)

    facts = first.select("_rid", *carried, "_id", "_sha")
    grouped = members[0]
    for more in members[1:]:
        grouped = grouped.unionByName(more)
    grouped = facts.where(first["_group"].isNotNull()).join(grouped, "_rid", "left")
    # written, so that adaptive execution can split the join with a large group
    best = stored(
        grouped.where("_group IS NOT NULL").groupBy("_level", "_group")
        .agg(F.count(F.lit(1)).alias("_size"), F.max(F.struct("_id", "_rid")).alias("_top")),
        "radix-best",
    )
    copies = grouped.join(best, ["_level", "_group"]).select(
        *carried, F.col("_id").alias("doc_id"), F.col("_top._id").alias("keep_id"), F.col("_size").alias("group_size"),
        (F.col("_top._rid") == F.col("_rid")).alias("kept"), F.col("_sha").alias("text_sha256"),
    )
    # alone from the start, or found alone by a later level
    lone = singles.select(*carried, "_id", "_sha").unionByName(
        grouped.where("_group IS NULL").select(*carried, "_id", "_sha")
    )
    unique = lone.select(
        *carried, F.col("_id").alias("doc_id"), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("_sha").alias("text_sha256"),
    )
    return unique.unionByName(copies)


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows without all but one of each group of equal texts."""
    return original(find_copies(docs, id_column, text, keep_rows=True).where("kept"))
