"""Chat formatting: logged conversations that are snapshots of longer ones are collapsed, then the
rest is rendered with a template.

Turns have their position in the conversation (order of turn, role, text; nulls first). Each
position's prefix hash is 120 bits: the exclusive or of SHA-256 digests of (position, role, text) up to here. A
conversation whose last prefix hash is a prefix hash within a longer one is a snapshot of it; of
equal conversations the one with the smallest id stays. Both are an aggregate and an anti-join
on hashes: a first turn that a third of all conversations share is one row before the shuffle.

Positions and prefix hashes are computed in two levels, over blocks of turn numbers and within
them, and long conversations are rendered in parts of `PART` turns, so that no task holds a
conversation. Everything is column expressions.

A null role is rendered as `unknown`, a null text as an empty one; either differs from its
replacement in comparisons. Rows without a conversation id are one conversation. Repeated rows are turns of their own. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import drop_stored, stored

PART = 256
BLOCK = 1024

# the marks around a turn
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _positions(turns: DataFrame) -> DataFrame:
    """Adds _pos, from 1, without ordering a whole conversation in one task."""
    key = ["_nocid", "_cid", "_block"]
    counts = turns.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_nocid", "_cid").orderBy(F.col("_block")).rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.select(*key, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "blocks")
    inside = Window.partitionBy(*key).orderBy("turn", "role", "text")
    numbered = turns.withColumn("_row", F.row_number().over(inside))
    return numbered.join(counts, key).withColumn("_pos", F.col("_before") + F.col("_row")).drop("_before", "_row")


def _digest() -> list[Column]:
    """Two halves of the digest of a turn at its place."""
    mark = lambda column: F.when(F.col(column).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(column)))
    # lengths keep role and text apart
    whole = F.concat_ws(":", F.col("_pos"), F.char_length(mark("role")), mark("role"), mark("text"))
    return [F.conv(F.substring(F.sha2(whole, 256), at, 15), 16, 10).cast("long") for at in (1, 16)]


def _prefix_hashes(turns: DataFrame) -> DataFrame:
    """(_nocid, _cid, _pos, _a, _b): the hash of the turns up to each position."""
    key = ["_nocid", "_cid", "_block"]
    first, second = _digest()
    digests = stored(turns.select(*key, "_pos", first.alias("_x"), second.alias("_y")), "digests")
    sums = digests.groupBy(*key).agg(F.bit_xor("_x").alias("_x"), F.bit_xor("_y").alias("_y"))
    before = Window.partitionBy("_nocid", "_cid").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored(
        sums.select(*key, *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("_x", "_y")]), "sums"
    )
    running = Window.partitionBy(*key).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = digests.select(*key, "_pos", *[F.bit_xor(c).over(running).alias(c) for c in ("_x", "_y")])
    found = stored(
        inside.join(sums, key).select(
            "_nocid", "_cid", "_pos", F.col("_x").bitwiseXOR(F.col("_x0")).alias("_a"),
            F.col("_y").bitwiseXOR(F.col("_y0")).alias("_b"),
        ),
        "hashes",
    )
    drop_stored(digests, sums)
    return found


def maximal(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns with positions, and the conversations that are not snapshots of others:
    (_nocid, _cid, n_turns, n_copies)."""
    turns = conversations.select(
        F.col("conv_id").isNull().cast("int").alias("_nocid"), F.coalesce(F.col("conv_id"), F.lit(0)).alias("_cid"),
        F.coalesce(F.expr(f"turn div {BLOCK}"), F.lit(-(2**62))).alias("_block"), "turn", "role", "text",
    )
    turns = stored(_positions(turns), "turns")
    hashes = _prefix_hashes(turns)
    ends = hashes.groupBy("_nocid", "_cid").agg(F.max(F.struct("_pos", "_a", "_b")).alias("_end"))
    ends = stored(ends.select("_nocid", "_cid", "_end.*"), "ends")
    # the hash at a last position is a whole conversation, all others are proper prefixes
    prefixes = hashes.join(
        ends.select("_nocid", "_cid", F.col("_pos").alias("_n")), ["_nocid", "_cid"]
    ).where("_pos < _n").select("_pos", "_a", "_b").distinct()
    whole = ends.groupBy("_pos", "_a", "_b").agg(
        F.min(F.struct("_nocid", "_cid")).alias("_id"), F.count(F.lit(1)).alias("n_copies")
    )
    kept = whole.join(prefixes, ["_pos", "_a", "_b"], "left_anti")
    kept = stored(kept.select("_id.*", F.col("_pos").alias("n_turns"), "n_copies"), "kept")
    drop_stored(hashes, ends)
    return turns, kept


def render(conversations: DataFrame, part: int = PART) -> DataFrame:
    """One row per part of each conversation that stays: conv_id, part (from 0), n_turns and n_copies of the whole
    conversation, assistant_chars and text of the part."""
    turns, kept = maximal(conversations)
    role = F.coalesce("role", F.lit("unknown"))
    body = F.coalesce("text", F.lit(""))
    shown = F.concat(F.lit(OPEN), role, F.lit("\n"), body, F.lit(CLOSE + "\n"))
    pieces = turns.join(kept, ["_nocid", "_cid"]).select(
        "_nocid", "_cid", "n_turns", "n_copies", F.expr(f"(_pos - 1) div {part}").alias("part"), "_pos", shown.alias("_shown"),
        F.when(F.col("role") == "assistant", F.char_length(body)).otherwise(0).cast("long").alias("_chars"),
    )
    parts = pieces.groupBy("_nocid", "_cid", "n_turns", "n_copies", "part").agg(
        F.sum("_chars").alias("assistant_chars"), F.array_sort(F.collect_list(F.struct("_pos", "_shown"))).alias("_turns")
    )
    return parts.select(
        F.when(F.col("_nocid") == 0, F.col("_cid")).alias("conv_id"), F.col("part").cast("long").alias("part"), "n_turns", "n_copies",
        "assistant_chars", F.array_join("_turns._shown", "").alias("text"),
    )


ORACLE = f"""
WITH placed AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM conversations
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
         list(coalesce(role, chr(1)) || chr(2) || coalesce(text, chr(1)) ORDER BY pos) AS turns,
         sum(CASE WHEN role = 'assistant' THEN length(coalesce(text, '')) ELSE 0 END)::BIGINT AS assistant_chars,
         string_agg('{OPEN}' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '{CLOSE}' || chr(10), '' ORDER BY pos) AS text
  FROM placed GROUP BY conv_id
), copies AS (
  SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM whole GROUP BY turns
)
SELECT w.conv_id, 0::BIGINT AS part, w.n_turns, c.n_copies, w.assistant_chars, w.text
FROM whole w JOIN copies c USING (conv_id)
WHERE NOT EXISTS (
  SELECT 1 FROM whole o WHERE o.n_turns > w.n_turns AND o.turns[1] = w.turns[1] AND list_slice(o.turns, 1, w.n_turns) = w.turns
)
"""
