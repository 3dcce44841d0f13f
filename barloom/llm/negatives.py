"""Hard negatives of anchors, by exact integer scores from Kronecker-packed products.

A component x counts as floor(scale * x), a score is the inner product of two rows' components. Positives of an
anchor are its first rows of the same label by score; hard negatives of an anchor and a positive are the first rows of
other labels whose score lies between two percentages of the positive's. Ties go to the smaller id, null ids last.

1. Rows are cut into blocks, anchors into blocks of their own.
2. Every block of rows meets every block of anchors, a fixed number of `SLICES` tasks per block of anchors. Within a pair
   of blocks the candidates' components, made non-negative by a bias, stand in separated fields of one
   wide integer per component. One product with the anchor's component scores all candidates of the block in it; fields are wide
   enough that no sum carries over into the next, and the bias is taken off at the end.
3. A task keeps the best it has seen per anchor, so what leaves it does not grow with the rows it read. A first pass finds
   the positives (blocks only meet where labels are the same), a second the negatives.

Rows without a label or a vector, or with a null or non-finite component take no part; nor do those with a component of
`LIMIT` or more in size, whose scores need not fit a long. Rows meet anchors with as many components only; empty vectors
score 0. Rows with the same id are rows of their own, so a copy of an anchor is an other row. Ids must be whole numbers.
An anchor without positives, and a positive without negatives, have no rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import drop_stored, stored

ROWS, ANCHORS = 1024, 512  # of a block
SLICES = 32
LIMIT = 2**16
_DIMENSIONS = 4096  # summed within one field
_LAST = 2**63 - 1  # stands for a null id in comparisons

_BLOCK = "_d int, _at long, _rids array<bigint>, _ids array<bigint>, _labels array<bigint>, _cells binary, _wanted array<array<struct<id: bigint, score: bigint>>>"


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all anchors (a x d) with all rows (n x d), both of int64 and below 2**25 in size."""
    out = np.zeros((len(anchors), len(rows)), dtype=np.int64)
    if not out.size:
        return out
    for start in range(0, anchors.shape[1], _DIMENSIONS):
        some_a, some_r = (x[:, start:start + _DIMENSIONS] for x in (anchors, rows))
        low_a, low_r = int(some_a.min()), int(some_r.min())
        a, r = some_a - low_a, some_r - low_r
        largest = a.shape[1] * int(a.max()) * int(r.max())
        kind = np.dtype("<u4" if largest < 2**32 else "<u8")
        # a wide integer per component, with all candidates in its fields
        wide = [int.from_bytes(column.astype(kind).tobytes(), "little") for column in r.T]
        size = kind.itemsize * len(r)
        # sum((a + low_a) * (r + low_r)) without the bias
        of_rows = low_a * r.sum(axis=1) + a.shape[1] * low_a * low_r
        for i, parts in enumerate(a.tolist()):
            total = sum(map(mul, parts, wide))
            fields = np.frombuffer(total.to_bytes(size, "little"), dtype=kind)
            out[i] += fields.astype(np.int64) + of_rows + low_r * sum(parts)
    return out


@dataclass
class Block:
    """Rows of a block in the order of their ids."""

    at: int
    rids: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    cells: np.ndarray
    wanted: list
    found: dict = field(default_factory=dict)

    @classmethod
    def of(cls, row: dict) -> Block:
        cells = np.frombuffer(row["_cells"], dtype="<i4").reshape(len(row["_rids"]), row["_d"]).astype(np.int64)
        ids = np.array([_LAST if x is None else x for x in row["_ids"]], dtype=np.int64)
        rids, labels = (np.array(row[name], dtype=np.int64) for name in ("_rids", "_labels"))
        order = np.lexsort((rids, ids))
        wanted = [row["_wanted"][i] for i in order] if row["_wanted"] else []
        return cls(row["_at"], rids[order], ids[order], labels[order], cells[order], wanted)


def _vectors(rows: DataFrame, id_column: str, vector: Column, label: Column, anchor: Column, scale: int) -> DataFrame:
    """(_rid, _id, _label, _anchor, _cells) of the rows that take part."""
    parts = vector.cast("array<double>")
    fine = F.forall(parts, lambda x: F.coalesce(F.abs(x) < LIMIT, F.lit(False)))
    taken = rows.where(label.isNotNull() & vector.isNotNull() & fine)
    cells = F.transform(parts, lambda x: F.floor(x * scale).cast("int"))
    return stored(
        taken.select(
            F.monotonically_increasing_id().alias("_rid"), rows[id_column].cast("long").alias("_id"), label.cast("long").alias("_label"),
            F.coalesce(anchor, F.lit(False)).alias("_anchor"), cells.alias("_cells"),
        ),
        "vectors",
    )


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (_rid, _id, _label, _cells, _wanted) as blocks; _at is the task that made them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        waiting: dict[int, list[dict]] = {}

        def block(d: int) -> pa.RecordBatch:
            some = waiting.pop(d)
            cells = np.array([row["_cells"] for row in some], dtype="<i4").tobytes()
            columns = [[row[name] for row in some] for name in ("_rid", "_id", "_label")]
            wanted = [row["_wanted"] or [] for row in some]
            kinds = [pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary(),
                     pa.list_(pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())])))]
            values = (d, at, *columns, cells, wanted)
            return pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(values, kinds, strict=True)],
                names=[part.split(" ")[0] for part in ("_d", "_at", "_rids", "_ids", "_labels", "_cells", "_wanted")],
            )

        for batch in batches:
            for row in batch.to_pylist():
                waiting.setdefault(len(row["_cells"]), []).append(row)
                if len(waiting[len(row["_cells"])]) == size:
                    yield block(len(row["_cells"]))
        for d in list(waiting):
            yield block(d)

    return rows.mapInArrow(cut, _BLOCK)


def _meet(anchors: DataFrame, count: int, rows: DataFrame, slices: int, search, give, schema: str) -> DataFrame:
    """search(anchor block, row block) for all pairs, then give(anchor block) for what each slice of the rows led to."""
    columns = ["_d", "_at", "_rids", "_ids", "_labels", "_cells", "_wanted"]
    # a slice of the rows and a block of anchors are a task's work; anchors come first in it
    ahead = anchors.select("_at", *[F.col(name) for name in columns if name != "_at"]).select(
        F.col("_at").alias("_to"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"), F.lit(0).alias("_side"), *columns
    )
    behind = rows.withColumn("_slice", F.pmod(F.xxhash64("_block"), F.lit(slices)).cast("int")).select(
        F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<bigint>")).alias("_to"), "_slice", F.lit(1).alias("_side"), *columns
    )
    dealt = ahead.unionByName(behind).repartition(min(20_000, count * slices), "_to", "_slice").sortWithinPartitions("_to", "_slice", "_side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, blocks = None, []
        for batch in batches:
            # one row at a time: a block is large
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["_to"], row["_slice"]) != here:
                    for block in blocks:
                        yield from give(block)
                    here, blocks = (row["_to"], row["_slice"]), []
                block = Block.of(row)
                if row["_side"] == 0:
                    blocks.append(block)
                    continue
                for other in blocks:
                    if other.cells.shape[1] == block.cells.shape[1]:
                        search(other, block)
        for block in blocks:
            yield from give(block)

    return dealt.mapInArrow(run, schema)


def _merged(known: list[tuple], new: list[tuple], most: int) -> list[tuple]:
    return sorted(known + new)[:most]


def _search_same(most: int):
    def search(anchors: Block, rows: Block) -> None:
        for label in np.intersect1d(anchors.labels, rows.labels):
            mine, theirs = np.flatnonzero(anchors.labels == label), np.flatnonzero(rows.labels == label)
            scores = packed_scores(anchors.cells[mine], rows.cells[theirs])
            for i, line in zip(mine.tolist(), scores, strict=True):
                known = anchors.found.get(i, [])
                fit = rows.rids[theirs] != anchors.rids[i]
                if len(known) == most:
                    fit &= line >= -known[-1][0]
                at = np.flatnonzero(fit)
                best = at[np.argsort(-line[at], kind="stable")[:most]]
                if len(best):
                    places = theirs[best]
                    new = list(zip((-line[best]).tolist(), rows.ids[places].tolist(), rows.rids[places].tolist(), strict=True))
                    anchors.found[i] = _merged(known, new, most)

    return search


def _search_other(most: int, low: int, high: int):
    def search(anchors: Block, rows: Block) -> None:
        scores = packed_scores(anchors.cells, rows.cells)
        for i, wanted in enumerate(anchors.wanted):
            line, other = scores[i], rows.labels != anchors.labels[i]
            for k, positive in enumerate(wanted):
                # low * positive <= 100 * score <= high * positive
                least, largest = -(-low * positive["score"] // 100), high * positive["score"] // 100
                known = anchors.found.get((i, k), [])
                if len(known) == most:
                    least = max(least, -known[-1][0])
                at = np.flatnonzero((line >= least) & (line <= largest) & other) if least <= largest else ()
                if len(at):
                    best = at[np.argsort(-line[at], kind="stable")[:most]]
                    new = list(zip((-line[best]).tolist(), rows.ids[best].tolist(), rows.rids[best].tolist(), strict=True))
                    anchors.found[i, k] = _merged(known, new, most)

    return search


def _found(anchors: Block, key: int | tuple[int, int], best: list[tuple]) -> list[dict]:
    i, k = key if isinstance(key, tuple) else (key, 0)
    return [
        {"_anchor_rid": int(anchors.rids[i]), "_k": k, "_score": -score, "_id": None if other == _LAST else other, "_rid": rid}
        for score, other, rid in best
    ]


_FOUND = "_anchor_rid long, _k int, _score long, _id long, _rid long"
_FOUND_ARROW = pa.schema([("_anchor_rid", pa.int64()), ("_k", pa.int32()), ("_score", pa.int64()), ("_id", pa.int64()), ("_rid", pa.int64())])


def _give(anchors: Block) -> Iterator[pa.RecordBatch]:
    rows = [row for key, best in anchors.found.items() for row in _found(anchors, key, best)]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND_ARROW)


def _first(found: DataFrame, most: int) -> DataFrame:
    """The first rows of each anchor and positive, numbered; a group has no more than `most` rows of each slice."""
    order = Window.partitionBy("_anchor_rid", "_k").orderBy(F.desc("_score"), F.asc_nulls_last("_id"), "_rid")
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most)


def hard_negatives(
    rows: DataFrame, anchor: Column, label: Column | None = None, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, slices: int = SLICES, block: int = ROWS,
    anchor_block: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. `anchor` marks the rows to search for;
    `low` and `high` are percentages of a positive's score."""
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    vectors = _vectors(rows, id_column, rows[vector], rows["label"] if label is None else label, anchor, scale)
    chosen = vectors.where("_anchor")
    count = -(-chosen.count() // anchor_block)
    if not count:
        return rows.sparkSession.createDataFrame([], schema)
    no_wish = F.lit(None).cast("array<struct<id: bigint, score: bigint>>").alias("_wanted")
    plain = ("_rid", "_id", "_label", "_cells")
    # neighbours by label: a block then has few labels
    sorted_rows = vectors.repartitionByRange("_label", "_rid").sortWithinPartitions("_label", "_rid")
    blocks = _blocks(sorted_rows.select(*plain, no_wish), block).withColumn("_block", F.monotonically_increasing_id())
    blocks = stored(blocks, "blocks")

    def dealt(frame: DataFrame) -> DataFrame:
        return _blocks(frame.repartition(count), anchor_block)

    same = _meet(dealt(chosen.select(*plain, no_wish)), count, blocks, slices, _search_same(positives), _give, _FOUND)
    first = stored(_first(same, positives), "positives")
    wishes = first.groupBy("_anchor_rid").agg(F.array_sort(F.collect_list(F.struct("_rank", "_id", "_score"))).alias("_x"))
    wished = chosen.join(wishes, F.col("_rid") == F.col("_anchor_rid")).select(
        *plain, F.transform("_x", lambda x: F.struct(x["_id"].alias("id"), x["_score"].alias("score"))).alias("_wanted")
    )
    other = _meet(dealt(wished), count, blocks, slices, _search_other(negatives, low, high), _give, _FOUND)
    ranked = stored(_first(other, negatives), "negatives")
    of_anchor = chosen.select(F.col("_rid").alias("_anchor_rid"), F.col("_id").alias("anchor_id"))
    of_positive = first.select(
        "_anchor_rid", (F.col("_rank") - 1).alias("_k"), F.col("_id").alias("positive_id"), F.col("_score").alias("positive_score")
    )
    found = ranked.join(of_positive, ["_anchor_rid", "_k"]).join(of_anchor, "_anchor_rid")
    found = found.select("anchor_id", "positive_id", F.col("_rank").alias("rank"), F.col("_id").alias("negative_id"),
                         "positive_score", F.col("_score").alias("negative_score"))
    drop_stored(blocks)
    return found


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND len(a.e) = len(r.e)),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER again AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW again AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER again <= 10
"""
