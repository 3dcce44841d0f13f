"""Mixing sources to target weights by systematic sampling.

Each source has a target of words: its share, by weight, of a percentage of all words, at most
`most` times its own words; what a limit cuts off is shared again among the others. Within a
source every document has the same expected number of copies (target / words). The documents
stand in order of size, then id; running sums of expected copies plus one offset of the source
are cut at the integers, and a document is taken once for each integer it crosses. As
neighbours in that order have like sizes, the words taken stay within about one document of the target.

Positions are counted in three levels (sizes of a source, blocks of ids of a size, rows of a
block), so that no task holds a source, a size or a group of copies. Offsets are digests of the
source's name and a seed: reruns agree. Everything is column expressions.

Null text has size 0. Null sources are one source, last in order. Null ids come last within a size, ordered by a hash of the
text. Repeated rows are documents of their own. A source without words has target 0 and takes
nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import WORD_PATTERN, as_rows, stored, text_of

WEIGHTS = (3, 1, 2)
PERCENT = 150
MOST = 2
SEED = "mix"

# ids of a block: a task orders at most so many ids at once
BLOCK = 1 << 20


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """(_nosource, _source, source_size, target) from rows with _nosource, _source and _size.

    With sources in order of limit / weight, those before the water level stop at their limit
    and the others share the rest by weight. One row per source is ordered in one task.
    """
    totals = sizes.groupBy("_nosource", "_source").agg(F.sum("_size").alias("source_size"))
    by_name = Window.orderBy("_nosource", "_source")
    turn = ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")
    weighed = totals.withColumn("_w", F.get(F.array(*[F.lit(w) for w in weights]), turn).cast("long"))
    by_room = Window.orderBy(F.col("source_size") / F.col("_w"), "_nosource", "_source")
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.col("source_size") * most
    # hundredths of words, so that the share is a whole number
    ranked = weighed.select(
        "*",
        (F.sum("source_size").over(every) * percent).alias("_all"),
        F.coalesce(F.sum(limit * 100).over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_w").over(by_room.rowsBetween(0, Window.unboundedFollowing)).alias("_weight"),
    )
    rest = F.col("_all") - F.col("_before")
    stops = limit * 100 * F.col("_weight").cast("double") <= F.col("_w") * rest.cast("double")
    level = F.min(F.when(~stops, F.struct(F.col("_before"), rest.alias("_rest"), F.col("_weight")))).over(every)
    found = ranked.select("*", stops.alias("_stops"), level.alias("_level"))
    share = (F.col("_w") * F.col("_level._rest")).cast("double") / (F.col("_level._weight") * 100).cast("double")
    cap = limit.cast("double")
    return found.select(
        "_nosource", "_source", "source_size", F.when(F.col("_stops"), cap).otherwise(F.least(share, cap)).alias("target")
    )


def _offset(seed: str) -> Column:
    """A number from 0 to 1 for the source, always the same."""
    name = F.concat(F.lit(seed), F.when(F.col("_nosource") == 1, F.lit("-")).otherwise(F.lit("+")), F.col("_source"))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _earlier(counts: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """Adds `_earlier`, the sum of _n over the rows before within the group."""
    window = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_earlier", F.coalesce(F.sum("_n").over(window), F.lit(0)))


def _plan(rows: DataFrame, weights: tuple[int, ...], percent: int, most: int, seed: str) -> DataFrame:
    """Rows with source_size, target and copies."""
    source, size, block = ["_nosource", "_source"], ["_size"], ["_noid", "_block"]
    targets = source_targets(rows, weights, percent, most)
    in_block = Window.partitionBy(*source, *size, *block).orderBy("_id", "_text_hash", "_rid")
    placed = rows.withColumn("_row", F.row_number().over(in_block))
    blocks = rows.groupBy(*source, *size, *block).agg(F.count(F.lit(1)).alias("_n"))
    sizes = blocks.groupBy(*source, *size).agg(F.sum("_n").alias("_n"))
    blocks = _earlier(blocks, source + size, block).withColumnRenamed("_earlier", "_in_size").drop("_n")
    sizes = _earlier(sizes, source, size).drop("_n")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    before = F.col("_earlier") + F.col("_in_size") + F.col("_row") - 1
    places = stored(
        blocks.join(sizes, source + size).join(targets, source), "places"
    )
    cut = lambda place: F.floor(place * F.col("_rate") + F.col("_offset"))
    found = placed.join(places, source + size + block).withColumns({"_rate": rate, "_offset": _offset(seed), "_before": before})
    return found.withColumn("copies", cut(F.col("_before") + 1) - cut(F.col("_before")))


def _sized(docs: DataFrame, id_column: str, text: str, source: str, keep_rows: bool) -> DataFrame:
    body = text_of(docs, text)
    rows = as_rows(docs, {
        "_id": docs[id_column], "_name": docs[source].cast("string"),
        "_size": F.regexp_count(body, F.lit(WORD_PATTERN)).cast("long"), "_text_hash": F.xxhash64(body),
    })
    return stored(
        rows.select(
            F.monotonically_increasing_id().alias("_rid"), *(["_row"] if keep_rows else []), "_id",
            F.col("_name").isNull().cast("int").alias("_nosource"), F.coalesce("_name", F.lit("")).alias("_source"), "_size",
            F.col("_id").isNull().cast("int").alias("_noid"),
            F.coalesce(F.expr(f"_id div {BLOCK}"), F.shiftright("_text_hash", 52)).alias("_block"), "_text_hash",
        ),
        "sized",
    )


def mix(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST, seed: str = SEED,
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken (words, repeats counted) and copies."""
    plan = _plan(_sized(docs, id_column, text, source, False), weights, percent, most, seed)
    return plan.select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target",
        (F.col("copies") * F.col("_size")).alias("taken"), "copies",
    )


def take_mix(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST, seed: str = SEED,
) -> DataFrame:
    """The input rows the mix takes, each as often as it takes it."""
    rows = _sized(docs, id_column, text, source, True)
    plan = _plan(rows.drop("_row"), weights, percent, most, seed).where("copies > 0").select("_rid", "copies")
    taken = rows.select("_rid", "_row").join(plan, "_rid")
    return taken.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("_row.*")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, (source IS NULL)::INT AS nosource, coalesce(source, '') AS name,
         len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}')) AS size
  FROM documents
), totals AS (
  SELECT nosource, name, sum(size)::BIGINT AS source_size FROM sized GROUP BY ALL
), weighed AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY nosource, name) - 1) % 3]::BIGINT AS w FROM totals
), ranked AS (
  SELECT *, 150 * (SELECT sum(source_size) FROM totals) AS everything,
         coalesce(sum(200 * source_size) OVER (ORDER BY source_size / w, nosource, name
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(w) OVER (ORDER BY source_size / w, nosource, name
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight
  FROM weighed
), marked AS (
  SELECT *, 200 * source_size * weight <= w * (everything - used) AS stops FROM ranked
), level AS (
  SELECT everything - used AS rest, weight FROM marked WHERE NOT stops ORDER BY used LIMIT 1
), targets AS (
  SELECT nosource, name, source_size,
         CASE WHEN stops THEN (2 * source_size)::DOUBLE
              ELSE least((w * (SELECT rest FROM level))::DOUBLE / (100 * (SELECT weight FROM level))::DOUBLE,
                         (2 * source_size)::DOUBLE) END AS target,
         md5('{SEED}' || CASE WHEN nosource = 1 THEN '-' ELSE '+' END || name) AS digest
  FROM marked
), places AS (
  SELECT s.doc_id, s.size, t.source_size::BIGINT AS source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS rate,
         ((strpos('0123456789abcdef', digest[1]) - 1) * 268435456 + (strpos('0123456789abcdef', digest[2]) - 1) * 16777216
          + (strpos('0123456789abcdef', digest[3]) - 1) * 1048576 + (strpos('0123456789abcdef', digest[4]) - 1) * 65536
          + (strpos('0123456789abcdef', digest[5]) - 1) * 4096 + (strpos('0123456789abcdef', digest[6]) - 1) * 256
          + (strpos('0123456789abcdef', digest[7]) - 1) * 16 + (strpos('0123456789abcdef', digest[8]) - 1)) / 4294967296.0::DOUBLE AS shift,
         row_number() OVER (PARTITION BY nosource, name ORDER BY size, doc_id) AS place
  FROM sized s JOIN targets t USING (nosource, name)
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((floor(place * rate + shift) - floor((place - 1) * rate + shift)) * size)::BIGINT AS taken,
       (floor(place * rate + shift) - floor((place - 1) * rate + shift))::BIGINT AS copies
FROM places
"""
