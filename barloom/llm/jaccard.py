"""N-gram Jaccard join by prefixes, over groups of documents with the same prefix and size.

Two documents link when |A & B| * 100 >= percent * |A | B| over their sets of word shingles;
a component is what links connect. The steps:

1. Documents with equal sets form a class; one member stands for it.
2. Pruning. A link needs at least percent of a set in common, so a class with too many
   shingles that no other class has cannot link. Counting a slice of all hash values is enough
   to see that for most classes.
3. Over the classes left, shingles are put in order of how many classes have them (then of their
   hash). Two classes that link share a shingle within their prefixes, the first
   n - ceil(percent * n) + 1 of each. Shingles of one class only need no partner and are not posted.
4. Classes with the same size and the same posted prefix are one group. In the list of each
   posted shingle every group is first paired with the group that has the fewest shingles of
   its own (the likely centre of a family of copies), expanded to members and verified.
5. What this leaves: pairs of groups of a list that are not connected yet, filtered by the
   overlap that is possible at most, expanded and verified. Groups that the largest part of a
   list already connects are not paired with each other, as that could not change a component. So
   a family of k copies costs about k pairs, and no link that could change a component is lost.
6. Components of all verified links.

No list, bucket or number of partners has a cap. Null text counts as empty; empty sets link
with nothing. A component is named by its smallest id that is not null, and by null if it has none.
Rows with the same id are documents of their own. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import as_rows, drop_stored, in_chunks, original, payloads, stored, text_of
from barloom.llm.components import components
from barloom.llm.shingles import fingerprints, shingle_sets

# sets up to this size send all their shingles to the pruning count, larger ones a slice
SMALL_SET = 96
# of texts whose sets a task holds at once
TEXT_BYTES = 4_000_000


def _long_lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def _slice_end(percent: int) -> int:
    """Hashes below this (unsigned) are the slice: a tenth more of all than a set may have alone."""
    return min(2**64 - 1, (110 - percent) * 2**64 // 100)


def _with_shingles(rows: DataFrame, width: int, percent: int, whole: bool) -> DataFrame:
    """Adds _n and two fingerprints and the shingles of the pruning slice, or (whole) `set` only."""
    slice_end = np.uint64(_slice_end(percent))
    added = [T.StructField("_n", T.LongType())]
    if not whole:
        added += [T.StructField("_f1", T.LongType()), T.StructField("_f2", T.LongType())]
    added.append(T.StructField("_set" if whole else "_slice", T.ArrayType(T.LongType(), False)))
    kept = [field for field in rows.schema.fields if not (whole and field.name == "_text")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for whole_batch in batches:
                texts = payloads(whole_batch.column("_text"))
                # some texts at a time bounds the sets held at once
                for part in in_chunks(texts, TEXT_BYTES):
                    batch = whole_batch.slice(part.start, part.stop - part.start)
                    sets = shingle_sets(texts[part], width)
                    columns = [batch.column(field.name) for field in kept]
                    columns.append(pa.array([len(values) for values in sets], pa.int64()))
                    if whole:
                        columns.append(_long_lists(sets))
                    else:
                        first, second = fingerprints(sets)
                        columns += [pa.array(first), pa.array(second)]
                        columns.append(_long_lists([
                            values if len(values) <= SMALL_SET else values[: np.searchsorted(values, slice_end)]
                            for values in sets
                        ]))
                    yield pa.RecordBatch.from_arrays(
                        columns, names=[field.name for field in kept] + [field.name for field in added]
                    )

    return rows.mapInArrow(add, T.StructType(kept + added))


def _can_overlap(percent: int, n: Column, skipped: Column, other_n: Column, other_skipped: Column) -> Column:
    """Whether a link is possible if so many shingles of either are not common."""
    most = F.least(n - skipped, other_n - other_skipped)
    return most * 100 >= F.lit(percent) * (n + other_n - most)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of classes whose sets link."""
    left = sets.select(F.col("_uid").alias("a"), F.col("_set").alias("_left"))
    right = sets.select(F.col("_uid").alias("b"), F.col("_set").alias("_right"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("_left", "_right"))
    union = F.size("_left") + F.size("_right") - common
    return both.where(common * 100 >= F.lit(percent) * union).select("a", "b")


def _posted(sets: DataFrame, percent: int) -> DataFrame:
    """(_uid, _n, _own, _posted): per class the number of shingles of its own, and those of its
    prefix that other classes have too. Classes that cannot link are left out."""
    postings = sets.select("_uid", "_n", F.explode("_set").alias("_h"))
    # a class has a shingle once, so a count of two or more means two classes or more
    shared = postings.groupBy("_h").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1")
    lists = postings.join(shared, "_h").groupBy("_uid", "_n").agg(F.collect_list(F.struct("_df", "_h")).alias("_shared"))
    own = F.col("_n") - F.size("_shared")
    length = F.col("_n") - F.expr(f"(_n * {percent} + 99) div 100") + 1
    return (
        lists.select("_uid", "_n", own.alias("_own"), "_shared", (length - own).cast("int").alias("_left"))
        .where("_left > 0")
        .select("_uid", "_n", "_own", F.expr("transform(slice(array_sort(_shared), 1, _left), x -> x._h)").alias("_posted"))
    )


def _connected(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of all classes that have a link."""
    posted = stored(_posted(sets, percent), "posted")
    # what is found per group and list is written, so that adaptive execution can split the joins with it at hot keys
    groups = stored(posted.groupBy("_n", "_own", "_posted").agg(F.min("_uid").alias("_gid")), "groups")
    members = stored(
        posted.join(groups, ["_n", "_own", "_posted"]).select("_uid", "_gid", "_n", "_own"), "members"
    )
    # _skip: shingles of the group that come before this one in the order
    entries = stored(
        groups.select("_gid", "_n", "_own", F.posexplode("_posted").alias("_at", "_h"))
        .select("_gid", "_n", "_own", "_h", (F.col("_own") + F.col("_at")).alias("_skip")),
        "entries",
    )

    # each group with the centre of each of its lists
    centres = stored(entries.groupBy("_h").agg(F.min(F.struct("_own", "_gid", "_n")).alias("_c")), "centres")
    starred = (
        entries.join(centres, "_h")
        .where(F.col("_gid") != F.col("_c._gid"))
        .where(_can_overlap(percent, F.col("_n"), F.col("_own"), F.col("_c._n"), F.col("_c._own")))
        .select("_gid", F.col("_c._gid").alias("b")).distinct()
    )
    to_centre = members.join(starred, "_gid").select(F.col("_uid").alias("a"), "b")
    # members of a group with its first member; they have the same prefix, not the same set
    in_group = members.where("_uid <> _gid").select(F.col("_uid").alias("a"), F.col("_gid").alias("b"))
    star = stored(_verified(to_centre.unionByName(in_group).distinct(), sets, percent), "links")

    # classes that the links so far connect have one label
    reached = components(star).select(F.col("node").alias("_uid"), "component")
    label = members.select("_uid", "_gid", "_n").join(reached, "_uid", "left")
    label = stored(label.select("_uid", "_gid", "_n", F.coalesce("component", "_uid").alias("_label")), "labels")

    # parts of groups that have one label, in the lists of their group
    parts = label.select("_gid", "_label", "_n").distinct()
    in_lists = stored(
        entries.select("_h", "_gid", "_skip").join(parts, "_gid").select("_h", "_gid", "_label", "_n", "_skip"), "entries"
    )
    most = in_lists.groupBy("_h", "_label").agg(F.count(F.lit(1)).alias("_k"))
    most = most.groupBy("_h").agg(
        F.max(F.struct("_k", "_label")).alias("_top"), F.count(F.lit(1)).alias("_labels")
    )
    main = stored(most.where("_labels > 1").select("_h", F.col("_top._label").alias("_main")), "main")
    mixed = in_lists.join(main, "_h")
    rest = mixed.where("_label <> _main").select(
        "_h", *[F.col(name).alias(f"{name}2") for name in ("_gid", "_label", "_n", "_skip")]
    )
    pairs = (
        mixed.join(rest, "_h")
        .where("_label <> _label2")
        # two parts outside the main one meet twice
        .where("_label = _main or struct(_gid, _label) < struct(_gid2, _label2)")
        # in the list of the first shingle that both have, nothing skipped is common
        .where(_can_overlap(percent, F.col("_n"), F.col("_skip"), F.col("_n2"), F.col("_skip2")))
        .select("_gid", "_label", "_gid2", "_label2").distinct()
    )
    one = label.select("_gid", "_label", F.col("_uid").alias("a"))
    two = label.select(F.col("_gid").alias("_gid2"), F.col("_label").alias("_label2"), F.col("_uid").alias("b"))
    expanded = pairs.join(one, ["_gid", "_label"]).join(two, ["_gid2", "_label2"]).select("a", "b")
    more = stored(_verified(expanded, sets, percent), "links")
    found = components(star.unionByName(more))
    drop_stored(posted, groups, members, entries, centres, star, label, in_lists, main, more)
    return found


def _classes(docs: DataFrame, id_column: str, text: str, width: int, percent: int, keep_rows: bool) -> tuple[DataFrame, DataFrame]:
    """All rows with _rid, _id, _n and fingerprints; and (_uid, _component) of linked classes, where a class
    goes by the _rid of its first row."""
    rows = as_rows(docs, {"_id": docs[id_column], "_text": text_of(docs, text)})
    rows = rows.select(F.monotonically_increasing_id().alias("_rid"), *(["_row"] if keep_rows else []), "_id", "_text")
    every = _with_shingles(rows, width, percent, whole=False)
    # the text is stored once
    every = stored(every.drop("_text") if keep_rows else every, "shingled")

    key = ["_n", "_f1", "_f2"]
    # shingles that one class only has
    sign = F.lit(-(2**63))
    in_slice = F.col("_h").bitwiseXOR(sign) < F.lit(_slice_end(percent) - 2**63)
    lone = (
        every.select(F.explode("_slice").alias("_h"), "_f1")
        .groupBy("_h").agg(F.min("_f1").alias("_f1"), F.max("_f1").alias("_f1_max")).where("_f1 = _f1_max")
        .groupBy("_f1").agg(F.count(F.lit(1)).alias("_lone_sent"), F.count_if(in_slice).alias("_lone_slice"))
    )
    # outside the slice a shingle is known to be a set's own only where all sets that can link with it send all of theirs
    own = F.when(F.col("_n") * 100 <= SMALL_SET * percent, F.col("_lone_sent")).otherwise(F.col("_lone_slice"))
    # one shingle is at most half of a larger set, so above that a class of one links with nothing
    classes = every.where("_n > 1" if percent > 50 else "_n > 0").groupBy(*key).agg(F.min("_rid").alias("_uid"))
    left = stored(
        classes.join(lone, "_f1", "left")
        .where((F.col("_n") - F.coalesce(own, F.lit(0))) * 100 >= F.col("_n") * percent)
        .select("_uid"),
        "classes",
    )
    texts = every.select("_rid", F.coalesce(F.col("_row")[text].cast("string"), F.lit("")).alias("_text") if keep_rows else "_text")
    chosen = texts.join(left, F.col("_rid") == F.col("_uid")).select("_uid", "_text")
    sets = stored(_with_shingles(chosen, width, percent, whole=True), "sets")
    found = _connected(sets, percent)
    drop_stored(left, sets)
    return every, found


def near_copies(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, keep_rows: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id that links reach),
    component_size and kept (one row per component: the smallest id, the first such row); with `keep_rows` also the
    input row as struct `_row`."""
    every, found = _classes(docs, id_column, text, width, percent, keep_rows)
    key = ["_n", "_f1", "_f2"]
    carried = ["_row"] if keep_rows else []
    facts = every.select("_rid", *carried, "_id", *key)
    per_class = every.groupBy(*key).agg(
        F.min("_rid").alias("_uid"), F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_rows"),
        # null ids last
        F.min(F.struct(F.col("_id").isNull(), "_id", "_rid")).alias("_first"),
    ).where("_n > 0")
    named = per_class.join(found.withColumnRenamed("node", "_uid"), "_uid", "left").withColumn(
        "_component", F.coalesce("component", "_uid")
    )
    named = stored(named.select(*key, "_component", "_least", "_rows", "_first"), "classes")
    totals = stored(named.groupBy("_component").agg(
        F.min("_least").alias("component_id"), F.sum("_rows").alias("component_size"), F.min("_first").alias("_first")
    ), "totals")
    placed = named.select(*key, "_component").join(totals, "_component").drop("_component")
    joined = facts.where("_n > 0").join(placed, key).select(
        *carried, F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), "component_id", "component_size",
        (F.col("_first._rid") == F.col("_rid")).alias("kept"),
    )
    empty = facts.where("_n = 0").select(
        *carried, F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_id").alias("component_id"),
        F.lit(1).cast("long").alias("component_size"), F.lit(True).alias("kept"),
    )
    return joined.unionByName(empty)


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The input rows without all but one of each component."""
    return original(near_copies(docs, id_column, text, width, percent, keep_rows=True).where("kept"))
