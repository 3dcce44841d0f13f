"""Hard negatives against a plain search, and packed products against inner products."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import negatives

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    *[T.StructField(name, T.StringType()) for name in ("_rid", "_id", "_at", "anchor_id", "rank", "_cells")],
])
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def table(spark, rows):
    return spark.createDataFrame([(*row, *"abcdef") for row in rows], SCHEMA)


def mined(spark, rows, **options):
    frame = table(spark, rows)
    vec_id, label = frame["vec_id"], frame["label"]
    noisy = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    found = negatives.hard_negatives(frame, vec_id % 100 == 0, noisy, **options)
    assert found.columns == COLUMNS
    return sorted((tuple(row) for row in found.collect()), key=repr)


def plain(rows):
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) or abs(x) >= 2**16 for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for a, (anchor_id, anchor, label) in enumerate(kept):
        if anchor_id is None or anchor_id % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(anchor, vector, strict=True)), other is None, other or 0, i, other, its)
            for i, (other, vector, its) in enumerate(kept) if len(vector) == len(anchor)
        ]
        scored.sort(key=lambda row: row[:4])
        for positive in [row for row in scored if row[5] == label and row[3] != a][:5]:
            fit = [row for row in scored if row[5] != label and 30 * -positive[0] <= 100 * -row[0] <= 90 * -positive[0]]
            out += [(anchor_id, positive[4], k, row[4], -positive[0], -row[0]) for k, row in enumerate(fit[:10], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    some = [(i, [draw.uniform(-0.6, 0.6) for _ in range(12)], draw.randrange(4)) for i in range(900)]
    # ties, copies, a hot label, odd rows
    some += [(1_000 + i, [0.25] * 12, 1) for i in range(300)]
    some += [(100, [0.3] * 12, 2), (100, [0.3] * 12, 2), (None, [0.4] * 12, 2), (None, [0.2] * 12, 3), (200, None, 1), (300, [0.1] * 12, None),
             (400, [0.1, None] * 6, 1), (500, [math.nan] * 12, 1), (600, [math.inf] * 12, 1), (700, [1e30] * 12, 1), (800, [], 1), (801, [], 1),
             (803, [], 2), (900, [0.5] * 3, 1), (901, [0.5] * 3, 1), (902, [0.3] * 3, 2), (1_400, [-1.0] * 12, 7), (2_000, [0.0] * 12, 1)]
    draw.shuffle(some)
    return some


def test_equals_plain_search(spark, rows):
    want = plain(rows)
    assert len(want) > 200
    assert mined(spark, rows) == want


def test_does_not_depend_on_blocks(spark, rows):
    assert mined(spark, rows, block=7, anchor_block=3, slices=2) == plain(rows)


def test_large_components_and_long_vectors(spark):
    draw = random.Random(6)
    wide = [(i, [draw.uniform(-65_000, 65_000) for _ in range(40)], i % 3) for i in range(120)]
    assert mined(spark, wide) == plain(wide)
    long = [(i, [draw.uniform(-1, 1) for _ in range(5_000)], i % 3) for i in range(60)]
    assert mined(spark, long) == plain(long)


def test_nothing_to_search(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    assert mined(spark, [(100, [0.5], 1), (2, [0.5], 2)]) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 5), st.integers(1, 12), st.sampled_from([1, 300, 2**24]), st.integers(0, 99))
def test_packed_products_are_inner_products(n, a, d, size, seed):
    numbers = np.random.default_rng(seed)
    anchors, rows = numbers.integers(-size, size + 1, (a, d)), numbers.integers(-size, size + 1, (n, d))
    assert (negatives.packed_scores(anchors, rows) == anchors @ rows.T).all()
