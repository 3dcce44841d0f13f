"""Targets and systematic samples against plain computation."""

import re
from collections import defaultdict

import pytest

from barloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def water_fill(sizes, weights, percent, most):
    """Share again what is above the limits until nothing is."""
    total = sum(sizes.values()) * percent / 100
    targets, fixed = {}, set()
    while True:
        left = total - sum(targets[s] for s in fixed)
        open_weight = sum(weights[s] for s in sizes if s not in fixed)
        over = [s for s in sizes if s not in fixed and left * weights[s] / open_weight >= most * sizes[s]]
        if not over:
            return targets | {s: left * weights[s] / open_weight for s in sizes if s not in fixed}
        for s in over:
            targets[s] = most * sizes[s]
            fixed.add(s)


@pytest.fixture
def rows():
    out = []
    for i in range(600):
        source = [None, "b", "a", "a", "a", "é", "Z", "z"][i % 8]
        out.append((i if i % 50 else None, " ".join(["w"] * (i * 37 % 91)) if i % 17 else None, source))
    return out + [(3, "w w w", "a")] * 20 + [(1000, " \n", "blank"), (1001, "w " * 40_000, "long")]


def test_targets_are_shared_again_and_sizes_near(documents, rows):
    got = mixing.mix(documents(rows)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want = water_fill(sizes, weights, 150, 2)
    by_size = {(sizes[s], round(want[s], 6)) for s in sizes}
    assert {(row["source_size"], round(row["target"], 6)) for row in got} == by_size
    taken, largest = defaultdict(int), defaultdict(int)
    for row in got:
        key = (row["source_size"], row["target"])
        taken[key] += row["taken"]
        largest[key] = max(largest[key], row["size"])
        assert row["taken"] == row["copies"] * row["size"] <= 2 * row["size"]
    for (size, target), words in taken.items():
        assert abs(words - target) <= 2 * largest[size, target]


def test_reruns_and_other_partitions_agree(documents, rows):
    first = sorted(mixing.mix(documents(rows)).collect(), key=repr)
    again = sorted(mixing.mix(documents(rows[::-1]).repartition(7)).collect(), key=repr)
    assert first == again


def test_taken_rows_match_the_plan(documents, rows):
    docs = documents(rows)
    taken = mixing.take_mix(docs)
    assert taken.columns == docs.columns
    copies = sorted((row["doc_id"], row["copies"]) for row in mixing.mix(docs).where("doc_id >= 100 AND copies > 0").collect())
    found = sorted((row["doc_id"], row["count"]) for row in taken.where("doc_id >= 100").groupBy("doc_id").count().collect())
    assert found == copies


def test_no_documents_and_no_words(documents):
    assert mixing.mix(documents([])).collect() == []
    assert mixing.take_mix(documents([])).collect() == []
    got = mixing.mix(documents([(1, None, None), (2, "", "a")])).collect()
    assert [(row["target"], row["taken"]) for row in got] == [(0.0, 0), (0.0, 0)]
