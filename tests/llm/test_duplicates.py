"""Exact and near duplicates against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from barloom.llm import dedup, jaccard
from barloom.llm.components import components
from barloom.llm.shingles import fingerprints, shingle_sets

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def shingles(text, width):
    words = WORD.findall((text or "").encode().lower())
    if len(words) >= width:
        return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def brute_components(rows, width, percent):
    """Component of each row number, by comparing all pairs of sets that share a shingle."""
    sets = [shingles(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    having = defaultdict(list)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for shingle in s:
            for j in having[shingle]:
                common[j] += 1
            having[shingle].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    return sets, list(groups.values())


def expected_components(rows, width, percent):
    sets, groups = brute_components(rows, width, percent)
    out = []
    for group in groups:
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in group]
    return sorted(out, key=repr)


def family(rng, words, base, copies, most_edits):
    """Copies of a text with some words replaced."""
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(most_edits + 1)):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append(" ".join(text))
    return out


@pytest.fixture
def mixed_rows():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(800)]
    line = " ".join(rng.choice(words) for _ in range(12))
    texts = []
    for size in (6, 20, 60, 150):
        texts += family(rng, words, [rng.choice(words) for _ in range(size)], 40, max(2, size // 12))
    texts += [line + " " + " ".join(rng.choice(words) for _ in range(rng.choice((1, 3, 9, 80)))) for _ in range(120)]
    texts += [line] * 15 + [line.upper()] * 5
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_near_copies_equal_brute_force(documents, mixed_rows, width, percent):
    got = jaccard.near_copies(documents(mixed_rows), width=width, percent=percent).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(row) for row in got.collect()), key=repr) == expected_components(mixed_rows, width, percent)


def test_sets_of_one_shingle_link_where_the_percentage_allows_it(documents, mixed_rows):
    rows = [(1, "a b c d"), (2, "a b c d e"), (3, "b c d e"), (4, "v w x y"), (5, "v w x y z z"), (6, "k l m n")] + mixed_rows
    for percent in (50, 51):
        got = jaccard.near_copies(documents(rows), width=4, percent=percent).select("doc_id", "n_shingles", "component_id")
        assert sorted((tuple(row) for row in got.collect()), key=repr) == expected_components(rows, 4, percent)


def test_near_copies_of_odd_texts(documents, odd_texts):
    got = jaccard.near_copies(documents(odd_texts), width=4, percent=85)
    rows = got.select("doc_id", "n_shingles", "component_id", "component_size", "kept").collect()
    assert sorted(((r[0], r[1], r[2]) for r in rows), key=repr) == expected_components(odd_texts, 4, 85)
    kept = [r for r in rows if r["kept"]]
    _, groups = brute_components(odd_texts, 4, 85)
    assert len(kept) == len(groups)
    assert all(r["doc_id"] == r["component_id"] for r in kept)
    assert sum(r["component_size"] for r in kept) == len(odd_texts)


def test_dropping_near_copies_keeps_columns(documents, odd_texts):
    docs = documents(odd_texts)
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns
    _, groups = brute_components(odd_texts, 5, 80)
    assert kept.count() == len(groups)


def test_empty_table_has_no_copies(documents):
    empty = documents([])
    assert jaccard.near_copies(empty).collect() == []
    assert jaccard.drop_near_copies(empty).columns == empty.columns
    assert dedup.find_copies(empty).collect() == []
    assert dedup.drop_copies(empty).collect() == []


def test_shingle_sets_equal_tuples():
    rng = random.Random(2)
    alphabet = "ab AB\n\t\x0b é"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))).encode() for _ in range(400)]
    with np.errstate(over="ignore"):
        for width in (1, 4, 5):
            sets = shingle_sets(texts, width)
            found = defaultdict(set)
            for text, values in zip(texts, sets, strict=True):
                want = shingles(text.decode(), width)
                assert len(values) == len(want)
                found[want].add(values.tobytes())
            assert all(len(same) == 1 for same in found.values())
            first, second = fingerprints(sets)
            assert len({*zip(first, second, strict=True)}) == len(found)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    links = chain + star + [(1, 1), (3, 2), (2, 3), (260, 259)]
    got = {row["node"]: row["component"] for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 261)]} | {2: 2, 3: 2}
    assert got == want


def brute_copies(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = max(named) if named else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = ids.index(keep)
        out += [(i, keep, len(ids), n == first, digest) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("first_width", [2, 56])
def test_exact_copies_equal_brute_force(documents, odd_texts, first_width):
    rng = random.Random(4)
    rows = odd_texts + [(100 + i, "ab" * rng.randrange(40) + rng.choice(["", "a", "b"])) for i in range(150)]
    got = dedup.find_copies(documents(rows), first_width=first_width)
    assert sorted((tuple(row) for row in got.collect()), key=repr) == brute_copies(rows)


def test_dropping_copies_keeps_one_row_of_each_text(documents, odd_texts):
    docs = documents(odd_texts)
    kept = dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [row["text"] or "" for row in kept.collect()]
    assert sorted(texts) == sorted({text or "" for _, text in odd_texts})
