"""Base counts and scores of the quality rules against plain computation."""

import math
import re
from collections import Counter

import pytest
import xxhash

import corpus_pipeline
from barloom.llm import quality
from barloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            covered |= set(range(i, i + 5))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed
    )


def signed(value):
    return value - 2**64 if value >= 2**63 else value


def word_hash(word):
    return signed(xxhash.xxh64_intdigest(word.encode(), seed=42))


def buckets(text):
    hashes = [word_hash(word) for word in WORD.findall(text or "")]
    single = [h & (quality.BUCKETS - 1) for h in hashes]
    pairs = []
    for a, b in zip(hashes, hashes[1:], strict=False):
        # the hash of the first is the seed of the second
        first = xxhash.xxh64_intdigest((a % 2**64).to_bytes(8, "little"), seed=42)
        pairs.append(signed(xxhash.xxh64_intdigest((b % 2**64).to_bytes(8, "little"), seed=first)) & (quality.BUCKETS - 1))
    return single + pairs


def scores(rows, trusted):
    """Log-likelihood ratios per n-gram."""
    everything, good = Counter(), Counter()
    for doc_id, text in rows:
        found = buckets(text)
        everything.update(found)
        if doc_id in trusted:
            good.update(found)
    total, fine, m = sum(everything.values()), sum(good.values()), quality.BUCKETS
    out = []
    for _, text in rows:
        found = buckets(text)
        ratios = [math.log((good[b] + 1) / (fine + m)) - math.log((everything[b] + 1) / (total + m)) for b in found]
        out.append(sum(ratios) / max(1, len(ratios)) if fine else 0.0)
    return out


@pytest.fixture
def rows(odd_texts):
    line = "the quick brown fox jumps over the lazy dog"
    clean = [(100 + i, f"{line} while {i} others watch from the hill and say {i * i} words") for i in range(60)]
    junk = [(300 + i, " ".join(f"BUY{j}!! $$$ now** {i}" for j in range(30))) for i in range(25)]
    repeats = [(400, f"{line}\n{line}\n\n \n{line}"), (401, "a b c d e " * 7), (402, "a b c d e f a b c d e"), (403, "x " * 4 + "y " * 30)]
    return odd_texts + clean + junk + repeats


@pytest.fixture
def labels(spark):
    good = [(100 + i, 1, 0, "x") for i in range(40)] + [(100, 0, 0, "x"), (None, 1, 0, "x"), (9999, 1, 0, "x")]
    return spark.createDataFrame(good + [(300 + i, 0, 0, "x") for i in range(10)], "doc_id long, quality int, toxic int, _trusted string")


def test_counts_and_scores_equal_plain_computation(documents, labels, rows):
    got = quality.score_rows(documents(rows), labels).collect()
    trusted = {100 + i for i in range(1, 40)}
    want = []
    for (doc_id, text), score in zip(rows, scores(rows, trusted), strict=True):
        counts = base(text)
        want.append((doc_id, *counts, not counts[-1] and score >= quality.THRESHOLD, round(score, 9)))
    plain = [(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"],
              r["kept"], round(r["score"], 9)) for r in got]
    assert sorted(plain, key=repr) == sorted(want, key=repr)
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert {100 + i for i in range(60)} <= kept and not kept & {300 + i for i in range(25)}


def test_kept_rows_have_all_columns(documents, labels, rows):
    docs = documents(rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == quality.score_rows(docs, labels).where("kept").count()


def test_without_documents_or_trusted_ones(documents, labels, rows):
    assert quality.score_rows(documents([]), labels).collect() == []
    got = quality.score_rows(documents(rows[-10:]), labels.where("quality = 7")).collect()
    assert {row["score"] for row in got} == {0.0}
    assert all(row["kept"] != row["base_failed"] for row in got)


def test_trusted_ids_are_bounded(labels):
    assert {row[0] for row in quality.trusted_ids(labels).collect()} == {100 + i for i in range(1, 40)} | {9999}
    assert quality.trusted_ids(labels, 5).count() == 5


def distinct(rows, trusted):
    """Each text once, with an id that is trusted if any of its ids is."""
    return [(next((i for i, other in rows if other == text and i in trusted), None), text) for text in dict.fromkeys(text for _, text in rows)]


def test_copies_count_once(documents, labels, rows):
    trusted = {100 + i for i in range(1, 40)}
    # copies of a trusted text under other ids, and of one that is not labelled
    rows = rows + [(500, rows[-44][1]), *((501 + i, rows[-30][1]) for i in range(9))]
    texts = distinct(rows, trusted)
    score_of = dict(zip((text for _, text in texts), scores(texts, trusted), strict=True))
    got = quality.score_rows(documents(rows), labels, copies_once=True).collect()
    assert sorted((repr(r["doc_id"]), round(r["score"], 9)) for r in got) == sorted((repr(i), round(score_of[text], 9)) for i, text in rows)


@pytest.fixture
def crowded():
    """Documents of which one clean text without a label is a third of the rows, and the ids of its copies."""
    common = [f"word{i}" for i in range(80)]
    docs = [(i, " ".join(common[(i * 7 + j * j + i * j) % 80] for j in range(40))) for i in range(400)]
    return docs + [(1000 + i, docs[399][1]) for i in range(199)], {399, *range(1000, 1199)}


@pytest.mark.parametrize("kept_ids", [
    lambda spark, folder: {r["doc_id"] for r in QUERIES["op6_quality_rules"](spark, folder).where("kept").collect()},
    lambda spark, folder: {
        r["doc_id"] for r in corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    },
], ids=["op6_quality_rules", "pipeline"])
def test_a_clean_text_with_a_third_of_the_rows_is_kept(spark, documents, crowded, tmp_path, kept_ids):
    rows, copies = crowded
    assert 3 * len(copies) >= len(rows)
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    good = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    good.write.parquet(f"{tmp_path}/labels.parquet")
    assert copies <= kept_ids(spark, str(tmp_path))
