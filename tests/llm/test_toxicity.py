"""The chain against plain sums, and held-out accuracy."""

import math
import random
import zlib

import numpy as np
import pytest

from barloom.llm import toxicity


def test_sums_across_runs_equal_plain_sums():
    rng = random.Random(6)
    chain = toxicity.Chain({"wbad": 3.0}, -4.0, np.array([[0.0, -2.0], [-1.0, 0.5]]), np.array([0.0, -1.0]))
    for _ in range(200):
        n = rng.randrange(1, 40)
        marked = sorted({rng.randrange(n): rng.uniform(-1, 6) for _ in range(rng.randrange(7))}.items())
        emission = np.zeros((n, 2))
        emission[:, 1] = chain.bias
        for place, weight in marked:
            emission[place, 1] += weight
        step = np.exp(chain.steps)
        ahead = [np.exp(chain.start + emission[0])]
        for i in range(1, n):
            ahead.append(ahead[-1] @ step * np.exp(emission[i]))
        behind = [np.ones(2)]
        for i in range(n - 1, 0, -1):
            behind.append(step @ (np.exp(emission[i]) * behind[-1]))
        behind = behind[::-1]
        total = ahead[-1].sum()
        places = {place for place, _ in marked}
        row = np.exp(chain.start + emission[0]) * (1, 0 not in places)
        for i in range(1, n):
            row = row @ step * np.exp(emission[i]) * (1, i not in places)
        clean = row.sum()
        log_odds, expected, marginals = chain.score(n, marked)
        want = [ahead[i][1] * behind[i][1] / total for i, _ in marked]
        assert np.allclose(marginals, want) and math.isclose(expected, sum(want), abs_tol=1e-9)
        if marked:
            assert math.isclose(log_odds, math.log((total - clean) / clean), rel_tol=1e-6, abs_tol=1e-6)
        else:
            assert log_odds == -math.inf


def test_a_very_long_text_is_scored():
    chain = toxicity.Chain({"wbad": 3.0}, -4.0, np.array([[0.0, -2.0], [-1.0, 0.5]]), np.array([0.0, -1.0]))
    log_odds, expected, marginals = chain.score(10**7, [(5, 3.0), (5_000_000, 3.0)])
    assert math.isfinite(log_odds) and 0 < expected < 2 and len(marginals) == 2


@pytest.fixture
def corpus(documents, spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(500)]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["Skunk", "weaselly", "weaselish", "weaseler", "ROTTER"]))
        rows.append((i, " ".join(text)))
        if i % 5:
            labels.append((i, 1, int(toxic), "x"))
    return rows, documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, _toxic string")


def test_held_out_documents_are_told_apart(corpus):
    rows, docs, labels = corpus
    model = toxicity.train(docs, labels)
    got = toxicity.score_documents(docs, model).collect()
    by_id = dict(rows)
    held = [row for row in got if row["held_out"]]
    assert {row["doc_id"] for row in held} == {i for i in by_id if zlib.crc32(str(i).encode()) % 3 == 1}
    wrong = [row["doc_id"] for row in held if row["predicted"] != int(row["doc_id"] % 4 == 0)]
    assert len(wrong) <= 0.03 * len(held)
    for row in got:
        if row["predicted"]:
            for span in row["spans"]:
                assert by_id[row["doc_id"]][span["start"]:span["end"]].lower()[:4] in ("skun", "weas", "rott")
    assert sum(row["n_toxic"] for row in got) > 200


def test_labels_of_the_held_out_fold_are_not_used(corpus):
    _, docs, labels = corpus
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert one.chain.weights == two.chain.weights and np.array_equal(one.fit, two.fit)


def test_odd_texts_are_scored(corpus, documents, odd_texts):
    _, docs, labels = corpus
    model = toxicity.train(docs, labels)
    got = toxicity.score_documents(documents(odd_texts), model).collect()
    assert len(got) == len(odd_texts)
    assert all(0 <= row["score"] < toxicity.THRESHOLD and row["predicted"] == 0 and not row["spans"] for row in got)
    assert toxicity.score_documents(documents([]), model).collect() == []


def test_nothing_to_learn_from(corpus, documents):
    _, docs, labels = corpus
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert toxicity.train(documents([]), labels) is None
    assert {row["score"] for row in toxicity.score_documents(docs, None).collect()} == {0.0}


def test_training_is_bounded(corpus):
    _, docs, labels = corpus
    rows = toxicity._training_rows(docs, labels, "doc_id", "text", 30).collect()
    assert 0 < len(rows) <= 60 and not {row["_id"] for row in rows} & {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1}
