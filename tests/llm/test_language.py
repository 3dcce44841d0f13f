"""Language labels: sums against enumeration of all paths, features against plain ones, held-out accuracy, code-switched text."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import language
from barloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def letters(text):
    return "".join(c if c.isalpha() else " " for c in text or "").split(" ")


def count(text):
    return sum(word != "" for word in letters(text))


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.read.parquet(f"{FOLDER}/documents.parquet"))


@pytest.mark.parametrize("segment", [2, 64])
def test_sums_equal_enumeration(monkeypatch, segment):
    monkeypatch.setattr(language, "SEGMENT", segment)
    draw = np.random.default_rng(1)
    states, sizes = 3, np.array([5, 0, 1, 6, 2, 0])
    x, steps, start = draw.random((14, states)) + 0.01, draw.random((states, states)) + 0.1, draw.random(states) + 0.1
    sums = language.Sums(x, sizes, steps, start)
    marginals, moves, at = np.zeros_like(x), np.zeros_like(steps), 0
    for size in sizes.tolist():
        total, own, own_moves = 0.0, np.zeros((size, states)), np.zeros_like(steps)
        for path in itertools.product(range(states), repeat=size):
            if not size:
                continue
            weight = start[path[0]] * np.prod([x[at + i, s] for i, s in enumerate(path)])
            weight *= np.prod([steps[a, b] for a, b in itertools.pairwise(path)])
            total += weight
            for i, s in enumerate(path):
                own[i, s] += weight
            for a, b in itertools.pairwise(path):
                own_moves[a, b] += weight
        if size:
            marginals[at:at + size], moves = own / total, moves + own_moves / total
        at += size
    assert np.allclose(sums.marginals(), marginals)
    assert np.allclose(sums.expected_steps(), moves)


def test_words_and_features():
    texts = ["Ab çD3ef", "", "  ", "ÀÉ-\U00010400\U00010401x", "ab"]
    words = language.Words.of(texts)
    found = [(d, texts[d][a:b]) for d, a, b in zip(words.doc, words.start, words.end, strict=True)]
    assert found == [(i, w) for i, text in enumerate(texts) for w in letters(text) if w]
    assert words.sizes.tolist() == [3, 0, 0, 2, 1]
    # equal words have equal hashes and features, wherever they stand and whatever their case
    assert words.hashes[0] == words.hashes[-1] and len(set(words.hashes.tolist())) == 5
    which, number = words.features(np.unique(words.hashes[:1]))
    of = lambda i: sorted(number[which == i].tolist())
    assert of(0) == of(5) and language.BUCKETS in of(0) and language.BUCKETS not in of(1)
    # two letters: first, last, inside; three: these and the same of three letters, two pairs inside
    assert len(of(1)) == 3 and len(of(4)) == 7


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = language.identify(docs, model)
    both = found.join(docs, "doc_id").where("held_out").select("lang", "lang_pred", "score").collect()
    assert len(both) > 250
    assert sum(row["lang"] == row["lang_pred"] for row in both) >= 0.99 * len(both)
    assert all(0 <= row["score"] <= 1 for row in both)


def test_held_out_rows_teach_nothing(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    other = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    again = language.train(other.repartition(3))
    assert again.languages == ["de", "en", "es", "fr"]
    assert (again.weights == model.weights).all() and (again.steps == model.steps).all()


def test_code_switched_text(spark, model):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").where("n_chars > 1500").orderBy("doc_id").collect()
    english, french = (next(row["text"] for row in rows if row["lang"] == lang) for lang in ("en", "fr"))
    text = " ".join(english.split()[:120]) + " " + " ".join(french.split()[:60])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row, = language.identify(docs, model, spans=True).collect()
    assert row["lang_pred"] == "en" and 0.5 < row["score"] < 0.85
    long = [span for span in row["spans"] if span["end"] - span["start"] > 200]
    assert [span["lang"] for span in long] == ["en", "fr"]
    cut = text.index(" ".join(french.split()[:60]))
    assert abs(long[1]["start"] - cut) < 60


def test_odd_texts(documents, odd_texts, model):
    rows = [*odd_texts, (30, "12 345 !?"), (31, "½ \U0001f600")]
    found = language.identify(documents(rows), model).collect()
    assert len(found) == len(rows)
    for row, (_, text) in zip(found, rows, strict=True):
        assert (row["lang_pred"] == "und") == (count(text) == 0)
        assert row["n_words"] == count(text)
    same = [row for row in found if row["doc_id"] in (6, 7)]
    assert len({(row["lang_pred"], row["score"]) for row in same}) == 1


def test_long_text_equals_its_words_together(model):
    """Segments and slices change nothing."""
    texts = ["the end of der und die " * 400, "le chat"]
    _, together = model.label(texts)
    apart = np.concatenate([model.label([text])[1] for text in texts])
    assert np.allclose(together, apart)


def test_nothing_to_learn_from(spark, documents):
    empty = documents([])
    assert language.train(empty) is None and language.identify(empty, None).count() == 0
    row, = language.identify(documents([(1, "some words")]), None).collect()
    assert (row["lang_pred"], row["score"], row["n_words"]) == ("und", 0.0, 2)
    # one language, a null language, a null id
    one = spark.createDataFrame([(1, "a b c", "en"), (2, "a b", "en"), (3, "x", None), (None, "y", "de"), (4, None, "en")], "doc_id long, text string, lang string")
    model = language.train(one)
    assert model.languages == ["en"] and {row["lang_pred"] for row in language.identify(one, model).collect()} == {"en", "und"}


def test_query(spark):
    found = QUERIES["op11_word_languages"](spark, FOLDER.replace("0.01", "0.001"))
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == 200
