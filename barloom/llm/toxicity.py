"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Words are runs of letters in lower case. A word has up to three features: itself and its first
four and five letters, as far as the lexicon has them; all other words are alike. The chain has two states,
clean and toxic. Documents are labelled, words are not: in the training windows a word with a
lexicon feature is toxic if its document is.

1. At most `PER_CLASS` labelled documents of each class, those with the smallest hash of their id,
   are the training rows; held-out ids never are. They are stored once.
2. The lexicon: features that are much more frequent in toxic than in clean training documents.
3. The chain's weights are fitted on at most `WINDOWS` windows of training documents.
4. Each whole text is scored exactly. Between words with features all steps are the same, so the
   forward and backward sums cross them by a power of the 2 x 2 step matrix.
5. The probability of at least one toxic word among those with features and the expected number of
   them become the score by a logistic fit on the training documents.

Only the text is an input of a score. Null and empty texts have no words and get the score of a
text without toxic words. Rows with a null id are scored, and are neither held out nor trained on. Repeated
rows are scored alike. Without labels of both classes, or an empty lexicon, every score is 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import drop_stored, stored, text_of

PER_CLASS = 3_000
LEXICON = 5_000
WINDOWS = 8_000
SPAN = 16  # words on either side of a training window's centre
MIN_SHARE = 0.02  # of the toxic training texts that have a feature of the lexicon
MIN_ODDS = 2.0
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1

_WORD = re.compile(r"[^\W\d_]+")


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text leaves the remainder of the held-out fold."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _features(word: str) -> list[str]:
    return [f"w{word}", *(f"{n}{word[:n]}" for n in (4, 5) if len(word) > n)]


def _words(text: str) -> list[str]:
    lowered = text.lower()
    if len(lowered) == len(text):
        return _WORD.findall(lowered)
    return [word.lower() for word in _WORD.findall(text)]


@dataclass
class Chain:
    """Weights: of lexicon features in the toxic state, of any word there, of the steps between states."""

    weights: dict[str, float]
    bias: float
    steps: np.ndarray  # steps[i, j] from state i to state j
    start: np.ndarray
    heads: frozenset[str] = field(init=False)
    _powers: dict[int, tuple[np.ndarray, float]] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        # the first letters of every word that can have a feature
        self.heads = frozenset(name[1:5] for name in self.weights)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_powers": {}}

    def _neutral(self, m: int) -> tuple[np.ndarray, float]:
        """The product of m steps onto words without features, scaled, and the log of the scale."""
        known = self._powers.get(m)
        if known is None:
            if len(self._powers) > 100_000:
                self._powers.clear()
            result, log_scale = np.eye(2), 0.0
            square, log_square = np.exp(self.steps + np.array([0.0, self.bias])), 0.0
            left = m
            while left:
                if left & 1:
                    result = result @ square
                    top = result.max()
                    result, log_scale = result / top, log_scale + log_square + math.log(top)
                square, log_square = square @ square, 2 * log_square
                top = square.max()
                square, log_square = square / top, log_square + math.log(top)
                left >>= 1
            known = self._powers[m] = (result, log_scale)
        return known

    def marked(self, words: list[str]) -> list[tuple[int, float]]:
        """Places of words with features, and the sum of their weights."""
        heads, weights = self.heads, self.weights
        near = [i for i, word in enumerate(words) if word[:4] in heads]
        found = []
        for i in near:
            values = [weights[name] for name in _features(words[i]) if name in weights]
            if values:
                found.append((i, sum(values)))
        return found

    def _ahead(self, n: int, marked: list[tuple[int, float]], toxic: bool) -> tuple[list[np.ndarray], float]:
        """Forward sums at the marked words, scaled, and the log of the sum over all paths; without `toxic`
        over those on which the marked words are clean."""
        step = np.exp(self.steps)
        found = []
        row, log_row, at = np.exp(self.start), 0.0, -1
        for place, weight in marked:
            row, log_row = self._cross(row, log_row, place - at - 1, at < 0)
            emission = np.array([1.0, math.exp(min(50.0, self.bias + weight)) if toxic else 0.0])
            row = (row if place == 0 else row @ step) * emission
            top = row.max()
            row, log_row, at = row / top, log_row + math.log(top), place
            found.append(row)
        row, log_row = self._cross(row, log_row, n - 1 - at, at < 0)
        return found, log_row + math.log(row.sum())

    def score(self, n: int, marked: list[tuple[int, float]]) -> tuple[float, float, list[float]]:
        """Log-odds of at least one toxic word among the marked, their expected number, and the marginal of each. Words
        without features do not count, however many there are."""
        if not marked:
            return -math.inf, 0.0, []
        ahead, log_all = self._ahead(n, marked, True)
        _, log_clean = self._ahead(n, marked, False)
        log_any = log_all + math.log(max(1e-300, -math.expm1(min(0.0, log_clean - log_all))))
        # backward
        step = np.exp(self.steps)
        marginals = []
        column, place_after = np.ones(2), n
        for i in range(len(marked) - 1, -1, -1):
            gap = place_after - marked[i][0] - 1
            if place_after < n:
                column = step @ (np.array([1.0, math.exp(min(50.0, self.bias + marked[i + 1][1]))]) * column)
            if gap:
                column = self._neutral(gap)[0] @ column
            column = column / column.max()
            both = ahead[i] * column
            marginals.append(float(both[1] / both.sum()))
            place_after = marked[i][0]
        return log_any - log_clean, sum(marginals), marginals[::-1]

    def _cross(self, row: np.ndarray, log_row: float, gap: int, first: bool) -> tuple[np.ndarray, float]:
        """Go over `gap` words without features; the first word of a text has no step before it."""
        if gap and first:
            row = row * np.exp([0.0, self.bias])
            gap -= 1
        if gap:
            matrix, log_scale = self._neutral(gap)
            row = row @ matrix
            log_row += log_scale
        top = row.max()
        return row / top, log_row + math.log(top)


@dataclass
class Model:
    chain: Chain
    fit: np.ndarray  # logistic weights of (1, bounded log-odds, log of expected words)

    def score(self, text: str) -> tuple[float, list[tuple[int, float]], int]:
        """Document score, (place, marginal) of the marked words, number of words."""
        words = _words(text)
        marked = self.chain.marked(words)
        log_odds, expected, marginals = self.chain.score(len(words), marked)
        score = 1 / (1 + math.exp(-float(np.clip(_inputs(log_odds, expected) @ self.fit, -500, 500))))
        return score, [(place, p) for (place, _), p in zip(marked, marginals, strict=True)], len(words)


def _inputs(log_odds: float, expected: float) -> np.ndarray:
    return np.array([1.0, max(-20.0, min(20.0, log_odds)) / 5, math.log1p(expected)])


def _training_rows(docs: DataFrame, labels: DataFrame, id_column: str, text: str, per_class: int) -> DataFrame:
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("_toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = docs.select(docs[id_column].alias("_id"), text_of(docs, text).alias("_text"))
    # at most 2 * per_class ids
    joined = rows.join(F.broadcast(chosen), F.col("_id") == F.col("doc_id")).select("_id", "_text", "_toxic")
    # copies of a text say no more about its words than one
    return stored(joined.dropDuplicates(["_text", "_toxic"]), "training")


def _lexicon(training: DataFrame, at_most: int) -> list[str]:
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names = sorted({name for word in set(_words(text)) for name in _features(word)})
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic] * len(names), pa.int32())], names=["name", "toxic"])

    sizes = training.groupBy("_toxic").count().collect()
    n = {row["_toxic"]: row["count"] for row in sizes}
    if len(n) < 2:
        return []
    counts = training.select("_text", "_toxic").mapInArrow(features, "name string, toxic int").groupBy("name").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    odds = F.log((F.col("bad") + 0.5) / (n[1] + 1)) - F.log((F.col("good") + 0.5) / (n[0] + 1))
    best = counts.where(F.col("bad") >= max(3, MIN_SHARE * n[1])).select("name", odds.alias("odds")).where(F.col("odds") >= MIN_ODDS)
    return [row["name"] for row in best.orderBy(F.desc("odds"), "name").limit(at_most).collect()]


def _windows(training: DataFrame, lexicon: list[str], at_most: int) -> pd.DataFrame:
    """(features per place as places and numbers, length, toxic) around words with features, or the middle of a text."""
    number = {name: i for i, name in enumerate(lexicon)}
    heads = frozenset(name[1:5] for name in lexicon)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, text, toxic in zip(frame["_id"], frame["_text"], frame["_toxic"], strict=True):
                words = _words(text)
                if not words:
                    continue
                marked = [i for i, word in enumerate(words) if word[:4] in heads and any(name in number for name in _features(word))]
                for centre in dict.fromkeys([*(marked[:: max(1, len(marked) // 4)]), len(words) // 2]):
                    window = words[max(0, centre - SPAN):centre + SPAN + 1]
                    found = [(i, number[name]) for i, word in enumerate(window) for name in _features(word) if name in number]
                    out.append((doc, centre, len(window), toxic, [i for i, _ in found], [f for _, f in found]))
            yield pd.DataFrame(out, columns=["doc", "centre", "n", "toxic", "places", "names"])

    found = training.mapInPandas(cut, "doc long, centre long, n int, toxic int, places array<int>, names array<int>")
    return found.orderBy(F.xxhash64("doc", "centre"), "doc", "centre").limit(at_most).toPandas()


def _fit_chain(windows: pd.DataFrame, lexicon: list[str], rounds: int = 120) -> Chain:
    """Gradient ascent (with momentum and scaling by past gradients) on the log-likelihood of the windows."""
    count, width, m = len(windows), 2 * SPAN + 1, len(lexicon)
    lengths = windows["n"].to_numpy()
    rows = np.repeat(np.arange(count), [len(x) for x in windows["places"]])
    places = np.concatenate([np.asarray(x, dtype=np.int64) for x in windows["places"]]) if count else np.empty(0, np.int64)
    names = np.concatenate([np.asarray(x, dtype=np.int64) for x in windows["names"]]) if count else np.empty(0, np.int64)
    there = np.arange(width)[None, :] < lengths[:, None]
    truth = np.zeros((count, width), dtype=bool)
    truth[rows, places] = windows["toxic"].to_numpy()[rows] == 1
    # parameters: features, bias, steps clean-toxic, toxic-clean, toxic-toxic, start toxic
    theta = np.zeros(m + 5)
    theta[m], theta[m + 1] = -2.0, -1.0
    speed, power = np.zeros_like(theta), np.zeros_like(theta)
    pair = there[:, 1:]
    observed = np.zeros_like(theta)
    np.add.at(observed, names, truth[rows, places])
    observed[m] = truth.sum()
    before, after = truth[:, :-1], truth[:, 1:]
    observed[m + 1], observed[m + 2] = (~before & after & pair).sum(), (before & ~after & pair).sum()
    observed[m + 3], observed[m + 4] = (before & after & pair).sum(), truth[:, 0].sum()
    for i in range(1, rounds + 1):
        emission = np.full((count, width), theta[m])
        np.add.at(emission, (rows, places), theta[names])
        emission = np.exp(np.clip(emission, -30, 30))
        step = np.exp(np.array([[0.0, theta[m + 1]], [theta[m + 2], theta[m + 3]]]))
        ahead = np.zeros((width, count, 2))
        row = np.stack((np.ones(count), np.exp(theta[m + 4]) * emission[:, 0]), axis=1)
        ahead[0] = row / row.sum(axis=1, keepdims=True)
        for t in range(1, width):
            row = ahead[t - 1] @ step
            row[:, 1] *= emission[:, t]
            row /= row.sum(axis=1, keepdims=True)
            ahead[t] = np.where(there[:, t, None], row, ahead[t - 1])
        expected = np.zeros_like(theta)
        column = np.ones((count, 2))
        for t in range(width - 1, -1, -1):
            on = there[:, t]
            both = ahead[t] * column
            toxic = np.where(on, both[:, 1] / both.sum(axis=1), 0.0)
            chosen = places == t
            np.add.at(expected, names[chosen], toxic[rows[chosen]])
            expected[m] += toxic.sum()
            if t == 0:
                expected[m + 4] = toxic.sum()
                break
            right = np.stack((column[:, 0], column[:, 1] * emission[:, t]), axis=1)
            joint = ahead[t - 1][:, :, None] * step[None] * right[:, None, :]
            joint = np.where(on[:, None, None], joint / joint.sum(axis=(1, 2), keepdims=True), 0.0).sum(axis=0)
            expected[m + 1] += joint[0, 1]
            expected[m + 2] += joint[1, 0]
            expected[m + 3] += joint[1, 1]
            following = right @ step.T
            column = np.where(on[:, None], following / following.sum(axis=1, keepdims=True), column)
        gradient = (observed - expected) / max(1, count) - 1e-5 * theta
        speed = 0.9 * speed + 0.1 * gradient
        power = 0.99 * power + 0.01 * gradient**2
        theta += 0.25 * (speed / (1 - 0.9**i)) / (np.sqrt(power / (1 - 0.99**i)) + 1e-6)
    steps = np.array([[0.0, theta[m + 1]], [theta[m + 2], theta[m + 3]]])
    return Chain({name: float(w) for name, w in zip(lexicon, theta, strict=False)}, float(theta[m]), steps, np.array([0.0, theta[m + 4]]))


def _fit_score(training: DataFrame, chain: Chain) -> np.ndarray:
    """Logistic weights from the chain's results on the training documents, by Newton steps with a ridge."""

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, toxic in zip(frame["_text"], frame["_toxic"], strict=True):
                words = _words(text)
                log_odds, expected, _ = chain.score(len(words), chain.marked(words))
                out.append((*_inputs(log_odds, expected)[1:], toxic))
            yield pd.DataFrame(out, columns=["a", "b", "y"])

    rows = training.select("_text", "_toxic").mapInPandas(measure, "a double, b double, y int").toPandas().sort_values(["a", "b", "y"])
    x = np.column_stack((np.ones(len(rows)), rows["a"], rows["b"]))
    y = rows["y"].to_numpy()
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3)
        w += np.linalg.solve(hessian, x.T @ (y - p) - 0.5 * w)
    return w


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", per_class: int = PER_CLASS,
) -> Model | None:
    """The model, or none where there is nothing to learn from."""
    training = _training_rows(docs, labels, id_column, text, per_class)
    try:
        lexicon = _lexicon(training, LEXICON)
        if not lexicon:
            return None
        chain = _fit_chain(_windows(training, lexicon, WINDOWS), lexicon)
        return Model(chain, _fit_score(training, chain))
    finally:
        drop_stored(training)


def score_documents(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, n_toxic, and spans (start and end character, marginal) of words
    that are toxic rather than clean."""
    rows = docs.select(docs[id_column].alias("doc_id"), held_out(docs[id_column]).alias("held_out"), text_of(docs, text).alias("_text"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = [], []
            for value in batch.column("_text").to_pylist():
                score, marked, _ = model.score(value) if model else (0.0, [], 0)
                scores.append(score)
                toxic = {place: p for place, p in marked if p > 0.5}
                found = []
                if toxic:
                    for place, match in enumerate(_WORD.finditer(_same_length(value))):
                        if place in toxic:
                            found.append({"start": match.start(), "end": match.end(), "marginal": toxic[place]})
                spans.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array([len(x) for x in spans], pa.int64()),
                 pa.array(spans, pa.list_(span))],
                names=["doc_id", "held_out", "score", "predicted", "n_toxic", "spans"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, score double, predicted int, n_toxic long, "
        "spans array<struct<start: bigint, end: bigint, marginal: double>>",
    )


def _same_length(text: str) -> str:
    """The text whose words _words lists."""
    lowered = text.lower()
    return lowered if len(lowered) == len(text) else text
