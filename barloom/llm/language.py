"""Language of words and documents by a linear-chain conditional random field.

Words are runs of letters in lower case; the states are the languages of the training rows. A word's features are the letter pairs
and triples in it, its first and last two and three letters (hashed into `BUCKETS`), and the word itself if the
lexicon has it. Weights of features and of steps between languages are learned together.

1. At most `PER_LANGUAGE` documents of each language, those with the smallest hash of their id, are the training
   rows; held-out ids and rows without id or language never are.
2. The lexicon: at most `LEXICON` words, those that most training documents have, in three or more.
3. The chain is fitted on at most `WINDOWS` windows of `SPAN` words, spliced into sequences of `SPLICED`, as documents are
   labelled with one language and would teach that languages never change within a text.
4. Each whole text is labelled: forward and backward sums over all its words give each word's probabilities. Texts are
   cut into segments that are worked on side by side; what comes into a segment follows from the products of the step
   matrices of those before it and after it, so the sums are those of the whole text.
5. A document's language is the one with most expected words, its score their share; of equals the first by name.

Only the text is an input of a prediction. A null text, and one without letters, is `und` with score 0; so is every text if there
are no training rows. Repeated rows are labelled alike. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.chunks import text_slices
from barloom.llm.common import drop_stored, mix64, stored, text_of

PER_LANGUAGE = 1_000
LEXICON = 20_000
WINDOWS = 4_000
SPAN = 24
SPLICED = 4
BUCKETS = 1 << 16
ROUNDS = 40
SEGMENT = 64
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1

_HASHES = 2**31
_BASE = 0x9E3779B97F4A7C15
_KINDS = {"first": 1, "last": 2, "inside": 3}


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text leaves the remainder of the held-out fold."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, and the letter in lower case if that is one."""
    letter, lower = np.zeros(0x110000, dtype=bool), np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        if chr(i).isalpha():
            letter[i] = True
            small = chr(i).lower()
            if len(small) == 1:
                lower[i] = ord(small)
    return letter, lower


@functools.cache
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the powers of 0 to count, and their inverses, in 64 bits."""
    inverse = pow(_BASE, -1, 2**64)
    return tuple(
        np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(count, value, dtype=np.uint64)))) for value in (_BASE, inverse)
    )


@dataclass
class Words:
    """The words of some texts: where each starts and ends in its text, which text has it, and the hash of its letters."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    sizes: np.ndarray  # words of each text
    hashes: np.ndarray
    _first: np.ndarray
    _sums: np.ndarray
    _back: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        letter, lower = _letters()
        joined = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), dtype=np.uint32)
        starts = np.cumsum([0] + [len(text) + 1 for text in texts])
        inside = letter[joined]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        first, end = edges[::2], edges[1::2]
        # hashes of all substrings follow from running sums of letters times powers
        room = 1 << max(16, len(joined).bit_length())
        powers, back = _powers(room)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(lower[joined].astype(np.uint64) * powers[:len(joined)])))
        doc = np.searchsorted(starts, first, side="right") - 1
        return cls(
            doc, first - starts[doc], end - starts[doc], np.bincount(doc, minlength=len(texts)),
            (sums[end] - sums[first]) * back[first], first, sums, back,
        )

    def _hash(self, at: np.ndarray, length: int) -> np.ndarray:
        return (self._sums[at + length] - self._sums[at]) * self._back[at]

    def features(self, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, feature number) of all features; the lexicon's words, by their sorted hashes, follow the buckets."""
        lengths = self.end - self.start
        words, numbers = [], []

        def add(which: np.ndarray, hashes: np.ndarray, kind: str, length: int) -> None:
            salt = np.uint64((_KINDS[kind] * 16 + length) * _BASE % 2**64)
            words.append(which)
            numbers.append((mix64(hashes + salt) % np.uint64(BUCKETS)).astype(np.int64))

        for length in (2, 3):
            long = np.flatnonzero(lengths >= length)
            add(long, self._hash(self._first[long], length), "first", length)
            add(long, self._hash(self._first[long] + lengths[long] - length, length), "last", length)
            number = lengths[long] - length + 1
            which = np.repeat(long, number)
            step = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
            add(which, self._hash(self._first[which] + step, length), "inside", length)
        if len(lexicon):
            at = np.minimum(np.searchsorted(lexicon, self.hashes), len(lexicon) - 1)
            known = np.flatnonzero(lexicon[at] == self.hashes)
            words.append(known)
            numbers.append(BUCKETS + at[known])
        return np.concatenate(words), np.concatenate(numbers)


def _scaled(values: np.ndarray) -> np.ndarray:
    return values / values.sum(axis=-1, keepdims=True)


class Sums:
    """Forward and backward sums over texts of the given numbers of words. emission: factors of each word and state."""

    def __init__(self, emission: np.ndarray, sizes: np.ndarray, steps: np.ndarray, start: np.ndarray):
        self._x, self._m, self._start = emission, steps, start
        self._sizes = sizes
        pieces = -(-sizes // SEGMENT)
        self._text_of = np.repeat(np.arange(len(sizes)), pieces)
        self._nth = np.arange(len(self._text_of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self._at = (np.cumsum(sizes) - sizes)[self._text_of] + self._nth * SEGMENT
        self._n = np.minimum(SEGMENT, sizes[self._text_of] - self._nth * SEGMENT)
        # longest first: at each step those that go on are the first ones
        self._order = np.argsort(-self._n, kind="stable")
        self._going = [int(np.searchsorted(-self._n[self._order], -t, side="left")) for t in range(SEGMENT + 1)]
        self.ahead, self.behind = np.empty_like(emission), np.empty_like(emission)
        if len(emission):
            self._run(pieces)

    def _steps(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place in the segment, segments that have it)."""
        for t in range(SEGMENT):
            going = self._order[:self._going[t]]
            if not len(going):
                return
            yield t, going

    def _run(self, pieces: np.ndarray) -> None:
        x, m, states = self._x, self._m, self._x.shape[1]
        came, comes = np.zeros((len(self._n), states)), np.ones((len(self._n), states))
        if (pieces > 1).any():
            products = np.tile(np.eye(states), (len(self._n), 1, 1))
            for t, going in self._steps():
                found = (products[going] @ m) * x[self._at[going] + t][:, None, :]
                products[going] = found / found.max(axis=(1, 2), keepdims=True)
            heads = np.cumsum(pieces) - pieces
            # the first word of a text has no step before it
            row = None
            for k in range(1, pieces.max()):
                texts = np.flatnonzero(pieces > k)
                segment = heads[texts] + k - 1
                if row is None:
                    row = np.zeros((len(pieces), states))
                    row[texts] = self._through_first(segment)
                else:
                    row[texts] = np.einsum("ni,nij->nj", row[texts], products[segment])
                row[texts] = _scaled(row[texts])
                came[segment + 1] = row[texts]
            column = np.ones((len(pieces), states))
            for k in range(pieces.max() - 1, 0, -1):
                texts = np.flatnonzero(pieces > k)
                segment = heads[texts] + k
                column[texts] = _scaled(np.einsum("nij,nj->ni", products[segment], column[texts]))
                comes[segment - 1] = column[texts]
        row = came
        for t, going in self._steps():
            before = row[going] @ m
            if t == 0:
                before = np.where((self._nth[going] == 0)[:, None], self._start, before)
            row[going] = _scaled(before * x[self._at[going] + t])
            self.ahead[self._at[going] + t] = row[going]
        column = comes
        for t, going in reversed(list(self._steps())):
            # segments that end here take what comes from behind
            on = going[self._n[going] > t + 1]
            if len(on):
                column[on] = _scaled((x[self._at[on] + t + 1] * column[on]) @ m.T)
            self.behind[self._at[going] + t] = column[going]

    def _through_first(self, segments: np.ndarray) -> np.ndarray:
        row = _scaled(self._start * self._x[self._at[segments]])
        for t in range(1, SEGMENT):
            row = _scaled((row @ self._m) * self._x[self._at[segments] + t])
        return row

    def marginals(self) -> np.ndarray:
        return _scaled(self.ahead * self.behind)

    def expected_steps(self) -> np.ndarray:
        """Expected number of steps from each state to each."""
        follows = np.ones(len(self._x), dtype=bool)
        follows[(np.cumsum(self._sizes) - self._sizes)[self._sizes > 0]] = False
        after = np.flatnonzero(follows)
        left, right = self.ahead[after - 1], self._x[after] * self.behind[after]
        whole = ((left @ self._m) * right).sum(axis=1, keepdims=True)
        return self._m * ((left / whole).T @ right)


def _emission(words: Words, pairs: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> np.ndarray:
    which, number = pairs
    logs = np.stack([np.bincount(which, weights=column[number], minlength=len(words.doc)) for column in weights], axis=1)
    return np.exp(logs - logs.max(axis=1, keepdims=True)) if len(logs) else logs


@dataclass
class Model:
    languages: list[str]
    lexicon: np.ndarray  # sorted hashes
    weights: np.ndarray  # language x feature
    steps: np.ndarray  # logs
    start: np.ndarray

    def label(self, texts: list[str]) -> tuple[Words, np.ndarray]:
        """The words of the texts and each one's probability of each language."""
        words = Words.of(texts)
        emission = _emission(words, words.features(self.lexicon), self.weights)
        return words, Sums(emission, words.sizes, np.exp(self.steps), np.exp(self.start)).marginals()


def _training_rows(docs: DataFrame, id_column: str, text: str, language: str, per_language: int) -> DataFrame:
    rows = docs.select(docs[id_column].alias("_id"), docs[language].cast("string").alias("_lang"), text_of(docs, text).alias("_text"))
    rows = rows.where("_id IS NOT NULL AND _lang IS NOT NULL").where(~held_out(F.col("_id")))
    # a language's share of hash values is chosen so that about four times as many rows as needed are left to be numbered
    sizes = stored(rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("_rows")), "languages")
    share = F.lit(4.0 * per_language * _HASHES) / F.col("_rows")
    near = rows.select("_id", "_lang").join(sizes, "_lang").where(F.pmod(F.xxhash64("_id"), F.lit(_HASHES)) <= share)
    order = Window.partitionBy("_lang").orderBy(F.pmod(F.xxhash64("_id"), F.lit(_HASHES)), "_id")
    chosen = near.select("_id", "_lang").distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language)
    # ids that several rows have are one training row
    found = rows.join(chosen.select("_id", "_lang"), ["_id", "_lang"]).groupBy("_id", "_lang").agg(F.min("_text").alias("_text"))
    training = stored(found, "training")
    drop_stored(sizes)
    return training


def _word_counts(training: DataFrame, at_most: int) -> list[str]:
    def words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text in frame["_text"]:
                yield pd.DataFrame({"word": sorted(set(_lowered(text, Words.of([text]))))}, dtype="string")

    counts = training.select("_text").mapInPandas(words, "word string").groupBy("word").count().where("count >= 3")
    return [row["word"] for row in counts.orderBy(F.desc("count"), "word").limit(at_most).collect()]


def _lowered(text: str, words: Words) -> Iterator[str]:
    """The words with letters as their hashes have them."""
    _, lower = _letters()
    for start, end in zip(words.start.tolist(), words.end.tolist(), strict=True):
        yield lower[np.frombuffer(text[start:end].encode("utf-32-le"), dtype=np.uint32)].tobytes().decode("utf-32-le")


def _windows(training: DataFrame, at_most: int) -> pd.DataFrame:
    """(lang, text): windows from the start and the middle of training texts."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc, lang, text in zip(frame["_id"].astype(str), frame["_lang"], frame["_text"], strict=True):
                words = Words.of([text])
                count = len(words.start)
                for at in dict.fromkeys((0, max(0, count // 2 - SPAN // 2))):
                    last = min(count, at + SPAN) - 1
                    if last >= at:
                        out.append((doc, at, lang, text[words.start[at]:words.end[last]]))
            yield pd.DataFrame(out, columns=["doc", "place", "lang", "text"])

    found = training.mapInPandas(cut, "doc string, place int, lang string, text string")
    return found.orderBy(F.xxhash64("doc", "place"), "doc", "place", "lang").limit(at_most).toPandas()


def _fit(windows: pd.DataFrame, languages: list[str], lexicon: np.ndarray) -> Model:
    """Gradient ascent (with momentum and scaling by past gradients) on the log-likelihood of spliced windows."""
    number = {name: i for i, name in enumerate(languages)}
    texts, states = list(windows["text"]), np.array([number[name] for name in windows["lang"]])
    words = Words.of(texts)
    pairs = words.features(lexicon)
    truth = states[words.doc]
    # windows are in the order of a hash, so neighbours are of any language
    sizes = np.add.reduceat(words.sizes, np.arange(0, len(texts), SPLICED))
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    count, features = len(languages), BUCKETS + len(lexicon)
    wanted = np.zeros((len(truth), count))
    wanted[np.arange(len(truth)), truth] = 1
    seen_steps = np.zeros((count, count))
    follows = np.setdiff1d(np.arange(len(truth)), first)
    np.add.at(seen_steps, (truth[follows - 1], truth[follows]), 1)
    parts = [np.zeros((count, features)), np.zeros((count, count)), np.zeros(count)]
    speed, power = [np.zeros_like(x) for x in parts], [np.zeros_like(x) for x in parts]
    for i in range(1, ROUNDS + 1):
        sums = Sums(_emission(words, pairs, parts[0]), sizes, np.exp(parts[1]), np.exp(parts[2]))
        off = wanted - sums.marginals()
        gradients = [
            np.stack([np.bincount(pairs[1], weights=column[pairs[0]], minlength=features) for column in off.T]),
            seen_steps - sums.expected_steps(), off[first].sum(axis=0),
        ]
        for k, gradient in enumerate(gradients):
            gradient = gradient / len(truth) - 1e-6 * parts[k]
            speed[k] = 0.9 * speed[k] + 0.1 * gradient
            power[k] = 0.99 * power[k] + 0.01 * gradient**2
            parts[k] += 0.1 * (speed[k] / (1 - 0.9**i)) / (np.sqrt(power[k] / (1 - 0.99**i)) + 1e-7)
    return Model(languages, lexicon, *parts)


def train(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", language: str = "lang", per_language: int = PER_LANGUAGE,
) -> Model | None:
    """The model, or none where there is nothing to learn from."""
    training = _training_rows(docs, id_column, text, language, per_language)
    try:
        windows = _windows(training, WINDOWS)
        if not len(windows):
            return None
        known = _word_counts(training, LEXICON)
        hashes = Words.of(known).hashes if known else np.empty(0, dtype=np.uint64)
        return _fit(windows, sorted(set(windows["lang"])), np.unique(hashes))
    finally:
        drop_stored(training)


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string()), ("score", pa.float64())])


def _runs(languages: list[str], start: np.ndarray, end: np.ndarray, chances: np.ndarray) -> list[dict]:
    """Runs of words of one language, with the mean probability of its words."""
    best = chances.argmax(axis=1)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(best)) + 1, [len(best)]))
    return [
        {"start": int(start[a]), "end": int(end[b - 1]), "lang": languages[best[a]], "score": float(chances[a:b, best[a]].mean())}
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) if b > a
    ]


def identify(
    docs: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text", spans: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, n_words; with `spans` also the runs of words of one language as
    (start and end character, lang, score)."""
    rows = docs.select(docs[id_column].alias("doc_id"), held_out(docs[id_column]).alias("held_out"), text_of(docs, text).alias("_text"))

    def predict(texts: list[str]) -> Iterator[tuple[str, float, int, list[dict]]]:
        if model is None:
            for text in texts:
                yield UNKNOWN, 0.0, len(Words.of([text]).doc), []
            return
        words, chances = model.label(texts)
        at = 0
        for size in words.sizes.tolist():
            if not size:
                yield UNKNOWN, 0.0, 0, []
                continue
            own = slice(at, at + size)
            at += size
            shares = chances[own].mean(axis=0)
            best = int(shares.argmax())
            found = _runs(model.languages, words.start[own], words.end[own], chances[own]) if spans else []
            yield model.languages[best], min(1.0, float(shares[best])), size, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            out = [row for some in text_slices(texts, 1_000_000) for row in predict(texts[some])]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            arrays = [pa.array(values, kind) for values, kind in zip(columns, (pa.string(), pa.float64(), pa.int64(), pa.list_(_SPAN)), strict=True)]
            names = ["lang_pred", "score", "n_words", "spans"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *arrays[:4 if spans else 3]], names=["doc_id", "held_out", *names[:4 if spans else 3]]
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    more = ", spans array<struct<start: bigint, end: bigint, lang: string, score: double>>" if spans else ""
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double, n_words long{more}")
