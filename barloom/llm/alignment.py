"""How the tokens of two tokenizers stand to each other, over all documents.

1. Documents are grouped by their full text, with their number of copies.
2. Each distinct text is encoded by both tokenizers once. Byte offsets where tokens of both end cut them into
   groups; the last tokens of a group end together and are linked. Texts are worked on in slabs of about `SLAB`
   characters: a slab keeps its distinct id pairs, how often its documents hold each (texts weighted by their
   copies), and per text the pairs as numbers within the slab.
3. The pair counts of all slabs are summed, and the highest count of each id of B is found. The counts go back to
   the slabs that have the pair, so a pair crosses the shuffle once per slab, not once per text.
4. Measures of the texts are joined to the ids of all documents.

A is a byte-level BPE vocabulary, which gets a space before the text; B is a sentencepiece vocabulary, which adds one
itself. Their special tokens in a text are ordinary text. No token of either is empty, so tokens
that end together are one of each. Texts that are null or empty, or that either side does not give back byte by
byte, have no tokens: zeros and ''. Repeated rows and null ids are rows like others. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.chunks import byte_letters, text_slices
from barloom.llm.common import drop_stored, stored, text_of

SLAB = 8_000_000
_PAIR = 1 << 32  # a pair is a * _PAIR + b

MEASURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_level() -> dict[str, int]:
    return {letter: value for value, letter in enumerate(byte_letters())}


class ByteVocabulary:
    """A byte-level BPE file of the tokenizers library: ids of texts, and the bytes of an id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, place = rules["model"], _byte_level()
        known = {token: value for token, value in model["vocab"].items() if all(letter in place for letter in token)}
        ranks = {bytes(place[letter] for letter in token): value for token, value in known.items()}
        self.entries: list[bytes] = [b""] * (max(self._tokenizer.get_vocab(with_added_tokens=True).values()) + 1)
        for token, value in ranks.items():
            self.entries[value] = token
        self._library = self._same_by_ranks(rules, ranks)

    def _same_by_ranks(self, rules: dict, ranks: dict[bytes, int]):
        """tiktoken's encoding with the file's ranks, which is faster, if the file says nothing but that its merges are to be
        taken in the order of the ids they give. It was compared with the tokenizers library over all code points."""
        model, before = rules["model"], rules.get("pre_tokenizer") or {}
        plain = (
            rules.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex") is True
            and not before.get("add_prefix_space") and not model.get("ignore_merges") and not model.get("dropout")
        )
        merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        made = [model["vocab"].get(left + right, -1) for left, right in merges]
        if not plain or len(ranks) != 256 + len(made) or any(a >= b for a, b in pairwise(made)) or (made and made[0] < 256):
            return None
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self._library is None:
            found = (x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False))
        else:
            found = map(self._library.encode_ordinary, texts)
        return [np.array(ids, dtype=np.int32) for ids in found]


class PieceVocabulary:
    """A sentencepiece file: ids of texts, and the bytes of an id."""

    def __init__(self, path: str):
        import sentencepiece

        self._processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = [self._bytes(i) for i in range(self._processor.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self._processor.id_to_piece(number)
        value = _BYTE_PIECE.fullmatch(piece)
        return bytes([int(value[1], 16)]) if value else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for some in text_slices(texts, 1_000_000):
            out += [np.array(ids, dtype=np.int32) for ids in self._processor.encode(texts[some], num_threads=1)]
        return out


_loaded: dict[tuple[type, str], ByteVocabulary | PieceVocabulary] = {}


def _load(kind: type, path: str):
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


def _ends(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths[ids], dtype=np.int64)


class Aligner:
    """Both vocabularies, and what is looked up in them by id."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = _load(ByteVocabulary, a_path), _load(PieceVocabulary, b_path)
        self._lengths = [np.array([len(x) for x in side.entries], dtype=np.int64) for side in (self.a, self.b)]
        # an id of either side within or at the end of its part of a group, as text
        self._shown = [
            f"{i}{mark}" for n, marks in ((len(self.a.entries), ",|"), (len(self.b.entries), ",;")) for mark in marks for i in range(n)
        ]

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of each text on both sides, none where one does not give back the text."""
        spaced = [" " + text for text in texts]
        none = np.empty(0, dtype=np.int32)
        for text, a, b in zip(spaced, self.a.encode(spaced), self.b.encode(texts), strict=True):
            raw = text.encode()
            same = len(raw) > 1 and all(
                b"".join(map(side.entries.__getitem__, ids.tolist())) == raw for side, ids in ((self.a, a), (self.b, b))
            )
            yield (a, b) if same else (none, none)

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a and in b of the last tokens of all groups."""
        a_ends, b_ends = _ends(a, self._lengths[0]), _ends(b, self._lengths[1])
        at = np.searchsorted(b_ends, a_ends)
        last_a = np.flatnonzero(b_ends[np.minimum(at, max(0, len(b) - 1))] == a_ends) if len(b) else np.empty(0, dtype=np.int64)
        return last_a, at[last_a]

    def text_of_groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """a1,a2|b1;a3|b2,b3"""
        if not len(a):
            return ""
        n_a, n_b = len(self.a.entries), len(self.b.entries)
        out = np.empty(len(a) + len(b), dtype=np.int64)
        # before a token of a stand those of b in earlier groups, before one of b those of a in its own too
        group_a = np.searchsorted(last_a, np.arange(len(a)))
        group_b = np.searchsorted(last_b, np.arange(len(b)))
        before_a = np.concatenate(([0], last_b + 1))[group_a]
        before_b = (last_a + 1)[group_b]
        code_a, code_b = a.astype(np.int64), 2 * n_a + b
        code_a[last_a] += n_a
        code_b[last_b] += n_b
        out[np.arange(len(a)) + before_a] = code_a
        out[np.arange(len(b)) + before_b] = code_b
        return "".join(map(self._shown.__getitem__, out.tolist()))[:-1]


_SLABS = pa.schema([
    ("_key", pa.list_(pa.binary())), ("_n_a", pa.list_(pa.int64())), ("_n_b", pa.list_(pa.int64())), ("_n_links", pa.list_(pa.int64())),
    ("_sha", pa.list_(pa.string())), ("_pair", pa.list_(pa.int64())), ("_held", pa.list_(pa.int64())),
    ("_ends", pa.list_(pa.int64())), ("_at", pa.list_(pa.int32())), ("_times", pa.list_(pa.int32())),
])
_SLAB_COLUMNS = (
    "_key array<binary>, _n_a array<bigint>, _n_b array<bigint>, _n_links array<bigint>, _sha array<string>, "
    "_pair array<bigint>, _held array<bigint>, _ends array<bigint>, _at array<int>, _times array<int>"
)


def _slab(aligner: Aligner, keys: list[bytes], texts: list[str], copies: list[int]) -> pa.RecordBatch:
    """Measures of some texts, their distinct pairs, how often documents hold each, and per text its pairs and their
    times: _at and _times up to the text's end in _ends."""
    n_a, n_b, n_links, shas, linked, times = [], [], [], [], [], []
    for a, b in aligner.encode(texts):
        last_a, last_b = aligner.groups(a, b)
        pairs, number = np.unique(a[last_a].astype(np.int64) * _PAIR + b[last_b], return_counts=True)
        n_a.append(len(a))
        n_b.append(len(b))
        n_links.append(len(last_a))
        shas.append(hashlib.sha256(aligner.text_of_groups(a, b, last_a, last_b).encode()).hexdigest() if len(a) else "")
        linked.append(pairs)
        times.append(number)
    sizes = np.array([len(x) for x in linked], dtype=np.int64)
    distinct, at = np.unique(np.concatenate(linked), return_inverse=True)
    flat = np.concatenate(times)
    held = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(held, at, flat * np.repeat(np.array(copies, dtype=np.int64), sizes))
    values = (keys, n_a, n_b, n_links, shas, distinct, held, np.cumsum(sizes), at.astype(np.int32), flat.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array([value], field.type) for value, field in zip(values, _SLABS, strict=True)], schema=_SLABS
    )


def _aligned(texts: DataFrame, a_path: str, b_path: str, slab: int) -> DataFrame:
    """One row per slab of the distinct texts (_key, _text, _copies)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        keys, waiting, copies, held = [], [], [], 0
        for batch in batches:
            aligner = aligner or Aligner(a_path, b_path)
            for key, text, n in zip(*(batch.column(name).to_pylist() for name in ("_key", "_text", "_copies")), strict=True):
                keys.append(key)
                waiting.append(text)
                copies.append(n)
                held += len(text)
                if held >= slab:
                    yield _slab(aligner, keys, waiting, copies)
                    keys, waiting, copies, held = [], [], [], 0
        if waiting:
            yield _slab(aligner, keys, waiting, copies)

    return texts.mapInArrow(run, _SLAB_COLUMNS).withColumn("_slab", F.monotonically_increasing_id())


def pair_counts(slabs: DataFrame) -> DataFrame:
    """(_pair, _count, _best): links of each id pair over all documents, and whether no pair with its id of B has more."""
    held = slabs.select(F.explode(F.arrays_zip("_pair", "_held")).alias("_x")).select("_x._pair", "_x._held")
    # written, so that joins with it can be split at a hot key
    counts = stored(held.groupBy("_pair").agg(F.sum("_held").alias("_count")), "pairs")
    # at most one row per id of B
    best = stored(counts.groupBy(_b_id(F.col("_pair")).alias("_b")).agg(F.max("_count").alias("_top")), "best")
    found = stored(
        counts.join(best, _b_id(counts["_pair"]) == best["_b"]).select("_pair", "_count", (F.col("_count") == F.col("_top")).alias("_best")),
        "pairs",
    )
    drop_stored(counts, best)
    return found


def _b_id(pair: Column) -> Column:
    return pair % _PAIR


def _measured(slabs: DataFrame, counts: DataFrame) -> DataFrame:
    """Measures of each distinct text."""
    needed = slabs.select("_slab", F.posexplode("_pair").alias("_at", "_pair"))
    # a list has the distinct pairs of one slab
    listed = needed.join(counts, "_pair").groupBy("_slab").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_count", "_best"))).alias("_x")
    ).select("_slab", F.col("_x._count").alias("_counts"), F.col("_x._best").alias("_bests"))
    both = slabs.select("_slab", "_key", "_n_a", "_n_b", "_n_links", "_sha", "_ends", F.col("_at").alias("_ats"), "_times").join(
        listed, "_slab", "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                n_links = row["_n_links"].values
                ends = np.concatenate(([0], row["_ends"].values.to_numpy()))
                at, times = row["_ats"].values.to_numpy(), row["_times"].values.to_numpy().astype(np.int64)
                sums = []
                for name in ("_bests", "_counts"):
                    looked_up = (
                        row[name].values.to_numpy(zero_copy_only=False).astype(np.int64)[at] * times if len(at) else np.empty(0, dtype=np.int64)
                    )
                    running = np.concatenate(([0], np.cumsum(looked_up)))
                    sums.append(pa.array(running[ends[1:]] - running[ends[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [row["_key"].values, row["_n_a"].values, row["_n_b"].values, n_links, n_links, *sums, row["_sha"].values],
                    names=["_key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    return both.mapInArrow(run, f"_key binary, {MEASURES}")


def align(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text", slab: int = SLAB,
) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their id of
    B), count_sum (of the counts of all links), groups_sha256. The
    vocabularies are files that every executor has."""
    body = text_of(docs, text)
    key = F.unhex(F.sha2(body.cast("binary"), 256))
    texts = docs.select(body.alias("_text")).where("_text <> ''").groupBy("_text").agg(F.count(F.lit(1)).alias("_copies"))
    texts = texts.select(F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_key"), "_text", "_copies")
    slabs = stored(_aligned(texts, a_path, b_path, slab), "slabs")
    counts = pair_counts(slabs)
    measures = stored(_measured(slabs, counts), "measures")
    drop_stored(slabs, counts)
    names = [field.split(" ")[0] for field in MEASURES.split(", ")]
    rows = docs.select(docs[id_column].alias("doc_id"), F.when(body != "", key).alias("_key"))
    found = rows.join(measures, "_key", "left").drop("_key")
    return found.select("doc_id", *[F.coalesce(name, F.lit("" if name == "groups_sha256" else 0)).alias(name) for name in names])


def pairs_of(docs: DataFrame, a_path: str, b_path: str, text: str = "text", slab: int = SLAB) -> DataFrame:
    """The linked id pairs over all documents: (a_id, b_id, count, best)."""
    texts = docs.select(text_of(docs, text).alias("_text")).where("_text <> ''").groupBy("_text").agg(F.count(F.lit(1)).alias("_copies"))
    slabs = stored(_aligned(texts.withColumn("_key", F.lit(b"")), a_path, b_path, slab), "slabs")
    counts = pair_counts(slabs)
    drop_stored(slabs)
    return counts.select(
        F.expr(f"_pair div {_PAIR}").alias("a_id"), _b_id(F.col("_pair")).alias("b_id"), F.col("_count").alias("count"), F.col("_best").alias("best")
    )
