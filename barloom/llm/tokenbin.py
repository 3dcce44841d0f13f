"""Token ids in binary files, one wavelet matrix per shard.

Documents are range-partitioned and sorted by id; each task encodes its texts in that order and
closes a shard at the first document end after `SHARD_IDS` ids. A shard is one compressed file: the ids' planes with
their rank and select counts, a plane of bits with a one at each document's end id, and the documents' ids. Files are kept in a
Parquet table, one row each with the shard's numbers, so any store that Spark can write holds them and a task that is run again
replaces its own. Everything that is read, a document's bounds too, comes from the files alone.

Where documents start in the whole sequence follows from the lengths read, summed within
partitions and over partitions, of which there are as many as shuffle partitions.

Null text counts as empty: only the end id is written. Null ids come first, repeated ids stand in order of a
hash of their text. An empty table gives no shards and an empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.chunks import PATTERN, PLAIN, PartCache, array_slices, byte_letters, matches_of
from barloom.llm.common import stored, text_of
from barloom.llm.wavelet import BitPlane, WaveletMatrix

SHARD_IDS = 1 << 18
SLICE_BYTES = 16_000_000  # of texts encoded at once

_SPLIT = regex.compile(PATTERN).findall
_JOINS = re.compile(r" \S").match

SHARDS = "part int, shard int, file binary"
_SHARD_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("file", pa.binary())])

_HEAD = struct.Struct("<4sqQQQ")
_MAGIC = b"TKS1"


class ShardFile:
    """Ids of consecutive documents, where they end, and whose they are. Parts are inflated when asked for."""

    def __init__(self, matrix: WaveletMatrix, ends: BitPlane, names: bytes, end_id: int):
        self.matrix = matrix
        self.end_id = end_id
        self._ends = ends
        self._names = names

    @classmethod
    def of(cls, ids: np.ndarray, levels: int, doc_ids: list[int | None], sizes: list[int], end_id: int) -> ShardFile:
        ends = np.zeros(len(ids), dtype=bool)
        ends[np.cumsum(sizes) - 1] = True
        known = np.array([i is not None for i in doc_ids], dtype=bool)
        names = np.array([i or 0 for i in doc_ids], dtype="<i8").tobytes() + known.tobytes()
        return cls(WaveletMatrix.of(ids, levels), BitPlane.of(ends), zstandard.ZstdCompressor(level=1).compress(names), end_id)

    def to_bytes(self) -> bytes:
        parts = [self._names, self._ends.to_bytes(), self.matrix.to_bytes()]
        return b"".join((_HEAD.pack(_MAGIC, self.end_id, *map(len, parts)), *parts))

    @classmethod
    def from_bytes(cls, data: bytes) -> ShardFile:
        magic, end_id, *sizes = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        parts, at = [], _HEAD.size
        for size in sizes:
            parts.append(data[at:at + size])
            at += size
        return cls(WaveletMatrix.from_bytes(parts[2]), BitPlane.from_bytes(parts[1]), parts[0], end_id)

    @property
    def n_documents(self) -> int:
        return self._ends.length - self._ends.zeros

    def doc_ids(self) -> pa.Array:
        n = self.n_documents
        names = zstandard.ZstdDecompressor().decompress(self._names, max_output_size=9 * n)
        known = np.frombuffer(names, dtype=bool, offset=8 * n)
        return pa.array(np.frombuffer(names, dtype="<i8", count=n), pa.int64(), mask=~known)

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each document starts and where the next one does."""
        after = self._ends.places() + 1
        return np.concatenate((np.zeros(1, dtype=after.dtype), after[:-1])), after

    def span(self, nth: int) -> tuple[int, int]:
        """The bounds of the nth document (from 0)."""
        return (self._ends.place(1, nth - 1) + 1 if nth else 0), self._ends.place(1, nth) + 1

    def document_at(self, places: np.ndarray) -> np.ndarray:
        """Which document the id at each place belongs to (from 0)."""
        return self._ends.ones_each(places)

    def document(self, nth: int) -> np.ndarray:
        """The ids of the nth document, without unpacking the others."""
        start, end = self.span(nth)
        return self.matrix.access_each(np.arange(start, end))


class Vocabulary:
    """A tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # their strings in a text are ordinary text
        self._tokenizer.encode_special_tokens = True
        self.levels = max(1, (self._tokenizer.get_vocab_size() - 1).bit_length())
        self.kind = "<u2" if self.levels <= 16 else "<u4"
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        before, model = rules.get("pre_tokenizer") or {}, rules["model"]
        shown = byte_letters()
        # parts may be encoded alone only if texts are split by the byte-level pattern and by nothing else and not changed before,
        # and told apart by their bytes only if every byte is a token
        self._cuts = (
            rules.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex") is True
            and not before.get("add_prefix_space") and not any(rules.get(key) for key in ("truncation", "padding"))
            and all(token["special"] for token in rules.get("added_tokens") or [])
            and model.get("type", "BPE") == "BPE" and all(letter in model["vocab"] for letter in shown)
            and not any(model.get(key) for key in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        )
        if self._cuts:
            # the library's model alone, for matches in the letters of the byte level; 0xFF is in no text and stands between them
            self._model = Tokenizer(self._tokenizer.model)
            self._letters = np.array([*map(ord, shown[:255]), ord(" ")], dtype="<u4")
            tokens = self._tokenizer.get_vocab(with_added_tokens=True)
            self._lengths = np.zeros(max(tokens.values()) + 1, dtype=np.int64)
            self._lengths[list(tokens.values())] = list(map(len, tokens))
        self._cache = PartCache(self._encode_parts, self.kind, fine=True, size=96_000_000)

    def _packed(self, ids: list[int], sizes: Iterable[int]) -> list[bytes]:
        """Ids of pieces of so many bytes that no token lies across, piece by piece."""
        found = np.array(ids, dtype=self.kind)
        ends = np.cumsum(np.fromiter(sizes, dtype=np.int64))
        cuts = (np.searchsorted(np.cumsum(self._lengths[found]), ends, side="right") * found.itemsize).tolist()
        packed = found.tobytes()
        return [packed[start:end] for start, end in zip([0, *cuts], cuts, strict=False)]

    def _encode_plain(self, texts: list[str], sizes: Iterable[int]) -> list[bytes]:
        matches, _ = matches_of(texts, _SPLIT)
        letters = self._letters[np.frombuffer(b"\xff".join(map(str.encode, matches)), dtype=np.uint8)]
        words = letters.tobytes().decode("utf-32-le").split(" ")
        return self._packed(self._model.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, sizes)

    def _encode_parts(self, parts: list[bytes]) -> list[bytes]:
        """The library's ids of each part. Parts of characters that all Unicode versions agree on are split here, and the library's
        model encodes their matches; others go through the whole library, those put together that no match lies across."""
        out, plain, joined, alone = {}, {}, {}, {}
        for part in parts:
            text = part.decode()
            (plain if part.isascii() or PLAIN(text) else joined if _JOINS(text) else alone)[part] = text
        if plain:
            out.update(zip(plain, self._encode_plain(list(plain.values()), map(len, plain)), strict=True))
        if joined:
            found = self._tokenizer.encode_batch_fast(["".join(joined.values())], add_special_tokens=False)[0]
            out.update(zip(joined, self._packed(found.ids, map(len, joined)), strict=True))
        if alone:
            each = self._tokenizer.encode_batch_fast(list(alone.values()), add_special_tokens=False)
            out.update((part, np.array(found.ids, dtype=self.kind).tobytes()) for part, found in zip(alone, each, strict=True))
        return list(map(out.__getitem__, parts))

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each has."""
        if self._cuts:
            return self._cache.encode_array(texts)
        found = [x.ids for x in self._tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], dtype=self.kind), np.array(list(map(len, found)), dtype=np.int64)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        ids, sizes = self.encode_array(pa.array(texts, pa.large_string()))
        ends = np.cumsum(sizes)
        return [ids[start:end].tobytes() for start, end in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


_vocabularies: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def write_shards(
    docs: DataFrame, vocabulary: str, end_id: int, id_column: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """The shards, as a table in the shared folder. `vocabulary` is the path of a tokenizer file that every executor has."""
    body = text_of(docs, text)
    rows = docs.select(docs[id_column].cast("long").alias("_id"), body.alias("_text"), F.xxhash64(body).alias("_hash"))
    ordered = rows.repartitionByRange("_id", "_hash").sortWithinPartitions("_id", "_hash").select("_id", "_text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabulary(vocabulary)
        part, shard = TaskContext.get().partitionId(), 0
        names, sizes, packed, waiting = [], [], [], 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(packed)
            file = ShardFile.of(ids, words.levels, pa.chunked_array(names).to_pylist(), np.concatenate(sizes), end_id).to_bytes()
            return pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "file": file}], schema=_SHARD_ARROW)

        for batch in batches:
            for some in array_slices(batch.column("_text"), SLICE_BYTES):
                rows = batch.slice(some.start, some.stop - some.start)
                found, n_ids = words.encode_array(rows.column("_text"))
                found, n_ids = np.insert(found, np.cumsum(n_ids), end_id), n_ids + 1
                ends = np.cumsum(n_ids)
                first = done = 0
                while first < len(ends):
                    # up to the first document that fills the shard
                    stop = min(int(np.searchsorted(ends, done + shard_ids - waiting)) + 1, len(ends))
                    names.append(rows.column("_id").slice(first, stop - first))
                    sizes.append(n_ids[first:stop])
                    packed.append(found[done:ends[stop - 1]])
                    waiting += int(ends[stop - 1]) - done
                    first, done = stop, int(ends[stop - 1])
                    if waiting >= shard_ids:
                        yield close()
                        shard, waiting = shard + 1, 0
                        names, sizes, packed = [], [], []
        if names:
            yield close()

    return stored(ordered.mapInArrow(write, SHARDS), "shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """From the files: one row per document with doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of
    all its ids as little-endian unsigned 32-bit integers) and n_end_ids (how often the end id occurs in it)."""
    schema = "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long, n_end_ids long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, data in zip(*batch.columns, strict=True):
                file = ShardFile.from_bytes(data.as_py())
                starts, ends = file.bounds()
                ids = file.matrix.ids().astype("<u4")
                sums = [zlib.crc32(ids[start:end]) for start, end in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part.as_py(), dtype=np.int32)), pa.array(np.full(n, shard.as_py(), dtype=np.int32)),
                     file.doc_ids(), pa.array(starts, pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(sums, pa.int64()),
                     pa.array(file.matrix.count_each(file.end_id, starts, ends), pa.int64())],
                    names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32", "n_end_ids"],
                )

    # read once: the sizes of the shards are sums over what was read
    found = stored(shards.select("part", "shard", "file").mapInArrow(read, schema), "read")
    return found.join(_starts(found), ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "n_end_ids"
    )


def _starts(found: DataFrame) -> DataFrame:
    """(part, shard, base): ids of all shards before."""
    sizes = found.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return placed.join(parts, "part").select("part", "shard", (F.col("earlier") + F.col("inside")).alias("base"))


def count_tokens(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """(part, shard, token, n) for the given tokens, from the planes, without unpacking the ids."""
    arrow = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("token", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, data in zip(*batch.columns, strict=True):
                matrix = ShardFile.from_bytes(data.as_py()).matrix
                yield pa.RecordBatch.from_pylist([
                    {"part": part.as_py(), "shard": shard.as_py(), "token": token, "n": matrix.count(token)} for token in tokens
                ], schema=arrow)

    return shards.select("part", "shard", "file").mapInArrow(count, "part int, shard int, token int, n long")


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """(doc_id, place) of every occurrence of a token; place counts ids of the document from 0."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("file"):
                file = ShardFile.from_bytes(data.as_py())
                places = np.array(file.matrix.places(token), dtype=np.int64)
                if len(places):
                    docs = file.document_at(places)
                    yield pa.RecordBatch.from_arrays(
                        [file.doc_ids().take(pa.array(docs)), pa.array(places - file.bounds()[0][docs])], names=["doc_id", "place"]
                    )

    return shards.select("file").mapInArrow(find, "doc_id long, place long")


def read_document(shards: DataFrame, doc_id: int) -> DataFrame:
    """(doc_id, ids) of the documents of one id, by access to their places alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("file"):
                file = ShardFile.from_bytes(data.as_py())
                for nth, name in enumerate(file.doc_ids().to_pylist()):
                    if name == doc_id:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name], pa.int64()), pa.array([file.document(nth)], pa.list_(pa.int64()))], names=["doc_id", "ids"]
                        )

    return shards.select("file").mapInArrow(read, "doc_id long, ids array<bigint>")
