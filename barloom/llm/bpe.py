"""Byte-level BPE by prefix dynamic programming.

An encoding is right exactly if each two neighbouring tokens are: their bytes together encode to
just these two. So every prefix of the bytes has one valid last token, which is found from the
prefixes before it: a token that ends here, starts the bytes or fits the last token of the prefix before it.
The table of last tokens gives the encoding of every prefix, goes on from where it is when bytes
are appended, and after an edit is computed anew only until it agrees with the old one again.

The table works on one match of the pattern that splits texts. Texts are cut into parts no token
crosses, and equal parts are encoded once per worker.

Null text counts as empty and has no ids. Null ids in a list to decode are skipped. Repeated
rows are encoded each. An empty table gives an empty result. Other columns of the input are kept if wanted, as struct `_row`.
"""

from __future__ import annotations

import base64
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.chunks import PATTERN, PartCache, Recent, array_slices, matches_of
from barloom.llm.common import as_rows, text_of

# pairs whose fit is kept per worker
PAIRS = 400_000
# matches whose ids are kept per worker, twice
PIECES = 50_000
TEXTS_AT_ONCE = 256


class Ranks:
    """A vocabulary of byte strings with their ranks, which are also the ids. As from any
    training, a token has a higher rank than the two it is merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        # every end of a token, with the token it is or -1
        self.ends: dict[bytes, int] = {}
        for token, rank in ranks.items():
            for start in range(1, len(token)):
                self.ends.setdefault(token[start:], -1)
            self.ends[token] = rank
        # by left * 2**32 + right
        self.known_pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, ...]] = {}

    @classmethod
    def read(cls, path: str) -> Ranks:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            return cls({base64.b64decode(pair[0]): int(pair[1]) for pair in pairs if pair})

    def merged(self, data: bytes, below: float = math.inf) -> list[int]:
        """The definition: merge the neighbours of lowest rank until none can be; only ranks `below` count."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, math.inf) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(found)
            if best >= below or best == math.inf:
                break
            at = found.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def halves(self, token: int) -> tuple[int, ...]:
        """The tokens whose merge makes this one; empty for a byte. More than two for a token that merging
        never reaches."""
        known = self._halves.get(token)
        if known is None:
            data = self.bytes_of[token]
            known = self._halves[token] = tuple(self.merged(data, token)) if len(data) > 1 else ()
        return known

    def stands(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        return len(self.halves(token)) in (0, 2)

    def fits(self, left: int, right: int) -> bool:
        """Whether the two stay as they are side by side."""
        known = self.known_pairs.get(left << 32 | right)
        if known is None:
            if len(self.known_pairs) >= PAIRS:
                self.known_pairs.clear()
            known = self.known_pairs[left << 32 | right] = self.stands(right) and self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Goes back in time from the two tokens: which tokens met at the border, and when did the
        left and the right one go into a larger one? They would have merged if their rank was
        due before that; of equal ranks the one further left comes first."""
        left_until = right_until = math.inf
        while True:
            together = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if together is not None and together < left_until and together <= right_until:
                return False
            from_left, from_right = self.halves(left), self.halves(right)
            if not from_left and not from_right:
                return True
            # undo the later merge; of equal ones the right
            if from_left and (not from_right or left > right):
                left_until, left = left, from_left[1]
            else:
                right_until, right = right, from_right[0]


class PrefixTable:
    """The last token of every prefix of some bytes."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks = ranks
        self.data = b""
        self.last: list[int] = [-1]
        self.append(data)

    def _last_tokens(self, data: bytes, first: int, stop: int) -> Iterator[int]:
        """For each end from first to before stop: of the tokens that end there, the one that starts the bytes or fits what
        comes before. Each is in `last` before the next is asked for."""
        ranks, last, ends, known = self.ranks, self.last, self.ranks.ends.get, self.ranks.known_pairs.get
        for end in range(first, stop):
            for start in range(end - 1, -1, -1):
                token = ends(data[start:end])
                if token is None:
                    raise ValueError("the vocabulary lacks a byte")
                if token < 0:
                    continue
                if start:
                    fits = known(last[start] << 32 | token)
                    if fits is None:
                        fits = ranks.fits(last[start], token)
                else:
                    fits = ranks.stands(token)
                if fits:
                    yield token
                    break

    def append(self, more: bytes) -> None:
        """Goes on after what is there; no prefix changes."""
        data = self.data = self.data + more
        add = self.last.append
        for token in self._last_tokens(data, len(self.last), len(data) + 1):
            add(token)

    def shrink(self, length: int) -> None:
        """Keep the first bytes only."""
        self.data = self.data[:length]
        del self.last[length + 1:]

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put `new` in place of the bytes from start to end; returns how many prefixes were computed anew.
        A prefix depends on the `longest` bytes before it and the last tokens there; once these
        are as before for so many prefixes in a row, so is all that follows."""
        data = self.data[:start] + new + self.data[end:]
        old, shift = self.last, len(new) - (end - start)
        self.data, self.last = data, old[:start + 1]
        same = done = 0
        for token in self._last_tokens(data, len(self.last), len(data) + 1):
            at = len(self.last)
            self.last.append(token)
            done += 1
            same = same + 1 if at >= start + len(new) and token == old[at - shift] else 0
            if same >= self.ranks.longest:
                self.last += old[at + 1 - shift:]
                break
        return done

    def tokens(self, length: int | None = None) -> list[int]:
        """The encoding of the whole, or of a prefix."""
        out, end = [], len(self.data) if length is None else length
        while end:
            out.append(self.last[end])
            end -= len(self.ranks.bytes_of[self.last[end]])
        return out[::-1]


class Encoder:
    """Encodes texts, one match of the pattern after the other."""

    def __init__(self, ranks: Ranks, pattern: str = PATTERN):
        self.ranks = ranks
        self._split = regex.compile(pattern).findall
        self._pieces = Recent(PIECES)
        self._known_pattern = pattern == PATTERN
        self._cache = PartCache(self._parts, "<i4", fine=self._known_pattern)

    def pieces(self, matches: set[str]) -> dict[str, bytes]:
        """Packed ids of the matches. In order of their bytes, each goes on from the prefix it shares with the one before."""
        known = self._pieces.age()
        missing = self._pieces.missing(matches)
        table, ranks = PrefixTable(self.ranks), self.ranks.ranks
        for data, match in sorted((match.encode(), match) for match in missing):
            token = ranks.get(data)
            if token is not None:
                # a match that is a token as a whole is that token
                known[match] = token.to_bytes(4, "little")
                continue
            before, shared = table.data, 0
            for a, b in zip(before, data, strict=False):
                if a != b:
                    break
                shared += 1
            table.shrink(shared)
            table.append(data[shared:])
            known[match] = array("i", table.tokens()).tobytes()
        return known

    def _parts(self, parts: list[bytes]) -> list[bytes]:
        texts = [part.decode() for part in parts]
        if self._known_pattern:
            matches, cuts = matches_of(texts, self._split)
        else:
            split = [self._split(text) for text in texts]
            matches, cuts = [match for some in split for match in some], np.cumsum(list(map(len, split))).tolist()
        known = self.pieces(set(matches))
        ids = list(map(known.__getitem__, matches))
        return [
            ids[start] if end - start == 1 else b"".join(ids[start:end]) for start, end in zip([0, *cuts], cuts, strict=False)
        ]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each has."""
        return self._cache.encode_array(texts)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        return self._cache.encode_all(texts)


_encoders: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    """One per worker, vocabulary and pattern."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(Ranks.read(path), pattern)
    return _encoders[path, pattern]


class Decoder:
    """Bytes of ids, many at a time."""

    def __init__(self, ranks: Ranks):
        self._table = pa.array([ranks.bytes_of.get(i, b"") for i in range(max(ranks.bytes_of) + 1)], pa.large_binary())

    def decode_array(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The bytes of consecutive lists of so many ids."""
        _, ends, values = self._table.take(pa.array(ids)).buffers()
        at = np.frombuffer(ends, dtype=np.int64)[np.concatenate(([0], np.cumsum(sizes)))] if len(ids) else np.zeros(len(sizes) + 1)
        return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int64)), values]).cast(pa.binary())

    def decode(self, ids: np.ndarray) -> bytes:
        return self.decode_array(ids, np.array([len(ids)]))[0].as_py()


def encode(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", pattern: str = PATTERN, keep_rows: bool = False,
    decoded: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, ids (array of int); with `keep_rows` also `_row`, with `decoded` the bytes that the ids
    stand for, from the same pass. `vocabulary` is the path of a rank file, which every executor has."""
    rows = as_rows(docs, {"doc_id": docs[id_column], "_text": text_of(docs, text)})
    rows = rows if keep_rows else rows.drop("_row")
    kept = [field for field in rows.schema.fields if field.name != "_text"]
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    if decoded:
        added.append(T.StructField("decoded", T.BinaryType(), False))
    schema = T.StructType([*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, pattern)
        decoder = Decoder(encoder.ranks) if decoded else None
        for batch in batches:
            # some texts at a time bounds the parts held at once
            for part in array_slices(batch.column("_text")):
                some = batch.slice(part.start, part.stop - part.start)
                ids, sizes = encoder.encode_array(some.column("_text"))
                ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                columns = [*(some.column(field.name) for field in kept), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32()))]
                if decoder:
                    columns.append(decoder.decode_array(ids, sizes))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for; a null list has none."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_encoder(vocabulary, PATTERN).ranks)
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(start, TEXTS_AT_ONCE)
                texts = [
                    decoder.decode(listed.values.drop_null().to_numpy()) if listed.is_valid else b"" for listed in some.column(ids)
                ]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(texts, pa.binary())], names=schema.fieldNames())

    return encoded.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of the documents' ids and of what they decode to."""
    found = encode(docs, vocabulary, decoded=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
