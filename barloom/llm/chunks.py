"""Cuts texts where no token can lie across, so that what stands between cuts is encoded once.

The pattern that splits text before byte-level BPE lets a match begin at a space that stands
before other text, and none go on past one. So a text may be cut before every space with
a character other than white space after it.

A byte-level pattern that keeps letters, digits and the rest in matches of their own (`PATTERN`) allows
more cuts: where one of these follows another, except after an apostrophe, which may begin "'s", and around a single line end.
These are looked for among ASCII and Latin letters only, whose classes all versions of Unicode agree on.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?!\S)")
# the splitting pattern of byte-level BPE
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# characters to U+024F have had their classes since long before any version of Unicode in use
PLAIN = re.compile("[\\x00-\u024f]*").fullmatch

# what \S leaves out, in UTF-8
_WHITE = [chr(code).encode() for code in range(0x3001) if chr(code).isspace()]
_WHITE_BYTE = np.isin(np.arange(256), [white[0] for white in _WHITE if len(white) == 1])
_WHITE_LEAD = np.isin(np.arange(256), [white[0] for white in _WHITE if len(white) > 1])
_WHITE_CODES = np.array([int.from_bytes(white.ljust(3, b"\0"), "big") for white in _WHITE if len(white) > 1])


def byte_letters() -> list[str]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary: printable ones for themselves, the
    others, in order, for those from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(value if value in shown else next(hidden)) for value in range(256)]


def parts_of(text: str) -> list[str]:
    """What stands between the cuts; all but the first have lost the space before them."""
    # without a space before white space or at the end, every space is a cut
    return text.split(" ") if _ODD.search(text) is None else _CUT.split(text)


_LETTER, _DIGIT, _SIGN, _APOSTROPHE, _LINE = range(1, 6)


def _classes() -> np.ndarray:
    known = np.zeros(256, dtype=np.uint8)
    for value in range(33, 127):
        letter = chr(value)
        known[value] = _LETTER if letter.isalpha() else _DIGIT if letter.isdigit() else _SIGN
    known[ord("'")], known[ord("\n")] = _APOSTROPHE, _LINE
    return known


_CLASS = _classes()
# a match ends between the first and the second; what is not listed may be one match
_BORDER = np.zeros((8, 8), dtype=bool)
_BORDER[_LETTER, [_DIGIT, _SIGN, _APOSTROPHE, _LINE]] = True
_BORDER[_DIGIT, [_LETTER, _SIGN, _APOSTROPHE, _LINE]] = True
_BORDER[_SIGN, [_LETTER, _DIGIT, _LINE]] = True
_BORDER[_APOSTROPHE, [_DIGIT, _LINE]] = True


def _borders(body: np.ndarray) -> np.ndarray:
    """Whether a match is sure to begin at each byte, from the bytes before."""
    known = _CLASS[body]
    # the second byte of the letters from U+00C0 to U+024F; the signs of multiplication and division are none
    leads = np.flatnonzero((body[:-1] >= 0xC3) & (body[:-1] <= 0xC8))
    second = body[leads + 1]
    known[leads[(body[leads] != 0xC3) | ((second != 0x97) & (second != 0xB7))] + 1] = _LETTER
    found = np.zeros(len(body), dtype=bool)
    pairs = known[:-1] << 3
    pairs |= known[1:]
    np.take(_BORDER.ravel(), pairs, out=found[1:], mode="clip")
    # a line end alone is a match: longer white space is split by what follows
    lines = np.flatnonzero(known[1:-1] == _LINE) + 1
    before, after = known[lines - 1], known[lines + 1]
    found[lines[(before > 0) & (before < _LINE) & (after > 0) & (after < _LINE)] + 1] = True
    return found


def cut_parts(texts: pa.Array, fine: bool = False) -> tuple[pa.Array, np.ndarray]:
    """`parts_of` over a text column without nulls: the parts of all texts, as bytes with the space before them, and how many each
    text has. An empty text has none. With `fine` also the cuts that only `PATTERN` allows."""
    texts = texts.cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    low, high = int(ends[0]), int(ends[-1])
    if low == high:
        return pa.array([], pa.large_binary()), np.zeros(len(texts), dtype=np.int64)
    body = np.frombuffer(values, dtype=np.uint8, count=high - low, offset=low)
    ends = ends - low
    spaces = np.flatnonzero(body[:-1] == 32)
    after = body[spaces + 1]
    white = _WHITE_BYTE[after]
    maybe = np.flatnonzero(_WHITE_LEAD[after])
    if len(maybe):
        at = spaces[maybe] + 1
        # lead bytes here are those of two or three bytes; only the first two count for C2
        second, third = (body[np.minimum(at + i, len(body) - 1)].astype(np.int64) for i in (1, 2))
        third[after[maybe] == 0xC2] = 0
        white[maybe] = np.isin(after[maybe].astype(np.int64) << 16 | second << 8 | third, _WHITE_CODES)
    cuts = _borders(body) if fine else np.zeros(len(body), dtype=bool)
    cuts[spaces[~white]] = True
    filled = ends[1:] > ends[:-1]
    # a space that ends a text has nothing after it
    last = ends[1:][filled] - 1
    cuts[last[body[last] == 32]] = False
    cuts[ends[:-1][filled]] = True
    del spaces, after, white
    bounds = np.flatnonzero(np.append(cuts, True))
    parts = pa.Array.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), values.slice(low, high - low)]
    )
    return parts, np.diff(np.searchsorted(bounds, ends))


def _slices(sizes: Iterable[int], most: int) -> Iterator[slice]:
    start, total, i = 0, 0, -1
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start <= i:
        yield slice(start, i + 1)


def text_slices(texts: list[str], characters: int = 1_000_000) -> Iterator[slice]:
    """Slices of consecutive texts with about so many characters; a longer text is a slice of its own."""
    return _slices(map(len, texts), characters)


def array_slices(texts: pa.Array, size: int = 1_000_000) -> Iterator[slice]:
    """Slices of consecutive texts with about so many bytes; a longer text is a slice of its own."""
    return _slices(pc.binary_length(texts).to_pylist(), size)


# what an entry of a dictionary takes besides the letters and bytes of its key and value
_ENTRY = 190


class Recent:
    """A dictionary of what was asked for lately: two generations of `entries` each, and of about `size` bytes if that is stated."""

    def __init__(self, entries: int, size: int | None = None):
        self._entries = entries
        self._size = size
        self.new: dict = {}
        self._old: dict = {}
        self._seen = self._letters = 0

    def age(self) -> dict:
        """Start a generation if the present one is full. Returns the present one."""
        added = len(self.new) - self._seen
        if added and self._size is not None:
            # some of the newest entries stand for all that came since the last look
            some = list(islice(reversed(self.new.items()), min(added, 1_000)))
            self._letters += added * sum(len(key) + len(value) for key, value in some) // len(some)
            self._seen += added
        full = self._size is not None and self._letters + self._seen * _ENTRY > self._size
        if full or len(self.new) > self._entries:
            self._old, self.new = self.new, {}
            self._seen = self._letters = 0
        return self.new

    def missing(self, keys: set) -> list:
        """Those keys that neither generation has; what the older one has is taken over."""
        new, old = self.new, self._old
        out = []
        for key in keys.difference(new):
            value = old.get(key)
            if value is None:
                out.append(key)
            else:
                new[key] = value
        return out


class PartCache:
    """Token ids of parts; equal parts are encoded once as long as they are asked for. Both generations together hold
    about twice `size` bytes, as workers live on and keep them."""

    def __init__(
        self, encode: Callable[[list[bytes]], list[bytes]], kind: str, fine: bool, entries: int = 600_000, size: int = 12_000_000,
    ):
        # packed ids of parts
        self._encode = encode
        self._fine = fine
        # of numpy: an id
        self._kind = np.dtype(kind)
        self._known = Recent(entries, size)

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and how many each has."""
        parts, n_parts = cut_parts(texts, self._fine)
        numbered = parts.dictionary_encode()
        del parts
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self._known.age()
        packed = list(map(known.get, distinct))
        unknown = [i for i, ids in enumerate(packed) if ids is None]
        missing = self._known.missing({distinct[i] for i in unknown})
        if missing:
            known.update(zip(missing, self._encode(missing), strict=True))
        for i in unknown:
            packed[i] = known[distinct[i]]
        ids = np.frombuffer(b"".join(packed), dtype=self._kind)
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // self._kind.itemsize
        by_part = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes)))), pa.array(ids)).take(numbered.indices)
        ends = by_part.offsets.to_numpy()
        return by_part.flatten().to_numpy(), np.diff(ends[np.concatenate(([0], np.cumsum(n_parts)))])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed."""
        ids, sizes = self.encode_array(pa.array(texts, pa.large_string()))
        ends = np.cumsum(sizes)
        return [ids[start:end].tobytes() for start, end in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]


def matches_of(texts: list[str], findall: Callable[[str], list[str]]) -> tuple[list[str], list[int]]:
    """The matches of `PATTERN` in all texts, one text after the other, and where each text's end."""
    matches, ends = [], []
    for text in texts:
        # letters, with or without a space before them, are one match
        if text[text[0] == " ":].isalpha() and (text.isascii() or PLAIN(text)):
            matches.append(text)
        else:
            matches += findall(text)
        ends.append(len(matches))
    return matches, ends
