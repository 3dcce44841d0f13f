"""A wavelet matrix: a sequence of ids as planes of bits, the highest first. After each plane the
ids with a 0 there stand before those with a 1, in the order they had. With counts of ones before
each block of bits, an id, the number of times a token occurs and its places are found in time that
grows with the planes, without unpacking the sequence. In a file each plane is compressed apart and inflated when first asked for.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from functools import cached_property

import numpy as np
import zstandard

BLOCK = 512  # bits whose ones are counted together
_HEAD = struct.Struct("<4sBQ")
_PLANE_HEAD = struct.Struct("<QQ")
_MAGIC = b"WMX2"


class BitPlane:
    """A sequence of bits with rank (`ones`) and select (`place`)."""

    def __init__(self, length: int, zeros: int, load: Callable[[], tuple[np.ndarray, np.ndarray]]):
        self.length = length
        self.zeros = zeros
        self._load = load

    @cached_property
    def _arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self._load()

    @property
    def bits(self) -> np.ndarray:
        """Packed, low bit first, whole blocks."""
        return self._arrays[0]

    @property
    def before(self) -> np.ndarray:
        """Ones before each block."""
        return self._arrays[1]

    @staticmethod
    def _blocks(length: int) -> int:
        return -(-(length + 1) // BLOCK)

    @classmethod
    def of(cls, flags: np.ndarray) -> BitPlane:
        packed = np.packbits(flags, bitorder="little")
        padded = np.zeros(cls._blocks(len(flags)) * (BLOCK // 8), dtype=np.uint8)
        padded[: len(packed)] = packed
        counts = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        before = np.cumsum(counts, dtype=np.uint32) - counts
        return cls(len(flags), len(flags) - int(counts.sum()), lambda: (padded, before))

    def to_bytes(self) -> bytes:
        body = zstandard.ZstdCompressor(level=1).compress(self.bits.tobytes() + self.before.astype("<u4").tobytes())
        return _PLANE_HEAD.pack(self.length, self.zeros) + body

    @classmethod
    def from_bytes(cls, data: bytes) -> BitPlane:
        length, zeros = _PLANE_HEAD.unpack_from(data)
        blocks = cls._blocks(length)
        size = blocks * (BLOCK // 8)

        def load() -> tuple[np.ndarray, np.ndarray]:
            body = zstandard.ZstdDecompressor().decompress(data[_PLANE_HEAD.size:], max_output_size=size + 4 * blocks)
            return np.frombuffer(body, dtype=np.uint8, count=size), np.frombuffer(body, dtype="<u4", count=blocks, offset=size)

        return cls(length, zeros, load)

    def get(self, at: int) -> int:
        return int(self.bits[at >> 3] >> (at & 7)) & 1

    def ones(self, end: int) -> int:
        """Ones among the first `end` bits."""
        block = end // BLOCK
        byte, bit = end >> 3, end & 7
        inside = int(np.bitwise_count(self.bits[block * BLOCK // 8:byte]).sum())
        if bit:
            inside += int(np.bitwise_count(self.bits[byte] & np.uint8((1 << bit) - 1)))
        return int(self.before[block]) + inside

    def place(self, value: int, nth: int) -> int:
        """Where the bit `value` stands for the nth time (from 0)."""
        if value:
            block = int(np.searchsorted(self.before, nth, side="right")) - 1
            left = nth - int(self.before[block])
        else:
            empty = np.arange(len(self.before), dtype=np.int64) * BLOCK - self.before
            block = int(np.searchsorted(empty, nth, side="right")) - 1
            left = nth - int(empty[block])
        start = block * BLOCK
        flags = np.unpackbits(self.bits[start // 8:start // 8 + BLOCK // 8], bitorder="little")
        return start + int(np.flatnonzero(flags == value)[left])

    @cached_property
    def _words(self) -> tuple[np.ndarray, np.ndarray]:
        """The bits as words of 64, and the ones before each."""
        words = self.bits.view("<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        return words, np.cumsum(counts) - counts

    def get_each(self, places: np.ndarray) -> np.ndarray:
        return (self.bits[places >> 3] >> (places & 7).astype(np.uint8)) & np.uint8(1)

    def ones_each(self, ends: np.ndarray) -> np.ndarray:
        """`ones` of many ends at once."""
        words, before = self._words
        at = ends >> 6
        below = (np.uint64(1) << (ends & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & below)

    def places(self) -> np.ndarray:
        """Where all ones stand."""
        return np.flatnonzero(self.flags())

    def flags(self) -> np.ndarray:
        return np.unpackbits(self.bits, count=self.length, bitorder="little").view(bool)


class WaveletMatrix:
    def __init__(self, planes: list[BitPlane], length: int):
        self.planes = planes
        self.length = length

    @classmethod
    def of(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        values = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes = []
        for shift in range(levels - 1, -1, -1):
            flags = (values & values.dtype.type(1 << shift)) != 0
            planes.append(BitPlane.of(flags))
            # places are faster to gather from than flags
            values = np.concatenate((values.take(np.flatnonzero(~flags)), values.take(np.flatnonzero(flags))))
        return cls(planes, len(ids))

    def access(self, at: int) -> int:
        value = 0
        for plane in self.planes:
            bit = plane.get(at)
            ones = plane.ones(at)
            at = plane.zeros + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def access_each(self, places: np.ndarray) -> np.ndarray:
        """The ids at many places."""
        at = places.astype(np.int64)
        values = np.zeros(len(at), dtype=np.int64)
        for plane in self.planes:
            bit, ones = plane.get_each(at), plane.ones_each(at)
            at = np.where(bit == 1, plane.zeros + ones, at - ones)
            values = values << 1 | bit
        return values

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences between start and end stand after the last plane."""
        levels = len(self.planes)
        for i, plane in enumerate(self.planes):
            low, high = plane.ones(start), plane.ones(end)
            if token >> (levels - 1 - i) & 1:
                start, end = plane.zeros + low, plane.zeros + high
            else:
                start, end = start - low, end - high
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often the token occurs from start to before end."""
        if token >> len(self.planes):
            return 0
        low, high = self._range(token, start, self.length if end is None else end)
        return high - low

    def count_each(self, token: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """`count` of many ranges at once."""
        low, high = starts.astype(np.int64), ends.astype(np.int64)
        if token >> len(self.planes):
            return np.zeros_like(low)
        for shift, plane in zip(range(len(self.planes) - 1, -1, -1), self.planes, strict=True):
            ones_low, ones_high = plane.ones_each(low), plane.ones_each(high)
            if token >> shift & 1:
                low, high = plane.zeros + ones_low, plane.zeros + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low

    def places(self, token: int, first: int = 0, last: int | None = None) -> list[int]:
        """Where the token occurs for the first-th to before the last-th time."""
        if token >> len(self.planes):
            return []
        low, high = self._range(token, 0, self.length)
        out = []
        for at in range(low + first, high if last is None else min(high, low + last)):
            for i, plane in enumerate(reversed(self.planes)):
                at = plane.place(1, at - plane.zeros) if token >> i & 1 else plane.place(0, at)
            out.append(at)
        return out

    def ids(self) -> np.ndarray:
        """The whole sequence."""
        levels = len(self.planes)
        values = np.zeros(self.length, dtype=np.uint16 if levels <= 16 else np.uint32)
        for shift, plane in enumerate(reversed(self.planes)):
            flags = plane.flags()
            above = np.empty_like(values)
            above[np.flatnonzero(~flags)] = values[: plane.zeros]
            above[np.flatnonzero(flags)] = values[plane.zeros:] | values.dtype.type(1 << shift)
            values = above
        return values

    def to_bytes(self) -> bytes:
        """Head, sizes of the planes, planes."""
        planes = [plane.to_bytes() for plane in self.planes]
        sizes = np.array([len(plane) for plane in planes], dtype="<u4").tobytes()
        return b"".join((_HEAD.pack(_MAGIC, len(planes), self.length), sizes, *planes))

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, levels, length = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix")
        sizes = np.frombuffer(data, dtype="<u4", count=levels, offset=_HEAD.size)
        planes, at = [], _HEAD.size + 4 * levels
        for size in sizes.tolist():
            planes.append(BitPlane.from_bytes(data[at:at + size]))
            at += size
        return cls(planes, length)
