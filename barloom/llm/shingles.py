"""Shingle sets of many texts at once, on the bytes of a batch.

Words are runs of bytes other than white space, A-Z in lower case. A shingle is `width`
consecutive words; a text with fewer words is one shingle as a whole. Shingles are 64-bit
hashes: two different shingles of one pair of documents meet by chance once in 10^19 pairs.
"""

from __future__ import annotations

import numpy as np

from barloom.llm.common import SPACE_BYTES, in_chunks, mix64

BLOCK = 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACE_BYTES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    """BASE ** n, ..., BASE ** 1 (modulo 2**64)."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(n, BASE, dtype=np.uint64))[::-1].copy()
    return _powers[len(_powers) - n:]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word in the bytes. Works in blocks that end at white space, so
    memory follows the block, or the longest word."""
    starts, hashes = [], []
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + BLOCK)
        if end < n:
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            while not len(gaps) and end < n:
                end = min(n, end + BLOCK)
                gaps = np.flatnonzero(_SPACE[data[at:end]])
            if end < n:
                end = at + int(gaps[-1]) + 1
        block = data[at:end]
        gap = _SPACE[block]
        edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=1, append=1))
        first, last = edge[0::2], edge[1::2]
        if len(first):
            running = np.empty(len(block) + 1, dtype=np.uint64)
            running[0] = 0
            weights = _powers_to(len(block))
            np.cumsum((_LOWER[block].astype(np.uint64) + np.uint64(1)) * weights, out=running[1:])
            # shift each word's sum to the same power, whatever its place in the block
            total = (running[last] - running[first]) * _inverse_powers(len(block), first)
            starts.append(first + at)
            hashes.append(mix64(total + (last - first).astype(np.uint64)))
        at = end
    if not starts:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_inverses = np.ones(1, dtype=np.uint64)


def _inverse_powers(n: int, first: np.ndarray) -> np.ndarray:
    """The factor that takes the weight of place `first` in a block of n bytes to one."""
    global _inverses
    if len(_inverses) < n + 1:
        _inverses = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, _INVERSE, dtype=np.uint64))))
    return _inverses[n - first]


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    out: list[np.ndarray] = []
    factors = mix64(np.arange(1, width + 1, dtype=np.uint64) * BASE) | np.uint64(1)
    for part in in_chunks(texts, BLOCK):
        chosen = texts[part]
        sizes = np.fromiter((len(text) + 1 for text in chosen), dtype=np.int64, count=len(chosen))
        data = np.frombuffer(b" ".join(chosen) + b" ", dtype=np.uint8)
        starts, words = word_hashes(data)
        bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
        windows = max(0, len(words) - width + 1)
        shingles = np.zeros(windows, dtype=np.uint64)
        for j in range(width):
            shingles += words[j:j + windows] * factors[j]
        shingles = mix64(shingles)
        for i in range(len(chosen)):
            low, high = int(bounds[i]), int(bounds[i + 1])
            count = high - low
            if count >= width:
                values = np.sort(shingles[low:high - width + 1])
                if len(values) > 1:
                    values = values[np.concatenate(([True], values[1:] != values[:-1]))]
            elif count:
                short = (words[low:high] * factors[:count]).sum(dtype=np.uint64) + np.uint64(count)
                values = mix64(np.array([short], dtype=np.uint64))
            else:
                values = np.empty(0, dtype=np.uint64)
            out.append(values)
    return out


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set: sums of two independent mixings of its members."""
    flat = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    ends = np.cumsum([len(values) for values in sets], dtype=np.int64)
    out = []
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        running = np.concatenate(([np.uint64(0)], np.cumsum(mix64(flat ^ np.uint64(seed)), dtype=np.uint64)))
        sums = running[ends] - running[np.concatenate(([0], ends[:-1]))] if sets else running[:0]
        out.append(mix64(sums ^ np.uint64(seed)).view(np.int64))
    return out[0], out[1]
