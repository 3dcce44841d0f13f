"""License scans: exact phrases, and short notices with errors.

Texts are read as words: runs of letters, digits and all bytes beyond ASCII, A-Z in lower case.
Exact phrases are places where their words stand consecutively. A notice may differ by up to its
number of edits. By the pigeonhole principle, a notice cut into one piece more than its edits has a piece that no
edit touches; the longest word of each piece is a seed. One pass of an automaton finds all seeds,
the words around a seed are a candidate, and the regex library's bounded-error matching verifies
it and tells where it lies. Every seed is followed up; nothing is capped.

Null and empty texts have no words and no finds. Null ids and repeated rows are scanned like others. An empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from barloom.llm.common import in_chunks, payloads

# words of each phrase, and its label
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

BLOCK = 1 << 21

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:256] = True
# other bytes become spaces, A-Z lower case; places stay the same
_TABLE = bytes(0x20 if not _WORD[i] else i + 32 if 65 <= i <= 90 else i for i in range(256))


@dataclass(frozen=True)
class Notice:
    """A notice as words, its label, and how many characters may be wrong, missing or too many."""

    text: str
    label: str
    edits: int


# notices and their labels; names of the base phrases are used for the same licenses
NOTICES = (
    Notice("gnu general public license", "gpl", 2),
    Notice("this program is free software you can redistribute it and or modify it under the terms", "gpl", 4),
    Notice("gnu lesser general public license", "lgpl", 2),
    Notice("gnu affero general public license", "agpl", 2),
    Notice("apache license version", "apache", 2),
    Notice("creative commons attribution", "cc-by", 2),
    Notice("licensed under cc by nc", "cc-by-nc", 1),
    Notice("released under the mit license", "mit", 2),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 4),
    Notice("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 4),
    Notice("mozilla public license", "mpl", 2),
    Notice("eclipse public license", "epl", 2),
    Notice("boost software license", "bsl", 2),
    Notice("this is free and unencumbered software released into the public domain", "unlicense", 3),
)


def seeds(notice: Notice) -> list[tuple[str, int]]:
    """(word, its number in the notice) for each of edits + 1 pieces of whole words."""
    words = notice.text.split()
    pieces = notice.edits + 1
    if pieces > len(words):
        raise ValueError(f"{notice.text!r} has too few words for {notice.edits} edits")
    bounds = [len(words) * i // pieces for i in range(pieces + 1)]
    return [max(((words[i], i) for i in range(a, b)), key=lambda found: len(found[0])) for a, b in zip(bounds, bounds[1:], strict=False)]


class Scanner:
    def __init__(self, notices: tuple[Notice, ...] = NOTICES, phrases: tuple[tuple[str, str], ...] = PHRASES):
        self.notices = notices
        self.phrases = [
            (phrase.split()[0].encode(), re.compile(rb"(?<![^ ])" + rb" +".join(re.escape(w.encode()) for w in phrase.split()) + rb"(?![^ ])"), label)
            for phrase, label in phrases
        ]
        self.patterns = [
            regex.compile(rf"(?b)(?<!\S)(?:{regex.escape(notice.text, literal_spaces=True)}){{e<={notice.edits}}}(?!\S)") for notice in notices
        ]
        self.automaton = ahocorasick.Automaton()
        by_word: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for word, number in seeds(notice):
                by_word.setdefault(word, []).append((i, number))
        for word, uses in by_word.items():
            self.automaton.add_word(word, (word, uses))
        self.automaton.make_automaton()

    def exact(self, text: bytes) -> list[tuple[int, str]]:
        """(byte where it starts, label) of each phrase; the text has spaces between words."""
        return [(found.start(), label) for first, pattern, label in self.phrases if first in text for found in pattern.finditer(text)]

    def fuzzy(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> list[tuple[str, int, int, int]]:
        """(label, first word, words, edits) of each notice found; starts and ends are those of the words."""
        found: dict[tuple[int, int, int], int] = {}
        tried: set[tuple[int, int]] = set()
        for last, (word, uses) in self.automaton.iter(text.decode("latin-1")):
            # an untouched piece may stand within a longer word if an edit took the space beside it
            at = int(np.searchsorted(starts, last - len(word) + 1, side="right")) - 1
            for i, number in uses:
                notice = self.notices[i]
                length = len(notice.text.split())
                # where the notice would start, also before the text; clamped, different windows would look alike
                begin = at - number
                if (i, begin) in tried:
                    continue
                tried.add((i, begin))
                low = max(0, begin - notice.edits)
                high = min(len(starts), begin + length + notice.edits + 1)
                window = " ".join(text[starts[w]:ends[w]].decode("latin-1") for w in range(low, high))
                for match in self.patterns[i].finditer(window, overlapped=True):
                    first = low + window.count(" ", 0, match.start())
                    words = match.group().count(" ") + 1
                    edits = sum(match.fuzzy_counts)
                    key = (i, first, words)
                    found[key] = min(edits, found.get(key, edits))
        return sorted({(self.notices[i].label, first, words, edits) for (i, first, words), edits in found.items()}, key=lambda x: (x[1], x[0], x[2]))


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "finds array<struct<label: string, first_word: bigint, words: bigint, edits: bigint>>"
)
_FINDS = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("edits", pa.int64())]))


def _scan(scanner: Scanner, text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    places = scanner.exact(text)
    finds = scanner.fuzzy(text, starts, ends)
    at = np.searchsorted(starts, [start for start, _ in places])
    base = sorted({label for _, label in places})
    # a find with edits counts by the share of its characters that are right
    score = 1.0 if places else max((1 - edits / max(1, 4 * words) for _, _, words, edits in finds), default=0.0)
    return (
        len(starts), len(places), int(at.min()) if places else None, int(at.max()) if places else None, ",".join(base),
        ",".join(sorted({*base, *(find[0] for find in finds)})), max(0.0, score),
        [dict(zip(("label", "first_word", "words", "edits"), find, strict=True)) for find in finds],
    )


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base (places of the phrases), first_word and last_word (of those places),
    base_labels, labels (of the phrases and of the notices found), score (0 to 1), finds (label, first word, words, edits)."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text].cast("string").alias("_text"))
    id_field = rows.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            texts = payloads(batch.column("_text"))
            out = []
            for part in in_chunks(texts, BLOCK):
                chosen = texts[part]
                data = np.frombuffer(b" ".join(chosen) + b" ", dtype=np.uint8)
                edges = np.flatnonzero(np.diff(_WORD[data].view(np.int8), prepend=0))
                starts, ends = edges[0::2], edges[1::2]
                offset = 0
                for value in chosen:
                    low, high = np.searchsorted(starts, (offset, offset + len(value) + 1))
                    out.append(_scan(scanner, value.translate(_TABLE), starts[low:high] - offset, ends[low:high] - offset))
                    offset += len(value) + 1
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _FINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "finds"],
            )

    return rows.mapInArrow(run, f"doc_id {id_field.dataType.simpleString()}, {SCHEMA}")
