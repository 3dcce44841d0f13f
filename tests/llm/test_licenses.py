"""Phrases against word lists, notices with planted errors against edit distances."""

import random
import re

import pytest

from barloom.llm import licenses

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i, *row[1:]], row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def damaged(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        kind = rng.randrange(3)
        if kind == 0:
            letters[at] = rng.choice("abcdefgh")
        elif kind == 1:
            letters.insert(at, rng.choice("abcdefgh"))
        elif len(letters) > 1:
            del letters[at]
    return "".join(letters)


def test_base_counts_equal_word_lists(documents, odd_texts):
    rows = odd_texts + [
        (50, "The MIT\n\nLicense, cc-by 4.0; CC  BY cc by by GNU General (Public) License"), (51, "xmit license mit licenses mité license"),
        (52, "apache\x00license éapache license"), (53, "cc cc by"),
    ]
    got = licenses.scan(documents(rows)).collect()
    plain = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got]
    assert sorted(plain, key=repr) == sorted(((i, *base(text)) for i, text in rows), key=repr)
    for row in got:
        assert set(filter(None, row["base_labels"].split(","))) <= set(filter(None, row["labels"].split(",")))
        assert 0 <= row["score"] <= 1 and (row["n_base"] == 0 or row["score"] == 1)


def test_notices_with_errors_are_found_and_spans_verified(documents):
    rng = random.Random(8)
    filler = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    rows, planted = [], {}
    for i, notice in enumerate(licenses.NOTICES * 6):
        edits = rng.randrange(notice.edits + 1)
        broken = damaged(rng, notice.text, edits).strip()
        # white space and punctuation between words make no difference
        shown = re.sub(" ", lambda _: rng.choice([" ", "\n", ", ", "  "]), broken)
        before = " ".join(rng.choice(filler) for _ in range(rng.randrange(20)))
        rows.append((i, f"{before} {shown} {' '.join(rng.choice(filler) for _ in range(rng.randrange(20)))}"))
        # edits may meet at a border or undo each other, so what was planted is measured
        if distance(" ".join(broken.split()), notice.text) <= notice.edits:
            planted[i] = notice
    got = {row["doc_id"]: row for row in licenses.scan(documents(rows)).collect()}
    for i, notice in planted.items():
        assert notice.label in got[i]["labels"].split(","), (rows[i], notice)
    by_label = {}
    for notice in licenses.NOTICES:
        by_label.setdefault(notice.label, []).append(notice)
    for i, text in rows:
        words = WORD.findall(text.translate(LOWER))
        for find in got[i]["finds"]:
            span = " ".join(words[find["first_word"]:find["first_word"] + find["words"]])
            assert any(distance(span, n.text) <= find["edits"] <= n.edits for n in by_label[find["label"]])


def test_seed_words_before_a_notice_at_the_start_hide_nothing(documents):
    shown = [
        ("License\n\nThe Mozilla Public License Version 2.0", "mpl"), ("License: GNU Lesser General Public License v3", "lgpl"),
        ("Source code license: Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ]
    for notice in licenses.NOTICES:
        for word in sorted({word for word, _ in licenses.seeds(notice)}):
            shown += [(f"{'x ' * before}{word} {'y ' * between}{notice.text} z", notice.label) for before in range(2) for between in range(4)]
    got = {row["doc_id"]: row for row in licenses.scan(documents([(i, text) for i, (text, _) in enumerate(shown)])).collect()}
    for i, (text, label) in enumerate(shown):
        assert any(find["label"] == label and find["edits"] == 0 for find in got[i]["finds"]), (text, label)


def test_clean_texts_have_no_finds(documents):
    rows = [(i, "a license for the general public and software by permission of the source " * 3) for i in range(5)]
    assert all(not row["finds"] and row["score"] == 0 for row in licenses.scan(documents(rows)).collect())
    assert licenses.scan(documents([])).collect() == []


def test_a_notice_needs_a_word_per_piece():
    with pytest.raises(ValueError, match="too few words"):
        licenses.seeds(licenses.Notice("mit license", "mit", 2))
