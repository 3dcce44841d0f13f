"""Snapshots of conversations against comparing all pairs."""

import random
from collections import defaultdict

import pytest

from barloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, _cid string, _pos string, n_turns string"


def expected(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role, text))
    order = lambda x: tuple((v is not None, v if v is not None else 0) for v in x)
    whole = {c: [(r, x) for _, r, x in sorted(t, key=order)] for c, t in turns.items()}
    out = {}
    for conv, own in whole.items():
        same = [c for c, other in whole.items() if other == own]
        if conv != min(same, key=lambda c: (c is None, c or 0)):
            continue
        if any(len(other) > len(own) and other[: len(own)] == own for other in whole.values()):
            continue
        text = "".join(f"{chat.OPEN}{'unknown' if r is None else r}\n{x or ''}{chat.CLOSE}\n" for r, x in own)
        out[conv] = (len(own), len(same), sum(len(x or "") for r, x in own if r == "assistant"), text)
    return out


@pytest.fixture
def rows():
    rng = random.Random(1)
    out = []
    for conv in range(80):
        length = rng.randrange(1, 7)
        out += [(conv, t, "user" if t % 2 == 0 else "assistant", f"say {rng.randrange(2)}") for t in range(length)]
    out += [(200, 5, None, None), (200, 5, "", ""), (200, None, "user", "x"), (201, None, "user", "x"), (202, 1, "user", ""), (203, 1, "user", None)]
    out += [(204, 1, "user", "same"), (204, 1, "user", "same"), (205, 1, "user", "same"), (None, 1, "user", "no id"), (None, 2, "user", "no id")]
    out += [(300, t * 700, "user", "long") for t in range(600)] + [(301, t, "user", "long") for t in range(400)]
    return out


def test_maximal_conversations_equal_comparing_all(spark, rows):
    frame = spark.createDataFrame([(*row, "a", "b", "c") for row in rows], SCHEMA).repartition(5)
    got = defaultdict(list)
    for row in chat.render(frame).collect():
        got[row["conv_id"]].append(row)
    plain = {}
    for conv, parts in got.items():
        parts.sort(key=lambda row: row["part"])
        assert [row["part"] for row in parts] == list(range(-(-parts[0]["n_turns"] // chat.PART)))
        plain[conv] = (parts[0]["n_turns"], parts[0]["n_copies"], sum(r["assistant_chars"] for r in parts), "".join(r["text"] for r in parts))
    assert plain == expected(rows)
    assert 300 in plain and 301 not in plain


def test_no_conversations(spark):
    assert chat.render(spark.createDataFrame([], SCHEMA)).collect() == []
