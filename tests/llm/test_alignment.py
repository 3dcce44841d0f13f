"""Token alignment against a plain version, with the two libraries' own encodings."""

import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barloom.llm import alignment
from barloom.llm.queries import QUERIES

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
FOLDER = "/root/testdata/sf0.001"


def plain(rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha) of each (doc_id, text)."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    with open(A, encoding="utf-8") as file:
        names = {value: token for token, value in json.load(file)["model"]["vocab"].items()}
    letters = {**alignment._byte_level()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)

    def b_bytes(i):
        piece = pieces.id_to_piece(i)
        return bytes.fromhex(piece[3:5]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("▁", " ").encode()

    def with_ends(tokens):
        out, at = [], 0
        for i, raw in tokens:
            at += len(raw)
            out.append((i, at))
        return out, b"".join(raw for _, raw in tokens)

    found = []
    for _, text in rows:
        text = text or ""
        a, a_text = with_ends([(i, bytes(letters[c] for c in names[i])) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids])
        b, b_text = with_ends([(i, b_bytes(i)) for i in pieces.encode(text)])
        raw = (" " + text).encode()
        found.append((a, b) if text and a_text == raw == b_text else ([], []))
    counts = Counter()
    for a, b in found:
        at = dict((end, j) for j, end in b)
        counts.update((i, at[end]) for i, end in a if end in at)
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(top.get(j, 0), n)
    out = []
    for (doc_id, _), (a, b) in zip(rows, found, strict=True):
        at = dict((end, j) for j, end in b)
        links = [(i, at[end]) for i, end in a if end in at]
        cuts = sorted({end for _, end in a} & {end for _, end in b})
        shown, start = [], 0
        for cut in cuts:
            shown.append("|".join(",".join(str(i) for i, end in side if start < end <= cut) for side in (a, b)))
            start = cut
        sha = hashlib.sha256(";".join(shown).encode()).hexdigest() if a else ""
        out.append((
            doc_id, len(a), len(b), len(cuts), len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), sha
        ))
    return out


def ordered(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: (row[0] is None, row))


@pytest.fixture
def texts(odd_texts):
    odd = [(20, "<|endoftext|> <s> </s> <unk> <0x41>"), (21, "a ▁ b"), (22, "x\x00y\ttab  two\r\n\r\n"), (23, "漢字 😀 ẞ ﬁ ñ é"), (24, " lead trail ")]
    # the plain version is slow on long texts
    return [(i, text[:2_000] if text else text) for i, text in odd_texts] + odd


def test_equals_plain_version(spark, documents, texts):
    rows = texts + [(100 + i, "the same text again and again") for i in range(40)]
    for slab in (1, 3_000, alignment.SLAB):
        assert ordered(alignment.align(documents(rows), A, B, slab=slab).collect()) == ordered(plain(rows))


def test_a_text_the_pieces_do_not_give_back_has_no_tokens(documents, texts):
    found = {row["doc_id"]: row for row in alignment.align(documents(texts), A, B).collect()}
    assert found[21]["n_a"] == found[21]["n_links"] == 0 and found[21]["groups_sha256"] == ""
    assert found[20]["n_a"] > 0 and found[22]["n_b"] > 0


def test_pairs_are_weighted_by_copies(documents):
    rows = [(i, "the cat") for i in range(5)] + [(9, "the dog")]
    pairs = alignment.pairs_of(documents(rows), A, B).collect()
    assert sorted(row["count"] for row in pairs) == [1, 5, 6] and all(row["best"] for row in pairs)


def test_ranks_give_the_library_s_ids(texts):
    side = alignment.ByteVocabulary(A)
    assert side._library is not None
    many = [" " + (text or "") for _, text in texts] + [" " * 3_000 + "x", "^" * 3_000, "'S 's I'll 12345  \u0085x"]
    fast = [ids.tolist() for ids in side.encode(many)]
    side._library = None
    assert fast == [ids.tolist() for ids in side.encode(many)]


def test_very_long_text(documents):
    text = " ".join(f"w{i * 7919 % 100_003}" for i in range(60_000))
    one, = alignment.align(documents([(1, text)]), A, B).collect()
    assert one["n_links"] == one["n_groups"] > 60_000


def test_empty_table(documents):
    found = alignment.align(documents([]), A, B)
    assert found.count() == 0
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_over_all_documents(spark):
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert ordered(QUERIES["op13_token_alignment"](spark, FOLDER).collect()) == ordered(plain(rows))
