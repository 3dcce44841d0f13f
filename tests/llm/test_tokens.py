"""Encoders against the tokenizer libraries, wavelet matrices against arrays."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from barloom.llm import bpe, tokenbin
from barloom.llm.chunks import Recent, array_slices, cut_parts, parts_of
from barloom.llm.wavelet import WaveletMatrix

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ranks():
    return bpe.Ranks.read(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})


def random_texts(count, seed):
    rng = random.Random(seed)
    alphabet = " \n\t\r\x0b\x1c\x85  　aabé1½'strell.,!-😀漢́"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(count)]


def test_pattern_is_that_of_the_rank_files():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_parts_join_to_the_text():
    for text in [*random_texts(3000, 1), "", " ", "a", " a", "a ", "a  b", "a \n b"]:
        assert " ".join(parts_of(text)) == text


def cut(texts, fine=False):
    parts, counts = cut_parts(pa.array(texts, pa.large_string()), fine)
    every = iter(parts.to_pylist())
    return [[next(every).decode() for _ in range(n)] for n in counts.tolist()]


def border_texts(count, seed):
    rng = random.Random(seed)
    alphabet = "   \n\n\n\t\r'''''aabsStTdlé×÷ñɐɏ12.,;!-_(\x7f\x00\x85\xa0　’́漢«½"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(count)]


def test_cuts_of_arrays_are_those_of_texts():
    texts = [*random_texts(3000, 5), *border_texts(3000, 6), "", " ", "  ", "a ", " a", "a  b"]
    for text, found in zip(texts, cut(texts), strict=True):
        first, *rest = parts_of(text)
        assert found == [*([first] if first else []), *(" " + part for part in rest)]
    assert cut(["", ""]) == [[], []] and cut([]) == []
    column = pa.array(["left out", "a b", "", "c"]).slice(1)
    assert cut_parts(column)[0].to_pylist() == [b"a", b" b", b"c"]


def test_fine_cuts_fall_between_matches():
    texts = [*border_texts(20_000, 7), "it's l'homme 'st été, x.\nThe 64.44,5a ×! a\n\nb"]
    split = regex.compile(bpe.PATTERN).findall
    for text, found in zip(texts, cut(texts, fine=True), strict=True):
        assert [match for part in found for match in split(part)] == split(text)
    assert cut(["one, two.\nThree two's"], fine=True) == [["one", ",", " two", ".", "\n", "Three", " two", "'s"]]


def test_a_word_is_encoded_once_whatever_signs_follow(ranks):
    texts = [f"x thonorin{sign} y" for sign in ["", *",.;:!?-)", "!!", ".\n", "'s", "7"]]
    for encoder in (tokenbin.Vocabulary(JSON), bpe.Encoder(ranks)):
        seen, encode = [], encoder._cache._encode
        encoder._cache._encode = lambda parts, seen=seen, encode=encode: (seen.extend(parts), encode(parts))[1]
        for text in texts:
            encoder.encode_all([text])
        assert [part for part in seen if b"thonorin" in part] == [b" thonorin"]
        assert encoder.encode_all([]) == [] and encoder.encode_all(["", ""]) == [b"", b""]


def test_border_texts_equal_the_libraries(ranks, library):
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    texts = border_texts(5_000, 8)
    texts += [f"{a}{chr(c)}{b}" for c in range(0x250) for a in ("", "x", "'", ".", "x\n") for b in ("", "y", " z", "'s", "!")]
    shards, encoder = tokenbin.Vocabulary(JSON), bpe.Encoder(ranks)
    want = [found.ids for found in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, dtype="<u2").tolist() for x in shards.encode_all(texts)] == want
    assert [np.frombuffer(x, dtype="<i4").tolist() for x in encoder.encode_all(texts)] == library.encode_ordinary_batch(texts)


def test_added_tokens_are_found_as_by_the_library(tmp_path):
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.add_tokens(["norin"])
    tokenizer.save(str(tmp_path / "more.json"))
    found = tokenbin.Vocabulary(str(tmp_path / "more.json"))
    text = "a thonorin, b"
    assert np.frombuffer(found.encode_all([text])[0], dtype=found.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_array_slices_cover_all_rows():
    column = pa.array(["aaaa", "", "bb", "cccccccccc", "d", ""])
    assert list(array_slices(column, 5)) == [slice(0, 2), slice(2, 3), slice(3, 4), slice(4, 6)]
    assert list(array_slices(column.slice(0, 0))) == []


def test_encoder_equals_the_library(ranks, library):
    texts = [*random_texts(4000, 2), "a" * 4000, "ab" * 900 + "  " + "é" * 500, "<|endoftext|>", "it's we'll 'S"]
    encoder = bpe.Encoder(ranks)
    for start in range(0, len(texts), 300):
        some = texts[start:start + 300]
        for text, packed in zip(some, encoder.encode_all(some), strict=True):
            assert np.frombuffer(packed, dtype="<i4").tolist() == library.encode_ordinary(text)


def test_shard_vocabulary_equals_the_library():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    texts = [*random_texts(6000, 9), *[" ".join(random_texts(40, seed)) for seed in range(20, 60)], "<|endoftext|> x", "a" * 3000]
    vocabulary = tokenbin.Vocabulary(JSON)
    for start in range(0, len(texts), 500):
        some = texts[start:start + 500]
        want = [found.ids for found in tokenizer.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(x, dtype="<u2").tolist() for x in vocabulary.encode_all(some)] == want


def test_pairs_fit_as_merging_says(ranks):
    rng = random.Random(3)
    ids = list(ranks.bytes_of)
    for _ in range(3000):
        left, right = rng.choice(ids[:3000]), rng.choice(ids[:3000])
        if ranks.stands(left) and ranks.stands(right):
            assert ranks.fits(left, right) == (ranks.merged(ranks.bytes_of[left] + ranks.bytes_of[right]) == [left, right])


def test_prefix_table_appends_and_edits(ranks):
    rng = random.Random(4)
    letters = b"abcdeilnorst hing"
    data = bytes(rng.choice(letters) for _ in range(300))
    table = bpe.PrefixTable(ranks)
    for i in range(0, 300, 7):
        table.append(data[i:i + 7])
    assert table.tokens() == bpe.PrefixTable(ranks, data).tokens() == ranks.merged(data)
    assert table.tokens(120) == ranks.merged(data[:120])
    for _ in range(60):
        start = rng.randrange(len(table.data))
        end = min(len(table.data), start + rng.randrange(4))
        table.replace(start, end, bytes(rng.choice(letters) for _ in range(rng.randrange(4))))
        assert table.tokens() == ranks.merged(table.data)
    table = bpe.PrefixTable(ranks, data)
    assert table.replace(20, 21, b"q") < 150


def test_encoding_and_decoding_documents(documents, odd_texts, library):
    docs = documents(odd_texts)
    got = sorted((tuple(row) for row in bpe.digests(docs, RANKS).collect()), key=repr)
    want = []
    for doc_id, text in odd_texts:
        ids = library.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    kept = bpe.encode(docs, RANKS, keep_rows=True)
    assert kept.select("_row.*").columns == docs.columns
    assert bpe.digests(documents([]), RANKS).collect() == []


def test_documents_without_text(documents):
    empty = (0, hashlib.sha256().hexdigest(), hashlib.sha256().hexdigest())
    assert [tuple(row)[1:] for row in bpe.digests(documents([(1, None), (2, "")]), RANKS).collect()] == [empty] * 2
    shards = tokenbin.write_shards(documents([(1, None), (2, "")]), JSON, 2)
    assert sorted(tuple(row)[:3] for row in tokenbin.read_documents(shards).collect()) == [(1, 0, 1), (2, 1, 1)]


def test_decoding_skips_nulls(spark):
    rows = spark.createDataFrame([(1, [72, None, 73]), (2, None), (3, [])], "doc_id long, ids array<int>")
    table = bpe.Ranks.read(RANKS).bytes_of
    got = {row["doc_id"]: bytes(row["decoded"]) for row in bpe.decode(rows, RANKS).collect()}
    assert got == {1: table[72] + table[73], 2: b"", 3: b""}


def test_recent_forgets_the_older_half():
    known = Recent(10)
    for start in range(0, 100, 5):
        found = known.age()
        missing = known.missing(set(range(start, start + 5)))
        assert missing
        found.update({key: key for key in missing})
    assert not known.missing({99}) and known.missing({0}) == [0]
    assert len(known.new) + len(known._old) <= 32


@pytest.mark.parametrize("length", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("levels", [1, 5, 17])
def test_wavelet_matrix_equals_the_array(length, levels):
    rng = np.random.default_rng(length)
    ids = rng.integers(0, 1 << levels, length)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.of(ids, levels).to_bytes())
    assert matrix.ids().tolist() == ids.tolist()
    for at in range(0, length, 97):
        assert matrix.access(at) == ids[at]
    places = np.arange(length)
    assert matrix.access_each(places).tolist() == ids.tolist()
    starts, ends = places // 3, places
    for token in {*ids[:5].tolist(), (1 << levels) - 1, 1 << levels}:
        want = [int((ids[start:end] == token).sum()) for start, end in zip(starts, ends, strict=True)]
        assert matrix.count_each(token, starts, ends).tolist() == want
    for token in {*ids[:5].tolist(), 0, (1 << levels) - 1, 1 << levels}:
        places = np.flatnonzero(ids == token).tolist()
        assert matrix.places(token) == places
        assert matrix.places(token, 1, 3) == places[1:3]
        assert matrix.count(token) == len(places)
        assert matrix.count(token, length // 3, length // 2) == int((ids[length // 3:length // 2] == token).sum())


def test_shards_give_back_the_ids(spark, documents, odd_texts):
    rows = [row for row in odd_texts if row[0] != 7] + [(7, "seven"), (-5, "minus"), (10**15, "far")]
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    ids = {i: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2] for i, text in rows if i is not None}
    nulls = sorted([[*tokenizer.encode(text or "", add_special_tokens=False).ids, 2] for i, text in rows if i is None], key=len)
    shards = tokenbin.write_shards(documents(rows).repartition(3), JSON, 2, shard_ids=5000)
    assert shards.count() > 3
    assert shards.columns == ["part", "shard", "file"]
    got = tokenbin.read_documents(shards).orderBy("start").collect()
    assert [row["doc_id"] for row in got] == [None, None, *sorted(ids)]
    at = sum(map(len, nulls))
    for row in got[2:]:
        own = ids[row["doc_id"]]
        assert (row["start"], row["n_tokens"]) == (at, len(own))
        assert row["ids_crc32"] == zlib.crc32(np.array(own, dtype="<u4").tobytes())
        assert row["n_end_ids"] == own.count(2)
        at += len(own)
    assert sorted(row["n_tokens"] for row in got[:2]) == [len(x) for x in nulls]
    every = [x for own in [*ids.values(), *nulls] for x in own]
    token = ids[9][3]
    counts = tokenbin.count_tokens(shards, [token, 2]).groupBy("token").sum("n").collect()
    assert {row[0]: row[1] for row in counts} == {token: every.count(token), 2: every.count(2)}
    found = sorted(tuple(row) for row in tokenbin.find_token(shards, token).where("doc_id IS NOT NULL").collect())
    assert found == sorted((i, at) for i, own in ids.items() for at, x in enumerate(own) if x == token)
    for doc_id in (9, -5, 10**15):
        assert [row["ids"] for row in tokenbin.read_document(shards, doc_id).collect()] == [ids[doc_id]]


def test_shard_file_inflates_only_what_is_asked_for():
    ids = np.arange(1000, dtype=np.uint16) % 7
    file = tokenbin.ShardFile.from_bytes(tokenbin.ShardFile.of(ids, 3, [5, None, 9], [400, 1, 599], 2).to_bytes())
    assert file.doc_ids().to_pylist() == [5, None, 9] and file.n_documents == 3
    assert [file.span(i) for i in range(3)] == [(0, 400), (400, 401), (401, 1000)]
    assert file.document_at(np.array([0, 399, 400, 401, 999])).tolist() == [0, 0, 1, 2, 2]
    assert not any("_arrays" in plane.__dict__ for plane in file.matrix.planes)
    assert file.document(2).tolist() == ids[401:].tolist()


def test_no_documents_no_shards(documents):
    shards = tokenbin.write_shards(documents([]), JSON, 2)
    assert shards.collect() == []
    assert tokenbin.read_documents(shards).collect() == []
