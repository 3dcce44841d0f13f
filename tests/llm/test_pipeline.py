"""The pipeline stage by stage against brute force, and the registered queries against their SQL."""

import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from barloom.llm import bpe, mixing
from barloom.llm.queries import ORACLES, QUERIES
from check_oracles import TABLES, compare
from llm.test_duplicates import brute_components
from llm.test_quality import base, distinct, scores

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, the documents first."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], FOLDER), name))
    return out


def pairs(frame):
    return [(row["doc_id"], row["text"]) for row in frame.collect()]


def test_all_but_the_last_return_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "ngram_jaccard", "mix_sources", "prefix_bpe"]
    assert all(frame.columns == stages[0].columns for frame in stages[:-1])
    assert all(frame.schema["text"] == stages[0].schema["text"] for frame in stages[:-1])


def test_quality_stage(spark, stages):
    rows = pairs(stages[0])
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    bad = {row["doc_id"] for row in labels if row["quality"] != 1}
    trusted = {row["doc_id"] for row in labels} - bad
    texts = distinct(rows, trusted)
    score_of = dict(zip((text for _, text in texts), scores(texts, trusted), strict=True))
    want = [row for row in rows if not base(row[1])[-1] and score_of[row[1]] >= -0.13]
    assert sorted(pairs(stages[1])) == sorted(want)


def test_dedup_stages(stages):
    rows = pairs(stages[1])
    latest = {text: max(i for i, other in rows if other == text) for _, text in rows}
    assert sorted(pairs(stages[2])) == sorted((i, text) for text, i in latest.items())
    rows = pairs(stages[2])
    _, groups = brute_components(rows, 5, 80)
    assert sorted(row[0] for row in pairs(stages[3])) == sorted(min(rows[i][0] for i in group) for group in groups)


def test_mixing_and_encoding_stages(stages):
    plan = mixing.mix(stages[3]).collect()
    want = sorted(row["doc_id"] for row in plan for _ in range(row["copies"]))
    mixed = pairs(stages[4])
    assert sorted(i for i, _ in mixed) == want
    ranks = bpe.Ranks.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})
    expected = []
    for i, text in mixed:
        ids = library.encode_ordinary(text)
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(tuple(row) for row in stages[5].collect()) == sorted(expected)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    result = compare(con, name, QUERIES[name](spark, FOLDER))
    assert result.startswith("equal"), result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_return_a_row_per_document(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    assert frame.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
