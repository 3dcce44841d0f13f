"""From raw documents to token ids: quality rules, exact and near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read back as the next stage's documents. All but the last return the columns of documents.
SQL has neither the encoding nor the hashing of the quality rules, so there is no ORACLE_SQL;
tests/llm compares the stages with brute-force versions.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barloom.llm import bpe, dedup, jaccard, mixing, quality
from barloom.llm.common import stored, tracked
from barloom.sources.files import remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_left: list[DataFrame] = []


def _stage(body: Stage) -> Stage:
    """A stage that first deletes the intermediate tables of the one before, whose result has been written by
    then, unless the documents it gets still come from them."""

    @functools.wraps(body)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _left else []
        needed = [any(table.stored_at.rsplit("/", 1)[1] in name for name in read) for table in _left]
        for table, keep in zip(_left, needed, strict=True):
            if not keep:
                remove(spark, table.stored_at)
        _left[:] = [table for table, keep in zip(_left, needed, strict=True) if keep]
        with tracked() as made:
            found = body(spark, docs, sf_dir)
        _left.extend(made)
        return found

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), copies_once=True)


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.drop_copies(docs)


@_stage
def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_copies(docs)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_mix(docs)


@_stage
def prefix_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mix_sources", mix_sources),
    ("prefix_bpe", prefix_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
