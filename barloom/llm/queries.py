"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import alignment, bpe, chat, dedup, jaccard, language, licenses, mixing, negatives, quality, tokenbin, toxicity, warc

END_ID = 2


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return chat.render(_table(spark, folder, "conversations"))


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.near_copies(_table(spark, folder, "documents"), width=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "component_size")


def op3_wavelet_shards(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokenbin.read_documents(tokenbin.write_shards(_table(spark, folder, "documents"), path, END_ID))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op5_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(_table(spark, folder, "pages"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_rows(_table(spark, folder, "documents"), _table(spark, folder, "labels"), copies_once=True)


def op7_license_notices(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents")).drop("finds")


def op8_toxic_spans(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = toxicity.score_documents(docs, toxicity.train(docs, _table(spark, folder, "labels")))
    return found.select("doc_id", "held_out", "score", "predicted", "n_toxic")


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.find_copies(_table(spark, folder, "documents"))


def op10_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_word_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return language.identify(docs, language.train(docs))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    vec_id, label = rows["vec_id"], rows["label"]
    noisy = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(rows, vec_id % 100 == 0, noisy)


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a_path, b_path = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(_table(spark, folder, "documents"), a_path, b_path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_snapshots": op1_chat_snapshots,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_wavelet_shards": op3_wavelet_shards,
    "op4_mixing": op4_mixing,
    "op5_warc_chunks": op5_warc_chunks,
    "op6_quality_rules": op6_quality_rules,
    "op7_license_notices": op7_license_notices,
    "op8_toxic_spans": op8_toxic_spans,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_prefix_bpe": op10_prefix_bpe,
    "op11_word_languages": op11_word_languages,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op1_chat_snapshots": chat.ORACLE,
    "op4_mixing": mixing.ORACLE,
    "op5_warc_chunks": warc.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op9_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
}
