"""Quality rules: fixed counts of each text, and a likelihood ratio of hashed n-grams.

The model has two multinomials over hashed single words and word pairs: one of trusted
documents, one of the whole corpus. A document's score is the mean of log(trusted / corpus) over
its n-grams, so length plays no part; it is kept if it has no failed base rule and its score
reaches a fixed threshold. All documents are counted, whole; the trusted side is fitted on at
most `TRUSTED_DOCUMENTS` of the labelled documents of good quality, those with the smallest
hash of their id, so that their ids can be broadcast. With `copies_once` each distinct text counts
once on either side, trusted if any of its ids is: counted per row, a text with many copies weighs in the corpus only,
and the score of a clean one falls with their number. Everything is column expressions.

Null text counts as empty: no words, base_failed. Null ids are never trusted. Repeated rows are scored alike,
each as a row. Without trusted documents all scores are 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WORD_PATTERN, as_rows, drop_stored, let, original, stored, text_of

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

BUCKETS = 1 << 14
THRESHOLD = -0.13
TRUSTED_DOCUMENTS = 20_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def _count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    return let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))


def _repeat_words(hashes: Column) -> Column:
    """Words in windows that the text has twice or more. Windows are compared by 64-bit hashes
    of their words' hashes."""
    count = F.size(hashes) - (WINDOW - 1)
    windows = F.when(
        count > 1,
        F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)])),
    )

    def covered(places: Column) -> Column:
        # windows at these places, in order: each adds the words up to the next one's start
        steps = F.transform(
            places, lambda place, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - place, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def twice(sorted_windows: Column) -> Column:
        marked = F.transform(
            sorted_windows,
            lambda window, i: F.when(
                (window["h"] == F.get(sorted_windows, i - 1)["h"]) | (window["h"] == F.get(sorted_windows, i + 1)["h"]),
                window["i"],
            ),
        )
        return let(F.array_sort(F.array_compact(marked)), covered)

    def repeats(found: Column) -> Column:
        # most texts have no repeated window, and need no sort
        placed = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(let(placed, twice))

    return F.coalesce(let(windows, repeats), F.lit(0))


def _grams(hashes: Column) -> Column:
    """Buckets of the single words and the word pairs."""
    mask = F.lit(BUCKETS - 1).cast("long")
    single = F.transform(hashes, lambda h: h.bitwiseAND(mask))
    pairs = F.when(
        F.size(hashes) > 1,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 2),
            lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)).bitwiseAND(mask),
        ),
    )
    return F.concat(single, F.coalesce(pairs, F.array().cast("array<bigint>")))


def _hashes(text: Column) -> Column:
    return F.transform(_words(text), lambda word: F.xxhash64(word))


def trusted_ids(labels: DataFrame, at_most: int = TRUSTED_DOCUMENTS) -> DataFrame:
    """Ids that all their labels call good: (_trusted), at most so many."""
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    chosen = good.select(F.col("doc_id").alias("_trusted"), F.xxhash64("doc_id").alias("_h")).orderBy("_h", "_trusted")
    return chosen.limit(at_most).select("_trusted")


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", copies_once: bool = False,
) -> DataFrame:
    """One row with array `ratios`: log(trusted / corpus) of every bucket."""
    rows = docs.select(docs[id_column].alias("_id"), text_of(docs, text).alias("_text"))
    # at most TRUSTED_DOCUMENTS ids
    known = F.broadcast(trusted_ids(labels))
    rows = rows.join(known, F.col("_id") == F.col("_trusted"), "left")
    rows = rows.select("_text", F.col("_trusted").isNotNull().cast("long").alias("_good"))
    if copies_once:
        # copies are combined before the shuffle. The key is a digest, as tables of whole texts take memory; a text as the
        # aggregated value is sorted by key instead, and spills
        key = (F.octet_length("_text").alias("_size"), F.sha2(F.col("_text").cast("binary"), 256).alias("_sha"))
        rows = rows.groupBy(*key).agg(F.max("_good").alias("_good"), F.first("_text").alias("_text")).select("_text", "_good")
    grams = rows.select("_good", let(_hashes(F.col("_text")), _grams).alias("_b"))
    counts = grams.select("_good", F.explode("_b").alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_good").alias("good")
    )
    # one row per bucket, whether it has n-grams or not
    buckets = docs.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"))
    counts = buckets.join(counts, "bucket", "left").fillna(0)
    listed = counts.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "n", "good"))).alias("seen"),
        F.sum("n").alias("total"), F.sum("good").alias("trusted"),
    )
    ratio = lambda x: F.log((x["good"] + 1) / (F.col("trusted") + BUCKETS)) - F.log((x["n"] + 1) / (F.col("total") + BUCKETS))
    ratios = F.when(F.col("trusted") > 0, F.transform("seen", ratio)).otherwise(F.transform("seen", lambda x: F.lit(0.0)))
    return stored(listed.select(ratios.alias("ratios")), "ratios")


def score_rows(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
    keep_rows: bool = False, copies_once: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, kept, score; with `keep_rows` also
    the input row as struct `_row`."""
    # BUCKETS doubles, as a constant of the plan
    fitted = fit(docs, labels, id_column, text, copies_once)
    known = fitted.first()["ratios"]
    drop_stored(fitted)
    ratios = F.split(F.lit(",".join(map(repr, known))), ",").cast("array<double>")
    carried = ["_row"] if keep_rows else []
    rows = as_rows(docs, {"_id": docs[id_column], "_text": text_of(docs, text)}).select(*carried, "_id", "_text")
    body = F.col("_text")
    counted = rows.select(
        *carried, F.col("_id").alias("doc_id"),
        F.char_length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
        _count_of(body, SYMBOLS).cast("long").alias("n_symbols"),
        _repeated_lines(body).cast("long").alias("n_dup_lines"),
        let(
            _hashes(body),
            lambda hashes: F.struct(
                F.size(hashes).cast("long").alias("n_words"), _repeat_words(hashes).cast("long").alias("n_repeat_words"),
                let(
                    _grams(hashes),
                    lambda grams: F.aggregate(grams, F.lit(0.0), lambda total, b: total + F.get(ratios, b.cast("int")))
                    / F.greatest(F.size(grams), F.lit(1)),
                ).alias("score"),
            ),
        ).alias("_found"),
    )
    n_words, repeats = F.col("_found.n_words"), F.col("_found.n_repeat_words")
    failed = (n_words < MIN_WORDS) | (repeats * 100 > n_words * MAX_REPEAT_PERCENT)
    return counted.select(
        *carried, "doc_id", n_words.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", repeats.alias("n_repeat_words"),
        failed.alias("base_failed"), (~failed & (F.col("_found.score") >= threshold)).alias("kept"),
        F.col("_found.score").alias("score"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", copies_once: bool = False,
) -> DataFrame:
    """The input rows that the rules keep."""
    return original(score_rows(docs, labels, id_column, text, keep_rows=True, copies_once=copies_once).where("kept"))
