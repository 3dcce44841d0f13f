import pytest

from pyspark.sql import types as T

# names that the operators use inside, and names of their results
CLASHING = ["_id", "_text", "_row", "_rid", "_n", "_h", "ids", "copies", "kept", "score", "component_id", "bucket"]

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in CLASHING]
)


@pytest.fixture
def documents(spark):
    """Makes documents from (doc_id, text) or (doc_id, text, source), with columns of clashing names."""

    def make(rows):
        full = [(row[0], row[1], "en", row[2] if len(row) > 2 else "src", len(row[1] or ""), *CLASHING) for row in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def odd_texts():
    """Null, empty, blank, tied, repeated and very long texts."""
    word = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore "
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two three"), (6, word * 3), (7, word * 3), (7, word * 3),
        (8, word * 3 + "x"), (None, word * 3), (None, None), (9, long), (10, long + " end"), (11, long), (12, "ÀÉ ½² 漢字 😀 \x1c y"),
        (13, "A" * 5_000), (14, "license " * 300), (15, "a b c d e f g h i j k l m n o p"), (16, "  a  b\r\n c "),
    ]
