"""Keys against Python's own compact JSON."""

import hashlib
import json
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from barloom.functions import text

def digest(fields):
    return hashlib.md5(json.dumps(fields, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def doubles():
    draw = random.Random(3)
    some = [0.0001, 1e16, 1e-7, 5.0, -0.0, 0.0, 0.00001, 123456789012345680.0, 9999999999999998.0, 1e15, 0.1, 1 / 3, -2.5, 1e22, 1e23, 8.41e21,
            2e23, 5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 2.0e-3, 100.0, 12345.678, 4.9e-324, 9.5e-5, 1e100, 2**53 + 2.0, 1.0e-4]
    some += [struct.unpack("<d", draw.randbytes(8))[0] for _ in range(3_000)]
    some += [draw.uniform(-1000, 1000) for _ in range(1_000)] + [round(draw.uniform(-1000, 1000), 2) for _ in range(1_000)]
    some += [float(f"{draw.randrange(1, 100)}e{draw.randrange(-300, 300)}") for _ in range(2_000)]
    return [x for x in some if math.isfinite(x)]


def test_numbers_have_their_shortest_text(spark):
    values = doubles()
    frame = spark.createDataFrame([(x,) for x in values], "v double")
    rows = frame.select("v", text.canonical_number(F.col("v").cast("string")).alias("t")).collect()
    common = [row for row in rows if row.v == 0 or 1e-5 <= abs(row.v) < 2**63]
    assert len(common) > 2_000 and [(row.v, row.t) for row in common if row.t != repr(row.v)] == []
    # elsewhere two texts of the least length may stand for the same double
    assert [row.t for row in rows if float(row.t) != row.v or len(row.t) != len(repr(row.v))] == []
    assert sum(row.t == repr(row.v) for row in rows) >= 0.999 * len(rows)


def test_keys_equal_those_of_compact_json(spark):
    fields = [(x, "a", {"n": x}, [x, 1.0], None, 7) for x in doubles()[:200]]
    fields += [(1.5, t, {"n": 2.0}, [], True, 7) for t in ('quote " 1.0E5 \\ x', "tab\t\x0b\x1f\x01 é漢", "5.0", "\\u000B", "line\n\r\b\f", "")]
    schema = "v double, name string, inner struct<n: double>, many array<double>, flag boolean, n int"
    frame = spark.createDataFrame(fields, schema)
    names = ["v", "name", "inner", "many", "flag", "n"]
    got = [row[0] for row in frame.select(text.deterministic_key({name: F.col(name) for name in names})).collect()]
    assert got == [digest(dict(zip(names, row, strict=True))) for row in fields]


@pytest.mark.parametrize("value, want", [
    (0.0001, '{"v":0.0001}'), (1e16, '{"v":1e+16}'), (1e-7, '{"v":1e-07}'), (5.0, '{"v":5.0}'), (-0.0, '{"v":-0.0}'),
])
def test_fixed_texts(spark, value, want):
    frame = spark.createDataFrame([(value,)], "v double")
    assert frame.select(text.deterministic_key({"v": F.col("v")})).first()[0] == hashlib.md5(want.encode()).hexdigest()
