"""Text, path, JSON and key column functions."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# URI schemes dropped from object paths, the date form in names, the
# UUID form, and the texts that mean "no value".
OBJECT_SCHEMES = ("gs", "gcs", "s3")
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
EMPTY_TEXTS = ("", "nan", "None")

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# a double as Spark writes it; the strings, numbers and marks of a JSON text; the escapes of a JSON string and what is between
_DOUBLE_TEXT = r"^-?([0-9]+)\.([0-9]+)(?:E(-?[0-9]+))?$"
_JSON_TOKENS = r'"(?:[^"\\]|\\.)*"|[-+.0-9E]+|[^-+.0-9E"]+'
_ESCAPES = r"\\u[0-9A-Fa-f]{4}|\\.|[^\\]+"

DATASET_PATTERN = r"([^/]+)_([^/_]+)_(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})\.parquet"


def parse_codes(codes: str | Sequence[object] | None) -> list[str]:
    """Codes from a plain text, a JSON list in text, or a sequence."""
    if codes is None:
        return []
    if isinstance(codes, str):
        text = codes.strip()
        listed = json.loads(text) if text.startswith("[") else [text]
    else:
        listed = list(codes)
    return [code for code in (str(item).strip() for item in listed) if code]


def parse_codes_column(codes: Column) -> Column:
    """Column form of `parse_codes`: an array of trimmed, non-empty codes."""
    text = strip(codes)
    listed = F.from_json(text, "array<string>")
    items = F.when(text.startswith("["), listed).otherwise(F.array(text))
    return F.filter(F.transform(items, strip), lambda c: F.length(c) > 0)


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def clean_text(value: Column) -> Column:
    trimmed = strip(value)
    return F.when(~trimmed.isin(*EMPTY_TEXTS), trimmed)


def strip_scheme(uri: Column) -> Column:
    """Object path without scheme and closing slashes."""
    bare = F.regexp_replace(uri, f"^({'|'.join(OBJECT_SCHEMES)})://", "")
    return F.rtrim(bare, F.lit("/"))


def split_object_path(uri: Column) -> Column:
    """Struct of bucket and key of an object URI; null when either is missing."""
    parts = F.split(strip_scheme(uri), "/", 2)
    bucket, key = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return F.when((bucket != "") & (key != ""), F.struct(bucket.alias("bucket"), key.alias("key")))


def dataset_name(code: Column, candle: Column, start: Column, end: Column) -> Column:
    return F.concat(F.concat_ws("_", code, candle, short_date(start), short_date(end)), F.lit(".parquet"))


def dataset_folder(path: Column) -> Column:
    """The dataset folder of a part file path, or null when the name does not parse."""
    found = F.regexp_extract(path, DATASET_PATTERN, 0)
    return F.when((found != "") & ~found.startswith("TEMP_"), found)


def parse_dataset(path: Column) -> Column:
    """Struct (code, candle, start_date, end_date) of a dataset path; null when it does not parse."""
    folder = dataset_folder(path)

    def part(group: int) -> Column:
        return F.regexp_extract(folder, DATASET_PATTERN, group)

    parsed = F.struct(
        part(1).alias("code"),
        part(2).alias("candle"),
        F.try_to_date(part(3)).alias("start_date"),
        F.try_to_date(part(4)).alias("end_date"),
    )
    return F.when(folder.isNotNull(), parsed)


def short_date(value: Column) -> Column:
    """First ten characters of a date or a text, empty for null."""
    return F.coalesce(F.left(value.cast("string"), F.lit(10)), F.lit(""))


def json_path(value: Column, path: str) -> Column:
    """Text at a JSON path, e.g. json_path(col, "data_model.code")."""
    return F.get_json_object(value, f"$.{path}")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def canonical_number(number: Column) -> Column:
    """Text of a double in the key's form, from the text Spark gives it (1.0E-4, 1.0E16, 5.0).

    The fewest digits that give the same double back; plain from 0.0001 to below 1e16, else with a signed exponent of two digits or
    more (1e-05, 1e+16). Of several texts with as few digits the nearest is taken below 2**63; beyond that and for small fractions the
    one that the Java version gives.
    """
    whole, part = (F.regexp_extract(number, _DOUBLE_TEXT, i) for i in (1, 2))
    power = F.coalesce(F.try_to_number(F.regexp_extract(number, _DOUBLE_TEXT, 3), F.lit("S999")).cast("int"), F.lit(0))
    bare = F.ltrim(F.concat(whole, part), F.lit("0"))
    # the value is 0.digits * 10 ** point
    point = F.length(bare) - F.length(part) + power
    parsed = F.struct(F.rtrim(bare, F.lit("0")).alias("digits"), point.alias("point"))

    def shortest(x: Column) -> Column:
        """A digit less if a neighbour of that length is the same double, as the text has one too many at times."""
        digits, count = x["digits"].cast("long"), F.length(x["digits"])
        below = F.floor(digits / 10)
        near = F.when(digits % 10 < 5, F.array(below, below + 1)).otherwise(F.array(below + 1, below))

        def same(candidate: Column) -> Column:
            text = F.concat(candidate.cast("string"), F.lit("E"), (x["point"] - count + 1).cast("string"))
            return text.cast("double") == F.abs(number.cast("double"))

        found = F.get(F.filter(near, same), F.lit(0))
        shorter = F.struct(
            F.rtrim(found.cast("string"), F.lit("0")).alias("digits"), (x["point"] - count + 1 + F.length(found.cast("string"))).alias("point")
        )
        return F.when((count > 1) & found.isNotNull() & (found > 0), shorter).otherwise(x)

    def shown(x: Column) -> Column:
        digits, at = x["digits"], x["point"]
        count, zero = F.length(digits), F.lit("0")
        plain = (
            F.when(at <= 0, F.concat(F.lit("0."), F.repeat(zero, -at), digits))
            .when(at >= count, F.concat(digits, F.repeat(zero, at - count), F.lit(".0")))
            .otherwise(F.concat(F.left(digits, at), F.lit("."), F.substring(digits, at + 1, count)))
        )
        rest = F.when(count > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), count))).otherwise("")
        power = F.abs(at - 1).cast("string")
        raised = F.concat(
            F.left(digits, F.lit(1)), rest, F.when(at > 0, "e+").otherwise("e-"), F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power)
        )
        # The powers of ten from and below which numbers are written plainly
        return F.when(digits == "", "0.0").when((at > -4) & (at <= 16), plain).otherwise(raised)

    def nearest(x: Column) -> Column:
        """Of as many digits, those that are nearest to the double; a whole number without fraction can be compared."""
        whole_value = F.abs(number.cast("double"))
        zeros = x["point"] - F.length(x["digits"])
        unit = F.pow(F.lit(10.0), zeros).cast("decimal(19,0)")

        def off(candidate: Column) -> Column:
            return F.abs(candidate.cast("decimal(19,0)") * unit - whole_value.cast("bigint").cast("decimal(19,0)"))

        around = F.transform(F.array(*(F.lit(i) for i in (-1, 0, 1))), lambda i: x["digits"].cast("long") + i)
        best = F.array_min(F.transform(around, lambda c: F.struct(off(c).alias("off"), c.alias("c"))))["c"].cast("string")
        found = F.struct(F.rtrim(best, F.lit("0")).alias("digits"), (zeros + F.length(best)).alias("point"))
        return F.when((whole_value >= 2.0**53) & (whole_value < 2.0**63) & (zeros >= 0), found).otherwise(x)

    sign = F.when(number.startswith("-"), "-").otherwise("")
    return F.concat(sign, _let(_let(_let(parsed, shortest), nearest), shown))


def canonical_json(value: Column) -> Column:
    """JSON text as Spark writes it in the key's form: doubles as `canonical_number`, escapes of control characters in lower case.
    NaN and infinite values keep Spark's quotes."""

    def inside(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(_ESCAPES), F.lit(0))
        lowered = F.transform(pieces, lambda p: F.when(p.startswith("\\u"), F.lower(p)).otherwise(p))
        return F.when(F.contains(text, F.lit("\\u")), F.array_join(lowered, "")).otherwise(text)

    def token(t: Column) -> Column:
        return F.when(t.startswith('"'), inside(t)).when(t.rlike(_DOUBLE_TEXT), canonical_number(t)).otherwise(t)

    return F.array_join(F.transform(F.regexp_extract_all(value, F.lit(_JSON_TOKENS), F.lit(0)), token), "")


def deterministic_key(fields: dict[str, Column]) -> Column:
    """MD5 of the compact JSON object with sorted names; null fields are kept, numbers have their shortest text."""
    ordered = [fields[name].alias(name) for name in sorted(fields)]
    return F.md5(canonical_json(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})))


def file_key(fields: dict[str, Column], at: Column) -> Column:
    return F.concat(deterministic_key(fields), F.date_format(at, "yyyyMMddHHmmss"))


def decode_utf8(value: Column) -> Column:
    """Bytes to text; null when the bytes are not valid UTF-8."""
    return F.when(F.is_valid_utf8(value.cast("string")), F.decode(value, "UTF-8"))


def merge_maps(old: Column, new: Column) -> Column:
    """Shallow merge of two maps; entries of `new` win."""
    kept = F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(kept, new)


def remap(value: Column, mapping: dict[str, str]) -> Column:
    """Replace enumerated values; values without an entry become null."""
    entries = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.create_map(*entries)[value]


def uuid_from(value: Column) -> Column:
    """A UUID text that is always the same for a value."""
    digest = F.md5(value.cast("string"))
    # Start and length of the five parts of a UUID
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digest, start, length) for start, length in cuts))


def merge_json(old: Column, new: Column) -> Column:
    """Shallow merge of two JSON objects; entries of `new` win, values keep their types."""

    def entries(value: Column) -> Column:
        return F.try_parse_json(value).cast("map<string,variant>")

    return F.to_json(merge_maps(entries(old), entries(new)))
