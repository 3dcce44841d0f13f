"""Archives: round trips, revisits, and their form for other readers."""

import gzip
import hashlib
import re
from collections import defaultdict

import pytest

from barloom.llm import warc

SCHEMA = "page_id long, url string, html string, sha1 string, record_type string, _same string"


@pytest.fixture
def pages(spark):
    big = "".join(chr(97 + i * i % 26) for i in range(200_000))
    rows = [
        (1, "http://a/\r\nX: y", "<p>é漢</p>"), (2, None, None), (3, "http://b", ""), (4, "u", big), (5, "u", big), (6, "u", big + "x"),
        (7, "u", "z" * 999), (8, "u", "z" * 999), (9, "u", "z" * 1000), (10, "u", "z" * 1000), (10, "u", "z" * 1000),
        (None, "u", "z" * 1000), (None, "u", "q" * 2000), (None, "u", "q" * 2000), (11, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    ] + [(100 + i, "u", "copy " * 400) for i in range(50)]
    return rows, spark.createDataFrame([(*row, "a", "b", "c") for row in rows], SCHEMA).repartition(3)


def expected(rows):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = []
    for html, ids in groups.items():
        data = html.encode()
        named = [i for i in ids if i is not None]
        keep = max(named) if named and len(data) >= 1000 else None
        for i in ids:
            revisit = keep is not None and i != keep
            out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keep if revisit else None, True))
    return sorted(out, key=repr)


def test_pages_come_back(pages):
    rows, frame = pages
    assert sorted((tuple(row) for row in warc.archive_pages(frame).collect()), key=repr) == expected(rows)


def test_chunks_carry_digests_and_join_to_payloads(pages, tmp_path):
    rows, frame = pages
    folder = f"file://{tmp_path}/archives"
    manifest = warc.write_archives(warc.record_chunks(frame, chunk=5000), folder, archive_bytes=3_000)
    files = manifest.collect()
    assert len(files) > 2 and sum(row["records"] for row in files) == len(rows)
    # a left-over file of a task that failed is not read
    (tmp_path / "archives" / "stray.warc.gz").write_bytes(b"broken")
    parts = defaultdict(list)
    for row in warc.read_archives(manifest, folder, chunk=3000).collect():
        parts[row["archive"], row["record"]].append(row)
    got = []
    for chunks in parts.values():
        chunks.sort(key=lambda row: row["chunk_no"])
        assert [row["last"] for row in chunks] == [False] * (len(chunks) - 1) + [True]
        seen = b""
        for row in chunks:
            assert len(row["data"]) <= 3000
            seen += bytes(row["data"])
            assert row["sha1_so_far"] == hashlib.sha1(seen).hexdigest()
        if chunks[0]["record_type"] == "response":
            assert chunks[-1]["header_sha1"] == chunks[-1]["sha1_so_far"]
            got.append((chunks[0]["page_id"], seen.decode()))
    responses = [(row[0], row[3]) for row in expected(rows)]
    assert sum(kind == "response" for _, kind in responses) == len(got)
    assert {html for _, html in got} == {html or "" for _, _, html in rows}


def test_archives_have_the_standard_form(pages, tmp_path):
    _, frame = pages
    folder = f"file://{tmp_path}/archives"
    name = warc.write_archives(warc.record_chunks(frame.where("page_id <= 3").coalesce(1)), folder).first()["archive"]
    data = gzip.decompress((tmp_path / "archives" / name).read_bytes())
    for _ in range(3):
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
        assert re.search(rb"WARC-Record-ID: <urn:uuid:[0-9a-f-]{36}>", head) and b"\r\nX: y" not in head
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest[length:length + 4] == b"\r\n\r\n"
        data = rest[length + 4:]
    assert data == b""


def test_no_pages(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []
