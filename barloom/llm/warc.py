"""WARC archives, written and read as a table of chunks.

A payload is never held whole: it is cut into rows (record, chunk number, bytes) before it
reaches Python, the writer compresses chunk after chunk into the record's gzip member, and the reader yields
chunk rows again, each with the length and the SHA-1 digest of the payload so far, so the last
chunk's are those of the payload.

Of records with equal payloads of at least `MIN_BYTES` bytes, that with the largest id is a
response; the others are revisits without payload that name it, its digest and its length. Equal payloads are found by
SHA-256, with an aggregate before the join.

Each task writes archives of its own, under new names; the manifest lists those of tasks that
ended, so what a lost executor or a repeated task left behind is never read. The folder may be on any
file system pyarrow opens by URI.

Null html counts as empty, a null url as no target. Null ids come before all others; a record without id has no id
field. Repeated rows are records each; if they are the largest, each is a response. An empty table gives no archives and an
empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import stored
from barloom.session import scratch_path

MIN_BYTES = 1000
CHUNK = 1 << 18
ARCHIVE_BYTES = 1 << 29
READ_BYTES = 1 << 20
READ_TASKS = 20_000
DATE = "2020-01-01T00:00:00Z"
ROWS_AT_ONCE = 512
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space


def record_chunks(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", chunk: int = CHUNK) -> DataFrame:
    """The chunk rows to write: page_id, url, payload_bytes, sha1, record_type, refers_to, n_chunks, chunk_no, data. All
    chunks of a record follow each other."""
    payload = F.coalesce(pages[html].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(pages[id_column].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), payload.alias("_payload"))
    rows = rows.select(
        "*", F.octet_length("_payload").cast("long").alias("payload_bytes"), F.sha1("_payload").alias("sha1"),
        F.sha2("_payload", 256).alias("_same"),
    )
    # one row per payload; written, so that adaptive execution can split the join at a payload with many copies
    kept = stored(
        rows.where(F.col("payload_bytes") >= MIN_BYTES).groupBy("_same").agg(F.max("page_id").alias("_kept"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1").select("_same", "_kept"),
        "payloads",
    )
    # the same join at every size
    joined = rows.join(kept.hint("merge"), "_same", "left")
    revisit = F.col("_kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_kept"))
    typed = joined.select(
        "page_id", "url", "payload_bytes", "sha1", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("_kept")).alias("refers_to"), F.when(~revisit, F.col("_payload")).alias("_payload"),
    )
    count = F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length("_payload"), F.lit(0)) / chunk)).cast("int")
    cut = typed.withColumn("n_chunks", count).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    return cut.withColumn("data", F.expr(f"substring(_payload, chunk_no * {chunk} + 1, {chunk})")).drop("_payload")


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page/{page_id}')}>"


def _field(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda found: f"%{ord(found[0]):02X}", value)


def _head(row: dict) -> bytes:
    """The record's header and the HTTP header its block begins with."""
    http = HTTP_HEAD.format(row["payload_bytes"])
    revisit = row["record_type"] == "revisit"
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_record_id(row['page_id'])}", f"WARC-Date: {DATE}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(row['sha1'])).decode()}",
        f"Content-Length: {len(http) + (0 if revisit else row['payload_bytes'])}",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_field(row['url'])}")
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(row['refers_to'])}", f"X-Refers-To-Page-ID: {row['refers_to']}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


MANIFEST = "archive string, records long, bytes long"
_MANIFEST_ARROW = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def write_archives(chunks: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the chunk rows into archives; returns the stored manifest (archive, records, bytes). Every record is a gzip member."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out = member = None
        name, records, size = "", 0, 0
        meta = ("page_id", "url", "payload_bytes", "sha1", "record_type", "refers_to", "n_chunks", "chunk_no")

        def manifest() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], schema=_MANIFEST_ARROW)

        for batch in batches:
            data = batch.column("data")
            for i, row in enumerate(batch.select(meta).to_pylist()):
                if row["chunk_no"] == 0:
                    if out is None:
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = files.open_output_stream(f"{root}/{name}", compression=None)
                    member = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(member.compress(_head(row)))
                value = data[i].as_buffer() if data[i].is_valid else b""
                out.write(member.compress(value))
                if row["chunk_no"] == row["n_chunks"] - 1:
                    out.write(member.compress(b"\r\n\r\n"))
                    out.write(member.flush())
                    records, size = records + 1, out.tell()
                    if size >= archive_bytes:
                        out.close()
                        yield manifest()
                        out = None
        if out is not None:
            out.close()
            yield manifest()

    return stored(chunks.mapInArrow(write, MANIFEST), "manifest")


class _Records:
    """The uncompressed bytes of an archive, read on demand."""

    def __init__(self, stream: pa.NativeFile):
        self._stream = stream
        self._member = zlib.decompressobj(31)
        self._buffer = bytearray()

    def _more(self) -> bool:
        packed = self._member.unused_data if self._member.eof else self._member.unconsumed_tail
        if self._member.eof:
            self._member = zlib.decompressobj(31)
        packed = packed or self._stream.read(READ_BYTES)
        if not packed:
            return False
        # at most so much at once, however well it was compressed
        self._buffer += self._member.decompress(packed, READ_BYTES)
        return True

    def until(self, end: bytes) -> bytes | None:
        """Bytes up to the end mark, without it; none at the end of the archive."""
        at = self._buffer.find(end)
        while at < 0:
            if not self._more():
                if self._buffer.strip():
                    raise ValueError("the archive ends within a header")
                return None
            at = self._buffer.find(end)
        found = bytes(self._buffer[:at])
        del self._buffer[:at + len(end)]
        return found

    def take(self, n: int) -> bytes:
        while len(self._buffer) < n:
            if not self._more():
                raise ValueError("the archive ends within a record")
        found = bytes(self._buffer[:n])
        del self._buffer[:n]
        return found


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


CHUNKS = (
    "archive string, record long, chunk_no int, last boolean, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, header_sha1 string, sha1_so_far string, data binary"
)
_CHUNKS_ARROW = pa.schema([
    ("archive", pa.string()), ("record", pa.int64()), ("chunk_no", pa.int32()), ("last", pa.bool_()), ("page_id", pa.int64()),
    ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("header_sha1", pa.string()), ("sha1_so_far", pa.string()), ("data", pa.binary()),
])


def _read_records(name: str, stream: pa.NativeFile, chunk: int, with_data: bool) -> Iterator[dict]:
    records = _Records(stream)
    number = 0
    while (head := records.until(b"\r\n\r\n")) is not None:
        fields = _fields(head)
        http = records.until(b"\r\n\r\n")
        left = int(fields["content-length"]) - len(http) - 4
        revisit = fields["warc-type"] == "revisit"
        number_of = lambda key: int(fields[key]) if key in fields else None
        row = {
            "archive": name, "record": number, "page_id": number_of("x-page-id"), "url": fields.get("warc-target-uri"),
            "record_type": fields["warc-type"], "refers_to": number_of("x-refers-to-page-id"),
            "header_sha1": base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(),
        }
        digest, seen, chunk_no = hashlib.sha1(usedforsecurity=False), 0, 0
        while True:
            data = records.take(min(chunk, left))
            left -= len(data)
            seen += len(data)
            digest.update(data)
            yield row | {
                "chunk_no": chunk_no, "last": not left,
                # a revisit has no payload: its length is in the HTTP header
                "payload_bytes": int(_fields(http)["content-length"]) if revisit else seen,
                "sha1_so_far": digest.copy().hexdigest(), "data": data if with_data else None,
            }
            chunk_no += 1
            if not left:
                break
        records.take(4)  # the two line ends after a block
        number += 1


def read_archives(manifest: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """Chunk rows of all archives: archive, record (number within it), chunk_no, last, page_id, url, record_type, refers_to,
    payload_bytes and sha1_so_far (of the payload up to this chunk; of a revisit the length of the payload it
    stands for), header_sha1, data."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                waiting, size = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for row in _read_records(name, stream, chunk, with_data):
                        waiting.append(row)
                        size += len(row["data"] or b"")
                        if len(waiting) >= ROWS_AT_ONCE or size >= 16 * chunk:
                            yield pa.RecordBatch.from_pylist(waiting, schema=_CHUNKS_ARROW)
                            waiting, size = [], 0
                if waiting:
                    yield pa.RecordBatch.from_pylist(waiting, schema=_CHUNKS_ARROW)

    # a stated number of partitions is not merged, however small the manifest is
    tasks = max(1, min(READ_TASKS, manifest.count()))
    return manifest.select("archive").repartition(tasks).mapInArrow(read, CHUNKS)


def archive_pages(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes all pages and reads the archives back: page_id, payload_bytes, payload_digest (bare lower-case hex SHA-1 of the whole
    payload), record_type, refers_to, digest_ok (the payload read has the digest its header names)."""
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    folder = re.sub(r"^file:/(?=[^/])", "file:///", folder)
    manifest = write_archives(record_chunks(pages, id_column, url, html), folder)
    whole = read_archives(manifest, folder, with_data=False).where("last")
    revisit = F.col("record_type") == "revisit"
    return whole.select(
        "page_id", "payload_bytes", F.when(revisit, F.col("header_sha1")).otherwise(F.col("sha1_so_far")).alias("payload_digest"),
        "record_type", "refers_to", (revisit | (F.col("header_sha1") == F.col("sha1_so_far"))).alias("digest_ok"),
    )


ORACLE = f"""
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), kept AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM sized
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN payload_bytes >= {MIN_BYTES} AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_BYTES} AND page_id <> keeper THEN keeper END AS refers_to, true AS digest_ok
FROM kept
"""
