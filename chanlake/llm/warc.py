"""Operator 3: WARC archives through a chunked record table.

Writing: one record per row, through Spark's text sink whose line separator is the
blank line that ends a WARC record, so no task holds more than the row it
writes. A payload above ``segment_bytes`` is cut into a first record and
continuation records (WARC segments). Of equal payloads the smallest id is the
response, the others are revisits that refer to it.

Reading: files are streamed fragment by fragment (bytes between blank lines) into
rows (record id, chunk number, the chunk's bytes, bytes and digest so far) of at most
``chunk_bytes`` payload bytes, whatever the fragments; a running SHA-256 follows the chunks
of a record across its segments, so the last chunk's digest is that of the full
payload, the chunks in order are the payload, and Python holds a fragment and a chunk,
never a record. A fragment is as long as the payload goes without a blank line;
the writer's segments bound it for its own archives. Archives are gzip files,
each read by one task.

Defined results: NULL payloads are empty; a NULL URL gives no target header; repeated
rows give equal records; an empty table gives an empty archive; columns other
than id, URL and payload are ignored. A record cut short is returned with complete = false.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.llm.common import stored

END = "\r\n\r\n"
ID = "urn:x-row:"
CHUNKS = ("record_id string, record_type string, refers_to string, target_uri string, segment int, chunk_no int, "
          "n long, payload_bytes long, digest string, stated_digest string, last boolean, complete boolean, data binary")
CHUNK_BYTES = 1 << 16


def plan_records(rows: DataFrame, id_col: str, url: str, payload: str, min_bytes: int) -> DataFrame:
    """Rows (id, url, payload, n, digest, refers): refers is the id of the response for revisits, else NULL.

    The map of repeated payloads (digest -> smallest id) is stored first, so the planner knows its size:
    small maps are broadcast, large ones joined with skew splitting."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
                       body.alias("payload"))
    rows = rows.withColumn("n", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    firsts = (rows.filter(F.col("n") >= min_bytes).groupBy("digest")
              .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
              .select(F.col("digest").alias("d"), "first"))
    firsts = stored(firsts, "repeats")
    joined = rows.join(firsts, F.col("digest") == F.col("d"), "left")
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("id", "url", "payload", "n", "digest", refers.alias("refers"))


def write_archives(records: DataFrame, path: str, segment_bytes: int = 1 << 20,
                   date: str = "2025-01-01T00:00:00Z") -> None:
    """Write planned records as gzip WARC files under ``path`` (any file system Spark writes)."""
    def name(c):
        return F.concat(F.lit(f"<{ID}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))

    revisit = F.col("refers").isNotNull()
    parts = F.when(revisit | (F.col("n") <= segment_bytes), F.lit(1)).otherwise(
        F.ceil(F.col("n") / segment_bytes)).cast("int")
    cut = records.withColumn("parts", parts).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("parts"))))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit(END))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    first = F.col("k") == 1
    chunk = F.when(revisit, F.lit("").cast("binary")).otherwise(
        F.substring(F.col("payload"), (F.col("k") - 1) * segment_bytes + 1, F.lit(segment_bytes)))
    block = F.when(first, F.concat(F.encode(http, "UTF-8"), chunk)).otherwise(chunk)
    kind = F.when(revisit, "revisit").when(first, "response").otherwise("continuation")

    def line(key, value, when=None):
        text = F.concat(F.lit(f"\r\n{key}: "), value.cast("string"))
        return F.coalesce(F.when(when, text) if when is not None else text, F.lit(""))

    many = F.col("parts") > 1
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind,
        line("WARC-Record-ID", F.when(first, name(F.col("id"))).otherwise(
            F.concat(F.lit(f"<{ID}"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(":"),
                     F.col("k").cast("string"), F.lit(">")))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri, first),
        line("WARC-Refers-To", name(F.col("refers")), revisit),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), revisit),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")), first),
        line("WARC-Segment-Number", F.col("k"), many),
        line("WARC-Segment-Origin-ID", name(F.col("id")), ~first),
        line("WARC-Segment-Total-Length", F.col("n") + F.octet_length(http), many & (F.col("k") == F.col("parts"))),
        line("Content-Type", F.lit("application/http;msgtype=response"), first),
        F.lit("\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit(END))
    lines = cut.withColumn("block", block).select(
        F.concat(F.encode(head, "UTF-8"), F.col("block")).cast("string").alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(path)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


class _Record:
    """What is known of the record being read; its digest and size go on over its segments."""

    def __init__(self, head: dict[str, str], before: "_Record | None"):
        self.head, self.need, self.got = head, int(head.get("content-length", "0")), 0
        self.type, self.segment = head.get("warc-type", ""), int(head.get("warc-segment-number", "0"))
        going_on = self.type == "continuation"
        self.id = head.get("warc-segment-origin-id" if going_on else "warc-record-id", "").strip("<>")
        follows = (going_on and before is not None and before.ok and before.id == self.id
                   and before.segment + 1 == self.segment)
        self.ok = follows or not going_on
        self.origin = before.origin if follows else self
        self.sha = before.sha if follows else hashlib.sha256()
        self.bytes, self.chunks = (before.bytes, before.chunks) if follows else (0, 0)
        self.front = b"" if "application/http" in head.get("content-type", "") else None
        self.http: dict[str, str] = {}
        self.held = bytearray()

    def feed(self, data: bytes) -> None:
        """Take bytes of the block; what is payload waits for ``rows``."""
        self.got += len(data)
        if self.front is not None:                       # still in the HTTP header
            front, sep, rest = (self.front + data).partition(END.encode())
            if not sep:
                self.front = front
                return
            self.http, self.front, data = _headers(front), None, rest
        self.held += data

    def rows(self, size: int, data: bool, complete: bool = True) -> Iterator[tuple]:
        """Full chunks of what was fed and, when the record is done or cut short, the rest."""
        done = not complete or self.got >= self.need
        while len(self.held) > size:
            chunk = bytes(self.held[:size])
            del self.held[:size]
            yield self._row(chunk, data, False, True)
        if done:
            yield self._row(bytes(self.held), data, True, complete)
            self.held.clear()

    def _row(self, chunk: bytes, data: bool, final: bool, complete: bool) -> tuple:
        self.sha.update(chunk)
        self.bytes += len(chunk)
        total, digest, head = self.bytes, self.sha.copy().hexdigest(), self.origin.head
        stated = head.get("warc-payload-digest", "").partition(":")[2] or None
        if self.origin.type == "revisit":                # the payload lies elsewhere: size and digest are stated
            total, digest = int(self.http.get("content-length", -1)), stated
        last = final and (not complete or self.segment == 0 or "warc-segment-total-length" in self.head)
        self.chunks += 1
        return (self.id, self.origin.type, head.get("warc-refers-to", "").strip("<>") or None,
                head.get("warc-target-uri"), self.segment, self.chunks - 1, len(chunk), total, digest, stated, last,
                complete and self.ok, chunk if data else None)


class _Stream:
    """The bytes of one file, in order, cut into records."""

    def __init__(self, size: int, data: bool):
        self.size, self.data = size, data
        self.record: _Record | None = None
        self.before: _Record | None = None
        self.front, self.begun = b"", False

    def feed(self, part: bytes) -> Iterator[tuple]:
        """Rows of CHUNKS for the next fragment (fragments are what stands between blank lines)."""
        data, self.begun = (END.encode() if self.begun else b"") + part, True
        while True:
            if self.record is None:
                self.front = (self.front + data).lstrip(b"\r\n")
                head, sep, data = self.front.partition(END.encode())
                if not sep:
                    return
                self.front = b""
                if not head.startswith(b"WARC/"):
                    continue
                self.record = _Record(_headers(head), self.before)
            r = self.record
            take = data[:r.need - r.got]
            data = data[len(take):]
            r.feed(take)
            yield from r.rows(self.size, self.data)
            if r.got < r.need:
                return
            self.before, self.record = r, None

    def end(self) -> Iterator[tuple]:
        if self.record is not None:                      # the file stops inside a record
            yield from self.record.rows(self.size, self.data, complete=False)


def _read(size: int, data: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    kinds = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()
              }[f.split()[1]] for f in CHUNKS.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    stream, file = _Stream(size, data), None
    for b in batches:
        out: list[tuple] = []
        for name, cell in zip(b.column("file").to_pylist(), b.column("value")):
            if name != file:
                out += stream.end()
                stream, file = _Stream(size, data), name
            for row in stream.feed(cell.as_py()):
                out.append(row)
                if len(out) >= (64 if data else 1000):   # some MB of chunks at a time
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)
    out = list(stream.end())
    if out:
        yield batch(out)


def read_chunks(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, data: bool = True) -> DataFrame:
    """The chunked record table of all archives under ``path`` (CHUNKS): bytes of each chunk (unless ``data`` is false),
    sizes and digests so far."""
    text = spark.read.option("lineSep", END).text(path)
    return text.select(F.col("value").cast("binary").alias("value"),
                       F.col("_metadata.file_path").alias("file")).mapInArrow(
        functools.partial(_read, chunk_bytes, data), CHUNKS)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: its last chunk, with the digest and size of the full payload."""
    return read_chunks(spark, path, data=False).filter("last").drop("last", "segment", "n", "data")


def row_id(record_id):
    """The writer's row id of a record identifier (NULL for a NULL id)."""
    return F.substring(record_id, len(ID) + 1, 40).try_cast("long")
