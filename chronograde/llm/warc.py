"""WARC records as a table of chunks.

A record is a run of rows (``archive``, ``record_id``, ``chunk``, ``data``): chunk 0 is its header block, the following chunks
are slices of the payload, the last is the record's end mark. Joined in order, the chunks of an archive are a WARC
file byte for byte (``export`` writes one). Writer and reader pass over chunks one at a time and carry length
and SHA-1 along, so no step needs a whole record in one buffer beyond the page that the input row itself holds.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 64 * 1024
#: Rows of an output batch; with CHUNK it bounds the memory of a writer task.
BATCH = 256
CRLF = b"\r\n"
CHUNKS = "archive int, record_id bigint, chunk int, data binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def first_copies(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id``, ``sha1``, ``payload_bytes``, ``first_id`` of each different page: of equal payloads of at least ``min_bytes`` bytes
    the smallest page id, pages without an id coming last; smaller payloads have no first.

    Only ids and digests are shuffled for it. The minimum is combined before the shuffle, and the join back is
    a plain sort-merge join, which adaptive execution splits where one payload has very many pages.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", F.octet_length(F.coalesce("html", F.lit(""))).cast("bigint").alias("payload_bytes"),
                        F.sha1(body).alias("sha1")).distinct()
    firsts = (rows.where(F.col("payload_bytes") >= min_bytes).groupBy("sha1", "payload_bytes")
              .agg(F.min("page_id").alias("first_id"), F.lit(True).alias("is_counted")))  # a minimum passes over nulls
    return rows.join(firsts, ["sha1", "payload_bytes"], "left")


def _page(page_id: int | None, digest: str, copy: str = "") -> str:
    """A record's name: page, payload and, but for the one record others refer to, archive and number."""
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}{copy}>"


def _header(page_id: int | None, url: str | None, size: int, digest: str, first_id: int | None, revisit: bool, copy: str) -> bytes:
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"),
            f"WARC-Record-ID: {_page(page_id, digest, copy)}".encode(),
            b"WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A").encode(),
            b"WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}".encode(),
            f"X-Payload-Length: {size}".encode(), b"Content-Type: text/html; charset=utf-8"]
    if revisit:
        head += [f"WARC-Refers-To: {_page(first_id, digest)}".encode(), f"WARC-Profile: {PROFILE}".encode()]
    return CRLF.join([*head, f"Content-Length: {0 if revisit else size}".encode(), b"", b""])


def utf8_slices(text: str, size: int = CHUNK) -> Iterator[bytes]:
    """The UTF-8 bytes of a text in slices of at most ``size`` bytes, encoded a slice at a time."""
    step = max(1, size // 4)
    for at in range(0, len(text), step):
        yield text[at:at + step].encode("utf-8")


def record_chunks(page_id: int | None, url: str | None, html: str | None, size: int, sha1: str, first_id: int | None,
                  revisit: bool, copy: str = "", chunk: int = CHUNK) -> Iterator[bytes]:
    """Header block, payload slices (none for a revisit) and end mark of one record."""
    yield _header(page_id, url, size, base32_sha1(sha1), first_id, revisit, copy)
    if not revisit and html:
        yield from utf8_slices(html, chunk)
    yield CRLF + CRLF


def write_records(pages: DataFrame, chunk: int = CHUNK, min_bytes: int = 0) -> DataFrame:
    """The chunk rows of one record per row. Each task writes an archive of its own, in order of page ids.

    Pages are shuffled once, to meet their digests' first copies; the archive's number is the task's, records are numbered
    within it. Null html is an empty payload, null url an empty URI. A row without ``page_id`` gets a record without one; it is the
    response of its payload only where no page with an id has that. Rows that share an id are records of their own: with different
    payloads they have nothing to do with each other, of equal rows the first is the response and the others revisit it. An empty
    table gives an empty result; further columns are ignored.
    """
    known = first_copies(pages.select("page_id", "html"), min_bytes).select(F.col("page_id").alias("known_id"), F.col("sha1").alias("known_sha1"),
                                                                         "payload_bytes", "first_id", "is_counted")
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = (pages.select("page_id", "url", "html", F.sha1(body).alias("sha1"))
            .join(known, F.col("page_id").eqNullSafe(F.col("known_id")) & (F.col("sha1") == F.col("known_sha1")))
            .select("page_id", "url", F.when(F.col("first_id").isNull() | (F.col("first_id") == F.col("page_id")), F.col("html")).alias("html"),
                    "payload_bytes", "sha1", "first_id", F.coalesce("is_counted", F.lit(False)).alias("is_counted"))
            .sortWithinPartitions("page_id", "sha1", "url").select(F.spark_partition_id().alias("archive"), "*"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        before, number = None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                archive, page_id, url, html, size, sha1, first_id, counted = (batch.column(k)[i].as_py() for k in range(8))
                again = (page_id, sha1) == before  # equal rows meet in one task, one after the other
                before = page_id, sha1
                revisit = counted and (again or first_id != page_id)
                copy = f":{archive}-{number}" if revisit or again else ""
                for n, data in enumerate(record_chunks(page_id, url, html, size, sha1, first_id, revisit, copy, chunk)):
                    out.append((archive, number, n, data))
                    if len(out) >= BATCH:
                        yield _batch(out)
                        out = []
                number += 1
        if out:
            yield _batch(out)

    return rows.mapInArrow(run, CHUNKS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    a, r, c, d = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int32()), pa.array(r, pa.int64()), pa.array(c, pa.int32()), pa.array(d, pa.binary())],
        names=["archive", "record_id", "chunk", "data"])


class RecordReader:
    """Follows one record over its chunks; keeps header fields, counted bytes and the running digest."""

    def __init__(self) -> None:
        self.fields: dict[str, str] | None = None
        self._head = b""
        self._left = 0
        self.size = 0
        self.sha1 = hashlib.sha1()

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self._head += data
            head, mark, data = self._head.partition(CRLF + CRLF)
            if not mark:
                return
            lines = head.decode("utf-8").split("\r\n")
            self.fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            self._left = int(self.fields["Content-Length"])
        body = data[:self._left]
        self._left -= len(body)
        self.size += len(body)
        self.sha1.update(body)

    def row(self) -> tuple:
        """page_id, payload_bytes, payload_digest, record_type, refers_to; a response's figures are recounted."""
        if self.fields is None or self._left:
            raise ValueError("record is cut off")
        f = self.fields
        number = lambda x: int(n) if (n := x.strip("<>").split(":")[2]) else None
        named = f["WARC-Payload-Digest"].removeprefix("sha1:")
        if f["WARC-Type"] == "revisit":
            return number(f["WARC-Record-ID"]), int(f["X-Payload-Length"]), named, "revisit", number(f["WARC-Refers-To"])
        counted = base64.b32encode(self.sha1.digest()).decode()
        if counted != named:
            raise ValueError(f"digest of {f['WARC-Record-ID']} is {counted}, not {named}")
        return number(f["WARC-Record-ID"]), self.size, counted, "response", None


def read_records(chunks: DataFrame) -> DataFrame:
    """One row per record, read from its chunks in order: id, length, digest, type and reference.

    Raises on a record that is cut off or whose payload does not have the digest in its header.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, at = None, None
        for batch in batches:
            done = []
            for archive, record, chunk, data in zip(*(batch.column(k) for k in range(4))):
                if chunk.as_py() == 0:
                    if reader:
                        done.append(reader.row())
                    reader, at = RecordReader(), (archive.as_py(), record.as_py())
                elif at != (archive.as_py(), record.as_py()):
                    raise ValueError(f"record {record.as_py()} has no header chunk")
                reader.feed(data.as_py())
            if done:
                yield _records(done)
        if reader:
            yield _records([reader.row()])

    ordered = (chunks.select("archive", "record_id", "chunk", "data").repartition("archive", "record_id")
               .sortWithinPartitions("archive", "record_id", "chunk"))
    return ordered.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def export(chunks: DataFrame, archive: int, path: str) -> None:
    """Writes one archive as a WARC file, a chunk at a time (for a folder that the caller can reach)."""
    rows = chunks.where(F.col("archive") == archive).orderBy("record_id", "chunk").select("data")
    with open(path, "wb") as out:
        for row in rows.toLocalIterator():
            out.write(row["data"])

