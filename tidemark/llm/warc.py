"""WARC archives as tables of chunks.

A payload travels as rows of (record, chunk number) of at most ``CHUNK`` bytes,
and every row carries the SHA-1 digest and the size of the payload up to its end.
The last row of a record thus has the digest of the whole. Neither the
writer nor the reader ever puts a record together.

Writing: a response is an HTTP message in chunked transfer coding, so an
archive is a sequence of lines that end in CRLF. Chunks are written as they come,
as rows of Spark's text writer, which adds the line feed. That works on every
file system Spark can write to, and a task that is run again leaves one file.
An archive is one gzip stream and starts with a ``warcinfo`` record. Of records
with equal payloads the one with the smallest id is a ``response``, the
others are ``revisit`` records that name it and hold no payload. Equal payloads
are found by SHA-256, summed per task before the shuffle.

Reading: Spark's text reader streams the lines of an archive, which is not
split, and a pull parser takes headers and chunks from the stream. It holds a
batch of lines and a chunk at a time. The digest of a response is checked against its header.
Responses without transfer coding are read as well, in pieces of ``CHUNK`` bytes.

Defined cases: a null payload is empty. Payloads may be text or bytes, also
bytes that are no text. A null url is left out; spaces and control characters of
urls are percent-encoded. Rows with the same id and payload are responses all. A null id
is larger than any other, and a response that could only name a null id is a
``response`` itself. Very long payloads are many chunks. An empty table gives archives
without records, which read as no rows. Other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.registry import query
from tidemark.operators.scale import attach
from tidemark.session import scratch_path, store

CHUNK = 1 << 18
DATE = "1970-01-01T00:00:00Z"
FLUSH = 1 << 23  # bytes of a frame that is passed on
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = "record bigint, no_record boolean, url string, type string, refers_to bigint, chunk int, last boolean, bytes bigint, digest string, data binary"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


class CorruptArchive(ValueError):
    """An archive that breaks off, or a payload that is not what its header says."""


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# -- writing -------------------------------------------------------------------


def _header(fields: list[tuple[str, str]], length: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass")


def _safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _name(id: int | None) -> str:
    return f"<urn:page:{'' if id is None else id}>"


def chunks_of(payload: bytes, size: int = CHUNK) -> Iterator[tuple[int, memoryview, int, str]]:
    """number, bytes, size so far and digest so far of each chunk; an empty payload is one empty chunk."""
    view, sha = memoryview(payload), hashlib.sha1()
    for k, a in enumerate(range(0, max(len(view), 1), size)):
        part = view[a : a + size]
        sha.update(part)
        yield k, part, a + len(part), base32(sha.digest())


def _response(id: int | None, url: str | None, payload: bytes, size: int) -> Iterator[bytes]:
    """The record as rows, each without its last line feed."""
    for *_, total, digest in chunks_of(payload, size):  # the digest stands before the payload
        pass
    sizes = [min(size, total - a) for a in range(0, total, size)]
    head = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n"
    length = len(head) + sum(len(f"{n:x}") + 4 + n for n in sizes) + 5
    fields = [
        ("WARC-Type", "response"), ("WARC-Record-ID", _name(id)), ("WARC-Date", DATE), *([("WARC-Target-URI", _safe(url))] if url is not None else ()),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Payload-Length", str(total)), ("Content-Type", "application/http; msgtype=response"),
    ]
    held = _header(fields, length) + head
    for k, part, _, _ in chunks_of(payload, size) if total else ():
        if k:
            yield held[:-1]
            held = b""
        held = b"".join((held, b"%x\r\n" % len(part), part, b"\r\n"))
    yield held + b"0\r\n\r\n\r\n\r"


def _revisit(id: int | None, url: str | None, payload: bytes, of: int, size: int) -> bytes:
    for *_, total, digest in chunks_of(payload, size):
        pass
    head = _HTTP + b"\r\n"
    fields = [
        ("WARC-Type", "revisit"), ("WARC-Record-ID", _name(id)), ("WARC-Date", DATE), *([("WARC-Target-URI", _safe(url))] if url is not None else ()),
        ("WARC-Refers-To", _name(of)), ("WARC-Profile", REVISIT), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Payload-Length", str(total)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _header(fields, len(head)) + head + b"\r\n\r"


def _info() -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:page:info>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")]
    return _header(fields, len(body)) + body + b"\r\n\r"


def _rendered(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [_info()], 0
        for batch in batches:
            columns = (batch[c].tolist() for c in ("id", "no_id", "url", "payload", "of", "revisit"))
            for id, no_id, url, payload, of, revisit in zip(*columns):
                id = None if no_id else id
                rows = [_revisit(id, url, payload, of, size)] if revisit else _response(id, url, payload, size)
                for row in rows:
                    out.append(row)
                    held += len(row)
                    if held >= FLUSH:
                        yield pd.DataFrame({"value": out})
                        out, held = [], 0
        if out:
            yield pd.DataFrame({"value": out})

    return run


def _payload(c: Column) -> Column:
    """Bytes, of text in UTF-8; null as none."""
    return F.coalesce(c.cast("binary"), F.lit(b""))


def write(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, chunk: int = CHUNK
) -> None:
    """One archive per task below ``path``, with a record per row; payloads of fewer than ``least`` bytes are never revisited."""
    body = _payload(F.col(f"`{payload}`"))
    rows = pages.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("payload"))
    keyed = rows.withColumn("sha", F.unhex(F.sha2("payload", 256)))
    repeated = keyed.filter(F.octet_length("payload") >= least).groupBy("sha").agg(F.min("id").alias("of"), F.count(F.lit(1)).alias("n"))
    copies = store(repeated.filter("n > 1 AND of IS NOT NULL"), "copies")
    marked = attach(keyed, copies, ["sha"], "n").select(
        F.coalesce("id", F.lit(0).cast("long")).alias("id"), F.col("id").isNull().alias("no_id"), "url", "payload",
        F.coalesce("of", F.lit(0).cast("long")).alias("of"),
        (F.col("of").isNotNull() & ~F.col("id").eqNullSafe(F.col("of"))).alias("revisit"),
    )
    lines = marked.mapInPandas(_rendered(chunk), "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("compression", "gzip").option("lineSep", "\n").text(path)


# -- reading -------------------------------------------------------------------


class Stream:
    """The bytes of a task's archives, taken from batches of lines."""

    def __init__(self, batches: Iterator[pd.DataFrame]) -> None:
        self.batches, self.data, self.at = batches, b"", 0
        self.taken = 0  # bytes so far

    def more(self) -> bool:
        for batch in self.batches:
            if len(batch):
                self.data = b"".join((self.data[self.at :], b"\n".join(batch["value"]), b"\n"))
                self.at = 0
                return True
        return False

    def line(self) -> bytes | None:
        """Up to the next CRLF, which is taken too; None at the end."""
        searched = self.at
        while (end := self.data.find(b"\r\n", searched)) < 0:
            searched = max(len(self.data) - 1 - self.at, 0)
            if not self.more():
                if self.data[self.at :].strip():
                    raise CorruptArchive("an archive ends inside a line")
                return None
        found = self.data[self.at : end]
        self.taken += end + 2 - self.at
        self.at = end + 2
        return found

    def take(self, n: int) -> bytes:
        while len(self.data) - self.at < n:
            if not self.more():
                raise CorruptArchive("an archive ends inside a record")
        found = self.data[self.at : self.at + n]
        self.at += n
        self.taken += n
        return found

    def fields(self) -> dict[str, str]:
        out = {}
        while line := self.line():
            k, _, v = line.decode("utf-8", "surrogatepass").partition(":")
            out[k.strip().lower()] = v.strip()
        return out


def _parts(stream: Stream, http: dict[str, str], rest: int, size: int) -> Iterator[bytes]:
    """The chunks of a payload of which ``rest`` bytes are left in the record."""
    if "chunked" in http.get("transfer-encoding", "").lower():
        while n := int((stream.line() or b"0").split(b";")[0], 16):
            yield stream.take(n)
            stream.take(2)
        stream.fields()  # trailers
    else:
        for a in range(0, rest, size):
            yield stream.take(min(size, rest - a))


def _id(uri: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def read_chunks(batches: Iterator[pd.DataFrame], size: int = CHUNK) -> Iterator[tuple]:
    """record, url, type, refers_to, chunk, last, bytes so far, digest so far, data: the rows of all responses and revisits."""
    stream = Stream(batches)
    while (version := stream.line()) is not None:
        if not version:
            continue
        if not version.startswith(b"WARC/"):
            raise CorruptArchive(f"a record starts with {version[:20]!r}")
        head = stream.fields()
        kind, length = head.get("warc-type"), int(head.get("content-length", 0))
        wanted, sha, total = head.get("warc-payload-digest", "").rpartition(":")[2], hashlib.sha1(), 0
        mine = (_id(head.get("warc-record-id")), head.get("warc-target-uri"), kind)
        end = stream.taken + length
        if kind == "response":
            stream.line()
            http = stream.fields()
            before: bytes | None = None
            k = 0
            for part in _parts(stream, http, end - stream.taken, size):
                if before is not None:
                    yield (*mine, None, k, False, total, base32(sha.digest()), before)
                    k += 1
                sha.update(part)
                total += len(part)
                before = part
            digest = base32(sha.digest())
            if wanted and wanted != digest:
                raise CorruptArchive(f"record {mine[0]} has the digest {digest}, not {wanted}")
            yield (*mine, None, k, True, total, digest, before or b"")
        elif kind == "revisit":
            yield (*mine, _id(head.get("warc-refers-to")), 0, True, int(head.get("payload-length", 0)), wanted, None)
        while stream.taken < end:
            stream.take(min(size, end - stream.taken))
        if stream.taken > end or stream.take(4) != b"\r\n\r\n":
            raise CorruptArchive(f"record {mine[0]} is not as long as its header says")


def _read(last_only: bool, size: int):
    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["record", "url", "type", "refers_to", "chunk", "last", "bytes", "digest", "data"], dtype=object)
        out["no_record"] = [r is None for r in out["record"]]
        out["record"] = [r or 0 for r in out["record"]]
        return out[[c.split()[0] for c in _CHUNK.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for row in read_chunks(batches, size):
            if last_only:
                if not row[5]:
                    continue
                row = (*row[:-1], None)
            out.append(row)
            held += 200 + len(row[-1] or b"")
            if held >= FLUSH:
                yield frame(out)
                out, held = [], 0
        if out:
            yield frame(out)

    return run


def chunks(spark: SparkSession, path: str, last_only: bool = False, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of the archives below ``path``; with ``last_only`` one row per record, without data."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))
    found = lines.mapInPandas(_read(last_only, chunk), _CHUNK)
    return found.withColumn("record", F.when(~F.col("no_record"), F.col("record"))).drop("no_record")


def records(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """record, url, type, refers_to, bytes and digest of every response and revisit below ``path``."""
    return chunks(spark, path, True, chunk).select("record", "url", "type", "refers_to", "bytes", "digest")


@query(
    """
WITH t AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, min(page_id) AS first, sha1(h) AS s FROM t GROUP BY h)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(s, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM t JOIN g USING (h)"""
)
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    return records(spark, path).select(
        F.col("record").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )
