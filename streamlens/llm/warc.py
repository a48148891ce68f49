"""WARC archives: a writer with revisit records, and a salvage reader.

Writer: one gzip member per record (or plain records), written by Spark's own text writer, so its
commit protocol holds: a lost or repeated task leaves no half-written archive. Bytes pass through
the writer unchanged: a record is the value, and the line separator is a valid piece of the format
(an empty gzip member; the two line ends after a plain record).

Reader: archives are read whole by Spark (``binaryFile``), one record at a time is parsed. A record
must pass its checks: gzip CRC and length, version line, headers, content length, the two line ends,
block digest. After a failed check the reader looks for the next place that holds a valid member or
version line, goes on there, and logs the bytes between as quarantined. If the failed record's own
length leads to a valid border, only that record is quarantined, so a record quoted inside a payload
is not taken for one of the archive's. In a gzip member of several records the same holds within its content; of a member
that is not whole, the records before the damage are kept if their block digests hold. Archives over ``most_bytes`` are refused (``rotate`` keeps the writer's below).

Null payloads count as empty; a null id is written as an empty id and read back as null. Of rows with
equal payloads, those with the largest id are responses (all of them, if the row is repeated); a group
without any id is all responses. Empty tables give no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens.llm.common import slices

VERSION = b"WARC/1.1"
_VERSION_LINE = re.compile(rb"WARC/[01]\.[0-9]{1,2}\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/[01]\.[0-9]{1,2}\r\n")
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


#: An empty gzip member: the separator between compressed records.
EMPTY_MEMBER = _member(b"", 1)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """A response record, or a revisit record if ``refers_to`` is given; without the two line ends after it."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    block = _HTTP + (payload if refers_to is None else b"")
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {uri}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}",
            f"WARC-Block-Digest: sha1:{digest(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_REVISIT}"]
    head.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block


def with_originals(pages: DataFrame, least: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows (page_id, url, payload, refers_to): refers_to is the largest id of the rows with an
    equal payload of at least ``least`` bytes, null for that row itself and for shorter payloads.
    The groups are reduced before the join, which Spark may split for a group of many copies."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha1("payload"))).withColumn("size", F.octet_length("payload"))
    first = rows.where(F.col("size") >= least).groupBy("key", "size").agg(F.max("page_id").alias("original"))
    joined = rows.join(first, ["key", "size"], "left")
    return joined.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original")).alias("refers_to"))


def write_archives(rows: DataFrame, path: str, compress: bool = True, level: int = 1, rotate: int = 20_000) -> None:
    """Write rows (page_id, url, payload, refers_to) as archives below ``path``; a new file after ``rotate`` records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "payload"):
            out = [record(i, u, p, r) for i, u, p, r in zip(*[c.to_pylist() for c in b.columns])]
            if compress:
                out = [_member(x + b"\r\n\r\n", level) for x in out]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    separator, encoding = (EMPTY_MEMBER.decode("latin-1"), "ISO-8859-1") if compress else ("\r\n\r\n", "UTF-8")
    slim = rows.select("page_id", "url", "payload", "refers_to")
    (slim.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("encoding", encoding).option("lineSep", separator).option("maxRecordsPerFile", rotate).text(path))


class Salvage:
    """Records and quarantined gaps of one archive."""

    def __init__(self, data: bytes):
        self.data = data
        self.view = memoryview(data)

    def member(self, at: int) -> tuple[bytes, int]:
        """Content and end of the gzip member at ``at``; what can be read and -1 if it is not whole or its CRC fails."""
        z = zlib.decompressobj(31)
        parts, pos = [], at
        try:
            while not z.eof:
                piece = self.view[pos:pos + (1 << 16)]
                if not piece:
                    return b"".join(parts), -1
                parts.append(z.decompress(piece))
                pos += len(piece)
        except zlib.error:
            z = zlib.decompressobj(31)
            parts = [z.decompress(self.view[at:pos])]
            try:
                for i in range(pos, len(self.view)):
                    parts.append(z.decompress(self.view[i:i + 1]))
            except zlib.error:
                pass
            return b"".join(parts), -1
        return b"".join(parts), pos - len(z.unused_data)

    def inside(self, content: bytes, whole: bool) -> list[tuple[str, dict[str, str], bytes]]:
        """(failed check or '', headers, block) of the records and gaps of a member's content. Without a CRC that holds,
        a record needs a block digest and must end before the readable part does."""
        out, p = [], 0
        while p < len(content):
            headers, start, stop, why = self.parse(content, p)
            if not why and not whole and (stop == len(content) or not headers.get("warc-block-digest", "").startswith("sha1:")):
                why = "gzip member"
            if not why:
                out.append(("", headers, content[start:stop - 4]))
                p = stop
                continue
            out.append((why, {}, b""))
            if not (stop > 0 and (stop == len(content) or _VERSION_LINE.match(content, stop))):
                m = _VERSION_LINE.search(content, p + 1)
                while m and self.parse(content, m.start())[3]:
                    m = _VERSION_LINE.search(content, m.start() + 1)
                stop = m.start() if m else len(content)
            p = stop
        return out

    @staticmethod
    def parse(data: bytes, at: int) -> tuple[dict[str, str], int, int, str]:
        """Headers, block start, end behind the two line ends, and the failed check ('' if none).
        An end of -1: the record's extent is unknown."""
        if not _VERSION_LINE.match(data, at):
            return {}, at, -1, "version line"
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0:
            return {}, at, -1, "headers"
        headers: dict[str, str] = {}
        for line in data[at:stop].split(b"\r\n")[1:]:
            k, sep, v = line.partition(b":")
            if not sep or not k or k.strip() != k:
                return {}, at, -1, "headers"
            headers[k.decode("utf-8", "replace").lower()] = v.strip().decode("utf-8", "replace")
        size, start = headers.get("content-length", ""), stop + 4
        if not size.isdecimal():
            return headers, start, -1, "content length"
        end = start + int(size) + 4
        if end > len(data) or data[end - 4:end] != b"\r\n\r\n":
            return headers, start, -1, "content length"
        if not headers.get("warc-type") or not headers.get("warc-record-id"):
            return headers, start, end, "headers"
        want = headers.get("warc-block-digest", "")
        if want.startswith("sha1:") and want[5:] != digest(data[start:end - 4]):
            return headers, start, end, "block digest"
        return headers, start, end, ""

    def at(self, pos: int) -> tuple[list[tuple[str, dict[str, str], bytes]], int, str]:
        """Records and gaps at ``pos`` (one; a member may hold several or none), the next position (-1: unknown), the
        failed check if there is no record."""
        if self.data.startswith(b"\x1f\x8b\x08", pos):
            content, end = self.member(pos)
            found = self.inside(content, end >= 0)
            if end < 0:  # one gap for all that is lost
                found = [x for x in found if not x[0]] + [("gzip member", {}, b"")]
            return found, end, found[0][0] if found and all(x[0] for x in found) else ""
        headers, start, stop, why = self.parse(self.data, pos)
        if why:
            border = stop > 0 and (stop == len(self.data) or _START.match(self.data, stop))
            return [(why, {}, b"")], stop if border else -1, why
        return [("", headers, self.data[start:stop - 4])], stop, ""

    def __iter__(self) -> Iterator[tuple[int, int, str, dict[str, str], bytes]]:
        """(offset, length, failed check or '', headers, block) in archive order; what a member holds has the member's extent."""
        pos, n = 0, len(self.data)
        while pos < n:
            found, end, _ = self.at(pos)
            if end < 0:
                m = _START.search(self.data, pos + 1)
                while m and self.at(m.start())[2]:
                    m = _START.search(self.data, m.start() + 1)
                end = m.start() if m else n
            for why, headers, block in found:
                yield pos, end - pos, why, headers, block
            pos = end


_ROWS = [("archive", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("failed_check", pa.string()), ("record_type", pa.string()),
         ("page_id", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
         ("payload_digest", pa.string()), ("payload", pa.binary())]
_ROWS_SCHEMA = ("archive string, start long, length long, failed_check string, record_type string, page_id long, refers_to long, "
                "url string, payload_bytes long, payload_digest string, payload binary")


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True, most_bytes: int = 1 << 30) -> DataFrame:
    """Rows of all archives below ``path``: records (``failed_check`` null; size and digest of the
    payload as read, of revisits as recorded; payload null unless asked for) and quarantined gaps
    (``failed_check`` names the check; offset and length of the bytes passed over)."""
    files = spark.read.format("binaryFile").load(path)
    files = files.select("path", F.when(F.col("length") > most_bytes, F.raise_error(F.lit("an archive is larger than most_bytes"))).otherwise(F.col("content")).alias("content"))

    def rows(name: str, data: bytes) -> Iterator[tuple]:
        for at, size, why, h, block in Salvage(data):
            if why:
                yield name, at, size, why, None, None, None, None, None, None, None
                continue
            kind = h.get("warc-type")
            _, _, payload = block.partition(b"\r\n\r\n") if h.get("content-type", "").startswith("application/http") else (b"", b"", block)
            if kind == "revisit":
                n = h.get("x-payload-length", "")
                body = int(n) if n.isdecimal() else None, h.get("warc-payload-digest", "").removeprefix("sha1:") or None, None
            else:
                body = len(payload), digest(payload), payload if payloads else None
            yield name, at, size, None, kind, _page(h.get("warc-record-id")), _page(h.get("warc-refers-to")), h.get("warc-target-uri"), *body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = zip(*_ROWS)
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

        for b in slices(batches, "content"):
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                for x in rows(name, data.as_py()):
                    held.append(x)
                    size += 200 + len(x[-1] or b"")
                    if size > 16 << 20:
                        yield flush()
                        held.clear()
                        size = 0
        if held:
            yield flush()

    return files.mapInArrow(run, _ROWS_SCHEMA)
