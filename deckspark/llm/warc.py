"""Operator 7: WARC archives with a salvage reader.

**Writer.**  Each page becomes a record: a ``response``, or a ``revisit`` of
the page with the smallest id among those with an equal payload.  Records are
gzip members of their own; each task writes one archive and only archives in
the committed manifest count.

**Reader.**  At every offset the reader expects a gzip member or a version
line and checks what follows: the member's checksum, the version line, the
header block, Content-Length, the end mark and the block digest.  After a
failed check it searches for the next place that passes all checks, member or
version line, goes on from there and logs the bytes in between as a
quarantined gap with its reason.  A member's content is searched in the same
way: its records that pass are read, and a gap in it is logged at the member,
with its bytes of the content in the reason.  Of a member that is truncated or
fails its checksum, the records that pass and have a block digest are read,
without one that ends where a truncated content ends; the member is logged as
a gap all the same.  A reader holds one record, a window of the content and
the compressed bytes of one member.

Defined results: null html is an empty payload, null or odd urls are written
percent-encoded; payloads shorter than ``least_bytes`` are always responses;
rows that share the smallest ``page_id`` of equal payloads are all responses;
a null ``page_id`` is a revisit if its payload has a page with an id, else a
response; empty tables give no archive; a file of garbage is one gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import cut_lineage, file_system, own_file, shared_folder

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
CHUNK = 1 << 20
PIECE = 1 << 16  # compressed bytes inflated at a time
TRUNCATED = "truncated member"

_MAGIC = b"\x1f\x8b\x08"
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
_LINE = re.compile(rb"WARC/\d\.\d\r\n")
_LONGEST_START = 10


def digest(data: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + END


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """``refers_to`` None: a response; else a revisit without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    return record(fields, block)


def _revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, sha, refers_to) of the rows that revisit another page.
    Only ids and hashes are shuffled; a payload that many pages share is
    summed up per task first, and joined as written tables."""
    keyed = cut_lineage(pages.where(F.octet_length("html") >= least_bytes).select("page_id", F.sha1("html").alias("sha")), "payloads")
    first = keyed.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    first = cut_lineage(first.where("n > 1 and refers_to is not null").drop("n"), "first-pages")
    return keyed.join(first, "sha").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, date: str | None = None) -> DataFrame:
    """Write ``pages(page_id, url, html)``; returns the manifest (path,
    n_records, n_bytes)."""
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html)
    again = cut_lineage(_revisits(pages, least_bytes), "revisits").select(F.col("page_id").alias("__id"), F.col("sha").alias("__sha"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("__id")) & (F.sha1("html") == F.col("__sha"))
    rows = pages.join(again, same, "left").select("page_id", "url", "html", "refers_to")

    def write(batches):
        out, n, size, uri = None, 0, 0, ""
        for b in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    fs, path, uri = own_file(folder, ".warc.gz")
                    out = fs.open_output_stream(path, compression=None)
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{uri.rsplit('/', 1)[1]}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
                    size += out.write(member(record(info, b"format: WARC File Format 1.1\r\n")))
                size += out.write(member(page_record(page_id, url, html.encode(), refers_to, date)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": uri, "n_records": n, "n_bytes": size}])

    return cut_lineage(rows.mapInArrow(write, "path string, n_records long, n_bytes long"), "warc-manifest")


class Window:
    """Bytes of a file by absolute offset; forgets what lies behind."""

    def __init__(self, source):
        self.source, self.base, self.data, self.ended = source, 0, bytearray(), False

    def more(self) -> bool:
        got = b"" if self.ended else self.source.read(CHUNK)
        self.ended = not got
        self.data += got
        return bool(got)

    def has(self, offset: int) -> bool:
        """Is there a byte at the offset?"""
        while offset >= self.base + len(self.data):
            if not self.more():
                return False
        return True

    def get(self, start: int, end: int) -> bytes:
        self.has(end - 1)
        return bytes(self.data[start - self.base : end - self.base])

    def forget(self, offset: int) -> None:
        if offset - self.base >= CHUNK:
            del self.data[: offset - self.base]
            self.base = offset


class Bad(Exception):
    pass


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Bad("header line without a colon")
        out[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return out


def _header_end(window: Window, at: int) -> int:
    """Offset of the end mark of the header at the offset, as far away as
    its lines are header lines."""
    line = seen = at
    while True:
        i = window.data.find(END, seen - window.base)
        if i >= 0:
            return i + window.base
        seen = max(at, window.base + len(window.data) - len(END) + 1)
        while (j := window.data.find(b"\r\n", line - window.base)) >= 0:
            if line > at and window.data.find(b":", line - window.base, j) < 0:
                raise Bad("header line without a colon")
            line = window.base + j + 2
        rest = line - window.base
        if len(window.data) - rest > CHUNK and window.data.find(b":", rest, rest + CHUNK) < 0:
            raise Bad("header line without a colon")
        if not window.more():
            raise Bad("header does not end")


def _plain(window: Window, at: int) -> tuple[dict, bytes, int]:
    """The record whose version line is at the offset, and its end."""
    if not _LINE.match(window.get(at, at + _LONGEST_START)):
        raise Bad("no version line")
    stop = _header_end(window, at)
    fields = _headers(window.get(at, stop))
    length = fields.get("content-length", "")
    if not length.isdigit():
        raise Bad("no Content-Length")
    start = stop + len(END)
    end = start + int(length)
    if not window.has(end + len(END) - 1):
        raise Bad("truncated record")
    block = window.get(start, end)
    if window.get(end, end + len(END)) != END:
        raise Bad("no end mark after the block")
    kind, _, value = fields.get("warc-block-digest", "").partition(":")
    if kind == "sha1" and value != digest(block):
        raise Bad("block digest differs")
    if "warc-type" not in fields:
        raise Bad("no WARC-Type")
    return fields, block, end + len(END)


class _Pieces:
    def __init__(self, pieces):
        self.pieces = iter(pieces)

    def read(self, n: int) -> bytes:
        return next(self.pieces, b"")


def _inflate(window: Window, at: int):
    """Yields the content of the gzip member at the offset in pieces; returns
    its end, or the place of its damage, and the damage or None.  A piece
    that fails is tried again in halves, which gives all before the damage."""
    z, pos, step = zlib.decompressobj(31), at, PIECE
    while not z.eof:
        if not window.has(pos):
            return pos, TRUNCATED
        chunk, before = window.get(pos, pos + step), z.copy()
        try:
            piece = z.decompress(chunk, CHUNK)
        except zlib.error as e:
            if len(chunk) == 1:
                return pos, "member checksum" if "check" in str(e) else "broken member"
            z, step = before, len(chunk) // 2
            continue
        pos += len(chunk) - len(z.unused_data if z.eof else z.unconsumed_tail)
        if piece:
            yield piece
    return pos, None


def _member(window: Window, at: int):
    """What the content of the gzip member at the offset holds, as by
    ``_walk``, the content's size, and the member's end and damage."""
    kept, size, run = [], 0, _inflate(window, at)
    while True:
        try:
            piece = next(run)
        except StopIteration as e:
            end, damage = e.value
            break
        size += len(piece)
        if size <= CHUNK:
            kept.append(piece)
    pieces = kept if size <= CHUNK else _inflate(window, at)  # a large one again
    return _walk(Window(_Pieces(pieces)), _LINE), size, end, damage


def salvage(source):
    """Yields ("record", offset, length, fields, block) and ("gap", offset,
    length, reason, None) in order; together they cover the whole file.  What
    lies in a member has the member's place."""
    return _walk(Window(source), _START)


def _walk(window: Window, starts: re.Pattern):
    at, gap, reason = 0, None, ""
    while window.has(at):
        packed = starts is _START and window.get(at, at + 3) == _MAGIC
        try:
            if packed:
                inner, size, end, damage = _member(window, at)
            else:
                fields, block, end = _plain(window, at)
                inner, size, damage = [("record", 0, end - at, fields, block)], end - at, None
        except Bad as e:
            if gap is None:
                gap, reason = at, str(e)
            at = _next_start(window, at + 1, starts)
            continue
        read, lost = False, []
        for kind, start, length, what, block in inner:
            if kind == "record" and damage:
                if "warc-block-digest" not in what or damage == TRUNCATED and start + length == size:
                    kind, what, block = "gap", damage, None
            if kind == "record":
                if gap is not None:
                    yield "gap", gap, at - gap, reason, None
                    gap = None
                yield from lost
                read, lost = True, []
                yield "record", at, end - at, what, block
            else:
                lost.append(("gap", at, end - at, f"{what}, bytes {start} to {start + length} of the content", None))
        if read:
            yield from lost
        if read and not damage:
            at = end
            window.forget(at)
            continue
        if gap is None:
            gap, reason = at, damage or (lost[0][3] if lost else "empty member")
        at = _next_start(window, at + 1, starts)
    if gap is not None:
        yield "gap", gap, window.base + len(window.data) - gap, reason, None


def _next_start(window: Window, at: int, starts: re.Pattern) -> int:
    """The next offset that looks like one of ``starts``, or the end."""
    while window.has(at):
        found = starts.search(window.data, at - window.base)
        if found:
            return window.base + found.start()
        at = max(at, window.base + len(window.data) - _LONGEST_START + 1)
        window.forget(at)
        if not window.more():
            break
    return window.base + len(window.data)


RECORDS = (
    "path string, kind string, offset long, length long, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long"
)


def _describe(path: str, found: tuple) -> dict:
    kind, offset, length, what, block = found
    out = {"path": path, "kind": kind, "offset": offset, "length": length}
    if kind == "gap":
        return out | {"reason": what}
    bare = lambda x: x[1:-1] if x and x[0] == "<" else x
    out |= {"record_type": what["warc-type"], "record_id": bare(what.get("warc-record-id")), "target_uri": what.get("warc-target-uri")}
    out |= {"refers_to": bare(what.get("warc-refers-to"))}
    head, _, payload = block.partition(END)
    if what["warc-type"] == "response":
        out |= {"payload_digest": digest(payload), "payload_bytes": len(payload)}
    elif what["warc-type"] == "revisit":
        http = _headers(head)
        out |= {"payload_digest": what.get("warc-payload-digest", "").partition(":")[2], "payload_bytes": int(http.get("content-length", 0))}
    return out | {"payload": payload if what["warc-type"] == "response" else None}


def read_archives(spark: SparkSession, paths: DataFrame, payloads: bool = False) -> DataFrame:
    """Records and gaps of the files in ``paths(path)``, one file a task;
    ``payloads`` adds the responses' payloads as a binary column."""
    schema = RECORDS + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in schema.split(", ")]
    arrow = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in schema.split(", ")])

    def read(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, p = file_system(path)
                rows, held = [], 0
                with fs.open_input_stream(p, compression=None) as f:
                    for found in salvage(f):
                        rows.append({k: v for k, v in _describe(path, found).items() if k in names})
                        held += len(found[4] or b"") if payloads else 0
                        if len(rows) == 1000 or held > CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return paths.select("path").repartition(n, "path").mapInArrow(read, schema)


def quarantine(found: DataFrame) -> DataFrame:
    """The log of byte gaps: (path, offset, length, reason)."""
    return found.where("kind = 'gap'").select("path", "offset", "length", "reason")
