"""WARC 1.1 archives: writer with revisit records, and a salvage reader.

Writer: every record is its own gzip member.  Of records with equal payloads of at least ``least`` bytes the
one with the smallest id is a response, the others are revisits that name it and carry only the HTTP head.

Reader: each member must decompress (gzip's own check sum), parse, have the stated length, end in two line
ends and match its digest.  When a check fails the reader searches for the next valid member (or, in a plain
file, the next version line), goes on from there, and logs the bytes between as quarantined.

Edge cases: a null payload is empty and never revisited; a null id is written as ``none`` and read back as
null, and such rows are all responses; a null URL leaves the target header out; repeated rows each give a
record; an empty table gives no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SharedWriter, bound_batches, file_system, lean, materialise, shared_folder

#: Archives are rolled at this size, so that a reader's task stays bounded.
ROLL = 128 << 20
_DATE = "2024-01-01T00:00:00Z"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_RECORD_SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, file string, position long"
_GAP_SCHEMA = "file string, start long, end long, reason string"


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


def _name(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _id(name: str | None):
    tail = (name or "").strip("<>").rpartition(":")[2]
    return int(tail) if re.fullmatch(r"-?\d+", tail) else None


def encode_record(page_id, url: str | None, payload: bytes, size: int, digest: str, refers_to=None) -> bytes:
    """The plain bytes of one record; ``payload`` is left out of a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {_DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def compress(record: bytes, level: int = 4) -> bytes:
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


class Damaged(ValueError):
    """A record fails a check."""


class _Window:
    """A file read in chunks from any position."""

    def __init__(self, source, chunk: int = 1 << 20):
        self.source, self.size, self.chunk = source, source.size(), chunk
        self.start, self.data = 0, b""

    def at(self, position: int, n: int) -> bytes:
        if position < self.start or position + n > self.start + len(self.data):
            self.source.seek(position)
            self.start, self.data = position, self.source.read(max(n, self.chunk))
        return self.data[position - self.start : position - self.start + n]

    def find(self, pattern: re.Pattern, position: int, longest: int) -> int | None:
        """The first match at or after ``position``; ``longest`` bytes at most."""
        while position < self.size:
            piece = self.at(position, min(self.chunk, self.size - position))
            m = pattern.search(piece)
            if m:
                return position + m.start()
            position += max(1, len(piece) - longest + 1)
            if position + longest > self.size:
                return None
        return None


def _parse(data: bytes, whole: bool) -> tuple[Record, int]:
    """The record at the start of ``data`` and its length.  whole: nothing may follow it."""
    m = _VERSION.match(data)
    end = data.find(b"\r\n\r\n")
    if not m or end < 0:
        raise Damaged("no version line or header end")
    headers = {}
    for line in data[m.end() : end].split(b"\r\n"):
        k, colon, v = line.partition(b":")
        if not colon:
            raise Damaged("broken header line")
        headers[k.decode("latin-1").strip().lower()] = v.decode("utf-8", "replace").strip()
    if not headers.get("content-length", "").isdigit():
        raise Damaged("no content length")
    begin, n = end + 4, int(headers["content-length"])
    block = data[begin : begin + n]
    if len(block) < n or data[begin + n : begin + n + 4] != b"\r\n\r\n" or whole and len(data) != begin + n + 4:
        raise Damaged("length differs")
    stated = headers.get("warc-block-digest", "")
    if stated.startswith("sha256:") and stated[7:] != hashlib.sha256(block).hexdigest():
        raise Damaged("block digest differs")
    return Record(headers, block), begin + n + 4


def _member(window: _Window, position: int) -> tuple[Record, int]:
    if window.at(position, 3) != b"\x1f\x8b\x08":
        raise Damaged("no gzip member")
    inflate, out, at = zlib.decompressobj(31), [], position
    try:
        while not inflate.eof:
            piece = window.at(at, min(1 << 16, window.size - at))
            if not piece:
                raise Damaged("member is cut off")
            out.append(inflate.decompress(piece))
            at += len(piece)
            if len(out) == 1 and not out[0].startswith(b"WARC/") and len(out[0]) >= 5:
                raise Damaged("member holds no record")
    except zlib.error as e:
        raise Damaged(f"gzip: {e}") from None
    return _parse(b"".join(out), True)[0], at - len(inflate.unused_data)


def _plain(window: _Window, position: int) -> tuple[Record, int]:
    n = 1 << 16
    while True:
        data = window.at(position, min(n, window.size - position))
        try:
            record, size = _parse(data, False)
            return record, position + size
        except Damaged:
            head = re.search(rb"(?im)^content-length:\s*(\d+)", data[: data.find(b"\r\n\r\n") + 1])
            need = data.find(b"\r\n\r\n") + 8 + int(head[1]) if head else 0
            if len(data) >= need or len(data) == window.size - position:
                raise
            n = need


def salvage(source) -> Iterator[tuple[int, Record | None, int, str]]:
    """(position, record, end, "") for each whole record and (start, None, end, reason) for each quarantined gap."""
    window = _Window(source)
    position, gap, reason = 0, None, ""
    zipped = window.at(0, 2) == b"\x1f\x8b" or window.find(_VERSION, 0, 10) is None
    read = _member if zipped else _plain
    mark = re.compile(rb"\x1f\x8b\x08") if zipped else _VERSION
    while position < window.size:
        try:
            record, end = read(window, position)
        except Damaged as e:
            if gap is None:
                gap, reason = position, str(e)
            following = window.find(mark, position + 1, 16)
            position = window.size if following is None else following
            continue
        if gap is not None:
            yield gap, None, position, reason
            gap = None
        yield position, record, end, ""
        position = end
    if gap is not None:
        yield gap, None, window.size, reason


def roles(pages: DataFrame, least: int = 100) -> DataFrame:
    """Adds payload_bytes, payload_digest and refers_to.  Only digests that occur twice are joined; a hot digest
    is split by AQE's skew join, since nothing after the join needs its rows together."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(F.encode(html, "utf-8"), 256).alias("payload_digest"))
    heads = rows.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull()).groupBy(F.col("payload_digest").alias("digest")).agg(F.min("page_id").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    heads = materialise(heads, "warc-heads")
    joined = rows.join(heads, (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= least), "left")
    return joined.select("page_id", "url", F.when(F.col("head").isNull() | (F.col("head") == F.col("page_id")) | F.col("page_id").isNull(), F.col("html")).alias("html"), "payload_bytes", "payload_digest", F.when(F.col("head") != F.col("page_id"), F.col("head")).alias("refers_to"))


def write(pages: DataFrame, folder: str, least: int = 100, roll: int = ROLL) -> DataFrame:
    """Writes archives below ``folder``; returns the list of committed files (a retried task's spare file isn't in it)."""
    bound_batches(pages.sparkSession)

    def run(batches):
        out, names = None, []
        for batch in batches:
            for page_id, url, html, size, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = SharedWriter(folder, f"pages-{uuid.uuid4().hex}.warc.gz")
                out.write(compress(encode_record(page_id, url, (html or "").encode(), size, digest, refers_to)))
                if out.size >= roll:
                    out.commit()
                    names.append(out.path)
                    out = None
        if out is not None:
            out.commit()
            names.append(out.path)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["file"])

    return materialise(roles(pages, least).mapInArrow(lean(run), "file string"), "warc-files")


def read(files: DataFrame) -> DataFrame:
    """The records of the archives listed in ``files``, each checked; see ``gaps`` for what was quarantined."""
    return _read(files, False)


def gaps(files: DataFrame) -> DataFrame:
    """File, start, end and reason of every stretch of bytes that holds no whole record."""
    return _read(files, True)


def _read(files: DataFrame, log: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = file_system(path)
                rows = []
                with fs.open_input_file(name) as source:
                    for start, record, end, reason in salvage(source):
                        if log and record is None:
                            rows.append((path, start, end, reason))
                        elif not log and record is not None:
                            rows.append(_row(record, path, start))
                        if len(rows) >= 4096:
                            yield table(rows)
                            rows = []
                if rows:
                    yield table(rows)

    types = [pa.string(), pa.int64(), pa.int64(), pa.string()] if log else [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in (_GAP_SCHEMA if log else _RECORD_SCHEMA).split(", ")]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    spread = files.repartition(max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(lean(run), _GAP_SCHEMA if log else _RECORD_SCHEMA)


def _row(record: Record, path: str, start: int) -> tuple:
    h, kind = record.headers, record.headers.get("warc-type")
    head, _, payload = record.block.partition(b"\r\n\r\n")
    if kind == "revisit":
        stated = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        size, digest = int(stated[1]) if stated else None, h.get("warc-payload-digest", "").removeprefix("sha256:") or None
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    return _id(h.get("warc-record-id")), h.get("warc-target-uri"), kind, _id(h.get("warc-refers-to")) if kind == "revisit" else None, size, digest, path, start


def round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    folder = posixpath.join(shared_folder(pages.sparkSession, "warc"))
    return read(write(pages, folder, least))
