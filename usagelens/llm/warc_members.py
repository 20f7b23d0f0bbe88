"""WARC archives: one gzip stream per file turned into one gzip member per record.

Many tools compress a WARC file as a whole, so nothing in it can be reached without inflating
all before it. ``normalise`` inflates such a file once, in pieces, cuts it into records by
their headers, writes each record as a gzip member of its own and yields the sidecar index
(file, offset, length, record id). ``read_members`` then reads any record by offset alone.

``write_archives`` writes pages as such monolithic files: a record per row, its payload the
HTML in UTF-8. Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one
with the largest id is a ``response``; the others are ``revisit`` records that refer to it
and have no body. Smaller ones are all responses.

Files are written by tasks into the shared folder under names of their own; the rows a task
returns name them, so files of lost or repeated attempts are never looked at. Memory per
task is one piece of the stream and one record's header, whatever the file; bodies pass
through in pieces.

Defined results: a null page is an empty payload; a null id is written as such and read back
as null, it never is what others refer to; rows with equal id and payload are separate
records. Rows with equal payload and the same largest id are all responses; a row without an id
revisits them, and is a response where no copy has an id. Null urls are left out of the header,
line breaks in urls become spaces. Other columns play no part, whatever they are called.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.llm.common import byte_values, create_file, open_file, ship_package
from usagelens.session import new_path, stage

REVISIT_BYTES = 1000
#: A task starts another archive beyond this many bytes before compression.
ARCHIVE_BYTES = 1 << 26
_PIECE = 1 << 18
_GZIP = 16 + zlib.MAX_WBITS
_NULL_ID = "null"
# The WARC version, the revisit profile and the date of all records.
_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2025-01-01T00:00:00Z"


def record_header(page_id, url: bytes | None, payload: int, sha1: str, refers_to,
                  body: int) -> bytes:
    """A record's header; digests are base32, as archives have them."""
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", f"<urn:page:{_NULL_ID if page_id is None else page_id}>"),
              ("WARC-Date", _DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.decode("utf-8", "replace").split())))
    fields.append(("WARC-Payload-Digest",
                   "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode("ascii")))
    fields.append(("X-Payload-Length", str(payload)))
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "text/html"), ("Content-Length", str(body))]
    return _VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def parse_header(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def link_copies(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(page_id, url, html, sha1, refers_to) of every page."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"),
                        body.alias("html"), F.sha1(body.cast("binary")).alias("sha1"))
    large = F.octet_length("html") >= REVISIT_BYTES
    # One row per payload that occurs more than once; sums are taken before the shuffle.
    copies = stage(rows.where(large).groupBy("sha1").agg(
        F.max("page_id").alias("last"), F.count("*").alias("n")).where(
        "n > 1 and last is not null").select("sha1", "last"), "copies")
    return rows.join(copies, "sha1", "left").select(
        "page_id", "url", "html", "sha1",
        F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
                   html: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages as archives of a single gzip stream each; one row (file) per archive.

    Running the plan writes the files, so stage the rows before using them.
    """
    ship_package(pages.sparkSession)

    def write(batches) -> Iterator[pa.RecordBatch]:
        out = name = stream = None
        size = 0
        for batch in batches:
            ids, targets = batch.column(0).to_pylist(), batch.column(4).to_pylist()
            digests = batch.column(3).to_pylist()
            urls, bodies = byte_values(batch.column(1)), byte_values(batch.column(2))
            for page_id, link, body, sha1, refers_to in zip(ids, urls, bodies, digests, targets):
                if out is None:
                    out, name = create_file(folder, f"{uuid.uuid4().hex}.warc.gz")
                    stream, size = zlib.compressobj(6, zlib.DEFLATED, _GZIP), 0
                payload = len(body)
                if refers_to is not None:
                    body = b""
                header = record_header(page_id, link, payload, sha1, refers_to, len(body))
                for part in (header, body, b"\r\n\r\n"):
                    out.write(stream.compress(part))
                size += len(header) + len(body)
                if size >= archive_bytes:
                    out.write(stream.flush())
                    out.close()
                    yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])
                    out = None
        if out is not None:
            out.write(stream.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])

    return link_copies(pages, key, url, html).mapInArrow(write, "file string")


def inflate(path: str) -> Iterator[bytes]:
    """The content of a gzip file, one member or many, in pieces of bounded size."""
    with open_file(path) as file:
        stream = zlib.decompressobj(_GZIP)
        at, size = 0, file.size()
        data = b""
        while at < size or data:
            if not data:
                data = file.read_at(min(_PIECE, size - at), at)
                at += len(data)
            found = stream.decompress(data, _PIECE)
            data = stream.unconsumed_tail
            if stream.eof:
                data = stream.unused_data
                stream = zlib.decompressobj(_GZIP)
            if found:
                yield found
        rest = stream.flush()
        if rest:
            yield rest


class _Stream:
    """Pieces of bytes read by delimiter and by count."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def more(self) -> bool:
        found = next(self.pieces, None)
        self.held += found or b""
        return found is not None

    def header(self) -> bytes | None:
        """Up to and with the empty line that ends a header; None at the end."""
        while True:
            self.held = self.held.lstrip(b"\r\n") if self.held[:1] in (b"\r", b"\n") else self.held
            end = self.held.find(b"\r\n\r\n")
            if end >= 0:
                found, self.held = self.held[:end + 4], self.held[end + 4:]
                return found
            if not self.more():
                if self.held.strip():
                    raise ValueError("the last record's header is cut off")
                return None

    def body(self, length: int) -> Iterator[bytes]:
        while length:
            if not self.held and not self.more():
                raise ValueError("the last record's body is cut off")
            part, self.held = self.held[:length], self.held[length:]
            length -= len(part)
            if part:
                yield part


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite every archive (file) with a member per record; the index (file, offset, length,
    record_id, record_type) of all records. Running the plan writes the files."""
    ship_package(archives.sparkSession)

    def rewrite(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                out, name = create_file(folder, f"{uuid.uuid4().hex}.warc.gz")
                rows, offset = [], 0
                source = _Stream(inflate(path))
                while (header := source.header()) is not None:
                    fields = parse_header(header)
                    member = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
                    length = out.write(member.compress(header))
                    for part in source.body(int(fields["content-length"])):
                        length += out.write(member.compress(part))
                    length += out.write(member.compress(b"\r\n\r\n") + member.flush())
                    rows.append((name, offset, length, fields["warc-record-id"], fields["warc-type"]))
                    offset += length
                    if len(rows) >= 4096:
                        yield _index(rows)
                        rows = []
                out.close()
                if rows:
                    yield _index(rows)

    # A number of its own: adaptive execution would put the few short rows into one task. More
    # partitions than tasks that run, for a hash seldom deals out few files evenly.
    tasks = 4 * max(1, archives.sparkSession.sparkContext.defaultParallelism)
    return archives.repartition(tasks, "file").mapInArrow(
        rewrite, "file string, offset long, length long, record_id string, record_type string")


def _index(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in zip(*rows)],
        names=["file", "offset", "length", "record_id", "record_type"])


def read_members(index: DataFrame) -> DataFrame:
    """What the records say, each read by its offset alone: (record_id, record_type, refers_to,
    payload_bytes, payload_digest). A response's payload is counted and hashed as it is read;
    a revisit has none and its header is taken at its word."""
    ship_package(index.sparkSession)

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            path = file = None
            for name, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if name != path:
                    if file is not None:
                        file.close()
                    path, file = name, open_file(name)
                rows.append(_record(file, offset, length))
            if file is not None:
                file.close()
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()))],
                    names=["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest"])

    return index.select("file", "offset", "length").mapInArrow(
        read, "record_id string, record_type string, refers_to string, payload_bytes long, "
              "payload_digest string")


def _name(urn: str | None) -> str | None:
    found = None if urn is None else urn.removeprefix("<urn:page:").removesuffix(">")
    return None if found == _NULL_ID else found


def _record(file, offset: int, length: int) -> tuple:
    def pieces():
        stream, at = zlib.decompressobj(_GZIP), offset
        data = b""
        while not stream.eof and (at < offset + length or data):
            if not data:
                data = file.read_at(min(_PIECE, offset + length - at), at)
                at += len(data)
            yield stream.decompress(data, _PIECE)
            data = stream.unconsumed_tail
        yield stream.flush()

    source = _Stream(pieces())
    fields = parse_header(source.header())
    size, sha1 = 0, hashlib.sha1()
    for part in source.body(int(fields["content-length"])):
        size += len(part)
        sha1.update(part)
    told = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if fields["warc-type"] == "revisit":
        size, digest = int(fields["x-payload-length"]), told
    else:
        digest = sha1.hexdigest()
        if digest != told:
            raise ValueError(f"damaged payload in {fields['warc-record-id']}")
    return (_name(fields["warc-record-id"]), fields["warc-type"],
            _name(fields.get("warc-refers-to")), size, digest)


def archive_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url",
                       html: str = "html") -> DataFrame:
    """Write, normalise and read back all pages; a row per record."""
    spark = pages.sparkSession
    kind = pages.schema[key].dataType
    archives = stage(write_archives(pages, new_path(spark, "archives"), key, url, html), "archive-list")
    index = stage(normalise(archives, new_path(spark, "members")), "archive-index")
    return read_members(index).select(
        F.col("record_id").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
