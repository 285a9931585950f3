"""WARC archives: pages written one gzip member per record, and a sequential reader that verifies them."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_path
from .common import bounded, column, save, storage

VERSION = b"WARC/1.1"
CHUNK = 1 << 16
_ID = re.compile(r"<urn:page:(-?\d*)>")


class WarcError(ValueError):
    """A record that breaks the framing or fails its digest."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header(name, value):
    # A header is one line: control characters of a value are percent-encoded.
    clean = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))
    return f"{name}: {clean}\r\n".encode()


def record(page_id, url, payload: bytes, refers_to=None, revisit=False, date="1970-01-01T00:00:00Z") -> bytes:
    """The bytes of one response record, or of the revisit record that stands for an equal payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += f"Content-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    named = "" if page_id is None else page_id
    out = VERSION + b"\r\n"
    out += _header("WARC-Type", "revisit" if revisit else "response")
    out += _header("WARC-Record-ID", f"<urn:page:{named}>")
    out += _header("WARC-Date", date)
    if url is not None:
        out += _header("WARC-Target-URI", url)
    out += _header("Content-Type", "application/http; msgtype=response")
    out += _header("WARC-Block-Digest", "sha1:" + digest(block))
    out += _header("WARC-Payload-Digest", "sha1:" + digest(payload))
    if revisit:
        out += _header("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        out += _header("WARC-Refers-To", f"<urn:page:{refers_to}>")
    out += _header("Content-Length", len(block))
    return out + b"\r\n" + block + b"\r\n\r\n"


def members(stream):
    """The content of one gzip member after another, decompressed chunk by chunk."""
    machine, out, rest = zlib.decompressobj(31), [], b""
    begun = False
    while True:
        data = rest or stream.read(CHUNK)
        rest = b""
        if not data:
            if begun:
                raise WarcError("the archive ends inside a gzip member")
            return
        begun = True
        try:
            out.append(machine.decompress(data))
        except zlib.error as error:
            raise WarcError(f"damaged gzip member: {error}") from error
        if machine.eof:
            yield b"".join(out)
            rest = machine.unused_data
            machine, out, begun = zlib.decompressobj(31), [], False


def parse(member: bytes):
    """(headers by lower-cased name, block) of the one record in a member, framed by its length."""
    top, gap, rest = member.partition(b"\r\n\r\n")
    first, *lines = top.split(b"\r\n")
    if not gap or not first.startswith(b"WARC/"):
        raise WarcError("no WARC header")
    headers = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon:
            raise WarcError(f"not a header: {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    try:
        length = int(headers["content-length"])
    except (KeyError, ValueError):
        raise WarcError("no content length") from None
    if length < 0 or rest[length:] != b"\r\n\r\n":
        raise WarcError("the record's length and its content length differ")
    return headers, rest[:length]


def checked(headers, block):
    """(payload or None for a revisit, payload length) after both digests have been verified."""
    if headers.get("warc-block-digest") != "sha1:" + digest(block):
        raise WarcError(f"block digest of {headers.get('warc-record-id')}")
    http, gap, body = block.partition(b"\r\n\r\n")
    found = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    if not gap or not found:
        raise WarcError("no HTTP header")
    length = int(found[1])
    if headers["warc-type"] == "revisit":
        return None, length
    if len(body) != length or headers.get("warc-payload-digest") != "sha1:" + digest(body):
        raise WarcError(f"payload digest of {headers.get('warc-record-id')}")
    return body, length


def write_archives(
    pages: DataFrame, root: str | None = None, min_bytes: int = 0, level: int = 3, most: int = 1 << 30
) -> DataFrame:
    """Write a record per page under `root`; returns the manifest (path, records, bytes).

    Of pages with equal payloads of `min_bytes` or more, the one with the largest page_id is the
    response and the others revisit it. A null html is an empty payload; a null page_id is never
    the largest unless all are null, when each is a response; rows that repeat the largest page_id
    are all responses. A null url leaves out the target. An empty table writes no file.

    Digests meet in a count per digest first, so of a payload that a third of the pages share only
    one row is kept; the pages join that table by digest with the split of skewed keys. Each task
    attempt writes files of its own name, of `most` bytes of records each, and only the manifest of
    the attempt that succeeded names them, so lost executors leave nothing behind that is read.
    """
    spark = pages.sparkSession
    root = root or work_path(spark, "warc")
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", "url", html.alias("html"), F.sha1(html).alias("sha"), F.octet_length(html).alias("n")
    )
    shared = (
        rows.groupBy("sha", "n")
        .agg(F.count("*").alias("copies"), F.max("page_id").alias("response_id"))
        .where((F.col("copies") > 1) & (F.col("n") >= min_bytes))
        .drop("copies")
    )
    shared = save(shared, f"{root}/shared")
    rows = rows.join(shared, ["sha", "n"], "left").select(
        "page_id",
        "url",
        "html",
        F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id")).alias("refers_to"),
    )

    def write(batches):
        fs, folder = storage(root)
        fs.create_dir(f"{folder}/archives", recursive=True)
        out, path, n, size, listed = None, None, 0, 0, []
        for batch in bounded(batches, "html"):
            for page_id, url, html, refers_to in zip(*(column(batch, c).to_pylist() for c in names)):
                if out is None:
                    path = f"{folder}/archives/{uuid.uuid4().hex}.warc.gz"
                    out, n, size = fs.open_output_stream(path, compression=None), 0, 0
                data = record(page_id, url, html.encode("utf-8"), refers_to, refers_to is not None)
                machine = zlib.compressobj(level, zlib.DEFLATED, 31)
                packed = machine.compress(data) + machine.flush()
                out.write(packed)
                n, size = n + 1, size + len(packed)
                if size >= most:
                    out.close()
                    listed.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            listed.append((path, n, size))
        if listed:
            columns = list(zip(*listed))
            yield pa.RecordBatch.from_pydict(dict(zip(("path", "records", "bytes"), map(list, columns))))

    names = ("page_id", "url", "html", "refers_to")
    manifest = rows.mapInArrow(write, "path string, records long, bytes long")
    return save(manifest.withColumn("root", F.lit(root)), f"{root}/manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the archives that a manifest lists, read front to back and verified.

    Columns: page_id, url, record_type, refers_to, payload (null for a revisit), payload_bytes and
    payload_digest of the full payload. A damaged member, a wrong length or a digest that does not
    fit raises WarcError with the file's name.
    """

    def read(batches):
        for batch in batches:
            for path, root in zip(column(batch, "path").to_pylist(), column(batch, "root").to_pylist()):
                fs, _ = storage(root)
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for member in members(stream):
                        try:
                            headers, block = parse(member)
                            payload, length = checked(headers, block)
                        except WarcError as error:
                            raise WarcError(f"{path}: {error}") from error
                        page = _ID.fullmatch(headers["warc-record-id"])[1]
                        to = _ID.fullmatch(headers.get("warc-refers-to", "<urn:page:>"))[1]
                        rows.append(
                            (
                                int(page) if page else None,
                                headers.get("warc-target-uri"),
                                headers["warc-type"],
                                int(to) if to else None,
                                payload,
                                length,
                                headers["warc-payload-digest"].removeprefix("sha1:"),
                            )
                        )
                        held += length
                        if held > 8_000_000:
                            yield as_batch(rows)
                            rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    kinds = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
        ]
    )
    schema = (
        "page_id long, url string, record_type string, refers_to long, payload binary, "
        "payload_bytes long, payload_digest string"
    )
    files = manifest.select("path", "root")
    return files.repartition(max(1, files.count())).mapInArrow(read, schema)
