"""WARC archives: a writer that stores each payload once, and a splittable reader.

Archives are gzip members, one a record, in a folder that all executors share (any store
that ``pyarrow.fs`` opens by URI).  Writing: a task writes one archive under a name of its
own and returns the name; only the names of finished tasks enter the manifest, so a task
that runs twice leaves at most a file that nobody reads.  Reading: a task gets a byte range
of an archive, scans it for the gzip magic, accepts a candidate when it decodes to a WARC
header, and owns the records that start inside its range, reading past its end to finish
the last one.  So one large archive is read by many tasks.

Of records with equal payloads of at least ``min_bytes``, the one with the largest page_id
holds the payload and the others are revisits of it; grouping is by SHA-256 of the payload,
combined before the shuffle, and only groups of several pages are joined back.

Defined results: a null html is an empty payload; a null url gives no target URI; rows
without page_id are always responses; rows that share the largest page_id of a group are
all responses; an empty table gives an empty manifest and no records; a member that starts
like a record but does not decode to its end is an error, not a skipped record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import shuffle_partitions, written

MAGIC = b"\x1f\x8b\x08"
STEP = 1 << 18
MANIFEST = "path string, bytes long, records long"
RECORDS = "path string, start long, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def page_urn(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """One WARC record, not compressed; a revisit where ``refers_to`` is given."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", page_urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", page_urn(refers_to))]
    else:
        block += payload
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 1000, level: int = 4, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of (page_id, url, html); returns the manifest (path, bytes, records)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("sha"))
    groups = (pages.where(F.octet_length("html") >= min_bytes)
              .groupBy(F.sha2(F.col("html").cast("binary"), 256).alias("sha"))
              .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("sha", "last"))
    plan = (rows.join(written(groups, "warc-groups"), "sha", "left")
            .select("page_id", "url", "html", F.when(F.col("page_id") < F.col("last"), F.col("last")).alias("refers_to")))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for page_id, url, text, refers_to in zip(*(batch.column(i) for i in range(4))):
                if out is None:
                    filesystem, place = _open(folder)
                    filesystem.create_dir(place, recursive=True)
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = filesystem.open_output_stream(f"{place}/{name}", compression=None)
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = pack.compress(record(page_id.as_py(), url.as_py(), text.as_buffer().to_pybytes(), refers_to.as_py(), date)) + pack.flush()
                out.write(member)
                size, n = size + len(member), n + 1
        if out is not None:
            out.close()
            yield pa.record_batch([[f"{folder}/{name}"], [size], [n]], names=["path", "bytes", "records"])

    return written(plan.mapInArrow(store, MANIFEST), "warc-manifest")


def parse(raw: bytes) -> dict | None:
    """Fields and block of one decoded record; None if it isn't a whole WARC record."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/1."):
        return None
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    n = int(fields.get("Content-Length", -1))
    return {**fields, "block": rest[:n]} if 0 <= n <= len(rest) else None


def members(source, size: int, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the records of an archive that start in [start, end)."""
    source.seek(start)
    held = source.read(min(end + len(MAGIC) - 1, size) - start)
    at = start
    while (found := held.find(MAGIC, at - start)) >= 0 and start + found < end:
        at = start + found
        raw, used = _member(source, held, start, at)
        if raw is None:
            at += 1
            continue
        yield at, raw
        at += used


def _member(source, held: bytes, start: int, at: int) -> tuple[bytes | None, int]:
    """The decoded member at offset ``at`` and its length; None if no record starts there."""
    unpack, parts, fed, got = zlib.decompressobj(31), [], 0, 0
    while not unpack.eof:
        lo = at - start + fed
        data = held[lo:lo + STEP]
        if not data:
            source.seek(at + fed)
            data = source.read(STEP)
        try:
            part = unpack.decompress(data)
        except zlib.error:
            data, part = b"", b""
        parts.append(part)
        got, fed = got + len(part), fed + len(data)
        if got >= 7 and not b"".join(parts[:2])[:7] == b"WARC/1.":
            return None, 0
        if not data:
            if got >= 7:
                raise ValueError(f"the WARC record at byte {at} does not decode to its end")
            return None, 0
    raw = b"".join(parts)
    return (raw, fed - len(unpack.unused_data)) if raw.startswith(b"WARC/1.") else (None, 0)


def read_archives(manifest: DataFrame, split_bytes: int = 8 << 20, payloads: bool = True) -> DataFrame:
    """Records of the archives in (path, bytes): see ``RECORDS``.

    ``payload_digest`` (hex) and ``payload_bytes`` are those of the full payload, for a
    revisit too, whose payload is null.  Payloads are checked against their digest;
    ``payloads=False`` leaves them out of the rows.
    """
    ranges = (manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
              .withColumn("end", F.least(F.col("start") + split_bytes, "bytes")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                filesystem, place = _open(part["path"])
                rows, held = [], 0
                with filesystem.open_input_file(place) as source:
                    for at, raw in members(source, part["bytes"], part["start"], part["end"]):
                        rows.append(_row(part["path"], at, raw, payloads))
                        held += len(rows[-1][-1] or b"") + 500
                        if held > split_bytes:
                            yield _batch(rows)
                            rows, held = [], 0
                yield _batch(rows)

    # a range is a task's work: without a deal of its own the small table of ranges is one task
    return ranges.repartition(shuffle_partitions(manifest), "path", "start").mapInArrow(scan, RECORDS)


def _row(path: str, at: int, raw: bytes, payloads: bool) -> tuple:
    r = parse(raw)
    if r is None:
        raise ValueError(f"{path}: the record at byte {at} is not whole")
    http, _, payload = r["block"].partition(b"\r\n\r\n")
    n = int(next(v for k, v in (x.split(b": ", 1) for x in http.split(b"\r\n")[1:]) if k == b"Content-Length"))
    digest = base64.b32decode(r["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    whole = r["WARC-Type"] == "response"
    if whole and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{path}: the payload at byte {at} does not match its digest")
    return path, at, r["WARC-Type"], r["WARC-Record-ID"], r.get("WARC-Target-URI"), r.get("WARC-Refers-To"), digest, n, payload if whole and payloads else None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pa.record_batch([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)


def page_of(urn):
    """The page_id in a record id column made by ``page_urn``."""
    return F.regexp_extract(urn, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
