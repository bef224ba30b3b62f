"""WARC archives written and read as Spark jobs.

Every record is a gzip member of its own.  Writers run in the tasks that hold the pages and put
archives into shared storage; a task that fails leaves a file that no manifest names.  Readers
stream an archive from front to back: incremental decompression, framing by Content-Length,
digests compared record by record.  One record is in memory at a time.

Of pages with equal payloads the one with the largest page_id is stored, the others revisit it.
Defined cases: null html is an empty payload; a null page_id revisits like any other page and is
a response only if no equal page has an id; rows that repeat a page_id and its payload are all
responses if that id is the largest; a null url has no target; an empty table makes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.batches import pieces
from roadpulse.sources.storage import new_path, stage

#: An archive is closed beyond this many compressed bytes.
ARCHIVE_BYTES = 64 << 20
#: Smallest payload that is stored once only.
MIN_REVISIT_BYTES = 0
WRITTEN_AT = "2024-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 16
_MANIFEST = "path string, records long, bytes long"
_RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "digest_ok boolean, payload binary, path string"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(field: str | None) -> int | None:
    number = (field or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One gzip member: version line, fields, block."""
    lines = [f"{k}: {v}" for k, v in fields if v is not None] + [f"Content-Length: {len(block)}"]
    head = "\r\n".join(["WARC/1.1", *lines, "", ""]).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or with ``refers_to`` a revisit, which keeps the HTTP head but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    return record(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", _id(page_id)),
            ("WARC-Date", WRITTEN_AT),
            ("WARC-Target-URI", None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")),
            ("WARC-Profile", IDENTICAL if revisit else None),
            ("WARC-Refers-To", _id(refers_to) if revisit else None),
            ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
            ("WARC-Block-Digest", f"sha1:{digest(block)}"),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        block,
    )


def with_originals(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, and ``refers_to``: the page that stores an equal payload, null if it is this one.

    Only payloads that occur twice are joined back; a payload on a third of all pages is one row there.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    base = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha2("payload", 256))
    twice = (
        base.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sha", "original")
    )
    # Written, so that the join knows the size of this side before it deals out payloads.
    joined = base.join(stage(twice, "equal-payloads"), "sha", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("original")), F.col("original"))
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write archives into ``folder``, a path or URI all executors reach; returns the manifest (path, records, bytes)."""
    root = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pa.fs.FileSystem.from_uri(root)
        out, done, path, records, size = None, [], "", 0, 0
        for piece in pieces(batches, "payload"):
            for row in piece.to_pylist():
                if out is None:
                    files.create_dir(base, recursive=True)
                    path, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{base}/{path}", compression=None)
                    size += out.write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", WRITTEN_AT), ("WARC-Filename", path), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                size += out.write(page_record(row["page_id"], row["url"], row["payload"], row["refers_to"]))
                records += 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        for path, records, size in done:
            yield pa.RecordBatch.from_pydict({"path": [f"{root}/{path}"], "records": [records], "bytes": [size]})

    return stage(with_originals(pages, min_bytes).mapInArrow(run, _MANIFEST), "warc-manifest")


def members(stream: BinaryIO) -> Iterator[bytearray]:
    """Contents of the gzip members of a stream, decompressed as they are read."""
    waiting = b""
    while waiting or (waiting := stream.read(_CHUNK)):
        unpacker, content = zlib.decompressobj(31), bytearray()
        while not unpacker.eof:
            if not waiting and not (waiting := stream.read(_CHUNK)):
                raise ValueError("archive ends inside a record")
            content += unpacker.decompress(waiting)
            waiting = unpacker.unused_data
        yield content


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields, by lower-case name, and block of each record; raises on broken framing."""
    for content in members(stream):
        end = content.find(b"\r\n\r\n")
        version, *lines = bytes(content[: max(end, 0)]).decode().split("\r\n")
        if end < 0 or not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if bytes(content[stop:]) != b"\r\n\r\n":
            raise ValueError("Content-Length does not frame the record")
        yield fields, bytes(content[start:stop])


def page_of(fields: dict[str, str], block: bytes, path: str, payloads: bool) -> dict:
    """A response or revisit as a row; its digests are compared."""
    head, _, payload = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    said = fields["warc-payload-digest"].removeprefix("sha1:")
    ok = fields["warc-block-digest"] == f"sha1:{digest(block)}"
    revisit = fields["warc-type"] == "revisit"
    if not revisit:
        ok = ok and said == digest(payload) and int(http["content-length"]) == len(payload)
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": int(http["content-length"]),
        "payload_digest": said,
        "digest_ok": ok,
        "payload": payload if payloads and not revisit else None,
        "path": path,
    }


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per response or revisit record of the archives in ``manifest``; an archive is read by one task."""
    schema = T.StructType.fromDDL(_RECORDS)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, place = pa.fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with files.open_input_stream(place, compression=None) as stream:
                    for fields, block in records(stream):
                        if fields["warc-type"] not in ("response", "revisit"):
                            continue
                        rows.append(page_of(fields, block, path, payloads))
                        held += 200 + payloads * len(block)
                        if held > 1 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=arrow)

    archives = max(1, manifest.count())
    return manifest.select("path").repartition(archives, "path").mapInArrow(run, schema)


def archive_report(pages: DataFrame) -> DataFrame:
    """Pages through archives in shared storage and back; a record whose digest is wrong raises."""
    manifest = write_archives(pages, new_path(pages.sparkSession, "warc"))
    back = read_archives(manifest, payloads=False)
    checked = F.when(F.col("digest_ok"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("wrong digest in "), "path")))
    return back.select("page_id", "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to")


#: The same rows in DuckDB: SHA-1 hex as bits, five bits a letter.
SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages
), originals AS (
  SELECT x, max(page_id) AS original FROM hashed GROUP BY x
), bits AS (
  SELECT h.page_id, h.payload_bytes, o.original, h.x,
         list_aggregate([lpad(bin(CAST('0x' || h.x[i] AS INT)), 4, '0') FOR i IN range(1, 41)], 'string_agg', '') AS b
  FROM hashed h JOIN originals o USING (x)
), letters AS (
  SELECT *, list_aggregate(['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum([(1 << (4 - j)) * CAST(b[5 * i + j + 1] AS INT) FOR j IN range(0, 5)])::INT] FOR i IN range(0, 32)], 'string_agg', '') AS d
  FROM bits
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM letters
"""
