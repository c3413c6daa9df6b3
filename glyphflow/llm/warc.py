"""WARC archives: one gzip member per record, revisit records for equal payloads, and a sequential reader that checks all.

Writing takes one shuffle of the pages, by digest and salt, so that a payload that a third of the pages have is dealt over
SALTS tasks. A task writes files of its own under names that no other attempt uses; the manifest, committed by Spark's
own writer, lists the files of the attempts that counted. The reader holds one record at a time.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import reader, writer
from .shared import new_folder, written

#: Smaller equal payloads are all stored.
LEAST_REVISIT = 100
SALTS = 16
FILE_BYTES = 256 << 20
#: What follows a record in a block is copied, so blocks are small.
BLOCK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """A record that is not framed or digested as its header says."""


def member(page_id: str | None, url: str | None, payload: bytes, digest: str, refers: str | None, revisit: bool) -> bytes:
    """One record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]')}")
    if page_id is not None:
        head.append(f"X-Page-ID: {quote(page_id)}")
    if revisit:
        head.append(f"WARC-Profile: {PROFILE}")
        if refers is not None:
            head.append(f"X-Refers-To-Page-ID: {quote(refers)}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(source) -> Iterator[bytes]:
    """The unpacked members of a gzip file that is read block by block."""
    rest, unpack, parts = b"", zlib.decompressobj(31), []
    while True:
        data = rest or source.read(BLOCK)
        if not data:
            if parts:
                raise WarcError("the file ends inside a record")
            return
        parts.append(unpack.decompress(data))
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []


def parsed(record: bytes) -> dict:
    """Header, payload and what the header says of it; WarcError if framing or a digest is wrong."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not blank or not lines[0].startswith("WARC/"):
        raise WarcError("no record header")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError("the block is not as long as Content-Length")
    block = rest[:size]
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise WarcError("wrong block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    digest, n = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(stated["Content-Length"])
    if fields["WARC-Type"] == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
        raise WarcError("wrong payload length or digest")
    page_id, refers = (None if (x := fields.get(f)) is None else unquote(x) for f in ("X-Page-ID", "X-Refers-To-Page-ID"))
    return {"page_id": page_id, "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "payload": payload, "payload_bytes": n, "payload_digest": digest, "refers_to": refers}


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the archives and returns their manifest (file, n_records, n_bytes), itself written to the shared folder.

    Null html is an empty payload; null urls and ids leave out their header. Of equal rows one is the response.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"), body.alias("body"), F.sha2(body.cast("binary"), 256).alias("digest"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    first = rows.where(F.octet_length("body") >= LEAST_REVISIT).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("digest").alias("d"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    rows = rows.repartition("digest", "salt")
    rows = rows.join(first, (rows["digest"] == first["d"]) & (rows["salt"] == first["s"]), "left").select(F.col("id").cast("string").alias("id"), "url", "body", "digest", F.col("d").isNotNull().alias("copied"), F.col("first").cast("string").alias("first"))
    rows = rows.sortWithinPartitions("digest", "id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, n, size, last, done = None, "", 0, 0, None, []

        def close():
            out.close()
            done.append((name, n, size))

        for batch in batches:
            for id_, link, text, digest, copied, least in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        close()
                    name, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = writer(name)
                revisit = copied and (id_ != least or last == (id_, digest))
                last = (id_, digest)
                data = member(id_, link, text.encode(), digest, least if revisit else None, revisit)
                out.write(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"file": [x[0] for x in done], "n_records": [x[1] for x in done], "n_bytes": [x[2] for x in done]}, pa.schema([("file", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    return written(rows.mapInArrow(write, "file string, n_records long, n_bytes long"), "warc-manifest")


def read_warc(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the archives in a manifest, each checked; with payload as binary if asked for. A task reads a file at a time."""
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string" + ", payload binary" * payloads
    names = [x.split()[0] for x in schema.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, n in zip(frame["file"], frame["n_records"], strict=True):
                rows, held, seen = [], 0, 0
                with reader(name) as source:
                    for record in members(source):
                        x = parsed(record)
                        rows.append([x[k] for k in names])
                        seen, held = seen + 1, held + (len(record) if payloads else 100)
                        if held > 16 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                if seen != n:
                    raise WarcError(f"{name}: {seen} records, {n} were written")
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = max(1, manifest.count())
    return manifest.repartition(files).mapInPandas(read, schema)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to as read back from archives of all pages.

    Null html is an empty payload; rows without an id have none; of equal rows one is the response. No pages give no rows.
    Other columns of pages are not looked at, whatever their names.
    """
    kind = pages.schema["page_id"].dataType
    back = read_warc(write_warc(pages, new_folder(spark, "warc")))
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
