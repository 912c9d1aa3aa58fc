"""WARC archives: writing with segments, and reassembly of what is read back.

Each page is an HTTP response whose body is framed in chunks (chunked transfer encoding). A
block longer than ``SEGMENT`` bytes is cut into a first record and continuation records, which carry
the first record's id (WARC-Segment-Origin-ID), their number, and the last one the total length.
A task deals a record's segments over its open files in turn, so they lie in several files. Pages whose payload
equals that of a smaller page_id are written as revisit records without a body.

The reader scans files record by record, groups records by origin id, orders them by segment number,
checks that no number is missing and that the lengths add up to the total, joins the block, undoes the
chunk framing and checks the payload digest.

Files have random names and count only by their row in the manifest, so a task that runs twice leaves
an unused file and no double record.

Cases: null html is an empty payload, and empty payloads are equal to each other. A null page_id is written without a
page header and read back as null; its payload neither revisits nor is revisited. Rows that repeat a page_id with the same
payload are records of their own, all of the type of that page. An empty table writes no file. Very long payloads are cut into segments. Further columns
of any name are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from hangtally.llm.common import batch, prepare, stored
from hangtally.llm.seekable import filesystem
from hangtally.session import scratch_path

#: Bytes of a block from which it is segmented, bytes of a transfer chunk, bytes of a file from which a new one is begun.
SEGMENT, CHUNK, FILE_BYTES = 16_384, 4_096, 128 << 20
#: Files that a task has open at once.
FILES = 2
MANIFEST = "file string, bytes bigint, records bigint"
RECORD = ("record_id string, record_type string, page_id bigint, uri string, digest string, refers_to bigint, "
          "segment int, origin string, total bigint, length bigint, block binary")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(body: bytes) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (body[i:i + CHUNK] for i in range(0, len(body), CHUNK))]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(framed: bytes) -> bytes:
    """The body of a chunked message; extensions and trailers are read over."""
    out, at = [], 0
    while True:
        line = framed.index(b"\r\n", at)
        size = int(framed[at:line].split(b";")[0].strip(), 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        out.append(framed[at:at + size])
        if len(out[-1]) != size or framed[at + size:at + size + 2] != b"\r\n":
            raise ValueError("broken chunk")
        at += size + 2


def http_body(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    plain = b"transfer-encoding: chunked" not in head.lower()
    return body if plain else dechunked(body)


def header_text(value: str) -> str:
    """Header values can't hold line ends."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def plain_text(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_bytes(row: dict) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if row["page_id"] is not None:
        head.append(f"WARC-Page-ID: {row['page_id']}")
    if row["uri"] is not None:
        head.append(f"WARC-Target-URI: {header_text(row['uri'])}")
    if row["digest"]:
        head.append(f"WARC-Payload-Digest: sha1:{row['digest']}")
    if row["refers_to"] is not None:
        head.append(f"WARC-Refers-To-Page-ID: {row['refers_to']}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    if row["segment"]:
        head.append(f"WARC-Segment-Number: {row['segment']}")
    if row["segment"] and row["segment"] > 1:
        head.append(f"WARC-Segment-Origin-ID: <{row['origin']}>")
    if row["total"] is not None:
        head.append(f"WARC-Segment-Total-Length: {row['total']}")
    head.append(f"WARC-Payload-Length: {row['length']}")
    head.append("Content-Type: application/http; msgtype=response" if row["segment"] in (0, 1) else "Content-Type: application/octet-stream")
    head.append(f"Content-Length: {len(row['block'])}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + row["block"] + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    h = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    size = int(h["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record length is wrong")

    def number(name):
        return int(h[name]) if name in h else None

    own = h["warc-record-id"].strip("<>")
    return {"record_id": own, "record_type": h["warc-type"], "page_id": number("warc-page-id"),
            "uri": plain_text(h["warc-target-uri"]) if "warc-target-uri" in h else None,
            "digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None, "refers_to": number("warc-refers-to-page-id"),
            "segment": number("warc-segment-number") or 0, "origin": h.get("warc-segment-origin-id", own).strip("<>"),
            "total": number("warc-segment-total-length"), "length": number("warc-payload-length"), "block": rest[:size]}


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The contents of a file's gzip members, one record each, holding one record at a time."""
    data, unzip, out = b"", zlib.decompressobj(31), []
    while True:
        if not data:
            data = stream.read(size)
            if not data:
                if out:
                    raise ValueError("truncated file")
                return
        out.append(unzip.decompress(data))
        data = b""
        if unzip.eof:
            data = unzip.unused_data
            yield b"".join(out)
            unzip, out = zlib.decompressobj(31), []


def planned(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with payload (binary), digest (of hex), copy number and refers_to."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload")).withColumn("hex", F.sha1("payload"))
    narrow = rows.where(f"page_id is not null and octet_length(payload) >= {least_bytes}").select("page_id", "hex")
    first = narrow.groupBy("hex").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last").drop("last")
    later = narrow.join(first, "hex").where("page_id > first").select(F.col("page_id").alias("_p"), F.col("hex").alias("_h"), F.col("first").alias("refers_to")).distinct()
    # stored first: with its size known, Spark sends few revisits to the pages instead of shuffling the pages
    later = stored(later, "warc-revisits")
    joined = rows.join(later, (F.col("page_id") == F.col("_p")) & (F.col("hex") == F.col("_h")), "left").drop("_p", "_h")
    return joined


def write(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes one archive record per page and its continuations; returns the stored manifest of files."""
    spark = pages.sparkSession
    prepare(spark)
    folder = scratch_path(spark, "warc")
    schema = to_arrow_schema(_parse_datatype_string(MANIFEST))

    def records(page, uri, payload: bytes, refers) -> list[dict]:
        own = uuid.uuid4().urn
        base = {"page_id": page, "uri": uri, "digest": base32_sha1(payload), "refers_to": refers, "length": len(payload)}
        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        if refers is not None:
            return [base | {"record_id": own, "record_type": "revisit", "segment": 0, "origin": own, "total": None, "block": head + b"\r\n"}]
        block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
        cuts = range(0, len(block), SEGMENT)
        several = len(cuts) > 1
        return [base | {"record_id": own if k == 0 else uuid.uuid4().urn, "record_type": "response" if k == 0 else "continuation",
                        "segment": k + 1 if several else 0, "origin": own, "total": len(block) if several and k == len(cuts) - 1 else None,
                        "block": block[i:i + SEGMENT]} for k, i in enumerate(cuts)]

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        open_files: list = [None] * FILES
        done = []

        def close(k):
            name, out, size, count = open_files[k]
            out.close()
            done.append((f"{folder}/{name}", size, count))
            open_files[k] = None

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                for n, record in enumerate(records(*row)):
                    k = n % FILES
                    if open_files[k] is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        open_files[k] = [name, fs.open_output_stream(f"{base}/{name}", compression=None), 0, 0]
                    data = gzip.compress(record_bytes(record), compresslevel=1, mtime=0)
                    open_files[k][1].write(data)
                    open_files[k][2] += len(data)
                    open_files[k][3] += 1
                    if open_files[k][2] >= FILE_BYTES:
                        close(k)
        for k in range(FILES):
            if open_files[k] is not None:
                close(k)
        yield batch(schema, *(zip(*done) if done else [[]] * 3))

    # record ids and file names are random: a task that runs again writes new files, and the manifest names only one run's
    return stored(planned(pages, least_bytes).select("page_id", "url", "payload", "refers_to").mapInArrow(files, MANIFEST), "warc-manifest")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The records of the files of a manifest, as they stand (columns of ``RECORD``)."""
    prepare(spark)
    schema = to_arrow_schema(_parse_datatype_string(RECORD))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, name = filesystem(uri)
                some, size = [], 0
                with fs.open_input_stream(name, compression=None) as f:
                    for data in members(f):
                        some.append(parsed(data))
                        size += len(data)
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(some, schema)
                            some, size = [], 0
                if some:
                    yield pa.RecordBatch.from_pylist(some, schema)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file").repartition(n, "file").mapInArrow(work, RECORD)


def reassembled(records: DataFrame) -> DataFrame:
    """One row per page: page_id, uri, record_type, refers_to, digest, length, payload (null for revisits).

    A group is one record's segments, so it is as long as that record. Records that lack a segment, or
    whose lengths or digest don't fit, raise an error.
    """
    prepare(records.sparkSession)
    first = F.min_by(F.struct("record_type", "page_id", "uri", "refers_to", "digest", "length"), "segment").alias("r")
    groups = records.groupBy("origin").agg(first, F.array_sort(F.collect_list(F.struct("segment", "total", "block"))).alias("parts"))
    out = "page_id bigint, uri string, record_type string, refers_to bigint, digest string, length bigint, payload binary"
    schema = to_arrow_schema(_parse_datatype_string(out))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 100):
                made = []
                for row in b.slice(at, 100).to_pylist():
                    r, parts = row["r"], row["parts"]
                    block = b"".join(p["block"] for p in parts)
                    numbers = [p["segment"] for p in parts]
                    if numbers != [0] and (numbers != list(range(1, len(parts) + 1)) or parts[-1]["total"] != len(block)):
                        raise ValueError(f"segments of {row['origin']} are not complete")
                    payload = None
                    if r["record_type"] != "revisit":
                        payload = http_body(block)
                        if len(payload) != r["length"] or base32_sha1(payload) != r["digest"]:
                            raise ValueError(f"payload of {row['origin']} is damaged")
                    made.append({k: r[k] for k in ("page_id", "uri", "record_type", "refers_to", "digest", "length")} | {"payload": payload})
                yield pa.RecordBatch.from_pylist(made, schema)

    return groups.select("origin", "r", "parts").mapInArrow(work, out)


def report(pages_read: DataFrame) -> DataFrame:
    return pages_read.selectExpr("page_id", "length as payload_bytes", "digest as payload_digest", "record_type", "refers_to")
