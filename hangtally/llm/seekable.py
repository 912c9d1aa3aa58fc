"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A file holds one frame per document (its ids, little-endian unsigned 32-bit, the end id last), then
a skippable frame with the documents' ids, then the seek table: a skippable frame whose entries
give each frame's compressed size, decompressed size and checksum (low 32 bits of XXH64 of the
content), and whose footer holds the number of frames. This is the public seekable zstandard
layout, so other readers can use the files. A reader fetches the table from the file's end and then
only the frames of the documents it wants, and verifies their checksums.

Files are named at random and become part of the data by their row in the returned manifest, so a
task that runs twice leaves an unused file and never a double document.

Cases: null text is an empty document, which still has its end id. A null doc_id comes first.
Repeated rows are stored repeatedly, in the order of their text. An empty table writes no file. A text of any length is one frame.
Further columns of any name are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from hangtally.llm.common import batch, prepare, stored
from hangtally.llm.words import Memo, Splitter, byte_letters
from hangtally.session import scratch_path

INDEX_MAGIC, TABLE_MAGIC, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1   # fixed values of the format
_ENTRY, _FOOT = struct.Struct("<III"), struct.Struct("<IBI")
MANIFEST = "part int, seq int, file string, docs bigint, ids bigint, first_doc bigint, last_doc bigint"
#: Documents after which a task begins its next file. It bounds the seek table in memory and what a reader fetches of it.
FILE_DOCS = 20_000


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class FrameWriter:
    def __init__(self, file):
        self.file, self.table, self.docs = file, [], []
        self._zip = zstandard.ZstdCompressor(level=1, write_content_size=True)

    def add(self, doc: int | None, data: bytes) -> None:
        frame = self._zip.compress(data)
        self.file.write(frame)
        self.table.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.docs.append(doc)

    def close(self) -> None:
        n = len(self.docs)
        known = np.array([d is not None for d in self.docs], np.uint8)
        ids = np.array([d or 0 for d in self.docs], "<i8")
        index = struct.pack("<Q", n) + known.tobytes() + ids.tobytes()
        self.file.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.table.append((len(index) + 8, 0, 0))
        body = b"".join(_ENTRY.pack(*e) for e in self.table) + _FOOT.pack(len(self.table), 0x80, SEEK_MAGIC)
        self.file.write(struct.pack("<II", TABLE_MAGIC, len(body)) + body)
        self.file.close()


class FrameReader:
    """Random access to one file; ``place`` k is the k-th document."""

    def __init__(self, file):
        self.file, self._unzip = file, zstandard.ZstdDecompressor()
        size = file.size()
        frames, flags, magic = _FOOT.unpack(self._at(size - _FOOT.size, _FOOT.size))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError("no seek table")
        body = self._at(size - _FOOT.size - frames * _ENTRY.size, frames * _ENTRY.size)
        self.table = np.frombuffer(body, "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        index = self._at(int(self.starts[-2]) + 8, int(self.table[-1, 0]) - 8)
        n = struct.unpack_from("<Q", index)[0]
        known = np.frombuffer(index, np.uint8, n, 8)
        self.docs = [int(d) if k else None for d, k in zip(np.frombuffer(index, "<i8", n, 8 + n), known)]
        self.lengths = self.table[:n, 1] // 4

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        data = self.file.read(size)
        if len(data) != size:
            raise ValueError("truncated file")
        return data

    def read(self, place: int) -> bytes:
        data = self._unzip.decompress(self._at(int(self.starts[place]), int(self.table[place, 0])), max_output_size=int(self.table[place, 1]))
        if len(data) != self.table[place, 1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[place, 2]:
            raise ValueError(f"frame {place} is damaged")
        return data


class LibraryWords:
    """Whole texts as the public library encodes them; each distinct word goes through it once."""

    def __init__(self, path: str):
        self.splitter = Splitter(path)
        # a word has been through the normaliser and pre-tokenizer already, so it goes to the library's model
        tokenize, letters = self.splitter.tokenizer.model.tokenize, [byte_letters()[b] for b in range(256)]
        self._known = Memo(lambda w: np.array([t.id for t in tokenize("".join(map(letters.__getitem__, w.encode())))], "<u4").tobytes(), 500_000)
        self._special = {s: np.array([i], "<u4").tobytes() for s, i in self.splitter.special.items()}

    def encode(self, text: str) -> bytes:
        out = []
        for k, part in enumerate(self.splitter.parts(text)):
            if k % 2:
                out.append(self._special[part])
            elif part:
                out.extend(map(self._known.__getitem__, self.splitter.words(part)))
        return b"".join(out)


_LOADED: dict[str, LibraryWords] = {}


def _encoder(path: str):
    if path not in _LOADED:
        _LOADED[path] = LibraryWords(path)
    return _LOADED[path].encode


def forget_encoders() -> None:
    _LOADED.clear()


def write_ids(docs: DataFrame, path: str, end_id: int, files: int | None = None) -> DataFrame:
    """Encodes whole texts and writes them in ascending doc_id order; returns the stored manifest.

    The texts are dealt by ranges of doc_id, and a range is written as files of ``FILE_DOCS`` documents, so memory holds one
    batch of rows and one seek table. ``files`` is the number of ranges (default: the session's shuffle partitions).
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = scratch_path(spark, "token-ids")
    schema = to_arrow_schema(_parse_datatype_string(MANIFEST))
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, fs, out, part, seq = _encoder(path), None, None, TaskContext.get().partitionId(), 0

        def closed() -> pa.RecordBatch:
            out.close()
            return batch(schema, [part], [seq], [f"{folder}/{name.rsplit('/', 1)[1]}"], [len(out.docs)], [total], [next((d for d in out.docs if d is not None), None)], [out.docs[-1]])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if out is not None and len(out.docs) >= FILE_DOCS:
                    yield closed()
                    out, seq = None, seq + 1
                if out is None:
                    if fs is None:
                        fs, base = filesystem(folder)
                        fs.create_dir(base, recursive=True)
                    name = f"{base}/{uuid.uuid4().hex}.zst"
                    out, total = FrameWriter(fs.open_output_stream(name, compression=None)), 0
                data = encode(text or "") + end
                total += len(data) // 4
                out.add(doc, data)
        if out is not None:
            yield closed()

    ranges = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select("doc_id", "text").repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(dealt.mapInArrow(work, MANIFEST), "token-manifest")


def read_ids(manifest: DataFrame, wanted: DataFrame | None = None, slice_docs: int = 2000) -> DataFrame:
    """Rows (doc_id, start, ids) of the stored documents; ``start`` counts the ids of all documents before.

    With ``wanted`` (a column doc_id, nulls ignored), only those documents' frames are decompressed: the manifest, one row per
    file, says which files can hold them, and the seek tables where. Ids meet files in equal stretches of the range of ids.
    """
    # one row per file: a running sum over the files, not over documents
    files = manifest.selectExpr("*", "coalesce(sum(ids) over (order by part, seq rows between unbounded preceding and 1 preceding), 0) as base").drop("part", "seq")
    if wanted is not None:
        low, high, n = manifest.agg(F.min("first_doc"), F.max("last_doc"), F.count("*")).first()
        low, wide = low or 0, max(1, ((high or 0) - (low or 0)) // max(1, n) + 1)
        ids = wanted.select("doc_id").where(f"doc_id between {low} and {high or 0}").distinct().withColumn("stretch", F.expr(f"(doc_id - {low}L) div {wide}L"))
        spread = files.where("last_doc is not null").withColumn("stretch", F.expr(
            f"explode(sequence((first_doc - {low}L) div {wide}L, (last_doc - {low}L) div {wide}L))"))
        slices = (spread.join(ids, "stretch").where("doc_id between first_doc and last_doc")
                  .groupBy("file", "base").agg(F.collect_set("doc_id").alias("only"), F.first("docs").alias("docs")))   # no more than a file's documents
    else:
        slices = files.selectExpr("file", "base", "cast(null as array<bigint>) as only", "docs")
    slices = slices.selectExpr("file", "base", f"explode(sequence(0, if(only is null, (docs - 1) div {slice_docs}, 0))) as part", "only")
    out = "doc_id bigint, start bigint, ids binary"
    schema = to_arrow_schema(_parse_datatype_string(out))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()   # a worker that wrote files before needs its words no more
        for b in batches:
            for row in b.to_pylist():
                fs, name = filesystem(row["file"])
                with fs.open_input_file(name) as f:
                    r = FrameReader(f)
                    starts = row["base"] + np.concatenate([[0], np.cumsum(r.lengths)])
                    low = row["part"] * slice_docs
                    places = range(low, min(low + slice_docs, len(r.docs)))
                    if row["only"] is not None:
                        only = set(row["only"])
                        places = [p for p, d in enumerate(r.docs) if d in only]
                    for at in range(0, len(places), 250):
                        some = places[at:at + 250]
                        yield batch(schema, [r.docs[p] for p in some], [int(starts[p]) for p in some], [r.read(p) for p in some])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return slices.repartition(n, "file", "part").mapInArrow(work, out)


def digests(stored_ids: DataFrame) -> DataFrame:
    return stored_ids.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
