"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of ``WINDOW`` bytes covers it that also starts earlier. Texts are first cut
into contexts that can be judged apart: of the ``WINDOW - ANCHOR + 1`` anchors (``ANCHOR``-byte
strings) inside a window the one with the least hash is the window's anchor, so equal windows have
equal anchors in the same place, and the windows of one anchor occurrence form one context (a run
of window starts). Windows of an anchor that occurs once are unique. Of equal contexts the earliest
stands for all; all windows of the others are repeats. What remains are anchors with several
different contexts, the edges of the repeats. They are judged in buckets of anchors. Contexts of one
anchor count as equal when their 64-bit digests agree: n different contexts of an anchor give about
n^2 / 2^65 false equals, 2.4e-7 for three million. A bucket is judged thus:

Each shard of a bucket gets a Burrows-Wheeler transform over symbols of ``STRIDE`` bytes: its suffixes
in order, and for each the symbol before it. The shards are merged without sorting their suffixes
again: an interleave vector says which shard the next suffix comes from; taking the symbols through
it and dealing them out stably by symbol gives the interleave that is right for one symbol more.
Where neighbours part in a round is where their common prefix ends, so after ``WINDOW / STRIDE``
rounds the runs that never parted are the repeated intervals of at least ``WINDOW`` bytes. Symbols
are compared by their 64-bit hashes; any order serves, as only equality of prefixes matters.

An anchor with more than ``HOT`` different contexts is judged window by window with partial
aggregation instead, so no task ever holds an unbounded group.

Cases: null text is empty. Texts shorter than the window keep all. Order is (doc_id, start), null
doc_ids last; rows that share a doc_id are one document to that order (none of them is earlier
than another at the same start) and are told apart by a 16-bit digest of their text when the spans
are applied. An empty table gives an empty result. Further columns of any name are not read, unless named to be kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from hangtally.llm.common import batch, frugal, prepare, rows_of, stored

WINDOW, ANCHOR, STRIDE = 100, 32, 25
#: Bytes of contexts that a task's rows aim at and that it judges at once, shards that are merged then, and contexts of
#: one anchor from which it is judged window by window.
PART_BYTES, BUCKET_BYTES, SHARDS, HOT = 6_000_000, 400_000, 4, 12_000
LAST = (1 << 63) - 1   # stands for a null doc_id

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _grams(a: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all ``size``-byte strings of an array of bytes, built up by doubling."""
    h, have, done, at = a.astype(np.uint64) + _U(1), 1, None, 0
    n = len(a) - size + 1
    while True:
        if size & have:   # this power of two is part of the size
            part = h[at:at + n]
            done = part.copy() if done is None else _mixed(done * _U(0xD6E8FEB86659FD93) + part)
            at += have
        if have * 2 > size:
            return done
        x = h[:-have] * _U(0x9E3779B97F4A7C15)
        x ^= x >> _U(29)
        h, have = x + h[have:] * _U(0xA24BAED4963EE407), have * 2


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum."""
    n, have = len(h) - width + 1, 1
    while have * 2 <= width:
        h, have = np.minimum(h[:-have], h[have:]), have * 2
    return np.minimum(h[:n], h[width - have:width - have + n])


def contexts_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window start, last window start) of a text's contexts, in order."""
    h = _mixed(_grams(np.frombuffer(data, np.uint8), ANCHOR))
    low = _least(h, WINDOW - ANCHOR + 1)
    # the leftmost of equal hashes counts; a context ends where the least hash changes or its anchor leaves the window
    first = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (h[:len(low) - 1] == low[:-1])]))
    return low[first], first, np.concatenate([first[1:], [len(low)]]) - 1


def _tag(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) & 0xFFFF


def _pack(tag, start, last):
    """start (40 bits), last - start (8 bits, always below WINDOW), tag (16 bits); ordered by start."""
    return (start << 24) | ((last - start) << 16) | tag


def _occurrences(docs: DataFrame) -> DataFrame:
    """Contexts of all texts: anchor, digest of the context, document, place (packed)."""
    out = "anchor bigint, context bigint, doc bigint, place bigint"
    schema = to_arrow_schema(_parse_datatype_string(out))

    @frugal
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                made = [[], [], [], []]
                for doc, data in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    if data is None or len(data) < WINDOW:
                        continue
                    h, first, last = contexts_of(data)
                    made[0].append(h.view(np.int64))
                    made[1].append(np.array([digest(data[i:j]) for i, j in zip(first.tolist(), (last + WINDOW).tolist())], np.uint64).view(np.int64))
                    made[2].append(np.full(len(h), LAST if doc is None else doc))
                    made[3].append(_pack(_tag(data), first, last))
                if made[0]:
                    yield batch(schema, *map(np.concatenate, made))

    return docs.select("doc_id", "text").mapInArrow(work, out)


def bwt(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Burrows-Wheeler transform of a shard over symbols of STRIDE bytes.

    Returns (text number, start) of the suffixes in order, the symbol before each, and how many
    suffixes are empty ends (shorter than a symbol); these come first, each with an end mark of its
    own. A suffix at the begin of its chain of symbols has no symbol before it: 0 stands for that.
    """
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)   # one place more per text: the empty suffix
    text = np.repeat(np.arange(len(texts)), size + 1)
    start = np.arange(len(joined)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    whole = start + STRIDE <= size[text]
    sym = np.zeros(len(joined), np.uint64)
    if len(joined) >= STRIDE:
        grams = _mixed(_grams(joined, STRIDE)) | _U(1)
        sym[:len(grams)] = grams
    sym[~whole] = 0
    # ranks by one symbol, then by two, four, ... symbols; ends get ranks of their own, below all others
    ends = np.flatnonzero(~whole)
    body = np.flatnonzero(whole)
    rank = np.empty(len(joined), np.int64)
    rank[ends] = np.arange(len(ends))
    rank[body] = np.unique(sym[body], return_inverse=True)[1] + len(ends)
    step = STRIDE
    longest = int(size.max(initial=0))
    live = body
    while step < longest and len(live):
        following = live + step
        inside = start[live] + step <= size[text[live]]
        live, following = live[inside], following[inside]
        if not len(live):
            break
        order = np.lexsort((rank[following], rank[live]))
        a, f = rank[live][order], rank[following][order]
        # new ranks: place inside the old rank's group; groups without a following part sort before by construction
        apart = np.concatenate([[True], (a[1:] != a[:-1]) | (f[1:] != f[:-1])])
        group = np.concatenate([[True], a[1:] != a[:-1]])
        number = np.cumsum(apart)
        base = np.maximum.accumulate(np.where(group, number, 0))
        fine = np.zeros(len(joined), np.int64)
        fine[live[order]] = number - base + 1
        key = rank * (int(fine.max()) + 1) + fine
        rank = np.unique(key, return_inverse=True)[1]
        step *= 2
    order = np.argsort(rank, kind="stable")
    before = np.where(start >= STRIDE, sym[np.maximum(np.arange(len(joined)) - STRIDE, 0)], _U(0))[order]
    return text[order], start[order], before, len(ends)


def merged_runs(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges transforms by ``rounds`` refinements of their interleave.

    Returns, in merged order: the shard, the rank in the shard, and the number of the run of
    suffixes that share their first ``rounds`` symbols. Ends and chains that stop earlier stand alone.
    """
    sizes = [len(s[2]) for s in shards]
    source = np.concatenate([s[2] for s in shards])
    offset = np.cumsum([0, *sizes])
    ends = [s[3] for s in shards]
    kind = np.uint8 if len(shards) < 256 else np.uint32
    fixed = np.repeat(np.arange(len(shards), dtype=kind), ends)        # the ends, first and in the order of the shards
    body = np.repeat(np.arange(len(shards), dtype=kind), np.array(sizes) - ends)
    z = np.concatenate([fixed, body])                                  # the interleave that is right for no symbol
    run = np.zeros(len(z), np.int64)                                   # no symbol read: nothing has parted
    for _ in range(rounds):
        place = np.argsort(z, kind="stable")                           # where each shard's suffixes stand, in order
        symbol = np.empty(len(z), np.uint64)
        symbol[place] = source
        has = np.flatnonzero(symbol)
        dealt = has[np.argsort(symbol[has], kind="stable")]
        z = np.concatenate([fixed, z[dealt]])
        s, r = symbol[dealt], run[dealt]
        parts = np.concatenate([[True], (s[1:] != s[:-1]) | (r[1:] != r[:-1])]) if len(dealt) else np.empty(0, bool)
        run = np.concatenate([np.arange(len(fixed)), len(fixed) + np.cumsum(parts) - 1])
    place = np.argsort(z, kind="stable")
    rank = np.empty(len(z), np.int64)
    rank[place] = np.arange(len(z)) - np.repeat(offset[:-1], sizes)
    return z, rank, run


def repeated_starts(texts: list[bytes], order: np.ndarray) -> list[np.ndarray]:
    """For each text the starts of windows that an earlier window equals; ``order`` (text, 2): document and start of the text in it."""
    shards, members = [], []
    for k in range(SHARDS):
        own = np.arange(k, len(texts), SHARDS)
        if len(own):
            shards.append(bwt([texts[i] for i in own]))
            members.append(own)
    z, rank, run = merged_runs(shards, WINDOW // STRIDE)
    text, start = np.empty(len(z), np.int64), np.empty(len(z), np.int64)
    for k, (s, own) in enumerate(zip(shards, members)):
        at = z == k
        text[at], start[at] = own[s[0][rank[at]]], s[1][rank[at]]
    shared = np.bincount(run)[run] > 1
    text, start, run = text[shared], start[shared], run[shared]
    doc, place = order[text, 0], order[text, 1] + start
    by = np.lexsort((place, doc, run))
    text, start, run, doc, place = text[by], start[by], run[by], doc[by], place[by]
    head = np.concatenate([[True], run[1:] != run[:-1]])
    first = np.maximum.accumulate(np.where(head, np.arange(len(run)), 0))
    later = (doc != doc[first]) | (place != place[first])
    text, start = text[later], start[later]
    by = np.lexsort((start, text))
    text, start = text[by], start[by]
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    return [start[i:j] for i, j in zip(cut[:-1], cut[1:])]


SPAN = "doc bigint, tag int, low bigint, high bigint"


def _judged(contexts: DataFrame) -> DataFrame:
    """Spans of repeated windows in contexts (anchor, doc, tag, start, data), bucket by bucket."""
    spark = contexts.sparkSession
    contexts = stored(contexts, "repeat-contexts")
    many = contexts.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.octet_length("data")).alias("bytes"))
    hot = many.where(f"n > {HOT}").select("anchor")
    total = many.where(f"n <= {HOT}").agg(F.sum("bytes")).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    schema = to_arrow_schema(_parse_datatype_string(SPAN))

    def spans(bucket: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, docs, tags, starts, data = zip(*bucket)
        made = []
        for doc, tag, start, s in zip(docs, tags, starts, repeated_starts(data, np.array([docs, starts]).T)):
            if len(s):
                edge = np.flatnonzero(np.diff(s) > 1)
                low, high = s[np.concatenate([[0], edge + 1])], s[np.concatenate([edge, [len(s) - 1]])] + WINDOW
                made.extend((doc, tag, start + int(i), start + int(j)) for i, j in zip(low, high))
        if made:
            yield batch(schema, *zip(*made))

    @frugal
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, size = [], 0   # whole anchors, in their order
        for row in rows_of(batches):
            if size >= BUCKET_BYTES and row[0] != bucket[-1][0]:
                yield from spans(bucket)
                bucket, size = [], 0
            bucket.append(row)
            size += len(row[4])
        if bucket:
            yield from spans(bucket)

    cool = (contexts.join(hot, "anchor", "left_anti").repartition(parts, "anchor").sortWithinPartitions("anchor")
            .select("anchor", "doc", "tag", "start", "data").mapInArrow(work, SPAN))
    # windows of hot anchors: 0-based starts inside the context
    window = (contexts.join(hot, "anchor").withColumn("k", F.expr(f"explode(sequence(1, octet_length(data) - {WINDOW - 1}))"))
              .selectExpr("doc", "tag", "start + k - 1 as low", f"sha2(substr(data, k, {WINDOW}), 256) as window"))
    earliest = window.groupBy("window").agg(F.min(F.struct("doc", "low")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = window.join(earliest, "window").where("struct(doc, low) > first")
    return cool.union(later.selectExpr("doc", "tag", "low", f"low + {WINDOW} as high"))


def repeat_spans(docs: DataFrame) -> DataFrame:
    """Spans (doc, tag, low, high) of bytes to remove; they may overlap."""
    prepare(docs.sparkSession)
    found = _occurrences(docs)
    again = (found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("a"), F.max("context").alias("b"))
             .where("n > 1").selectExpr("anchor", "a <> b as several"))
    ranked = found.join(again, "anchor").withColumn("k", F.expr(
        "rank() over (partition by anchor, context order by doc, shiftright(place, 24))"))
    places = stored(ranked.select("anchor", "several", "doc", "place", F.expr("k = 1").alias("first"))
                    .where("several or not first"), "repeat-places")
    unpacked = ("cast(place & 65535 as int) as tag", "shiftright(place, 24) as start", "(shiftright(place, 16) & 255) as more")
    whole = (places.where("not first").selectExpr("doc", *unpacked)
             .selectExpr("doc", "tag", "start as low", f"start + more + {WINDOW} as high"))
    wanted = places.where("first and several").groupBy("doc").agg(F.collect_set(F.struct("anchor", "place")).alias("wanted"))
    texts = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text").join(wanted, "doc").select("doc", "text", "wanted.anchor", "wanted.place")
    out = "anchor bigint, doc bigint, tag int, start bigint, data binary"
    schema = to_arrow_schema(_parse_datatype_string(out))

    @frugal
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                made = []
                for doc, data, anchors, wanted_places in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(),
                                                             part.column(2).to_pylist(), part.column(3).to_pylist()):
                    if data is None:
                        continue
                    own = _tag(data)
                    for a, p in zip(anchors, wanted_places):
                        if p & 0xFFFF == own:
                            start = p >> 24
                            made.append((a, doc, own, start, data[start:start + ((p >> 16) & 255) + WINDOW]))
                yield batch(schema, *(zip(*made) if made else [[]] * 5))

    return whole.union(_judged(texts.mapInArrow(cut, out)))


def merged_spans(low: list[int], high: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for i, j in sorted(zip(low, high)):
        if out and i <= out[-1][1]:
            out[-1][1] = max(out[-1][1], j)
        else:
            out.append([i, j])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), as_text: bool = False) -> DataFrame:
    """Per row of docs: ``keep``, n_bytes, kept (binary: the bytes that stay), spans (array of removed low/high).

    ``as_text``: kept is the text of these bytes, without characters that have lost a part of theirs.
    """
    prepare(docs.sparkSession)
    spans = repeat_spans(docs).groupBy("doc").agg(F.collect_set(F.struct("tag", "low", "high")).alias("s"))
    rows = (docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text")
            .join(spans, "doc", "left").select(*[f"k{i}" for i in range(len(keep))], "text", "s.tag", "s.low", "s.high"))
    made = _parse_datatype_string(f"n_bytes bigint, kept {'string' if as_text else 'binary'}, spans array<struct<low: bigint, high: bigint>>")
    schema = StructType([docs.schema[c] for c in keep] + made.fields)

    @frugal
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, n = to_arrow_schema(schema), len(keep)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                sizes, kept, cut = [], [], []
                for data, tags, lows, highs in zip(part.column(n).cast(pa.binary()).to_pylist(), *(part.column(n + k).to_pylist() for k in (1, 2, 3))):
                    data, runs = data or b"", []
                    if tags:
                        own = _tag(data)
                        runs = merged_spans(*zip(*[(i, j) for t, i, j in zip(tags, lows, highs) if t == own])) if own in tags else []
                    at_byte, pieces = 0, []
                    for i, j in runs:
                        pieces.append(data[at_byte:i])
                        at_byte = j
                    sizes.append(len(data))
                    left = b"".join([*pieces, data[at_byte:]])
                    kept.append(left.decode("utf-8", "ignore") if as_text else left)
                    cut.append([{"low": i, "high": j} for i, j in runs])
                yield batch(arrow, *part.columns[:n], sizes, kept, cut)

    return rows.mapInArrow(apply, schema)


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_bytes", F.expr("n_bytes - octet_length(kept)").alias("n_removed"),
                          F.expr("cast(size(spans) as bigint)").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
