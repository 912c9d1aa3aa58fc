"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

A document's set holds its distinct 5-word shingles (64-bit hashes). Its signature has 48 symbols
of 16 bits, the low bits of 48 minima. Two signatures that differ in at most 23 symbols must, cut
into 12 chunks of 4 symbols, have a chunk that differs in at most one (pigeonhole: 12 chunks with
two errors or more are 24). So each signature is entered 4 times per chunk, once with each symbol
left out; equal entries find every pair within that distance. A pair of similarity 0.75 misses all
entries with probability 1e-7 (a chunk has two errors or more in 0.262 of the cases, all twelve in 0.262^12). Pairs found are confirmed on the full sets.

Equal sets are one class and are never compared with each other. Within an entry's group the first
member is compared with all others, which joins most of a group of copies to one component. Documents
connected through entries form a candidate group; its documents outside the group's largest component
are then counted against all its documents of other components, through an inverted index of their
shingles inside the tasks. Tasks hold blocks of bounded size and emit a forest of the links, so a
group of thousands of copies makes as many rows as it has members, and no connection is lost.

Cases: null or blank text has an empty set and links with nothing. Fewer than five words: the whole
sequence is one shingle. Rows that repeat a doc_id are one document where their sets are equal, and
go together. A null doc_id links with nothing: its component is null and it is kept. An empty table
gives an empty result. Very long texts are hashed whole, and minima are taken in pieces. Further columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType, _parse_datatype_string

from hangtally.llm.common import batch, components, frugal, prepare, rows_of, stored
from hangtally.llm.words import Memo

WORDS, CHUNKS, CHUNK = 5, 12, 4
SYMBOLS = CHUNKS * CHUNK
#: Members of a leader that one task confirms; strays that a task holds, and documents that pass by them.
MEMBERS, STRAYS, PASSING = 512, 512, 4096

_U = np.uint64
_rng = np.random.default_rng(20240501)
_ODD = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * _U(2) + _U(1)
_FLIP = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_PLACE = (_rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * _U(2) + _U(1))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingles:
    def __init__(self):
        self._hash = Memo(xxhash.xxh3_64_intdigest, 500_000)

    def __call__(self, text: bytes | None) -> np.ndarray:
        """The set of a text as sorted distinct 64-bit hashes."""
        words = text.lower().split() if text else []   # of bytes: A-Z only, and ASCII white space only
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < WORDS:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
        h = np.fromiter(map(self._hash.__getitem__, words), np.uint64, len(words))
        n = len(h) - WORDS + 1
        s = h[:n] * _PLACE[0]
        for k in range(1, WORDS):
            s += h[k:n + k] * _PLACE[k]
        return np.unique(mixed(s))


def minima(s: np.ndarray) -> np.ndarray:
    low = np.full(SYMBOLS, ~_U(0))
    for at in range(0, len(s), 4096):
        low = np.minimum(low, ((s[None, at:at + 4096] ^ _FLIP[:, None]) * _ODD[:, None]).min(1))
    return mixed(low)


def set_digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def signatures(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, ``keep``, n_shingles, digest of the set and symbols of the signature (both null if it is empty)."""
    made = _parse_datatype_string("n_shingles bigint, digest binary, symbols binary")
    out = StructType([StructField("doc_id", LongType()), *[docs.schema[c] for c in keep], *made.fields])
    schema = to_arrow_schema(out)

    @frugal
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for b in batches:
            rows = []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                s = shingles(text)
                if not len(s):
                    rows.append((0, None, None))
                    continue
                rows.append((len(s), set_digest(s), minima(s).astype(np.uint16).tobytes()))
            if rows:
                yield batch(schema, b.column(0), *b.columns[2:], *zip(*rows))

    return docs.select(F.col("doc_id").cast("bigint"), "text", *keep).mapInArrow(work, out)


def _entries(classes: DataFrame) -> DataFrame:
    """Index entries (entry, node) of each signature: per chunk, every choice of one symbol to leave out."""
    out = "entry bigint, node bigint"
    schema = to_arrow_schema(_parse_datatype_string(out))

    @frugal
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sym = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, CHUNKS, CHUNK).astype(np.int64)
            made = []
            for left_out in range(CHUNK):
                a, c, d = (sym[:, :, k] for k in range(CHUNK) if k != left_out)
                made.append((np.arange(CHUNKS)[None, :] * CHUNK + left_out << 48) | (a << 32) | (c << 16) | d)
            keys = np.stack(made, 2).reshape(len(sym), -1)
            yield batch(schema, keys.ravel(), np.repeat(b.column(0).to_numpy(), keys.shape[1]))

    return classes.select("node", "symbols").mapInArrow(work, out)


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose full sets have 100 * intersection >= percent * union.

    Texts go to their pairs: a is sent once per slice of its partners and kept, the partners stream by.
    """
    slices = pairs.groupBy("a").agg(F.expr(f"cast(ceil(count(*) / {MEMBERS}) as bigint)").alias("slices"))
    member = (pairs.join(slices, "a").withColumn("slice", F.expr("pmod(xxhash64(b), slices)"))
              .join(texts, F.col("b") == F.col("node")).selectExpr("a", "slice", "1 as kind", "node", "digest", "text"))
    leader = (slices.selectExpr("a", "explode(sequence(0L, slices - 1)) as slice")
              .join(texts, F.col("a") == F.col("node")).selectExpr("a", "slice", "0 as kind", "node", "digest", "text"))
    out = "u bigint, v bigint"
    schema = to_arrow_schema(_parse_datatype_string(out))

    @frugal
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, now, own = Shingles(), None, None
        for b in batches:
            us, vs = [], []
            for a, part, kind, node, digest, text in zip(*(b.column(k).to_pylist() for k in range(5)), b.column(5).cast(pa.binary()).to_pylist()):
                s = shingles(text)
                if set_digest(s) != digest:
                    continue   # another text of a repeated doc_id
                if kind == 0:
                    now, own = (a, part), s
                elif now == (a, part):
                    both = len(np.intersect1d(own, s, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(s) - both):
                        us.append(a)
                        vs.append(node)
            yield batch(schema, us, vs)

    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = member.union(leader).repartition(n, "a", "slice").sortWithinPartitions("a", "slice", "kind")
    return stored(dealt.mapInArrow(work, out).distinct(), "near-links")


class Index:
    """Inverted index of some sets, to count their intersections with another set."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        all_of = np.concatenate(sets)
        by = np.argsort(all_of, kind="stable")
        self.shingles, first = np.unique(all_of[by], return_index=True)
        self.first = np.append(first, len(by))
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[by]

    def shared(self, s: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.shingles, s)
        at = at[self.shingles[np.minimum(at, len(self.shingles) - 1)] == s]
        low, size = self.first[at], self.first[at + 1] - self.first[at]
        places = np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)
        return np.bincount(self.owner[places], minlength=len(self.sizes))


def _strays(stars: DataFrame, parts: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of linked components, named by their smallest nodes: enough of them to connect what is connected."""
    groups = components(stars.selectExpr("a as u", "b as v"), "near-groups")
    placed = groups.selectExpr("node", "component as grp").join(parts, "node", "left").selectExpr("node", "grp", "coalesce(component, node) as part")
    sizes = placed.groupBy("grp", "part").agg(F.count("*").alias("n"))
    main = (sizes.groupBy("grp").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
            .where("all > most").selectExpr("grp", "main", f"ceil((all - most) / {STRAYS}) as rows", f"ceil(all / {PASSING}) as columns"))
    near = placed.join(main, "grp").join(texts, "node")
    row, column = "pmod(xxhash64(node), rows)", "pmod(xxhash64(node, 1), columns)"
    held = near.where("part <> main").selectExpr("grp", f"{row} as i", "explode(sequence(0L, columns - 1)) as j", "0 as kind", "node", "part", "digest", "text")
    passing = near.selectExpr("grp", "explode(sequence(0L, rows - 1)) as i", f"{column} as j", "1 as kind", "node", "part", "digest", "text")
    out = "u bigint, v bigint"
    schema = to_arrow_schema(_parse_datatype_string(out))

    @frugal
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, now, index = Shingles(), None, None
        own, sets = [], []
        for b in batches:
            us, vs = [], []
            for grp, i, j, kind, node, part, digest, text in zip(*(b.column(k).to_pylist() for k in range(7)), b.column(7).cast(pa.binary()).to_pylist()):
                if (grp, i, j) != now:
                    now, index, own, sets = (grp, i, j), None, [], []
                s = shingles(text)
                if set_digest(s) != digest:
                    continue   # another text of a repeated doc_id
                if kind == 0:
                    own.append(part)
                    sets.append(s)
                    continue
                if index is None:
                    if not sets:
                        continue
                    index, part_of = Index(sets), np.array(own)
                both = index.shared(s)
                hit = (100 * both >= percent * (index.sizes + len(s) - both)) & (part_of != part)
                for p in np.unique(part_of[hit]).tolist():   # one link to each component is enough
                    us.append(p)
                    vs.append(part)
            yield batch(schema, us, vs)

    n = int(stars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = held.union(passing).repartition(n, "grp", "i", "j").sortWithinPartitions("grp", "i", "j", "kind", "node")
    return stored(dealt.mapInArrow(work, out).distinct(), "near-more")


def near_duplicates(docs: DataFrame, percent: int = 75, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of docs: ``keep``, doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    prepare(spark)
    sigs = stored(signatures(docs, keep), "near-signatures")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = (sigs.where("digest is not null and doc_id is not null").groupBy("digest")
             .agg(F.min_by(F.struct("doc_id", "symbols"), "doc_id").alias("s")).select("digest", "s.*"))
    # numbered in the order of doc_id, so the smallest node of a component is its smallest document
    classes = stored(first.repartitionByRange(n, "doc_id", "digest").sortWithinPartitions("doc_id", "digest")
                     .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    entries = _entries(classes)
    heads = entries.groupBy("entry").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = stored(entries.join(heads, "entry").where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "near-stars")
    nodes = classes.join(stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct(), "node").select("node", "doc_id", "digest")
    texts = stored(docs.select("doc_id", "text").join(nodes, "doc_id").select("node", "digest", "text"), "near-texts")
    links = _confirmed(stars, texts, percent)
    parts = components(links, "near-parts")
    whole = components(_strays(stars, parts, texts, percent), "near-whole").selectExpr("node as part", "component as top")   # parts that belong together
    named = (classes.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
             .join(whole, "part", "left").withColumn("top", F.coalesce("top", "part")))
    tops = classes.select(F.col("node").alias("top"), F.col("doc_id").alias("component_doc"))
    named = named.join(tops, "top").select("digest", "component_doc")
    out = sigs.join(named, "digest", "left")
    return out.select(*keep, "doc_id", "n_shingles", F.expr("if(doc_id is null, null, coalesce(component_doc, doc_id))").alias("component_id"),
                      F.expr("doc_id is null or doc_id = coalesce(component_doc, doc_id)").alias("kept"))


def keep_one(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of docs without the near duplicates of smaller documents; columns as they are.

    Of rows that share a doc_id only those go whose own text is such a duplicate.
    """
    told = F.xxhash64("text")
    found = near_duplicates(docs.select("doc_id", "text", told.alias("_told")), percent, ("_told",))
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone"), "_told").distinct()
    return docs.join(gone, (docs["doc_id"] == F.col("_gone")) & (F.xxhash64(docs["text"]) == F.col("_told")), "left_anti")
