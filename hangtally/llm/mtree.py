"""Exact top-k search by inner product with best-first M-trees.

Vectors are scaled to integers, floor(256 * x). Inner products become distances by one more
coordinate: with M the greatest norm, x gets sqrt(M^2 - |x|^2) and a query gets 0, so
d(q, x)^2 = |q|^2 + M^2 - 2 q.x, and the greatest product is the least distance. A bounded sample of
pivots cuts all rows into cells; a cell with more than ``CELL_ROWS`` rows is cut by hash. In
each cell's task an M-tree is built from pages: a node keeps its centre, covering radius and
distance to its parent's centre, a leaf its rows and their distances to the leaf's centre. A
search takes nodes from a heap by their least possible distance and stops when that exceeds the
k-th found; stored parent distances and the triangle inequality leave out children and rows
whose distance need not be computed.

A query first searches the cell of its nearest pivot. The k-th distance found there bounds the
second pass, which goes only to cells whose ball it reaches. Scores are computed from the
integers, and bounds have a margin above rounding, so the result is exact.

Cases: vectors that are null or hold null or non-finite components take no part. Shorter vectors
count as padded by zeros. Rows with a null vec_id are neither query nor candidate. Repeated rows are
candidates of their own, except that a row is never a candidate for its own vec_id. Ties
go to the smaller vec_id. An empty table gives an empty result. Further columns of any name are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from hangtally.llm.common import batch, prepare, stored

SCALE, PAGE, FANOUT, CELL_ROWS = 256, 256, 8, 8192
#: Most pivots, and rows sampled to find them.
PIVOTS, SAMPLE = 256, 4096
MARGIN = 1e-6


class Tree:
    """An M-tree over the rows of one cell."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float):
        self.ids, self.x, self.top = ids, x, top
        self.norms = (x * x).sum(1)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(ids)), int(np.argmax(self.norms)) if len(ids) else 0, 0.0)

    def _to(self, rows: np.ndarray, centre: int) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.top - self.norms[rows], 0)) - np.sqrt(max(self.top - self.norms[centre], 0))
        d = self.norms[rows] + self.norms[centre] - 2 * (self.x[rows] @ self.x[centre])
        return np.sqrt(np.maximum(d, 0) + lift * lift)

    def _build(self, rows: np.ndarray, centre: int, to_parent: float) -> int:
        """Number of the node over ``rows``: (centre, radius, distance to the parent's centre, children or None, rows, distances)."""
        own = self._to(rows, centre)
        radius = float(own.max(initial=0))
        if len(rows) <= PAGE or radius == 0:
            by = np.argsort(own, kind="stable")
            self.nodes.append((centre, radius, to_parent, None, rows[by], own[by]))
            return len(self.nodes) - 1
        pivots = [int(rows[own.argmax()])]   # far apart from each other
        near = self._to(rows, pivots[0])
        which = np.zeros(len(rows), np.int64)
        while len(pivots) < FANOUT and near.max() > 0:
            pivots.append(int(rows[near.argmax()]))
            d = self._to(rows, pivots[-1])
            which[d < near] = len(pivots) - 1
            near = np.minimum(near, d)
        children = []
        for k, p in enumerate(pivots):
            part = rows[which == k]
            if len(part) == len(rows):   # nothing was split off: halve, so that the depth stays bounded
                half = len(part) // 2
                children += [self._build(q, int(q[0]), float(self._to(q[:1], centre)[0])) for q in (part[:half], part[half:])]
            elif len(part):
                children.append(self._build(part, p, float(self._to(np.array([p]), centre)[0])))
        info = np.array([[self.nodes[c][0], self.nodes[c][1], self.nodes[c][2]] for c in children])
        self.nodes.append((centre, radius, to_parent, (np.array(children), info), None, None))
        return len(self.nodes) - 1

    def search(self, q: np.ndarray, own: int, k: int, bound: float) -> list[tuple[int, int]]:
        """The k best (score, id), none beyond the distance ``bound``; ties to the smaller id."""
        if not len(self.ids):
            return []
        norm = float(q @ q)
        whole = norm + self.top

        def to(rows):
            return np.sqrt(np.maximum(whole - 2 * (self.x[rows] @ q), 0))

        best: list[tuple[int, int]] = []   # heap of (score, -id)
        root = self.nodes[self.root]
        d = float(to(np.array([root[0]]))[0])
        heap = [(max(0.0, d - root[1]), self.root, d)]
        while heap:
            least, number, d = heapq.heappop(heap)
            if least > bound + MARGIN:
                break
            _, _, _, inner, rows, member = self.nodes[number]
            if inner is not None:
                children, info = inner
                reach = np.abs(d - info[:, 2]) - info[:, 1] <= bound + MARGIN   # by parent distances alone
                children, info = children[reach], info[reach]
                if len(children):
                    dc = to(info[:, 0].astype(np.int64))
                    low = np.maximum(dc - info[:, 1], 0)
                    for c, lo, x in zip(children.tolist(), low.tolist(), dc.tolist()):
                        if lo <= bound + MARGIN:
                            heapq.heappush(heap, (lo, c, x))
                continue
            # rows whose stored distance to the centre cannot bring them within the bound are left out
            i, j = np.searchsorted(member, [d - bound - MARGIN, d + bound + MARGIN], side="left")
            rows = rows[i:np.searchsorted(member, d + bound + MARGIN, side="right")] if j >= i else rows[:0]
            rows = rows[self.ids[rows] != own]
            if not len(rows):
                continue
            score = np.rint(self.x[rows] @ q).astype(np.int64)
            if len(best) == k:
                some = np.flatnonzero(score >= best[0][0])
            elif len(score) > 4 * k:
                some = np.flatnonzero(score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1])
            else:
                some = np.arange(len(score))
            for s, i in sorted(zip(score[some].tolist(), self.ids[rows[some]].tolist()), key=lambda t: (-t[0], t[1])):
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
                elif s < best[0][0]:
                    break
            if len(best) == k:
                bound = min(bound, float(np.sqrt(max(whole - 2 * best[0][0], 0))))
        return [(s, -i) for s, i in best]


def integers(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, vector: binary of 64-bit integers, norm: squared) of the vectors that take part."""
    v = F.expr("transform(embedding, x -> floor(256 * cast(x as double)))")
    fine = F.expr("vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and abs(cast(x as double)) < double('Infinity'))")
    rows = vectors.where(fine).select("vec_id", v.alias("v"))
    return rows.select("vec_id", "v", F.expr("aggregate(v, 0L, (a, x) -> a + x * x)").alias("norm"))


def _matrix(values: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def _search(cells: DataFrame, asked: DataFrame, k: int, width: int, top: float) -> DataFrame:
    """Best k of each (query, cell). cells (cell, vec_id, v); asked (cell, query_id, v, bound)."""
    out = "query_id bigint, vec_id bigint, score bigint"
    schema = to_arrow_schema(_parse_datatype_string(out))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, rows, tree = None, [], [], None
        for b in batches:
            made = []
            for cell, kind, number, v, bound in zip(*(c.to_pylist() for c in b.columns)):
                if cell != now:
                    now, ids, rows, tree = cell, [], [], None
                if kind == 0:
                    ids.append(number)
                    rows.append(v)
                    continue
                if tree is None:   # a cell's rows come before its queries
                    tree = Tree(np.array(ids, np.int64), _matrix(rows, width), top)
                    ids, rows = [], []
                made.extend((number, i, s) for s, i in tree.search(_matrix([v], width)[0], number, k, bound))
            yield batch(schema, *(zip(*made) if made else [[]] * 3))

    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = (cells.selectExpr("cell", "0 as kind", "vec_id", "v", "0D as bound")
            .union(asked.selectExpr("cell", "1 as kind", "query_id", "v", "bound")))
    dealt = both.repartition(n, "cell").sortWithinPartitions("cell", "kind", "vec_id")
    return dealt.mapInArrow(work, out)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k highest products, from rank 1.

    Both frames have vec_id and embedding; every row of ``vectors`` is a candidate.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = stored(integers(vectors), "search-rows")
    asks = stored(integers(queries).groupBy("vec_id").agg(F.min(F.struct("v", "norm")).alias("q")).select("vec_id", "q.*"), "search-queries")
    facts = rows.union(asks).agg(F.max("norm"), F.max(F.size("v"))).first()
    count = rows.count()
    top, width = float(facts[0] or 0), int(facts[1] or 0)
    pivots = min(PIVOTS, max(1, -(-count // CELL_ROWS)))
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(SAMPLE).collect()]   # a bounded sample
    m = _matrix(sample, width)
    chosen = m[:pivots] if len(m) else np.zeros((1, width))
    norms = (chosen * chosen).sum(1)
    lifts = np.sqrt(np.maximum(top - norms, 0))
    out = "vec_id bigint, v array<bigint>, cell int, far double"
    schema = to_arrow_schema(_parse_datatype_string(out))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1).to_pylist(), width)
            own = (x * x).sum(1)
            lift = np.sqrt(np.maximum(top - own, 0))
            d = np.sqrt(np.maximum(own[:, None] + norms - 2 * x @ chosen.T, 0) + (lift[:, None] - lifts) ** 2)
            near = d.argmin(1)
            yield batch(schema, b.column(0), b.column(1), near.astype(np.int32), d[np.arange(len(d)), near] if len(d) else [])

    placed = stored(rows.select("vec_id", "v").mapInArrow(assign, out), "search-cells")
    balls = placed.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).collect()   # one row per pivot
    parts = {r["cell"]: -(-r["n"] // CELL_ROWS) for r in balls}
    radius = {r["cell"]: r["radius"] for r in balls}
    most = max(parts.values(), default=1)
    split = F.create_map(*[F.lit(x) for kv in (parts or {0: 1}).items() for x in kv])[F.col("cell")]
    cells = placed.select((F.col("cell") * most + F.pmod(F.xxhash64("vec_id"), split)).cast("long").alias("cell"), "vec_id", "v")
    ask_out = "cell bigint, query_id bigint, v array<bigint>, bound double"
    ask_schema = to_arrow_schema(_parse_datatype_string(ask_out))

    def routed(first: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            live = sorted(parts)
            for b in batches:
                made = []
                for number, v, limit in zip(*(c.to_pylist() for c in b.columns)):
                    q = _matrix([v], width)[0]
                    d = np.sqrt(np.maximum(float(q @ q) + top - 2 * chosen[live] @ q, 0)) if live else np.empty(0)
                    home = int(d.argmin()) if len(d) else -1
                    for at, c in enumerate(live):
                        if (at == home) == first and (first or d[at] - radius[c] <= limit + MARGIN):
                            made.extend((c * most + part, number, v, limit) for part in range(parts[c]))
                yield batch(ask_schema, *(zip(*made) if made else [[]] * 4))
        return work

    far = 1e300
    start = asks.select("vec_id", "v", F.lit(far).alias("bound")).mapInArrow(routed(True), ask_out)
    home = stored(_best(_search(cells, start, k, width, top), k), "search-home")
    norm = asks.select(F.col("vec_id").alias("query_id"), "v", "norm")
    kth = home.where(f"rank = {k}").select("query_id", "score")
    bounded = (norm.join(kth, "query_id", "left")
               .select("query_id", "v", F.expr(f"coalesce(sqrt(greatest(norm + {top!r}D - 2 * score, 0)), {far!r}D)").alias("bound")))
    more = _search(cells, bounded.mapInArrow(routed(False), ask_out), k, width, top)
    return _best(home.select("query_id", "vec_id", "score").union(more), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = found.selectExpr("query_id", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank", "vec_id", "score")
    return ranked.where(f"rank <= {k}")
