"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in two halves, and each half has a codebook of its own (k-means over a bounded
sample). A vector lives in one cell of the product grid. To find its partners it visits cells in
the order of the summed squared distances of its halves to the two codewords (multi-sequence
traversal), as many cells as a sample of queries needs for a mean recall of ``RECALL``, measured twice: on the queries' true
partners (the sample is compared with all rows by brute force, the rank of each partner's cell is noted, and queries
count alike, however large their group), and on ``PLANTED`` partners a query, drawn at the least cosine in random
directions. The second holds where the sample has no or few partners. Only finding from the query's own end is counted; a pair
is also found from the other. Every candidate in a visited cell is verified in double precision, so no false link appears.

Equal vectors of one label are one class with a weight. Inside a task rows are compared in blocks;
links are counted there and only a spanning forest of them leaves it, so a large group of
copies gives as many rows as it has members. A pair that is met in both of its cells is counted once.
A cell of more than ``BLOCK`` rows is cut by hash and its visitors are sent to every part.

Cases: null labels, null ids, and vectors that are null, zero or hold null or non-finite
components link with nothing (0 links, their own component, kept; null where the id is null).
Shorter vectors count as padded by zeros. Rows that repeat a vec_id are counted as vectors of their
own. An empty table gives an empty result. Further columns of any name are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from hangtally.llm.common import batch, components, prepare, stored

#: Rows the codebooks are fitted on at most, queries of the recall sample, planted partners of each, the recall aimed at, and
#: cells up to which a rank is told; partners farther off make a query visit all cells.
FIT_ROWS, RECALL_QUERIES, PLANTED, RECALL, RANKED = 8192, 256, 16, 0.995, 4096
BLOCK = 2048
#: Rows of one label that a cell should hold, and fitted rows a codeword should have.
CELL_ROWS, CODE_ROWS = 512, 8


def units(rows: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def codebook(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k-means with evenly drawn starts; rows come in a seeded order."""
    c = np.unique(x, axis=0)
    c = c[np.linspace(0, len(c) - 1, min(k, len(c))).astype(int)] if len(c) else np.zeros((1, x.shape[1]))
    for _ in range(rounds):
        own = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].mean(0)
    return c


class Grid:
    def __init__(self, left: np.ndarray, right: np.ndarray, visits: int):
        self.left, self.right, self.visits = left, right, visits

    def _far(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        a, b = x[:, :half], x[:, half:]
        return ((a * a).sum(1)[:, None] + (self.left ** 2).sum(1) - 2 * a @ self.left.T,
                (b * b).sum(1)[:, None] + (self.right ** 2).sum(1) - 2 * b @ self.right.T)

    def homes(self, x: np.ndarray) -> np.ndarray:
        a, b = self._far(x)
        return a.argmin(1) * len(self.right) + b.argmin(1)

    def traversals(self, x: np.ndarray, visits: int | None = None) -> Iterator[list[int]]:
        """For each row the first cells in the order of summed distances."""
        n = min(visits or self.visits, len(self.left) * len(self.right))
        for a, b in zip(*self._far(x)):
            ia, ib = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
            heap, out, next_in = [(a[ia[0]] + b[ib[0]], 0, 0)], [], {}
            while heap and len(out) < n:
                _, i, j = heapq.heappop(heap)
                out.append(int(ia[i]) * len(self.right) + int(ib[j]))
                next_in[i] = j + 1
                # the two followers, each pushed when its other neighbour has been taken
                if i + 1 < len(ia) and next_in.get(i + 1, 0) == j:
                    heapq.heappush(heap, (a[ia[i + 1]] + b[ib[j]], i + 1, j))
                if j + 1 < len(ib) and (i == 0 or next_in.get(i - 1, 0) > j + 1):
                    heapq.heappush(heap, (a[ia[i]] + b[ib[j + 1]], i, j + 1))
            yield out


def _valid(vectors: DataFrame) -> DataFrame:
    fine = F.expr("""vec_id is not null and label is not null and embedding is not null
        and forall(embedding, x -> x is not null and abs(cast(x as double)) < double('Infinity'))
        and exists(embedding, x -> x <> 0)""")
    return vectors.where(fine).select("vec_id", F.col("embedding").alias("v"), F.col("label").cast("string").alias("label"))


def _visits(classes: DataFrame, grid: Grid, asked: list, width: int, least: float) -> int:
    """Cells to visit so that the sample's true and planted partners are found from the sampled end, with the recall aimed at."""
    if not asked:
        return 1
    q = units([r["v"] for r in asked], width)
    labels, nodes = np.array([r["label"] for r in asked]), np.array([r["node"] for r in asked])
    whole = len(grid.left) * len(grid.right)
    told = min(whole, RANKED)
    ranks = [dict(zip(t, range(told))) for t in grid.traversals(q, told)]
    random = np.random.default_rng(5)
    side = random.normal(size=(len(q), PLANTED, width))
    side -= (side * q[:, None]).sum(2, keepdims=True) * q[:, None]
    planted = least * q[:, None] + (1 - least ** 2) ** 0.5 * side / np.maximum(np.linalg.norm(side, axis=2, keepdims=True), 1e-30)
    share = np.zeros(told + 1)   # of partners by the rank of their cell, summed over queries
    for of, homes in zip(ranks, grid.homes(planted.reshape(-1, width)).reshape(len(q), PLANTED).tolist()):
        for h in homes:
            share[of.get(h, told)] += 1 / PLANTED
    out = "query int, rank int, pairs bigint"
    schema = to_arrow_schema(_parse_datatype_string(out))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            if b.num_rows:
                x = units(b.column(1).to_pylist(), width)
                own = np.array(b.column(2).to_pylist())
                hit = (x @ q.T >= least) & (own[:, None] == labels) & (b.column(0).to_numpy()[:, None] != nodes)
                homes = grid.homes(x).tolist()
                total.update((c, ranks[c].get(homes[r], told)) for r, c in zip(*(i.tolist() for i in np.nonzero(hit))))
        if total:
            yield batch(schema, *zip(*((c, r, n) for (c, r), n in total.items())))

    found = classes.select("node", "v", "label").mapInArrow(work, out).groupBy("query", "rank").agg(F.sum("pairs").alias("n")).collect()   # bounded by queries and ranks
    pairs = Counter()
    for r in found:
        pairs[r["query"]] += r["n"]
    true = np.zeros(told + 1)
    for r in found:
        true[r["rank"]] += r["n"] / pairs[r["query"]]
    return max(_enough(share / len(q), whole), _enough(true / max(1, len(pairs)), whole))


def _enough(share: np.ndarray, whole: int) -> int:
    """Cells that hold the recall aimed at, from the shares by rank; all cells where the told ranks do not hold it."""
    reached = np.flatnonzero(np.cumsum(share[:-1]) >= RECALL * share.sum() - 1e-12)
    return int(reached[0]) + 1 if len(reached) else whole


def _links(classes: DataFrame, grid: Grid, width: int, least: float) -> DataFrame:
    """Rows (node, links, other): links counted in a task, and a linked node or null; other forms a forest."""
    spark = classes.sparkSession
    mid = StructType([*_parse_datatype_string("label string, cell int, kind int, node bigint, weight bigint").fields, classes.schema["v"],
                      *_parse_datatype_string("visits array<int>").fields])   # vectors as they come: narrower than unit vectors
    mid_schema = to_arrow_schema(mid)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 250):
                part = b.slice(at, 250)
                raw = part.column(1).to_pylist()
                x = units(raw, width)
                home = grid.homes(x).tolist()
                made = []
                for node, label, weight, v, h, t in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), raw, home, grid.traversals(x)):
                    made.append((label, h, 0, node, weight, v, t))
                    made.extend((label, c, 1, node, weight, v, [h]) for c in t)
                yield batch(mid_schema, *zip(*made))

    placed = stored(classes.select("node", "v", "label", "weight").mapInArrow(place, mid), "index-places")
    sizes = placed.where("kind = 0").groupBy("label", "cell").agg(F.expr(f"ceil(count(*) / {BLOCK})").alias("parts"))
    # a cell without rows of its own has no part, so its visitors end here
    parted = placed.join(sizes, ["label", "cell"]).withColumn("part", F.explode(F.expr(
        "if(kind = 0, array(pmod(xxhash64(node), parts)), sequence(0L, parts - 1))"))).drop("parts")
    out = "node bigint, links bigint, other bigint"
    schema = to_arrow_schema(_parse_datatype_string(out))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, mine = None, [], None
        for b in batches:
            made: list[tuple] = []
            pending: list[tuple] = []

            def flush():
                nonlocal mine
                if not pending or not rows:
                    pending.clear()
                    return
                if mine is None:
                    mine = (np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), units([r[2] for r in rows], width), [frozenset(r[3]) for r in rows])
                nodes, weights, x, visits = mine
                theirs = np.array([p[0] for p in pending])
                heavy = np.array([p[1] for p in pending])
                i, j = np.nonzero(x @ units([p[2] for p in pending], width).T >= least)
                keep = nodes[i] != theirs[j]
                i, j = i[keep], j[keep]
                # met in both cells: counted where the resident is the smaller
                other_home = [p[3][0] for p in pending]
                twice = np.fromiter((other_home[b] in visits[a] for a, b in zip(i.tolist(), j.tolist())), bool, len(i))
                once = ~twice | (nodes[i] < theirs[j])
                i, j = i[once], j[once]
                if len(i):
                    made.extend(zip(nodes.tolist(), np.bincount(i, heavy[j], len(nodes)).astype(np.int64).tolist(), [None] * len(nodes)))
                    made.extend(zip(theirs.tolist(), np.bincount(j, weights[i], len(theirs)).astype(np.int64).tolist(), [None] * len(theirs)))
                    made.extend((a, 0, c) for a, c in forest(nodes[i], theirs[j]))
                pending.clear()

            for label, cell, part, kind, node, weight, v, t in zip(*(c.to_pylist() for c in b.columns)):
                if (label, cell, part) != now:
                    flush()
                    now, rows, mine = (label, cell, part), [], None
                if kind == 0:
                    rows.append((node, weight, v, t))
                else:
                    pending.append((node, weight, v, t))
            flush()
            made = [m for m in made if m[1] or m[2] is not None]
            yield batch(schema, *(zip(*made) if made else [[]] * 3))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (parted.select("label", "cell", "part", "kind", "node", "weight", "v", "visits").repartition(n, "label", "cell", "part")
             .sortWithinPartitions("label", "cell", "part", "kind", "node"))
    return dealt.mapInArrow(compare, out)


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges (node, smallest of its tree) that join the same nodes as the pairs a-b."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return [(x, top(x)) for x in list(up) if top(x) != x]


def near_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. The frame has vec_id, embedding, label."""
    spark = vectors.sparkSession
    prepare(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    classes = stored(_valid(vectors).groupBy("label", "v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"))
                     .repartitionByRange(n, "vec_id").sortWithinPartitions("vec_id", "label", "v")
                     .withColumn("node", F.monotonically_increasing_id()), "index-classes")
    facts = classes.agg(F.count("*"), F.max(F.size("v")), F.approx_count_distinct("label")).first()
    count, width = facts[0], facts[1] or 2
    width += width % 2
    sample = classes.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(FIT_ROWS).select("node", "v", "label").collect()   # bounded
    x = units([r["v"] for r in sample], width)
    codes = int(min(max(2, len(sample) // CODE_ROWS), max(2, round((count / CELL_ROWS / max(1, facts[2])) ** 0.5))))
    grid = Grid(codebook(x[:, :width // 2], codes), codebook(x[:, width // 2:], codes), 1)
    grid.visits = _visits(classes, grid, sample[:RECALL_QUERIES], width, least)
    links = stored(_links(classes, grid, width, least), "index-links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    whole = components(links.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")), "index-parts")
    named = classes.join(counts, "node", "left").join(whole, "node", "left").withColumn("top", F.coalesce("component", "node"))
    tops = classes.select(F.col("node").alias("top"), F.col("vec_id").alias("component_vec"))
    named = named.join(tops, "top").selectExpr("label as _label", "v as _v", "component_vec", "coalesce(links, 0) + weight - 1 as n")
    rows = vectors.select("vec_id", F.col("embedding").alias("v"), F.col("label").cast("string").alias("label"))
    out = rows.join(named, (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v")) & F.col("vec_id").isNotNull(), "left")
    return out.selectExpr("vec_id", "coalesce(n, 0L) as n_links", "if(vec_id is null, null, coalesce(component_vec, vec_id)) as component_id",
                          "vec_id is null or vec_id = coalesce(component_vec, vec_id) as kept")
