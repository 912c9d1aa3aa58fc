"""Mixing of sources to target weights by a minimum-cost flow.

Documents are summed by membership pattern (the set of sources that hold them). Patterns offer their words once
for nothing, a second time at cost 1, a third time at cost 2 and so on (convex costs of repetition), and a flow of least
cost fills the quotas of the sources. The flow is then turned into documents: in each pattern, documents stand
in the order of a seeded hash, on a line that has one length of the pattern per copy; each source takes
a stretch of that line. The ends of the stretches are hash values, found by a histogram of the hash and
a running sum inside one of its 4,096 bins, so no source is ever sorted in one task.

The driver holds one number per pattern and source, not per document.

Cases: a null or blank text has size 0. Null is a source of its own, the last. The order's hash reads doc_id and text, so rows
without doc_id or with one doc_id move apart where their texts differ; equal rows are taken together. Very long texts are
only counted and hashed, in the JVM. Further columns keep their values, whatever their names, but for names with a leading underscore. A source without words has target 0. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangtally.llm.common import few_rows, stored

WORD = r"[^\x20\x09-\x0D]+"
BINS = 12   # bits
#: Patterns up to which the plan is small enough to be sent to all executors.
BROADCAST_PATTERNS = 10_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def by_code_point(names: Sequence[str | None]) -> list[str | None]:
    return sorted(names, key=lambda s: (s is None, s or ""))


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], total: float, most: float) -> dict[str | None, float]:
    """``total`` shared by weight; what exceeds ``most`` times a source's size is shared again among the others."""
    out, free, left = {}, list(sizes), float(total)
    while free:
        whole = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / whole > most * sizes[s]]
        if not over:
            out.update({s: left * weights[s] / whole for s in free})
            break
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        free = [s for s in free if s not in out]
    return out


def least_cost_flow(capacity: list[int], members: list[list[int]], quota: list[int], copies: int) -> list[dict[int, int]]:
    """Words that each pattern gives each source: successive cheapest paths with potentials."""
    n, m = len(capacity), len(quota)
    start, end = n + m, n + m + 1
    arcs: list[list[int]] = []             # to, room, cost; arc k ^ 1 is its reverse
    at: list[list[int]] = [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, room: int, cost: int) -> None:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            at[x].append(len(arcs))
            arcs.append([y, r, c])

    for p in range(n):
        for copy in range(copies):
            arc(start, p, capacity[p], copy)
        for s in members[p]:
            arc(p, n + s, copies * capacity[p], 0)
    for s in range(m):
        arc(n + s, end, quota[s], 0)
    height = [0] * (n + m + 2)
    while True:
        far, via = [float("inf")] * (n + m + 2), [-1] * (n + m + 2)
        far[start] = 0
        heap = [(0, start)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > far[x]:
                continue
            for k in at[x]:
                y, room, cost = arcs[k]
                if room > 0 and (e := d + cost + height[x] - height[y]) < far[y]:
                    far[y], via[y] = e, k
                    heapq.heappush(heap, (e, y))
        if far[end] == float("inf"):
            break
        height = [h + (f if f < float("inf") else 0) for h, f in zip(height, far)]
        path, x = [], end
        while x != start:
            path.append(via[x])
            x = arcs[via[x] ^ 1][0]
        amount = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= amount
            arcs[k ^ 1][1] += amount
    return [{arcs[k][0] - n: arcs[k ^ 1][1] for k in at[p] if not k & 1 and arcs[k ^ 1][1] > 0} for p in range(n)]


def mix(docs: DataFrame, sources: Column, weight: Callable[[int], float], total_share: float = 1.5, copies: int = 2,
        seed: int = 20240501) -> tuple[DataFrame, DataFrame]:
    """Returns docs with _size, _copies and _credited (the source of each copy), and the sources with their targets.

    ``sources`` gives a row's array of source names; ``weight`` the weight of the k-th source by code point.
    """
    spark = docs.sparkSession
    rows = docs.withColumns({"_size": word_count("text"), "_pattern": F.to_json(F.array_distinct(sources)),
                             "_order": F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.lit(seed))})
    narrow = stored(rows.select("_pattern", "_size", "_order"), "mix-sizes")
    sums = sorted((r["_pattern"], r["size"]) for r in narrow.groupBy("_pattern").agg(F.sum("_size").alias("size")).collect())
    held = [json.loads(p) for p, _ in sums]
    capacity = [n for _, n in sums]
    names = by_code_point({s for h in held for s in h})
    sizes = {s: sum(n for h, n in zip(held, capacity) if s in h) for s in names}
    goal = targets(sizes, {s: float(weight(k)) for k, s in enumerate(names)}, total_share * sum(capacity), copies)
    flow = least_cost_flow(capacity, [[names.index(s) for s in h] for h in held], [round(goal[s]) for s in names], copies)
    # stretches of each pattern's line, cut where a copy ends
    cuts: list[tuple[str, int, int, int, str | None]] = []   # pattern, copy, number, end inside the copy, source
    for (pattern, size), given in zip(sums, flow):
        at = 0
        for s, amount in sorted(given.items()):
            stop = at + amount
            while at < stop:
                copy = at // size
                upto = min(stop, (copy + 1) * size)
                cuts.append((pattern, copy, len(cuts), upto - copy * size, names[s]))
                at = upto
    whole = dict(sums)
    inner = [(p, n, e) for p, _, n, e, _ in cuts if e < whole[p]]
    limit = _limits(spark, narrow, inner) if inner else {}
    plan: dict[str, list[list[dict]]] = {p: [[] for _ in range(copies)] for p, _ in sums}
    for p, copy, n, e, s in cuts:
        plan[p][copy].append({"upto": limit[n] if e < whole[p] else (1 << 63) - 1, "source": s})
    table = few_rows(spark, [(p, t) for p, t in plan.items()], "_p string, _plan array<array<struct<upto: bigint, source: string>>>")
    if len(plan) <= BROADCAST_PATTERNS:
        table = F.broadcast(table)   # one row per pattern, counted above
    hit = F.expr("filter(transform(_plan, t -> filter(t, e -> _order <= e.upto)), t -> size(t) > 0)")
    out = (rows.join(table, F.col("_pattern") == F.col("_p"), "left").withColumn("_hit", hit)
           .withColumns({"_copies": F.when(F.col("_size") > 0, F.size("_hit")).otherwise(0), "_credited": F.expr("transform(_hit, t -> t[0].source)")})
           .drop("_p", "_plan", "_pattern", "_order", "_hit"))
    described = few_rows(spark, [(s, sizes[s], goal[s]) for s in names], "source string, source_size bigint, target double")
    return out, described


def _limits(spark, narrow: DataFrame, wanted: list[tuple[str, int, int]]) -> dict[int, int]:
    """The hash value at which each pattern's running size comes nearest to a wanted length."""
    ask = few_rows(spark, wanted, "p string, number int, length bigint")
    if len(wanted) <= BROADCAST_PATTERNS:
        ask = F.broadcast(ask)
    binned = narrow.withColumn("bin", F.shiftright("_order", 64 - BINS))
    bins = binned.groupBy("_pattern", "bin").agg(F.sum("_size").alias("size"))
    summed = bins.selectExpr("_pattern", "bin", "size", "sum(size) over (partition by _pattern order by bin) as upto")
    hit = summed.join(ask, (F.col("_pattern") == F.col("p")) & (F.col("upto") >= F.col("length")) & (F.col("upto") - F.col("size") < F.col("length")))
    hit = hit.selectExpr("_pattern", "bin", "number", "length - (upto - size) as rest")
    inside = binned.join(hit, ["_pattern", "bin"]).selectExpr(
        "number", "bin", "rest", "_order", "sum(_size) over (partition by number order by _order) as upto")
    near = inside.groupBy("number").agg(F.min_by(F.struct("_order", "upto"), F.struct(F.abs(F.col("upto") - F.col("rest")), F.col("_order"))).alias("n"),
                                        F.first("rest").alias("rest"), F.first("bin").alias("bin"))
    got = near.selectExpr("number", f"if(rest <= abs(n.upto - rest), shiftleft(bin, {64 - BINS}) - 1, n._order) as limit").collect()
    return {r["number"]: r["limit"] for r in got}   # one row per stretch end


def by_source(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mix of documents that each have one source, with weights 3, 1, 2 in turn and 150 % of all words."""
    return mix(docs, F.array("source"), lambda k: (3, 1, 2)[k % 3])


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    mixed, sources = by_source(docs.select("doc_id", "text", "source"))
    sources = sources.withColumnRenamed("source", "_s")
    out = mixed.select("doc_id", "source", "_size", "_copies").join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("_s")), "left")
    return out.selectExpr("doc_id", "_size as size", "source_size", "target", "_size * _copies as taken")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """docs with every row as often as the mix takes it; columns as they are."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", "source")
    mixed, _ = by_source(rows)
    return mixed.where("_copies > 0").select("_row", F.explode(F.expr("sequence(1, _copies)"))).select("_row.*")
