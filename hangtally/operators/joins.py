"""Joins that Spark has no single call for.

Dimensions are joined without broadcast hints: their size grows with the business,
so the choice between broadcast and sort-merge is left to Spark's size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hangtally.sources.versions import written


#: Spans that Spark may send to all tasks, so that no join shuffles facts, and spans of a key that one join may compare.
SMALL_SPANS, FEW_SPANS = 100_000, 16


def _dated(facts: DataFrame, spans: DataFrame, keys: Sequence[str], fact_date: str, out: str) -> DataFrame:
    """Facts with ``out`` of the one span (``_from``, ``_to``) of their key that holds their date.

    Spans of a key are disjoint; a null end is open.  Closed spans are spread over the months
    they touch, so a fact meets at most the spans of its own key and month; open ones (two per
    key at most) are met by key, if there are any.  Where spans are many but a key has only a few, all are met by key at
    once: facts are shuffled once, spans are not spread, and a hot key is left to Spark's splitting of skewed joins.
    Facts are read once, and no date range is assumed.  The spans, prepared from rates alone, are
    written once, as all of this reads them.
    """
    spans = written(spans, "rate-spans")

    def matched(left: DataFrame, right: DataFrame, name: str, *more: Column) -> DataFrame:
        r = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                         *[c for c in ("_rm", "_from", "_to") if c in right.columns], F.col(out).alias(name))
        cond = (F.coalesce(F.col(fact_date) >= F.col("_from"), F.lit(True))
                & F.coalesce(F.col(fact_date) <= F.col("_to"), F.lit(True)) & F.col(fact_date).isNotNull())
        for i, k in enumerate(keys):
            cond = cond & (F.col(k) == F.col(f"_k{i}"))
        for m in more:
            cond = cond & m
        return left.join(r, cond, "left").select(*left.columns, name)

    held = spans.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.sum("_n"), F.max("_n")).first()
    if (held[0] or 0) > SMALL_SPANS and held[1] <= FEW_SPANS:
        return matched(facts, spans, out)
    closed = F.col("_from").isNotNull() & F.col("_to").isNotNull()
    monthly = spans.where(closed).withColumn("_rm", F.explode(F.sequence(
        F.trunc("_from", "MM"), F.trunc("_to", "MM"), F.expr("interval 1 month"))))
    got = matched(facts.withColumn("_m", F.trunc(fact_date, "MM")), monthly, "_closed", F.col("_m") == F.col("_rm"))
    unbounded = spans.where(~closed)
    got = got.withColumn("_open", F.lit(None)) if unbounded.isEmpty() else matched(got, unbounded, "_open")
    return got.withColumn(out, F.coalesce("_closed", "_open")).select(*facts.columns, out)


def asof_join(facts: DataFrame, rates: DataFrame, keys: Sequence[str], fact_date: str,
              rate_date: str, value: str, out: str) -> DataFrame:
    """Latest ``value`` with ``rate_date <= fact_date`` per key; null if there is none.

    All preparation is on the rates: one per key and day (the lowest value), valid until the
    next one, the last without end.
    """
    keys = list(keys)
    daily = (rates.where(F.col(rate_date).isNotNull())
             .groupBy(*keys, F.col(rate_date).alias("_from")).agg(F.min(value).alias(out)))
    follows = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))
    return _dated(facts, daily.withColumn("_to", F.date_sub(follows, 1)), keys, fact_date, out)


def interval_join(facts: DataFrame, bands: DataFrame, keys: Sequence[str], fact_date: str,
                  begin: str, end: str, value: str, out: str) -> DataFrame:
    """``value`` of the band with ``begin <= fact_date <= end`` per key; a null limit is open.

    If bands overlap, the latest begin wins, then the lowest value.  The overlap is settled on the bands by a sweep
    inside (key, month) cells: a band gives each month it touches the days from which and to which it holds there, and
    equal ones are added up to one, so a cell has a thousand rows at most however many bands a key has. Open limits reach to
    the key's outermost edges inside the cells; beyond these one span per key and side goes on without end.
    """
    keys = list(keys)
    every = bands.select(*keys, F.col(begin).alias("b"), F.col(end).alias("e"), F.col(value).alias("v")).where("b is null or e is null or b <= e")
    # bands that touch no other of their key are spans as they are
    first, last = F.coalesce(F.unix_date("b"), F.lit(-(2 ** 31))), F.coalesce(F.unix_date("e"), F.lit(2 ** 31 - 1))
    order = Window.partitionBy(*keys).orderBy("_b0")
    reached, follows = F.max("_e0").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lead("_b0").over(order)
    alone = F.coalesce(reached < F.col("_b0"), F.lit(True)) & F.coalesce(follows > F.col("_e0"), F.lit(True))
    every = written(every.withColumns({"_b0": first, "_e0": last}).withColumn("alone", alone), "bands")
    single = every.where("alone").select(*keys, F.col("b").alias("_from"), F.col("e").alias("_to"), F.col("v").alias(out))
    valid = every.where("not alone").select(*keys, "b", "e", "v")
    # a null begin comes before all begins
    rank = F.struct(F.coalesce(F.unix_date("b"), F.lit(-(2 ** 31))).alias("b"), (-F.col("v")).alias("nv"))
    edges = (valid.groupBy(*keys).agg(F.least(F.min("b"), F.date_add(F.min("e"), 1)).alias("lo"), F.greatest(F.max("b"), F.date_add(F.max("e"), 1)).alias("hi")))
    edged = _same_keys(valid, edges, keys)
    head = edged.where("b is null").groupBy(*keys).agg(F.max(rank).alias("_best"), F.first("lo").alias("lo"))
    head = head.select(*keys, F.lit(None).cast("date").alias("_from"), F.date_sub("lo", 1).alias("_to"), "_best")
    tail = edged.where("e is null and hi is not null").groupBy(*keys).agg(F.max(rank).alias("_best"), F.first("hi").alias("hi"))
    tail = tail.select(*keys, F.col("hi").alias("_from"), F.lit(None).cast("date").alias("_to"), "_best")
    within = (edged.where("lo is not null").withColumns({"_b": F.coalesce("b", "lo"), "_e": F.coalesce("e", F.date_sub("hi", 1))}).where("_b <= _e")
              .withColumn("_m", F.explode(F.sequence(F.trunc("_b", "MM"), F.trunc("_e", "MM"), F.expr("interval 1 month")))))
    cells = (within.groupBy(*keys, "_m", F.greatest("_b", "_m").alias("_b"), F.least("_e", F.last_day("_m")).alias("_e")).agg(F.max(rank).alias("_best")))
    cells = cells.withColumn("_n", F.count("*").over(Window.partitionBy(*keys, "_m")))
    lone = cells.where("_n = 1").select(*keys, F.col("_b").alias("_from"), F.col("_e").alias("_to"), "_best")
    days = (cells.where("_n > 1").withColumn("_d", F.explode(F.sequence("_b", "_e"))).groupBy(*keys, "_m", "_d").agg(F.max("_best").alias("_best")))
    cell = Window.partitionBy(*keys, "_m").orderBy("_d")   # the days of a month
    goes_on = (F.lag("_d").over(cell) == F.date_sub("_d", 1)) & (F.lag("_best").over(cell) == F.col("_best"))
    runs = days.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(cell))
    inner = runs.groupBy(*keys, "_m", "_run").agg(F.min("_d").alias("_from"), F.max("_d").alias("_to"), F.max("_best").alias("_best"))
    spans = inner.select(*keys, "_from", "_to", "_best").union(lone).union(head).union(tail)
    return _dated(facts, spans.select(*keys, "_from", "_to", (-F.col("_best.nv")).alias(out)).union(single), keys, fact_date, out)


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys, null equal to null."""
    r = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return left.join(r, cond).drop(*[f"_k{i}" for i in range(len(keys))])


def null_safe_anti(new: DataFrame, old: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``new`` for which no row of ``old`` is equal in all columns (null equals null)."""
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in columns]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return new.alias("n").join(old.alias("o"), cond, "left_anti")


#: A key with more than this part of all facts is split; there are no more such keys than its inverse.
HOT_SHARE = 1 / 500


def spread_join(facts: DataFrame, per_key: DataFrame, key: str, spread_by: str,
                pieces: int = 32, how: str = "inner") -> tuple[DataFrame, str]:
    """Join facts to a one-row-per-key side without one task owning a hot key.

    A key with more than ``HOT_SHARE`` of the facts is split into ``pieces`` by a hash of ``spread_by``, and its row of the
    other side is repeated once per piece; all others keep one piece, so that side does not grow with the pieces.  Facts are
    read once more, for their keys alone.  Grouping the result by (key, piece, spread_by, ...) can use the join's
    partitioning, so no second shuffle follows.  Returns the frame and the name of the piece column.
    """
    piece = "_piece"
    counts = written(facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")), "key-counts")
    hot = counts.where(F.col("_n") > counts.agg(F.sum("_n")).scalar() * HOT_SHARE).select(key, F.lit(pieces).alias("_pieces"))
    hot = written(hot, "hot-keys")   # a few keys, so Spark sees that they are small
    if hot.isEmpty():
        one = F.lit(0)
        return facts.withColumn(piece, one).join(per_key.withColumn(piece, one), [key, piece], how), piece
    split = F.coalesce("_pieces", F.lit(1))
    left = (facts.join(hot, key, "left")
            .withColumn(piece, F.pmod(F.xxhash64(spread_by), split).cast("int")).drop("_pieces"))
    right = (per_key.join(hot, key, "left")
             .withColumn(piece, F.explode(F.sequence(F.lit(0), split - 1))).drop("_pieces"))
    return left.join(right, [key, piece], how), piece


def semi_filter(facts: DataFrame, chosen: DataFrame, on: str | list[str]) -> DataFrame:
    return facts.join(chosen, on, "left_semi")


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
              zeros: Sequence[str] = ()) -> DataFrame:
    """Full outer join on keys, with null measures turned to 0."""
    out = left.join(right, list(keys), "full")
    return out.fillna(0, subset=list(zeros)) if zeros else out


def renamed_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                 how: str = "left") -> DataFrame:
    """Join on differently named keys and drop the right one."""
    return left.join(right, left[left_on] == right[right_on], how).drop(right[right_on])


def key_translate(facts: DataFrame, lookup: DataFrame, from_key: str, to_key: str) -> DataFrame:
    """Replace one key by another through a lookup; unknown keys become null, a key with
    several translations takes the least."""
    one = lookup.groupBy(from_key).agg(F.min(to_key).alias(to_key))
    return facts.join(one, from_key, "left").drop(from_key)


def any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    cond = F.lit(False)
    for a, b in pairs:
        cond = cond | ~a.eqNullSafe(b)
    return cond
