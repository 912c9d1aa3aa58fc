"""How far the sources of a language differ in their words, by ranking count cells.

Terms are runs of letters A-Z (lower-cased) and of characters from U+0080 on. A language keeps the terms that at least
``LEAST_DOCS`` of its documents hold. A group is a (lang, source) that occurs. With V kept terms and N kept occurrences a
count c has the share ``p(c) = 1 + floor(10^9 * (c + 2) / (N + 2 * V))``, and two shares differ by
``f = floor((p - q)^2 / (p + q))``. All of it is integer arithmetic: products that may pass 64 bits are decimals.

f depends on counts alone, so terms with the same counts form a *cell*, and f is evaluated once per cell:

* ``term`` rows of a group: cells (count in the group, count in the language) with p above the language's q. Cells of
  equal value are merged; the values down to the one in which the cumulative number of terms reaches ``RANKS`` are expanded
  to terms again, in UTF-8 order.
* ``pair`` rows of two sources: cells (count here, count there) of terms that both have, plus each source's own histogram of
  counts against 0, minus what the first cells took from it, plus the terms neither has. So only terms that two
  sources share meet, and they are added up to cells inside the task; the sum over all kept terms comes out exactly.

Cases: null text, lang or source is empty. A group without terms has count 0 for each kept term. A language
without kept terms has pairs of value 0 and no terms; one with a single source has no pairs. Equal rows are documents of
their own. Ties of value stand in UTF-8 order of the item. Very long texts are cut at separators, so a task holds their
distinct terms only. An empty table gives an empty result. Further columns of any name are not read.

Groups that hold a third of all rows are counted inside the tasks first; no step gathers the terms of a group or a language.
The pairs, at most one row for two sources of a language, are the result itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from hangtally.llm.common import batch, pieces, prepare, stored

LEAST_DOCS, RANKS, SCALE = 10, 10, 1_000_000_000
#: Terms a task counts before it hands them on, and pairs of counts it holds before it adds them up to cells.
HELD_TERMS, HELD_PAIRS = 300_000, 1_000_000

_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
TALLY = "lang string, source string, term string, n bigint, docs bigint"
SHARED = "lang string, source string, item string, here bigint, there bigint, terms bigint"


def share(count: str, total: str, kept: str) -> str:
    """SQL of p of a count; null where the language keeps no term."""
    return (f"(cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0)) "
            f"div cast(nullif({total} + 2 * {kept}, 0) as decimal(20,0)) + 1)")


def apart(p: str, q: str) -> str:
    """SQL of f of two shares. Both are at most 10^9 + 1, so the square fits into 64 bits."""
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def tallied(docs: DataFrame) -> DataFrame:
    """Rows of ``TALLY`` from the tasks, still to be added up."""
    prepare(docs.sparkSession)
    schema = to_arrow_schema(_parse_datatype_string(TALLY))

    def flushed(counts: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in counts.items():
            terms = list(n)
            for at in range(0, len(terms), 50_000):
                part = terms[at:at + 50_000]
                yield batch(schema, [lang] * len(part), [source] * len(part), pa.array(part, pa.binary()).cast(pa.string()),
                            list(map(n.__getitem__, part)), list(map(d.__getitem__, part)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = {}, 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                n, d = counts.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(n), set()
                for piece in pieces(text.as_py().translate(_LETTERS)):
                    words = piece.split()
                    n.update(words)
                    own.update(words)
                d.update(own)
                held += len(n) - before
                if held > HELD_TERMS:
                    yield from flushed(counts)
                    counts, held = {}, 0
        yield from flushed(counts)

    return docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(work, TALLY)


def kept_counts(docs: DataFrame) -> DataFrame:
    """Counts above 0 of kept terms: lang, source, term, a (in the group), c (in the language), leads (one row a term)."""
    # the tasks have added up already, and one exchange by language and term serves both sums
    summed = tallied(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("a"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    return (summed.withColumn("c", F.sum("a").over(whole)).withColumn("docs", F.sum("docs").over(whole))
            .withColumn("leads", F.col("source") == F.min("source").over(whole)).where(f"docs >= {LEAST_DOCS}")
            .select("lang", "source", "term", "a", "c", "leads"))


def groups_of(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """Every group: lang, source, n (occurrences), own (different kept terms), total and kept of the language."""
    of_lang = counts.groupBy("lang").agg(F.sum("a").alias("total"), F.count_if("leads").alias("kept"))
    of_group = counts.groupBy("lang", "source").agg(F.sum("a").alias("n"), F.count("*").alias("own"))
    every = docs.select("lang", "source").distinct()
    return (every.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
            .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "own", "total", "kept")]))


def shared_cells(counts: DataFrame) -> DataFrame:
    """Rows of ``SHARED``: how many terms have count ``here`` in source and ``there`` in item (item after source)."""
    schema = to_arrow_schema(_parse_datatype_string(SHARED))
    keys = ["lang", "source", "item", "here", "there"]

    def cells(parts: list) -> Iterator[pa.RecordBatch]:
        if parts:
            made = pd.concat(parts).groupby(keys, sort=False).size().reset_index(name="terms")
            yield batch(schema, *[pa.array(made[k].tolist(), f.type) for k, f in zip([*keys, "terms"], schema)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, rest = [], 0, None
        for b in _and_none(batches):
            block = b if rest is None else rest if b is None else pd.concat([rest, b], ignore_index=True)
            if block is None or block.empty:
                continue
            term = (block[["lang", "term"]] != block[["lang", "term"]].shift()).any(axis=1).cumsum().to_numpy()
            whole = len(block) if b is None else int(np.searchsorted(term, term[-1]))   # the last term may go on in the next batch
            rest, block, term = block.iloc[whole:], block.iloc[:whole], term[:whole]
            lang, source, a = (block[k].to_numpy() for k in ("lang", "source", "a"))
            for step in range(1, whole):
                at = np.flatnonzero(term[step:] == term[:-step])
                if not len(at):
                    break
                parts.append(pd.DataFrame(dict(zip(keys, (lang[at], source[at], source[at + step], a[at], a[at + step])))))
                held += len(at)
                if held > HELD_PAIRS:
                    yield from cells(parts)
                    parts, held = [], 0
        yield from cells(parts)

    def _and_none(batches):
        for b in batches:
            if b.num_rows:
                yield b.to_pandas()
        yield None

    ordered = counts.select("lang", "term", "source", "a").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return ordered.mapInArrow(work, SHARED).groupBy(*keys).agg(F.sum("terms").alias("terms"))


def pair_rows(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Part ``pair``: for each source of a language every other one and their sum of f over all kept terms."""
    there = groups.select("lang", F.col("source").alias("item"), F.col("n").alias("item_n"), F.col("own").alias("item_own"))
    pairs = groups.join(there, "lang").where("source <> item")
    here0, there0 = share("0L", "n", "kept"), share("0L", "item_n", "kept")
    here, other = share("here", "n", "kept"), share("there", "item_n", "kept")
    neither = pairs.select("lang", "source", "item", F.expr(f"coalesce((kept - own - item_own) * {apart(here0, there0)}, 0L)").alias("value"))
    own = counts.groupBy("lang", "source", F.col("a").alias("here")).agg(F.count("*").alias("terms"))
    alone = pairs.join(own, ["lang", "source"]).select("lang", "source", "item", F.expr(f"terms * {apart(here, there0)}").alias("value"))
    shared = shared_cells(counts).join(pairs, ["lang", "source", "item"]).select("lang", "source", "item", F.expr(
        f"terms * ({apart(here, other)} - {apart(here, there0)} - {apart(here0, other)} + {apart(here0, there0)})").alias("value"))
    both = lambda rows: rows.select("lang", "value", F.inline(F.expr("array(struct(source, item), struct(item as source, source as item))"))).select("lang", "source", "item", "value")
    summed = neither.union(both(alone)).union(both(shared)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def term_rows(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Part ``term``: the terms of greatest f that a group has more often than its language."""
    group = Window.partitionBy("lang", "source")
    cells = counts.groupBy("lang", "source", "a", "c").agg(F.count("*").alias("terms")).join(groups, ["lang", "source"])
    p, q = share("a", "n", "kept"), share("c", "total", "kept")
    cells = cells.where(f"{p} > {q}").select("lang", "source", "a", "c", "terms", F.expr(apart(p, q)).alias("value"))
    # each value holds one term or more, so no more than RANKS values are needed
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms")).withColumn(
        "place", F.row_number().over(group.orderBy(F.desc("value")))).where(f"place <= {RANKS}")
    earlier = F.coalesce(F.sum("terms").over(group.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("earlier", earlier).where(f"earlier < {RANKS}").select("lang", "source", "value")
    terms = counts.join(cells.join(values, ["lang", "source", "value"]).drop("terms"), ["lang", "source", "a", "c"])
    order = group.orderBy(F.desc("value"), "term")
    return (terms.withColumn("rank", F.row_number().over(order)).where(f"rank <= {RANKS}")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def audit(docs: DataFrame) -> DataFrame:
    """Both parts for documents with columns text, lang, source: lang, source, part, item, value, rank."""
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stored(kept_counts(docs), "kept-counts")
    groups = stored(groups_of(docs, counts), "groups")
    return pair_rows(counts, groups).union(term_rows(counts, groups))
