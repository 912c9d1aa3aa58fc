"""Consecutive numbers without moving a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hangtally.sources.versions import written


def number_rows(df: DataFrame, keys: Sequence[str], order_id: str, out: str, ties: Sequence[str] = ()) -> DataFrame:
    """1, 2, 3 ... per key in the order of ``order_id`` (then ``ties``, then a hash of the row). Null ids come first.

    Rows are dealt to tasks by sampled ranges of that order and sorted there, so a key with most of the rows, an id far from
    all others or a million equal ids still spread over many tasks. A row's number is its place in its task, less the
    place of its key's first row there, plus the key's rows in the tasks before; those counts are one row per task and key.
    """
    keys = list(keys)
    order = [*keys, order_id, *ties, "_spread"]
    dealt = df.withColumn("_spread", F.xxhash64(*df.columns)).repartitionByRange(*order).sortWithinPartitions(*order).drop("_spread")
    # sampled ranges may differ when a plan runs twice, so the places are written down
    placed = written(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn("_task", F.shiftright("_at", 33))
    before = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (placed.groupBy(*keys, "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
              .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first")))
    left, right = placed.alias("l"), shifts.select(*keys, "_task", "_shift").alias("r")
    same = F.col("l._task") == F.col("r._task")
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return (left.join(right, same)
            .select(*[F.col(f"l.`{c}`") for c in df.columns], (F.col("l._at") + F.col("r._shift")).cast("long").alias(out)))


def running_suffix(df: DataFrame, code: str, unique_id: str, out: str) -> DataFrame:
    """Make a code unique: the first keeps it, later ones get 2, 3 ... appended."""
    numbered = number_rows(df, [code], unique_id, "_n")
    tail = F.when(F.col("_n") == 1, "").otherwise(F.col("_n").cast("string"))
    return numbered.withColumn(out, F.concat(code, tail)).drop("_n")


def sequence_fill(df: DataFrame, target: str, order_id: str, start: int) -> DataFrame:
    """Fill null ids in the order of ``order_id``: start, start + 1, ..., or after the greatest
    used id where ids from start on are already used."""
    numbered = number_rows(df.withColumn("_gap", F.col(target).isNull()), ["_gap"], order_id, "_n")
    used = df.where(F.col(target) >= start).agg(F.max(target)).scalar()
    spare = (F.col("_n") + F.coalesce(used, F.lit(start - 1))).cast(df.schema[target].dataType)
    return (numbered.withColumn(target, F.when(F.col("_gap"), spare).otherwise(F.col(target)))
            .select(*df.columns))


def pair_by_position(left: DataFrame, right: DataFrame, keys: Sequence[str], order_id: str,
                     ties: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Number the rows of two frames per document, so that they can be compared by position."""
    return (number_rows(left, keys, order_id, "position", ties),
            number_rows(right, keys, order_id, "position", ties))
