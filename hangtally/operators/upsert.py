"""Insert-or-update by key as plain joins; the caller writes the result to a new path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_columns(target: DataFrame, source: DataFrame) -> None:
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"unknown columns in source: {unknown}")


def one_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """If a key comes more than once, the greatest row is written (a fixed choice)."""
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.select(*keys).distinct()
    row = F.max(F.struct(*rest)).alias("_r")
    return source.groupBy(*keys).agg(row).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; source columns must be known.

    Columns the source does not have keep their old value (null for new keys).
    """
    check_columns(target, source)
    keys = list(keys)
    if set(source.columns) == set(target.columns):
        fresh = one_per_key(source, keys)
        return target.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh.select(*target.columns))
    return merge_upsert_columns(target, source, keys, [c for c in source.columns if c not in keys])


def merge_upsert_columns(target: DataFrame, source: DataFrame, keys: Sequence[str],
                         columns: Sequence[str]) -> DataFrame:
    """Write only the listed columns of existing keys and insert new keys, in one join."""
    check_columns(target, source)
    keys = list(keys)
    t = target.withColumn("_old", F.lit(True)).alias("t")
    s = one_per_key(source, keys).withColumn("_new", F.lit(True)).alias("s")
    both = t.join(s, keys, "full")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in columns:
            out.append(F.when(F.col("s._new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return both.select(*out)
