"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangtally.operators.numbering import number_rows
from hangtally.operators.upsert import merge_upsert


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of one output folder together, few files each; adaptive execution splits the
    large folders over several tasks and merges the small ones."""
    return df.hint("rebalance", *columns) if columns else df


def overwrite(df: DataFrame, *paths: str, partition_by: Sequence[str] = ()) -> None:
    """Write the same frame to one or more places; with several it is computed once."""
    if len(paths) > 1:
        df = df.persist()
    for path in paths:
        rebalanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    if len(paths) > 1:
        df.unpersist()


def write_months(df: DataFrame, date: str, path: str) -> None:
    """One Parquet folder per month, ``month=yyyy-MM``. A frame that has its months already (``ledger.net_by_month``) is written as it is dealt."""
    if "month" not in df.columns:
        df = rebalanced(df.withColumn("month", F.date_format(date, "yyyy-MM")), ["month"])
    df.write.partitionBy("month").parquet(path)


def export_by_month(df: DataFrame, date: str, path: str) -> None:
    """One CSV folder per year and month."""
    parts = ["year", "month"]
    (rebalanced(df.withColumns({"year": F.year(date), "month": F.month(date)}), parts)
     .write.mode("overwrite").partitionBy("year", "month").option("header", True).csv(path))


def export_in_parts(df: DataFrame, path: str, rows_per_file: int) -> None:
    """CSV files of at most ``rows_per_file`` rows."""
    (df.write.mode("overwrite").option("header", True)
     .option("maxRecordsPerFile", rows_per_file).csv(path))


def export_in_equal_parts(df: DataFrame, path: str, order_id: str, ties: Sequence[str] = (), parts: int = 3) -> None:
    """CSV folders part=0, 1, ... of equally many rows (one more or less) in the order of ``order_id``."""
    total = df.agg(F.count("*")).scalar()
    numbered = number_rows(df, [], order_id, "_n", ties)
    placed = numbered.withColumn("part", F.floor((F.col("_n") - 1) * parts / total)).drop("_n")
    rebalanced(placed, ["part"]).write.mode("overwrite").partitionBy("part").option("header", True).csv(path)


def upsert_to(spark: SparkSession, old_path: str, new_path: str, source: DataFrame,
              keys: Sequence[str]) -> DataFrame:
    """Merge into the table at ``old_path`` and write the result to ``new_path``.

    The old table is never overwritten while it is read; the caller points readers at the
    new path.  With an empty source nothing is written and the old table is returned.
    """
    if old_path == new_path:
        raise ValueError("write to a new path")
    target = spark.read.parquet(old_path)
    if source.isEmpty():
        return target
    merge_upsert(target, source, keys).write.mode("overwrite").parquet(new_path)
    return spark.read.parquet(new_path)
