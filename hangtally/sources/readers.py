"""Sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: str, upper: str,
              partitions: int, properties: dict[str, str]) -> DataFrame:
    """A live table in parallel slices of one column."""
    return (spark.read.format("jdbc").options(**properties)
            .option("url", url).option("dbtable", table)
            .option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions).load())


def read_year(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One year of a table partitioned by year: only its folder is read."""
    return spark.read.parquet(path).where(F.col("year") == year)


def read_months(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written by ``sinks.write_months``; ``schema`` is that of its rows."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("month", T.StringType())])).parquet(path)


def within_months(df: DataFrame, date: str, lo: str | None, hi: str | None) -> DataFrame:
    """Rows between two days; only the folders of their months are read."""
    if lo:
        df = df.where((F.col("month") >= lo[:7]) & (F.col(date) >= F.lit(lo).cast("date")))
    if hi:
        df = df.where((F.col("month") <= hi[:7]) & (F.col(date) <= F.lit(hi).cast("date")))
    return df


def snapshot_labels(start_year: int, end_year: int) -> list[str]:
    """Month labels of the years and the January after them, each once."""
    from hangtally.constants import MONTH_NAMES
    labels = [f"{m}_{y % 100:02d}" for y in range(start_year, end_year + 1) for m in MONTH_NAMES]
    labels.append(f"jan_{(end_year + 1) % 100:02d}")
    return list(dict.fromkeys(labels))


def read_snapshots(spark: SparkSession, base: str, labels: Sequence[str]) -> DataFrame:
    """All monthly snapshots that exist under ``base`` (one folder per ``label=..``), read in
    one scan and summed by store and SKU.  Months without a snapshot are skipped."""
    df = spark.read.parquet(base).where(F.col("label").isin(list(labels)))
    return df.groupBy("store_id", "sku", "label").agg(F.sum("qty").alias("qty"))


def read_snapshot_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Snapshot files whose month columns differ: one scan with a merged schema, then the
    sum of all numeric columns by store and SKU.  A path listed twice is read once."""
    df = spark.read.option("mergeSchema", "true").parquet(*dict.fromkeys(paths))
    keys = ("store_id", "sku")
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(f"`{c}`"), F.lit(0.0)).alias(c) for c in numbers])
