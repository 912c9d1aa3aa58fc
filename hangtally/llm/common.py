"""Helpers shared by the operators: code shipping, stored tables, connected components."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from hangtally.session import scratch_path

#: Rows and bytes in one Arrow batch.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def prepare(spark: SparkSession) -> None:
    """Ships this package to the executors once per session and bounds the Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if getattr(spark.sparkContext, "_hangtally_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="ship-")) / "hangtally.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(str(target))
    spark.sparkContext._hangtally_shipped = True


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Returns what this process has freed to the system, as far as Arrow and the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim is not None:
        trim(0)


def frugal(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow; Spark keeps its worker for tasks of other stages, so freed memory goes back when a task ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()
    return run


def few_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few rows that the driver has. As an Arrow table it takes no Python workers on the executors, as a list it does."""
    kind = _parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), kind)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches, one after the other, as tuples."""
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def pieces(raw: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Parts of a text of about ``size`` bytes, cut at spaces, so a very long text needs no list of all its words."""
    at = 0
    while len(raw) - at > size:
        cut = raw.find(b" ", at + size)
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of edges (u, v: long): rows (node, component), component the smallest node.

    Alternating large-star and small-star steps: every step keeps the components and shortens the
    paths, until no node hangs on two others or on one that hangs itself; then each hangs on the
    smallest one. Sums and joins only; the edges of each round are written to the shared folder.
    Self loops are dropped, nulls too; no edges give no rows. ``edges`` is read more than once, so
    it should be a stored table.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    unsettled = 1
    while unsettled:
        both = e.select(F.inline(F.expr("array(struct(u, v), struct(v as u, u as v))")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        # the node itself hangs on its smallest neighbour as well
        small = small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e = stored(small, label)
        ends = e.select(F.inline(F.expr("array(struct(u as node, 1 as hangs, 0 as holds), struct(v as node, 0 as hangs, 1 as holds))")))
        places = ends.groupBy("node").agg((F.sum("hangs") + F.max("holds")).alias("n"))
        unsettled = places.where("n > 1").agg(F.count("*")).first()[0]
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stored(e.selectExpr("u as node", "v as component").union(roots), label)
