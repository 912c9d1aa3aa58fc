"""A table kept by key in buckets: an upsert writes only the buckets it touches.

Rows are dealt to buckets by a hash of the key; the list of versions says for each bucket which folder counts, how many rows
it has and from where to where the mark column reaches. So the high-water mark is read from the list, and a change reads and writes
the touched buckets alone. The change itself is read once. Until the new list stands readers see the old rows;
an upsert that ends before that, or runs twice, leaves the table as one whole run does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangtally.operators.upsert import merge_upsert, merge_upsert_columns, one_per_key
from hangtally.sources.versions import Versions

BUCKET = "bucket"


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, schema: str | T.StructType, keys: Sequence[str], mark: str | None = None, buckets: int = 64):
        """The number of buckets stays that of the table's first write."""
        self.versions = Versions(spark, root, schema, BUCKET)
        self.spark, self.keys, self.mark, self.buckets = spark, list(keys), mark, buckets

    @property
    def columns(self) -> list[str]:
        return self.versions.schema.names

    def rows(self) -> DataFrame:
        return self.versions.read(self.versions.current()[1])

    def marks(self) -> tuple[str | None, str | None]:
        """Least and greatest value of the mark, from the list alone."""
        entries = self.versions.current()[1]
        return (min((e["low"] for e in entries if e["low"] is not None), default=None),
                max((e["high"] for e in entries if e["high"] is not None), default=None))

    def _dealt(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _arrived(self, change: DataFrame) -> tuple[DataFrame, set[str]]:
        """The change, read once and written by bucket, and the buckets it touches."""
        table = Versions(self.spark, f"{self.versions.root}/arrived", change.schema, BUCKET)
        entries = table.write(self._dealt(change))
        return table.read(entries), {e["part"] for e in entries}

    def _swap(self, number: int, entries: list[Row], rows: DataFrame, touched: set[str]) -> list[str]:
        new = self.versions.write(self._dealt(rows.select(*self.columns)), self.mark) if touched else []
        self.versions.commit(number, [*(e for e in entries if e["part"] not in touched), *new])
        return sorted(touched)

    def create(self, df: DataFrame) -> None:
        number, _ = self.versions.current()
        self.versions.commit(number, self.versions.write(self._dealt(one_per_key(df, self.keys)), self.mark))

    def upsert(self, change: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
        """Rows of the change replace rows of their key, or only in some columns; the buckets written anew.

        Columns the change does not have keep their values. A change without rows writes nothing.
        """
        if unknown := [c for c in change.columns if c not in self.columns]:
            raise ValueError(f"unknown columns in source: {unknown}")
        number, entries = self.versions.current()
        change, touched = self._arrived(change)
        if not touched:
            return []
        old = self.versions.read([e for e in entries if e["part"] in touched])
        new = merge_upsert_columns(old, change, self.keys, columns) if columns else merge_upsert(old, change, self.keys)
        return self._swap(number, entries, new, touched)

    def refresh(self, source: DataFrame) -> list[str]:
        """New rows in, vanished rows out: rows of the source at or after the table's greatest mark are written, and rows of
        the table whose key the source no longer has within the table's marks go. The source is read once, from the least mark on.
        """
        number, entries = self.versions.current()
        low, high = self.marks()
        mark = F.col(self.mark)
        kind = self.versions.schema[self.mark].dataType
        source = source.select(*self.columns)
        if low is None:
            source, _ = self._arrived(source)
            return self.upsert(source)
        low, high = (F.lit(x).cast(kind) for x in (low, high))
        source, _ = self._arrived(source.where(mark >= low))
        table = self.versions.read(entries)
        gone = table.select(*self.keys).join(source.where(mark <= high), self.keys, "left_anti")
        gone, left = self._arrived(gone)
        fresh, came = self._arrived(source.where(mark >= high))
        touched = left | came
        old = self.versions.read([e for e in entries if e["part"] in touched])
        return self._swap(number, entries, merge_upsert(old.join(gone, self.keys, "left_anti"), fresh, self.keys), touched)
