"""Tables kept as folders of Parquet, and numbered lists of the folders that count.

Nothing is overwritten. A change writes new folders first and then a list with the next number that names them beside
the folders it leaves alone; readers take the list of the greatest number. A run that ends between the two leaves a
folder nobody reads, and running it again gives the same table. A list whose number is taken already is refused, so of two
writers that start from one list the second fails. A table has one row in its list per part, never per data row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangtally.session import scratch_path

ENTRY = "part string, path string, rows bigint, low string, high string, kind string, tag string"


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Versions:
    def __init__(self, spark: SparkSession, root: str, schema: str | T.StructType, part: str):
        """``part`` names the column that deals rows to folders; it is not in ``schema``. Its values must do as folder names."""
        self.spark, self.root, self.part = spark, root, part
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def current(self) -> tuple[int, list[Row]]:
        """Number and entries of the newest list; 0 and none before the first."""
        try:
            lists = self.spark.read.schema(f"{ENTRY}, number int").parquet(f"{self.root}/lists")
        except AnalysisException:   # no list yet
            return 0, []
        number = lists.agg(F.max("number")).first()[0]
        if number is None:
            return 0, []
        rows = lists.where(F.col("number") == number).select(*T._parse_datatype_string(ENTRY).names).collect()
        return number, [r for r in rows if r["kind"] != "list"]

    def write(self, df: DataFrame, mark: str | None = None, kind: str = "base", tag: str = "") -> list[Row]:
        """Writes rows (columns of the schema and the part) to a new folder; entries with row counts and the range of ``mark``."""
        path = f"{self.root}/data/version=v{uuid.uuid4().hex}"
        names = [*self.schema.names, self.part]
        df = df.select(*names)
        df.hint("rebalance", self.part).write.partitionBy(self.part).parquet(path)
        seen = F.col(mark).cast("string") if mark else F.lit(None).cast("string")
        facts = (self.spark.read.schema(df.schema).parquet(path).groupBy(F.col(self.part).cast("string").alias("part"))
                 .agg(F.count("*").alias("rows"), F.min(seen).alias("low"), F.max(seen).alias("high")).collect())
        return [Row(part=r["part"], path=f"{path}/{self.part}={r['part']}", rows=r["rows"], low=r["low"], high=r["high"], kind=kind, tag=tag)
                for r in facts]

    def commit(self, number: int, entries: Iterable[Row]) -> int:
        """The list that follows list ``number``. The first row only says that the list exists."""
        head = Row(part=None, path=None, rows=0, low=None, high=None, kind="list", tag="")
        (self.spark.createDataFrame([tuple(r) for r in (head, *entries)], ENTRY).coalesce(1)
         .write.mode("error").parquet(f"{self.root}/lists/number={number + 1}"))
        return number + 1

    def read(self, entries: Sequence[Row], with_part: bool = False) -> DataFrame:
        """Rows of some entries, each folder once."""
        paths = list(dict.fromkeys(e["path"] for e in entries))
        if not with_part:
            return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, T.StructField(self.part, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths).select(*schema.names)
