"""Comparison of tables and data quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally.operators.joins import any_differs


def cell_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Cells that differ between two tables with the same keys, as text.

    The tables meet once on the key; only differing cells are unpivoted.  A key on one
    side only gives its cells with null on the other.
    """
    keys = list(keys)
    both = left.withColumn("_in", F.lit(True)).alias("l").join(right.withColumn("_in", F.lit(True)).alias("r"), keys, "full")
    cells = []
    for c in columns:
        a, b = F.col(f"l.{c}").cast("string"), F.col(f"r.{c}").cast("string")
        cells.append(F.when(~a.eqNullSafe(b), F.struct(F.lit(c).alias("column_name"), a.alias("left_value"),
                                                       b.alias("right_value"))))
    found = F.filter(F.array(*cells), lambda x: x.isNotNull())
    return both.select(*keys, F.inline(found))


def tolerance_status(a: Column | str, b: Column | str, limit: float = K.DIFF_TOLERANCE) -> tuple[Column, Column]:
    """Numeric difference of two texts and OK / Not OK; texts that are no numbers are OK."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    gap = F.abs(a.try_cast("double") - b.try_cast("double"))
    return gap, F.when(gap.isNull() | (gap < limit), "OK").otherwise("Not OK")


def keyed_compare(left: DataFrame, right: DataFrame, keys: Sequence[str], checked: Sequence[str]) -> DataFrame:
    """Rows that match on the keys and differ in a checked column."""
    keys = list(keys)
    both = left.alias("l").join(right.alias("r"), keys)
    diff = any_differs([(F.col(f"l.{c}"), F.col(f"r.{c}")) for c in checked])
    cols = [F.col(f"l.{c}").alias(f"{c}_left") for c in checked] + [F.col(f"r.{c}").alias(f"{c}_right") for c in checked]
    return both.where(diff).select(*keys, *cols)


def bad_codes(df: DataFrame, code: str) -> DataFrame:
    """Codes with white space and codes that occur more than once."""
    counts = df.where(F.col(code).isNotNull()).groupBy(code).agg(F.count("*").alias("n"))
    problem = F.when(F.col(code).rlike(r"\s"), "white space").when(F.col("n") > 1, "duplicate")
    return counts.withColumn("problem", problem).where("problem is not null")


def fill_from_siblings(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Null attributes filled from rows of the same key where all of them are known.

    One row per key is joined back (the greatest), so no row is multiplied.
    """
    known = df.dropna(subset=[key, *columns])
    best = known.groupBy(key).agg(F.max(F.struct(*columns)).alias("_k"))
    out = df.join(best, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_k.{c}")) for c in columns}).drop("_k")


def schema_by_prefix(df: DataFrame) -> DataFrame:
    """Cast columns by the naming rule: doubles to decimal(15,2), fn to int, fd to timestamp,
    fv and fc and all others to text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if f.dataType.simpleString() in ("double", "float"):
            c = c.cast("decimal(15,2)")
        elif f.name.startswith("fn"):
            c = c.cast("int")
        elif f.name.startswith("fd"):
            c = c.cast("timestamp_ntz")
        else:
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def prefix_names(df: DataFrame) -> DataFrame:
    """Put the type prefix in front of column names that lack it."""
    names = {}
    for f in df.schema:
        if f.name[:3] in ("fn_", "fv_", "fd_", "fc_"):
            continue
        kind = f.dataType.simpleString()
        if kind in ("date", "timestamp", "timestamp_ntz"):
            names[f.name] = f"fd_{f.name}"
        elif kind == "string":
            names[f.name] = f"fv_{f.name}"
        else:
            names[f.name] = f"fn_{f.name}"
    return df.withColumnsRenamed(names)
