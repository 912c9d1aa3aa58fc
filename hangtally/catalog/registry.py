"""Registration of queries and of the SQL text that checks them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangtally.sources.standins import Standins, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def report(df: DataFrame) -> DataFrame:
    """Portable result: dates and timestamps as ISO text, decimals as doubles."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            c = c.cast("string").alias(f.name)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        out.append(c)
    return df.select(*out)


def query(name: str, sql: str | None = None, dates: Sequence[str] = ()):
    """Register a function of the stand-ins; ``dates`` names the date columns of the SQL."""
    def add(fn: Callable[[Standins], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: report(fn(Standins(spark, folder)))
        if sql is not None:
            text = with_views(sql)
            if dates:
                casts = ", ".join(f'CAST("{d}" AS VARCHAR) AS "{d}"' for d in dates)
                text = f"SELECT * REPLACE ({casts}) FROM (\n{text}\n) AS result"
            ORACLES[name] = text
        return fn
    return add


def half_even(expr: str, digits: int = 0) -> str:
    """SQL text of half-even rounding: scale, nearest (even on ties), scale back."""
    scale = float(10 ** digits)
    t = f"(({expr}) * {scale}e0)"
    return f"(CASE WHEN {t} - FLOOR({t}) = 0.5 THEN 2 * ROUND({t} / 2) ELSE ROUND({t}) END / {scale}e0)"


def pct(a: str, b: str, digits: int = 2) -> str:
    """SQL text of a percentage that is 0 where it cannot be computed."""
    return half_even(f"COALESCE(({a}) / NULLIF({b}, 0), 0) * 100.0e0", digits)
