"""Month periods taken from the data's own date range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def month_calendar(df: DataFrame, date: str) -> DataFrame:
    """All months from January of the first year to the month after the last date, but not
    beyond that date's year."""
    span = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    first = F.trunc("lo", "YEAR")
    last = F.least(F.add_months(F.trunc("hi", "YEAR"), 11), F.add_months(F.trunc("hi", "MM"), 1))
    months = span.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("start_date"))
    return months.select(F.lower(F.date_format("start_date", "MMM_yy")).alias("label"), "start_date",
                         F.last_day("start_date").alias("end_date"))


def last_month_ends(df: DataFrame, keys: Sequence[str], date: str, months: int) -> DataFrame:
    """Month ends of the month of the latest date of each key and of the months before it."""
    ends = F.array(*[F.last_day(F.add_months(F.trunc("_d", "MM"), -i)) for i in range(months - 1, -1, -1)])
    return df.groupBy(*keys).agg(F.max(date).alias("_d")).select(*keys, F.explode(ends).alias("month_end"))
