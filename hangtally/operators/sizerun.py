"""Size pivots and the health of size runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hangtally import constants as K


def class_list(articles: DataFrame, size_class: str = "size_class") -> Column:
    """All size classes of the article dimension in the order in which they win: others by name, then BOTTOM, then TOP."""
    # a handful of names, whatever the number of articles
    known = articles.agg(F.array_sort(F.collect_set(size_class)).alias("_c")).scalar()
    named = F.array(F.lit("BOTTOM"), F.lit("TOP"))
    return F.concat(F.array_except(F.coalesce(known, F.array().cast("array<string>")), named), named)


def class_code(size_class: Column, classes: Column) -> Column:
    """The size class as its place in the list.  A text cannot be kept in a hash aggregate's buffer (the
    whole input would be sorted instead), a number can."""
    return F.when(size_class.isNotNull(), F.array_position(classes, size_class))


def class_name(code: Column, classes: Column) -> Column:
    return F.get(classes, (code - 1).cast("int"))


def size_cells(value: str, size: str = "size", every_size: bool = False) -> list[Column]:
    """One zero-filled sum per known size and their total (or that of every size that occurs); the list is fixed, so one shuffle
    is enough.  The total is an aggregate of its own, not a sum of 28 columns."""
    known = ", ".join(f"'{s}'" for s in K.ALL_SIZES)
    cells = {s: f"{size} = '{s}'" for s in K.ALL_SIZES} | {"sum_qty": f"{size} is not null" if every_size else f"{size} in ({known})"}
    return [F.expr(f"cast(coalesce(sum(case when {test} then {value} end), 0) as bigint) as `{name}`")
            for name, test in cells.items()]


def size_pivot(df: DataFrame, keys: Sequence[str], value: str, size: str = "size",
               size_class: str | None = "size_class", extra: Sequence[Column] = (),
               every_size: bool = False, articles: DataFrame | None = None) -> DataFrame:
    """One column per known size, their sum as ``sum_qty``, and the size class of the key.

    The class is an attribute of the key; if rows disagree, TOP wins, so the pivot never
    grows rows.  ``extra`` aggregates ride along in the same shuffle.  The classes that exist are
    read from ``articles`` (the dimension), else from the rows themselves.
    """
    aggs = [*size_cells(f"`{value}`", size, every_size), *extra]
    if size_class:
        classes = class_list(df if articles is None else articles, size_class)
        aggs.append(F.max(class_code(F.col(size_class), classes)).alias("_class"))
    wide = df.dropna(subset=list(keys)).groupBy(*keys).agg(*aggs)
    return wide.withColumn("size_class", class_name(F.col("_class"), classes)).drop("_class") if size_class else wide


def add(columns: Sequence[str]) -> Column:
    return F.expr(" + ".join(f"`{c}`" for c in columns))


def in_stock(columns: Sequence[str]) -> Column:
    return F.expr(" + ".join(f"int(`{c}` > 0)" for c in columns))


def run_status(df: DataFrame, out: str = "status", size_class: str = "size_class",
               top: Sequence[str] = tuple(K.TOP_RUN), top_min: int = K.TOP_RUN_MIN,
               bottom: Sequence[str] = tuple(K.BOTTOM_RUN),
               bottom_min: int = K.BOTTOM_RUN_MIN) -> DataFrame:
    """BROKEN if too few sizes of the class are in stock, else complete."""
    broken = (((F.col(size_class) == "TOP") & (in_stock(top) < top_min))
              | ((F.col(size_class) == "BOTTOM") & (in_stock(bottom) < bottom_min)))
    return df.withColumn(out, F.when(broken, K.BROKEN).otherwise(K.COMPLETE))


def size_buckets(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "size_small": add(K.SMALL_SIZES),
        "size_medium": add(K.MEDIUM_SIZES),
        "size_large": add(K.LARGE_SIZES),
    })


def dominant_bucket(small: str = "size_small", medium: str = "size_medium",
                    large: str = "size_large") -> Column:
    """Letters of the bucket or buckets that hold the maximum."""
    k, s, b = F.col(small), F.col(medium), F.col(large)
    top = F.greatest(k, s, b)
    return F.concat(F.when(k == top, "k").otherwise(""), F.when(s == top, "s").otherwise(""),
                    F.when(b == top, "b").otherwise(""))


def top_half_sizes(df: DataFrame, keys: Sequence[str], value: str, size: str = "size",
                   share: float = K.TOP_SIZE_SHARE) -> DataFrame:
    """The largest sizes that together reach the share of the total, as text.

    Works on the long form; after the sum a key has at most one row per known size, so
    the window is bounded.  Ties are ordered by size name.  Keys without sales give ''.
    """
    keys = list(keys)
    by_size = (df.dropna(subset=keys).where(F.col(size).isin(K.ALL_SIZES))
               .groupBy(*keys, size).agg(F.sum(value).alias("_q")))
    order = Window.partitionBy(*keys).orderBy(F.desc("_q"), F.asc(size))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = (by_size
              .withColumn("_total", F.sum("_q").over(Window.partitionBy(*keys)))
              .withColumn("_cum", F.sum("_q").over(upto))
              .withColumn("_pos", F.row_number().over(order))
              .withColumn("_take", (F.col("_total") != 0)
                          & (F.col("_cum") - F.col("_q") < F.col("_total") * share)))
    picked = F.array_sort(F.collect_list(F.when(F.col("_take"), F.struct("_pos", size))))
    return (marked.groupBy(*keys).agg(picked.alias("_p"), F.max("_total").alias("total_qty"))
            .select(*keys, "total_qty",
                    F.array_join(F.transform("_p", lambda x: x[size]), ", ").alias("dominant_sizes")))
