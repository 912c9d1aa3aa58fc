"""Size pivots and size-run health."""

from __future__ import annotations

from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally.catalog.registry import query
from hangtally.operators import aging as AG
from hangtally.operators import sizerun as G


def cells(value: str) -> str:
    return ", ".join(f"""CAST(COALESCE(SUM(CASE WHEN size = '{z}' THEN {value} END), 0) AS BIGINT) AS "{z}" """ for z in K.ALL_SIZES)


def plus(sizes) -> str:
    return " + ".join(f'"{z}"' for z in sizes)


def have(sizes) -> str:
    return " + ".join(f'CASE WHEN "{z}" > 0 THEN 1 ELSE 0 END' for z in sizes)


def status_sql(top=K.TOP_RUN, top_min=3, bottom=K.BOTTOM_RUN) -> str:
    return (f"CASE WHEN size_class = 'TOP' AND {have(top)} < {top_min} THEN 'BROKEN' "
            f"WHEN size_class = 'BOTTOM' AND {have(bottom)} < 5 THEN 'BROKEN' ELSE 'SEHAT' END")


PIVOT = f"""
    raw_pivot AS (SELECT store_id, article, MAX(size_class) AS size_class, {cells('qty')} FROM movement JOIN article USING (sku) GROUP BY store_id, article),
    pivoted AS (SELECT *, {plus(K.ALL_SIZES)} AS sum_qty FROM raw_pivot)"""


def pivot(s):
    return G.size_pivot(s.movement.join(s.article, "sku"), ["store_id", "article"], "qty", articles=s.article)


@query("size_pivot", f"WITH {PIVOT} SELECT * FROM pivoted")
def _(s):
    return pivot(s)


@query("size_run_status", f"WITH {PIVOT} SELECT *, {status_sql()} AS status FROM pivoted")
def _(s):
    return G.run_status(pivot(s))


WITH_SALES = f"""
    raw_pivot AS (SELECT store_id, article, MAX(size_class) AS size_class, {cells('qty')},
        SUM(CASE WHEN stat = 'penjualan' THEN -qty ELSE 0 END) AS sales_qty,
        CAST(COALESCE(SUM(qty) FILTER (WHERE size IS NOT NULL), 0) AS BIGINT) AS sum_qty
        FROM movement JOIN article USING (sku) GROUP BY store_id, article),
    pivoted AS (SELECT * FROM raw_pivot),
    v2 AS (SELECT store_id, article, sum_qty, sales_qty, {status_sql(K.TOP_RUN_WITH_FREE, 2)} AS status FROM pivoted
           WHERE sum_qty <> 0 OR sales_qty <> 0)"""


def status_v2(s):
    """Status with the free size counted, sales beside stock, rows without either left out."""
    from hangtally.plans.stock_reports import status_with_sales
    return status_with_sales(s.movement.join(s.article, "sku"), s.article)


@query("size_run_status_v2", f"WITH {WITH_SALES} SELECT * FROM v2")
def _(s):
    return status_v2(s)


SALES_PIVOT = f"""
    raw_pivot AS (SELECT store_id, article, MAX(size_class) AS size_class, MAX(category) AS category, {cells('qty')}
        FROM sales_line JOIN article USING (sku) WHERE sales_date BETWEEN DATE '1999-06-30' AND DATE '1999-09-28' GROUP BY store_id, article),
    pivoted AS (SELECT *, {plus(K.ALL_SIZES)} AS sum_qty FROM raw_pivot),
    bucket AS (SELECT store_id, article, category, {plus(K.SMALL_SIZES)} AS size_small, {plus(K.MEDIUM_SIZES)} AS size_medium,
                      {plus(K.LARGE_SIZES)} AS size_large FROM pivoted)"""
DOMINANT = """CASE WHEN size_small = GREATEST(size_small, size_medium, size_large) THEN 'k' ELSE '' END
    || CASE WHEN size_medium = GREATEST(size_small, size_medium, size_large) THEN 's' ELSE '' END
    || CASE WHEN size_large = GREATEST(size_small, size_medium, size_large) THEN 'b' ELSE '' END"""


def season_sales(s):
    """Sales of the ninety days after the same day of last year."""
    return s.between("1999-06-30", "1999-09-28").sales_line.join(s.article, "sku")


def sales_pivot(s, *keys):
    return G.size_pivot(season_sales(s), list(keys), "qty")


@query("size_run_status_sales", f"""
    WITH {SALES_PIVOT} SELECT store_id, article, sum_qty, {status_sql(bottom=K.BOTTOM_RUN_SALES)} AS status FROM pivoted""")
def _(s):
    wide = sales_pivot(s, "store_id", "article")
    return G.run_status(wide, bottom=K.BOTTOM_RUN_SALES).select("store_id", "article", "sum_qty", "status")


@query("size_buckets", f"WITH {SALES_PIVOT} SELECT store_id, article, size_small, size_medium, size_large FROM bucket")
def _(s):
    return G.size_buckets(sales_pivot(s, "store_id", "article")).select("store_id", "article", "size_small", "size_medium", "size_large")


@query("dominant_bucket", f"WITH {SALES_PIVOT} SELECT store_id, article, {DOMINANT} AS dominant_size FROM bucket")
def _(s):
    wide = G.size_buckets(sales_pivot(s, "store_id", "article"))
    return wide.select("store_id", "article", G.dominant_bucket().alias("dominant_size"))


@query("dominant_bucket_by_category", f"""
    WITH {SALES_PIVOT},
    c AS (SELECT store_id, category, CAST(SUM(size_small) AS BIGINT) AS size_small, CAST(SUM(size_medium) AS BIGINT) AS size_medium,
                 CAST(SUM(size_large) AS BIGINT) AS size_large FROM bucket GROUP BY store_id, category)
    SELECT *, {DOMINANT} AS dominant_size FROM c""")
def _(s):
    # sizes are summed by category straight away: the buckets are sums of sizes
    wide = G.size_buckets(G.size_pivot(season_sales(s), ["store_id", "category"], "qty", size_class=None))
    return wide.select("store_id", "category", "size_small", "size_medium", "size_large", G.dominant_bucket().alias("dominant_size"))


@query("cumulative_half", """
    WITH q AS (SELECT store_id, article, size, SUM(qty) AS q FROM sales_line JOIN article USING (sku) WHERE size IS NOT NULL GROUP BY ALL),
    c AS (SELECT *, SUM(q) OVER w AS cum, SUM(q) OVER (PARTITION BY store_id, article) AS total FROM q
          WINDOW w AS (PARTITION BY store_id, article ORDER BY q DESC, size ROWS UNBOUNDED PRECEDING))
    SELECT store_id, article, total AS total_qty,
           COALESCE(STRING_AGG(size, ', ' ORDER BY q DESC, size) FILTER (WHERE cum - q < total * 0.5), '') AS dominant_sizes
    FROM c GROUP BY store_id, article, total""")
def _(s):
    return G.top_half_sizes(s.sales_line.join(s.article, "sku"), ["store_id", "article"], "qty")


@query("stock_sales_dashboard_h", f"""
    WITH {WITH_SALES},
    info AS (SELECT article, MIN(category) AS category, MIN(brand) AS brand, MIN(price) AS price FROM article GROUP BY article),
    age AS (SELECT store_id, article, MIN(d) AS days_min, MAX(d) AS days_max FROM (
            SELECT store_id, article, CAST(DATE_DIFF('day', move_date, DATE '2001-12-15') AS INTEGER) AS d
            FROM movement JOIN article USING (sku) WHERE stat = 'receive') AS x GROUP BY ALL)
    SELECT v2.*, COALESCE(CASE WHEN brand LIKE '%2%' THEN 'MD ' || category END, category) AS category, brand, price, store_name,
           days_min, days_max
    FROM v2 LEFT JOIN info USING (article) LEFT JOIN store USING (store_id) LEFT JOIN age USING (store_id, article)""")
def _(s):
    from hangtally.plans.stock_reports import stock_sales_dashboard
    info = s.article.groupBy("article").agg(F.min("category").alias("category"), F.min("brand").alias("brand"), F.min("price").alias("price"))
    follow_up = (s.article.where(F.col("brand").contains("2")).groupBy("article")
                 .agg(F.concat(F.lit("MD "), F.min("category")).alias("md_category")))
    ages = AG.aging_min_max(s.receipts.join(s.article, "sku"), ["store_id", "article"], "2001-12-15").select(
        "store_id", "article", "days_min", "days_max")
    return stock_sales_dashboard(status_v2(s), info, follow_up, s.store.select("store_id", "store_name"), ages)
