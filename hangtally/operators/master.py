"""Article and store masters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangtally import constants as K
from hangtally.functions import recode, store_detail_class
from hangtally.operators.numbering import running_suffix, sequence_fill


def article_master(articles: DataFrame, sizes: DataFrame, dims: Mapping[str, DataFrame],
                   config: DataFrame) -> DataFrame:
    """Star of an article: left joins to its sizes, its dimensions and, three times, config.

    ``dims`` maps a key column of ``articles`` to a frame (key, name[, hold]); held
    dimension rows do not count.  Category type, motif and rating come from ``config``.
    """
    out = articles.join(sizes, "article_id", "left")
    for key, dim in dims.items():
        if "hold" in dim.columns:
            dim = dim.where("hold = 'F'").drop("hold")
        out = out.join(dim, key, "left")
    for key, name in (("category_type_id", "size_class"), ("motif_id", "motif"), ("rating_id", "rating")):
        names = config.select(F.col("config_id").alias(key), F.col("config_name").alias(name))
        out = out.join(names, key, "left")
    return out


def store_master(warehouses: DataFrame, customers: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """Every customer, with its store number where it has one, and its dimensions."""
    out = warehouses.join(customers, "cust_id", "right")
    for dim, key in dims:
        out = out.join(dim, key, "left")
    return out


def store_users(users: DataFrame, access: DataFrame) -> DataFrame:
    """Active store-level users and the customers they may see."""
    return (users.where("user_level = 2 and hold = 'F'").select("user_id")
            .join(access.where("cust_id is not null").select("user_id", "cust_id"), "user_id"))


def finish_stores(stores: DataFrame) -> DataFrame:
    """Repairs, fills and derived columns of the store master.

    Code repair of one city, spare numbers for stores without one, customer code filled
    from the store code and made unique, fixed labels, detail class.
    """
    code = F.when(F.col("city") == K.STORE_CODE_REPAIR_CITY, recode("store_code", K.STORE_CODE_REPAIRS)).otherwise(
        F.col("store_code"))
    out = stores.withColumn("store_code", code)
    out = sequence_fill(out, "store_id", "cust_id", K.FIRST_SPARE_STORE_ID)
    out = out.withColumns({
        "customer_code": F.coalesce("customer_code", "store_code"),
        "store_type": F.when(F.col("store_id").isin(K.STRATEGIC_STORES), K.STRATEGIC_LABEL)
                       .otherwise(F.col("store_type")),
        "new_name": F.when(F.col("group_id") == K.BAZAAR_GROUP, K.BAZAAR_LABEL).otherwise(F.col("new_name")),
        "detail_class": store_detail_class("group_id", "net_flag"),
    })
    out = out.withColumn("new_name", F.when(
        F.col("new_name").isNull() & F.col("store_code").startswith(K.BAZAAR_CODE_PREFIX), K.BAZAAR_LABEL)
        .otherwise(F.col("new_name")))
    return running_suffix(out, "customer_code", "cust_id", "customer_code")


def first_article_row(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the least of the remaining columns in order."""
    rest = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r"))
            .select(key, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def default_columns(df: DataFrame, wanted: Mapping[str, object]) -> DataFrame:
    """Add missing columns with a constant and return exactly the wanted columns in order."""
    cols = []
    for name, default in wanted.items():
        if name in df.columns:
            cols.append(F.col(name))
        else:
            value = F.lit(default) if default is not None else F.lit(None).cast("string")
            cols.append(value.alias(name))
    return df.select(*cols)
