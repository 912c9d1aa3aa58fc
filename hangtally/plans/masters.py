"""Refresh of the article and store masters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangtally.functions import price_class, remove_spaces, to_number
from hangtally.operators.joins import null_safe_anti
from hangtally.operators.master import finish_stores, first_article_row
from hangtally.operators.upsert import merge_upsert


def article_upsert(fresh: DataFrame, stored: DataFrame, photos: DataFrame, statuses: DataFrame,
                   key: str = "artsize") -> DataFrame:
    """New and changed articles merged into the stored master.

    Code without spaces, one row per code, photo link, status, price class; a change of any
    written column counts, the class included.
    """
    rows = fresh.withColumn(key, remove_spaces(key)).where(F.col(key).isNotNull())
    rows = first_article_row(rows, key)
    rows = rows.join(photos, "barcode", "left").join(statuses, "article_id", "left")
    rows = rows.withColumns({
        "photo": F.coalesce("photo", F.lit("none")), "rating": F.coalesce("rating", F.lit("none")),
        "price": to_number("price"), "amount": to_number("amount"),
    })
    rows = rows.withColumn("price_class", price_class("status", "category", "amount")).select(*stored.columns)
    return merge_upsert(stored, null_safe_anti(rows, stored, stored.columns), [key])


def store_upsert(stores: DataFrame, users: DataFrame, contacts: DataFrame, stored: DataFrame,
                 columns: Sequence[str]) -> DataFrame:
    """Store master with users and contacts, finished and merged by store number."""
    user = users.groupBy("cust_id").agg(F.min("user_name").alias("user_name"))
    contact = contacts.groupBy("store_code").agg(F.min("supervisor").alias("supervisor"))
    rows = (stores.join(user, "cust_id", "left").join(contact, "store_code", "left")
            .fillna("-", subset=["user_name", "supervisor"]))
    return merge_upsert(stored, finish_stores(rows).select(*columns), ["store_id"])
