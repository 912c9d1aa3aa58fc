"""Filters that apply only where the caller gives a value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangtally.functions import all_of


def optional_filters(df: DataFrame, stores: DataFrame, store_codes: Sequence[str] | None = None,
                     brand: str | None = None, price_class: str | None = None) -> DataFrame:
    """Store codes are resolved to store numbers inside the plan (semi join), not by a
    query of their own."""
    conditions = []
    if brand:
        conditions.append(F.col("brand") == brand)
    if price_class:
        conditions.append(F.col("price_class") == price_class)
    out = df.where(all_of(conditions)) if conditions else df
    if store_codes:
        out = stores_only(out, stores, store_codes)
    return out


def stores_only(df: DataFrame, stores: DataFrame, store_codes: Sequence[str]) -> DataFrame:
    chosen = stores.where(F.col("store_code").isin(list(store_codes))).select("store_id")
    return df.join(chosen, "store_id", "left_semi")
