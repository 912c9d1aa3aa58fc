"""Canonical SKUs: raw texts become numbers once, at ingestion.

Source tables spell SKUs in mixed case, with blanks around them, and in one known wrong way. A dictionary holds every raw
text that occurs with its number; tables are joined with it once and carry the number from then on, so no later join or
sum meets two spellings of one SKU.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangtally.functions import clean_sku


def sku_dictionary(raws: Sequence[DataFrame], articles: DataFrame) -> DataFrame:
    """Rows (raw, sku) for all raw texts of the one-column frames. ``articles`` has code (clean text) and sku (number).

    A code without article gets a negative number from its hash: the same in every run, and never an article's.
    """
    texts = raws[0].toDF("raw")
    for r in raws[1:]:
        texts = texts.union(r.toDF("raw"))
    code = texts.where("raw is not null").distinct().withColumn("code", clean_sku("raw"))
    known = articles.groupBy("code").agg(F.min("sku").alias("_sku"))
    other = -F.shiftrightunsigned(F.xxhash64("code"), 2) - 1
    return code.join(known, "code", "left").select("raw", F.coalesce("_sku", other).alias("sku"))


def numbered(df: DataFrame, dictionary: DataFrame, raw: str = "sku_text") -> DataFrame:
    """``df`` with the number ``sku`` in place of the raw text; null stays null."""
    return df.join(dictionary.withColumnRenamed("raw", raw), raw, "left").drop(raw)
