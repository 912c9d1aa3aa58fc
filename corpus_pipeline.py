"""From raw documents to token ids: language, near copies, repeated passages, mix, tokens.

Every stage takes all rows that the stage before kept. Languages are learned from the documents' own labels.
No SQL expresses the stages; they are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangtally.llm import bpe, langid, minhash, mixing, repeats
from hangtally.llm.common import stored
from hangtally.llm.queries import TOKENIZER


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return langid.keep_known(docs, langid.fit(langid.labelled(docs)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return minhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that an earlier place holds go; a character that loses a part of its bytes goes whole."""
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("_row"), "doc_id", "text")
    cleaned = repeats.remove_repeats(rows, ("_row",), as_text=True).select("_row.*", F.col("kept").alias("text"))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what goes into training."""
    return bpe.digests(bpe.round_trip(docs, TOKENIZER))


STAGES = [("language_id", language), ("minhash_dedup", near_copies), ("suffix_dedup", repeated_passages), ("mixing", mix), ("bpe", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
