"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot store must also be split where its join feeds an aggregate on the same key
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "hangtally", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder of the session.

    The folder is the setting ``spark.checkpoint.dir`` or, where that is unset, the session's
    checkpoint directory. There is no other place: executors must see what others wrote.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
            or spark.sparkContext.getCheckpointDir())
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
