"""Session settings the plans rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # calendar work is done on dates; a fixed zone keeps timestamp -> date casts stable
    "spark.sql.session.timeZone": "UTC",
    # skewed join partitions are split and small sides become broadcasts at run time, by measured size
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # lets a selective report or student filter prune the fact scan on the other side of a join
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(app_name: str = "scolaria", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; pass further ones as ``**{"spark.x.y": "value"}``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors share.

    A folder of one machine would give incomplete results on a cluster, so there is none to fall back on.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/scolaria-{uuid.uuid4().hex}"
