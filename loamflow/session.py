"""Session helpers. On a cluster pass your own session; these are for local use."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What the operators rely on: UTC so that stored marks compare with zone-less
# columns, and adaptive execution for runtime broadcast and skew splitting.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a write into the two parts of a quality split go without sorting the rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``ENGINE_CONF`` to a session that already runs."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "loamflow", cpus: str = "8", memory: str = "8g", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
    )
    for key, value in {**ENGINE_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, fallback: str) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` if the cluster names one."""
    return (spark.conf.get("spark.checkpoint.dir", None) or fallback).rstrip("/")
