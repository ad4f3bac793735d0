"""Session settings the library expects.

``tune`` only touches runtime SQL settings, so it is safe on a session that a
cluster has already created.  ``build`` is for tests and local runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # results must not depend on the zone of the machine that runs them
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: join strategy, partition coalescing, skew splitting
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a partition load replaces that partition and nothing else
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: For tables of the warehouse: a task joins and sums what it reads from a shuffle in memory, at some 25 times the compressed size.
#: Parts are many, so that they stay small when tables grow, and are put together up to a quarter of Spark's size for a task.
TABLE_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

STREAM_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def tune(spark: SparkSession) -> SparkSession:
    return _set(spark, RUNTIME_SETTINGS)


def tune_tables(spark: SparkSession) -> SparkSession:
    """``tune``, and parts of shuffles sized for the warehouse's tables."""
    return _set(tune(spark), TABLE_SETTINGS)


def _set(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def tune_streams(spark: SparkSession) -> SparkSession:
    """Keep large keyed state off the JVM heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STREAM_STATE_STORE)
    return spark


def build(app: str = "stratamart", master: str | None = None, cores: int = 8) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.sql.shuffle.partitions", str(cores))
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return configured
