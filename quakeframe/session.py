"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# The estimated size of a join side says little after an aggregation or an explode, so plans never
# broadcast by estimate; adaptive execution does it once it has measured the side.
QUERY_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}
SETTINGS = {
    **QUERY_SETTINGS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark.

    On a cluster the session comes from spark-submit; ``prepare`` is enough there.
    """
    partitions = str(os.cpu_count() if cpus == "*" else cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quakeframe")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "localhost")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.streaming.metricsEnabled", "false")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """What the queries rely on, whoever made the session: UTC and broadcasts by measured size."""
    for key, value in QUERY_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for checkpoints or written tables.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Where that is
    unset and the session runs in one process, a temporary folder takes its place.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="quakeframe-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
