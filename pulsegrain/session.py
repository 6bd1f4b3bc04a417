"""Session settings the pipelines rely on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    # Times in documents are read against an explicit zone; UTC keeps rendering predictable.
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in one JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Rows between two steps are read back whole; cutting them into columns would be undone at once.
    "spark.sql.variant.inferShreddingSchema": "false",
    # Keyed counter state needs column families, which only this provider has.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Nothing is ever emitted by time alone. Without this, state with an age limit makes an ``availableNow`` query
    # run empty micro-batches for ever.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session that somebody else built."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", name: str = "pulsegrain", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores if cores != "*" else "8")
        .config("spark.sql.adaptive.enabled", "true")
        # Noting the Python line of every column call doubles the time it takes to build a large plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share. Only a local master without it gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{os.environ.get('TMPDIR', '/tmp').rstrip('/')}/pulsegrain-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")
