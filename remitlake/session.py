"""A session with the settings the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Stream de-duplication state can outgrow the heap; keep it in RocksDB and upload only changes.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

SETTINGS = {
    # Messages carry no zone; every timestamp is read and written as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **STATE_STORE,
    "spark.ui.enabled": "false",
}


def build_session(app: str = "remitlake", master: str | None = None, **extra: str) -> SparkSession:
    """Get or create a session. ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
