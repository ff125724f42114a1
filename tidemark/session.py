"""Session settings these jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Stored times are wall-clock NTZ in an explicit zone; UTC keeps instants unambiguous.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window state larger than an executor heap stays on local disk; only the
    # changelog is uploaded per micro-batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Layer tables are declared over folders and found by listing, in any catalog.
    "spark.sql.hive.manageFilesourcePartitions": "false",
    # SQL views list their files anew for each query, so they show each commit.
    "spark.sql.filesourceTableRelationCacheSize": "0",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """Session with ``SETTINGS``; ``extra`` keys use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name on storage that every executor sees.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local
    session, which has one machine, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"
