"""Session defaults and the scratch location used by queries that write tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Window state off the heap, with each batch uploading its changes rather than whole snapshots.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Defaults for sessions we build ourselves. The master, executor sizing and object-store
# credentials belong to spark-submit / spark-defaults.conf and are never set here.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **STATE_CONF,
}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the library defaults, overridden by ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Set session options for the duration of a block and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """Return a fresh path for tables and checkpoints a query writes on its way.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local session
    may fall back to a temporary folder: executors on other machines could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="fraudtide-")
    return f"{shared.rstrip('/')}/fraudtide/{label}-{uuid.uuid4().hex}"


@contextmanager
def consumed(spark: SparkSession, label: str) -> Iterator[str]:
    """Yield a scratch path for data that is used up within the block, and delete it after.

    Not for what the block's result still reads: a DataFrame reads its files when it runs.
    """
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    For results several jobs use: what they cost is paid once, and losing an executor
    costs no recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
