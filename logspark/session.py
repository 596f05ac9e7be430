"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Stream state on local disk, not on the heap; each batch sends its changes to the checkpoint, not a
# whole snapshot.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "logspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library counts on; ``conf`` adds or replaces settings.

    Adaptive execution merges small shuffle partitions, splits skewed join partitions and picks
    broadcast joins by measured size, so no operator here fixes a partition count by itself.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | STATE_STORE | conf
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC; bucket edges and time text follow the session zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Keyed state needs this store, and large state of any kind is better off in it."""
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path for one run, below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without that setting; on a cluster a machine-local folder would
    be lost with its machine, so its absence is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="logspark-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
