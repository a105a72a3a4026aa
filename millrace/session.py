"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Settings every job relies on. AQE merges shuffle partitions up to the advisory size; nothing measures tables.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Layers are written once and kept: fewer bytes for a little more time.
    "spark.sql.parquet.compression.codec": "zstd",
    # Plain 64-bit numbers with statistics; the default of twelve bytes takes longer to write and to read.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Dedup state lives on executor disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# For sessions of our own: the size AQE merges to, and no call-site lookup for every column expression built.
START_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "millrace", shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """A session with the settings above.

    ``shuffle_partitions`` is the number AQE starts from before it merges small ones. Give the largest table's
    shuffled bytes over the advisory size of 128 MB; unset, the cluster's own setting holds.
    """
    if shuffle_partitions:
        settings = {INITIAL_PARTITIONS: str(shuffle_partitions), **settings}
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_SETTINGS, **START_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder; whoever runs the job removes it afterwards.

    Only a local session without that setting falls back to a temporary folder of this machine, because
    there driver and executors are the same process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def together(spark: SparkSession, jobs: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run independent actions side by side, so small tables fill the gaps large ones leave on the cluster."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = {name: pool.submit(inherit(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}
