"""Session settings, and the shared scratch folder for checkpoints and staged data."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "riverdeck", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Counters of all players may outgrow the heap; keep them on executor disk, log changes only.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary folder only when Spark runs locally."""
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="riverdeck-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


_scope: ContextVar[str | None] = ContextVar("riverdeck_scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder, inside the current scope if there is one."""
    return f"{_scope.get() or scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch data made inside the block is removed at its end: finish all actions on frames
    built inside before leaving it."""
    path = scratch_path(spark, "scope")
    token = _scope.set(path)
    try:
        yield path
    finally:
        _scope.reset(token)
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder the library wrote, on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pinned(df: DataFrame, name: str = "pinned") -> DataFrame:
    """`df` written to the shared scratch folder and read back: lineage ends there, lost
    executors change nothing, and each later use reads only the columns it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slice_count(spark: SparkSession) -> int:
    """How many range slices the ordered plans cut: the shuffle setting, or more on a wider cluster."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
