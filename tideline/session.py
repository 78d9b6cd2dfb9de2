"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that change plans or results; a cluster's own values win for everything else.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: int | str = 8, app: str = "tideline", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers, once per application: executors need not have it installed."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tideline-')}/tideline-package", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)  # Spark's file service hands the driver's copy to every executor
        _SHIPPED.add(application)
    return spark


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """All epoch/text conversions use one zone (Q11)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A folder that no other run uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files, which else stay until the driver happens to collect its garbage.
    A value that the session has set itself wins."""
    own = spark.conf.get(_CLEANUP, None) is None
    if own:
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if own:
            spark.conf.unset(_CLEANUP)


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of ``scratch`` that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
