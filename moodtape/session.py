"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "moodtape", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; everything can be overridden.

    UTC keeps stored timestamps free of zone shifts.  Adaptive execution sizes
    shuffles, splits hot join partitions and picks broadcast joins by measured
    size, so no join here carries a broadcast hint.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Recording the Python call site of every column costs more than planning the queries.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a temporary folder, as there
    driver and executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="moodtape-")
    return _local_dirs[app]


def work_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder for one run's intermediate table."""
    return f"{shared_dir(spark)}/moodtape/{label}-{uuid.uuid4().hex}"


#: Session setting of Spark 4.1: whether a query's shuffle files go when it ends, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in this block leave no shuffle files behind, which would hold the written rows a second time."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
