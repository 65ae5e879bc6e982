"""Session settings the jobs are written for.

Cluster sizing (executors, memory, checkpoint folder) belongs to whoever
submits the job; only settings that change plans or results are named here.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(app: str, cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session with the recommended settings, for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**RECOMMENDED_CONF, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sibling_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings, for jobs that leave something behind in theirs.

    Observing a query does: afterwards, models that were fitted in its session and
    still hold their training summary cannot be sent to tasks.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and sibling.conf.isModifiable(key) and sibling.conf.get(key, None) != value:
            sibling.conf.set(key, value)
    return sibling


class _Made(threading.local):
    """The scratch folders of a thread's open :func:`scratch` blocks, the innermost last."""

    def __init__(self) -> None:
        self.blocks: list[list[str]] = []


_made = _Made()


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path in its terms."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    system, place = filesystem(spark, path)
    system.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder."""
    system, place = filesystem(spark, path)
    return sorted(found.getPath().getName() for found in system.listStatus(place)) if system.exists(place) else []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared checkpoint folder of the session.

    A machine-local folder is only used where the session names none, which
    is the case in single-machine tests.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="facetmill-")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _made.blocks:
        _made.blocks[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch folders named inside, by this thread, are removed at the end.

    What is computed from them must be written by then. Threads do not see each
    other's folders.
    """
    _made.blocks.append([])
    try:
        yield
    finally:
        for path in _made.blocks.pop():
            remove_folder(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    The written table survives lost executors and carries its real size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
