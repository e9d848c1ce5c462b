"""Shared scratch storage: the folder the cluster names, seen by the driver and every executor alike."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"
#: Spark removes what a query shuffled as soon as it has ended; otherwise files stay until the driver collects its garbage
LET_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session. Where none is set, a local session gets its own; a cluster must name one."""
    root = spark.conf.get(CONF, None)
    if root is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"{CONF} names no folder that all executors share")
        root = tempfile.mkdtemp(prefix="catalogue-")
        spark.conf.set(CONF, root)
    return root.rstrip("/")


_MADE: list[tuple[int, str]] = []


def _remove_scratch() -> None:
    """Removes what this process has put below the shared folder, when it ends."""
    from pyarrow import fs

    for pid, path in _MADE:
        if pid == os.getpid():
            try:
                store, place = fs.FileSystem.from_uri(path)
                store.delete_dir(place)
            except (OSError, ValueError):
                continue  # never written, or in a store that only Spark reaches


atexit.register(_remove_scratch)


def scratch(spark: SparkSession) -> str:
    """A new path below the shared folder, removed when this process ends; nothing is created yet."""
    path = f"{shared_root(spark)}/run-{uuid.uuid4().hex}"
    _MADE.append((os.getpid(), path))
    return path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to shared storage and read it back: lineage ends here and lost executors cost no recomputation.

    What was shuffled on the way is not read again, so its files go at once.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{label}"
    before = spark.conf.get(LET_GO, "false")
    spark.conf.set(LET_GO, "true")
    try:
        df.select("*").write.parquet(path)  # a new plan, which goes by the setting
    finally:
        spark.conf.set(LET_GO, before)
    return spark.read.schema(df.schema).parquet(path)
