"""Runs a function over Arrow batches on the executors' Python workers."""

from __future__ import annotations

import os
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: a batch of rows sent to a worker, where the session does not set its own: rows may be long texts
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
ROOT = str(Path(__file__).resolve().parents[2])
#: functions whose kept results take tens of megabytes in a worker, by name
_LARGE: dict = {}


def large(maxsize: int):
    """``lru_cache`` for what tasks of one kind share in a worker; a worker lets go of it when a task of another kind begins."""
    def kept(make):
        _LARGE[make.__name__] = cached = lru_cache(maxsize=maxsize)(make)
        return cached

    return kept


def let_go(keeps: str | None) -> None:
    """Drops what this worker keeps from earlier tasks, but for the results of the function that ``keeps`` names."""
    for name, cached in _LARGE.items():
        if name != keeps:
            cached.cache_clear()


def bounded(fn, keeps: str | None = None):
    """``fn`` in a worker that holds what ``keeps`` names and no more, neither while it runs nor while it waits for the next task."""
    def run(batches):
        import pyarrow as pa

        let_go(keeps)
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return run


def with_package(spark: SparkSession) -> None:
    """Puts this package on the workers' path, so that what a worker keeps lasts over its tasks, and bounds its batches in bytes.

    Executors that do not see this folder get the package the usual way (``--py-files``).
    """
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def map_batches(df: DataFrame, fn, schema, keeps: str | None = None) -> DataFrame:
    """``df.mapInArrow`` with this package on the workers' path.

    ``keeps`` names the ``large`` function whose results the tasks leave to each other. A worker outlives its stage, so without
    it an idle worker would hold, say, an encoder's words through all later stages, beside whatever these need.
    """
    with_package(df.sparkSession)
    return df.mapInArrow(bounded(fn, keeps), schema)
