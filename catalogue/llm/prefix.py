"""Prefix sums over any number of rows without an ordered pass in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN = 4096


def _before(window) -> Window:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def running_start(rows: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str | Column], value: str,
                  out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same ``group`` that come before this one.

    ``bucket`` is a long that never falls along ``order``; the caller picks it so that one (group, bucket) holds a
    bounded number of rows. Rows are summed inside their bucket, buckets inside runs of ``FAN`` buckets, and runs
    inside the group, so no task ever holds a group. ``group`` and ``bucket`` must not be null; ``group`` may be empty.
    """
    group = list(group)
    zero = F.lit(0).cast("long")
    inside = _before(Window.partitionBy(*group, bucket).orderBy(*order))
    rows = rows.withColumn("_in", F.coalesce(F.sum(value).over(inside), zero))
    totals = rows.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    totals = totals.withColumn("_run", F.floor(F.col(bucket) / FAN))
    runs = totals.groupBy(*group, "_run").agg(F.sum("_sum").alias("_sum"))
    runs = runs.select(*group, "_run", F.coalesce(F.sum("_sum").over(
        _before(Window.partitionBy(*group).orderBy("_run"))), zero).alias("_at"))
    totals = totals.withColumn("_part", F.coalesce(F.sum("_sum").over(
        _before(Window.partitionBy(*group, "_run").orderBy(bucket))), zero))
    starts = totals.join(runs, [*group, "_run"]).select(*group, bucket, (F.col("_part") + F.col("_at")).alias("_base"))
    return rows.join(starts, [*group, bucket]).withColumn(out, F.col("_in") + F.col("_base")).drop("_in", "_base")
