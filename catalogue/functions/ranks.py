"""Dense numbers, and rows by number, in the order of a key: a range partition and one count per partition.

Rows are sorted inside range partitions and written; what a partition's rows start at is the sum of the counts before it.
No task sees more than its partition, and no window runs without one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle

_NTH = (1 << 33) - 1


def placed(df: DataFrame, order: Sequence[str | Column], ranges: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with ``_part`` (range) and ``_nth`` (place in it, from 0).

    Without a number of ``ranges`` Spark chooses it by size. A plan, not a table: write it before it is read twice.
    """
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return ranged.withColumn("_part", F.shiftright("_id", 33)).withColumn("_nth", F.col("_id").bitwiseAND(_NTH)).drop("_id")


def sorted_parts(df: DataFrame, order: Sequence[str | Column], label: str = "sorted") -> DataFrame:
    """``placed`` as a written table."""
    return settle(placed(df, order), label)


def part_starts(parts: DataFrame) -> DataFrame:
    """(_part, _n, _start): one row per range partition that holds rows, however many rows there are."""
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long"))


def numbered(df: DataFrame, order: Sequence[str | Column], out: str, label: str = "numbered") -> DataFrame:
    """``df`` with ``out``: its place in the order, from 0, without gaps. Rows that tie are numbered in any order."""
    parts = sorted_parts(df, order, label)
    # as many rows as the sort has partitions, so always small enough to send along
    starts = F.broadcast(part_starts(parts).drop("_n"))
    return parts.join(starts, "_part").withColumn(out, F.col("_start") + F.col("_nth")).drop("_part", "_nth", "_start")
