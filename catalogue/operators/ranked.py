"""Pages by rank: rows stored in the order of a sort key, so that an offset opens the range partitions it falls into.

The counts of the ranges are the index. Page ``k`` is found by adding them up, one row per range, and reading the one or two
ranges that hold it; the rows before it are neither read nor sorted again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranks import part_starts, placed
from .search import SEARCH_ORDER


def order_columns(order: Sequence[str], collation: str | None = None, blank_nulls: bool = False) -> list[Column]:
    """A total order with NULL first; with a collation the names are compared by it, ties by the text itself."""
    def by(c: str) -> list[Column]:
        k = F.coalesce(F.col(c).cast("string"), F.lit("")) if blank_nulls else F.col(c)
        plain = k.asc_nulls_first()
        return [F.collate(k.cast("string"), collation).asc_nulls_first(), plain] if collation else [plain]
    return [x for c in order for x in by(c)]


#: rows of one range, which one task sorts
RANGE_ROWS = 1 << 16


@dataclass(frozen=True)
class RankedTable:
    """An opened table in rank order; ``starts`` has (part, rows, rank of its first row), one entry per range."""

    spark: SparkSession
    path: str
    starts: tuple[tuple[int, int, int], ...]

    @property
    def rows(self) -> int:
        return sum(n for _, n, _ in self.starts)

    def page(self, offset: int, limit: int) -> DataFrame:
        """Rows of rank ``offset`` and up, ``limit`` at most, in order and with their rank (from 0) as ``rank``."""
        end = offset + limit
        hit = [(part, start) for part, n, start in self.starts if start < end and offset < start + n]
        rows = self.spark.read.parquet(self.path)
        if not hit:
            return rows.where("false").select("*", F.lit(0).cast("long").alias("rank")).drop("part", "_nth")
        base = F.create_map(*[F.lit(x) for p, s in hit for x in (p, s)])
        # the places asked for, per range: the file's own statistics skip what lies outside them
        first, last = max(0, offset - hit[0][1]), end - hit[-1][1]
        rows = rows.where(F.col("part").isin([p for p, _ in hit]))
        rows = rows.where((F.col("part") != hit[0][0]) | (F.col("_nth") >= first)).where((F.col("part") != hit[-1][0]) | (F.col("_nth") < last))
        return rows.withColumn("rank", base[F.col("part")] + F.col("_nth")).orderBy("rank").drop("part", "_nth")


def build_ranked(df: DataFrame, path: str, order: Sequence[str] = SEARCH_ORDER, collation: str | None = None, blank_nulls: bool = False,
                 ranges: int | None = None) -> RankedTable:
    """Writes ``df`` by rank below ``path``, a directory per range of the order, and opens it.

    ``ranges`` is the least number of directories, so that small tables have several; a table of more than ``RANGE_ROWS`` rows a
    range gets more of them, so a task sorts the same number of rows whatever the size. Without it Spark chooses by size.
    """
    columns = order_columns(order, collation, blank_nulls)
    if ranges:
        ranges = max(ranges, -(-df.count() // RANGE_ROWS))
    ranked = placed(df, columns, ranges).withColumn("part", F.col("_part").cast("int")).drop("_part")
    ranked.sortWithinPartitions("part", "_nth").write.partitionBy("part").parquet(path)
    spark = df.sparkSession
    starts = part_starts(spark.read.parquet(path).select(F.col("part").alias("_part")))
    found = sorted((r["_part"], r["_n"], r["_start"]) for r in starts.collect())  # one row per range
    return RankedTable(spark, path, tuple(found))
