"""Sinks: canonical CSV, hash-sharded documents, receipts, guarded exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import TableContract
from ..functions import columns as P
from ..functions.skew import fingerprint


def canonical_text(df: DataFrame, contract: TableContract) -> DataFrame:
    """Contract order, NULL as empty text, booleans as true/false."""
    return df.select(*[P.text(F.col(c).cast("string")).alias(c) for c in contract.columns])


def write_canonical(df: DataFrame, path: str, contract: TableContract, order: Sequence[str] = ()) -> None:
    out = df.sortWithinPartitions(*order) if order else df
    canonical_text(out, contract).write.options(
        header=True, lineSep="\n", emptyValue="", escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False).csv(path)


def write_snapshot(df: DataFrame, path: str, partition: str = "source_dataset", order: Sequence[str] = ("university",)) -> None:
    """Columnar snapshot of classified records: a directory per source, sorted inside each file for min/max skipping."""
    df.sortWithinPartitions(partition, *order).write.partitionBy(partition).parquet(path)


def shard_count(total_bytes: int | Column, target_bytes: int, rows: int | Column) -> Column:
    """Next power of two of bytes/target, at most one shard per row, at least one."""
    total = F.lit(total_bytes) if isinstance(total_bytes, int) else total_bytes
    rows = F.lit(rows) if isinstance(rows, int) else rows
    parts = F.greatest(F.lit(1), F.ceil(total / F.lit(target_bytes)))
    # the number of binary digits of parts-1 is the exponent; exact, unlike a floating logarithm
    power = F.when(parts <= 1, F.lit(1).cast("bigint")).otherwise(
        F.pow(F.lit(2), F.length(F.bin(parts - 1))).cast("bigint"))
    return F.when(rows == 0, F.lit(1).cast("bigint")).otherwise(F.least(rows.cast("bigint"), power))


def shard_plan(df: DataFrame, key: Sequence[str], shards: int) -> DataFrame:
    """Documents per shard, empty shards left out."""
    return df.groupBy(P.shard_of(key, shards).alias("shard")).agg(F.count("*").alias("documents"))


def sharding(df: DataFrame, target_bytes: int) -> DataFrame:
    """One row: rows, bytes as JSON, and the shard count that follows."""
    size = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    sums = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))
    return sums.withColumn("shards", shard_count(F.col("bytes"), target_bytes, F.col("rows")))


def write_shards(df: DataFrame, key: Sequence[str], path: str, target_bytes: int = 0, shards: int = 0,
                 files_per_shard: int = 1) -> int:
    """Write documents as one JSON directory per shard and return the number of shards.

    The shard depends on the key alone, so a document is found without an index. ``files_per_shard`` spreads a big
    shard over several writers; there are as many writers as files.
    """
    if not shards:
        shards = sharding(df, target_bytes).first()["shards"]
    part = F.pmod(F.xxhash64(*key), F.lit(files_per_shard))
    placed = df.withColumn("shard", P.shard_of(key, shards))
    (placed.repartition(max(1, shards * files_per_shard), "shard", part).sortWithinPartitions("shard", *key)
     .write.partitionBy("shard").option("ignoreNullFields", False).json(path))
    return shards


def size_stats(df: DataFrame, column: str) -> DataFrame:
    """Total, mean, exact median, nearest-rank p95 and maximum of a size column, in one aggregate.

    The percentile aggregates keep a value histogram per task and merge those, so memory follows the number of
    different sizes, not the number of rows.
    """
    v = F.col(column).cast("bigint")
    return df.select(v.alias("v")).agg(
        F.count("v").alias("records"),
        F.coalesce(F.sum("v"), F.lit(0)).alias("total_bytes"),
        F.round(F.avg("v"), 2).alias("average_bytes"),
        F.median("v").alias("median_bytes"),
        F.expr("percentile_disc(0.95) within group (order by v)").cast("bigint").alias("p95_bytes"),
        F.coalesce(F.max("v"), F.lit(0)).alias("largest_bytes"))


def size_report(df: DataFrame) -> DataFrame:
    """``size_stats`` of whole records written as JSON."""
    record = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    return size_stats(df.select(record.alias("bytes")), "bytes")


def receipt(df: DataFrame) -> DataFrame:
    """Order-free content receipt: rows, columns, and the sums of two row hashes (copies count)."""
    row = fingerprint(df.columns)
    return df.select(row.alias("f")).agg(
        F.count("*").alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.coalesce(F.sum(F.col("f.a").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_a"),
        F.coalesce(F.sum(F.col("f.b").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash_b"))


def content_profile(df: DataFrame) -> DataFrame:
    """One row per column: NULLs and distinct values, the readable part of a receipt."""
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns])).alias("cell"))
    values = cells.groupBy("cell.column", "cell.value").agg(F.count("*").alias("n"))
    return values.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"))


def verify_receipt(tables: dict[str, DataFrame], old: dict[str, DataFrame]) -> DataFrame:
    """Per table: does its content still give the old receipt."""
    fields = ("rows", "columns", "hash_a", "hash_b")
    lines = []
    for name, df in tables.items():
        now = receipt(df).select(F.lit(name).alias("table"), F.struct(*fields).alias("now"))
        before = old[name].select(F.lit(name).alias("table"), F.struct(*fields).alias("before"))
        lines.append(now.join(before, "table"))
    return reduce(DataFrame.unionByName, lines).select(
        "table", F.col("before.rows").alias("old_rows"), F.col("now.rows").alias("new_rows"),
        (F.col("now") != F.col("before")).alias("changed"))


def assert_same(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset differences of two frames, both directions, as one row; all zero means the same content."""
    cols = a.columns
    both = (a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
            .unionByName(b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    counts = both.groupBy(*cols).agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    return counts.agg(
        F.coalesce(F.sum("na"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("nb"), F.lit(0)).alias("rows_b"),
        F.coalesce(F.sum(F.greatest(F.col("na") - F.col("nb"), F.lit(0))), F.lit(0)).alias("only_a"),
        F.coalesce(F.sum(F.greatest(F.col("nb") - F.col("na"), F.lit(0))), F.lit(0)).alias("only_b"))


def guard_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Spreadsheet-safe text in the given columns (all by default)."""
    names = columns if columns is not None else df.columns
    return df.select(*[P.guard_cell(F.col(c).cast("string")).alias(c) if c in names else F.col(c) for c in df.columns])


def export_csv(df: DataFrame, path: str) -> None:
    guard_cells(df).write.options(
        header=True, quoteAll=True, lineSep="\n", escape='"', ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False).csv(path)
