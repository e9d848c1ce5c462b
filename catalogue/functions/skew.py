"""Join helpers that stay safe when one key owns a large share of the rows.

Aggregates need no help: Spark combines them before the shuffle. A join of rows to per-key facts does, because the
aggregated side keeps the adaptive skew split from applying. Here only the keys that are really hot are spread over
several partitions, and only their facts are repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 256 << 20
HOT_ROWS = 2_000_000
#: rows without a key are dealt out over so many values that no key has
NULL_SALTS = 1 << 20
#: bits of one row of a broadcast bit map, as bitmap_construct_agg makes them, and of all rows (64 MB)
MAP_BITS, MOST_BITS = 1 << 15, 1 << 29


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting: a frame above the limit joins by shuffle instead."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def _text_bytes() -> Column:
    return F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0)).cast("long")


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    return are_small([df], max_rows)[0]


def are_small(frames: Sequence[DataFrame], max_rows: int = BROADCAST_ROWS) -> list[bool]:
    """Rows and bytes of several frames against the broadcast limits, in one job that stops above ``max_rows``."""
    tagged = [f.limit(max_rows + 1).select(F.lit(i).alias("i"), _text_bytes().alias("b")) for i, f in enumerate(frames)]
    sums = reduce(DataFrame.unionAll, tagged).groupBy("i").agg(F.count("*").alias("n"), F.sum("b").alias("b")).collect()
    small = {r["i"]: r["n"] <= max_rows and r["b"] <= BROADCAST_BYTES for r in sums}
    return [small.get(i, True) for i in range(len(frames))]


def null_marked(cols: Sequence[str | Column]) -> list[Column]:
    """Each column followed by its null flag, so that hashes tell NULL in one column from NULL in the next."""
    out = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        out += [c, c.isNull()]
    return out


def fingerprint(cols: Sequence[str | Column]) -> Column:
    """128-bit row fingerprint as two hashes with different seeds; the same for equal rows, NULLs included."""
    marked = null_marked(cols)
    return F.struct(F.xxhash64(*marked).alias("a"), F.xxhash64(F.lit(7), *marked).alias("b"))


def maybe_listed(rows: DataFrame, listed: DataFrame, column: str, per_value: int = 32, most: int = MOST_BITS) -> DataFrame:
    """The rows whose 64-bit hash ``column`` may be in ``listed`` (same column): all that are, and some one in ``per_value`` others.

    Each listed hash sets a bit of a broadcast map, so the rows stay where they are. The map has at most ``most`` bits; with
    more hashes than fit more of the other rows pass, and none that is listed is lost.
    """
    bits = min(most, max(MAP_BITS, 1 << (per_value * listed.count() - 1).bit_length()))
    at, in_map = F.pmod(F.col(column), F.lit(bits)), F.col("_at").bitwiseAND(MAP_BITS - 1)
    pick = lambda df: df.withColumn("_at", at).withColumn("_map", F.shiftright("_at", MAP_BITS.bit_length() - 1))
    # dealt out first: each map is made in one place instead of one nearly empty copy per task
    maps = pick(listed).select("_map", in_map.alias("_bit")).repartition("_map").groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(in_map, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, in_map.bitwiseAND(7).cast("int")) == 1
    return pick(rows).join(F.broadcast(maps), "_map").where(hit).drop("_map", "_at", "_bits")


def attach(
    rows: DataFrame,
    facts: DataFrame,
    key: Sequence[str],
    size: str,
    spread: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` to ``facts`` (one row per key; column ``size`` = rows of that key in ``rows``).

    A key gets one salt per ``hot_rows`` rows, so what meets in one place stays the same however many rows it has. Its
    rows are spread by a hash of ``spread`` (columns that tell rows of one key apart), and its facts are repeated once
    per salt. Rows with a NULL key meet no facts and are dealt out evenly. The list of hot keys has at most
    total/hot_rows entries and is broadcast after its size has been checked.
    """
    key = list(key)
    parts = F.ceil(F.col(size) / hot_rows).cast("int")
    hot = broadcast_if_small(facts.where(F.col(size) > hot_rows).select(*key, parts.alias("_parts")))
    some = F.xxhash64(*null_marked(spread))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    salt = (F.when(no_key, -1 - F.pmod(some, F.lit(NULL_SALTS))).when(F.col("_parts").isNotNull(), F.pmod(some, F.col("_parts")))
            .otherwise(0).cast("int"))
    salted = rows.join(hot, key, "left").withColumn("_salt", salt).drop("_parts")
    last = F.greatest(parts - 1, F.lit(0))
    spread_facts = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return salted.join(spread_facts, [*key, "_salt"], how).drop("_salt")


def join_keyed(rows: DataFrame, facts: DataFrame, key: Sequence[str], spread: Sequence[str], how: str = "left",
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join rows to a large lookup (one row per key): the rows are counted per key first, then hot keys are spread."""
    sizes = rows.groupBy(*key).agg(F.count("*").alias("_n"))
    return attach(rows, facts.join(sizes, list(key)), key, "_n", spread, how, hot_rows).drop("_n")


def join_small_or_keyed(
    rows: DataFrame, facts: DataFrame, key: Sequence[str], spread: Sequence[str], how: str = "left",
) -> DataFrame:
    """Left/inner join to a dimension: broadcast while it is small, otherwise the skew-safe keyed join."""
    if is_small(facts):
        return rows.join(F.broadcast(facts), list(key), how)
    return join_keyed(rows, facts, key, spread, how)
