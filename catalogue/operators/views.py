"""Joins of records with coverage, children, layers, flags, saved lists and provisional records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def records_view(parent: DataFrame, coverage: DataFrame, child: DataFrame, cov_key: Sequence[str],
                 child_on: Sequence[tuple[str, str]], prefix: str = "coverage_") -> DataFrame:
    """One row per record with its coverage columns, child count (0-filled) and a has-children flag.

    Children are counted before the join. ``child_on`` lists (child column, parent column).
    """
    extra = [c for c in coverage.columns if c not in cov_key]
    cov = coverage.select(*cov_key, *[F.col(c).alias(prefix + c) for c in extra])
    counts = child.groupBy(*[F.col(c).alias(p) for c, p in child_on]).agg(F.count("*").alias("_n"))
    return (parent.join(counts, [p for _, p in child_on], "left").join(cov, list(cov_key), "left")
            .withColumn("child_rows", F.coalesce("_n", F.lit(0))).withColumn("has_children", F.col("_n").isNotNull())
            .select(*parent.columns, *[prefix + c for c in extra], "child_rows", "has_children"))


def records_with_children(parent: DataFrame, child: DataFrame, on: Sequence[tuple[str, str]], prefix: str = "child_") -> DataFrame:
    """Record x child pairs, copies kept, childless records once with NULLs.

    The left join is split into matches and childless records: an inner join lets the adaptive planner split a record
    that owns very many children, which a left join with the big side on the right cannot.
    """
    c = child.select(*[F.col(x).alias(prefix + x) for x in child.columns])
    cond = reduce(lambda a, b: a & b, [F.col(prefix + x) == F.col(p) for x, p in on])
    matched = c.join(parent, cond).select(*parent.columns, *c.columns)
    with_child = child.select(*[F.col(x).alias(p) for x, p in on]).distinct()
    childless = parent.join(with_child, [p for _, p in on], "left_anti")
    blanks = [F.lit(None).cast(child.schema[x].dataType).alias(prefix + x) for x in child.columns]
    return matched.unionByName(childless.select(*parent.columns, *blanks))


def with_layers(df: DataFrame, *layers: DataFrame, on: Sequence[str], optional: Sequence[DataFrame] = ()) -> DataFrame:
    """Record with its 1:1 layers (inner) and any optional ones (left)."""
    out = reduce(lambda acc, layer: acc.join(layer, list(on)), layers, df)
    return reduce(lambda acc, layer: acc.join(layer, list(on), "left"), optional, out)


def has_any(col_array: Column | str, codes: Sequence[str]) -> Column:
    """Membership test on the array form, without a join."""
    return F.arrays_overlap(col_array, F.array(*[F.lit(c) for c in codes]))


def having_child(df: DataFrame, child: DataFrame, on: Sequence[str], code: str, codes: Sequence[str]) -> DataFrame:
    """Membership test on the child table: records with a child that has one of the codes."""
    return df.join(child.where(F.col(code).isin(list(codes))).select(*on), list(on), "left_semi")


def branch_predicate(branches: Sequence[tuple[str, Sequence[str]]], broad_col: Column | str, sub_col: Column | str) -> Column:
    """OR over branches of: has the broad code and, when subcodes are given, one of them."""
    def one(group: str, subs: Sequence[str]) -> Column:
        hit = F.array_contains(broad_col, group)
        return hit & has_any(sub_col, subs) if subs else hit
    return reduce(lambda a, b: a | b, [F.coalesce(one(g, s), F.lit(False)) for g, s in branches])


def branch_semi(df: DataFrame, broad: DataFrame, sub: DataFrame, branches: Sequence[tuple[str, Sequence[str]]],
                on: Sequence[str], broad_code: str, sub_code: str, parent_code: str) -> DataFrame:
    """The same test on child tables. Each child table is folded once into one hit flag per branch and record."""
    on = list(on)
    b = broad.groupBy(*on).agg(*[F.bool_or(F.col(broad_code) == g).alias(f"_b{i}") for i, (g, _) in enumerate(branches)])
    s = sub.groupBy(*on).agg(*[
        F.bool_or((F.col(parent_code) == g) & F.col(sub_code).isin(list(subs)) if subs else F.lit(True)).alias(f"_s{i}")
        for i, (g, subs) in enumerate(branches)])
    hits = b.join(s, on, "left").where(reduce(lambda a, c: a | c, [
        F.col(f"_b{i}") & (F.coalesce(F.col(f"_s{i}"), F.lit(False)) if subs else F.lit(True))
        for i, (_, subs) in enumerate(branches)]))
    return df.join(hits.select(*on), on, "left_semi")


def missing_in(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.join(b.select(*on), list(on), "left_anti")


def suppress(provisional: DataFrame, confirmed: DataFrame, eq: Sequence[str], optional: str, kept: bool = True) -> DataFrame:
    """Provisional records without (``kept``) or with a confirmed one: equal on ``eq`` and, when the provisional record
    names it, equal on ``optional``.

    The wildcard is split off: records that name the value need the full key, the others only ``eq``. Both are plain
    equi-joins on distinct keys, so no group of confirmed records is ever compared row by row.
    """
    how = "left_anti" if kept else "left_semi"
    named = F.coalesce(F.col(optional) != "", F.lit(False))
    full = confirmed.select(*eq, F.coalesce(optional, F.lit("")).alias(optional)).distinct()
    part = confirmed.select(*eq).distinct()
    return (provisional.where(named).join(full, [*eq, optional], how).select(*provisional.columns)
            .unionByName(provisional.where(~named).join(part, list(eq), how).select(*provisional.columns)))


def pair(a: DataFrame, b: DataFrame, key: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Full outer join on the key with side flags; the other columns come as ``old_`` and ``new_``."""
    cols = [c for c in (cols if cols is not None else a.columns) if c not in key]
    left = a.select(*key, *[F.col(c).alias("old_" + c) for c in cols], F.lit(True).alias("in_old"))
    right = b.select(*key, *[F.col(c).alias("new_" + c) for c in cols], F.lit(True).alias("in_new"))
    return (left.join(right, list(key), "full_outer")
            .withColumn("in_old", F.coalesce("in_old", F.lit(False))).withColumn("in_new", F.coalesce("in_new", F.lit(False))))


def match_values(applicants: DataFrame, rules: DataFrame, value: str, floor: str, inclusive: str) -> DataFrame:
    """Per applicant: how many rules their value (integer tenths 0..50) satisfies.

    Rules are counted per (floor, inclusive), each such group is spread over the tenths it admits, and the 51 totals
    are looked up. No applicant x rule pair is ever produced.
    """
    groups = rules.where(F.col(floor).isNotNull()).groupBy(floor, inclusive).agg(F.count("*").alias("n"))
    first = F.col(floor) + F.when(F.coalesce(inclusive, F.lit(False)), 0).otherwise(1)
    # sequence() would count down when the first admitted tenth lies above 50
    admitted = F.when(first <= 50, F.sequence(first.cast("int"), F.lit(50)))
    totals = (groups.select("n", F.explode(admitted).alias(value)).groupBy(value)
              .agg(F.sum("n").alias("matching_rules")))
    # at most 51 rows: one per tenth
    return (applicants.join(F.broadcast(totals), value, "left")
            .withColumn("matching_rules", F.coalesce("matching_rules", F.lit(0))))


def resolve(saved: DataFrame, current: DataFrame, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Saved list against current records: current values, or the saved snapshot marked stale."""
    now = current.select(*key, *[F.col(f).alias(f"_now_{f}") for f in fields], F.lit(True).alias("_found"))
    j = saved.join(now, list(key), "left")
    found = F.col("_found").isNotNull()
    return j.select(*key, F.when(found, "current").otherwise("stale").alias("state"),
                    *[F.when(found, F.col(f"_now_{f}")).otherwise(F.col(f)).alias(f) for f in fields])


def nest(parent: DataFrame, child: DataFrame, on: Sequence[tuple[str, str]], as_: str, page: int = 10_000) -> DataFrame:
    """Children collected into pages of their parent: arrays of structs with ``copies`` for exact duplicates.

    A row is one page of a parent and its key is (parent key, ``part``), whatever the number of children: ``page`` is
    how many different children a page holds on average, so no array and no task has to hold a hot parent whole. A
    child's page follows from a hash of the child and the parent's number of pages; part 0 is always there.
    """
    cols = child.columns
    names = [p for _, p in on]
    copies = child.groupBy(*cols).agg(F.count("*").alias("copies"))
    keyed = copies.select(*[F.col(c).alias(p) for c, p in on], F.struct(*cols, "copies").alias("_c"))
    sizes = keyed.groupBy(*names).agg(F.count("*").alias("_n"))
    # only parents of several pages; a plain join, which Spark splits at a parent that owns many rows
    several = sizes.where(F.col("_n") > page).select(*names, F.ceil(F.col("_n") / page).cast("int").alias("_pages"))
    at = F.coalesce(F.pmod(F.xxhash64(*[F.col(f"_c.{c}") for c in cols]), F.col("_pages")), F.lit(0)).cast("int")
    placed = keyed.join(several, names, "left").withColumn("part", at)
    lists = placed.groupBy(*names, "part").agg(F.sort_array(F.collect_list("_c")).alias(as_))
    pages = parent.join(several, names, "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pages"), F.lit(1)) - 1)))
    empty = F.array().cast(lists.schema[as_].dataType)
    return (pages.join(lists, [*names, "part"], "left").withColumn(as_, F.coalesce(as_, empty))
            .select(*parent.columns, "part", as_))


def flag_index(df: DataFrame, key: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Key and a struct of boolean flags; a flag that is not Yes/No/true/false fails the job."""
    def value(c: str) -> Column:
        v = F.col(c).cast("string")
        return F.when(v.isin("Yes", "true"), True).when(v.isin("No", "false"), False).otherwise(
            F.raise_error(F.concat(F.lit(f"{c} is not a flag: "), F.coalesce(v, F.lit("NULL")))).cast("boolean"))
    return df.select(*key, F.struct(*[value(f).alias(f) for f in flags]).alias("flags"))


def attach_flags(df: DataFrame, index: DataFrame, key: Sequence[str]) -> DataFrame:
    """Records with their flags and how often the index has their key (1 is right, 0 and 2+ are defects)."""
    folded = index.groupBy(*key).agg(F.count("*").alias("index_rows"), F.min("flags").alias("flags"))
    return df.join(folded, list(key), "left").withColumn("index_rows", F.coalesce("index_rows", F.lit(0)))


def flag_gate(attached: DataFrame) -> DataFrame:
    return attached.agg(F.count("*").alias("records"), F.count_if(F.col("index_rows") == 0).alias("missing"),
                        F.count_if(F.col("index_rows") > 1).alias("repeated"))


def beside(*frames: DataFrame) -> DataFrame:
    """Frames of one row each as one row, by an aggregate over their union rather than a product."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
