"""Do two forms of the same search agree, for every query of a suite: keys, counts and summaries.

The array form asks the record's own membership arrays. The join form asks stored membership tables: they are folded once to
one row of bit sets per record, whatever the number of queries. Both forms are then answered in one scan of the records, as two
bit sets per row. Key sets are compared by a hash that does not depend on order (count and sums of two 64-bit hashes), so keys
are only listed for the queries where the hashes differ.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle
from .search import SearchRequest, predicate, safe_match

#: queries, or branches of queries, that share a bit set
BITS = 60
KINDS = ("groups", "places", "broad", "sub")
Suite = Sequence[tuple[str, SearchRequest]]


def _bits(items: Sequence[tuple[int, Sequence[str]]], code: str) -> Column:
    """The bits of all items whose list holds the code."""
    by_code: dict[str, int] = {}
    for bit, codes in items:
        for c in set(codes):
            by_code[c] = by_code.get(c, 0) | 1 << bit
    out = F.lit(0).cast("bigint")
    for c, mask in by_code.items():
        out = F.when(F.col(code) == c, F.lit(mask).cast("bigint")).otherwise(out)
    return out


def _wanted(suite: Suite) -> dict[str, list[tuple[int, Sequence[str]]]]:
    """Per kind of membership: what each query, or each branch in suite order, asks for."""
    branches = [b for _, r in suite for b in r.branches]
    return {
        "groups": [(i, r.groups) for i, (_, r) in enumerate(suite) if r.groups],
        "places": [(i, r.places) for i, (_, r) in enumerate(suite) if r.places],
        "broad": [(k, [g]) for k, (g, _) in enumerate(branches)],
        "sub": [(k, subs) for k, (_, subs) in enumerate(branches) if subs],
    }


def fold_memberships(children: Mapping[str, DataFrame], key: Sequence[str], suite: Suite, code: str = "code") -> DataFrame:
    """(key, one bit set per kind): one row per record with members, from tables of (key, code) per kind."""
    wanted = _wanted(suite)
    rows = [children[k].select(*key, *[(_bits(wanted[k], code) if k == o else F.lit(0).cast("bigint")).alias(f"_{o}") for o in KINDS]) for k in KINDS]
    return reduce(DataFrame.unionByName, rows).groupBy(*key).agg(*[F.bit_or(f"_{k}").alias(f"_{k}") for k in KINDS])


def _joined_form(suite: Suite) -> list[Column]:
    """Each query as a predicate that takes memberships from the folded bit sets, and the rest of it from ``_rest``."""
    has = lambda kind, bit: F.coalesce(F.getbit(f"_{kind}", F.lit(bit)) == 1, F.lit(False))
    out, at = [], 0
    for i, (_, r) in enumerate(suite):
        hit = has("rest", i)
        if r.groups:
            hit = hit & has("groups", i)
        if r.places:
            hit = hit & has("places", i)
        if r.branches:
            one = [has("broad", at + k) & (has("sub", at + k) if subs else F.lit(True)) for k, (_, subs) in enumerate(r.branches)]
            hit = hit & reduce(lambda a, b: a | b, one)
        at += len(r.branches)
        out.append(hit)
    return out


def _mask(hits: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(h, F.lit(1 << i)).otherwise(0).cast("bigint") for i, h in enumerate(hits)])


def _chunks(suite: Suite) -> list[Suite]:
    """Runs of the suite whose queries and branches fit a bit set each."""
    out: list[list] = []
    for q in suite:
        if not out or len(out[-1]) == BITS or sum(len(r.branches) for _, r in [*out[-1], q]) > BITS:
            out.append([])
        out[-1].append(q)
    return out


BOUNDS = ("gpa_min_tenths", "gpa_min_inclusive", "gpa_max_tenths", "gpa_max_inclusive")


def both_forms(records: DataFrame, children: Mapping[str, DataFrame], key: Sequence[str], suite: Suite, keep: Sequence[str] = ()) -> DataFrame:
    """The records' key and ``keep`` with ``_a`` and ``_b``: the queries that the array form and the join form answer with them.

    A record meets its members as bit sets, with none of its other columns.
    """
    rest = [predicate(replace(r, groups=(), places=(), branches=())) for _, r in suite]
    asked = records.select(*dict.fromkeys([*key, *keep]), _mask([predicate(r) for _, r in suite]).alias("_a"), _mask(rest).alias("_rest"))
    met = asked.join(fold_memberships(children, key, suite), list(key), "left")
    return met.withColumn("_b", _mask(_joined_form(suite))).drop("_rest", *[f"_{k}" for k in KINDS])


def _written(records: DataFrame, children: Mapping[str, DataFrame], key: Sequence[str], suite: Suite, group: str, status: str) -> list[tuple[Suite, DataFrame]]:
    """Both forms per chunk of the suite, written once for all that is counted and listed of them."""
    keep = [group, status, *[c for c in BOUNDS if c in records.columns]]
    return [(part, settle(both_forms(records, children, key, part, keep), "forms")) for part in _chunks(suite)]


def suite_equivalence(records: DataFrame, children: Mapping[str, DataFrame], key: Sequence[str], suite: Suite, group: str = "university",
                      status: str = "gpa_parse_status") -> DataFrame:
    """One row per query: label, rows_a, rows_b, same_keys, same_summary, and the summary of the array form.

    The summary is that of a search page: safe matches and misses of the asked value (NULL without one), rows with a safe rule,
    rows under review, the rest, and distinct groups.
    """
    out = [_compared(forms, key, part, group, status) for part, forms in _written(records, children, key, suite, group, status)]
    return reduce(DataFrame.unionByName, out)


def _compared(forms: DataFrame, key: Sequence[str], suite: Suite, group: str, status: str) -> DataFrame:
    bounds = [c for c in BOUNDS if c in forms.columns]
    h = [F.xxhash64(*key).cast("decimal(20,0)"), F.xxhash64(F.lit(7), *key).cast("decimal(20,0)")]
    # rows are added up per pair of bit sets before anything is listed per query
    counted = forms.groupBy(F.col(status).alias("s"), *bounds, "_a", "_b").agg(F.count("*").alias("n"), F.sum(h[0]).alias("h1"), F.sum(h[1]).alias("h2"))
    asked = F.array(*[F.struct(
        F.lit(label).alias("label"), F.lit(i).alias("i"), F.lit(r.value_tenths is not None).alias("valued"),
        (safe_match(r.value_tenths, status="s") if r.value_tenths is not None else F.lit(False)).alias("safe")) for i, (label, r) in enumerate(suite)])
    lines = counted.withColumn("q", F.explode(asked)).select("n", "h1", "h2", "s", "_a", "_b", "q.*")
    lines = lines.withColumns({"a": F.getbit("_a", F.col("i")) == 1, "b": F.getbit("_b", F.col("i")) == 1})
    parsed, review = F.col("s") == "parsed_safe", F.col("s") == "conditional_review"

    def total(side: str, what: Column | None = None, of: str = "n") -> Column:
        hit = F.col(side) if what is None else F.col(side) & F.coalesce(what, F.lit(False))
        return F.coalesce(F.sum(F.when(hit, F.col(of))), F.lit(0))

    def side(x: str) -> list[Column]:
        return [total(x).alias(f"rows_{x}"), total(x, of="h1").alias(f"h1_{x}"), total(x, of="h2").alias(f"h2_{x}"), total(x, F.col("safe")).alias(f"safe_{x}"),
                total(x, parsed & ~F.col("safe")).alias(f"miss_{x}"), total(x, parsed).alias(f"rule_{x}"), total(x, review).alias(f"review_{x}")]

    # distinct groups from one pair of bit sets per group, so that no row per query and group exists
    bits: dict[tuple[str, bool], int] = {}
    for i, (label, r) in enumerate(suite):
        named = (label, r.value_tenths is not None)
        bits[named] = bits.get(named, 0) | 1 << i
    listed = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(valued).alias("valued"), *[
        (F.col(f"_{x}").bitwiseAND(F.lit(b).cast("bigint")) != 0).alias(x) for x in "ab"]) for (label, valued), b in bits.items()])
    per_group = forms.where(F.col(group).isNotNull()).groupBy(group).agg(F.bit_or("_a").alias("_a"), F.bit_or("_b").alias("_b"))
    groups = per_group.select(F.explode(listed).alias("q")).select("q.*").groupBy("label", "valued").agg(
        *[F.count_if(x).alias(f"groups_{x}") for x in "ab"])
    all_ = lines.groupBy("label", "valued").agg(*side("a"), *side("b")).join(groups, ["label", "valued"], "left").fillna(0, ["groups_a", "groups_b"])
    same =lambda *names: reduce(lambda p, q: p & q, [F.col(f"{n}_a") == F.col(f"{n}_b") for n in names])
    valued = lambda c: F.when(F.col("valued"), F.col(c))
    return all_.select(
        "label", "rows_a", "rows_b", same("rows", "h1", "h2").alias("same_keys"), same("rows", "safe", "miss", "rule", "review", "groups").alias("same_summary"),
        valued("safe_a").alias("safe_match_rows"), valued("miss_a").alias("safe_no_match_rows"), F.col("rule_a").alias("safe_numeric_rule_rows"),
        F.col("review_a").alias("conditional_review_rows"), (F.col("rows_a") - F.col("rule_a") - F.col("review_a")).alias("not_evaluable_rows"),
        F.col("groups_a").alias("group_count"))


def suite_differences(records: DataFrame, children: Mapping[str, DataFrame], key: Sequence[str], suite: Suite, group: str = "university",
                      status: str = "gpa_parse_status") -> DataFrame:
    """(label, key, side): the keys that only one form answers, looked for only where the hashes differ."""
    written = _written(records, children, key, suite, group, status)
    compared = reduce(DataFrame.unionByName, [_compared(forms, key, part, group, status) for part, forms in written])
    differing = {r["label"] for r in compared.where("NOT same_keys").select("label").collect()}  # a suite is a short list
    out = []
    for part, forms in written:
        asked = [(i, label) for i, (label, _) in enumerate(part) if label in differing]
        if not asked:
            continue
        lines = F.array_compact(F.array(*[F.when(F.getbit("_a", F.lit(i)) != F.getbit("_b", F.lit(i)), F.struct(
            F.lit(label).alias("label"), F.when(F.getbit("_a", F.lit(i)) == 1, "array").otherwise("join").alias("side"))) for i, label in asked]))
        out.append(forms.where("_a <> _b").select(*key, F.explode(lines).alias("d")).select("d.label", *key, "d.side"))
    if not out:
        return records.where("false").select(F.lit("").alias("label"), *key, F.lit("").alias("side"))
    return reduce(DataFrame.unionByName, out)
