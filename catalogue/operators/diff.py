"""Snapshot comparison: keys, cells, multisets, issue counts and search results.

Row equality is decided on a 128-bit fingerprint, so only key and fingerprint of an unchanged wide row are shuffled;
cells are fetched for changed keys alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contract as K
from ..functions.skew import fingerprint
from ..sources.shared import settle
from .facets import compare_counts
from .search import SearchRequest, predicate

# ---- fixed values: classes of changed cells ---------------------------------------------------------------------------
CLASSES = {
    "A_search_visible_material": K.MATERIAL_FIELDS,
    "B_publication_provenance": K.PROVENANCE_FIELDS,
    "C_notes_completeness": K.NOTES_FIELDS,
}
OTHER_CLASS = "D_other"
# ---- end of fixed values ----------------------------------------------------------------------------------------------


def field_class(name: str, classes: Mapping[str, Sequence[str]] = CLASSES) -> str:
    return next((c for c, fields in classes.items() if name in fields), OTHER_CLASS)


def last_by_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """One row per key, the last by ``order``: what a keyed diff sees when a snapshot repeats a key."""
    rest = [c for c in df.columns if c not in key]
    g = df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return g.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def aligned(old: DataFrame, new: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both snapshots with the columns of either; one that a side lacks is NULL there. A column of two types raises."""
    kinds: dict = {}
    for f in (*old.schema.fields, *new.schema.fields):
        if kinds.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is {kinds[f.name].simpleString()} in one snapshot and {f.dataType.simpleString()} in the other")
    rest = [c for c in kinds if c not in key]
    both = [df.select(*key, *[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in rest]) for df in (old, new)]
    return both[0], both[1], rest


#: bits of a hash that are added up per key, so that no sum overflows
SUM_BITS = 44


def diff_keys(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key with its state: added, removed, changed, unchanged.

    All columns of either snapshot count; one that a snapshot lacks is NULL there. A key that repeats is one row: unchanged if
    both sides have the same rows for it. The sides are added up in one aggregate, a row being a key and two numbers.
    """
    key = list(key)
    a, b, rest = aligned(old, new, key)
    part = F.lit((1 << SUM_BITS) - 1).cast("bigint")

    def side(df: DataFrame, na: int, nb: int) -> DataFrame:
        f = df.select(*key, fingerprint(rest).alias("_f"))
        sign = na - nb
        return f.select(*key, F.lit(na).alias("_na"), F.lit(nb).alias("_nb"), *[(F.col(f"_f.{x}").bitwiseAND(part) * sign).alias(f"_{x}") for x in "ab"])

    g = side(a, 1, 0).unionByName(side(b, 0, 1)).groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("_na", "_nb", "_a", "_b")])
    same = (F.col("_na") == F.col("_nb")) & (F.col("_a") == 0) & (F.col("_b") == 0)
    state = F.when(F.col("_na") == 0, "added").when(F.col("_nb") == 0, "removed").when(same, "unchanged").otherwise("changed")
    return g.select(*key, state.alias("state"))


def count_states(states: DataFrame, id_: str, n: int = 12) -> DataFrame:
    """Rows per state and the smallest ``n`` ids of each."""

    w = Window.partitionBy("state").orderBy(id_)
    ids = (states.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
           .groupBy("state").agg(F.sort_array(F.collect_list(id_)).alias("examples")))
    return states.groupBy("state").agg(F.count("*").alias("rows")).join(ids, "state")


def diff_cells(old: DataFrame, new: DataFrame, key: Sequence[str], classes: Mapping[str, Sequence[str]] = CLASSES,
               changed: DataFrame | None = None) -> DataFrame:
    """One row per changed cell of keys in both snapshots: field, class, old and new value as text.

    ``changed`` are the changed keys, where they are known already. Of a key that repeats, the row with the greatest
    fingerprint is compared.
    """
    key = list(key)
    old, new, rest = aligned(old, new, key)
    if changed is None:
        changed = diff_keys(old, new, key).where("state = 'changed'").select(*key)

    def of_changed(df: DataFrame, prefix: str) -> DataFrame:
        one = df.join(changed, key, "left_semi").groupBy(*key).agg(F.max_by(F.struct(*rest), fingerprint(rest)).alias("_r"))
        return one.select(*key, *[F.col(f"_r.{c}").alias(prefix + c) for c in rest])

    a, b = of_changed(old, "_a_"), of_changed(new, "_b_")
    cells = F.array_compact(F.array(*[
        F.when(~F.col("_a_" + c).eqNullSafe(F.col("_b_" + c)), F.struct(
            F.lit(c).alias("field"), F.lit(field_class(c, classes)).alias("classification"),
            F.col("_a_" + c).cast("string").alias("old_value"), F.col("_b_" + c).cast("string").alias("new_value")))
        for c in rest]))
    return a.join(b, key).select(*key, F.explode(cells).alias("x")).select(*key, "x.*")


def rollup_cells(cells: DataFrame, key: Sequence[str]) -> DataFrame:
    """Changed cells per field and per class, and records with a changed cell per class."""
    by = cells.groupBy("field", "classification").agg(F.count("*").alias("n"))
    fields = by.select(F.lit("field").alias("kind"), F.col("field").alias("value"), "n")
    classes = by.groupBy("classification").agg(F.sum("n").alias("n")).select(
        F.lit("class").alias("kind"), F.col("classification").alias("value"), "n")
    records = (cells.groupBy("classification", *key).agg(F.count("*").alias("_c")).groupBy("classification")
               .agg(F.count("*").alias("n")).select(F.lit("records").alias("kind"), F.col("classification").alias("value"), "n"))
    return fields.unionByName(classes).unionByName(records)


def transitions(old: DataFrame, new: DataFrame, key: Sequence[str], rules: Mapping[str, Column], cols: Sequence[str]) -> DataFrame:
    """Conditional counts over key pairs. Rules see ``old_*``, ``new_*``, ``in_old`` and ``in_new``."""
    from .views import pair
    both = pair(old.select(*key, *cols), new.select(*key, *cols), key)
    return both.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])


def fallback_rules(flag: str = "fallback_previous_year", year: str = "information_year", current: int = K.CONTRACT_YEAR) -> dict[str, Column]:
    """The standard transitions of the taken-over flag and the information year (boolean flag, integer year)."""
    was, now = F.coalesce(F.col(f"old_{flag}"), F.lit(False)), F.coalesce(F.col(f"new_{flag}"), F.lit(False))
    both, added = F.col("in_old") & F.col("in_new"), ~F.col("in_old") & F.col("in_new")
    earlier = was | F.coalesce(F.col(f"old_{year}") < current, F.lit(False))
    return {
        "fallback_removed": both & was & ~now,
        "fallback_introduced": both & ~was & now,
        "current_year_confirmed": both & earlier & ~now & (F.col(f"new_{year}") == current),
        "added_with_fallback": added & now,
        "year_changed": both & ~F.col(f"old_{year}").eqNullSafe(F.col(f"new_{year}")),
    }


def key_diff(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys on one side only, with the side."""
    ka, kb = a.select(*key), b.select(*key)
    return (ka.subtract(kb).withColumn("side", F.lit("only_a"))
            .unionByName(kb.subtract(ka).withColumn("side", F.lit("only_b"))))


def new_values(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``b`` that ``a`` does not have."""
    return b.select(col).where(F.col(col).isNotNull()).subtract(a.select(col))


def _multiset(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    both = (a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
            .unionByName(b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    return both.groupBy(*cols).agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: copies on one side beyond the other. Rows are counted, never listed, so copies cost nothing."""
    return _multiset(a, b, a.columns).agg(
        F.coalesce(F.sum(F.greatest(F.col("na") - F.col("nb"), F.lit(0))), F.lit(0)).alias("only_a"),
        F.coalesce(F.sum(F.greatest(F.col("nb") - F.col("na"), F.lit(0))), F.lit(0)).alias("only_b"))


def diff_children(old: DataFrame, new: DataFrame, parent_key: str) -> DataFrame:
    """Child rows added and removed as a multiset, and parents whose set of children changed."""
    counts = _multiset(old, new, old.columns)
    per = counts.groupBy(parent_key).agg(
        F.sum("na").alias("na"), F.sum("nb").alias("nb"),
        F.sum(F.greatest(F.col("nb") - F.col("na"), F.lit(0))).alias("added"),
        F.sum(F.greatest(F.col("na") - F.col("nb"), F.lit(0))).alias("removed"))
    z = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(z("na").alias("old_rows"), z("nb").alias("new_rows"), z("added").alias("rows_added"),
                   z("removed").alias("rows_removed"),
                   F.count_if((F.col("added") > 0) | (F.col("removed") > 0)).alias("changed_parents"))


def issue_delta(old_issues: DataFrame, new_issues: DataFrame) -> DataFrame:
    """Issue counts before and after per severity and code."""
    c = compare_counts(old_issues, new_issues, ["severity", "code"]).drop("percent")
    s = (c.groupBy("severity").agg(F.sum("before").alias("before"), F.sum("after").alias("after"), F.sum("delta").alias("delta"))
         .withColumn("code", F.lit(None).cast("string")))
    return c.unionByName(s)


def sidecar_report(parent: DataFrame, coverage: DataFrame, child: DataFrame, cov_key: Sequence[str], declared: str,
                   child_on: Sequence[tuple[str, str]], denormalized: Sequence[str] = ()) -> DataFrame:
    """One row on how well coverage and children fit the records, and the verdict.

    ``child_on`` lists (child column, parent column); ``denormalized`` are columns both have.
    """
    cov_key = list(cov_key)
    groups = parent.groupBy(*cov_key).agg(F.count("*").alias("n"))
    cov = coverage.groupBy(*cov_key).agg(F.max(declared).alias("declared"))
    c = groups.join(cov, cov_key, "full_outer").agg(
        F.count_if(F.col("declared").isNull()).alias("missing_coverage"),
        F.count_if(F.col("n").isNull()).alias("stale_coverage"),
        F.count_if(F.col("n").isNull() & (F.col("declared") != 0)).alias("stale_nonzero"),
        F.count_if(F.col("n") != F.col("declared")).alias("count_mismatches"))
    names = [x for x, _ in child_on]
    # written, so that no task adds up the children, sorts them and meets the parents all at once
    rows = settle(child.groupBy(*child.columns).agg(F.count("*").alias("n")), "children")
    p = parent.select(*[F.col(pc).alias(x) for x, pc in child_on], *[F.col(d).alias("_p_" + d) for d in denormalized],
                      F.lit(True).alias("_found"))
    differing = reduce(lambda a, b: a + b, [
        F.when(F.col("_found") & ~F.col(d).eqNullSafe(F.col("_p_" + d)), F.col("n")).otherwise(0) for d in denormalized], F.lit(0))
    r = rows.join(p, names, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_children"),
        F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum(differing), F.lit(0)).cast("bigint").alias("denormalized_mismatches"))
    out = c.withColumn("_one", F.lit(1)).join(r.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return out.withColumn("coherent", (F.col("missing_coverage") == 0) & (F.col("stale_nonzero") == 0)
                          & (F.col("count_mismatches") == 0) & (F.col("orphans") == 0))


#: queries per bit set; the sign bit stays free
MASK_BITS = 62


def search_drift(old: DataFrame, new: DataFrame, suite: Sequence[tuple[str, SearchRequest]], key: Sequence[str],
                 group: str = "university") -> DataFrame:
    """Per saved query: matches and groups before and after, keys that entered and left.

    Each row carries one bit per query, so what is shuffled is a row per key and one per group, however many queries
    match it; labels come back after the combinations of bits have been counted. A query without a match on either
    side is left out.
    """
    def counted(part: Sequence[tuple[str, SearchRequest]]) -> DataFrame:
        bits = [(n, 1 << i) for i, (n, _) in enumerate(part)]
        one = lambda r, b: F.when(F.coalesce(predicate(r), F.lit(False)), F.lit(b)).otherwise(F.lit(0)).cast("bigint")
        mask = reduce(lambda x, y: x.bitwiseOR(y), [one(r, b) for (_, r), (_, b) in zip(part, bits)])
        none = F.lit(0).cast("bigint")
        side = lambda df, o, n: df.select(*key, group, o.alias("o"), n.alias("n")).where((F.col("o") != 0) | (F.col("n") != 0))
        both = side(old, mask, none).unionByName(side(new, none, mask))
        label = F.explode(F.array(*[F.struct(F.lit(n).alias("label"), F.lit(b).cast("bigint").alias("bit")) for n, b in bits]))

        def per_label(by: Sequence[str], **sums: Column) -> DataFrame:
            masks = both.groupBy(*by).agg(F.bit_or("o").alias("o"), F.bit_or("n").alias("n")).groupBy("o", "n").agg(F.count("*").alias("c"))
            spread = masks.select("o", "n", "c", label.alias("l")).select("l.label", "c", *[
                (F.col(x).bitwiseAND(F.col("l.bit")) != 0).alias(f"in_{x}") for x in ("o", "n")])
            return spread.groupBy("label").agg(*[F.coalesce(F.sum(F.when(c, F.col("c"))), F.lit(0)).alias(n) for n, c in sums.items()])

        o, n = F.col("in_o"), F.col("in_n")
        keys = per_label(key, old_rows=o, new_rows=n, added=n & ~o, removed=o & ~n)
        return keys.join(per_label([group], old_groups=o, new_groups=n), "label").where("old_rows > 0 OR new_rows > 0")

    return reduce(DataFrame.unionByName, [counted(suite[k:k + MASK_BITS]) for k in range(0, len(suite), MASK_BITS)])
