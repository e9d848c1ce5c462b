"""Review workflow: packets of values to decide on, checks on the decisions, and the next crosswalk version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as P
from ..functions.ranks import numbered
from ..functions.skew import join_small_or_keyed
from .classify import SAFE_FLOORS, layer_counts, settled  # noqa: F401
from .rules import Rule, apply_rules  # noqa: F401

# ---- fixed values: decision status -> (tier, class, flags, numeric tokens keep the floor, safe minimum keeps the floor) ----
DECISION_RULES = {
    "safe_simple_overall": ("safe_numeric", "simple_overall_minimum", "numeric", True, True),
    "safe_overall_with_additional_conditions": ("conditional_numeric", "other_complex_numeric", "numeric", True, False),
    "no_safe_overall_floor": ("conditional_numeric", "other_complex_numeric", "numeric", True, False),
    "non_binding": ("do_not_numeric", "nonbinding_or_historical_numeric", "nonbinding", False, False),
    "non_admission_numeric": ("do_not_numeric", "non_admission_or_inoperative_numeric", "numeric", False, False),
    "historical": ("do_not_numeric", "nonbinding_or_historical_numeric", "historical", False, False),
    "ambiguous": ("do_not_numeric", "unresolved", "unresolved", False, False),
    "unknown": ("do_not_numeric", "unknown", "unknown", False, False),
}
# ---- end of fixed values --------------------------------------------------------------------------------------------------


def review_packet(new: DataFrame, old: DataFrame, col: str, xw: DataFrame, order: str, cols: Sequence[str],
                  status: str = "requirement_status") -> DataFrame:
    """Values that are new against the old snapshot or not in the crosswalk: frequency, representative row, status."""
    vals = (new.where(~P.is_blank(col)).groupBy(F.col(col).alias("raw_or_context"))
            .agg(F.count("*").alias("frequency"), F.min_by(F.struct(*cols), order).alias("_r")))
    seen = old.select(F.col(col).alias("raw_or_context"), F.lit(True).alias("_seen")).distinct()
    one = settled(xw, [status])
    listed = one.select(F.col("raw_value").alias("raw_or_context"), F.when(F.col("conflict"), "review_required").otherwise(F.col(status)).alias("_s"))
    j = vals.join(seen, "raw_or_context", "left").join(listed, "raw_or_context", "left")
    s = F.when(F.col("_s").isNull(), "unmapped").otherwise(F.concat(F.lit("exact_crosswalk_"), F.col("_s")))
    note = F.when(F.col("_s").isNull(), "Needs a human decision; nothing is inferred from the text.").otherwise(
        "Covered by the reviewed exact crosswalk.")
    return (j.where("_seen is null or _s is null")
            .select("raw_or_context", "frequency", *[F.col(f"_r.{c}").alias(f"representative_{c}") for c in cols],
                    s.alias("current_fail_closed_status"), note.alias("suggested_review_note")))


def number_packet(packet: DataFrame, order: Sequence[str] = ("raw_or_context",), out: str = "review_order") -> DataFrame:
    """The packet with its review order 1..n: its place by ``order``, counted over ranges and not in one task."""
    return numbered(packet, list(order), "_at", "packet").withColumn(out, F.col("_at") + 1).drop("_at")


def context_packet(new: DataFrame, old: DataFrame, cols: Sequence[str], raw_xw: DataFrame, ctx_xw: DataFrame,
                   order: str, id_: str) -> DataFrame:
    """Context tuples the old snapshot did not have, with one of four statuses; ``needs_review`` marks the open ones.

    ``raw_xw`` has raw_value, mapping_status; ``ctx_xw`` the context columns. The last of ``cols`` is the raw value.
    """
    cols = list(cols)
    filled = lambda d, *more: d.select(*[P.text(c).alias(c) for c in cols], *more)
    ctx = filled(new, F.struct(order, id_).alias("_o")).groupBy(*cols).agg(F.count("*").alias("frequency"), F.min("_o").alias("_o"))
    fresh = ctx.join(filled(old).distinct(), cols, "left_anti")
    r = raw_xw.groupBy(F.col("raw_value").alias(cols[-1])).agg(F.min("mapping_status").alias("_rs"))
    x = filled(ctx_xw).distinct().withColumn("_exact", F.lit(True))
    j = join_small_or_keyed(fresh, r, [cols[-1]], cols)
    j = j.join(x, cols, "left")
    status = (F.when(F.col("_rs").isNull(), "unmapped_raw_and_context").when(F.col("_exact"), "mapped_exact_context")
              .when(F.col("_rs") == "review_required", "review_required_no_exact_context")
              .otherwise("mapped_by_existing_raw_exact"))
    return j.select(F.concat_ws(" | ", *cols).alias("raw_or_context"), "frequency",
                    F.col(f"_o.{id_}").alias("representative_record_id"), status.alias("current_fail_closed_status"),
                    status.isin("unmapped_raw_and_context", "review_required_no_exact_context").alias("needs_review"))


def check_correspondence(packet: DataFrame, decisions: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Packet and decisions row by row on ``review_order``: missing rows and differing columns (packet -> decision)."""
    p = packet.select("review_order", *[F.col(a).cast("string").alias(f"_p{i}") for i, a in enumerate(columns)], F.lit(True).alias("_p"))
    d = decisions.select("review_order", *[F.col(b).cast("string").alias(f"_d{i}") for i, b in enumerate(columns.values())],
                         F.lit(True).alias("_d"))
    j = p.join(d, "review_order", "full_outer")
    both = F.col("_p") & F.col("_d")
    found = F.array_compact(F.array(
        F.when(F.col("_d").isNull(), F.lit("missing_decision")), F.when(F.col("_p").isNull(), F.lit("missing_packet_row")),
        *[F.when(both & ~F.col(f"_p{i}").eqNullSafe(F.col(f"_d{i}")), F.lit(b)) for i, b in enumerate(columns.values())]))
    return j.select("review_order", F.explode(found).alias("issue"))


def order_issues(decisions: DataFrame) -> DataFrame:
    """One row: is the review order exactly 1..n."""
    return decisions.agg(F.count("*").alias("rows"), (
        F.min("review_order").eqNullSafe(F.lit(1)) & F.max("review_order").eqNullSafe(F.count("*"))
        & (F.count_distinct("review_order") == F.count("*"))).alias("contiguous"))


def check_frequencies(df: DataFrame, decisions: DataFrame, col: str, id_: str) -> DataFrame:
    """Decisions whose frequency is not the recounted one, or whose representative does not carry the value."""
    counts = df.where(~P.is_blank(col)).groupBy(F.col(col).alias("raw_value")).agg(F.count("*").alias("actual"))
    reps = decisions.select("raw_value", F.col("representative_record_id").alias(id_))
    right = df.join(reps.select(id_).distinct(), id_, "left_semi").select(id_, F.col(col).alias("_v"))
    ok = (reps.join(right, id_).where(F.col("_v") == F.col("raw_value")).select("raw_value").distinct().withColumn("_ok", F.lit(True)))
    j = decisions.join(counts, "raw_value", "left").join(ok, "raw_value", "left")
    found = F.array_compact(F.array(
        F.when(F.col("frequency") != F.coalesce("actual", F.lit(0)), F.lit("frequency")),
        F.when(F.col("_ok").isNull(), F.lit("representative"))))
    return j.select("raw_value", F.coalesce("actual", F.lit(0)).alias("actual"), F.explode(found).alias("issue"))


def check_decisions(decisions: DataFrame) -> DataFrame:
    """A floor exists exactly on safe decisions, its text equals its tenths, and the additional flag fits the status."""
    status, floor, text = F.col("approved_numeric_status"), F.col("approved_overall_floor_tenths"), F.col("approved_overall_floor")
    extra = P.text("approved_additional_conditions")
    safe = status.isin(list(SAFE_FLOORS))
    complete = (F.col("approved_grade_status") == "required") & ~P.is_blank(floor) & ~P.is_blank(text) & extra.isin("true", "false")
    want = F.when(extra == "true", SAFE_FLOORS[1]).otherwise(SAFE_FLOORS[0])
    checks = {
        "incomplete_safe_decision": safe & ~F.coalesce(complete, F.lit(False)),
        "floor_text_differs": safe & F.coalesce(complete, F.lit(False)) & ~P.to_tenths(text).eqNullSafe(P.strict_int(floor, "int")),
        "additional_flag_differs": safe & F.coalesce(complete, F.lit(False)) & (status != want),
        "floor_on_unsafe_decision": ~safe & (~P.is_blank(floor) | ~P.is_blank(text)),
    }
    return decisions.select("raw_value", F.explode(F.array_compact(F.array(*[
        F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]))).alias("issue"))


def overlap(prev: DataFrame, decisions: DataFrame, key: Sequence[str] = ("raw_value",)) -> DataFrame:
    """Decided keys that the previous crosswalk already has; must be empty."""
    return decisions.select(*key).distinct().join(prev.select(*key).distinct(), list(key), "left_semi")


def next_crosswalk(prev: DataFrame, decisions: DataFrame, version: str, key: Sequence[str] = ("raw_value",),
                   version_column: str = "contract_version") -> DataFrame:
    """Re-versioned union of the previous crosswalk and the decisions; a decided key that already exists fails the job."""
    rest = [c for c in prev.columns if c != version_column]
    known = prev.select(*key, F.lit(True).alias("_known")).distinct()
    gated = decisions.join(known, list(key), "left").withColumn(key[0], F.when(
        F.col("_known"), F.raise_error(F.concat(F.lit("already decided: "), F.col(key[0]))).cast("string")).otherwise(F.col(key[0])))
    return (prev.select(*rest).unionByName(gated.select(*rest))
            .select(F.lit(version).alias(version_column), *rest))


def changed_decisions(prev: DataFrame, next_: DataFrame, key: str = "raw_value") -> DataFrame:
    """Earlier decisions that the next version lost or changed (versions left out)."""
    cols = [c for c in prev.columns if c not in (key, "contract_version")]
    b = next_.select(key, *[F.col(c).alias("_n_" + c) for c in cols], F.lit(True).alias("_found"))
    j = prev.join(b, key, "left")
    found = F.array_compact(F.array(
        F.when(F.col("_found").isNull(), F.lit("(lost)")),
        *[F.when(F.col("_found") & ~F.col(c).eqNullSafe(F.col("_n_" + c)), F.lit(c)) for c in cols]))
    return j.select(key, F.explode(found).alias("issue"))


def decision_to_rule(decisions: DataFrame) -> DataFrame:
    """Decisions as rows of the numeric rule table; an unlisted status fails the job."""
    status, floor = F.col("approved_numeric_status"), P.text("approved_overall_floor")

    def pick(i: int) -> Column:
        chain = None
        for name, values in DECISION_RULES.items():
            v = F.when(F.lit(values[i]), floor).otherwise("") if isinstance(values[i], bool) else F.lit(values[i])
            chain = F.when(status == name, v) if chain is None else chain.when(status == name, v)
        return chain.otherwise(F.raise_error(F.concat(F.lit("unsupported status: "), P.text(status))).cast("string"))

    return decisions.select("raw_value", pick(0).alias("distinct_tier"), pick(1).alias("primary_class"),
                            pick(2).alias("feature_flags"), pick(3).alias("numeric_tokens"), pick(4).alias("safe_gpa_min"),
                            F.lit("").alias("safe_gpa_max"), F.lit("reviewed").alias("review_status"))


def decision_memberships(decisions: DataFrame, broad: DataFrame, sub: DataFrame, key: str = "raw_value") -> DataFrame:
    """Pipe-separated code lists to ordered membership rows; a broad code without subcodes keeps one row.

    ``broad`` has group_code, rank; ``sub`` has subcategory_code, parent_group_code, rank.
    """
    codes = lambda c: F.filter(F.array_distinct(F.split(P.text(c), r"\|")), lambda x: x != "")
    g = decisions.select(key, F.explode(codes("broad_group_codes")).alias("group_code"))
    g = join_small_or_keyed(g, broad.select("group_code", F.col("rank").alias("_gr")), ["group_code"], [key], "inner")
    s = decisions.select(key, F.explode(codes("subcategory_codes")).alias("subcategory_code"))
    s = join_small_or_keyed(s, sub.select("subcategory_code", F.col("parent_group_code").alias("group_code"),
                                          F.col("rank").alias("_sr")), ["subcategory_code"], [key], "inner")
    pairs = g.join(s, [key, "group_code"], "left")
    # one decision lists at most every taxonomy code once, so the sorted array is bounded by the taxonomy
    per = pairs.groupBy(key).agg(F.sort_array(F.collect_set(F.struct(
        F.col("_gr"), F.coalesce("_sr", F.lit(0)).alias("_sr"), "group_code", "subcategory_code"))).alias("m"))
    groups = F.size(F.array_distinct(F.transform("m", lambda x: x["group_code"])))
    subs = F.size(F.array_distinct(F.filter(F.transform("m", lambda x: x["subcategory_code"]), lambda x: x.isNotNull())))
    one = lambda n: F.when(n == 1, "single").otherwise("multi")
    return per.select(
        key, one(F.size("m")).alias("mapping_status"), one(groups).alias("broad_mapping_status"),
        F.when(subs == 0, "not_applicable").otherwise(one(subs)).alias("subcategory_mapping_status"),
        F.posexplode("m").alias("pos", "x")).select(
        key, "mapping_status", "broad_mapping_status", "subcategory_mapping_status", "x.group_code", "x.subcategory_code",
        (F.col("pos") + 1).cast("bigint").alias("membership_order"))


def crosswalk_effect(df: DataFrame, col: str, prev: DataFrame, next_: DataFrame, status: str = "requirement_status") -> DataFrame:
    """Rows per status before and after, classified twice over the value counts instead of over the rows."""
    vals = df.groupBy(F.col(col).alias("raw_value")).agg(F.count("*").alias("n"))
    read = F.when(F.col("conflict"), "review_required").otherwise(F.col(status))
    a = settled(prev, [status]).select("raw_value", read.alias("_a"))
    b = settled(next_, [status]).select("raw_value", read.alias("_b"))
    label = lambda c: F.when(F.col("raw_value").isNull(), "unknown").otherwise(F.coalesce(c, F.lit("unmapped")))
    j = vals.join(a, "raw_value", "left").join(b, "raw_value", "left")
    sides = F.array(F.struct(label("_a").alias("status"), F.col("n").alias("before"), F.lit(0).cast("bigint").alias("after")),
                    F.struct(label("_b").alias("status"), F.lit(0).cast("bigint").alias("before"), F.col("n").alias("after")))
    return (j.select(F.explode(sides).alias("x")).groupBy("x.status")
            .agg(F.sum("x.before").alias("before"), F.sum("x.after").alias("after")))
