"""Acceptance of a new snapshot as one job: a stored change set first, and everything else from it.

The snapshots are compared once, by key and fingerprint. The rows of keys that were added, removed or changed are stored with
both sides; cells, transitions, findings, classification, search drift and review packets are computed from those rows alone, so
past the comparison the job costs what has changed, not what there is. Totals of a suite or of findings follow from the ones
stored with the old snapshot plus the change. Every table is written below one folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import fingerprint
from . import diff as D
from . import review as R
from .rules import Rule, apply_rules
from .search import SearchRequest, predicate

# ---- fixed values: what the gate can say, in the order in which it is decided -----------------------------------------------
HOLD_SCHEMA, HOLD_SOURCE = "HOLD_SCHEMA", "HOLD_SOURCE_COHERENCE"
HOLD_VALIDATION, HOLD_REVIEW = "HOLD_VALIDATION", "HOLD_REVIEW_CORRESPONDENCE"
READY = "READY_FOR_PRODUCTION_PROMOTION"
# ---- end of fixed values ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Review:
    """A column whose new values need a decision: its crosswalk (raw_value, status), row order and representative columns."""

    column: str
    crosswalk: DataFrame
    order: str
    columns: Sequence[str]
    status: str = "requirement_status"


@dataclass(frozen=True)
class Plan:
    """What an acceptance looks at beside keys and cells. ``classify`` adds layers to rows before the suite is asked.

    ``old_suite`` (label, rows) and ``old_findings`` (severity, code, rows) are stored with the old snapshot.
    """

    rules: Sequence[Rule] = ()
    table: str = "master"
    dataset: Column | str = "source_dataset"
    transitions: Mapping[str, Column] = field(default_factory=D.fallback_rules)
    classes: Mapping[str, Sequence[str]] = field(default_factory=lambda: D.CLASSES)
    suite: Sequence[tuple[str, SearchRequest]] = ()
    classify: Callable[[DataFrame], DataFrame] = lambda df: df
    reviews: Sequence[Review] = ()
    sidecar: DataFrame | None = None
    old_suite: DataFrame | None = None
    old_findings: DataFrame | None = None


def change_set(old: DataFrame, new: DataFrame, key: Sequence[str], path: str) -> DataFrame:
    """Writes (key, state, old, new) of every key that is not unchanged, both rows as structs, and the counts of all states."""
    key, spark = list(key), old.sparkSession
    a, b, rest = D.aligned(old, new, key)
    D.diff_keys(old, new, key).write.parquet(f"{path}/keys")
    states = spark.read.parquet(f"{path}/keys")
    states.groupBy("state").agg(F.count("*").alias("rows")).write.parquet(f"{path}/states")
    changed = states.where("state <> 'unchanged'")

    def side(df: DataFrame, name: str) -> DataFrame:
        # of a key that repeats, the row with the greatest fingerprint stands for it
        return df.join(changed.select(*key), key, "left_semi").groupBy(*key).agg(F.max_by(F.struct(*rest), fingerprint(rest)).alias(name))

    changed.join(side(a, "old"), key, "left").join(side(b, "new"), key, "left").write.parquet(f"{path}/changes")
    return spark.read.parquet(f"{path}/changes")


def rows_of(changes: DataFrame, key: Sequence[str], side: str) -> DataFrame:
    """The changed rows of one snapshot as plain columns."""
    there = changes.where(F.col("state") != ("added" if side == "old" else "removed"))
    return there.select(*key, f"{side}.*")


def cells(changes: DataFrame, key: Sequence[str], classes: Mapping[str, Sequence[str]] = D.CLASSES) -> DataFrame:
    """One row per changed cell: field, class, old and new value."""
    names = changes.schema["old"].dataType.names
    found = F.array_compact(F.array(*[
        F.when(~F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")), F.struct(
            F.lit(c).alias("field"), F.lit(D.field_class(c, classes)).alias("classification"),
            F.col(f"old.`{c}`").cast("string").alias("old_value"), F.col(f"new.`{c}`").cast("string").alias("new_value"))) for c in names]))
    return changes.where("state = 'changed'").select(*key, F.explode(found).alias("x")).select(*key, "x.*")


def transition_counts(changes: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(transition, rows): rules over ``old_*``, ``new_*``, ``in_old`` and ``in_new``; an unchanged row passes through none."""
    names = changes.schema["old"].dataType.names
    both = changes.select(*[F.col(f"{s}.`{c}`").alias(f"{s}_{c}") for s in ("old", "new") for c in names],
                          (F.col("state") != "added").alias("in_old"), (F.col("state") != "removed").alias("in_new"))
    counts = both.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("transition"), F.col(n).alias("rows")) for n in rules])).alias("t")).select("t.*")


def finding_delta(changes: DataFrame, key: Sequence[str], plan: Plan) -> DataFrame:
    """(severity, code, before, after, delta) of the row rules; with stored findings these are the totals, else those of changed rows."""
    def found(side: str) -> DataFrame:
        return apply_rules(rows_of(changes, key, side), plan.rules, plan.table, plan.dataset, key[-1], F.lit(None).cast("bigint"))

    counts = D.compare_counts(found("old"), found("new"), ["severity", "code"]).select("severity", "code", "before", "delta")
    if plan.old_findings is not None:
        stored = plan.old_findings.select("severity", "code", F.col("rows").cast("bigint").alias("_rows"))
        counts = counts.join(stored, ["severity", "code"], "full_outer").select("severity", "code", F.coalesce("_rows", F.lit(0)).alias("before"),
                                                                                F.coalesce("delta", F.lit(0)).alias("delta"))
    return counts.select("severity", "code", "before", (F.col("before") + F.col("delta")).alias("after"), "delta")


def drift(changes: DataFrame, key: Sequence[str], plan: Plan) -> DataFrame:
    """(label, old_rows, new_rows, added, removed): how the changed keys move the saved queries; totals where they are stored."""
    both = []
    for side, there in (("old", -1), ("new", 1)):
        rows = plan.classify(rows_of(changes, key, side))
        hits = F.array_compact(F.array(*[F.when(F.coalesce(predicate(r), F.lit(False)), F.lit(label)) for label, r in plan.suite]))
        both.append(rows.select(*key, F.explode(hits).alias("label"), F.lit(there).alias("_s")))
    per_key = both[0].unionByName(both[1]).groupBy("label", *key).agg(F.sum("_s").alias("_s"))
    moved = per_key.groupBy("label").agg(F.count_if(F.col("_s") > 0).alias("added"), F.count_if(F.col("_s") < 0).alias("removed"))
    labels = changes.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n, _ in plan.suite])).alias("label"))
    out = labels.join(moved, "label", "left").na.fill(0, ["added", "removed"])
    if plan.old_suite is None:
        total = F.lit(None).cast("bigint")
        out = out.withColumn("old_rows", total)
    else:
        out = out.join(plan.old_suite.select("label", F.col("rows").cast("bigint").alias("old_rows")), "label", "left")
        out = out.withColumn("old_rows", F.coalesce("old_rows", F.lit(0).cast("bigint")))
    return out.select("label", "old_rows", (F.col("old_rows") + F.col("added") - F.col("removed")).alias("new_rows"), "added", "removed")


def packet(changes: DataFrame, old: DataFrame, new: DataFrame, review: Review) -> DataFrame:
    """Values that changed rows bring in and that the old snapshot lacks or the crosswalk does not list, as a review packet.

    Both snapshots are read for these values alone; frequency and representative count every row that has them.
    """
    c = review.column
    brought = changes.where(~F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`"))).select(F.col(f"new.`{c}`").alias(c)).where(F.col(c).isNotNull()).distinct()
    some = R.review_packet(new.join(brought, c, "left_semi"), old.join(brought, c, "left_semi"), c, review.crosswalk, review.order, review.columns, review.status)
    return some.select(F.lit(c).alias("column"), "raw_or_context", "frequency", "current_fail_closed_status", "suggested_review_note")


def gate(schema_same: bool, sidecar: DataFrame | None, findings: DataFrame | None, packets: DataFrame | None) -> tuple[str, str]:
    """Status and reason: the first reason to hold the snapshot, or that it is ready. The inputs are reports of a few rows."""
    if not schema_same:
        return HOLD_SCHEMA, "The columns of the snapshots differ."
    if sidecar is not None and not sidecar.first()["coherent"]:
        return HOLD_SOURCE, "Coverage or details do not fit the records."
    if findings is not None and not findings.where("severity = 'error' AND after > 0").isEmpty():
        return HOLD_VALIDATION, "The new snapshot has findings of severity error."
    if packets is not None and not packets.where("current_fail_closed_status IN ('unmapped', 'exact_crosswalk_review_required')").isEmpty():
        return HOLD_REVIEW, "Values of changed rows wait for a decision."
    return READY, "Nothing holds the snapshot."


def accept(old: DataFrame, new: DataFrame, key: Sequence[str], path: str, plan: Plan | None = None) -> dict[str, DataFrame]:
    """Compares the snapshots and writes all result tables below ``path``: states, changes, cells, rollup, transitions, findings,
    drift, packets, sidecar, gate; those that the plan does not ask for are left out. ``key`` is unique in both snapshots."""
    spark, key, plan = old.sparkSession, list(key), plan or Plan()
    changes = change_set(old, new, key, path)
    out = {"states": spark.read.parquet(f"{path}/states"), "changes": changes}

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
        return out[name]

    found = keep("cells", cells(changes, key, plan.classes))
    keep("rollup", D.rollup_cells(found, key))
    keep("transitions", transition_counts(changes, plan.transitions))
    if plan.rules:
        keep("findings", finding_delta(changes, key, plan))
    if plan.suite:
        keep("drift", drift(changes, key, plan))
    if plan.reviews:
        keep("packets", reduce(DataFrame.unionByName, [packet(changes, old, new, r) for r in plan.reviews]))
    if plan.sidecar is not None:
        keep("sidecar", plan.sidecar)
    status, reason = gate(sorted(old.columns) == sorted(new.columns), out.get("sidecar"), out.get("findings"), out.get("packets"))
    keep("gate", spark.range(1).select(F.lit(status).alias("status"), F.lit(reason).alias("reason")))
    return out
