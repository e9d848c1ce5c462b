"""Ledger maintenance, operations checks and publication of provisional records. The corrections log is in ``corrections``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as K
from ..functions import columns as P
from . import views as V


def upsert(base: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """Replace whole rows by key or append. Updates have unique keys."""
    return base.join(updates.select(*key), list(key), "left_anti").select(*updates.columns).unionByName(updates)


def batch_guard(before: DataFrame, after: DataFrame, key: str, expected_delta: int, expected: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """One row per expectation: row delta, unique ids, and named conditional counts after the change."""
    b = before.agg(F.count("*").alias("nb")).withColumn("_one", F.lit(1))
    keys = after.groupBy(key).agg(F.count("*").alias("n"))
    k = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("na"), F.count_if(F.col("n") > 1).alias("dup")).withColumn("_one", F.lit(1))
    c = after.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"_c{i}") for i, (cond, _) in enumerate(expected.values())],
                  F.lit(1).alias("_one"))
    one = b.join(k, "_one").join(c, "_one")
    lines = [F.struct(F.lit("row_delta").alias("check"), (F.col("na") - F.col("nb")).alias("actual"),
                      F.lit(expected_delta).cast("bigint").alias("expected")),
             F.struct(F.lit("repeated_ids").alias("check"), F.col("dup").alias("actual"), F.lit(0).cast("bigint").alias("expected"))]
    lines += [F.struct(F.lit(n).alias("check"), F.col(f"_c{i}").alias("actual"), F.lit(want).cast("bigint").alias("expected"))
              for i, (n, (_, want)) in enumerate(expected.items())]
    return one.select(F.explode(F.array(*lines)).alias("x")).select("x.*").withColumn("ok", F.col("actual") == F.col("expected"))


def _issues(df: DataFrame, id_: Column | str, checks: Sequence[tuple[str, str | None, Column]]) -> DataFrame:
    found = F.array_compact(F.array(*[
        F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(n).alias("issue"), F.lit(f).cast("string").alias("field")))
        for n, f, c in checks]))
    return df.select(P.col(id_).cast("string").alias("id"), F.explode(found).alias("x")).select("id", "x.*")


def _bad_date(c: str) -> Column:
    return ~P.is_blank(c) & P.iso_date(c).isNull()


def _outside(c: str, domain: Sequence[str]) -> Column:
    return ~P.text(c).isin(list(domain))


def queue_checks() -> list[tuple[str, str | None, Column]]:
    pub, act = P.text("publication_status"), P.text("action_status")
    start, end = P.iso_date("release_expected_from"), P.iso_date("release_expected_to")
    published, scheduled, waiting = K.PUBLICATION_STATUSES[:2], K.PUBLICATION_STATUSES[3], K.ACTION_STATUSES[:2]
    return [
        ("blank_id", "queue_id", P.is_blank("queue_id")),
        ("university_missing", "university", P.is_blank("university")),
        ("invalid_publication_status", "publication_status", _outside("publication_status", K.PUBLICATION_STATUSES)),
        ("invalid_action_status", "action_status", _outside("action_status", K.ACTION_STATUSES)),
        *[("invalid_date", c, _bad_date(c)) for c in K.QUEUE_DATES],
        ("from_after_to", "release_expected_from", start > end),
        ("scheduled_without_text", "release_expected_text", (pub == scheduled) & P.is_blank("release_expected_text")),
        ("update_needed_but_unpublished", "action_status", (act == K.ACTION_STATUSES[2]) & ~pub.isin(list(published))),
        ("waiting_without_next_check", "next_check_on", act.isin(list(waiting)) & P.is_blank("next_check_on")),
    ]


def queue_issues(queue: DataFrame) -> DataFrame:
    """Row rules of the update queue plus ids used more than once."""
    again = queue.where(~P.is_blank("queue_id")).groupBy("queue_id").agg(F.count("*").alias("n")).where("n > 1")
    return _issues(queue, "queue_id", queue_checks()).unionByName(
        again.select(F.col("queue_id").cast("string").alias("id"), F.lit("repeated_id").alias("issue"), F.lit("queue_id").alias("field")))


def ledger_checks() -> list[tuple[str, str | None, Column]]:
    digits = r"\A[0-9]+\z"
    return [
        ("invalid_audit_status", "reaudit_status", _outside("reaudit_status", K.AUDIT_STATUSES)),
        *[("invalid_check_status", c, _outside(c, K.CHECK_STATUSES)) for c in K.LEDGER_CHECKS],
        ("invalid_date", "last_audited_on", _bad_date("last_audited_on")),
        *[("invalid_count", c, ~P.is_blank(c) & ~F.col(c).rlike(digits)) for c in K.LEDGER_COUNTS],
    ]


def ledger_issues(ledger: DataFrame, key: Sequence[str] = ("institution_type", "university")) -> DataFrame:
    """Row rules of the audit ledger plus one finding per later use of a key."""
    name = F.concat_ws(":", *[P.text(k) for k in key])
    again = ledger.groupBy(name.alias("id")).agg(F.count("*").alias("n")).where("n > 1")
    return _issues(ledger, name, ledger_checks()).unionByName(
        again.select("id", F.explode(F.array_repeat(F.lit("repeated_key"), (F.col("n") - 1).cast("int"))).alias("issue"),
                     F.lit(None).cast("string").alias("field")))


def reconcile(queue: DataFrame, ledger: DataFrame, key: Sequence[str], status: str = "action_status",
              done: str = K.ACTION_STATUSES[4], count: str = "update_queue_open_count") -> DataFrame:
    """Open queue entries against the ledger's count, both directions."""
    open_ = queue.where(P.text(status) != done).groupBy(*key).agg(F.count("*").alias("actual"))
    # a repeated ledger key is reported by ledger_issues; here its largest count stands for it
    led = ledger.groupBy(*key).agg(F.max(F.coalesce(F.col(count).cast("string").try_cast("bigint"), F.lit(0))).alias("ledger"))
    j = open_.join(led, list(key), "full_outer")
    issue = (F.when(F.col("ledger").isNull(), "missing_in_ledger")
             .when(F.coalesce("actual", F.lit(0)) != F.col("ledger"), "count_mismatch"))
    return j.select(*key, F.coalesce("ledger", F.lit(0)).alias("ledger"), F.coalesce("actual", F.lit(0)).alias("actual"),
                    issue.alias("issue")).where("issue is not null")


def registry_issues(registry: DataFrame, queue: DataFrame, urls: Sequence[str] = ("official_source_url", "previous_year_source_url")) -> DataFrame:
    """Repeated ids, URLs that are not https with a host, and queue references that are missing, foreign or done."""
    def unsafe(c: str) -> Column:
        u = F.col(c)
        # parse_url fails on text that is no URL at all under ANSI, so the try form is used
        scheme, host = F.try_parse_url(u, F.lit("PROTOCOL")), F.try_parse_url(u, F.lit("HOST"))
        return u.isNotNull() & ~(F.coalesce(F.lower(scheme) == "https", F.lit(False)) & (F.length(F.coalesce(host, F.lit(""))) > 0))
    # a repeated queue id must not repeat findings; it is a finding of its own in the queue's rules
    q = (queue.groupBy("queue_id").agg(F.min(F.struct("university", "action_status")).alias("_q"))
         .select(F.col("queue_id").alias("related_update_queue_id"), F.col("_q.university").alias("_qu"),
                 F.col("_q.action_status").alias("_qa"), F.lit(True).alias("_found")))
    j = registry.join(q, "related_update_queue_id", "left")
    linked = F.col("related_update_queue_id").isNotNull()
    bad = F.col("_found").isNull() | ~F.col("_qu").eqNullSafe(F.col("university")) | F.col("_qa").eqNullSafe(K.ACTION_STATUSES[4])
    rows = _issues(j, "provisional_id", [
        *[("unsafe_url", c, unsafe(c)) for c in urls], ("invalid_queue_reference", "related_update_queue_id", linked & bad)])
    again = registry.groupBy("provisional_id").agg(F.count("*").alias("n")).where("n > 1")
    return rows.unionByName(again.select(F.col("provisional_id").cast("string").alias("id"), F.lit("repeated_id").alias("issue"),
                                         F.lit("provisional_id").alias("field")))


def publish(registry: DataFrame, confirmed: DataFrame, eq: Sequence[str] = ("university", "selection_name"),
            optional: str = "faculty_school") -> DataFrame:
    """Every provisional record with its state: published, or suppressed by a confirmed record."""
    kept = V.suppress(registry, confirmed, eq, optional).withColumn("state", F.lit("published"))
    gone = V.suppress(registry, confirmed, eq, optional, kept=False).withColumn("state", F.lit("suppressed"))
    return kept.unionByName(gone)
