"""OPS operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as K
from ..operators import corrections as C
from ..operators import ledger as L
from ..operators import views as V
from ..sources import readers as R
from ..sources import sinks as S
from . import bindings as B
from .registry import query

COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "price_cents", "o_orderpriority", "o_orderdate", "fallback_previous_year", "information_year")


def f(spark, sf, sql):
    return B.frame(spark, sf, sql)


@query("ops01_upsert", B.with_ctes(f"SELECT {', '.join(COLUMNS)} FROM n UNION ALL SELECT {', '.join(COLUMNS)} FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)", o=B.B4_OLD, n=B.B4_NEW))
def ops01(spark, sf):
    return L.upsert(f(spark, sf, B.B4_OLD), f(spark, sf, B.B4_NEW), ["o_orderkey"])


RECORDS = "SELECT CAST(o_orderkey AS STRING) AS record_id, o_orderstatus AS slot_type, o_orderpriority AS selection_name FROM {orders}"
# one correction per customer with a key divisible by 10: retire its orders with status F, replace each by two units
RETIRED = "SELECT o_custkey, CAST(o_orderkey AS STRING) AS record_id FROM {orders} WHERE o_custkey % 10 = 0 AND o_orderstatus = 'F'"


@query("ops02_corrections", B.with_ctes("""
SELECT record_id, slot_type, selection_name FROM r WHERE record_id NOT IN (SELECT record_id FROM x)
UNION ALL SELECT record_id || '-A', 'new', NULL FROM x UNION ALL SELECT record_id || '-B', 'new', 'second' FROM x""", r=RECORDS, x=RETIRED))
def ops02(spark, sf):
    unit = lambda suffix, *more: F.create_map(F.lit("record_id"), F.concat("record_id", F.lit(suffix)), F.lit("slot_type"), F.lit("new"), *more)
    # a correction names a handful of records, so one log line per retired record keeps every line small
    log = f(spark, sf, RETIRED).select(
        F.array("record_id").alias("obsolete_record_ids"),
        F.array(unit("-A"), unit("-B", F.lit("selection_name"), F.lit("second"))).alias("replacement_units"))
    return C.apply_corrections(f(spark, sf, RECORDS), log)


# A log over the same orders, one entry a line: every 5th order is replaced by two units; of these every third has its first
# unit replaced again and of those every second once more; some entries wait; some are written twice, with other units the
# second time; every 4th of the second units comes back under the record's own id, and some of those are retired for good
def step(seq: int, entry: str, gone: str, unit: str, more: str, name: str, having: str, status: str = "'applied'") -> str:
    return (f"SELECT o_orderkey * 16 + {seq} AS seq, {entry} || CAST(o_orderkey AS STRING) AS correction_id, {status} AS status, {gone} AS obsolete, "
            f"{unit} AS unit, {more} AS more, {name} AS name FROM {{orders}} WHERE o_orderkey % 5 = 0 AND {having}")


def id_(prefix: str, suffix: str = "") -> str:
    return f"'{prefix}' || CAST(o_orderkey AS STRING)" + (f" || '{suffix}'" if suffix else "")


NO_ID = "CAST(NULL AS STRING)"
LOG = " UNION ALL ".join((
    step(1, "'C'", id_(""), id_("U", "-1"), id_("V", "-1"), "'first'", "TRUE"),
    step(2, "'D'", id_("U", "-1"), id_("U", "-2"), NO_ID, "'second'", "o_orderkey % 3 = 0", "CASE WHEN o_orderkey % 7 = 0 THEN 'waiting' ELSE 'applied_partial_pending_detail' END"),
    step(3, "'E'", id_("U", "-2"), id_("U", "-3"), id_("W", "-3"), "'third'", "o_orderkey % 6 = 0"),
    step(4, "'F'", id_("W", "-3"), NO_ID, NO_ID, "'gone'", "o_orderkey % 18 = 0"),
    step(5, "'G'", id_("V", "-1"), id_(""), NO_ID, "'again'", "o_orderkey % 4 = 0"),
    step(6, "'H'", id_(""), NO_ID, NO_ID, "'for good'", "o_orderkey % 8 = 0"),
    # the first entry once more: it keeps its place, its second unit is another one
    step(7, "'C'", id_(""), id_("U", "-1"), id_("X", "-1"), "'corrected'", "o_orderkey % 9 = 0"),
))
LOG_CTES = """
, c AS (SELECT correction_id, MIN(seq) AS seq, arg_max(status, seq) AS status, arg_max(obsolete, seq) AS obsolete, arg_max(unit, seq) AS unit, arg_max(COALESCE(more, ''), seq) AS more, arg_max(name, seq) AS name FROM g GROUP BY correction_id)
, k AS (SELECT * FROM c WHERE status LIKE 'applied%')
, ev AS (SELECT obsolete AS record_id, seq, 0 AS adds, NULL AS name, correction_id FROM k UNION ALL SELECT unit, seq, 1, name, correction_id FROM k WHERE unit IS NOT NULL UNION ALL SELECT more, seq, 1, name || ' too', correction_id FROM k WHERE more <> '')
, fin AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY record_id ORDER BY seq DESC, adds DESC) AS rn FROM ev) q WHERE rn = 1)
"""
APPLIED_SQL = """SELECT record_id, slot_type, selection_name FROM r WHERE record_id NOT IN (SELECT record_id FROM fin) UNION ALL SELECT record_id, 'new', name FROM fin WHERE adds = 1"""


def corrections_log(spark, sf):
    """The log in the shape that ``read_corrections`` gives."""
    unit = lambda c, name: F.when(F.col(c).isNotNull(), F.create_map(F.lit("record_id"), F.col(c), F.lit("slot_type"), F.lit("new"), F.lit("selection_name"), name))
    units = F.array_compact(F.array(unit("unit", F.col("name")), unit("more", F.concat("name", F.lit(" too")))))
    return f(spark, sf, LOG).select("seq", "correction_id", "status", F.array_compact(F.array("obsolete")).alias("obsolete_record_ids"), units.alias("replacement_units"))


@query("ops02_chains", B.with_ctes(LOG_CTES + APPLIED_SQL, r=RECORDS, g=LOG))
def ops02_chains(spark, sf):
    return C.apply_corrections(f(spark, sf, RECORDS), corrections_log(spark, sf))


@query("ops02_rerun", B.with_ctes(LOG_CTES + APPLIED_SQL, r=RECORDS, g=LOG))
def ops02_rerun(spark, sf):
    log = corrections_log(spark, sf)
    return C.apply_corrections(C.apply_corrections(f(spark, sf, RECORDS), log), log)


# every retirement with the ids that stand for it in the end, one link at a time
@query("ops02_lineage", "WITH RECURSIVE " + B.with_ctes(LOG_CTES + """
, lk AS (SELECT a.record_id, a.seq, b.record_id AS to_id, (SELECT MIN(n.seq) FROM ev n WHERE n.record_id = b.record_id AND n.adds = 0 AND n.seq > b.seq) AS until
  FROM ev a LEFT JOIN ev b ON a.correction_id = b.correction_id AND b.adds = 1 WHERE a.adds = 0)
, ch AS (SELECT record_id, seq, to_id, until, CASE WHEN to_id IS NULL THEN 0 ELSE 1 END AS links FROM lk
  UNION ALL SELECT ch.record_id, ch.seq, lk.to_id, lk.until, ch.links + CASE WHEN lk.to_id IS NULL THEN 0 ELSE 1 END FROM ch JOIN lk ON ch.to_id = lk.record_id AND ch.until = lk.seq)
, en AS (SELECT record_id, seq, to_id, MIN(links) AS links FROM ch WHERE until IS NULL GROUP BY ALL)
SELECT record_id, seq AS retired_at, to_id AS current_id, links FROM en WHERE to_id IS NOT NULL
 OR NOT EXISTS (SELECT 1 FROM en o WHERE o.record_id = en.record_id AND o.seq = en.seq AND o.to_id IS NOT NULL)""", g=LOG).removeprefix("WITH "))
def ops02_lineage(spark, sf):
    return C.lineage(corrections_log(spark, sf))


@query("ops02_log_issues", B.with_ctes(LOG_CTES + """
, st AS (SELECT *, LAG(adds) OVER (PARTITION BY record_id ORDER BY seq, adds) AS was FROM ev)
, al AS (SELECT *, COALESCE(was = 1, record_id IN (SELECT record_id FROM r)) AS there FROM st)
SELECT correction_id, record_id, CASE WHEN adds = 0 THEN 'retired_but_absent' ELSE 'added_over_living' END AS issue FROM al WHERE (adds = 0 AND NOT there) OR (adds = 1 AND there)""", r=RECORDS, g=LOG))
def ops02_log_issues(spark, sf):
    return C.log_issues(f(spark, sf, RECORDS), corrections_log(spark, sf))


@query("ops03_batch_guard", B.with_ctes("""
, a AS (SELECT (SELECT COUNT(*) FROM n) - (SELECT COUNT(*) FROM o) AS delta, (SELECT COUNT(*) FROM (SELECT o_orderkey FROM n GROUP BY 1 HAVING COUNT(*) > 1) q) AS dup, (SELECT COUNT(*) FROM n WHERE o_orderstatus = 'X') AS x, (SELECT COUNT(*) FROM n WHERE fallback_previous_year) AS fb)
SELECT 'row_delta' AS "check", CAST(delta AS BIGINT) AS actual, CAST(0 AS BIGINT) AS expected, delta = 0 AS ok FROM a UNION ALL SELECT 'repeated_ids', CAST(dup AS BIGINT), CAST(0 AS BIGINT), dup = 0 FROM a
UNION ALL SELECT 'marked', CAST(x AS BIGINT), CAST(3 AS BIGINT), x = 3 FROM a UNION ALL SELECT 'taken_over', CAST(fb AS BIGINT), CAST(7 AS BIGINT), fb = 7 FROM a""", o=B.B4_OLD, n=B.B4_NEW))
def ops03(spark, sf):
    return L.batch_guard(f(spark, sf, B.B4_OLD), f(spark, sf, B.B4_NEW), "o_orderkey", 0,
                         {"marked": (F.col("o_orderstatus") == "X", 3), "taken_over": (F.col("fallback_previous_year"), 7)})


def bad_date(c: str) -> str:
    return f"({c} <> '' AND (NOT regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') OR TRY_CAST({c} AS DATE) IS NULL))"


def words(v) -> str:
    return ", ".join(f"'{x}'" for x in v)


def checks(src: str, id_: str, rules: list[tuple[str, str | None, str]]) -> str:
    return " UNION ALL ".join(f"SELECT {id_} AS id, '{n}' AS issue, {'CAST(NULL AS VARCHAR)' if c is None else repr(c)} AS field FROM {src} WHERE {w}" for n, c, w in rules)


QUEUE_SQL = (checks("q", "queue_id", [
    ("blank_id", "queue_id", "queue_id = ''"), ("university_missing", "university", "university = ''"),
    ("invalid_publication_status", "publication_status", f"publication_status NOT IN ({words(K.PUBLICATION_STATUSES)})"),
    ("invalid_action_status", "action_status", f"action_status NOT IN ({words(K.ACTION_STATUSES)})"),
    *[("invalid_date", c, bad_date(c)) for c in K.QUEUE_DATES],
    ("from_after_to", "release_expected_from", "TRY_CAST(release_expected_from AS DATE) > TRY_CAST(release_expected_to AS DATE)"),
    ("scheduled_without_text", "release_expected_text", "publication_status = '公開予定' AND release_expected_text = ''"),
    ("update_needed_but_unpublished", "action_status", "action_status = '更新必要' AND publication_status NOT IN ('公開済', '一部公開')"),
    ("waiting_without_next_check", "next_check_on", "action_status IN ('待機', '確認時期到来') AND next_check_on = ''")])
    + " UNION ALL SELECT queue_id, 'repeated_id', 'queue_id' FROM q WHERE queue_id <> '' GROUP BY queue_id HAVING COUNT(*) > 1")


@query("ops04_queue_issues", B.with_ctes(QUEUE_SQL, q=B.QUEUE))
def ops04(spark, sf):
    return L.queue_issues(f(spark, sf, B.QUEUE))


@query("ops04_queue_file", B.with_ctes(QUEUE_SQL, q=B.QUEUE))
def ops04_file(spark, sf):
    """The same from the queue as a file of its contract."""
    path = B.scratch(spark)
    S.write_canonical(f(spark, sf, B.QUEUE), path, K.TableContract("update_queue", K.QUEUE_COLUMNS))
    return L.queue_issues(R.read_queue(spark, path))


LEDGER_ID = "institution_type || ':' || university"


LEDGER_SQL = (checks("l", LEDGER_ID, [
    ("invalid_audit_status", "reaudit_status", f"reaudit_status NOT IN ({words(K.AUDIT_STATUSES)})"),
    *[("invalid_check_status", c, f"{c} NOT IN ({words(K.CHECK_STATUSES)})") for c in K.LEDGER_CHECKS],
    ("invalid_date", "last_audited_on", bad_date("last_audited_on")),
    *[("invalid_count", c, f"{c} <> '' AND NOT regexp_matches({c}, '^[0-9]+$')") for c in K.LEDGER_COUNTS]])
    + f" UNION ALL SELECT id, 'repeated_key', NULL FROM (SELECT {LEDGER_ID} AS id, ROW_NUMBER() OVER (PARTITION BY {LEDGER_ID}) AS rn FROM l) r WHERE rn > 1")


@query("ops05_ledger_issues", B.with_ctes(LEDGER_SQL, l=B.LEDGER_TWICE))
def ops05(spark, sf):
    return L.ledger_issues(f(spark, sf, B.LEDGER_TWICE))


@query("ops05_ledger_file", B.with_ctes(LEDGER_SQL, l=B.LEDGER_TWICE))
def ops05_file(spark, sf):
    """The same from the ledger as a file of its contract."""
    path = B.scratch(spark)
    S.write_canonical(f(spark, sf, B.LEDGER_TWICE), path, K.TableContract("audit_ledger", K.LEDGER_COLUMNS))
    return L.ledger_issues(R.read_ledger(spark, path))


@query("ops06_reconcile", B.with_ctes("""
, a AS (SELECT institution_type, university, COUNT(*) AS n FROM q WHERE action_status <> '完了' GROUP BY ALL)
SELECT institution_type, university, COALESCE(CAST(update_queue_open_count AS BIGINT), 0) AS ledger, CAST(COALESCE(n, 0) AS BIGINT) AS actual, CASE WHEN update_queue_open_count IS NULL THEN 'missing_in_ledger' ELSE 'count_mismatch' END AS issue
FROM a FULL JOIN l USING (institution_type, university) WHERE update_queue_open_count IS NULL OR CAST(update_queue_open_count AS BIGINT) <> COALESCE(n, 0)""", q=B.QUEUE, l=B.LEDGER))
def ops06(spark, sf):
    return L.reconcile(f(spark, sf, B.QUEUE), f(spark, sf, B.LEDGER), ["institution_type", "university"])


REGISTRY_TWICE = B.PROVISIONAL + " UNION ALL " + B.PROVISIONAL + " WHERE s_suppkey % 13 = 0"


@query("ops07_registry_issues", B.with_ctes("""
SELECT provisional_id AS id, 'unsafe_url' AS issue, 'official_source_url' AS field FROM p WHERE official_source_url IS NOT NULL AND NOT regexp_matches(official_source_url, '^https://[^/]+')
UNION ALL SELECT provisional_id, 'invalid_queue_reference', 'related_update_queue_id' FROM p LEFT JOIN q ON queue_id = related_update_queue_id
 WHERE related_update_queue_id IS NOT NULL AND (queue_id IS NULL OR q.university <> p.university OR action_status = '完了')
UNION ALL SELECT provisional_id, 'repeated_id', 'provisional_id' FROM p GROUP BY provisional_id HAVING COUNT(*) > 1""", p=REGISTRY_TWICE, q=B.REGISTRY_QUEUE))
def ops07(spark, sf):
    return L.registry_issues(f(spark, sf, REGISTRY_TWICE), f(spark, sf, B.REGISTRY_QUEUE))


PAGES = "SELECT CAST(page_id AS STRING) AS provisional_id, url AS official_source_url, CAST(NULL AS STRING) AS related_update_queue_id, '' AS university FROM {pages}"


@query("ops07_page_urls", "SELECT CAST(page_id AS VARCHAR) AS id, 'unsafe_url' AS issue, 'official_source_url' AS field FROM pages WHERE NOT regexp_matches(url, '^https://[^/]+')")
def ops07_pages(spark, sf):
    return L.registry_issues(f(spark, sf, PAGES), f(spark, sf, B.REGISTRY_QUEUE), ["official_source_url"])


@query("ops08_publish", B.with_ctes("""
SELECT provisional_id, CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.university = p.university AND c.selection_name = p.selection_name AND (p.faculty_school IS NULL OR c.faculty_school = p.faculty_school)) THEN 'suppressed' ELSE 'published' END AS state FROM p""",
    p=B.PROVISIONAL, c=B.CONFIRMED))
def ops08(spark, sf):
    return L.publish(f(spark, sf, B.PROVISIONAL), f(spark, sf, B.CONFIRMED)).select("provisional_id", "state")


FLAGGED = ("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS returnee_flag, CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS adult_selection_flag FROM {orders}")


@query("ops09_flag_index", B.with_ctes("SELECT o_orderkey, returnee_flag = 'Yes' AS returnee_flag, adult_selection_flag = 'Yes' AS adult_selection_flag FROM x", x=FLAGGED))
def ops09(spark, sf):
    return V.flag_index(f(spark, sf, FLAGGED), ["o_orderkey"], ["returnee_flag", "adult_selection_flag"]).select("o_orderkey", "flags.*")
