"""REV operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import review as R
from . import bindings as B
from .registry import query


def f(spark, sf, sql):
    return B.frame(spark, sf, sql)


PRIORITY_XW = ("SELECT o_orderpriority AS raw_value, CASE o_orderpriority WHEN '1-URGENT' THEN 'required' ELSE 'not_required' END AS requirement_status "
               "FROM (SELECT DISTINCT o_orderpriority FROM {orders} WHERE o_orderpriority <> '5-LOW') s")


@query("rev01_review_packet", B.with_ctes("""
, v AS (SELECT o_orderpriority AS raw, COUNT(*) AS n, MIN(o_orderkey) AS k FROM n WHERE o_orderpriority IS NOT NULL GROUP BY 1)
SELECT raw AS raw_or_context, CAST(n AS BIGINT) AS frequency, k AS representative_o_orderkey, (SELECT o_custkey FROM n WHERE o_orderkey = k) AS representative_o_custkey,
 CASE WHEN x.raw_value IS NULL THEN 'unmapped' ELSE 'exact_crosswalk_' || requirement_status END AS current_fail_closed_status,
 CASE WHEN x.raw_value IS NULL THEN 'Needs a human decision; nothing is inferred from the text.' ELSE 'Covered by the reviewed exact crosswalk.' END AS suggested_review_note
FROM v LEFT JOIN x ON raw = x.raw_value WHERE x.raw_value IS NULL OR raw NOT IN (SELECT o_orderpriority FROM o)""", o=B.B4_OLD, n=B.B4_NEW, x=PRIORITY_XW))
def rev01(spark, sf):
    return R.review_packet(f(spark, sf, B.B4_NEW), f(spark, sf, B.B4_OLD), "o_orderpriority", f(spark, sf, PRIORITY_XW), "o_orderkey", ["o_orderkey", "o_custkey"])


CONTEXT = ("university", "faculty_school", "department", "academic_field")
OLD_RECORDS = "SELECT * FROM (" + B.B3 + ") x WHERE o_orderkey % 3 <> 1"
CTX = "SELECT DISTINCT university, faculty_school, department, academic_field FROM (" + B.CTX_XW + ") c"


def filled(alias: str) -> str:
    return ", ".join(f"COALESCE({alias}.{c}, '') AS {c}" for c in CONTEXT)


@query("rev02_context_packet", B.with_ctes(f"""
, g AS (SELECT university, faculty_school, department, academic_field, COUNT(*) AS n, MIN(o_orderkey) AS k FROM (SELECT {filled('b3')}, o_orderkey FROM b3) a GROUP BY ALL),
o AS (SELECT DISTINCT {filled('old')} FROM old), l AS (SELECT raw_value, MIN(mapping_status) AS rs FROM rx GROUP BY raw_value), xx AS (SELECT DISTINCT {filled('cx')}, TRUE AS ex FROM cx),
j AS (SELECT g.*, rs, ex FROM g LEFT JOIN l ON academic_field = raw_value LEFT JOIN xx USING (university, faculty_school, department, academic_field) ANTI JOIN o USING (university, faculty_school, department, academic_field)),
s AS (SELECT *, CASE WHEN rs IS NULL THEN 'unmapped_raw_and_context' WHEN ex THEN 'mapped_exact_context' WHEN rs = 'review_required' THEN 'review_required_no_exact_context' ELSE 'mapped_by_existing_raw_exact' END AS st FROM j)
SELECT university || ' | ' || faculty_school || ' | ' || department || ' | ' || academic_field AS raw_or_context, CAST(n AS BIGINT) AS frequency, 'R' || CAST(k AS VARCHAR) AS representative_record_id,
 st AS current_fail_closed_status, st IN ('unmapped_raw_and_context', 'review_required_no_exact_context') AS needs_review FROM s""", b3=B.B3, old=OLD_RECORDS, rx=B.RAW_XW, cx=CTX))
def rev02(spark, sf):
    return R.context_packet(f(spark, sf, B.B3), f(spark, sf, OLD_RECORDS), CONTEXT, f(spark, sf, B.RAW_XW), f(spark, sf, CTX), "o_orderkey", "record_id")


# decisions that lost one row and gained another order number
CUT_DECISIONS = "SELECT CASE WHEN review_order = 7 THEN 100007 ELSE review_order END AS review_order, raw_value, frequency, representative_record_id FROM (" + B.DECISIONS + ") d WHERE review_order <> 5"


@query("rev03_correspondence", B.with_ctes("""
SELECT COALESCE(p.review_order, d.review_order) AS review_order, unnest(list_filter([CASE WHEN d.review_order IS NULL THEN 'missing_decision' END, CASE WHEN p.review_order IS NULL THEN 'missing_packet_row' END,
 CASE WHEN p.raw_or_context <> d.raw_value THEN 'raw_value' END, CASE WHEN p.frequency <> d.frequency THEN 'frequency' END, CASE WHEN p.representative_record_id <> d.representative_record_id THEN 'representative_record_id' END], lambda x: x IS NOT NULL)) AS issue
FROM p FULL JOIN d ON p.review_order = d.review_order""", p=B.PACKET, d=CUT_DECISIONS))
def rev03(spark, sf):
    return R.check_correspondence(f(spark, sf, B.PACKET), f(spark, sf, CUT_DECISIONS),
                                  {"raw_or_context": "raw_value", "frequency": "frequency", "representative_record_id": "representative_record_id"})


@query("rev03_order", B.with_ctes("""
SELECT CAST(COUNT(*) AS BIGINT) AS rows, MIN(review_order) = 1 AND MAX(review_order) = COUNT(*) AND COUNT(DISTINCT review_order) = COUNT(*) AS contiguous FROM d""", d=CUT_DECISIONS))
def rev03_order(spark, sf):
    return R.order_issues(f(spark, sf, CUT_DECISIONS))


EVENTS = f"SELECT CAST(event_id AS STRING) AS record_id, {B.EVENT_RAW} AS raw FROM {{events}}"


@query("rev04_frequencies", B.with_ctes("""
, c AS (SELECT raw, COUNT(*) AS n FROM e GROUP BY raw), j AS (SELECT d.*, COALESCE(n, 0) AS actual, e.raw AS carried FROM d LEFT JOIN c ON c.raw = raw_value LEFT JOIN e ON record_id = representative_record_id)
SELECT raw_value, CAST(actual AS BIGINT) AS actual, 'frequency' AS issue FROM j WHERE frequency <> actual UNION ALL SELECT raw_value, CAST(actual AS BIGINT), 'representative' FROM j WHERE carried IS DISTINCT FROM raw_value""",
    d=B.DECISIONS, e=EVENTS))
def rev04(spark, sf):
    return R.check_frequencies(f(spark, sf, EVENTS), f(spark, sf, B.DECISIONS), "raw", "record_id")


@query("rev05_check_decisions", B.with_ctes("""
, s AS (SELECT *, approved_numeric_status IN ('safe_simple_overall', 'safe_overall_with_additional_conditions') AS safe FROM d),
c AS (SELECT *, safe AND approved_grade_status = 'required' AND approved_overall_floor_tenths <> '' AND approved_overall_floor <> '' AND approved_additional_conditions IN ('true', 'false') AS complete FROM s)
SELECT raw_value, 'incomplete_safe_decision' AS issue FROM c WHERE safe AND NOT complete
UNION ALL SELECT raw_value, 'floor_text_differs' FROM c WHERE complete AND CAST(CAST(approved_overall_floor AS DECIMAL(3,1)) * 10 AS INT) <> CAST(approved_overall_floor_tenths AS INT)
UNION ALL SELECT raw_value, 'additional_flag_differs' FROM c WHERE complete AND approved_numeric_status <> CASE WHEN approved_additional_conditions = 'true' THEN 'safe_overall_with_additional_conditions' ELSE 'safe_simple_overall' END
UNION ALL SELECT raw_value, 'floor_on_unsafe_decision' FROM c WHERE NOT safe AND (approved_overall_floor_tenths <> '' OR approved_overall_floor <> '')""", d=B.DECISIONS))
def rev05(spark, sf):
    return R.check_decisions(f(spark, sf, B.DECISIONS))


@query("rev06_next_crosswalk", B.with_ctes("""
SELECT '0.2' AS contract_version, raw_value, requirement_status, review_note FROM p UNION ALL SELECT '0.2', raw_value, requirement_status, review_note FROM d""", p=B.PREVIOUS, d=B.FRESH))
def rev06(spark, sf):
    return R.next_crosswalk(f(spark, sf, B.PREVIOUS), f(spark, sf, B.FRESH), "0.2")


@query("rev06_overlap", B.with_ctes("SELECT DISTINCT raw_value FROM d WHERE raw_value IN (SELECT raw_value FROM p)", p=B.PREVIOUS, d=B.DECISIONS))
def rev06_overlap(spark, sf):
    return R.overlap(f(spark, sf, B.PREVIOUS), f(spark, sf, B.DECISIONS))


@query("rev07_decision_to_rule", B.with_ctes("""
SELECT raw_value, CASE approved_numeric_status WHEN 'safe_simple_overall' THEN 'safe_numeric' WHEN 'safe_overall_with_additional_conditions' THEN 'conditional_numeric' WHEN 'no_safe_overall_floor' THEN 'conditional_numeric' ELSE 'do_not_numeric' END AS distinct_tier,
 CASE approved_numeric_status WHEN 'safe_simple_overall' THEN 'simple_overall_minimum' WHEN 'safe_overall_with_additional_conditions' THEN 'other_complex_numeric' WHEN 'no_safe_overall_floor' THEN 'other_complex_numeric'
  WHEN 'non_binding' THEN 'nonbinding_or_historical_numeric' WHEN 'historical' THEN 'nonbinding_or_historical_numeric' WHEN 'non_admission_numeric' THEN 'non_admission_or_inoperative_numeric' WHEN 'ambiguous' THEN 'unresolved' ELSE 'unknown' END AS primary_class,
 CASE approved_numeric_status WHEN 'non_binding' THEN 'nonbinding' WHEN 'historical' THEN 'historical' WHEN 'ambiguous' THEN 'unresolved' WHEN 'unknown' THEN 'unknown' ELSE 'numeric' END AS feature_flags,
 CASE WHEN approved_numeric_status IN ('safe_simple_overall', 'safe_overall_with_additional_conditions', 'no_safe_overall_floor') THEN approved_overall_floor ELSE '' END AS numeric_tokens,
 CASE WHEN approved_numeric_status = 'safe_simple_overall' THEN approved_overall_floor ELSE '' END AS safe_gpa_min, '' AS safe_gpa_max, 'reviewed' AS review_status FROM d""", d=B.DECISIONS))
def rev07(spark, sf):
    return R.decision_to_rule(f(spark, sf, B.DECISIONS))


@query("rev08_decision_memberships", B.with_ctes("""
, g AS (SELECT raw_value, code AS group_code, rank AS gr FROM (SELECT DISTINCT raw_value, unnest(string_split(broad_group_codes, '|')) AS code FROM d) a JOIN bt ON code = group_code),
s AS (SELECT raw_value, code AS subcategory_code, parent_group_code AS group_code, rank AS sr FROM (SELECT DISTINCT raw_value, unnest(string_split(subcategory_codes, '|')) AS code FROM d) a JOIN st ON code = subcategory_code),
m AS (SELECT g.raw_value, g.group_code, subcategory_code, gr, COALESCE(sr, 0) AS sr FROM g LEFT JOIN s ON s.raw_value = g.raw_value AND s.group_code = g.group_code),
c AS (SELECT raw_value, COUNT(*) AS n, COUNT(DISTINCT group_code) AS ng, COUNT(DISTINCT subcategory_code) AS ns FROM m GROUP BY raw_value)
SELECT raw_value, CASE WHEN n = 1 THEN 'single' ELSE 'multi' END AS mapping_status, CASE WHEN ng = 1 THEN 'single' ELSE 'multi' END AS broad_mapping_status,
 CASE WHEN ns = 0 THEN 'not_applicable' WHEN ns = 1 THEN 'single' ELSE 'multi' END AS subcategory_mapping_status, group_code, subcategory_code,
 CAST(ROW_NUMBER() OVER (PARTITION BY raw_value ORDER BY gr, sr) AS BIGINT) AS membership_order FROM m JOIN c USING (raw_value)""", d=B.DECISIONS, bt=B.BROAD, st=B.SUB))
def rev08(spark, sf):
    return R.decision_memberships(f(spark, sf, B.DECISIONS), f(spark, sf, B.BROAD), f(spark, sf, B.SUB))


NEXT = ("SELECT raw_value, requirement_status, review_note FROM (" + B.PREVIOUS + ") a UNION ALL SELECT raw_value, requirement_status, review_note FROM (" + B.FRESH + ") b")


@query("rev09_crosswalk_effect", B.with_ctes("""
, c AS (SELECT COALESCE(p.requirement_status, 'unmapped') AS b, COALESCE(n.requirement_status, 'unmapped') AS a FROM e LEFT JOIN p ON raw = p.raw_value LEFT JOIN n ON raw = n.raw_value)
SELECT status, CAST(SUM(before) AS BIGINT) AS before, CAST(SUM(after) AS BIGINT) AS after FROM (SELECT b AS status, 1 AS before, 0 AS after FROM c UNION ALL SELECT a, 0, 1 FROM c) u GROUP BY status""", e=EVENTS, p=B.PREVIOUS, n=NEXT))
def rev09(spark, sf):
    return R.crosswalk_effect(f(spark, sf, EVENTS), "raw", f(spark, sf, B.PREVIOUS), f(spark, sf, NEXT))


TAMPERED = ("SELECT '0.2' AS contract_version, raw_value, CASE WHEN raw_value LIKE '%1}' THEN 'unknown' ELSE requirement_status END AS requirement_status, CASE WHEN raw_value LIKE '%2}' THEN NULL ELSE review_note END AS review_note "
            "FROM (" + NEXT + ") x WHERE raw_value NOT LIKE '%3}'")


@query("rev10_changed_decisions", B.with_ctes("""
SELECT p.raw_value, '(lost)' AS issue FROM p WHERE raw_value NOT IN (SELECT raw_value FROM n)
UNION ALL SELECT p.raw_value, 'requirement_status' FROM p JOIN n USING (raw_value) WHERE p.requirement_status IS DISTINCT FROM n.requirement_status
UNION ALL SELECT p.raw_value, 'review_note' FROM p JOIN n USING (raw_value) WHERE p.review_note IS DISTINCT FROM n.review_note""", p=B.PREVIOUS, n=TAMPERED.replace("%1}", "%1}}").replace("%2}", "%2}}").replace("%3}", "%3}}")))
def rev10(spark, sf):
    return R.changed_decisions(f(spark, sf, B.PREVIOUS), f(spark, sf, TAMPERED.replace("%1}", "%1}}").replace("%2}", "%2}}").replace("%3}", "%3}}")))
