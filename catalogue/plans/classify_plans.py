"""CLS and WIN operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import classify as C
from ..operators import rules as V
from . import bindings as B
from .registry import query


def f(spark, sf, sql) -> DataFrame:
    return B.frame(spark, sf, sql)


def listing(array: str, *fields: str) -> Column:
    return F.array_join(F.transform(array, lambda m: F.concat_ws(":", *[m[x].cast("string") for x in fields])), ",")


# ---- crosswalk, taxonomy and rule table checks, on dimensions that grow with the customers and parts --------------------

CUSTOMER_XW = """SELECT c_name AS raw_value, CASE WHEN c_custkey % 23 = 0 THEN 'weird' WHEN c_custkey % 29 = 0 THEN 'review_required' WHEN c_custkey % 19 = 0 THEN 'single'
  WHEN n = 1 THEN 'single' ELSE 'multi' END AS mapping_status,
 CASE WHEN c_custkey % 13 = 0 THEN 'UNKNOWN' WHEN c_custkey % 37 = 0 THEN 'ASIA' ELSE r_name END AS group_code,
 CAST(CASE WHEN c_custkey % 11 = 0 THEN rn + 1 WHEN c_custkey % 17 = 0 THEN n + 1 - rn ELSE rn END AS STRING) AS group_order,
 CASE WHEN c_custkey % 31 = 0 THEN r_name ELSE '' END AS review_note
 FROM (SELECT c_custkey, c_name, r_name, r_regionkey, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY r_regionkey) AS rn, COUNT(*) OVER (PARTITION BY c_custkey) AS n
  FROM {customer} JOIN {region} ON c_custkey % 3 = (3 - r_regionkey % 3) % 3) q"""


@query("cls01_check_crosswalk", B.with_ctes("""
, j AS (SELECT x.*, TRY_CAST(group_order AS INT) AS o, rank AS r FROM x LEFT JOIN t USING (group_code)),
g AS (SELECT raw_value, COUNT(DISTINCT mapping_status) AS st, MIN(mapping_status) AS status, COUNT(DISTINCT review_note) AS notes, MAX(review_note) AS note, COUNT(group_code) AS codes,
  COUNT(DISTINCT group_code) AS dcodes, COUNT(*) FILTER (r IS NULL) AS unknown, MIN(o) AS lo, MAX(o) AS hi, COUNT(DISTINCT o) AS orders FROM j GROUP BY raw_value),
s AS (SELECT raw_value, list(r ORDER BY o, r) AS seq FROM (SELECT DISTINCT raw_value, o, r FROM j) d GROUP BY raw_value),
a AS (SELECT * FROM g JOIN s USING (raw_value))
SELECT raw_value, 'status_not_allowed' AS issue FROM a WHERE status NOT IN ('single', 'multi', 'review_required')
UNION ALL SELECT raw_value, 'several_notes' FROM a WHERE notes <> 1
UNION ALL SELECT raw_value, 'review_without_note' FROM a WHERE status = 'review_required' AND note = ''
UNION ALL SELECT raw_value, 'review_with_codes' FROM a WHERE status = 'review_required' AND codes > 0
UNION ALL SELECT raw_value, 'unknown_code' FROM a WHERE unknown > 0
UNION ALL SELECT raw_value, 'repeated_code' FROM a WHERE codes <> dcodes
UNION ALL SELECT raw_value, 'single_needs_one_code' FROM a WHERE status = 'single' AND codes <> 1
UNION ALL SELECT raw_value, 'multi_needs_two_codes' FROM a WHERE status = 'multi' AND codes < 2
UNION ALL SELECT raw_value, 'order_not_contiguous' FROM a WHERE status IN ('single', 'multi') AND NOT (lo = 1 AND hi = codes AND orders = codes)
UNION ALL SELECT raw_value, 'not_in_taxonomy_order' FROM a WHERE status IN ('single', 'multi') AND unknown = 0 AND seq <> list_sort(seq)""",
    x=CUSTOMER_XW, t=B.BROAD))
def cls01(spark, sf):
    return C.check_crosswalk(f(spark, sf, CUSTOMER_XW), f(spark, sf, B.BROAD), rank="rank")


CUSTOMER_TAX = """SELECT CASE WHEN c_custkey % 50 = 7 THEN 'Customer#twice' || CAST(c_custkey % 3 AS STRING) ELSE c_name END AS code, CASE WHEN c_custkey % 97 = 5 THEN 'NOWHERE' ELSE 'NATION_' || CAST(c_nationkey AS STRING) END AS parent,
 CAST(rn + CASE WHEN c_nationkey % 4 = 0 AND rn > 3 THEN 1 ELSE 0 END AS STRING) AS display_order
 FROM (SELECT c_custkey, c_name, c_nationkey, ROW_NUMBER() OVER (PARTITION BY CASE WHEN c_custkey % 97 = 5 THEN -1 ELSE c_nationkey END ORDER BY c_custkey) AS rn FROM {customer}) q"""


@query("cls02_check_taxonomy", B.with_ctes("""
SELECT 'repeated_code' AS issue, code AS subject FROM t GROUP BY code HAVING COUNT(*) > 1
UNION ALL SELECT 'order_not_contiguous', parent FROM t GROUP BY parent HAVING NOT (MIN(CAST(display_order AS INT)) = 1 AND MAX(CAST(display_order AS INT)) = COUNT(*) AND COUNT(DISTINCT display_order) = COUNT(*))
UNION ALL SELECT 'unknown_parent', code FROM t WHERE parent NOT IN (SELECT n_name FROM nation)""", t=CUSTOMER_TAX))
def cls02(spark, sf):
    return C.check_taxonomy(f(spark, sf, CUSTOMER_TAX), "code", "display_order", "parent", B.table(spark, sf, "nation"), "n_name")


# ---- classification -----------------------------------------------------------------------------------------------------

def english(spark, sf) -> DataFrame:
    return C.classify(f(spark, sf, B.B3), "english_requirement", f(spark, sf, B.ENGLISH))


ENGLISH_SQL = """SELECT record_id, source_dataset, university, english_requirement, CASE WHEN b3.english_requirement IS NULL THEN 'unknown' WHEN x.raw_value IS NULL THEN 'unmapped' ELSE x.requirement_status END AS requirement_status,
 CASE WHEN english_requirement IS NULL THEN 'missing' WHEN x.raw_value IS NULL THEN 'unmapped' ELSE 'exact_crosswalk' END AS parse_status,
 CASE WHEN english_requirement IS NULL THEN 'not_searchable' WHEN x.raw_value IS NULL THEN 'review_required' WHEN x.requirement_status IN ('required', 'not_required') THEN 'safe_exact'
  WHEN x.requirement_status = 'review_required' THEN 'review_required' ELSE 'not_searchable' END AS search_disposition,
 CASE WHEN english_requirement IS NULL THEN '原値がSQL NULL' WHEN x.raw_value IS NULL THEN '監査済みcrosswalkにない新規原値' ELSE NULLIF(x.review_note, '') END AS review_note
 FROM b3 LEFT JOIN e x ON english_requirement = x.raw_value"""


def english_sql(body: str) -> str:
    return f"WITH b3 AS ({B.duck(B.B3)}), e AS ({B.duck(B.ENGLISH)}), c AS ({ENGLISH_SQL}) {body}"


@query("cls03_classify", english_sql("SELECT record_id, requirement_status, parse_status, search_disposition, review_note FROM c"))
def cls03(spark, sf):
    return english(spark, sf).select("record_id", "requirement_status", "parse_status", "search_disposition", "review_note")

# ---- crosswalks that list a value twice: agreeing entries fold, others go to review ---------------------------------------

def twice(xw: str, status: str, changed: str, cols: str) -> str:
    """Every entry of ``xw`` twice, the second time with ``changed`` in place of its ``status``."""
    return f"SELECT {cols} FROM ({xw}) a UNION ALL SELECT {cols.replace(status, changed)} FROM ({xw}) b"


ENGLISH_TWICE = twice(B.ENGLISH, "requirement_status", "CASE WHEN length(raw_value) % 3 = 0 THEN 'required' WHEN length(raw_value) % 3 = 1 THEN 'not_required' ELSE requirement_status END AS requirement_status", "raw_value, requirement_status, review_note")
FOLDED = """SELECT raw_value, CASE WHEN COUNT(DISTINCT requirement_status) > 1 THEN 'review_required' ELSE MIN(requirement_status) END AS requirement_status,
 CASE WHEN COUNT(DISTINCT requirement_status) > 1 THEN 'crosswalk entries of this value differ' ELSE MIN(review_note) END AS review_note FROM e2 GROUP BY raw_value"""


@query("cls03_repeated_entries", B.with_ctes(f", e AS ({FOLDED}), c AS ({ENGLISH_SQL}) SELECT record_id, requirement_status, parse_status, search_disposition, review_note FROM c",
                                             b3=B.B3, e2=ENGLISH_TWICE))
def cls03_repeated(spark, sf):
    df = C.classify(f(spark, sf, B.B3), "english_requirement", f(spark, sf, ENGLISH_TWICE))
    return df.select("record_id", "requirement_status", "parse_status", "search_disposition", "review_note")



def grade(spark, sf) -> DataFrame:
    return C.classify_threshold(f(spark, sf, B.B3), "gpa_requirement", f(spark, sf, B.GRADE))


GRADE_SQL = """SELECT record_id, CASE WHEN gpa_requirement IS NULL THEN 'unknown' ELSE COALESCE(x.grade_requirement_status, 'unmapped') END AS grade_requirement_status,
 x.overall_gpa_min_tenths, x.overall_gpa_min_inclusive, CASE WHEN gpa_requirement IS NULL THEN 'unknown' ELSE COALESCE(x.overall_gpa_status, 'unmapped') END AS overall_gpa_status,
 x.additional_grade_conditions, CASE WHEN gpa_requirement IS NULL THEN 'missing' WHEN x.raw_value IS NULL THEN 'unmapped' ELSE 'exact_crosswalk' END AS grade_parse_status
 FROM b3 LEFT JOIN gx x ON gpa_requirement = x.raw_value"""


@query("cls04_threshold", B.with_ctes(GRADE_SQL, b3=B.B3, gx=B.GRADE))
def cls04(spark, sf):
    return grade(spark, sf).select("record_id", "grade_requirement_status", "overall_gpa_min_tenths", "overall_gpa_min_inclusive", "overall_gpa_status",
                                   "additional_grade_conditions", "grade_parse_status")


RULE_COLUMNS = ("numeric_safety_tier", "gpa_min_tenths", "gpa_min_inclusive", "gpa_scale", "metric_scope", "gpa_condition_type", "parse_status", "search_disposition",
                "source_value_status", "has_subject_condition", "has_and_condition", "has_or_condition", "has_branch_condition")
HIST = ("(fallback_previous_year OR COALESCE(list_contains(string_split(feature_flags, ';'), 'historical'), FALSE) OR COALESCE(admission_year <> information_year, FALSE))")
RULE_SQL = f"""SELECT k.*,
 CASE c WHEN 'safe' THEN 'safe_numeric' WHEN 'conditional' THEN 'conditional_numeric' ELSE 'do_not_numeric' END AS numeric_safety_tier,
 CASE WHEN c = 'safe' THEN CAST(CAST(safe_gpa_min AS DECIMAL(3,1)) * 10 AS INT) END AS gpa_min_tenths, CASE WHEN c = 'safe' THEN TRUE END AS gpa_min_inclusive,
 CASE WHEN c IN ('safe', 'conditional') THEN 'japanese_5_point' ELSE 'unknown' END AS gpa_scale,
 CASE WHEN c = 'missing' THEN 'none' WHEN c IN ('unlisted', 'undated') THEN 'unknown' WHEN c = 'safe' THEN 'overall' WHEN raw_value IS NULL THEN 'unknown'
  WHEN primary_class = 'subject_specific_condition' THEN 'subject' WHEN primary_class = 'overall_and_subject_compound' OR has_subject_condition THEN 'mixed'
  WHEN primary_class IN ('null', 'explicit_no_numeric_threshold', 'non_numeric_condition') THEN 'none' WHEN distinct_tier = 'conditional_numeric' THEN 'overall' ELSE 'unknown' END AS metric_scope,
 CASE c WHEN 'missing' THEN 'not_applicable' WHEN 'historical' THEN 'historical_reference' WHEN 'unlisted' THEN 'other' WHEN 'undated' THEN 'other' WHEN 'safe' THEN 'simple_overall_minimum'
  WHEN 'conditional' THEN CASE primary_class WHEN 'or_condition' THEN 'alternative_or' WHEN 'overall_and_subject_compound' THEN 'compound_and' WHEN 'and_condition' THEN 'compound_and'
   WHEN 'subject_specific_condition' THEN 'subject_specific' WHEN 'branch_condition' THEN 'branching' ELSE 'other' END
  ELSE CASE primary_class WHEN 'unknown' THEN 'unknown' WHEN 'explicit_no_numeric_threshold' THEN 'no_numeric_threshold' WHEN 'non_numeric_condition' THEN 'qualitative'
   WHEN 'non_admission_or_inoperative_numeric' THEN 'non_admission_numeric' WHEN 'nonbinding_or_historical_numeric' THEN 'qualitative' ELSE 'other' END END AS gpa_condition_type,
 CASE c WHEN 'missing' THEN 'not_applicable' WHEN 'historical' THEN 'historical_reference' WHEN 'unlisted' THEN 'unparsed' WHEN 'undated' THEN 'unparsed' WHEN 'safe' THEN 'parsed_safe'
  WHEN 'conditional' THEN 'conditional_review' ELSE CASE WHEN primary_class = 'unknown' THEN 'unknown' WHEN primary_class IN ('unresolved', 'something_else') THEN 'unparsed' ELSE 'not_numeric' END END AS parse_status,
 CASE c WHEN 'missing' THEN 'not_searchable' WHEN 'historical' THEN 'not_searchable' WHEN 'safe' THEN 'safe_numeric' WHEN 'unlisted' THEN 'review_required' WHEN 'undated' THEN 'review_required'
  WHEN 'conditional' THEN 'review_required' ELSE CASE WHEN primary_class IN ('unresolved', 'something_else') THEN 'review_required' ELSE 'not_searchable' END END AS search_disposition,
 CASE WHEN c = 'historical' OR (c = 'missing' AND {HIST}) THEN 'previous_year_reference' ELSE 'current' END AS source_value_status
 FROM (SELECT b3.*, x.*, {", ".join(f"COALESCE(list_contains(string_split(feature_flags, ';'), '{n}'), FALSE) AS has_{n}_condition" for n in ("subject", "and", "or", "branch"))},
  CASE WHEN gpa_requirement IS NULL THEN 'missing' WHEN {HIST} THEN 'historical' WHEN raw_value IS NULL THEN 'unlisted'
   WHEN distinct_tier = 'safe_numeric' THEN CASE WHEN admission_year = information_year THEN 'safe' ELSE 'undated' END
   WHEN distinct_tier = 'conditional_numeric' THEN 'conditional' ELSE 'other' END AS c FROM b3 LEFT JOIN rl x ON gpa_requirement = raw_value) k"""


def rule_layer(spark, sf) -> DataFrame:
    return C.classify_rule(f(spark, sf, B.B3), "gpa_requirement", f(spark, sf, B.RULES))


@query("cls05_rule", B.with_ctes(f"SELECT record_id, {', '.join(RULE_COLUMNS)} FROM ({RULE_SQL}) z", b3=B.B3, rl=B.RULES))
def cls05(spark, sf):
    return rule_layer(spark, sf).select("record_id", *RULE_COLUMNS)


BROKEN_RULES = """SELECT CASE WHEN p_partkey % 40 = 3 THEN 'G1' ELSE 'G' || CAST(p_partkey AS STRING) END AS raw_value,
 CASE p_partkey % 4 WHEN 0 THEN 'safe_numeric' WHEN 1 THEN 'conditional_numeric' WHEN 2 THEN 'do_not_numeric' ELSE CASE WHEN p_partkey % 7 = 0 THEN 'other' ELSE 'do_not_numeric' END END AS distinct_tier,
 CASE WHEN p_partkey % 4 = 0 AND p_partkey % 12 <> 0 THEN 'simple_overall_minimum' ELSE 'other_complex_numeric' END AS primary_class,
 CASE p_partkey % 5 WHEN 0 THEN 'numeric' WHEN 1 THEN 'numeric;subject' WHEN 2 THEN '' ELSE 'scale' END AS feature_flags,
 CASE WHEN p_partkey % 4 = 0 THEN CASE WHEN p_partkey % 16 = 0 THEN '7.5' ELSE '3.5' END WHEN p_partkey % 9 = 0 THEN '4.0' ELSE '' END AS safe_gpa_min,
 CASE WHEN p_partkey % 28 = 0 THEN '5.0' ELSE '' END AS safe_gpa_max, CASE WHEN p_partkey % 11 = 0 THEN 'draft' ELSE 'reviewed' END AS review_status FROM {part}"""


@query("cls06_check_rules", B.with_ctes("""
SELECT raw_value, 'tier_not_allowed' AS issue FROM r WHERE distinct_tier = 'other'
UNION ALL SELECT raw_value, 'not_reviewed' FROM r WHERE review_status <> 'reviewed'
UNION ALL SELECT raw_value, 'safe_class' FROM r WHERE distinct_tier = 'safe_numeric' AND primary_class <> 'simple_overall_minimum'
UNION ALL SELECT raw_value, 'safe_bounds' FROM r WHERE distinct_tier = 'safe_numeric' AND (safe_gpa_min NOT IN ('3.5', '4.0') OR safe_gpa_max <> '')
UNION ALL SELECT raw_value, 'safe_with_unsafe_flag' FROM r WHERE distinct_tier = 'safe_numeric' AND feature_flags LIKE '%subject%'
UNION ALL SELECT raw_value, 'unsafe_with_bounds' FROM r WHERE distinct_tier <> 'safe_numeric' AND (safe_gpa_min <> '' OR safe_gpa_max <> '')
UNION ALL SELECT raw_value, 'repeated_raw_value' FROM r GROUP BY raw_value HAVING COUNT(*) > 1
UNION ALL SELECT '', 'null_class_missing' FROM r HAVING COUNT(*) FILTER (raw_value = '') = 0""", r=BROKEN_RULES))
def cls06(spark, sf):
    return C.check_rules(f(spark, sf, BROKEN_RULES))


def multi(spark, sf) -> DataFrame:
    return C.classify_multi(f(spark, sf, B.B3), "academic_field", f(spark, sf, B.FIELD_XW))


MULTI_SQL = """SELECT record_id, academic_field, source_dataset, CASE WHEN academic_field IS NULL THEN 'not_applicable' ELSE COALESCE(x.mapping_status, 'unmapped') END AS mapping_status,
 COALESCE(x.codes, '') AS codes FROM b3 LEFT JOIN (SELECT raw_value, MIN(mapping_status) AS mapping_status, string_agg(group_code, ',' ORDER BY CAST(group_order AS INT)) AS codes FROM fx GROUP BY raw_value) x
 ON academic_field = x.raw_value"""


@query("cls07_multi", B.with_ctes(f"SELECT record_id, mapping_status, codes FROM ({MULTI_SQL}) z", b3=B.B3, fx=B.FIELD_XW))
def cls07(spark, sf):
    return multi(spark, sf).select("record_id", "mapping_status", listing("memberships", "code").alias("codes"))


@query("cls07_membership_rows", B.with_ctes("""
SELECT record_id, group_code AS code, CAST(group_order AS INT) AS "order", 'raw_exact' AS basis FROM b3 JOIN fx ON academic_field = raw_value WHERE group_code IS NOT NULL""", b3=B.B3, fx=B.FIELD_XW))
def cls07_rows(spark, sf):
    return C.membership_rows(multi(spark, sf), ["record_id"])


# the same crosswalk, every third of its entries listed a second time without a status
BLANK_XW = B.FIELD_XW + f" UNION ALL SELECT mapping_contract_version, raw_value, CAST(NULL AS STRING), group_code, group_order, review_note FROM ({B.FIELD_XW}) again WHERE raw_value = 'BUILDING'"


@query("cls07_blank_status", B.with_ctes(f"""
SELECT record_id, CASE WHEN academic_field = 'BUILDING' THEN 'review_required' ELSE mapping_status END AS mapping_status, CASE WHEN academic_field = 'BUILDING' THEN '' ELSE codes END AS codes
FROM ({MULTI_SQL}) z""", b3=B.B3, fx=B.FIELD_XW))
def cls07_blank(spark, sf):
    layers = C.classify_multi(f(spark, sf, B.B3), "academic_field", f(spark, sf, BLANK_XW))
    return layers.select("record_id", "mapping_status", listing("memberships", "code").alias("codes"))


def context(spark, sf) -> DataFrame:
    return C.classify_context(f(spark, sf, B.B3), f(spark, sf, B.RAW_XW), f(spark, sf, B.CTX_XW), f(spark, sf, B.BROAD), f(spark, sf, B.SUB))


CONTEXT_CTES = """, lx AS (SELECT raw_value, MIN(mapping_status) AS rs FROM rx GROUP BY raw_value),
cm AS (SELECT source_dataset, university, faculty_school, department, academic_field, MIN(merge_mode) AS mode, MIN(mapping_status) AS cs FROM cx GROUP BY ALL),
k AS (SELECT b3.record_id, b3.o_orderkey, b3.academic_field, lx.rs, lx.raw_value IS NOT NULL AS listed, cm.mode, cm.cs, cm.mode IS NOT NULL AND lx.raw_value IS NOT NULL AS hit,
  b3.source_dataset AS d, b3.university AS u, COALESCE(b3.faculty_school, '') AS fs, COALESCE(b3.department, '') AS dp
  FROM b3 LEFT JOIN lx ON b3.academic_field = lx.raw_value LEFT JOIN cm ON cm.source_dataset = b3.source_dataset AND cm.university = b3.university
   AND cm.faculty_school = COALESCE(b3.faculty_school, '') AND cm.department = COALESCE(b3.department, '') AND cm.academic_field = b3.academic_field),
p AS (SELECT record_id, group_code, subcategory_code, 1 AS r, 0 AS c, CASE WHEN hit AND mode = 'authoritative' THEN 0 ELSE 1 END AS m FROM k JOIN rx ON k.academic_field = rx.raw_value WHERE group_code IS NOT NULL
  UNION ALL SELECT record_id, group_code, subcategory_code, 0, 1, 1 FROM k JOIN cx ON hit AND cx.source_dataset = d AND cx.university = u AND cx.faculty_school = fs AND cx.department = dp AND cx.academic_field = k.academic_field WHERE group_code IS NOT NULL),
gb AS (SELECT record_id, group_code AS code, MAX(r) AS r, MAX(c) AS c FROM p GROUP BY ALL HAVING MAX(m) = 1),
gs AS (SELECT record_id, subcategory_code AS code, MAX(r) AS r, MAX(c) AS c FROM p WHERE subcategory_code IS NOT NULL GROUP BY ALL HAVING MAX(m) = 1),
bb AS (SELECT record_id, COUNT(*) AS nb, string_agg(code || ':' || CASE WHEN r = 1 AND c = 1 THEN 'raw_and_context' WHEN r = 1 THEN 'raw_exact' ELSE 'context_exact' END, ',' ORDER BY rank) AS b FROM gb JOIN bt ON code = group_code GROUP BY record_id),
ss AS (SELECT record_id, COUNT(*) AS ns, string_agg(code || ':' || CASE WHEN r = 1 AND c = 1 THEN 'raw_and_context' WHEN r = 1 THEN 'raw_exact' ELSE 'context_exact' END, ',' ORDER BY rank) AS s FROM gs JOIN st ON code = subcategory_code GROUP BY record_id),
cc AS (SELECT DISTINCT record_id FROM p WHERE c = 1),
z AS (SELECT k.*, COALESCE(nb, 0) AS nb, COALESCE(ns, 0) AS ns, COALESCE(b, '') AS b, COALESCE(s, '') AS s, cc.record_id IS NOT NULL AS effective,
  CASE WHEN academic_field IS NULL THEN 'not_applicable' WHEN NOT listed THEN 'unmapped' WHEN rs = 'review_required' OR (hit AND cs = 'review_required') THEN 'review_required' ELSE 'unmapped' END AS unresolved
  FROM k LEFT JOIN bb USING (record_id) LEFT JOIN ss USING (record_id) LEFT JOIN cc USING (record_id)) """


def context_sql(body: str) -> str:
    return B.with_ctes(CONTEXT_CTES + body, b3=B.B3, rx=B.RAW_XW, cx=B.CTX_XW, bt=B.BROAD, st=B.SUB)


CONTEXT_BODY = """
SELECT record_id, CASE WHEN nb = 0 THEN unresolved WHEN nb = 1 THEN 'single' ELSE 'multi' END AS broad_mapping_status,
 CASE WHEN nb = 0 THEN unresolved WHEN ns = 0 THEN 'none' WHEN ns = 1 THEN 'single' ELSE 'multi' END AS subcategory_mapping_status,
 hit AS context_mapping_consulted, CASE WHEN nb > 0 AND effective THEN mode ELSE 'none' END AS context_mapping_effect,
 CASE WHEN academic_field IS NULL THEN NULL WHEN NOT listed THEN 'No frozen exact raw-value mapping.' WHEN hit THEN 'context note' WHEN academic_field = 'FURNITURE' THEN 'needs review' ELSE 'raw note' END AS context_note,
 b AS broad, s AS sub FROM z"""


@query("cls08_context", context_sql(CONTEXT_BODY))
def cls08(spark, sf):
    return context_columns(context(spark, sf))


def context_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "record_id", "broad_mapping_status", "subcategory_mapping_status", "context_mapping_consulted", "context_mapping_effect", "context_note",
        listing("broad_memberships", "code", "basis").alias("broad"), listing("subcategory_memberships", "code", "basis").alias("sub"))


# one raw value is listed once more, without a status: it goes to review and its own pairs are not used
RAW_BLANK = B.RAW_XW + f" UNION ALL SELECT raw_value, CAST(NULL AS STRING), group_code, subcategory_code, review_note FROM ({B.RAW_XW}) again WHERE raw_value = 'AUTOMOBILE' AND subcategory_code IS NOT NULL"
RAW_REVIEWED = f"SELECT * FROM ({B.RAW_XW}) a WHERE raw_value <> 'AUTOMOBILE' UNION ALL SELECT DISTINCT raw_value, 'review_required', CAST(NULL AS STRING), CAST(NULL AS STRING), review_note FROM ({B.RAW_XW}) b WHERE raw_value = 'AUTOMOBILE'"


@query("cls08_blank_status", B.with_ctes(CONTEXT_CTES + CONTEXT_BODY, b3=B.B3, rx=RAW_REVIEWED, cx=B.CTX_XW, bt=B.BROAD, st=B.SUB))
def cls08_blank(spark, sf):
    return context_columns(C.classify_context(f(spark, sf, B.B3), f(spark, sf, RAW_BLANK), f(spark, sf, B.CTX_XW), f(spark, sf, B.BROAD), f(spark, sf, B.SUB)))


# ---- layer reports ------------------------------------------------------------------------------------------------------

@query("cls09_layer_counts", B.with_ctes(f"""
, m AS ({MULTI_SQL}), h AS (SELECT group_code, COUNT(*) AS n FROM b3 JOIN fx ON academic_field = raw_value WHERE group_code IS NOT NULL GROUP BY group_code)
SELECT 'status' AS kind, mapping_status AS value, CAST(COUNT(*) AS BIGINT) AS rows FROM m GROUP BY mapping_status
UNION ALL SELECT 'raw_values', mapping_status, CAST(COUNT(DISTINCT academic_field) AS BIGINT) FROM m GROUP BY mapping_status
UNION ALL SELECT 'membership', t.group_code, CAST(COALESCE(n, 0) AS BIGINT) FROM t LEFT JOIN h ON t.group_code = h.group_code""", b3=B.B3, fx=B.FIELD_XW, t=B.BROAD))
def cls09(spark, sf):
    return C.layer_counts(multi(spark, sf), "academic_field", "mapping_status", F.transform("memberships", lambda m: m["code"]), f(spark, sf, B.BROAD), "group_code")


LAYER = """SELECT o_orderkey, CASE WHEN o_orderkey % 15 = 0 THEN 'other' WHEN o_orderkey % 16 = 0 THEN NULL ELSE o_orderpriority END AS raw_value,
 CASE WHEN o_orderkey % 25 = 0 THEN 'unmapped' WHEN o_orderkey % 9 = 0 THEN 'single' ELSE 'multi' END AS mapping_status, CASE WHEN o_orderkey % 27 = 0 THEN '0.1' ELSE '0.2' END AS contract_version
 FROM {orders} WHERE o_orderkey % 21 <> 0"""
LAYER_TWICE = LAYER + " UNION ALL " + LAYER + " AND o_orderkey % 33 = 0 UNION ALL SELECT -1 - o_orderkey, 'x', 'unmapped', '0.2' FROM {orders} WHERE o_orderkey % 1000 = 1"


@query("cls10_audit", B.with_ctes("""
, p AS (SELECT o_orderkey, COUNT(*) AS copies, MIN(raw_value) AS raw_value, MIN(mapping_status) AS st, MIN(contract_version) AS v FROM l GROUP BY o_orderkey),
m AS (SELECT o_orderkey, COUNT(*) AS n, MIN(group_order) AS lo, MAX(group_order) AS hi, COUNT(DISTINCT group_order) AS d, list(r_regionkey ORDER BY group_order) AS seq FROM s GROUP BY o_orderkey),
j AS (SELECT r.o_orderkey AS rk, r.o_orderpriority AS raw, p.o_orderkey AS pk, copies, raw_value, st, v, COALESCE(n, 0) AS n, lo, hi, d, seq
  FROM orders r FULL JOIN p ON r.o_orderkey = p.o_orderkey LEFT JOIN m ON m.o_orderkey = COALESCE(r.o_orderkey, p.o_orderkey))
SELECT CAST(COUNT(*) FILTER (pk IS NULL) AS BIGINT) AS records_without_layer, CAST(COUNT(*) FILTER (rk IS NULL) AS BIGINT) AS layer_without_record,
 CAST(COUNT(*) FILTER (copies > 1) AS BIGINT) AS repeated_layer_rows, CAST(COUNT(*) FILTER (pk IS NOT NULL AND rk IS NOT NULL AND raw IS DISTINCT FROM raw_value) AS BIGINT) AS raw_mismatches,
 CAST(COUNT(*) FILTER (v <> '0.2') AS BIGINT) AS other_versions, CAST(COUNT(*) FILTER (st = 'single' AND n <> 1) AS BIGINT) AS single_cardinality,
 CAST(COUNT(*) FILTER (st = 'multi' AND n < 2) AS BIGINT) AS multi_cardinality, CAST(COUNT(*) FILTER (st = 'unmapped' AND n > 0) AS BIGINT) AS members_on_unmapped,
 CAST(COUNT(*) FILTER (n > 0 AND NOT (lo = 1 AND hi = n AND d = n)) AS BIGINT) AS order_gaps, CAST(COUNT(*) FILTER (seq <> list_sort(seq)) AS BIGINT) AS order_not_by_rank,
 CAST(0 AS BIGINT) AS unknown_codes FROM j""", l=LAYER_TWICE, s=B.STORED_REGIONS))
def cls10(spark, sf):
    members = f(spark, sf, B.STORED_REGIONS)
    return C.audit_layer(B.table(spark, sf, "orders"), f(spark, sf, LAYER_TWICE), members, f(spark, sf, B.BROAD), ["o_orderkey"], "o_orderpriority", "0.2",
                         "group_code", "group_order", "rank")


NATION_MEMBERS = "SELECT o_orderkey, n_name AS subcategory_code, CAST(1 AS INT) AS sub_order FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"
REGION_MEMBERS = "SELECT o_orderkey, r_name AS group_code FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey WHERE o_orderkey % 13 <> 0"


@query("cls10_parents", B.with_ctes("SELECT CAST(COUNT(*) AS BIGINT) AS members_without_parent FROM m JOIN t USING (subcategory_code) LEFT JOIN b ON m.o_orderkey = b.o_orderkey AND parent_group_code = group_code WHERE group_code IS NULL",
                                    m=NATION_MEMBERS, b=REGION_MEMBERS, t=B.SUB))
def cls10_parents(spark, sf):
    layer = f(spark, sf, "SELECT o_orderkey, o_orderpriority AS raw_value, 'single' AS mapping_status, '0.2' AS contract_version FROM {orders}")
    audit = C.audit_layer(B.table(spark, sf, "orders"), layer, f(spark, sf, NATION_MEMBERS), f(spark, sf, B.SUB), ["o_orderkey"], "o_orderpriority", "0.2",
                          "subcategory_code", "sub_order", "rank", "parent_group_code", f(spark, sf, REGION_MEMBERS))
    return audit.select("members_without_parent")


def gate_sql(profile: str) -> str:
    ok = "TRUE" if profile == "candidate" else "COUNT(*) FILTER (mapping_status = 'unmapped') = 0"
    return (f"SELECT '{profile}' AS profile, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(*) FILTER (mapping_status = 'unmapped') AS BIGINT) AS unmapped_rows, {ok} AS accepted FROM ({MULTI_SQL}) m")


@query("cls11_gate_profile", B.with_ctes(gate_sql("production") + " UNION ALL " + gate_sql("candidate"), b3=B.B3, fx=B.FIELD_XW))
def cls11(spark, sf):
    counts = C.layer_counts(multi(spark, sf), "academic_field", "mapping_status", F.transform("memberships", lambda m: m["code"]), f(spark, sf, B.BROAD), "group_code")
    return C.gate_profile(counts, "production").unionByName(C.gate_profile(counts, "candidate"))


DRIFT_XW = "SELECT DISTINCT c_name AS raw_value FROM {customer} WHERE c_custkey % 7 <> 0 UNION ALL SELECT s_name FROM {supplier}"
DRIFT_CTX = "SELECT DISTINCT c_name AS university, c_mktsegment AS academic_field FROM {customer}"


@query("cls12_drift", B.with_ctes("""
SELECT 'new' AS kind, university AS value, CAST(COUNT(*) AS BIGINT) AS rows FROM b3 WHERE university NOT IN (SELECT raw_value FROM x) GROUP BY university
UNION ALL SELECT 'stale', raw_value, CAST(0 AS BIGINT) FROM (SELECT DISTINCT raw_value FROM x) q WHERE raw_value NOT IN (SELECT university FROM b3)
UNION ALL SELECT 'unknown_context', university || ' | ' || academic_field, CAST(0 AS BIGINT) FROM c WHERE NOT EXISTS (SELECT 1 FROM b3 WHERE b3.university = c.university AND COALESCE(b3.academic_field, '') = c.academic_field)""",
    b3=B.B3, x=DRIFT_XW, c=DRIFT_CTX))
def cls12(spark, sf):
    return C.crosswalk_drift(f(spark, sf, B.B3), "university", f(spark, sf, DRIFT_XW), ["university", "academic_field"], f(spark, sf, DRIFT_CTX))


@query("cls13_coverage", context_sql("""
SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(*) FILTER (listed AND NOT hit) AS BIGINT) AS raw_only, CAST(COUNT(*) FILTER (hit) AS BIGINT) AS context_consulted,
 CAST(COUNT(*) FILTER (effective) AS BIGINT) AS context_effective, CAST(COUNT(*) FILTER (nb > 0) AS BIGINT) AS broad_coverage, CAST(COUNT(*) FILTER (ns > 0) AS BIGINT) AS subcategory_coverage,
 CAST(COUNT(*) FILTER (academic_field IS NOT NULL AND nb = 0) AS BIGINT) AS broad_review_required, CAST(COUNT(*) FILTER (academic_field IS NOT NULL AND ns = 0) AS BIGINT) AS subcategory_review_required,
 CAST(COUNT(*) FILTER (academic_field IS NOT NULL AND NOT listed) AS BIGINT) AS unmapped FROM z"""))
def cls13(spark, sf):
    return C.coverage_summary(context(spark, sf))


@query("cls14_safe_rule", B.with_ctes(f"SELECT record_id, gpa_min_tenths, gpa_min_inclusive FROM ({RULE_SQL}) z WHERE parse_status = 'parsed_safe'", b3=B.B3, rl=B.RULES))
def cls14(spark, sf):
    return C.safe_view(rule_layer(spark, sf), "rule").select("record_id", "gpa_min_tenths", "gpa_min_inclusive")


@query("cls14_safe_threshold", B.with_ctes(f"SELECT record_id, overall_gpa_min_tenths FROM ({GRADE_SQL}) z WHERE overall_gpa_min_tenths IS NOT NULL", b3=B.B3, gx=B.GRADE))
def cls14_threshold(spark, sf):
    return C.safe_view(grade(spark, sf), "threshold").select("record_id", "overall_gpa_min_tenths")


@query("cls14_safe_label", english_sql("SELECT record_id, requirement_status FROM c WHERE search_disposition = 'safe_exact'"))
def cls14_label(spark, sf):
    return C.safe_view(english(spark, sf), "label").select("record_id", "requirement_status")


COMPAT = ("SELECT 'OLD' || CAST(n_nationkey % 4 AS STRING) AS from_group_code, r_name AS to_group_code FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey < 7")


@query("cls15_compat", B.with_ctes("""
, u AS (SELECT to_group_code, COUNT(DISTINCT from_group_code) AS n, MIN(from_group_code) AS old FROM x GROUP BY to_group_code),
g AS (SELECT o_orderkey, COUNT(*) FILTER (COALESCE(n, 0) <> 1) AS open, COUNT(DISTINCT old) FILTER (n = 1) AS k, string_agg(DISTINCT old, ',' ORDER BY old) FILTER (n = 1) AS codes FROM m LEFT JOIN u ON r_name = to_group_code GROUP BY o_orderkey)
SELECT o_orderkey, CASE WHEN open > 0 OR k = 0 THEN 'review_required' WHEN k = 1 THEN 'single' ELSE 'multi' END AS mapping_status, CASE WHEN open > 0 OR k = 0 THEN '' ELSE codes END AS codes FROM g""",
    m=B.ORDER_REGIONS, x=COMPAT))
def cls15(spark, sf):
    members = f(spark, sf, B.ORDER_REGIONS).select("o_orderkey", "r_name")
    return C.project_compat(members, f(spark, sf, COMPAT), ["o_orderkey"], "r_name").withColumn("codes", F.array_join("codes", ","))


@query("cls16_excluded", english_sql("""
, t AS (SELECT 'required' AS label, requirement_status = 'required' AND search_disposition = 'safe_exact' AS hit, * FROM c UNION ALL SELECT 'not_required', requirement_status = 'not_required' AND search_disposition = 'safe_exact', * FROM c)
SELECT label, CAST(COUNT(*) AS BIGINT) AS total, CAST(COUNT(*) FILTER (hit) AS BIGINT) AS matched, CAST(COUNT(*) FILTER (requirement_status = 'unmapped') AS BIGINT) AS excluded,
 (SELECT string_agg(record_id, ',' ORDER BY record_id) FROM (SELECT record_id FROM c WHERE requirement_status = 'unmapped' ORDER BY record_id LIMIT 5) q) AS first_ids FROM t GROUP BY label"""))
def cls16(spark, sf):
    hit = lambda s: (F.col("requirement_status") == s) & (F.col("search_disposition") == "safe_exact")
    out = F.col("requirement_status") == "unmapped"
    x = C.excluded_rows(english(spark, sf), [("required", hit("required"), out), ("not_required", hit("not_required"), out)], "record_id")
    return x.withColumn("first_ids", F.array_join("first_ids", ","))


# ---- windows ------------------------------------------------------------------------------------------------------------

@query("win01_order_mismatches", B.with_ctes("""
SELECT o_orderkey, group_code, group_order, expected_order FROM (SELECT o_orderkey, group_code, group_order, CAST(ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY r_regionkey) AS BIGINT) AS expected_order FROM s) q
WHERE group_order <> expected_order""", s=B.STORED_REGIONS))
def win01(spark, sf):
    return C.order_mismatches(f(spark, sf, B.STORED_REGIONS), f(spark, sf, B.BROAD), ["o_orderkey"], "group_code", "group_order", "rank")


@query("win02_contiguity", B.with_ctes("""
SELECT o_orderkey, CAST(COUNT(*) AS BIGINT) AS n, MIN(group_order) AS lo, MAX(group_order) AS hi, CAST(COUNT(DISTINCT group_order) AS BIGINT) AS distinct_orders FROM s GROUP BY o_orderkey
HAVING NOT (MIN(group_order) = 1 AND MAX(group_order) = COUNT(*) AND COUNT(DISTINCT group_order) = COUNT(*))""", s=B.STORED_REGIONS))
def win02(spark, sf):
    return C.contiguity(f(spark, sf, B.STORED_REGIONS), ["o_orderkey"], "group_order")


@query("win03_first_row", """
SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS frequency, MIN(l_partkey * 1000000 + l_suppkey * 100 + l_linenumber) AS first_row FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def win03(spark, sf):
    return V.first_row(f(spark, sf, B.B2_CHILD), ["l_orderkey", "l_linenumber"], "_row_number")
