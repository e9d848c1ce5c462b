"""VAL operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as K
from ..functions import columns as P
from ..operators import bundle
from ..operators import rules as V
from ..sources import readers as R
from . import bindings as B
from .projection_plans import PRJ05, PRJ06, date_status
from .registry import query
from .sources_plans import LINES, headers, part_of, write_lines


def records(spark, sf) -> DataFrame:
    return B.frame(spark, sf, B.B1)


def flat(issues: DataFrame, *details: str) -> DataFrame:
    return issues.select("code", "severity", "dataset", "record_id", "field", "row_number",
                         *[F.element_at("details", F.lit(d)).alias(d) for d in details])


def run(spark, sf, rules, *details) -> DataFrame:
    return flat(V.apply_rules(records(spark, sf), rules, "master", "source_dataset", "record_id"), *details)


def line(code: str, where: str, field: str | None, src: str = "b1", id_: str = "record_id", **details: str) -> str:
    name = "CAST(NULL AS VARCHAR)" if field is None else f"'{field}'"
    extra = "".join(f", CAST({e} AS VARCHAR) AS {n}" for n, e in details.items())
    return (f"SELECT '{code}' AS code, '{K.severity(code)}' AS severity, source_dataset AS dataset, {id_} AS record_id, {name} AS field, "
            f"_row_number AS row_number{extra} FROM {src} WHERE {where}")


def sql(*lines: str) -> str:
    return B.with_ctes(" UNION ALL ".join(lines), b1=B.B1)


def words(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@query("val01_version_pairs", B.with_ctes("""
SELECT CASE WHEN source_dataset NOT IN ('kokkoritsu', 'shidai') THEN 'SOURCE_DATASET_UNSUPPORTED' ELSE 'SOURCE_VERSION_MISMATCH' END AS code,
 source_dataset, source_version, CAST(COUNT(*) AS BIGINT) AS rows FROM b1
WHERE NOT ((source_dataset = 'kokkoritsu' AND source_version = '5.83') OR (source_dataset = 'shidai' AND source_version = '1.10')) GROUP BY ALL""", b1=B.B1_VERSIONS))
def val01(spark, sf):
    return V.pair_issues(B.frame(spark, sf, B.B1_VERSIONS))


@query("val03_headers", """
SELECT 'SOURCE_COLUMN_ORDER_MISMATCH' AS code, CAST(p AS BIGINT) AS part, CAST(3 AS BIGINT) AS expected_count, CAST(CASE WHEN p % 3 = 1 THEN 3 ELSE 2 END AS BIGINT) AS actual_count
FROM (SELECT DISTINCT o_orderkey % 6 AS p FROM orders) s WHERE p % 3 <> 0
UNION ALL SELECT 'SOURCE_COLUMN_COUNT_MISMATCH', CAST(p AS BIGINT), CAST(3 AS BIGINT), CAST(2 AS BIGINT) FROM (SELECT DISTINCT o_orderkey % 6 AS p FROM orders) s WHERE p % 3 = 2""")
def val03(spark, sf):
    lines = B.table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 6).alias("part"), F.col("o_orderkey").alias("seq"),
        F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority").alias("line"))
    path = write_lines(spark, lines, headers(spark, ["id,status,priority", "status,id,priority", "id,status"] * 2))
    return R.header_issues(spark, path, LINES).select("code", part_of("file").alias("part"), "expected_count", "actual_count")


@query("val04_blank_key", sql(line("MASTER_PK_BLANK", "record_id = ''", "record_id"), line("COVERAGE_KEY_BLANK", "university = '' OR faculty_school = ''", None),
                              line("RESEARCH_ADMISSION_ID_BLANK", "department = ''", "department")))
def val04(spark, sf):
    return run(spark, sf, [*V.blank_key_rule("MASTER_PK_BLANK", ["record_id"]), *V.blank_key_rule("COVERAGE_KEY_BLANK", ["university", "faculty_school"]),
                           *V.blank_key_rule("RESEARCH_ADMISSION_ID_BLANK", ["department"])])


@query("val05_duplicate_key", B.with_ctes("""
SELECT 'MASTER_PK_DUPLICATE' AS code, 'error' AS severity, source_dataset AS dataset, record_id, 'record_id' AS field, _row_number AS row_number,
 CAST(first_row AS VARCHAR) AS first_row_number
FROM (SELECT *, MIN(_row_number) OVER (PARTITION BY source_dataset, record_id) AS first_row FROM b1 WHERE record_id <> '') x WHERE _row_number > first_row""", b1=B.B1))
def val05(spark, sf):
    return flat(V.duplicate_key_issues(records(spark, sf), ["record_id"], "_row_number"), "first_row_number")


@query("val05_duplicate_child_key", B.with_ctes("""
SELECT 'COVERAGE_KEY_DUPLICATE' AS code, 'error' AS severity, source_dataset AS dataset, CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS record_id,
 CAST(NULL AS VARCHAR) AS field, _row_number AS row_number, CAST(first_row AS VARCHAR) AS first_row_number
FROM (SELECT *, MIN(_row_number) OVER (PARTITION BY source_dataset, l_orderkey, l_linenumber) AS first_row FROM c) x WHERE _row_number > first_row""", c=B.B2_CHILD))
def val05_child(spark, sf):
    df = B.frame(spark, sf, B.B2_CHILD).select("source_dataset", F.col("l_orderkey").cast("string").alias("l_orderkey"),
                                               F.col("l_linenumber").cast("string").alias("l_linenumber"), "_row_number")
    return flat(V.duplicate_key_issues(df, ["l_orderkey", "l_linenumber"], "_row_number", "COVERAGE_KEY_DUPLICATE", "coverage"), "first_row_number")


REQUIRED = ("university", "verified_on", *K.SPECIAL_FLAGS)


@query("val06_required", sql(*[line("REQUIRED_VALUE_MISSING", f"{f} = ''", f) for f in REQUIRED]))
def val06(spark, sf):
    return run(spark, sf, V.required_rules(REQUIRED))


INT = "regexp_matches({}, '^-?[0-9]+$')"


@query("val07_integers", sql(
    line("INVALID_INTEGER_VALUE", f"NOT {INT.format('admission_year')}", "admission_year", value="admission_year", expected="NULL", minimum="NULL"),
    line("INVALID_INTEGER_VALUE", f"{INT.format('admission_year')} AND TRY_CAST(admission_year AS BIGINT) <> 2027", "admission_year", value="admission_year", expected="2027", minimum="NULL"),
    line("INVALID_INTEGER_VALUE", f"information_year <> '' AND NOT {INT.format('information_year')}", "information_year", value="information_year", expected="NULL", minimum="NULL"),
    line("INVALID_INTEGER_VALUE", "TRY_CAST(capacity AS BIGINT) < 3", "capacity", value="capacity", expected="NULL", minimum="3")))
def val07(spark, sf):
    return run(spark, sf, [*V.integer_rules("admission_year", True, expected=K.CONTRACT_YEAR), *V.integer_rules("information_year", False),
                           *V.integer_rules("capacity", True, minimum=3)], "value", "expected", "minimum")


@query("val08_institution_type", sql(line(
    "SOURCE_INSTITUTION_TYPE_MISMATCH", "NOT CASE WHEN source_dataset = 'kokkoritsu' THEN institution_type IN ('国立', '公立') ELSE institution_type = '私立' END",
    "institution_type", value="institution_type")))
def val08(spark, sf):
    return run(spark, sf, V.institution_rules(), "value")


@query("val09_domains", sql(
    *[line("INVALID_BOOLEAN_VALUE", f"{f} NOT IN ('', 'True', 'Yes', 'False', 'No')", f, value=f) for f in K.BOOLEAN_FIELDS],
    *[line("INVALID_TRISTATE_VALUE", f"{f} NOT IN ('', 'Yes', 'No', 'Unknown')", f, value=f) for f in K.TRISTATE_FIELDS],
    line("INVALID_COMMON_TEST_REQUIRED", "common_test_required NOT IN ('', 'Yes', 'No', 'Unknown', '条件付き')", "common_test_required", value="common_test_required"),
    line("INVALID_ENUM_VALUE", "exclusive_enrollment_status NOT IN ('専願', '併願可', '条件付き', '不明')", "exclusive_enrollment_status", value="exclusive_enrollment_status"),
    line("INVALID_ENUM_VALUE", "verification_grade NOT IN ('', 'A', 'B', 'C')", "verification_grade", value="verification_grade")))
def val09(spark, sf):
    return run(spark, sf, [*V.boolean_rules(), *V.tristate_rules(), *V.quadstate_rules(), *V.enum_rules()], "value")


@query("val10_unmapped", sql(
    line("DETAIL_COMPLETENESS_UNMAPPED", f"({PRJ05}) = 'unmapped'", "detail_completeness", raw_value="detail_completeness"),
    line("RESEARCH_ACTIVITY_LEVEL_UNMAPPED", f"({PRJ06}) = 'unmapped'", "research_activity_level", raw_value="research_activity_level")))
def val10(spark, sf):
    return run(spark, sf, V.mapping_rules(), "raw_value")


COMMON = "CASE WHEN common_test_required = '条件付き' THEN 'Conditional' ELSE common_test_required END"


@query("val11_common_test", sql(line("COMMON_TEST_FIELDS_DIFFER", f"common_test_required <> '' AND selection_common_test <> '' AND {COMMON} <> selection_common_test", None,
                                     common_test_required=COMMON, selection_common_test="selection_common_test")))
def val11(spark, sf):
    return run(spark, sf, V.common_test_rules(), "common_test_required", "selection_common_test")


@query("val12_urls", sql(
    line("PROVENANCE_URL_MISSING", "source_url = ''", "source_url"),
    line("PROVENANCE_URL_MISSING", "exclusive_enrollment_evidence_url = '' AND exclusive_enrollment_status <> '不明'", "exclusive_enrollment_evidence_url"),
    line("PROVENANCE_URL_MISSING", "previous_year_source_url = '' AND fallback_previous_year IN ('True', 'Yes')", "previous_year_source_url")))
def val12(spark, sf):
    return run(spark, sf, V.master_url_rules())


COVERAGE_TEXT = ("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '対象外（' || lang || '）' ELSE lang END AS undergraduate_scope, CASE WHEN doc_id % 7 = 0 THEN '対象外' ELSE source END AS research_status, "
                 "CASE doc_id % 3 WHEN 0 THEN '0' WHEN 1 THEN CAST(n_chars AS STRING) ELSE 'many' END AS master_rows, CASE WHEN doc_id % 2 = 0 THEN '' ELSE source END AS official_source_url FROM {documents}")


@query("val12_coverage_urls", B.with_ctes("""
SELECT CAST(doc_id AS VARCHAR) AS record_id, 'PROVENANCE_URL_MISSING' AS code FROM c
WHERE official_source_url = '' AND (COALESCE(TRY_CAST(master_rows AS BIGINT), 0) <> 0 OR NOT (undergraduate_scope LIKE '対象外%' OR research_status = '対象外'))""", c=COVERAGE_TEXT))
def val12_coverage(spark, sf):
    df = B.frame(spark, sf, COVERAGE_TEXT)
    return V.apply_rules(df, V.coverage_url_rules(), "coverage", F.lit("x"), "doc_id", "doc_id").select("record_id", "code")


PADDED = ("SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN ' ' || text WHEN 1 THEN text || '　' WHEN 2 THEN '　' || text || ' ' ELSE text END AS text, "
          "CASE WHEN doc_id % 5 = 0 THEN source || ' ' ELSE source END AS source FROM {documents}")
LEAD, TRAIL = r"regexp_matches({}, '^[\s\p{{Z}}\x1C-\x1F\x{{85}}]')", r"regexp_matches({}, '[\s\p{{Z}}\x1C-\x1F\x{{85}}]$')"


@query("val13_whitespace", B.with_ctes(" UNION ALL ".join(
    f"SELECT CAST(doc_id AS VARCHAR) AS record_id, '{c}' AS field, CAST({LEAD.format(c)} AS VARCHAR) AS leading, CAST({TRAIL.format(c)} AS VARCHAR) AS trailing "
    f"FROM p WHERE {LEAD.format(c)} OR {TRAIL.format(c)}" for c in ("text", "source")), p=PADDED))
def val13(spark, sf):
    df = B.frame(spark, sf, PADDED)
    return flat(V.apply_rules(df, V.whitespace_rules(["text", "source"]), "documents", F.lit("x"), "doc_id", "doc_id"), "leading", "trailing").select(
        "record_id", "field", "leading", "trailing")


@query("val14_dates", sql(*[
    line(code, f"({date_status(f)}) = '{status}'", f, raw_value=f, parse_status=f"'{status}'")
    for f in K.DATE_FIELDS for code, status in (("DATE_RAW_PARTIAL", "partial"), ("DATE_RAW_UNPARSED", "unparsed"))]))
def val14(spark, sf):
    return run(spark, sf, V.date_rules(), "raw_value", "parse_status")


ZERO = ("SELECT c_custkey, c_name, CAST(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey END AS STRING) AS master_rows, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END AS undergraduate_scope, "
        "'' AS research_status, CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE '' END AS current_year_status, CAST(NULL AS STRING) AS fallback_status FROM {customer}")


@query("val15_zero_rows", B.with_ctes(
    "SELECT c_name AS record_id, 'COVERAGE_ZERO_MASTER_ROWS' AS code FROM z WHERE master_rows = '0' AND (undergraduate_scope <> '' OR current_year_status <> '')", z=ZERO))
def val15(spark, sf):
    return V.apply_rules(B.frame(spark, sf, ZERO), V.zero_rows_rule(), "coverage", F.lit("x"), "c_name", "c_custkey").select("record_id", "code")


@query("val16_duplicate_rows", B.with_ctes("""
SELECT 'RESEARCH_EXACT_DUPLICATE' AS code, 'warning' AS severity, source_dataset AS dataset, CAST(l_orderkey AS VARCHAR) AS record_id, CAST(NULL AS VARCHAR) AS field,
 _row_number AS row_number, CAST(first_row AS VARCHAR) AS first_row_number
FROM (SELECT *, MIN(_row_number) OVER (PARTITION BY l_orderkey, l_linenumber) AS first_row FROM c) x WHERE _row_number > first_row""", c=B.B2_CHILD))
def val16(spark, sf):
    return flat(V.duplicate_row_issues(B.frame(spark, sf, B.B2_CHILD), ["l_orderkey", "l_linenumber"], "_row_number", record_id="l_orderkey"), "first_row_number")


@query("val17_count_mismatch", B.with_ctes("""
SELECT 'COVERAGE_MASTER_ROWS_MISMATCH' AS code, 'error' AS severity, source_dataset AS dataset, v.c_name AS record_id, 'declared' AS field, _row_number AS row_number,
 CAST(declared AS VARCHAR) AS declared, CAST(COALESCE(n, 0) AS VARCHAR) AS actual
FROM v LEFT JOIN (SELECT c_name, COUNT(*) AS n FROM p GROUP BY c_name) g ON v.c_name = g.c_name WHERE declared <> COALESCE(n, 0)""", v=B.B2_COVERAGE, p=B.B2_PARENT))
def val17(spark, sf):
    return flat(V.count_mismatch_issues(B.frame(spark, sf, B.B2_COVERAGE), B.frame(spark, sf, B.B2_PARENT), ["c_name"], "declared"), "declared", "actual")


@query("val18_orphan_fk", B.with_ctes("""
SELECT 'RESEARCH_ORPHAN_FK' AS code, 'error' AS severity, c.source_dataset AS dataset, CAST(l_orderkey AS VARCHAR) AS record_id, 'l_orderkey' AS field, c._row_number AS row_number
FROM c WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.o_orderkey = c.l_orderkey AND p.source_dataset = c.source_dataset)""", c=B.B2_CHILD, p=B.B2_PARENT_CUT))
def val18(spark, sf):
    return flat(V.orphan_issues(B.frame(spark, sf, B.B2_CHILD), B.frame(spark, sf, B.B2_PARENT_CUT),
                                [("source_dataset", "source_dataset"), ("l_orderkey", "o_orderkey")]))


COPIED = ("SELECT l_orderkey, l_partkey * 1000000 + l_suppkey * 100 + l_linenumber AS _row_number, 'x' AS source_dataset, "
          "CASE WHEN l_partkey % 7 = 0 THEN 'other' ELSE c_name END AS c_name, CASE WHEN l_partkey % 11 = 0 THEN '' ELSE o_orderpriority END AS o_orderpriority, o_orderstatus "
          "FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey")


@query("val19_denormalized", B.with_ctes(" UNION ALL ".join(
    f"""SELECT 'RESEARCH_DENORMALIZED_FIELD_MISMATCH' AS code, CAST(l_orderkey AS VARCHAR) AS record_id, '{f}' AS field, c._row_number AS row_number, p.{f} AS parent_value, c.{f} AS child_value
FROM c JOIN p ON p.o_orderkey = c.l_orderkey WHERE p.{f} <> c.{f}""" for f in ("c_name", "o_orderpriority", "o_orderstatus")), c=COPIED, p=B.B2_PARENT_CUT))
def val19(spark, sf):
    return flat(V.denormalized_issues(B.frame(spark, sf, COPIED), B.frame(spark, sf, B.B2_PARENT_CUT).drop("source_dataset"), [("l_orderkey", "o_orderkey")],
                                      ["c_name", "o_orderpriority", "o_orderstatus"]), "parent_value", "child_value").drop("severity", "dataset")


@query("val20_child_flags", B.with_ctes("""
SELECT CASE WHEN needs_child = 'Yes' THEN 'RESEARCH_REQUIRED_WITHOUT_CHILD' ELSE 'RESEARCH_NOT_REQUIRED_WITH_CHILD' END AS code,
 CASE WHEN needs_child = 'Yes' THEN 'warning' ELSE 'informational' END AS severity, source_dataset AS dataset, CAST(o_orderkey AS VARCHAR) AS record_id, CAST(NULL AS VARCHAR) AS field,
 _row_number AS row_number, CASE WHEN needs_child = 'No' THEN CAST(n AS VARCHAR) END AS child_rows
FROM p LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM c GROUP BY l_orderkey) g ON l_orderkey = o_orderkey
WHERE (needs_child = 'Yes' AND n IS NULL) OR (needs_child = 'No' AND n > 0)""", c=B.B2_CHILD, p=B.B2_PARENT))
def val20(spark, sf):
    return flat(V.child_flag_issues(B.frame(spark, sf, B.B2_PARENT), B.frame(spark, sf, B.B2_CHILD),
                                    [("source_dataset", "source_dataset"), ("l_orderkey", "o_orderkey")], "needs_child"), "child_rows")


def sample_issues(spark, sf) -> DataFrame:
    rules = [*V.required_rules(["university"]), *V.institution_rules(), *V.master_url_rules(), *V.quadstate_rules(), *V.common_test_rules()]
    return V.apply_rules(records(spark, sf), rules, "master", "source_dataset", "record_id")


SAMPLE = " UNION ALL ".join([
    line("REQUIRED_VALUE_MISSING", "university = ''", "university"),
    line("SOURCE_INSTITUTION_TYPE_MISMATCH", "NOT CASE WHEN source_dataset = 'kokkoritsu' THEN institution_type IN ('国立', '公立') ELSE institution_type = '私立' END", "institution_type"),
    line("PROVENANCE_URL_MISSING", "source_url = ''", "source_url"),
    line("PROVENANCE_URL_MISSING", "exclusive_enrollment_evidence_url = '' AND exclusive_enrollment_status <> '不明'", "exclusive_enrollment_evidence_url"),
    line("PROVENANCE_URL_MISSING", "previous_year_source_url = '' AND fallback_previous_year IN ('True', 'Yes')", "previous_year_source_url"),
    line("INVALID_COMMON_TEST_REQUIRED", "common_test_required NOT IN ('', 'Yes', 'No', 'Unknown', '条件付き')", "common_test_required"),
    line("COMMON_TEST_FIELDS_DIFFER", f"common_test_required <> '' AND selection_common_test <> '' AND {COMMON} <> selection_common_test", None)])


def summary_sql(body: str) -> str:
    return f"WITH b1 AS ({B.duck(B.B1)}), i AS ({SAMPLE}) {body}"


@query("val21_issue_summary", summary_sql("""
SELECT c.code, c.severity, c.count, c.by_dataset, r.representative_record_ids FROM
 (SELECT code, severity, CAST(SUM(n) AS BIGINT) AS count, string_agg(dataset || '=' || CAST(n AS VARCHAR), ',' ORDER BY dataset) AS by_dataset
  FROM (SELECT code, severity, dataset, COUNT(*) AS n FROM i GROUP BY ALL) g GROUP BY code, severity) c
 LEFT JOIN (SELECT code, string_agg(record_id, ',' ORDER BY rn) AS representative_record_ids FROM (
  SELECT code, record_id, ROW_NUMBER() OVER (PARTITION BY code ORDER BY d, rw, record_id) AS rn FROM (
   SELECT code, record_id, MIN(dataset) AS d, arg_min(row_number, dataset || lpad(CAST(row_number AS VARCHAR), 20, '0')) AS rw FROM i WHERE record_id <> '' GROUP BY code, record_id) q) w WHERE rn <= 5 GROUP BY code) r
 ON c.code = r.code"""))
def val21(spark, sf):
    s = V.summarize_issues(sample_issues(spark, sf))
    return s.select("code", "severity", "count", F.array_join(F.transform("by_dataset", lambda x: F.concat_ws("=", x["dataset"], x["n"].cast("string"))), ",").alias("by_dataset"),
                    F.array_join("representative_record_ids", ",").alias("representative_record_ids"))


@query("val21_issue_status", summary_sql("""
SELECT CAST(COUNT(*) AS BIGINT) AS total_issues, CAST(COUNT(*) FILTER (severity = 'error') AS BIGINT) AS error, CAST(COUNT(*) FILTER (severity = 'warning') AS BIGINT) AS warning,
 CAST(COUNT(*) FILTER (severity = 'informational') AS BIGINT) AS informational,
 CASE WHEN COUNT(*) = 0 THEN 'passed' WHEN COUNT(*) FILTER (severity = 'error') > 0 THEN 'failed' ELSE 'passed_with_findings' END AS status FROM i"""))
def val21_status(spark, sf):
    return V.issue_status(sample_issues(spark, sf))


@query("val21_issues_by_dataset", summary_sql("""
SELECT dataset, CAST(COUNT(*) FILTER (severity = 'error') AS BIGINT) AS error, CAST(COUNT(*) FILTER (severity = 'warning') AS BIGINT) AS warning,
 CAST(COUNT(*) FILTER (severity = 'informational') AS BIGINT) AS informational, CAST(COUNT(*) AS BIGINT) AS total FROM i GROUP BY dataset"""))
def val21_dataset(spark, sf):
    return V.issues_by_dataset(sample_issues(spark, sf))


@query("val22_status_metrics", B.with_ctes(f"""
SELECT source_dataset, 'detail_completeness_status' AS metric, COALESCE({PRJ05}, 'null') AS status, CAST(COUNT(*) AS BIGINT) AS rows FROM b1 GROUP BY ALL
UNION ALL SELECT source_dataset, 'research_activity_level_status', COALESCE({PRJ06}, 'null'), CAST(COUNT(*) AS BIGINT) FROM b1 GROUP BY ALL""", b1=B.B1))
def val22(spark, sf):
    return V.status_metrics(records(spark, sf), {"detail_completeness_status": P.detail_status(), "research_activity_level_status": P.research_status()})


# ---- a whole bundle -----------------------------------------------------------------------------------------------------

BUNDLE = {"b1": B.BUNDLE_MASTER, "cv": B.BUNDLE_COVERAGE, "rs": B.BUNDLE_RESEARCH}
COV_ID, RES_ID = "institution_type || ':' || university", "CASE WHEN admission_id = '' THEN 'row:' || CAST(_row_number AS VARCHAR) ELSE admission_id END"
SETS = f"""
, f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_dataset, record_id ORDER BY _row_number) AS nth, MIN(_row_number) OVER (PARTITION BY source_dataset, record_id) AS first_row FROM b1 WHERE record_id <> '')
, k AS (SELECT source_dataset, admission_id, COUNT(*) AS n FROM rs WHERE admission_id <> '' GROUP BY ALL)
, j AS (SELECT f.*, COALESCE(k.n, 0) AS kids FROM f LEFT JOIN k ON f.source_dataset = k.source_dataset AND f.record_id = k.admission_id WHERE nth = 1)
, a AS (SELECT source_dataset, institution_type, university, COUNT(*) AS n FROM b1 GROUP BY ALL)
, v AS (SELECT cv.*, a.n, MIN(_row_number) OVER (PARTITION BY source_dataset, institution_type, university) AS first_row FROM cv LEFT JOIN a USING (source_dataset, institution_type, university))
, d AS (SELECT *, MIN(_row_number) OVER (PARTITION BY source_dataset, {', '.join(K.source_columns(K.RESEARCH))}) AS first_row FROM rs)
, si AS (SELECT 'master' AS tab, 'MASTER_PK_DUPLICATE' AS code, source_dataset AS dataset, record_id, 'record_id' AS field, _row_number AS row_number, CAST(first_row AS VARCHAR) AS detail FROM f WHERE _row_number > first_row
UNION ALL SELECT 'master', 'RESEARCH_REQUIRED_WITHOUT_CHILD', source_dataset, record_id, NULL, _row_number, NULL FROM j WHERE research_requirement_required = 'Yes' AND kids = 0
UNION ALL SELECT 'master', 'RESEARCH_NOT_REQUIRED_WITH_CHILD', source_dataset, record_id, NULL, _row_number, CAST(kids AS VARCHAR) FROM j WHERE research_requirement_required = 'No' AND kids > 0
UNION ALL SELECT 'research_requirements', 'RESEARCH_ORPHAN_FK', source_dataset, admission_id, 'admission_id', _row_number, NULL FROM rs WHERE admission_id <> '' AND NOT EXISTS (SELECT 1 FROM j WHERE j.source_dataset = rs.source_dataset AND j.record_id = rs.admission_id)
{" ".join(f"UNION ALL SELECT 'research_requirements', 'RESEARCH_DENORMALIZED_FIELD_MISMATCH', rs.source_dataset, admission_id, '{c}', rs._row_number, j.{c} FROM rs JOIN j ON j.source_dataset = rs.source_dataset AND j.record_id = rs.admission_id WHERE rs.{c} <> j.{c}" for c in K.DISPLAY_FIELDS)}
UNION ALL SELECT 'research_requirements', 'RESEARCH_EXACT_DUPLICATE', source_dataset, admission_id, NULL, _row_number, CAST(first_row AS VARCHAR) FROM d WHERE _row_number > first_row
UNION ALL SELECT 'coverage', 'COVERAGE_KEY_DUPLICATE', source_dataset, {COV_ID}, NULL, _row_number, CAST(first_row AS VARCHAR) FROM v WHERE _row_number > first_row
UNION ALL SELECT 'coverage', 'COVERAGE_MASTER_ROWS_MISMATCH', source_dataset, {COV_ID}, 'master_rows', _row_number, CAST(COALESCE(n, 0) AS VARCHAR) FROM v WHERE TRY_CAST(master_rows AS BIGINT) <> COALESCE(n, 0))
"""


def bundle_frames(spark, sf) -> list[DataFrame]:
    return [B.frame(spark, sf, s) for s in BUNDLE.values()]


@query("val20_bundle_sets", B.with_ctes(SETS + "SELECT * FROM si", **BUNDLE))
def val20_bundle(spark, sf):
    """All rules over more than one row, from the two aggregates of a bundle."""
    found = bundle.set_issues(*bundle_frames(spark, sf))
    detail = F.coalesce(*[F.element_at("details", F.lit(k)) for k in ("first_row_number", "child_rows", "parent_value", "actual")])
    return found.select(F.col("table").alias("tab"), "code", "dataset", "record_id", "field", "row_number", detail.alias("detail"))


def blank(fields, src: str, id_: str) -> list[str]:
    return [line("REQUIRED_VALUE_MISSING", f"{f} = ''", f, src, id_) for f in fields]


def padded(fields, src: str, id_: str) -> list[str]:
    return [line("WHITESPACE_PADDING", f"({LEAD.format(c)} OR {TRAIL.format(c)})", c, src, id_) for c in fields]


def dates(fields, src: str, id_: str) -> list[str]:
    return [line(code, f"({date_status(c)}) = '{st}'", c, src, id_) for c in fields for code, st in (("DATE_RAW_PARTIAL", "partial"), ("DATE_RAW_UNPARSED", "unparsed"))]


INSTITUTION = "NOT CASE WHEN source_dataset = 'kokkoritsu' THEN institution_type IN ('国立', '公立') ELSE institution_type = '私立' END"
MASTER_LINES = [
    line("MASTER_PK_BLANK", "record_id = ''", "record_id"), *blank(REQUIRED, "b1", "record_id"),
    line("INVALID_INTEGER_VALUE", f"NOT {INT.format('admission_year')} OR TRY_CAST(admission_year AS BIGINT) <> 2027", "admission_year"),
    line("INVALID_INTEGER_VALUE", f"information_year <> '' AND NOT {INT.format('information_year')}", "information_year"),
    line("SOURCE_INSTITUTION_TYPE_MISMATCH", INSTITUTION, "institution_type"),
    *[line("INVALID_BOOLEAN_VALUE", f"{c} NOT IN ('', 'True', 'Yes', 'False', 'No')", c) for c in K.BOOLEAN_FIELDS],
    *[line("INVALID_TRISTATE_VALUE", f"{c} NOT IN ('', 'Yes', 'No', 'Unknown')", c) for c in K.TRISTATE_FIELDS],
    line("INVALID_COMMON_TEST_REQUIRED", "common_test_required NOT IN ('', 'Yes', 'No', 'Unknown', '条件付き')", "common_test_required"),
    line("INVALID_ENUM_VALUE", "exclusive_enrollment_status NOT IN ('専願', '併願可', '条件付き', '不明')", "exclusive_enrollment_status"),
    line("INVALID_ENUM_VALUE", "verification_grade NOT IN ('', 'A', 'B', 'C')", "verification_grade"),
    line("DETAIL_COMPLETENESS_UNMAPPED", f"({PRJ05}) = 'unmapped'", "detail_completeness"), line("RESEARCH_ACTIVITY_LEVEL_UNMAPPED", f"({PRJ06}) = 'unmapped'", "research_activity_level"),
    line("COMMON_TEST_FIELDS_DIFFER", f"common_test_required <> '' AND selection_common_test <> '' AND {COMMON} <> selection_common_test", None),
    line("PROVENANCE_URL_MISSING", "source_url = ''", "source_url"),
    line("PROVENANCE_URL_MISSING", "exclusive_enrollment_evidence_url = '' AND exclusive_enrollment_status <> '不明'", "exclusive_enrollment_evidence_url"),
    line("PROVENANCE_URL_MISSING", "previous_year_source_url = '' AND fallback_previous_year IN ('True', 'Yes')", "previous_year_source_url"),
    *padded(K.source_columns(K.MASTER), "b1", "record_id"), *dates(K.DATE_FIELDS, "b1", "record_id")]
COVERAGE_LINES = [
    line("COVERAGE_KEY_BLANK", "university = '' OR institution_type = ''", None, "cv", COV_ID), line("SOURCE_INSTITUTION_TYPE_MISMATCH", INSTITUTION, "institution_type", "cv", COV_ID),
    line("INVALID_INTEGER_VALUE", f"NOT {INT.format('master_rows')} OR TRY_CAST(master_rows AS BIGINT) < 0", "master_rows", "cv", COV_ID), *blank(["checked_on"], "cv", COV_ID),
    line("COVERAGE_ZERO_MASTER_ROWS", "master_rows = '0' AND (undergraduate_scope <> '' OR research_status <> '')", None, "cv", COV_ID),
    line("PROVENANCE_URL_MISSING", "official_source_url = '' AND (COALESCE(TRY_CAST(master_rows AS BIGINT), 0) <> 0 OR NOT (undergraduate_scope LIKE '対象外%' OR research_status = '対象外'))", "official_source_url", "cv", COV_ID),
    *padded(K.source_columns(K.COVERAGE), "cv", COV_ID), *dates(["checked_on"], "cv", COV_ID)]
RESEARCH_LINES = [
    line("RESEARCH_ADMISSION_ID_BLANK", "admission_id = ''", "admission_id", "rs", RES_ID), *blank(["university", "verified_on"], "rs", RES_ID),
    line("PROVENANCE_URL_MISSING", "source_url = ''", "source_url", "rs", RES_ID), *padded(K.source_columns(K.RESEARCH), "rs", RES_ID), *dates(["verified_on"], "rs", RES_ID)]
ALL_LINES = " UNION ALL ".join(f"SELECT '{t}' AS tab, * EXCLUDE (severity) FROM ({' UNION ALL '.join(x)}) q" for t, x in (
    ("master", MASTER_LINES), ("coverage", COVERAGE_LINES), ("research_requirements", RESEARCH_LINES)))


@query("val21_bundle", B.with_ctes(SETS + f"""
, al AS ({ALL_LINES} UNION ALL SELECT * EXCLUDE (detail) FROM si)
SELECT tab, code, dataset, field, CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(DISTINCT record_id) AS BIGINT) AS ids, CAST(SUM(row_number) AS BIGINT) AS row_numbers FROM al GROUP BY ALL""", **BUNDLE))
def val21_bundle(spark, sf):
    """Every finding of a bundle, counted per table, code, source and field."""
    kinds = bundle.kinds()
    found = bundle.validate_bundle(*bundle_frames(spark, sf), kinds=kinds)
    return V.count_kinds(found, kinds).withColumnRenamed("table", "tab")
