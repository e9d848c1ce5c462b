"""Record catalogues bound to the driver's tables.

Every binding is one SELECT that Spark and the checking engine both understand, so the two sides start from the same
rows; defects that the tables lack are derived by fixed expressions. The operators under test never appear here.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from .. import contract as K
from ..operators.classify import classify_records
from ..operators.review import number_packet
from ..sources.shared import scratch

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")


_OPENED: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the driver; its footer is read once per session."""
    key = (id(spark), f"{sf}/{name}.parquet")
    owner, df = _OPENED.get(key, (None, None))
    if owner is not spark:
        df = spark.read.parquet(key[1])
        _OPENED[key] = (spark, df)
    return df


def frame(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """A binding as DataFrame; ``{orders}`` and the like stand for the tables, the packet for its operator's output."""
    sql = sql.replace(PACKET, "SELECT review_order, raw_or_context, frequency, representative_record_id FROM {packet}")
    used = {t: table(spark, sf, t) for t in TABLES if "{" + t + "}" in sql}
    if "{packet}" in sql:
        used["packet"] = packet(spark, sf)
    return spark.sql(sql, **used)


def packet(spark: SparkSession, sf: str) -> DataFrame:
    """The numbered packet, built once per session."""
    key = (id(spark), f"{sf}/packet")
    owner, df = _OPENED.get(key, (None, None))
    if owner is not spark:
        df = number_packet(spark.sql(PACKET_VALUES, events=table(spark, sf, "events")))
        _OPENED[key] = (spark, df)
    return df


def duck(sql: str) -> str:
    """The same binding as text for the checking engine."""
    return sql.format(**{t: t for t in TABLES})


def with_ctes(body: str, **ctes: str) -> str:
    """A query over bindings; a body that starts with a comma adds further named parts."""
    return "WITH " + ", ".join(f"{n} AS ({duck(s)})" for n, s in ctes.items()) + " " + body.strip()


def number(i: int | str) -> str:
    return f"CAST({i} AS STRING)"


# ---- B1 / B5: records as source text -----------------------------------------------------------------------------------

DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
LATER = "CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 5 DAY AS DATE) AS STRING)"


def raw_date(shift: int) -> str:
    return (f"CASE (o_orderkey + {shift}) % 6 WHEN 0 THEN {DAY} WHEN 1 THEN 'from ' || {DAY} WHEN 2 THEN {DAY} || '~' || {LATER} "
            f"WHEN 3 THEN '2026-02-30' WHEN 4 THEN 'late autumn' ELSE '' END")


def tristate(i: int) -> str:
    return (f"CASE WHEN o_orderkey % {17 + i} = 0 THEN 'x' WHEN o_orderkey % {5 + i} = 0 THEN '' "
            f"WHEN o_orderkey % {3 + i} = 0 THEN 'Unknown' WHEN o_orderkey % {2 + i} = 0 THEN 'Yes' ELSE 'No' END")


def special_flag(i: int) -> str:
    return (f"CASE WHEN o_orderkey % {13 + i} = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN 'Maybe' "
            f"WHEN o_orderkey % {3 + i} = 0 THEN 'Yes' ELSE 'No' END")


@lru_cache
def master_columns() -> dict[str, str]:
    """Expression per source column of the record table."""
    k = "o_orderkey"
    made = {
        "record_id": f"CASE WHEN {k} % 23 = 0 THEN '' WHEN {k} % 41 = 0 THEN 'R' || {number(k + ' - 2')} ELSE 'R' || {number(k)} END",
        "admission_year": f"CASE WHEN {k} % 11 = 0 THEN '' WHEN {k} % 13 = 0 THEN '2026' WHEN {k} % 17 = 0 THEN ' 2027' ELSE '2027' END",
        "information_year": f"CASE WHEN {k} % 7 = 0 THEN '' WHEN {k} % 19 = 0 THEN '20x6' WHEN {k} % 5 = 0 THEN '2026' ELSE '2027' END",
        "institution_type": f"CASE WHEN {k} % 31 = 0 THEN '短大' WHEN {k} % 2 = 1 THEN '私立' WHEN {k} % 4 = 0 THEN '国立' ELSE '公立' END",
        "university": f"CASE WHEN {k} % 37 = 0 THEN '' ELSE c_name END",
        "prefecture": f"'NATION_' || {number('c_nationkey')}",
        "academic_field": "c_mktsegment",
        "faculty_school": f"CASE WHEN {k} % 3 = 0 THEN '' ELSE 'F' || {number('o_custkey % 3')} END",
        "department": f"CASE WHEN {k} % 4 = 0 THEN '' ELSE 'D' || {number(k + ' % 5')} END",
        "selection_category": f"CASE {k} % 3 WHEN 0 THEN '学校推薦型選抜' WHEN 1 THEN '総合型選抜' ELSE '一般選抜' END",
        "selection_name": "o_orderpriority",
        "slot_type": "o_orderstatus",
        "capacity": number(f"{k} % 40"),
        "stem_flag": f"CASE WHEN {k} % 2 = 0 THEN 'True' WHEN {k} % 19 = 0 THEN 'Maybe' WHEN {k} % 5 = 0 THEN '' ELSE 'False' END",
        "fallback_previous_year": f"CASE WHEN {k} % 7 = 0 THEN 'Yes' WHEN {k} % 17 = 0 THEN 'x' WHEN {k} % 11 = 0 THEN '' ELSE 'No' END",
        "common_test_required": f"CASE WHEN {k} % 17 = 0 THEN 'x' WHEN {k} % 5 = 0 THEN '条件付き' WHEN {k} % 11 = 0 THEN '' WHEN {k} % 2 = 0 THEN 'Yes' ELSE 'No' END",
        "exclusive_enrollment_status": f"CASE WHEN {k} % 29 = 0 THEN '' WHEN {k} % 4 = 0 THEN '専願' WHEN {k} % 4 = 1 THEN '併願可' WHEN {k} % 4 = 2 THEN '条件付き' ELSE '不明' END",
        "verification_grade": f"CASE WHEN {k} % 19 = 0 THEN 'D' WHEN {k} % 11 = 0 THEN '' WHEN {k} % 3 = 0 THEN 'A' WHEN {k} % 3 = 1 THEN 'B' ELSE 'C' END",
        "detail_completeness": f"CASE WHEN {k} % 11 = 0 THEN '' WHEN {k} % 2 = 0 THEN CASE {k} % 6 WHEN 0 THEN 'detailed_v2' WHEN 2 THEN 'partial (dates)' ELSE 'rough' END "
                               f"ELSE CASE {k} % 5 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' WHEN 2 THEN 'pending' WHEN 3 THEN 'unknown' ELSE 'detailed' END END",
        "research_activity_level": f"CASE WHEN {k} % 13 = 0 THEN '' WHEN {k} % 2 = 0 THEN CASE {k} % 10 WHEN 0 THEN 'explicit_requirement' WHEN 2 THEN '探究活動必須' WHEN 4 THEN 'related' WHEN 6 THEN 'なし' ELSE 'other' END "
                                   f"ELSE CASE {k} % 5 WHEN 0 THEN 'required' WHEN 1 THEN 'relevant' WHEN 2 THEN 'none' WHEN 3 THEN 'unknown' ELSE 'related' END END",
        "gpa_requirement": f"CASE WHEN {k} % 9 = 0 THEN '' ELSE 'G' || {number(k + ' % 60')} END",
        "english_requirement": f"CASE WHEN {k} % 8 = 0 THEN '' ELSE o_orderpriority END",
        "source_url": f"CASE WHEN {k} % 11 = 0 THEN '' ELSE 'https://e.example/' || {number(k)} END",
        "exclusive_enrollment_evidence_url": f"CASE WHEN {k} % 3 = 0 THEN '' ELSE 'https://x.example/' END",
        "previous_year_source_url": f"CASE WHEN {k} % 5 = 0 THEN '' ELSE 'https://p.example/' END",
        "notes": f"CASE WHEN {k} % 13 = 0 THEN ' ' || o_orderstatus WHEN {k} % 17 = 0 THEN o_orderstatus || '　' ELSE o_orderstatus END",
        "publication_status": "o_orderstatus",
        **{f: tristate(i) for i, f in enumerate(K.TRISTATE_FIELDS)},
        **{f: special_flag(i) for i, f in enumerate(K.SPECIAL_FLAGS)},
        **{f: raw_date(i) for i, f in enumerate(K.DATE_FIELDS)},
    }
    return {c: made.get(c, "''") for c in K.source_columns(K.MASTER)}


def select_list(cols: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in cols.items())


DATASET = "CASE WHEN o_orderkey % 2 = 0 THEN 'kokkoritsu' ELSE 'shidai' END"
VERSION = "CASE WHEN o_orderkey % 2 = 0 THEN '5.83' ELSE '1.10' END"
ORDERS_CUSTOMER = "FROM {orders} JOIN {customer} ON o_custkey = c_custkey"
DEFECT_DATASET = f"CASE WHEN o_orderkey % 43 = 0 THEN 'other' ELSE {DATASET} END"
DEFECT_VERSION = f"CASE WHEN o_orderkey % 29 = 0 THEN '9.99' ELSE {VERSION} END"

B1 = (f"SELECT {DATASET} AS source_dataset, {VERSION} AS source_version, o_orderkey AS _row_number, "
      f"{select_list(master_columns())} {ORDERS_CUSTOMER}")
B1_VERSIONS = f"SELECT {DEFECT_DATASET} AS source_dataset, {DEFECT_VERSION} AS source_version, o_orderkey {ORDERS_CUSTOMER}"


def clean(expr: str, bad: tuple[str, ...]) -> str:
    """The same cell without its defects: values the strict adapter would refuse become blank."""
    return f"CASE WHEN ({expr}) IN ({', '.join(repr(b) for b in bad)}) THEN '' ELSE ({expr}) END"


@lru_cache
def clean_columns() -> dict[str, str]:
    out = dict(master_columns())
    for c in (*K.TRISTATE_FIELDS, "common_test_required"):
        out[c] = clean(out[c], ("x",))
    for c in ("stem_flag", "fallback_previous_year", *K.SPECIAL_FLAGS):
        out[c] = clean(out[c], ("x", "Maybe"))
    out["admission_year"] = clean(out["admission_year"], (" 2027",))
    out["information_year"] = clean(out["information_year"], ("20x6",))
    out["record_id"] = "'R' || CAST(o_orderkey AS STRING)"
    return out


B1_CLEAN = (f"SELECT {DATASET} AS source_dataset, {VERSION} AS source_version, o_orderkey AS _row_number, "
            f"{select_list(clean_columns())} {ORDERS_CUSTOMER}")

# ---- B2: parent, child, coverage ---------------------------------------------------------------------------------------

B2_PARENT = (f"SELECT {DATASET} AS source_dataset, o_orderkey AS _row_number, o_orderkey, o_custkey, c_name, o_orderstatus, o_orderpriority, "
             f"CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS needs_child {ORDERS_CUSTOMER}")
# orphans: parents without every 17th key
B2_PARENT_CUT = B2_PARENT + " WHERE o_orderkey % 17 <> 0"
B2_CHILD = ("SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'kokkoritsu' ELSE 'shidai' END AS source_dataset, l_orderkey, l_linenumber, "
            "l_partkey * 1000000 + l_suppkey * 100 + l_linenumber AS _row_number FROM {lineitem}")
B2_COVERAGE = (f"SELECT c_name, c_custkey AS _row_number, 'kokkoritsu' AS source_dataset, "
               f"CAST(COALESCE(n, 0) + CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END AS BIGINT) AS declared, c_mktsegment AS scope, "
               f"CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'checked' END AS status "
               f"FROM {{customer}} LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM {{orders}} GROUP BY o_custkey) x ON o_custkey = c_custkey "
               f"WHERE c_custkey % 19 <> 0")

# ---- a whole bundle in source form ---------------------------------------------------------------------------------------


@lru_cache
def coverage_columns() -> dict[str, str]:
    n = "_row_number"
    made = {"institution_type": "institution_type", "university": "university", "master_rows": f"CASE WHEN {n} % 7 = 0 THEN 'many' WHEN {n} % 5 = 0 THEN '0' WHEN {n} % 11 = 0 THEN '-1' ELSE {number('n')} END",
            "undergraduate_scope": f"CASE WHEN {n} % 4 = 0 THEN '対象外（大学院）' ELSE '' END", "research_status": f"CASE WHEN {n} % 6 = 0 THEN '対象外' ELSE 'open ' END",
            "checked_on": f"CASE WHEN {n} % 9 = 0 THEN '' WHEN {n} % 8 = 0 THEN 'late autumn' ELSE '2026-05-01' END",
            "official_source_url": f"CASE WHEN {n} % 2 = 0 THEN '' ELSE 'https://c.example/' END"}
    return {c: made.get(c, "''") for c in K.source_columns(K.COVERAGE)}


@lru_cache
def research_columns() -> dict[str, str]:
    """Details of orders, with orphans, blank ids, changed copies of the order's fields, and whole rows given twice."""
    m = master_columns()
    made = {"admission_id": "CASE WHEN l_orderkey % 53 = 0 THEN '' WHEN l_orderkey % 47 = 0 THEN 'Q' || " + number("l_orderkey") + " ELSE 'R' || " + number("l_orderkey") + " END",
            **{c: m[c] for c in K.DISPLAY_FIELDS}, "department": f"CASE WHEN l_partkey % 7 = 0 THEN 'other' ELSE {m['department']} END",
            "requirement_code": number("l_partkey"), "required_level": "l_returnflag", "requirement_detail": "CASE WHEN l_suppkey % 9 = 0 THEN ' padded' ELSE l_linestatus END",
            "source_url": "CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE 'https://r.example/' END", "verified_on": "CASE WHEN l_suppkey % 8 = 0 THEN 'soon' ELSE '2026-05-01' END"}
    return {c: made.get(c, "''") for c in K.source_columns(K.RESEARCH)}


_COVERED = f"SELECT source_dataset, institution_type, university, COUNT(*) AS n, MIN(_row_number) AS _row_number FROM ({B1}) m GROUP BY source_dataset, institution_type, university"
_COVERAGE = f"SELECT source_dataset, _row_number, {select_list(coverage_columns())} FROM ({_COVERED}) g"
BUNDLE_COVERAGE = f"{_COVERAGE} UNION ALL SELECT source_dataset, _row_number + 1000000000 AS _row_number, {', '.join(coverage_columns())} FROM ({_COVERAGE}) c WHERE _row_number % 13 = 0"
_LINE = "l_orderkey * 10 + l_linenumber"
_RESEARCH = f"SELECT {DATASET} AS source_dataset, {_LINE} AS _row_number, {select_list(research_columns())} FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey"
BUNDLE_RESEARCH = f"{_RESEARCH} UNION ALL SELECT source_dataset, _row_number + 1000000000 AS _row_number, {', '.join(research_columns())} FROM ({_RESEARCH}) r WHERE _row_number % 17 = 0"
# the flag that the children are held against is one of the tristate fields of the master
BUNDLE_MASTER = B1

# ---- B3: classified records --------------------------------------------------------------------------------------------

B3 = f"""SELECT {DATASET} AS source_dataset, {VERSION} AS source_version, 'R' || CAST(o_orderkey AS STRING) AS record_id, o_orderkey,
 c_name AS university, CASE WHEN o_orderkey % 2 = 1 THEN '私立' WHEN o_orderkey % 4 = 0 THEN '国立' ELSE '公立' END AS institution_type,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'F' || CAST(o_custkey % 3 AS STRING) END AS faculty_school,
 CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'D' || CAST(o_orderkey % 5 AS STRING) END AS department,
 'NATION_' || CAST(c_nationkey AS STRING) AS prefecture, c_nationkey,
 CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE c_mktsegment END AS academic_field,
 CASE o_orderkey % 3 WHEN 0 THEN '学校推薦型選抜' WHEN 1 THEN '総合型選抜' ELSE '一般選抜' END AS selection_category,
 o_orderpriority AS selection_name, o_orderstatus AS slot_type, CAST(o_orderkey % 40 AS STRING) AS capacity,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS stem_flag,
 CASE o_orderkey % 4 WHEN 0 THEN '専願' WHEN 1 THEN '併願可' WHEN 2 THEN '条件付き' ELSE '不明' END AS exclusive_enrollment_status,
 {", ".join(f"CASE WHEN o_orderkey % {5 + i} = 0 THEN NULL WHEN o_orderkey % {3 + i} = 0 THEN 'Unknown' WHEN o_orderkey % {2 + i} = 0 THEN 'Yes' ELSE 'No' END AS {f}"
            for i, f in enumerate(K.TRISTATE_FIELDS))},
 CASE WHEN o_orderkey % 5 = 0 THEN 'Conditional' WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS common_test_required,
 CASE o_orderkey % 5 WHEN 0 THEN 'required' WHEN 1 THEN 'relevant' WHEN 2 THEN 'none' WHEN 3 THEN 'unknown' ELSE NULL END AS research_activity_level_status,
 CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'G' || CAST(o_orderkey % 60 AS STRING) END AS gpa_requirement,
 CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderpriority END AS english_requirement,
 NULLIF({raw_date(0)}, '') AS application_start, NULLIF({raw_date(1)}, '') AS application_end,
 o_orderkey % 7 = 0 AS fallback_previous_year, CAST(2027 AS INT) AS admission_year,
 CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN EXTRACT(YEAR FROM o_orderdate) < 1996 THEN 2026 ELSE 2027 END AS INT) AS information_year,
 o_orderstatus AS publication_status,
 {", ".join(f"o_orderkey % {3 + i} = 0 AS {f}" for i, f in enumerate(("returnee_flag", "international_baccalaureate_flag", "private_foreign_student_flag", "adult_selection_flag")))}
 {ORDERS_CUSTOMER}"""

# numeric rule table and threshold crosswalk, derived from the sizes in part
RULES = """SELECT 'G' || CAST(p_size AS STRING) AS raw_value,
 CASE p_size % 3 WHEN 0 THEN 'safe_numeric' WHEN 1 THEN 'conditional_numeric' ELSE 'do_not_numeric' END AS distinct_tier,
 CASE p_size % 3 WHEN 0 THEN 'simple_overall_minimum'
  WHEN 1 THEN CASE p_size % 7 WHEN 0 THEN 'or_condition' WHEN 1 THEN 'overall_and_subject_compound' WHEN 2 THEN 'and_condition' WHEN 3 THEN 'subject_specific_condition'
   WHEN 4 THEN 'branch_condition' WHEN 5 THEN 'range_or_upper_condition' ELSE 'other_complex_numeric' END
  ELSE CASE p_size % 7 WHEN 0 THEN 'unknown' WHEN 1 THEN 'unresolved' WHEN 2 THEN 'explicit_no_numeric_threshold' WHEN 3 THEN 'non_numeric_condition'
   WHEN 4 THEN 'non_admission_or_inoperative_numeric' WHEN 5 THEN 'nonbinding_or_historical_numeric' ELSE 'something_else' END END AS primary_class,
 CASE WHEN p_size % 3 = 0 THEN 'numeric' WHEN p_size % 5 = 0 THEN 'historical;subject' WHEN p_size % 4 = 0 THEN 'and;or' WHEN p_size % 11 = 0 THEN 'subject' ELSE 'branch' END AS feature_flags,
 CASE WHEN p_size % 3 = 0 THEN CAST(CAST((p_size - p_size % 10) / 10 AS INT) AS STRING) || '.' || CAST(p_size % 10 AS STRING) ELSE '' END AS safe_gpa_min,
 '' AS safe_gpa_max, 'reviewed' AS review_status
 FROM (SELECT DISTINCT p_size FROM {part}) s"""

GRADE = """SELECT '0.3' AS contract_version, 'G' || CAST(p_size AS STRING) AS raw_value,
 CASE p_size % 3 WHEN 0 THEN 'required' WHEN 1 THEN 'not_required' ELSE 'review_required' END AS grade_requirement_status,
 CAST(CASE WHEN p_size % 3 = 0 THEN p_size END AS INT) AS overall_gpa_min_tenths,
 CASE WHEN p_size % 3 = 0 THEN TRUE END AS overall_gpa_min_inclusive,
 CASE WHEN p_size % 3 <> 0 THEN 'ambiguous' WHEN p_size % 2 = 0 THEN 'safe_overall_with_additional_conditions' ELSE 'safe_simple_overall' END AS overall_gpa_status,
 CASE WHEN p_size % 3 = 0 THEN p_size % 2 = 0 END AS additional_grade_conditions, 'note' AS review_note
 FROM (SELECT DISTINCT p_size FROM {part} WHERE p_size <= 45) s"""

ENGLISH = """SELECT '0.2' AS contract_version, o_orderpriority AS raw_value,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'required' WHEN '2-HIGH' THEN 'not_required' WHEN '3-MEDIUM' THEN 'review_required' ELSE 'unknown' END AS requirement_status,
 CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'to be checked' ELSE '' END AS review_note
 FROM (SELECT DISTINCT o_orderpriority FROM {orders} WHERE o_orderpriority <> '5-LOW') s"""

BROAD = "SELECT r_name AS group_code, CAST(r_regionkey + 1 AS INT) AS rank FROM {region}"
SUB = ("SELECT n_name AS subcategory_code, r_name AS parent_group_code, CAST(n_nationkey + 1 AS INT) AS rank FROM {nation} "
       "JOIN {region} ON n_regionkey = r_regionkey")

SEGMENT_STATUS = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'single' WHEN 'FURNITURE' THEN 'review_required' ELSE 'multi' END")
SEGMENTS = "(SELECT DISTINCT c_mktsegment FROM {customer} WHERE c_mktsegment <> 'MACHINERY') s"


def segment_regions(**keys: str) -> str:
    """Regions of each segment as rows, so that segments meet them in a plain equi-join."""
    return " UNION ALL ".join(f"SELECT '{seg}' AS seg, r_name, r_regionkey FROM {{region}} WHERE r_regionkey IN ({k})" for seg, k in keys.items())


# AUTOMOBILE one region, BUILDING two, HOUSEHOLD three, FURNITURE none (review), MACHINERY left out
FIELD_XW = f"""SELECT '0.2' AS mapping_contract_version, c_mktsegment AS raw_value, {SEGMENT_STATUS} AS mapping_status, r_name AS group_code,
 CASE WHEN r_name IS NULL THEN NULL WHEN c_mktsegment = 'AUTOMOBILE' THEN '1' WHEN c_mktsegment = 'BUILDING' THEN CASE r_regionkey WHEN 1 THEN '1' ELSE '2' END
  ELSE CASE r_regionkey WHEN 0 THEN '1' WHEN 2 THEN '2' ELSE '3' END END AS group_order,
 CASE WHEN c_mktsegment = 'FURNITURE' THEN 'needs review' ELSE '' END AS review_note
 FROM {SEGMENTS} LEFT JOIN ({segment_regions(AUTOMOBILE='0', BUILDING='1, 3', HOUSEHOLD='0, 2, 4')}) m ON c_mktsegment = seg"""

# two-level raw crosswalk: AUTOMOBILE -> region 0 with its nations below 10; BUILDING -> regions 1, 3 without nations;
# HOUSEHOLD -> region 2 with nation 2 and region 4 without
RAW_XW = f"""SELECT c_mktsegment AS raw_value, CASE c_mktsegment WHEN 'FURNITURE' THEN 'review_required' ELSE 'multi' END AS mapping_status,
 r_name AS group_code, n_name AS subcategory_code, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'needs review' ELSE 'raw note' END AS review_note
 FROM {SEGMENTS} LEFT JOIN ({segment_regions(AUTOMOBILE='0', BUILDING='1, 3', HOUSEHOLD='2, 4')}) m ON c_mktsegment = seg
 LEFT JOIN {{nation}} ON n_regionkey = r_regionkey AND ((c_mktsegment = 'AUTOMOBILE' AND n_nationkey < 10) OR (c_mktsegment = 'HOUSEHOLD' AND n_nationkey = 2))"""

# contexts that really occur for every 20th customer: authoritative or additive, some without memberships
CTX_XW = f"""SELECT DISTINCT {DATASET} AS source_dataset, c_name AS university,
 CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'F' || CAST(o_custkey % 3 AS STRING) END AS faculty_school,
 CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'D' || CAST(o_orderkey % 5 AS STRING) END AS department, c_mktsegment AS academic_field,
 CASE WHEN o_custkey % 60 = 0 THEN 'review_required' ELSE 'single' END AS mapping_status,
 CASE WHEN o_custkey % 40 = 0 THEN 'authoritative' ELSE 'additive' END AS merge_mode,
 CASE WHEN o_custkey % 60 = 0 THEN NULL ELSE r_name END AS group_code,
 CASE WHEN o_custkey % 60 = 0 OR o_custkey % 3 = 1 THEN NULL ELSE n_name END AS subcategory_code, 'context note' AS review_note
 FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
 WHERE o_custkey % 20 = 0 AND o_orderkey % 2 = 0"""

# memberships of an order: nations (and regions) of the suppliers of its lines
ORDER_NATIONS = ("SELECT DISTINCT l_orderkey AS o_orderkey, n_name, n_nationkey, r_name, r_regionkey FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey "
                 "JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey")
ORDER_REGIONS = ("SELECT DISTINCT l_orderkey AS o_orderkey, r_name, r_regionkey FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey "
                 "JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey")
# the same with a stored order, wrong for every 11th order
STORED_REGIONS = (f"SELECT o_orderkey, r_name AS group_code, r_regionkey, CAST(CASE WHEN o_orderkey % 11 = 0 THEN 6 - rn WHEN o_orderkey % 13 = 0 THEN rn + 1 ELSE rn END AS BIGINT) AS group_order "
                  f"FROM (SELECT o_orderkey, r_name, r_regionkey, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY r_regionkey) AS rn FROM ({ORDER_REGIONS}) q) w")
# floors with open and closed bounds
PARTS = """SELECT p_partkey, p_name, CAST(p_size AS INT) AS gpa_min_tenths, p_partkey % 2 = 0 AS gpa_min_inclusive,
 CAST(CASE WHEN p_partkey % 10 = 0 THEN LEAST(p_size + 10, 50) END AS INT) AS gpa_max_tenths, CASE WHEN p_partkey % 10 = 0 THEN p_partkey % 4 = 0 END AS gpa_max_inclusive,
 CASE p_type WHEN 'PROMO' THEN 'conditional_review' WHEN 'SMALL' THEN 'unparsed' ELSE 'parsed_safe' END AS gpa_parse_status, p_brand AS university, p_type FROM {part}"""

# ---- B4: two snapshots -------------------------------------------------------------------------------------------------

B4_OLD = ("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS price_cents, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate, "
          "o_orderkey % 7 = 0 AS fallback_previous_year, CAST(CASE WHEN o_orderkey % 6 = 0 THEN 2026 ELSE 2027 END AS INT) AS information_year "
          "FROM {orders} WHERE o_orderkey % 10 <> 3")
B4_NEW = ("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' WHEN o_orderkey % 8 = 1 THEN NULL ELSE o_orderstatus END AS o_orderstatus, "
          "CAST(ROUND(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 9 = 0 THEN 100 ELSE 0 END AS price_cents, "
          "CASE WHEN o_orderkey % 12 = 5 THEN '6-' || o_orderstatus ELSE o_orderpriority END AS o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate, "
          "o_orderkey % 11 = 0 AS fallback_previous_year, CAST(2027 AS INT) AS information_year FROM {orders} WHERE o_orderkey % 10 <> 7")
B4_CHILD_OLD = "SELECT l_orderkey, l_linenumber, l_returnflag FROM {lineitem} WHERE l_orderkey % 10 <> 3"
B4_CHILD_NEW = ("SELECT l_orderkey, CAST(CASE WHEN l_partkey % 9 = 0 THEN l_linenumber + 1 ELSE l_linenumber END AS INT) AS l_linenumber, l_returnflag "
                "FROM {lineitem} WHERE l_orderkey % 10 <> 7")

# ---- B7: queue, ledger, decisions --------------------------------------------------------------------------------------

EVENT_DAY = "CAST(CAST(ts AS DATE) AS STRING)"
QUEUE = f"""SELECT CASE WHEN event_id % 31 = 0 THEN '' WHEN event_id % 37 = 0 THEN 'UQ' || CAST(event_id - 1 AS STRING) ELSE 'UQ' || CAST(event_id AS STRING) END AS queue_id,
 '国立' AS institution_type, CASE WHEN event_id % 41 = 0 THEN '' ELSE 'U' || CAST(user_id AS STRING) END AS university, '' AS faculty_school, event_type AS selection_name, '' AS document_type,
 CASE event_type WHEN 'view' THEN '公開済' WHEN 'click' THEN '一部公開' WHEN 'purchase' THEN '公開予定' WHEN 'signup' THEN '未公開' ELSE '?' END AS publication_status,
 CASE WHEN event_id % 3 = 0 THEN '' ELSE 'winter' END AS release_expected_text,
 {EVENT_DAY} AS release_expected_from, CASE WHEN event_id % 5 = 0 THEN '2023-12-31' WHEN event_id % 7 = 0 THEN 'soon' ELSE '2024-12-31' END AS release_expected_to,
 '' AS release_schedule_url, {EVENT_DAY} AS last_checked_on, CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 29 = 0 THEN '2024-13-01' ELSE {EVENT_DAY} END AS next_check_on,
 '' AS actual_release_on,
 CASE event_id % 6 WHEN 0 THEN '待機' WHEN 1 THEN '確認時期到来' WHEN 2 THEN '更新必要' WHEN 3 THEN '更新中' WHEN 4 THEN '完了' ELSE 'later' END AS action_status,
 '' AS related_record_id, props AS notes FROM {{events}}"""
LEDGER = f"""SELECT 'kokkoritsu' AS source_dataset, '国立' AS institution_type, 'U' || CAST(user_id AS STRING) AS university, '' AS baseline_research_status,
 '1' AS baseline_master_rows, CASE WHEN user_id % 9 = 0 THEN '?' ELSE '再監査済' END AS reaudit_status,
 {", ".join(f"CASE WHEN user_id % {11 + i} = 0 THEN 'x' ELSE '実施済' END AS {c}" for i, c in enumerate(K.LEDGER_CHECKS))},
 {", ".join(f"CASE WHEN user_id % {7 + i} = 0 THEN '' WHEN user_id % {19 + i} = 0 THEN '-1' ELSE '0' END AS {c}" for i, c in enumerate(K.LEDGER_COUNTS[:3]))},
 CAST(n + CASE WHEN user_id % 13 = 0 THEN 1 ELSE 0 END AS STRING) AS update_queue_open_count,
 CASE WHEN user_id % 17 = 0 THEN '2024-02-30' ELSE '2024-02-28' END AS last_audited_on, '' AS notes
 FROM (SELECT user_id, SUM(CASE WHEN event_id % 6 <> 4 THEN 1 ELSE 0 END) AS n FROM {{events}} GROUP BY user_id) g WHERE user_id % 23 <> 0"""
# ledger with every 10th key given twice
LEDGER_TWICE = LEDGER + " UNION ALL " + LEDGER + " AND user_id % 10 = 0"
# one decision per action and payload, from the events that carry it; the checking engine numbers them with a window, this
# side with an operator
EVENT_RAW = "event_type || ':' || props"
PACKET_VALUES = f"""SELECT {EVENT_RAW} AS raw_or_context, COUNT(*) AS frequency, CAST(MIN(event_id) AS STRING) AS representative_record_id FROM {{events}} GROUP BY {EVENT_RAW}"""
PACKET = f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY raw_or_context) AS BIGINT) AS review_order, raw_or_context, frequency, representative_record_id FROM ({PACKET_VALUES}) g"""
DECISIONS = f"""SELECT review_order, raw_or_context AS raw_value, CAST(CASE WHEN review_order % 10 = 0 THEN frequency + 1 ELSE frequency END AS BIGINT) AS frequency,
 CASE WHEN review_order % 15 = 0 THEN '0' ELSE representative_record_id END AS representative_record_id,
 CASE review_order % 8 WHEN 0 THEN 'safe_simple_overall' WHEN 1 THEN 'safe_overall_with_additional_conditions' WHEN 2 THEN 'no_safe_overall_floor' WHEN 3 THEN 'non_binding'
  WHEN 4 THEN 'non_admission_numeric' WHEN 5 THEN 'historical' WHEN 6 THEN 'ambiguous' ELSE 'unknown' END AS approved_numeric_status,
 CASE WHEN review_order % 8 IN (0, 1) AND review_order % 9 <> 0 THEN 'required' ELSE 'not_required' END AS approved_grade_status,
 CASE WHEN review_order % 8 IN (0, 1) OR review_order % 21 = 0 THEN '3.' || CAST(review_order % 10 AS STRING) ELSE '' END AS approved_overall_floor,
 CASE WHEN review_order % 8 IN (0, 1) OR review_order % 21 = 0 THEN CAST(30 + review_order % 10 + CASE WHEN review_order % 7 = 0 THEN 1 ELSE 0 END AS STRING) ELSE '' END AS approved_overall_floor_tenths,
 CASE WHEN review_order % 8 = 0 OR review_order % 25 = 1 THEN 'false' ELSE 'true' END AS approved_additional_conditions,
 CASE review_order % 4 WHEN 0 THEN 'required' WHEN 1 THEN 'not_required' WHEN 2 THEN 'review_required' ELSE 'unknown' END AS requirement_status,
 'decided' AS review_note,
 CASE review_order % 3 WHEN 0 THEN 'AFRICA|EUROPE' WHEN 1 THEN 'ASIA' ELSE 'MIDDLE EAST|AMERICA|AMERICA' END AS broad_group_codes,
 CASE review_order % 3 WHEN 0 THEN 'NATION_5|NATION_0' WHEN 1 THEN '' ELSE 'NATION_6|NATION_9|NATION_1' END AS subcategory_codes
 FROM ({PACKET}) p"""
# previous crosswalk: the decisions of another event type, one left out
PREVIOUS = f"""SELECT '0.1' AS contract_version, raw_value, requirement_status, review_note FROM ({DECISIONS}) d WHERE raw_value LIKE 'view:%'"""
FRESH = f"""SELECT raw_value, requirement_status, review_note FROM ({DECISIONS}) d WHERE raw_value LIKE 'click:%' OR raw_value LIKE 'error:%'"""

# ---- B8: provisional against confirmed ---------------------------------------------------------------------------------

PROVISIONAL = """SELECT 'P' || CAST(s_suppkey AS STRING) AS provisional_id, n_name AS university, CASE WHEN s_suppkey % 2 = 0 THEN '国立' ELSE '私立' END AS institution_type,
 'S' || CAST(s_suppkey % 40 AS STRING) AS selection_name, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'F' || CAST(s_suppkey % 3 AS STRING) END AS faculty_school,
 CASE s_suppkey % 3 WHEN 0 THEN 'recommendation' WHEN 1 THEN 'comprehensive' ELSE 'other' END AS selection_family,
 CASE s_suppkey % 6 WHEN 0 THEN 'returnee' WHEN 1 THEN 'private_foreign_student' WHEN 2 THEN 'unclassified_international' WHEN 3 THEN 'adult' ELSE 'none' END AS special_filter_tag,
 CASE s_suppkey % 5 WHEN 0 THEN 'http://plain.example/a' WHEN 1 THEN 'https:///nohost' WHEN 2 THEN NULL ELSE 'https://ok.example/' || CAST(s_suppkey AS STRING) END AS official_source_url,
 CAST(NULL AS STRING) AS previous_year_source_url,
 CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Q' || CAST(s_suppkey AS STRING) END AS related_update_queue_id
 FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey"""
CONFIRMED = """SELECT n_name AS university, 'S' || CAST(c_custkey % 40 AS STRING) AS selection_name, 'F' || CAST(c_custkey % 3 AS STRING) AS faculty_school
 FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""
# queue entries the registry points to: some done, some of another university, some missing
REGISTRY_QUEUE = """SELECT 'Q' || CAST(s_suppkey AS STRING) AS queue_id, CASE WHEN s_suppkey % 7 = 0 THEN 'elsewhere' ELSE n_name END AS university,
 CASE WHEN s_suppkey % 5 = 0 THEN '完了' ELSE '待機' END AS action_status FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey WHERE s_suppkey % 11 <> 0"""

# ---- places, and the record with all layers ------------------------------------------------------------------------------

PLACE_XW = """SELECT '0.1' AS mapping_contract_version, n_name AS raw_value, CASE WHEN n_nationkey % 6 = 0 THEN 'multi' ELSE 'single' END AS mapping_status, r_name AS group_code,
 CAST(ROW_NUMBER() OVER (PARTITION BY n_nationkey ORDER BY r_regionkey) AS STRING) AS group_order, '' AS review_note
 FROM (SELECT n_nationkey, n_name, n_regionkey AS rk FROM {nation} UNION ALL SELECT n_nationkey, n_name, (n_regionkey + 1) % 5 FROM {nation} WHERE n_nationkey % 6 = 0) n
 JOIN {region} ON r_regionkey = rk WHERE n_nationkey <> 24"""


def catalogue(spark: SparkSession, sf: str, partitions: int | None = None) -> DataFrame:
    """The classified records that search, facets and documents work on.

    ``partitions`` spreads a source of few row groups over more tasks before the work on it.
    """
    records, *dims = [frame(spark, sf, s) for s in (B3, RULES, GRADE, ENGLISH, FIELD_XW, PLACE_XW, RAW_XW, CTX_XW, BROAD, SUB)]
    return classify_records(records.repartition(partitions, "record_id") if partitions else records, *dims)
