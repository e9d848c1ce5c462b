"""SEA operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as K
from ..operators import equivalence as E
from ..operators import ranked as R
from ..operators import search as S
from ..operators import textindex as T
from ..operators import views as V
from ..operators.search import SearchRequest
from ..sources.shared import settle
from . import bindings as B
from .classify_plans import CONTEXT_CTES, ENGLISH_SQL, GRADE_SQL, RULE_SQL, listing
from .join_plans import BRANCHES, arrays
from .registry import query


def f(spark, sf, sql) -> DataFrame:
    return B.frame(spark, sf, sql)


# ---- the same records for the checking engine: lists for memberships --------------------------------------------------------

ALL_CTES = f"""{CONTEXT_CTES.strip()},
ru AS ({RULE_SQL}), gr AS ({GRADE_SQL}), en AS (SELECT record_id, requirement_status, parse_status, search_disposition FROM ({ENGLISH_SQL}) q),
mu AS (SELECT raw_value, MIN(mapping_status) AS ms, list(group_code ORDER BY CAST(group_order AS INT)) FILTER (group_code IS NOT NULL) AS codes FROM fx GROUP BY raw_value),
pl AS (SELECT raw_value, MIN(mapping_status) AS ms, list(group_code ORDER BY CAST(group_order AS INT)) AS codes FROM px GROUP BY raw_value),
gl AS (SELECT record_id, list(code) AS codes FROM gb GROUP BY record_id), sl AS (SELECT record_id, list(code) AS codes FROM gs GROUP BY record_id),
s AS (SELECT b3.*, ru.parse_status AS gpa_parse_status, ru.search_disposition AS gpa_search_disposition, ru.source_value_status AS gpa_source_value_status, ru.gpa_min_tenths, ru.gpa_min_inclusive,
  gr.grade_requirement_status, gr.overall_gpa_min_tenths, gr.overall_gpa_min_inclusive, gr.overall_gpa_status, gr.additional_grade_conditions, gr.grade_parse_status,
  en.requirement_status AS english_requirement_status, en.parse_status AS english_parse_status, en.search_disposition AS english_search_disposition,
  CASE WHEN b3.academic_field IS NULL THEN 'not_applicable' ELSE COALESCE(mu.ms, 'unmapped') END AS academic_field_mapping_status, COALESCE(mu.codes, []) AS academic_field_groups,
  COALESCE(pl.ms, 'unmapped') AS prefecture_mapping_status, COALESCE(pl.codes, []) AS prefecture_memberships, COALESCE(gl.codes, []) AS broad_codes, COALESCE(sl.codes, []) AS subcategory_codes
  FROM b3 JOIN ru USING (record_id) JOIN gr USING (record_id) JOIN en USING (record_id) LEFT JOIN mu ON b3.academic_field = mu.raw_value LEFT JOIN pl ON b3.prefecture = pl.raw_value
  LEFT JOIN gl USING (record_id) LEFT JOIN sl USING (record_id)) """


def search_sql(body: str) -> str:
    return B.with_ctes(ALL_CTES + body, b3=B.B3, rl=B.RULES, gx=B.GRADE, e=B.ENGLISH, fx=B.FIELD_XW, px=B.PLACE_XW, rx=B.RAW_XW, cx=B.CTX_XW, bt=B.BROAD, st=B.SUB)


def words(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def safe_sql(v) -> str:
    return f"(gpa_parse_status = 'parsed_safe' AND (gpa_min_tenths < {v} OR (gpa_min_tenths = {v} AND gpa_min_inclusive)))"


def status_sql(v: int | None) -> str:
    first = (f"WHEN {safe_sql(v)} THEN 'safe match' WHEN gpa_parse_status = 'parsed_safe' THEN 'safe no match'" if v is not None
             else "WHEN gpa_parse_status = 'parsed_safe' THEN 'safe numeric rule (GPA not supplied)'")
    return f"CASE {first} WHEN gpa_parse_status = 'conditional_review' THEN 'conditional/review required' ELSE 'not numerically evaluable' END"


def deadline_sql(d: str) -> str:
    return (f"CASE WHEN fallback_previous_year OR application_end IS NULL OR NOT regexp_matches(application_end, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN 'unknown' "
            f"WHEN application_end >= '{d}' THEN 'match' ELSE 'exclude' END")


def applicant_sql(v: int) -> str:
    return (f"CASE WHEN fallback_previous_year THEN 'unknown' WHEN grade_requirement_status IN ('not_required', 'not_applicable') THEN 'match' "
            f"WHEN grade_requirement_status <> 'required' OR overall_gpa_status <> 'safe_simple_overall' OR additional_grade_conditions OR additional_grade_conditions IS NULL OR overall_gpa_min_tenths IS NULL THEN 'unknown' "
            f"WHEN {v} > overall_gpa_min_tenths OR ({v} = overall_gpa_min_tenths AND overall_gpa_min_inclusive) THEN 'match' ELSE 'exclude' END")


FLAGS = tuple(S.PROVISIONAL_TAGS)
FAMILY = "CASE WHEN selection_category LIKE '学校推薦型%' THEN 'recommendation' WHEN selection_category LIKE '総合型%' THEN 'comprehensive' ELSE 'other' END"


def where(r: SearchRequest) -> str:
    """The request in SQL, for the checking engine only."""
    p = [f"{c} IN ({words(v)})" for c, v in r.equals.items() if v] + [f"{c} = {v}" for c, v in r.flags.items()]
    if r.groups:
        p.append(f"list_has_any(academic_field_groups, [{words(r.groups)}])")
    if r.mapping_status:
        p.append(f"academic_field_mapping_status IN ({words(r.mapping_status)})")
    if r.places:
        p.append(f"list_has_any(prefecture_memberships, [{words(r.places)}])")
    if r.branches:
        p.append("(" + " OR ".join(f"(list_contains(broad_codes, '{g}')" + (f" AND list_has_any(subcategory_codes, [{words(ss)}])" if ss else "") + ")" for g, ss in r.branches) + ")")
    if r.english_status:
        p.append(f"english_requirement_status IN ({words(r.english_status)}) AND english_search_disposition = 'safe_exact'")
    if r.value_tenths is not None and r.value_mode == "safe":
        p.append(safe_sql(r.value_tenths))
    if r.value_tenths is not None and r.value_mode == "review":
        p.append(f"({safe_sql(r.value_tenths)} OR gpa_parse_status = 'conditional_review')")
    if r.grade_status is not None:
        p.append(f"grade_requirement_status = '{r.grade_status}'")
    if r.overall_tenths is not None:
        v = r.overall_tenths
        p.append(f"grade_parse_status = 'exact_crosswalk' AND (overall_gpa_min_tenths < {v} OR (overall_gpa_min_tenths = {v} AND overall_gpa_min_inclusive))")
    if r.deadline_from is not None:
        p.append(f"{deadline_sql(r.deadline_from)} <> 'exclude'")
    if r.applicant_tenths is not None:
        p.append(f"{applicant_sql(r.applicant_tenths)} <> 'exclude'")
    if r.special_flags is not None:
        p.append("(" + " OR ".join(r.special_flags) + ")" if r.special_flags else "NOT (" + " OR ".join(FLAGS) + ")")
        if not r.special_flags and r.families:
            p.append(f"{FAMILY} IN ({words(r.families)})")
    return " AND ".join(p) if p else "TRUE"


REQUESTS = ("SELECT c_custkey AS request_id, CASE WHEN c_custkey % 13 = 0 THEN 'NOWHERE' ELSE r_name END AS group_code, "
            "'NATION_' || CAST(c_nationkey AS STRING) || '|NATION_' || CAST(c_custkey % 27 AS STRING) AS subs FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey")


@query("sea02_check_requests", B.with_ctes("""
, x AS (SELECT request_id, group_code, unnest(string_split(subs, '|')) AS code FROM q)
SELECT request_id, 'unknown_group' AS issue, group_code AS code FROM q WHERE group_code NOT IN (SELECT group_code FROM bt)
UNION ALL SELECT request_id, CASE WHEN parent_group_code IS NULL THEN 'unknown_subcategory' ELSE 'subcategory_of_another_group' END, code
 FROM x LEFT JOIN st ON code = subcategory_code WHERE parent_group_code IS NULL OR parent_group_code <> x.group_code""", q=REQUESTS, bt=B.BROAD, st=B.SUB))
def sea02(spark, sf):
    requests = f(spark, sf, REQUESTS).withColumn("subcategory_codes", F.split("subs", r"\|"))
    return S.check_requests(requests, f(spark, sf, B.BROAD), f(spark, sf, B.SUB))


def b3_hits(name: str, req: SearchRequest):
    """A request that needs no derived layer."""
    @query(name, B.with_ctes(f"SELECT record_id, university FROM s WHERE {where(req)}", s=B.B3))
    def run(spark, sf):
        return S.search(f(spark, sf, B.B3), req).select("record_id", "university")
    return run


def hits(name: str, req: SearchRequest):
    @query(name, search_sql(f"SELECT record_id, university FROM s WHERE {where(req)}"))
    def run(spark, sf):
        return S.search(B.catalogue(spark, sf), req).select("record_id", "university")
    return run


b3_hits("sea03_exact_filter", SearchRequest(equals={
    "institution_type": ("国立", "私立"), "selection_name": ("1-URGENT", "3-MEDIUM"), "selection_interview": ("Yes", "Unknown"), "prefecture": ("NATION_1", "NATION_2", "NATION_9"),
    "research_activity_level_status": ("required", "relevant", "none")}, exact_fields=(*K.EXACT_FILTER_FIELDS, "selection_name")))
@query("sea11_page_after", B.with_ctes("""
SELECT university, record_id FROM s, (SELECT university AS u, record_id AS r FROM s ORDER BY u, r LIMIT 1 OFFSET 700) l WHERE (university, record_id) > (u, r) ORDER BY university, record_id LIMIT 50""", s=B.B3))
def sea11_after(spark, sf):
    df = f(spark, sf, B.B3).select("university", "record_id")
    last = df.orderBy("university", "record_id").offset(700).limit(1).first()
    return S.page_after(df, ["university", "record_id"], 50, last)


b3_hits("sea04_boolean_filter", SearchRequest(flags={"stem_flag": False}, equals={"common_test_required": ("No", "Conditional")}))
hits("sea05_status_filter", SearchRequest(english_status=("required", "not_required"), mapping_status=("single", "multi")))
MODES = ("safe", "review", "all")
PART_SAFE = ("(gpa_parse_status = 'parsed_safe' AND (38 > gpa_min_tenths OR (38 = gpa_min_tenths AND gpa_min_inclusive)) "
             "AND (gpa_max_tenths IS NULL OR 38 < gpa_max_tenths OR (38 = gpa_max_tenths AND gpa_max_inclusive)))")


@query("sea06_threshold_modes", B.with_ctes(f"""
SELECT 'safe' AS mode, p_partkey FROM p WHERE {PART_SAFE} UNION ALL SELECT 'review', p_partkey FROM p WHERE {PART_SAFE} OR gpa_parse_status = 'conditional_review' UNION ALL SELECT 'all', p_partkey FROM p""", p=B.PARTS))
def sea06(spark, sf):
    parts = f(spark, sf, B.PARTS)
    modes = F.array_compact(F.array(*[F.when(S.threshold_filter(38, m), F.lit(m)) for m in MODES]))
    return parts.select(F.explode(modes).alias("mode"), "p_partkey")


hits("sea07_floor_filter", SearchRequest(grade_status="required", overall_tenths=24))


@query("sea08_threshold_search", B.with_ctes(f"""
SELECT university, p_partkey, gpa_min_tenths, CAST((SELECT COUNT(*) FROM p WHERE {PART_SAFE}) AS BIGINT) AS total_matches FROM p WHERE {PART_SAFE} ORDER BY university, p_partkey LIMIT 20""", p=B.PARTS))
def sea08(spark, sf):
    return S.threshold_search(f(spark, sf, B.PARTS), 38, ["university", "p_partkey"], 20).select("university", "p_partkey", "gpa_min_tenths", "total_matches")


@query("sea09_threshold_status", B.with_ctes(f"""
SELECT p_partkey, CASE WHEN {PART_SAFE} THEN 'safe match' WHEN gpa_parse_status = 'parsed_safe' THEN 'safe no match' WHEN gpa_parse_status = 'conditional_review' THEN 'conditional/review required' ELSE 'not numerically evaluable' END AS with_value,
 {status_sql(None)} AS without_value FROM p""", p=B.PARTS))
def sea09(spark, sf):
    return f(spark, sf, B.PARTS).select("p_partkey", S.threshold_status(38).alias("with_value"), S.threshold_status(None).alias("without_value"))


PROJECTED = SearchRequest(value_tenths=27, value_mode="review", groups=("AFRICA", "ASIA"))


def result_sql(r: SearchRequest) -> str:
    special = {"gpa_derived_status": status_sql(r.value_tenths), "academic_field_groups": "CASE WHEN len(academic_field_groups) > 0 THEN array_to_string(academic_field_groups, ',') END"}
    return ", ".join(f"{special.get(c, c)} AS {c}" for c in S.RESULT_COLUMNS)


@query("sea10_result_projection", search_sql(f"SELECT {result_sql(PROJECTED)} FROM s WHERE {where(PROJECTED)}"))
def sea10(spark, sf):
    return S.project_result(S.search(B.catalogue(spark, sf), PROJECTED), PROJECTED)


ORDER_SQL = ", ".join(f"{c} NULLS FIRST" for c in S.SEARCH_ORDER)


@query("sea11_page", B.with_ctes(f"SELECT record_id, university, faculty_school, department FROM s ORDER BY {ORDER_SQL} LIMIT 50 OFFSET 100", s=B.B3))
def sea11(spark, sf):
    return S.page(f(spark, sf, B.B3), limit=50, offset=100).select("record_id", "university", "faculty_school", "department")


DOC_ORDER_SQL = ", ".join(f"COALESCE({c}, '')" for c in S.DOCUMENT_ORDER)


@query("sea11_document_page", B.with_ctes(f"SELECT record_id, prefecture, university, faculty_school FROM s ORDER BY {DOC_ORDER_SQL} LIMIT 40 OFFSET 7", s=B.B3))
def sea11_document(spark, sf):
    return S.page(f(spark, sf, B.B3), S.DOCUMENT_ORDER, 40, 7, blank_nulls=True).select("record_id", "prefecture", "university", "faculty_school")


SUMMARY = SearchRequest(equals={"institution_type": ("国立", "公立", "私立")}, branches=(("AFRICA", ("NATION_5",)), ("ASIA", ()), ("EUROPE", ())), value_tenths=27, value_mode="all")


def summary_body(r: SearchRequest) -> str:
    safe = (f"CAST(COUNT(*) FILTER ({safe_sql(r.value_tenths)}) AS BIGINT) AS safe_match_rows, CAST(COUNT(*) FILTER (gpa_parse_status = 'parsed_safe' AND NOT COALESCE({safe_sql(r.value_tenths)}, FALSE)) AS BIGINT) AS safe_no_match_rows"
            if r.value_tenths is not None else "CAST(NULL AS BIGINT) AS safe_match_rows, CAST(NULL AS BIGINT) AS safe_no_match_rows")
    return (f"SELECT CAST(COUNT(*) AS BIGINT) AS total_matched_rows, {safe}, CAST(COUNT(*) FILTER (gpa_parse_status = 'parsed_safe') AS BIGINT) AS safe_numeric_rule_rows, "
            f"CAST(COUNT(*) FILTER (gpa_parse_status = 'conditional_review') AS BIGINT) AS conditional_review_rows, "
            f"CAST(COUNT(*) FILTER (gpa_parse_status NOT IN ('parsed_safe', 'conditional_review')) AS BIGINT) AS not_evaluable_rows, CAST(COUNT(DISTINCT university) AS BIGINT) AS group_count FROM s WHERE {where(r)}")


@query("sea12_summary", search_sql(summary_body(SUMMARY)))
def sea12(spark, sf):
    return S.summarize(B.catalogue(spark, sf), SUMMARY)


EMPTY = SearchRequest(equals={"university": ("nobody",)})


@query("sea12_summary_empty", search_sql(summary_body(EMPTY)))
def sea12_empty(spark, sf):
    return S.summarize(B.catalogue(spark, sf), EMPTY)


@query("sea12_rows_by_dataset", search_sql(f"SELECT source_dataset, CAST(COUNT(*) AS BIGINT) AS rows FROM s WHERE {where(SUMMARY)} GROUP BY source_dataset"))
def sea12_dataset(spark, sf):
    return S.rows_by_dataset(B.catalogue(spark, sf), SUMMARY)


@query("sea13_deadline", B.with_ctes(f"SELECT record_id, {deadline_sql('1998-06-15')} AS status FROM s WHERE {deadline_sql('1998-06-15')} <> 'exclude'", s=B.B3))
def sea13(spark, sf):
    df = S.search(f(spark, sf, B.B3), SearchRequest(deadline_from="1998-06-15"))
    return df.select("record_id", S.deadline_status("1998-06-15").alias("status"))


@query("sea14_applicant", search_sql(f"SELECT record_id, {applicant_sql(24)} AS status FROM s"))
def sea14(spark, sf):
    return B.catalogue(spark, sf).select("record_id", S.applicant_status(24).alias("status"))


b3_hits("sea15_flag_filter", SearchRequest(special_flags=("returnee_flag", "adult_selection_flag")))
b3_hits("sea15_no_flag_filter", SearchRequest(special_flags=()))
b3_hits("sea16_family_filter", SearchRequest(special_flags=(), families=("comprehensive",)))


@query("sea17_collation_page", "SELECT c_name, c_custkey FROM customer ORDER BY c_name, c_custkey LIMIT 30 OFFSET 20")
def sea17(spark, sf):
    return S.page(B.table(spark, sf, "customer"), ["c_name", "c_custkey"], 30, 20, collation="ja").select("c_name", "c_custkey")


#: directories of a stored table; small tables need few
DIRS = 8
_BUILT: dict[tuple, tuple] = {}


def built(spark, sf, name: str, build):
    """A stored table of this session: written when first asked for, opened from then on."""
    key = (id(spark), sf, name)
    owner, made = _BUILT.get(key, (None, None))
    if owner is not spark:
        made = build(f"{B.scratch(spark)}/{name}")
        _BUILT[key] = (spark, made)
    return made


RANKED = ("record_id", "university", "faculty_school", "department")


def deep(total: int) -> int:
    return total * 2 // 3


def page_sql(order: str) -> str:
    return (f"SELECT record_id, university, faculty_school, department, CAST(n * 2 // 3 + ROW_NUMBER() OVER () - 1 AS BIGINT) AS rank FROM "
            f"(SELECT *, (SELECT COUNT(*) FROM s) AS n FROM s ORDER BY {order} LIMIT 40 OFFSET (SELECT COUNT(*) * 2 // 3 FROM s)) q")


@query("sea11_by_rank", B.with_ctes(page_sql(ORDER_SQL), s=B.B3))
def sea11_rank(spark, sf):
    """A page two thirds down the order, from the stored ranks."""
    table = built(spark, sf, "ranked", lambda path: R.build_ranked(f(spark, sf, B.B3), path, ranges=DIRS))
    return table.page(deep(table.rows), 40).select(*RANKED, "rank")


# names of one alphabet in one case sort alike by the collation and by their bytes
@query("sea17_by_rank", B.with_ctes(page_sql("university, record_id"), s=B.B3))
def sea17_rank(spark, sf):
    table = built(spark, sf, "collated", lambda path: R.build_ranked(f(spark, sf, B.B3), path, ("university", "record_id"), collation="ja", ranges=DIRS))
    return table.page(deep(table.rows), 40).select(*RANKED, "rank")


DISCOVER = SearchRequest(equals={"institution_type": ("国立",)}, families=("recommendation", "comprehensive"))
DISCOVER_FLAG = SearchRequest(special_flags=("private_foreign_student_flag", "returnee_flag"), grade_status="required")
KEPT = ("NOT EXISTS (SELECT 1 FROM c WHERE c.university = p.university AND c.selection_name = p.selection_name AND (p.faculty_school IS NULL OR c.faculty_school = p.faculty_school))")


@query("sea18_discover", B.with_ctes(f"""
SELECT 'families' AS request, provisional_id, FALSE AS unverified FROM p WHERE {KEPT} AND institution_type = '国立'
 AND ((special_filter_tag = 'none' AND selection_family IN ('recommendation', 'comprehensive')) OR special_filter_tag = 'unclassified_international')
UNION ALL SELECT 'flags', provisional_id, TRUE FROM p WHERE {KEPT} AND special_filter_tag IN ('private_foreign_student', 'unclassified_international', 'returnee')""", p=B.PROVISIONAL, c=B.CONFIRMED))
def sea18(spark, sf):
    p, c = f(spark, sf, B.PROVISIONAL), f(spark, sf, B.CONFIRMED)
    one = S.discover(p, DISCOVER, c).select(F.lit("families").alias("request"), "provisional_id", "unverified")
    return one.unionByName(S.discover(p, DISCOVER_FLAG, c).select(F.lit("flags").alias("request"), "provisional_id", "unverified"))


PHRASE = "icens"


@query("sea19_text_contains", f"SELECT doc_id FROM documents WHERE contains(text, '{PHRASE}') OR contains(source, '{PHRASE}')")
def sea19(spark, sf):
    return S.contains_any(B.table(spark, sf, "documents"), ["text", "source"], PHRASE).select("doc_id")


@query("sea19_trigram_search", f"SELECT doc_id FROM documents WHERE contains(text, '{PHRASE}') OR contains(source, '{PHRASE}')")
def sea19_trigrams(spark, sf):
    docs = B.table(spark, sf, "documents")
    return S.trigram_search(docs, S.build_trigrams(docs, "doc_id", ["text", "source"]), "doc_id", ["text", "source"], PHRASE).select("doc_id")


# phrases of every kind: in many texts, in few, in one word, over a space, shorter than a trigram, in none
PHRASES = ("icens", "the ", "al", "e lic", "qzx", "ersion 2", "doc", "übe")
PHRASE_ROWS = ", ".join(f"('{p}')" for p in PHRASES)
RECORD_PHRASES = ("#000000123", "HOUSEHOLD", "1-URG", "G17", "F2", "nothing like it", "D4")
RECORD_ROWS = ", ".join(f"('{p}')" for p in RECORD_PHRASES)


def text_index(spark, sf) -> T.TextIndex:
    return built(spark, sf, "text-index", lambda path: T.build_index(B.table(spark, sf, "documents"), "doc_id", ["text", "source", "lang"], path, DIRS, DIRS))


@query("sea19_text_index", f"""
SELECT phrase, doc_id FROM documents, (VALUES {PHRASE_ROWS}) p(phrase) WHERE contains(text, phrase) OR contains(source, phrase) OR contains(lang, phrase)""")
def sea19_index(spark, sf):
    return text_index(spark, sf).find(PHRASES)


@query("sea19_record_index", B.with_ctes(f"""
SELECT phrase, o_orderkey FROM b1, (VALUES {RECORD_ROWS}) p(phrase) WHERE {" OR ".join(f"contains({c}, phrase)" for c in K.TEXT_FIELDS)}""", b1=B.B1.replace(" AS _row_number", " AS o_orderkey, o_orderkey AS _row_number", 1)))
def sea19_records(spark, sf):
    """All 20 text fields of the records."""
    records = f(spark, sf, B.B1).withColumnRenamed("_row_number", "o_orderkey")
    return built(spark, sf, "record-index", lambda path: T.build_index(records, "o_orderkey", K.TEXT_FIELDS, path, DIRS, DIRS)).find(RECORD_PHRASES)


@query("sea20_suggest", "SELECT DISTINCT c_name FROM customer WHERE contains(lower(c_name), '#00000012') ORDER BY c_name LIMIT 8")
def sea20(spark, sf):
    return S.suggest(B.table(spark, sf, "customer"), "c_name", "#00000012", 8)


# ---- saved suite ------------------------------------------------------------------------------------------------------------

Y = ("Yes",)
SUITE: list[tuple[str, SearchRequest]] = [
    ("place and stem", SearchRequest(equals={"prefecture": ("NATION_1",)}, flags={"stem_flag": True})),
    ("place, stem, value", SearchRequest(equals={"prefecture": ("NATION_1", "NATION_2", "NATION_3")}, flags={"stem_flag": True}, value_tenths=38, value_mode="safe")),
    ("place, stem, value, activity", SearchRequest(equals={"research_activity_level_status": ("required", "relevant")}, flags={"stem_flag": True}, value_tenths=38, value_mode="safe")),
    ("two places, not exclusive", SearchRequest(equals={"prefecture": ("NATION_4", "NATION_9"), "exclusive_enrollment_status": ("併願可",)})),
    ("recommendation needed", SearchRequest(equals={"selection_category": ("学校推薦型選抜",), "school_recommendation_required": Y})),
    ("no common test", SearchRequest(equals={"common_test_required": ("No",)})),
    ("oral exam", SearchRequest(equals={"selection_oral_exam": Y})),
    ("presentation", SearchRequest(equals={"selection_presentation": Y})),
    ("interview and essay", SearchRequest(equals={"selection_interview": Y, "selection_essay": Y})),
    *[(f"value {v / 10} safe", SearchRequest(value_tenths=v, value_mode="safe")) for v in (9, 27, 30, 35, 38, 40, 45)],
    ("value 3.8 review", SearchRequest(value_tenths=38, value_mode="review")),
    ("value 3.8 all", SearchRequest(value_tenths=38, value_mode="all")),
    ("public with research", SearchRequest(equals={"institution_type": ("国立", "公立"), "research_requirement_required": Y})),
    ("private, no common test, not exclusive", SearchRequest(equals={"institution_type": ("私立",), "common_test_required": ("No",), "exclusive_enrollment_status": ("併願可",)})),
    ("groups and value", SearchRequest(groups=("ASIA", "EUROPE"), value_tenths=40, value_mode="safe")),
    ("review values", SearchRequest(mapping_status=("review_required",))),
    ("unmapped values", SearchRequest(mapping_status=("unmapped",))),
    ("broad branch", SearchRequest(branches=(("AFRICA", ()),))),
    ("subcategory branch", SearchRequest(branches=(("AFRICA", ("NATION_0", "NATION_5")),))),
    ("two branches", SearchRequest(branches=(("AFRICA", ("NATION_0",)), ("AMERICA", ())))),
    ("english required", SearchRequest(english_status=("required",))),
    ("english not required", SearchRequest(english_status=("not_required",))),
    ("places by membership", SearchRequest(places=("ASIA", "AMERICA"))),
    ("grade required", SearchRequest(grade_status="required")),
    ("grade floor 3.0", SearchRequest(grade_status="required", overall_tenths=30)),
    ("nothing", SearchRequest(equals={"university": ("nobody",)})),
    ("everything", SearchRequest()),
]


def suite_sql(body: str) -> str:
    lines = " UNION ALL ".join(
        f"SELECT '{label}' AS label, source_dataset, university, {'COALESCE(' + safe_sql(r.value_tenths) + ', FALSE)' if r.value_tenths is not None else 'CAST(NULL AS BOOLEAN)'} AS safe, "
        f"gpa_parse_status = 'conditional_review' AS cond, COALESCE({where(r)}, FALSE) AS hit FROM sm" for label, r in SUITE)
    return search_sql(f", sm AS MATERIALIZED (SELECT * FROM s), t AS ({lines}) {body}")


SUITE_COUNTS = ("CAST(COUNT(*) FILTER (hit) AS BIGINT) AS total, CASE WHEN BOOL_AND(safe IS NULL) THEN NULL ELSE CAST(COUNT(*) FILTER (hit AND safe) AS BIGINT) END AS safe_match_rows, "
                "CAST(COUNT(*) FILTER (hit AND cond) AS BIGINT) AS conditional_rows, CAST(COUNT(DISTINCT CASE WHEN hit THEN university END) AS BIGINT) AS groups")


@query("sea21_suite", suite_sql(f"SELECT label, CAST(NULL AS VARCHAR) AS dataset, {SUITE_COUNTS} FROM t GROUP BY label UNION ALL SELECT label, source_dataset, {SUITE_COUNTS} FROM t GROUP BY label, source_dataset"))
def sea21(spark, sf):
    return S.run_suite(B.catalogue(spark, sf), SUITE)


@query("sea22_equivalence", B.with_ctes("""
SELECT CAST(COUNT(*) AS BIGINT) AS rows_a, CAST(COUNT(*) AS BIGINT) AS rows_b, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b FROM orders o
WHERE EXISTS (SELECT 1 FROM m WHERE m.o_orderkey = o.o_orderkey AND r_name = 'AFRICA' AND n_name IN ('NATION_5', 'NATION_10')) OR EXISTS (SELECT 1 FROM m WHERE m.o_orderkey = o.o_orderkey AND r_name = 'EUROPE')""", m=B.ORDER_NATIONS))
def sea22(spark, sf):
    orders = B.table(spark, sf, "orders").select("o_orderkey")
    joined = V.branch_semi(orders, f(spark, sf, B.ORDER_REGIONS), f(spark, sf, B.ORDER_NATIONS), BRANCHES, ["o_orderkey"], "r_name", "n_name", "r_name")
    return S.compare_results(joined, arrays(spark, sf).where(V.branch_predicate(BRANCHES, "regions", "nations")), ["o_orderkey"])


# the stored membership tables lack the members of every 50th record, and give every 77th one place too many
LISTS = {"groups": "academic_field_groups", "places": "prefecture_memberships", "broad": "broad_codes", "sub": "subcategory_codes"}
LOST = ", ".join(f"CASE WHEN o_orderkey % 50 = 0 THEN [] {'WHEN o_orderkey % 77 = 0 THEN list_append(' + c + ', ' + repr('AMERICA') + ') ' if k == 'places' else ''}ELSE {c} END AS {c}" for k, c in LISTS.items())


#: what the predicates of a suite may ask for besides the fields that a request names
ASKED = ("academic_field_mapping_status", "english_requirement_status", "english_search_disposition", "gpa_parse_status", *E.BOUNDS, "grade_requirement_status",
         "grade_parse_status", "overall_gpa_min_tenths", "overall_gpa_min_inclusive")


def suite_records(spark, sf) -> DataFrame:
    """The catalogue as far as the suite and the member tables read it, classified and written once for all of them."""
    named = [c for _, r in SUITE for c in (*r.equals, *r.flags)]
    return settle(B.catalogue(spark, sf).select(*dict.fromkeys(["record_id", "o_orderkey", "university", *named, *ASKED, *LISTS.values()])), "records")


def member_tables(records: DataFrame) -> dict[str, DataFrame]:
    kept = records.where("o_orderkey % 50 <> 0")
    tables = {k: kept.select("record_id", F.explode(c).alias("code")) for k, c in LISTS.items()}
    extra = records.where("o_orderkey % 77 = 0 AND o_orderkey % 50 <> 0").select("record_id", F.lit("AMERICA").alias("code"))
    return {**tables, "places": tables["places"].unionByName(extra)}


def both_sql(body: str) -> str:
    lines = lambda src: " UNION ALL ".join(
        f"SELECT '{label}' AS label, {'TRUE' if r.value_tenths is not None else 'FALSE'} AS valued, record_id, university, gpa_parse_status AS st, "
        f"{'COALESCE(' + safe_sql(r.value_tenths) + ', FALSE)' if r.value_tenths is not None else 'FALSE'} AS safe FROM {src} WHERE {where(r)}" for label, r in SUITE)
    names = ", ".join(f"('{label}', {'TRUE' if r.value_tenths is not None else 'FALSE'})" for label, r in SUITE)
    return search_sql(f", sm AS MATERIALIZED (SELECT * FROM s), s2 AS MATERIALIZED (SELECT * REPLACE ({LOST}) FROM sm), nm(label, valued) AS (VALUES {names}), "
                      f"a AS ({lines('sm')}), b AS ({lines('s2')}), o AS (SELECT label, record_id, a.safe IS NULL AS lost FROM a FULL JOIN b USING (label, record_id) WHERE a.safe IS NULL OR b.safe IS NULL) {body}")


SIDE = ("CAST(COUNT(label) AS BIGINT) AS n, CAST(COUNT(*) FILTER (safe) AS BIGINT) AS safe, CAST(COUNT(*) FILTER (st = 'parsed_safe' AND NOT safe) AS BIGINT) AS miss, "
        "CAST(COUNT(*) FILTER (st = 'parsed_safe') AS BIGINT) AS rule, CAST(COUNT(*) FILTER (st = 'conditional_review') AS BIGINT) AS review, CAST(COUNT(DISTINCT university) AS BIGINT) AS groups")


@query("sea22_suite", both_sql(f""", x AS (SELECT nm.label, {SIDE.replace('COUNT(label)', 'COUNT(a.label)')} FROM nm LEFT JOIN a USING (label) GROUP BY nm.label)
, y AS (SELECT nm.label, {SIDE.replace('COUNT(label)', 'COUNT(b.label)')} FROM nm LEFT JOIN b USING (label) GROUP BY nm.label)
SELECT label, x.n AS rows_a, y.n AS rows_b, label NOT IN (SELECT label FROM o) AS same_keys, x = y AS same_summary,
 CASE WHEN valued THEN x.safe END AS safe_match_rows, CASE WHEN valued THEN x.miss END AS safe_no_match_rows, x.rule AS safe_numeric_rule_rows, x.review AS conditional_review_rows,
 x.n - x.rule - x.review AS not_evaluable_rows, x.groups AS group_count FROM nm JOIN x USING (label) JOIN y USING (label)"""))
def sea22_suite(spark, sf):
    """All saved queries in both forms; the planted rows make those differ that ask for members."""
    records = suite_records(spark, sf)
    return E.suite_equivalence(records, member_tables(records), ["record_id"], SUITE)


@query("sea22_differences", both_sql("SELECT label, record_id, CASE WHEN lost THEN 'join' ELSE 'array' END AS side FROM o"))
def sea22_differences(spark, sf):
    records = suite_records(spark, sf)
    return E.suite_differences(records, member_tables(records), ["record_id"], SUITE)


EXAMPLE = {"o_orderstatus": "F", "o_orderpriority": "2-HIGH", "fallback_previous_year": False}
NULL_EXAMPLE = {"o_orderstatus": None, "o_orderpriority": "1-URGENT"}


@query("sea24_like_record", B.with_ctes("""
SELECT 'given' AS example, (SELECT CAST(COUNT(*) AS BIGINT) FROM n WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AND NOT fallback_previous_year) AS rows,
 (SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FROM (SELECT o_orderkey FROM n WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AND NOT fallback_previous_year ORDER BY 1 LIMIT 3) q) AS first_ids
UNION ALL SELECT 'null', (SELECT CAST(COUNT(*) AS BIGINT) FROM n WHERE o_orderstatus IS NULL AND o_orderpriority = '1-URGENT'),
 (SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FROM (SELECT o_orderkey FROM n WHERE o_orderstatus IS NULL AND o_orderpriority = '1-URGENT' ORDER BY 1 LIMIT 3) q)""", n=B.B4_NEW))
def sea24(spark, sf):
    df = f(spark, sf, B.B4_NEW)
    out = lambda name, e: S.like_record(df, e, list(e), "o_orderkey").select(F.lit(name).alias("example"), "rows", F.array_join("first_ids", ",").alias("first_ids"))
    return out("given", EXAMPLE).unionByName(out("null", NULL_EXAMPLE))
