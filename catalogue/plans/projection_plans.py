"""PRJ operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as K
from ..functions import columns as P
from ..operators import unify as U
from . import bindings as B
from .registry import query

ROW = "_row_number AS k"


def b1(spark, sf, *cols):
    return B.frame(spark, sf, B.B1).select(F.col("_row_number").alias("k"), *cols)


def sql(select: str, src: str = B.B1) -> str:
    return B.with_ctes(f"SELECT _row_number AS k, {select} FROM b1", b1=src)


def values(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


@query("prj01_null_if_blank", sql("NULLIF(notes, '') AS notes, NULLIF(faculty_school, '') AS faculty_school, NULLIF(department, '') AS department"))
def prj01(spark, sf):
    return b1(spark, sf, *[P.null_if_blank(c).alias(c) for c in ("notes", "faculty_school", "department")])


@query("prj02_strict_int", sql("CASE WHEN regexp_matches(information_year, '^-?[0-9]+$') THEN CAST(information_year AS BIGINT) END AS information_year, "
                               "CASE WHEN regexp_matches(admission_year, '^-?[0-9]+$') THEN CAST(admission_year AS BIGINT) END AS admission_year"))
def prj02(spark, sf):
    return b1(spark, sf, *[P.strict_int(c).alias(c) for c in ("information_year", "admission_year")])


@query("prj03_strict_bool", sql(", ".join(
    f"CASE WHEN {c} IN ('True', 'Yes') THEN TRUE WHEN {c} IN ('False', 'No') THEN FALSE END AS {c}" for c in K.BOOLEAN_FIELDS)))
def prj03(spark, sf):
    return b1(spark, sf, *[P.strict_bool(c).alias(c) for c in K.BOOLEAN_FIELDS])


@query("prj04_state_enum", sql(
    "CASE WHEN common_test_required = '条件付き' THEN 'Conditional' WHEN common_test_required IN ('Yes', 'No', 'Unknown') THEN common_test_required END AS common_test_required, "
    "CASE WHEN selection_interview IN ('Yes', 'No', 'Unknown') THEN selection_interview END AS selection_interview"))
def prj04(spark, sf):
    return b1(spark, sf, P.state_enum("common_test_required", K.TRISTATE, K.QUADSTATE_RENAME).alias("common_test_required"),
              P.state_enum("selection_interview", K.TRISTATE).alias("selection_interview"))


PRJ05 = ("CASE WHEN detail_completeness = '' THEN NULL WHEN source_dataset = 'shidai' AND detail_completeness IN ('complete', 'partial', 'pending', 'unknown') THEN detail_completeness "
         "WHEN source_dataset = 'kokkoritsu' AND starts_with(detail_completeness, 'detailed') THEN 'complete' "
         "WHEN source_dataset = 'kokkoritsu' AND starts_with(detail_completeness, 'partial') THEN 'partial' ELSE 'unmapped' END")
PRJ06 = ("CASE WHEN research_activity_level = '' THEN NULL WHEN source_dataset = 'shidai' AND research_activity_level IN ('required', 'relevant', 'none', 'unknown') THEN research_activity_level "
         "WHEN source_dataset = 'kokkoritsu' THEN CASE WHEN research_activity_level IN ('explicit_requirement', '探究活動必須', '必須（指定実績のいずれか）', '関連する課外活動実績が出願要件') THEN 'required' "
         "WHEN research_activity_level IN ('relevant', 'related', 'explicitly_evaluated', '探究活動重視', '研究活動重視') THEN 'relevant' WHEN research_activity_level IN ('none', 'なし') THEN 'none' "
         "WHEN research_activity_level = 'not_specified' THEN 'unknown' ELSE 'unmapped' END ELSE 'unmapped' END")


@query("prj05_prefix_map", sql(f"{PRJ05} AS detail_completeness_status"))
def prj05(spark, sf):
    return (B.frame(spark, sf, B.B1).select(F.col("_row_number").alias("k"), P.detail_status().alias("detail_completeness_status")))


@query("prj06_value_map", sql(f"{PRJ06} AS research_activity_level_status"))
def prj06(spark, sf):
    return (B.frame(spark, sf, B.B1).select(F.col("_row_number").alias("k"), P.research_status().alias("research_activity_level_status")))


@query("prj07_raw_companion", sql(f"source_dataset, {PRJ05} AS detail_completeness_status, NULLIF(detail_completeness, '') AS detail_completeness_raw"))
def prj07(spark, sf):
    df = b1(spark, sf, "source_dataset", "detail_completeness")
    return P.with_raw_companion(df, "detail_completeness", P.detail_status())


def adapted(c: str) -> str:
    if c in ("source_dataset", "source_version"):
        return c
    if c == "research_activity_level_status":
        return f"{PRJ06} AS {c}"
    if c == "detail_completeness_status":
        return f"{PRJ05} AS {c}"
    if c.endswith("_raw"):
        return f"NULLIF({c[:-4]}, '') AS {c}"
    if c in K.INTEGER_FIELDS:
        return f"CAST(NULLIF({c}, '') AS INT) AS {c}"
    if c in K.BOOLEAN_FIELDS:
        return f"CASE WHEN {c} IN ('True', 'Yes') THEN TRUE WHEN {c} IN ('False', 'No') THEN FALSE END AS {c}"
    if c == "common_test_required":
        return f"CASE WHEN {c} = '条件付き' THEN 'Conditional' ELSE NULLIF({c}, '') END AS {c}"
    return f"NULLIF({c}, '') AS {c}"


@query("prj08_adapt", B.with_ctes(f"SELECT {', '.join(adapted(c) for c in K.MASTER_COLUMNS)} FROM b1", b1=B.B1_CLEAN))
def prj08(spark, sf):
    return U.adapt(B.frame(spark, sf, B.B1_CLEAN), K.MASTER, F.col("source_dataset"), F.col("source_version"))


def date_status(c: str) -> str:
    """All binding texts hold at most two dates, set apart by other characters."""
    tokens = f"regexp_extract_all({c}, '(^|[^0-9])([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 2)"
    return (f"CASE WHEN COALESCE({c}, '') = '' THEN 'not_applicable' WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') "
            f"THEN CASE WHEN TRY_CAST({c} AS DATE) IS NOT NULL THEN 'parsed' ELSE 'unparsed' END "
            f"WHEN len(list_filter({tokens}, lambda t: TRY_CAST(t AS DATE) IS NOT NULL)) > 0 THEN 'partial' ELSE 'unparsed' END")


@query("prj09_date_status", sql(", ".join(f"{date_status(c)} AS {c}" for c in K.DATE_FIELDS)))
def prj09(spark, sf):
    return b1(spark, sf, *[P.date_status(c).alias(c) for c in K.DATE_FIELDS])


TENTHS = ("SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN CAST(CAST((p_size - p_size % 10) / 10 AS INT) AS STRING) || '.' || CAST(p_size % 10 AS STRING) "
          "WHEN 1 THEN CAST(p_size % 7 AS STRING) WHEN 2 THEN '3.85' WHEN 3 THEN ' 4.0' ELSE '4.' || CAST(p_size % 10 AS STRING) END AS raw FROM {part}")


@query("prj10_to_tenths", B.with_ctes(
    r"SELECT k, raw, CASE WHEN regexp_full_match(raw, '[0-4](\.[0-9])?|5(\.0)?') THEN CAST(CAST(raw AS DECIMAL(3,1)) * 10 AS INT) END AS tenths FROM t", t=TENTHS))
def prj10(spark, sf):
    return B.frame(spark, sf, TENTHS).select("k", "raw", P.to_tenths("raw").alias("tenths"))


FLAG_RULES = {"licence_flag": ("(?i)licen[sc]e", None), "mail_flag": ("@[a-z]+", "example"), "source_flag": ("src1", "src1[0-4]")}


@query("prj11_flag_rules", """
SELECT doc_id, regexp_matches(t, '(?i)licen[sc]e') AS licence_flag, regexp_matches(t, '@[a-z]+') AND NOT regexp_matches(t, 'example') AS mail_flag,
 regexp_matches(t, 'src1') AND NOT regexp_matches(t, 'src1[0-4]') AS source_flag
FROM (SELECT doc_id, text || ' ' || source AS t FROM documents) s""")
def prj11(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", *P.flag_rules(["text", "source"], FLAG_RULES))


NAMES = ("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '総合型選抜' WHEN 1 THEN '私費外国人留学生選抜' ELSE '特別' END AS selection_category, "
         "CASE doc_id % 7 WHEN 0 THEN 'AO IB' WHEN 1 THEN 'AO IB入試' WHEN 2 THEN 'SAT/ACT・IB入試' WHEN 3 THEN '帰国生徒選抜' WHEN 4 THEN '社会人' ELSE source END AS selection_name, "
         "CASE doc_id % 9 WHEN 0 THEN '地域枠' WHEN 1 THEN '一般枠（地域枠を含む内数）' WHEN 2 THEN 'SAT/ACT方式' WHEN 3 THEN 'IB方式' WHEN 4 THEN 'IB内数' WHEN 5 THEN '社会人を内数に含む' "
         "WHEN 6 THEN '社会人（内数）' ELSE '' END AS slot_type FROM {documents}")


@query("prj11_special_flags", B.with_ctes("""
SELECT doc_id,
 CASE WHEN (t LIKE '%国際バカロレア%' OR regexp_matches(slot_type, 'IBDP利用|IB方式|IB選抜|IB入試')
   OR (regexp_matches(selection_name, '(^|[^\\p{L}\\p{N}_])IB($|[^\\p{L}\\p{N}_])') AND NOT slot_type LIKE '%SAT/ACT方式%'))
   AND NOT (selection_name LIKE '%SAT/ACT・IB入試%' AND slot_type LIKE '%SAT/ACT方式%') AND NOT regexp_matches(slot_type, 'IB.*内数|内数.*IB') THEN 'Yes' ELSE 'No' END AS international_baccalaureate_flag,
 CASE WHEN t LIKE '%私費外国人留学生%' THEN 'Yes' ELSE 'No' END AS private_foreign_student_flag,
 CASE WHEN t LIKE '%帰国%' THEN 'Yes' ELSE 'No' END AS returnee_flag,
 CASE WHEN regexp_matches(t, '地域枠|地域特別枠|地域推薦|県内募集枠|県外募集枠|県内枠|県外枠|県内推薦|県外推薦') AND NOT regexp_matches(slot_type, '一般枠.*(地域枠|地域特別枠).*内数') THEN 'Yes' ELSE 'No' END AS regional_quota_flag,
 CASE WHEN t LIKE '%社会人%' AND NOT (slot_type LIKE '%内数%' AND slot_type LIKE '%社会人%' AND NOT slot_type LIKE '社会人%') THEN 'Yes' ELSE 'No' END AS adult_selection_flag
FROM (SELECT *, selection_category || ' ' || selection_name || ' ' || slot_type AS t FROM n) x""".replace("\\\\p", "\\p"), n=NAMES))
def prj11_special(spark, sf):
    return B.frame(spark, sf, NAMES).select("doc_id", *P.special_flags())


@query("prj12_family", sql("CASE WHEN selection_category LIKE '学校推薦型%' THEN 'recommendation' WHEN selection_category LIKE '総合型%' THEN 'comprehensive' ELSE 'other' END AS family"))
def prj12(spark, sf):
    return b1(spark, sf, P.family().alias("family"))


@query("prj13_method_labels", sql("array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {c} = 'Yes' THEN '{label}' END" for c, label in K.METHOD_LABELS) + "], lambda x: x IS NOT NULL), '・') AS methods"))
def prj13(spark, sf):
    return b1(spark, sf, F.array_join(P.method_labels(), "・").alias("methods"))


COND = (("academic_record_required", "Yes", "評定"), ("english_requirement", "1-URGENT", "英語資格"), ("research_requirement_required", "Yes", "研究業績"))


@query("prj14_condition_labels", sql("array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN '{label}' END" for c, v, label in COND) + "], lambda x: x IS NOT NULL), '・') AS conditions"))
def prj14(spark, sf):
    return b1(spark, sf, F.array_join(P.labels_where([(F.col(c) == v, label) for c, v, label in COND]), "・").alias("conditions"))


@query("prj15_evolve", sql("slot_type, 'No' AS evening_flag, capacity, CASE WHEN capacity = '0' THEN 'Yes' ELSE 'No' END AS closed_flag"))
def prj15(spark, sf):
    df = b1(spark, sf, "slot_type", "capacity")
    df = P.evolve(df, "slot_type", {"evening_flag": F.lit("No")})
    return P.evolve(df, "capacity", {"closed_flag": F.when(F.col("capacity") == "0", "Yes").otherwise("No"), "slot_type": F.lit("kept")})
