"""Table contracts: column lists, domains and codes. Pure data plus small lookups, no Spark session needed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- fixed values: vocabulary the published data contract prescribes ---------------------------------------------

VERSION_MATRIX = {"kokkoritsu": "5.83", "shidai": "1.10"}
CONTRACT_YEAR = 2027

CODE_SEVERITY = {
    "SOURCE_DATASET_UNSUPPORTED": "error",
    "SOURCE_VERSION_MISMATCH": "error",
    "SOURCE_COLUMN_COUNT_MISMATCH": "error",
    "SOURCE_COLUMN_ORDER_MISMATCH": "error",
    "SOURCE_ROW_WIDTH_MISMATCH": "error",
    "MASTER_PK_BLANK": "error",
    "MASTER_PK_DUPLICATE": "error",
    "COVERAGE_KEY_BLANK": "error",
    "COVERAGE_KEY_DUPLICATE": "error",
    "COVERAGE_MASTER_ROWS_MISMATCH": "error",
    "RESEARCH_ADMISSION_ID_BLANK": "error",
    "RESEARCH_ORPHAN_FK": "error",
    "REQUIRED_VALUE_MISSING": "error",
    "INVALID_INTEGER_VALUE": "error",
    "SOURCE_INSTITUTION_TYPE_MISMATCH": "error",
    "INVALID_BOOLEAN_VALUE": "error",
    "INVALID_TRISTATE_VALUE": "error",
    "INVALID_COMMON_TEST_REQUIRED": "error",
    "INVALID_ENUM_VALUE": "error",
    "RESEARCH_EXACT_DUPLICATE": "warning",
    "RESEARCH_REQUIRED_WITHOUT_CHILD": "warning",
    "RESEARCH_DENORMALIZED_FIELD_MISMATCH": "warning",
    "DETAIL_COMPLETENESS_UNMAPPED": "warning",
    "RESEARCH_ACTIVITY_LEVEL_UNMAPPED": "warning",
    "PROVENANCE_URL_MISSING": "warning",
    "WHITESPACE_PADDING": "warning",
    "RESEARCH_NOT_REQUIRED_WITH_CHILD": "informational",
    "COVERAGE_ZERO_MASTER_ROWS": "informational",
    "DATE_RAW_PARTIAL": "informational",
    "DATE_RAW_UNPARSED": "informational",
    "COMMON_TEST_FIELDS_DIFFER": "informational",
}
SEVERITIES = ("error", "warning", "informational")

MASTER_COLUMNS = (
    "source_dataset", "source_version", "record_id", "admission_year", "institution_type", "university",
    "prefecture", "academic_field", "stem_flag", "faculty_school", "department", "selection_category",
    "selection_name", "slot_type", "international_baccalaureate_flag", "private_foreign_student_flag",
    "returnee_flag", "regional_quota_flag", "adult_selection_flag", "capacity", "school_recommendation_required",
    "school_nomination_limit", "school_nomination_limit_total", "school_nomination_limit_rule",
    "exclusive_enrollment_status", "exclusive_enrollment", "exclusive_enrollment_evidence",
    "exclusive_enrollment_evidence_page", "exclusive_enrollment_evidence_url", "eligibility_graduation",
    "gpa_requirement", "english_requirement", "subject_prerequisites", "common_test_required", "common_test_usage",
    "research_activity_level_status", "research_activity_level_raw", "research_requirement_required",
    "research_activity_detail", "research_requirement_summary", "academic_record_required", "academic_record_type",
    "academic_record_detail", "documents_summary", "selection_process", "selection_document_review",
    "selection_interview", "selection_oral_exam", "selection_presentation", "selection_essay",
    "selection_written_exam", "selection_practical", "selection_group_discussion", "selection_aptitude_test",
    "selection_common_test", "interview_detail", "oral_exam_subjects", "oral_exam_detail", "presentation_detail",
    "essay_detail", "written_exam_detail", "selection_method_detail", "application_start", "application_end",
    "web_registration_period", "first_stage_result_date", "second_stage_start", "second_stage_end",
    "final_result_date", "source_status", "detail_completeness_status", "detail_completeness_raw",
    "verification_grade", "verified_on", "source_url", "schedule_url", "guideline_url", "notes", "information_year",
    "publication_status", "fallback_previous_year", "current_year_release_expected", "previous_year_source_url",
    "fallback_note",
)
COVERAGE_COLUMNS = (
    "source_dataset", "source_version", "institution_type", "university", "undergraduate_scope", "research_status",
    "master_rows", "current_year_status", "fallback_status", "checked_on", "official_source_url", "notes",
)
RESEARCH_COLUMNS = (
    "source_dataset", "source_version", "admission_id", "university", "faculty_school", "department",
    "selection_name", "requirement_code", "program_or_competition", "required_level", "requirement_detail",
    "alternative_allowed", "evidence_required", "source_url", "verified_on",
)

TRISTATE_FIELDS = (
    "school_recommendation_required", "research_requirement_required", "academic_record_required",
    "selection_document_review", "selection_interview", "selection_oral_exam", "selection_presentation",
    "selection_essay", "selection_written_exam", "selection_practical", "selection_group_discussion",
    "selection_aptitude_test", "selection_common_test",
)
SPECIAL_FLAGS = (
    "international_baccalaureate_flag", "private_foreign_student_flag", "returnee_flag", "regional_quota_flag",
    "adult_selection_flag",
)
BOOLEAN_FIELDS = ("stem_flag", "fallback_previous_year", *SPECIAL_FLAGS)
INTEGER_FIELDS = ("admission_year", "information_year")
DATE_FIELDS = (
    "application_start", "application_end", "web_registration_period", "first_stage_result_date",
    "second_stage_start", "second_stage_end", "final_result_date", "verified_on",
)
DISPLAY_FIELDS = ("university", "faculty_school", "department", "selection_name")

BOOLEANS = {"True": True, "Yes": True, "False": False, "No": False}
TRISTATE = ("Yes", "No", "Unknown")
QUADSTATE_SOURCE = ("Yes", "No", "Unknown", "条件付き")
QUADSTATE_RENAME = {"条件付き": "Conditional"}
EXCLUSIVE_STATUSES = ("専願", "併願可", "条件付き", "不明")
EXCLUSIVE_UNKNOWN = "不明"
VERIFICATION_GRADES = ("A", "B", "C")
INSTITUTION_TYPES = {"kokkoritsu": ("国立", "公立"), "shidai": ("私立",)}
OUT_OF_SCOPE = "対象外"

DETAIL_PREFIXES = {"kokkoritsu": {"detailed": "complete", "partial": "partial"}}
DETAIL_VALUES = {"shidai": {"complete": "complete", "partial": "partial", "pending": "pending", "unknown": "unknown"}}
RESEARCH_LEVEL_VALUES = {
    "kokkoritsu": {
        "explicit_requirement": "required",
        "探究活動必須": "required",
        "必須（指定実績のいずれか）": "required",
        "関連する課外活動実績が出願要件": "required",
        "relevant": "relevant",
        "related": "relevant",
        "explicitly_evaluated": "relevant",
        "探究活動重視": "relevant",
        "研究活動重視": "relevant",
        "none": "none",
        "なし": "none",
        "not_specified": "unknown",
    },
    "shidai": {"required": "required", "relevant": "relevant", "none": "none", "unknown": "unknown"},
}

# Columns a search request may filter on by exact value.
EXACT_FILTER_FIELDS = (
    "university", "institution_type", "prefecture", "academic_field", "selection_category",
    "exclusive_enrollment_status", "school_recommendation_required", "academic_record_required",
    "common_test_required", "research_requirement_required", "research_activity_level_status",
    "selection_interview", "selection_oral_exam", "selection_presentation", "selection_essay",
    "selection_written_exam", "selection_common_test",
)
# Columns a free-text phrase is looked for in.
TEXT_FIELDS = (
    "university", "faculty_school", "department", "selection_name", "academic_field", "eligibility_graduation",
    "gpa_requirement", "english_requirement", "subject_prerequisites", "research_activity_detail",
    "research_requirement_summary", "documents_summary", "selection_process", "interview_detail",
    "oral_exam_subjects", "oral_exam_detail", "presentation_detail", "essay_detail", "written_exam_detail",
    "selection_method_detail",
)

# How a changed cell is classed in a snapshot diff; everything else is "D_other".
MATERIAL_FIELDS = (
    "university", "prefecture", "faculty_school", "department", "academic_field", "selection_category",
    "selection_name", "eligibility_graduation", "gpa_requirement", "english_requirement", "subject_prerequisites",
    "research_activity_level", "research_requirement_required", "research_activity_detail",
    "research_requirement_summary", "exclusive_enrollment_status", "exclusive_enrollment", "common_test_required",
    "common_test_usage", "selection_document_review", "selection_interview", "selection_oral_exam",
    "selection_presentation", "selection_essay", "selection_written_exam", "selection_practical",
    "selection_group_discussion", "selection_aptitude_test", "selection_common_test", "application_start",
    "application_end", "web_registration_period", "first_stage_result_date", "second_stage_start",
    "second_stage_end", "final_result_date", "capacity",
)
PROVENANCE_FIELDS = (
    "source_url", "guideline_url", "schedule_url", "exclusive_enrollment_evidence_url", "publication_status",
    "information_year", "verified_on", "verification_grade", "fallback_previous_year",
    "current_year_release_expected", "previous_year_source_url", "fallback_note", "source_status",
)
NOTES_FIELDS = ("notes", "detail_completeness")

# Update queue and audit ledger.
QUEUE_COLUMNS = (
    "queue_id", "institution_type", "university", "faculty_school", "selection_name", "document_type",
    "publication_status", "release_expected_text", "release_expected_from", "release_expected_to",
    "release_schedule_url", "last_checked_on", "next_check_on", "actual_release_on", "action_status",
    "related_record_id", "notes",
)
LEDGER_COLUMNS = (
    "source_dataset", "institution_type", "university", "baseline_research_status", "baseline_master_rows",
    "reaudit_status", "official_system_checked", "capacity_table_checked", "schedule_checked",
    "guideline_index_checked", "master_compared", "kawai_crosscheck", "missing_candidate_count",
    "ambiguous_candidate_count", "obsolete_candidate_count", "update_queue_open_count", "last_audited_on", "notes",
)
PUBLICATION_STATUSES = ("公開済", "一部公開", "未公開", "公開予定", "不明")
ACTION_STATUSES = ("待機", "確認時期到来", "更新必要", "更新中", "完了")
AUDIT_STATUSES = ("未再監査", "再監査中", "追加確認待ち", "要項公開待ち", "再監査済")
CHECK_STATUSES = ("未実施", "一部実施", "実施済", "実施不能")
QUEUE_DATES = (
    "release_expected_from", "release_expected_to", "last_checked_on", "next_check_on", "actual_release_on",
)
LEDGER_CHECKS = (
    "official_system_checked", "capacity_table_checked", "schedule_checked", "guideline_index_checked",
    "master_compared", "kawai_crosscheck",
)
LEDGER_COUNTS = (
    "missing_candidate_count", "ambiguous_candidate_count", "obsolete_candidate_count", "update_queue_open_count",
)

# Selection methods and application conditions as shown to readers, in display order.
METHOD_LABELS = (
    ("selection_interview", "面接"),
    ("selection_oral_exam", "口頭試問"),
    ("selection_presentation", "プレゼン"),
    ("selection_essay", "小論文"),
    ("selection_written_exam", "筆記"),
    ("selection_practical", "実技"),
    ("selection_group_discussion", "グループ討論"),
    ("selection_aptitude_test", "適性検査"),
    ("selection_common_test", "共通テスト"),
)
CONDITION_LABELS = (
    ("grade_requirement_status", "required", "評定"),
    ("english_requirement_status", "required", "英語資格"),
    ("research_requirement_required", "Yes", "研究業績"),
)
FAMILY_PREFIXES = {"学校推薦型": "recommendation", "総合型": "comprehensive"}

# Base columns of a search document, in document order.
SEARCH_FIELDS = (
    "source_dataset", "source_version", "record_id", "institution_type", "university", "prefecture",
    "faculty_school", "department", "selection_category", "selection_name", "slot_type", "capacity",
    "academic_field", "stem_flag", "exclusive_enrollment_status", "school_recommendation_required",
    "academic_record_required", "common_test_required", "research_requirement_required",
    "research_activity_level_status", "selection_interview", "selection_oral_exam", "selection_presentation",
    "selection_essay", "selection_written_exam", "selection_practical", "selection_group_discussion",
    "selection_aptitude_test", "selection_common_test", "gpa_requirement", "english_requirement",
    "application_start", "application_end", "fallback_previous_year", "information_year", "publication_status",
)

# ---- end of fixed values ------------------------------------------------------------------------------------------

KEY = ("source_dataset", "source_version", "record_id")


@dataclass(frozen=True)
class TableContract:
    """Ordered columns with their types, plus the key; builds both the typed and the all-text schema."""

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    domains: tuple[tuple[str, tuple[str, ...]], ...] = ()
    #: no cell holds a line break, so a file may be read in pieces
    one_line: bool = False

    def kind(self, column: str) -> T.DataType:
        if column in self.integers:
            return T.IntegerType()
        return T.BooleanType() if column in self.booleans else T.StringType()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.kind(c)) for c in self.columns])

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


MASTER = TableContract(
    "master", MASTER_COLUMNS, KEY, INTEGER_FIELDS, BOOLEAN_FIELDS,
    required=("source_dataset", "source_version", "record_id", "admission_year", "university", "verified_on",
              *SPECIAL_FLAGS),
    domains=(*((f, TRISTATE) for f in TRISTATE_FIELDS),
             ("common_test_required", (*TRISTATE, "Conditional")),
             ("exclusive_enrollment_status", EXCLUSIVE_STATUSES),
             ("verification_grade", VERIFICATION_GRADES)),
)
COVERAGE = TableContract(
    "coverage", COVERAGE_COLUMNS, ("source_dataset", "source_version", "institution_type", "university"),
    ("master_rows",), required=("institution_type", "university", "master_rows", "checked_on"),
)
RESEARCH = TableContract(
    "research_requirements", RESEARCH_COLUMNS, required=("admission_id", "university", "verified_on"),
)


def source_columns(contract: TableContract) -> tuple[str, ...]:
    """Header of the source CSV: no source tag, and one raw column where the unified form keeps status + raw."""
    out = []
    for c in contract.columns:
        if c in ("source_dataset", "source_version") or c.endswith("_raw"):
            continue
        paired = c.endswith("_status") and c[: -len("_status")] + "_raw" in contract.columns
        out.append(c[: -len("_status")] if paired else c)
    return tuple(out)


def source_contract(contract: TableContract) -> TableContract:
    return TableContract(contract.name, source_columns(contract))


def severity(code: str) -> str:
    """Severity of a registered code; an unregistered one is a programming error."""
    return CODE_SEVERITY[code]
