"""Faceted structured search: one request becomes one boolean column, so filter, summary and page share a plan."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as K
from ..functions import columns as P
from ..functions.skew import join_small_or_keyed
from ..sources.shared import settle
from . import views as V
from .facets import typed_literal

# ---- fixed values: result words and tags ------------------------------------------------------------------------------
SAFE_MATCH, SAFE_NO_MATCH = "safe match", "safe no match"
CONDITIONAL, NOT_EVALUABLE = "conditional/review required", "not numerically evaluable"
RULE_WITHOUT_VALUE = "safe numeric rule (GPA not supplied)"
SEARCH_ORDER = ("university", "faculty_school", "department", "selection_category", "selection_name", *K.KEY)
DOCUMENT_ORDER = ("prefecture", *SEARCH_ORDER)
RESULT_COLUMNS = (
    "source_dataset", "source_version", "record_id", "institution_type", "university", "faculty_school", "department",
    "selection_category", "selection_name", "capacity", "prefecture", "academic_field",
    "academic_field_mapping_status", "academic_field_groups", "stem_flag", "exclusive_enrollment_status",
    "school_recommendation_required", "academic_record_required", "gpa_requirement", "gpa_derived_status",
    "gpa_parse_status", "gpa_search_disposition", "gpa_min_tenths", "grade_requirement_status",
    "overall_gpa_min_tenths", "overall_gpa_min_inclusive", "overall_gpa_status", "additional_grade_conditions",
    "common_test_required", "research_requirement_required", "research_activity_level_status", "selection_interview",
    "selection_oral_exam", "selection_presentation", "selection_essay", "selection_written_exam",
    "selection_common_test", "application_start", "application_end",
)
PROVISIONAL_TAGS = {
    "returnee_flag": ("returnee",),
    "international_baccalaureate_flag": ("international_baccalaureate",),
    "private_foreign_student_flag": ("private_foreign_student", "unclassified_international"),
    "adult_selection_flag": ("adult",),
}
MAPPING_STATUSES = frozenset(("single", "multi", "review_required", "unmapped", "not_applicable"))
NO_TAG, UNCLASSIFIED_TAG = "none", "unclassified_international"
# ---- end of fixed values ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class SearchRequest:
    """AND across fields, OR within a field. Empty means no filter; a request that cannot be meant raises ValueError.

    ``exact_fields`` are the columns that ``equals`` may name.
    """

    equals: Mapping[str, Sequence[str]] = field(default_factory=dict)
    flags: Mapping[str, bool] = field(default_factory=dict)
    groups: Sequence[str] = ()
    mapping_status: Sequence[str] = ()
    places: Sequence[str] = ()
    branches: Sequence[tuple[str, Sequence[str]]] = ()
    english_status: Sequence[str] = ()
    value_tenths: int | None = None
    value_mode: str = "all"
    grade_status: str | None = None
    overall_tenths: int | None = None
    deadline_from: str | None = None
    applicant_tenths: int | None = None
    special_flags: Sequence[str] | None = None
    families: Sequence[str] | None = None
    exact_fields: Sequence[str] = K.EXACT_FILTER_FIELDS

    def __post_init__(self) -> None:
        if self.value_mode not in ("safe", "review", "all"):
            raise ValueError(f"unknown mode {self.value_mode}")
        for v in (self.value_tenths, self.overall_tenths, self.applicant_tenths):
            if v is not None and not 0 <= v <= 50:
                raise ValueError("a threshold must be 0..50 tenths")
        if set(self.english_status) - {"required", "not_required"}:
            raise ValueError("only safe exact statuses can be asked for")
        if self.grade_status not in (None, "required", "not_required", "not_applicable", "review_required", "unknown"):
            raise ValueError("this grade status cannot be asked for")
        if self.overall_tenths is not None and self.grade_status != "required":
            raise ValueError("an overall floor needs the grade status 'required'")
        if self.value_mode != "all" and self.value_tenths is None:
            raise ValueError(f"mode {self.value_mode} needs a value")
        if unknown := set(self.equals) - set(self.exact_fields):
            raise ValueError(f"no exact filter on {sorted(unknown)}")
        lists = [*self.equals.values(), self.groups, self.mapping_status, self.places, self.families or ()]
        if any(v is None or not str(v).strip() for values in lists for v in values):
            raise ValueError("a filter value is empty")
        if unknown := set(self.mapping_status) - MAPPING_STATUSES:
            raise ValueError(f"unknown mapping status {sorted(unknown)}")
        broad = [b for b, _ in self.branches]
        if len(set(broad)) < len(broad):
            raise ValueError("a broad field is asked for twice")
        if self.deadline_from is not None:
            try:
                datetime.date.fromisoformat(self.deadline_from)
            except ValueError:
                raise ValueError(f"no date: {self.deadline_from}") from None
            if len(self.deadline_from) != 10:
                raise ValueError(f"no date: {self.deadline_from}")
        if self.special_flags is not None and self.families is not None and not self.special_flags and not self.families:
            raise ValueError("without a flag at least one family has to be chosen")


def safe_match(value: int | Column, prefix: str = "gpa_", status: str = "gpa_parse_status") -> Column:
    """The value lies within the safe rule's bounds, each open or closed."""
    v = F.lit(value) if isinstance(value, int) else value
    lo, hi = F.col(f"{prefix}min_tenths"), F.col(f"{prefix}max_tenths")
    above = (v > lo) | ((v == lo) & F.col(f"{prefix}min_inclusive"))
    below = hi.isNull() | (v < hi) | ((v == hi) & F.col(f"{prefix}max_inclusive"))
    return F.coalesce((F.col(status) == "parsed_safe") & above & below, F.lit(False))


def threshold_filter(value: int, mode: str, status: str = "gpa_parse_status") -> Column:
    if mode == "all":
        return F.lit(True)
    hit = safe_match(value, status=status)
    return hit if mode == "safe" else hit | F.coalesce(F.col(status) == "conditional_review", F.lit(False))


def threshold_status(value: int | None, status: str = "gpa_parse_status") -> Column:
    """Derived label per row, with or without a value."""
    parsed = F.col(status) == "parsed_safe"
    first = (F.when(parsed, RULE_WITHOUT_VALUE) if value is None
             else F.when(safe_match(value, status=status), SAFE_MATCH).when(parsed, SAFE_NO_MATCH))
    return first.when(F.col(status) == "conditional_review", CONDITIONAL).otherwise(NOT_EVALUABLE)


def floor_match(value: int, floor: str = "overall_gpa_min_tenths", inclusive: str = "overall_gpa_min_inclusive") -> Column:
    f = F.col(floor)
    return F.coalesce((f < value) | ((f == value) & F.col(inclusive)), F.lit(False))


def deadline_status(date: str, end: str = "application_end", fallback: str = "fallback_previous_year") -> Column:
    """match / unknown / exclude; a taken-over or unreadable date is unknown and stays in the result."""
    unknown = F.coalesce(F.col(fallback), F.lit(False)) | ~F.coalesce(F.col(end).rlike(P.ISO_DATE), F.lit(False))
    return F.when(unknown, "unknown").when(F.col(end) >= date, "match").otherwise("exclude")


def applicant_status(value: int, fallback: str = "fallback_previous_year") -> Column:
    status = F.col("grade_requirement_status")
    sure = ((status == "required") & (F.col("overall_gpa_status") == "safe_simple_overall")
            & ~F.col("additional_grade_conditions") & F.col("overall_gpa_min_tenths").isNotNull())
    return (F.when(F.coalesce(F.col(fallback), F.lit(False)), "unknown")
            .when(status.isin("not_required", "not_applicable"), "match")
            .when(~F.coalesce(sure, F.lit(False)), "unknown")
            .when(floor_match(value), "match").otherwise("exclude"))


def flag_filter(selected: Sequence[str], flags: Sequence[str]) -> Column:
    """With flags selected any of them; with none selected only rows without any flag."""
    yes = lambda f: F.coalesce(F.col(f), F.lit(False))
    if selected:
        return reduce(lambda a, b: a | b, [yes(f) for f in selected])
    return ~reduce(lambda a, b: a | b, [yes(f) for f in flags])


def predicate(req: SearchRequest, flags: Sequence[str] = tuple(PROVISIONAL_TAGS)) -> Column:
    """The whole request as one boolean column; values are literals of the column API, never text in a query."""
    parts = [F.col(f).isin(list(dict.fromkeys(v))) for f, v in req.equals.items() if v]
    parts += [F.col(f) == v for f, v in req.flags.items()]
    if req.groups:
        parts.append(V.has_any("academic_field_groups", req.groups))
    if req.mapping_status:
        parts.append(F.col("academic_field_mapping_status").isin(list(req.mapping_status)))
    if req.places:
        parts.append(V.has_any("prefecture_memberships", req.places))
    if req.branches:
        parts.append(V.branch_predicate(req.branches, "broad_codes", "subcategory_codes"))
    if req.english_status:
        parts.append(F.col("english_requirement_status").isin(list(req.english_status))
                     & (F.col("english_search_disposition") == "safe_exact"))
    if req.value_tenths is not None and req.value_mode != "all":
        parts.append(threshold_filter(req.value_tenths, req.value_mode))
    if req.grade_status is not None:
        parts.append(F.col("grade_requirement_status") == req.grade_status)
    if req.overall_tenths is not None:
        parts.append((F.col("grade_parse_status") == "exact_crosswalk") & floor_match(req.overall_tenths))
    if req.deadline_from is not None:
        parts.append(deadline_status(req.deadline_from) != "exclude")
    if req.applicant_tenths is not None:
        parts.append(applicant_status(req.applicant_tenths) != "exclude")
    if req.special_flags is not None:
        parts.append(flag_filter(req.special_flags, flags))
        if not req.special_flags and req.families:
            parts.append(P.family().isin(list(req.families)))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def search(df: DataFrame, req: SearchRequest) -> DataFrame:
    return df.where(predicate(req))


def project_result(df: DataFrame, req: SearchRequest) -> DataFrame:
    """The 39 result columns; the ordered code list as comma-joined text, NULL when there is none."""
    codes = F.when(F.size("academic_field_groups") > 0, F.array_join("academic_field_groups", ","))
    special = {"gpa_derived_status": threshold_status(req.value_tenths), "academic_field_groups": codes}
    return df.select(*[special.get(c, F.col(c)).alias(c) for c in RESULT_COLUMNS])


def project_site_result(df: DataFrame, req: SearchRequest) -> DataFrame:
    """The same with ``deadline_filter_status`` and ``applicant_grade_status``; NULL where the request does not ask."""
    nothing = F.lit(None).cast("string")
    deadline = nothing if req.deadline_from is None else deadline_status(req.deadline_from)
    applicant = nothing if req.applicant_tenths is None else applicant_status(req.applicant_tenths)
    marked = df.withColumns({"deadline_filter_status": deadline, "applicant_grade_status": applicant})
    codes = F.when(F.size("academic_field_groups") > 0, F.array_join("academic_field_groups", ","))
    special = {"gpa_derived_status": threshold_status(req.value_tenths), "academic_field_groups": codes}
    return marked.select(*[special.get(c, F.col(c)).alias(c) for c in (*RESULT_COLUMNS, "deadline_filter_status", "applicant_grade_status")])


def page_after(df: DataFrame, order: Sequence[str], limit: int, last: Sequence | None = None) -> DataFrame:
    """The page behind the row with the values ``last`` of ``order``, NULL first: a filter and a bounded top-k.

    However deep the page, no task sees more than ``limit`` rows of each partition; ``order`` has to be a total order.
    """
    if last is not None:
        later, same = F.lit(False), F.lit(True)
        for c, v in zip(order, last):
            value = F.col(c)
            above = value.isNotNull() if v is None else value > F.lit(v)
            later = later | (same & F.coalesce(above, F.lit(False)))
            same = same & value.eqNullSafe(F.lit(v))
        df = df.where(later)
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(limit)


def page(df: DataFrame, order: Sequence[str] = SEARCH_ORDER, limit: int | None = None, offset: int = 0,
         collation: str | None = None, blank_nulls: bool = False) -> DataFrame:
    """Total order, NULL first, then offset and limit. ``blank_nulls`` sorts NULL as empty text."""
    def by(c: str) -> Column:
        k = F.coalesce(F.col(c).cast("string"), F.lit("")) if blank_nulls else F.col(c)
        return (F.collate(k.cast("string"), collation) if collation else k).asc_nulls_first()
    out = df.orderBy(*[by(c) for c in order])
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def summarize(df: DataFrame, req: SearchRequest, group: str = "university", status: str = "gpa_parse_status") -> DataFrame:
    """One row over the matched rows; the safe counts are NULL without a value. Zero, not NULL, on an empty result."""
    hits = df.where(predicate(req))
    parsed, conditional = F.col(status) == "parsed_safe", F.col(status) == "conditional_review"
    if req.value_tenths is None:
        safe = no_safe = F.lit(None).cast("bigint")
        safe, no_safe = F.max(safe), F.max(no_safe)
    else:
        hit = safe_match(req.value_tenths, status=status)
        safe, no_safe = F.count_if(hit), F.count_if(parsed & ~hit)
    return hits.agg(
        F.count("*").alias("total_matched_rows"), safe.alias("safe_match_rows"), no_safe.alias("safe_no_match_rows"),
        F.count_if(parsed).alias("safe_numeric_rule_rows"), F.count_if(conditional).alias("conditional_review_rows"),
        F.count_if(~(parsed | conditional)).alias("not_evaluable_rows"), F.count_distinct(group).alias("group_count"))


def rows_by_dataset(df: DataFrame, req: SearchRequest, dataset: str = "source_dataset") -> DataFrame:
    return df.where(predicate(req)).groupBy(dataset).agg(F.count("*").alias("rows"))


def threshold_search(layer: DataFrame, value: int, order: Sequence[str], limit: int) -> DataFrame:
    """Rows of the safe subset that the value satisfies, in key order, with the full match count beside them."""
    hits = layer.where(safe_match(value))
    total = hits.agg(F.count("*").alias("total_matches")).withColumn("_one", F.lit(1))
    top = hits.orderBy(*order).limit(limit).withColumn("_one", F.lit(1))
    return top.join(F.broadcast(total), "_one").drop("_one")


def check_requests(requests: DataFrame, broad: DataFrame, sub: DataFrame) -> DataFrame:
    """Saved requests (request_id, group_code, subcategory_codes array): unknown codes, subcode under another parent."""
    b = broad.select("group_code", F.lit(True).alias("_known")).distinct()
    groups = join_small_or_keyed(requests.select("request_id", "group_code"), b, ["group_code"], ["request_id"])
    bad_group = groups.where("_known is null").select("request_id", F.lit("unknown_group").alias("issue"),
                                                      F.col("group_code").alias("code"))
    subs = requests.select("request_id", "group_code", F.explode("subcategory_codes").alias("subcategory_code"))
    s = sub.select("subcategory_code", F.col("parent_group_code").alias("_parent"), F.lit(True).alias("_known"))
    j = join_small_or_keyed(subs, s, ["subcategory_code"], ["request_id"])
    issue = F.when(F.col("_known").isNull(), "unknown_subcategory").when(F.col("_parent") != F.col("group_code"),
                                                                         "subcategory_of_another_group")
    bad_sub = j.select("request_id", issue.alias("issue"), F.col("subcategory_code").alias("code")).where("issue is not null")
    return bad_group.unionByName(bad_sub)


def run_suite(df: DataFrame, suite: Sequence[tuple[str, SearchRequest]], group: str = "university",
              dataset: str = "source_dataset", status: str = "gpa_parse_status") -> DataFrame:
    """All saved queries over one scan, one row per query and dataset (dataset NULL = the whole).

    Each row is reduced to the bit set of queries it matches, which is written once. Rows are counted per (dataset, rule,
    bit set) before anything is listed per query; distinct groups come from one bit set per (dataset, group). No row per
    query and group exists, so neither the scan nor the shuffle grows with the number of queries.
    """
    parts = [suite[k:k + 60] for k in range(0, len(suite), 60)]
    bounds = [c for c in ("gpa_min_tenths", "gpa_min_inclusive", "gpa_max_tenths", "gpa_max_inclusive") if c in df.columns]
    masks = [reduce(lambda a, b: a + b, [F.when(predicate(r), F.lit(1 << i)).otherwise(0).cast("bigint") for i, (_, r) in enumerate(part)]).alias(f"_mask{k}")
             for k, part in enumerate(parts)]
    rows = settle(df.select(F.col(group).alias("_g"), F.col(dataset).cast("string").alias("_d"), F.col(status).alias("_s"), *bounds, *masks), "suite")
    out = []
    for k, part in enumerate(parts):
        counted = rows.groupBy("_d", "_s", *bounds, f"_mask{k}").agg(F.count("*").alias("n"))
        # every query has a line, so one without any match is counted as well
        lines = F.array(*[F.struct(
            F.lit(label).alias("label"), F.lit(r.value_tenths is not None).alias("valued"), (F.getbit(f"_mask{k}", F.lit(i)) == 1).alias("hit"),
            (safe_match(r.value_tenths, status="_s") if r.value_tenths is not None else F.lit(False)).alias("safe"))
            for i, (label, r) in enumerate(part)])
        out.append(counted.select("_d", "_s", "n", F.explode(lines).alias("q")).select("_d", "_s", "n", "q.*"))
    of = lambda when: F.coalesce(F.sum(F.when(F.col("hit") & when, F.col("n"))), F.lit(0))
    per = reduce(DataFrame.unionByName, out).groupBy("label", "valued", "_d").agg(
        of(F.lit(True)).alias("t"), of(F.col("safe")).alias("s"), of(F.coalesce(F.col("_s") == "conditional_review", F.lit(False))).alias("c"))
    of_group = rows.where("_g IS NOT NULL").groupBy("_d", "_g").agg(*[F.bit_or(f"_mask{k}").alias(f"_mask{k}") for k in range(len(parts))])
    of_whole = of_group.groupBy("_g").agg(*[F.bit_or(f"_mask{k}").alias(f"_mask{k}") for k in range(len(parts))])
    names: dict[tuple[str, bool], dict[int, int]] = {}
    for k, part in enumerate(parts):
        for i, (label, r) in enumerate(part):
            bits = names.setdefault((label, r.value_tenths is not None), {})
            bits[k] = bits.get(k, 0) | 1 << i
    listed = F.explode(F.array(*[F.struct(F.lit(label).alias("label"), F.lit(valued).alias("valued"), reduce(
        lambda a, b: a | b, [F.col(f"_mask{k}").bitwiseAND(F.lit(b).cast("bigint")) != 0 for k, b in bits.items()]).alias("hit"))
        for (label, valued), bits in names.items()]))

    def with_groups(sums: DataFrame, seen: DataFrame, whole: bool) -> DataFrame:
        d = F.lit(None).cast("string") if whole else F.col("_d")
        found = seen.select(d.alias("_gd"), listed.alias("q")).select("_gd", "q.*").groupBy(
            F.col("label").alias("_gl"), F.col("valued").alias("_gv"), "_gd").agg(F.count_if("hit").alias("_groups"))
        on = (F.col("label") == F.col("_gl")) & (F.col("valued") == F.col("_gv")) & F.col("_d").eqNullSafe(F.col("_gd"))
        return sums.join(found, on, "left").select(
            "label", F.col("_d").alias("dataset"), F.col("t").alias("total"), F.when(F.col("valued"), F.col("s")).alias("safe_match_rows"),
            F.col("c").alias("conditional_rows"), F.coalesce("_groups", F.lit(0)).alias("groups"))

    whole = per.groupBy("label", "valued").agg(*[F.sum(c).alias(c) for c in "tsc"]).withColumn("_d", F.lit(None).cast("string"))
    return with_groups(per, of_group, False).unionByName(with_groups(whole, of_whole, True))


def compare_results(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Do two search forms give the same keys: rows on each side and keys with another count."""
    both = (a.select(*key, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
            .unionByName(b.select(*key, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    c = both.groupBy(*key).agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    return c.agg(F.coalesce(F.sum("na"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("nb"), F.lit(0)).alias("rows_b"),
                 F.count_if(F.col("na") > F.col("nb")).alias("only_a"), F.count_if(F.col("nb") > F.col("na")).alias("only_b"))


def discover(provisional: DataFrame, req: SearchRequest, confirmed: DataFrame, eq: Sequence[str] = ("university", "selection_name"),
             optional: str = "faculty_school") -> DataFrame:
    """Provisional hits: only verified identity fields exclude; ``unverified`` is set when other filters were asked."""
    kept = V.suppress(provisional, confirmed, eq, optional)
    identity = ("university", "institution_type")
    parts = [F.col(f).isin(list(v)) for f, v in req.equals.items() if f in identity and v]
    if req.special_flags:
        tags = [t for f in req.special_flags for t in PROVISIONAL_TAGS.get(f, ())]
        parts.append(F.col("special_filter_tag").isin(tags))
    else:
        parts.append(((F.col("special_filter_tag") == NO_TAG) & F.col("selection_family").isin(list(req.families)))
                     | (F.col("special_filter_tag") == UNCLASSIFIED_TAG))
    return kept.where(reduce(lambda a, b: a & b, parts)).withColumn("unverified", F.lit(has_unverified(req)))


def has_unverified(req: SearchRequest) -> bool:
    """Does the request hold filters that say nothing about a provisional record."""
    others = [v for f, v in req.equals.items() if f not in ("university", "institution_type") and v]
    return bool(others or req.flags or req.groups or req.mapping_status or req.places or req.branches or req.english_status
                or req.grade_status is not None or req.value_tenths is not None or req.overall_tenths is not None
                or req.applicant_tenths is not None or req.deadline_from is not None)


# ---- text -------------------------------------------------------------------------------------------------------------

def contains_any(df: DataFrame, cols: Sequence[str], phrase: str) -> DataFrame:
    """Rows whose text holds the phrase in any of the columns (a scan over whole texts)."""
    return df.where(reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.col(c), F.lit(phrase)), F.lit(False)) for c in cols]))


def trigrams_of(text: Column) -> Column:
    """Distinct three-character pieces of a text, found in one pass by an overlapping match; shorter texts have none."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(...))"), F.lit(1)))


def build_trigrams(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Inverted index (trigram, key), to be written partitioned or bucketed by trigram for repeated use."""
    pieces = F.flatten(F.array(*[F.coalesce(trigrams_of(F.col(c)), F.array().cast("array<string>")) for c in cols]))
    return df.select(F.col(key), F.explode(F.array_distinct(pieces)).alias("trigram"))


def trigram_search(df: DataFrame, index: DataFrame, key: str, cols: Sequence[str], phrase: str) -> DataFrame:
    """Candidates that hold every trigram of the phrase, checked against the text itself."""
    if len(phrase) < 3:
        return contains_any(df, cols, phrase)
    want = list(dict.fromkeys(phrase[i:i + 3] for i in range(len(phrase) - 2)))
    candidates = (index.where(F.col("trigram").isin(want)).groupBy(key).agg(F.count_distinct("trigram").alias("n"))
                  .where(F.col("n") == len(want)).select(key))
    return contains_any(df.join(candidates, key, "left_semi"), cols, phrase)


def suggest(df: DataFrame, col: str, q: str, n: int = 8) -> DataFrame:
    """First ``n`` distinct names that hold the query, case ignored; an empty query suggests nothing."""
    if not q:
        return df.select(col).limit(0)
    return df.where(F.contains(F.lower(col), F.lit(q.lower()))).select(col).distinct().orderBy(col).limit(n)


def like_record(df: DataFrame, record: Mapping[str, object], cols: Sequence[str], id_: str, n: int = 3) -> DataFrame:
    """Query by example: rows equal to the record on the columns (NULL matches NULL): count and first ``n`` ids."""
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(typed_literal(record[c], df, c)) for c in cols])
    hits = df.where(same)
    top = hits.select(F.col(id_).alias("_id")).orderBy("_id").limit(n)
    ids = top.agg(F.sort_array(F.collect_list("_id")).alias("first_ids")).withColumn("_one", F.lit(1))
    return hits.agg(F.count("*").alias("rows")).withColumn("_one", F.lit(1)).join(ids, "_one").drop("_one")
