"""Declarative validation: rules in, one ``issues`` frame out.

Row rules of one table become a single projection with one ``explode``; set rules are aggregates and joins whose hot
keys are spread. Every rule uses a registered code, and the severity follows from the code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..functions import columns as P
from ..functions.skew import HOT_ROWS, attach, maybe_listed, null_marked
from ..sources.shared import settle

ROW = "_row_number"
DETAILS = T.MapType(T.StringType(), T.StringType())
#: (table, code, field) of findings, each with its number from 0
Kinds = Mapping[tuple[str, str, str | None], int]


@dataclass(frozen=True)
class Rule:
    """``when`` flags the row; ``details`` are (name, column) pairs kept with the issue."""

    code: str
    when: Column
    message: str
    field: str | None = None
    details: tuple[tuple[str, Column], ...] = ()
    severity: str | None = None

    def detail_map(self) -> Column:
        return F.create_map(*[x for name, value in self.details for x in (F.lit(name), value.cast("string"))])


def apply_rules(df: DataFrame, rules: Sequence[Rule], table: str, dataset: Column | str, record_id: Column | str,
                row: Column | str = ROW, kinds: Kinds | None = None) -> DataFrame:
    """One scan: a row carries the rules it breaks, each as its number and its details; texts are added per finding.

    Details are made where the rule is tested, and only there: a finding neither goes through the list of rules again nor
    carries the row it comes from. With ``kinds`` a finding has the number of its kind as well.
    """
    rules = list(rules)
    broken = F.array_compact(F.array(*[F.when(r.when, F.struct(
        F.lit(n).alias("rule"), (r.detail_map() if r.details else F.lit(None)).cast(DETAILS).alias("details"))) for n, r in enumerate(rules, 1)]))
    about = F.array(*[F.struct(F.lit(r.code).alias("code"), F.lit(r.severity or K.severity(r.code)).alias("severity"),
                               F.lit(r.message).alias("message"), F.lit(r.field).cast("string").alias("field"),
                               *([F.lit(kinds[table, r.code, r.field]).alias("kind")] if kinds else [])) for r in rules])
    hits = (df.select(P.col(dataset).alias("dataset"), P.col(record_id).cast("string").alias("record_id"),
                      P.col(row).cast("bigint").alias("row_number"), F.explode(broken).alias("_hit"))
            .withColumn("_about", F.element_at(about, F.col("_hit.rule"))))
    return hits.select("_about.code", "_about.severity", "dataset", F.lit(table).alias("table"), "_about.message", "record_id", "_about.field",
                       "row_number", "_hit.details", *(["_about.kind"] if kinds else []))


def issue_rows(df: DataFrame, code: str, message: str, table: str, dataset: str, record_id: Column | str,
               row: Column | str = ROW, field: str | Column | None = None,
               details: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Every row of ``df`` as an issue of one code."""
    pairs = [x for name, value in details for x in (F.lit(name), value.cast("string"))]
    name = F.lit(field).cast("string") if field is None or isinstance(field, str) else field
    return df.select(
        F.lit(code).alias("code"), F.lit(K.severity(code)).alias("severity"), F.col(dataset).alias("dataset"),
        F.lit(table).alias("table"), F.lit(message).alias("message"),
        P.col(record_id).cast("string").alias("record_id"), name.alias("field"),
        P.col(row).cast("bigint").alias("row_number"),
        (F.create_map(*pairs) if pairs else F.lit(None).cast(DETAILS)).alias("details"))


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---- row rules ------------------------------------------------------------------------------------------------------

def required_rules(fields: Sequence[str]) -> list[Rule]:
    return [Rule("REQUIRED_VALUE_MISSING", P.is_blank(f), "A required value is blank.", f) for f in fields]


def integer_rules(field: str, required: bool, expected: int | None = None, minimum: int | None = None) -> list[Rule]:
    """Not an integer; not the contract value; below the minimum. A blank optional cell is fine."""
    code, raw, n = "INVALID_INTEGER_VALUE", F.col(field), P.strict_int(field)
    present = F.lit(True) if required else ~P.is_blank(field)
    out = [Rule(code, present & n.isNull(), "The value is not an integer.", field, (("value", P.text(raw)),))]
    if expected is not None:
        out.append(Rule(code, F.coalesce(n != expected, F.lit(False)), "The value differs from the contract value.",
                        field, (("value", n), ("expected", F.lit(expected)))))
    if minimum is not None:
        out.append(Rule(code, F.coalesce(n < minimum, F.lit(False)), "The value is below the minimum.", field,
                        (("value", n), ("minimum", F.lit(minimum)))))
    return out


def institution_rules(dataset: str = "source_dataset", field: str = "institution_type") -> list[Rule]:
    # a dataset outside the list is held to the last entry, like every non-public source
    names = list(K.INSTITUTION_TYPES)
    first = F.col(dataset) == names[0]
    allowed = F.when(first, P.text(field).isin(list(K.INSTITUTION_TYPES[names[0]]))).otherwise(
        P.text(field).isin(list(K.INSTITUTION_TYPES[names[1]])))
    return [Rule("SOURCE_INSTITUTION_TYPE_MISMATCH", ~allowed, "The institution type does not fit the source.", field,
                 (("value", P.text(field)),))]


def domain_rules(code: str, fields: Sequence[str], domain: Sequence[str], blank_ok: bool = True) -> list[Rule]:
    out = []
    for f in fields:
        inside = P.text(f).isin([*domain, *([""] if blank_ok else [])])
        out.append(Rule(code, ~inside, "The value is outside the allowed set.", f, (("value", P.text(f)),)))
    return out


def boolean_rules(fields: Sequence[str] = K.BOOLEAN_FIELDS) -> list[Rule]:
    return domain_rules("INVALID_BOOLEAN_VALUE", fields, list(K.BOOLEANS))


def tristate_rules(fields: Sequence[str] = K.TRISTATE_FIELDS) -> list[Rule]:
    return domain_rules("INVALID_TRISTATE_VALUE", fields, K.TRISTATE)


def quadstate_rules(field: str = "common_test_required") -> list[Rule]:
    return domain_rules("INVALID_COMMON_TEST_REQUIRED", [field], K.QUADSTATE_SOURCE)


def enum_rules() -> list[Rule]:
    return [*domain_rules("INVALID_ENUM_VALUE", ["exclusive_enrollment_status"], K.EXCLUSIVE_STATUSES, blank_ok=False),
            *domain_rules("INVALID_ENUM_VALUE", ["verification_grade"], K.VERIFICATION_GRADES)]


def mapping_rules() -> list[Rule]:
    out = []
    for code, field, status in (
        ("DETAIL_COMPLETENESS_UNMAPPED", "detail_completeness", P.detail_status()),
        ("RESEARCH_ACTIVITY_LEVEL_UNMAPPED", "research_activity_level", P.research_status()),
    ):
        out.append(Rule(code, F.coalesce(status == "unmapped", F.lit(False)), "No approved mapping for this value.",
                        field, (("raw_value", F.col(field)),)))
    return out


def common_test_rules(a: str = "common_test_required", b: str = "selection_common_test") -> list[Rule]:
    renamed = P.text(a)
    for old, new in K.QUADSTATE_RENAME.items():
        renamed = F.when(renamed == old, F.lit(new)).otherwise(renamed)
    return [Rule("COMMON_TEST_FIELDS_DIFFER", (renamed != "") & (P.text(b) != "") & (renamed != P.text(b)),
                 "Two related fields differ; they need not agree.", None, ((a, renamed), (b, P.text(b))))]


def url_rule(field: str, when: Column, message: str) -> Rule:
    return Rule("PROVENANCE_URL_MISSING", P.is_blank(field) & when, message, field)


def master_url_rules() -> list[Rule]:
    return [
        url_rule("source_url", F.lit(True), "The record has no source URL."),
        url_rule("exclusive_enrollment_evidence_url", P.text("exclusive_enrollment_status") != K.EXCLUSIVE_UNKNOWN,
                 "A known exclusivity status has no evidence URL."),
        url_rule("previous_year_source_url", F.coalesce(P.strict_bool("fallback_previous_year"), F.lit(False)),
                 "A record taken over from last year has no URL for it."),
    ]


def coverage_url_rules() -> list[Rule]:
    out_of_scope = P.text("undergraduate_scope").startswith(K.OUT_OF_SCOPE) | (P.text("research_status") == K.OUT_OF_SCOPE)
    counted = F.coalesce(P.strict_int("master_rows") != 0, F.lit(False))
    return [url_rule("official_source_url", counted | ~out_of_scope, "An in-scope coverage row has no official URL.")]


def research_url_rules() -> list[Rule]:
    return [url_rule("source_url", F.lit(True), "The requirement row has no source URL.")]


def whitespace_rules(fields: Sequence[str]) -> list[Rule]:
    out = []
    for f in fields:
        # a blank or missing cell is never padded, and a missing one makes the test NULL, which flags nothing
        out.append(Rule("WHITESPACE_PADDING", P.padded(f), "The value has leading or trailing space; it is kept.", f,
                        (("leading", P.leading_space(f)), ("trailing", P.trailing_space(f)))))
    return out


def date_rules(fields: Sequence[str] = K.DATE_FIELDS) -> list[Rule]:
    out = []
    for f in fields:
        status = P.date_status(f)
        for code, value in (("DATE_RAW_PARTIAL", "partial"), ("DATE_RAW_UNPARSED", "unparsed")):
            out.append(Rule(code, status == value, "The raw date is not one plain date.", f,
                            (("raw_value", F.col(f)), ("parse_status", F.lit(value)))))
    return out


def zero_rows_rule() -> list[Rule]:
    fields = ("undergraduate_scope", "research_status", "current_year_status", "fallback_status")
    described = reduce(lambda a, b: a | b, [~P.is_blank(f) for f in fields])
    return [Rule("COVERAGE_ZERO_MASTER_ROWS", F.coalesce(P.strict_int("master_rows") == 0, F.lit(False)) & described,
                 "The coverage row states that there are no records.")]


def blank_key_rule(code: str, fields: Sequence[str]) -> list[Rule]:
    blank = reduce(lambda a, b: a | b, [P.is_blank(f) for f in fields])
    return [Rule(code, blank, "The key is blank.", fields[0] if len(fields) == 1 else None)]


def row_rules(contract: K.TableContract) -> list[Rule]:
    """All row rules of one of the three contract tables, on its source form plus ``source_dataset``."""
    fields = K.source_columns(contract)
    if contract.name == K.MASTER.name:
        return [*blank_key_rule("MASTER_PK_BLANK", ["record_id"]), *required_rules(["university", "verified_on"]),
                *integer_rules("admission_year", True, expected=K.CONTRACT_YEAR),
                *integer_rules("information_year", False), *institution_rules(), *required_rules(K.SPECIAL_FLAGS),
                *boolean_rules(), *tristate_rules(), *quadstate_rules(), *enum_rules(), *mapping_rules(),
                *common_test_rules(), *master_url_rules(), *whitespace_rules(fields), *date_rules()]
    if contract.name == K.COVERAGE.name:
        return [*blank_key_rule("COVERAGE_KEY_BLANK", ["university", "institution_type"]), *institution_rules(),
                *integer_rules("master_rows", True, minimum=0), *required_rules(["checked_on"]), *zero_rows_rule(),
                *coverage_url_rules(), *whitespace_rules(fields), *date_rules(["checked_on"])]
    return [*blank_key_rule("RESEARCH_ADMISSION_ID_BLANK", ["admission_id"]),
            *required_rules(["university", "verified_on"]), *research_url_rules(), *whitespace_rules(fields),
            *date_rules(["verified_on"])]


# ---- set rules ------------------------------------------------------------------------------------------------------

def pair_issues(df: DataFrame, matrix: dict[str, str] = K.VERSION_MATRIX, dataset: str = "source_dataset",
                version: str = "source_version") -> DataFrame:
    """(dataset, version) pairs outside the version matrix, with their number of rows.

    The pairs are counted first, so what is checked is one row per pair.
    """
    pairs = df.groupBy(dataset, version).agg(F.count("*").alias("rows"))
    wanted = reduce(lambda acc, kv: F.when(F.col(dataset) == kv[0], F.lit(kv[1])).otherwise(acc),
                    matrix.items(), F.lit(None).cast("string"))
    code = F.when(wanted.isNull(), "SOURCE_DATASET_UNSUPPORTED").when(
        ~F.col(version).eqNullSafe(wanted), "SOURCE_VERSION_MISMATCH")
    return pairs.select(code.alias("code"), dataset, version, "rows").where("code is not null")


def repeats(df: DataFrame, key: Sequence[str], order: str, keep: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Second and later rows of a key by ``order``, each with the order value of the first.

    The first row per key comes from a combined aggregate, and only keys used twice meet the rows again, spread over
    salts when one of them is hot. No window has to hold a whole group.
    """
    # as one struct the key compares NULL equal to NULL, so rows with a missing part are found as well
    keyed = df.select(F.struct(*key).alias("_key"), *dict.fromkeys([order, *keep]))
    # read twice, by the list of hot keys and by the join
    firsts = settle(keyed.groupBy("_key").agg(F.count("*").alias("_n"), F.min(order).alias("first_row")).where("_n > 1"), "first-rows")
    joined = attach(keyed, firsts, ["_key"], "_n", [order], hot_rows=hot_rows)
    extra = [c for c in dict.fromkeys([order, *keep]) if c not in key]
    return joined.where(F.col(order) > F.col("first_row")).select("_key.*", *extra, "first_row")


def first_row(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """First row and frequency of every key used more than once."""
    return (df.groupBy(*key).agg(F.count("*").alias("frequency"), F.min(order).alias("first_row"))
            .where("frequency > 1"))


def duplicate_key_issues(df: DataFrame, key: Sequence[str], order: str, code: str = "MASTER_PK_DUPLICATE",
                         table: str = "master", dataset: str = "source_dataset",
                         record_id: Column | str | None = None) -> DataFrame:
    """Later rows of a key that is used more than once; blank keys are another finding and left out."""
    filled = reduce(lambda a, b: a & b, [~P.is_blank(k) for k in key])
    again = repeats(df.where(filled), [dataset, *key], order)
    rid = record_id if record_id is not None else (
        F.col(key[0]) if len(key) == 1 else F.concat_ws(":", *[F.col(k).cast("string") for k in key]))
    return issue_rows(again, code, "The key is used more than once.", table, dataset, rid, order,
                      key[0] if len(key) == 1 else None, [("first_row_number", F.col("first_row"))])


def duplicate_row_issues(df: DataFrame, cols: Sequence[str], order: str, code: str = "RESEARCH_EXACT_DUPLICATE",
                         table: str = "research_requirements", dataset: str = "source_dataset",
                         record_id: str = "admission_id", written: bool = False, kinds: Kinds | None = None) -> DataFrame:
    """Second and later identical rows over ``cols``; all copies stay in the data.

    Rows are counted by hash; whole rows are moved, and compared by content, only where a hash has several (and for some few
    others that the bit map lets through). ``written`` rows are read as they are, others are written first.
    """
    keys = list(dict.fromkeys([dataset, *cols]))
    rows = df.select(*dict.fromkeys([*keys, order, record_id]))
    rows = (rows if written else settle(rows, "marked-rows")).withColumn("_f", F.xxhash64(*null_marked(keys)))
    several = settle(rows.groupBy("_f").agg(F.count("*").alias("_n")).where("_n > 1").select("_f"), "shared-hashes")
    again = repeats(settle(maybe_listed(rows, several, "_f").drop("_f"), "rows-of-shared-hashes"), keys, order, keep=[record_id])
    found = issue_rows(again, code, "The row is an exact copy of an earlier one.", table, dataset, record_id, order,
                       None, [("first_row_number", F.col("first_row"))])
    return found.withColumn("kind", F.lit(kinds[table, code, None])) if kinds else found


def count_mismatch_issues(coverage: DataFrame, parent: DataFrame, key: Sequence[str], declared_col: str,
                          dataset: str = "source_dataset", row: str = ROW) -> DataFrame:
    """Declared count against the real group count, 0 where the group is absent."""
    key = list(key)
    actual = parent.groupBy(*key).agg(F.count("*").alias("_actual"))
    declared = P.strict_int(F.col(declared_col).cast("string"))
    joined = (coverage.withColumn("_declared", declared).where("_declared is not null")
              .join(actual, key, "left").withColumn("_actual", F.coalesce("_actual", F.lit(0)))
              .where("_declared <> _actual"))
    label = F.concat_ws(":", *[F.col(k).cast("string") for k in key if k not in (dataset, "source_version")])
    return issue_rows(joined, "COVERAGE_MASTER_ROWS_MISMATCH", "The declared count differs from the real one.",
                      "coverage", dataset, label, row, declared_col,
                      [("declared", F.col("_declared")), ("actual", F.col("_actual"))])


def orphan_issues(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]], dataset: str = "source_dataset",
                  row: str = ROW) -> DataFrame:
    """Children whose non-blank key has no parent. ``on`` lists (child column, parent column)."""
    keys = parent.select(*[F.col(p).alias(c) for c, p in on])
    ref = on[-1][0]
    lost = child.where(~P.is_blank(F.col(ref).cast("string"))).join(keys, [c for c, _ in on], "left_anti")
    return issue_rows(lost, "RESEARCH_ORPHAN_FK", "The child does not resolve to a parent.",
                      "research_requirements", dataset, ref, row, ref)


def first_parent(parent: DataFrame, keys: Sequence[str], cols: Sequence[str], order: str) -> DataFrame:
    """The first row per key, where later ones are reported as duplicates elsewhere."""
    first = parent.groupBy(*keys).agg(F.min_by(F.struct(*cols), order).alias("_p"))
    return first.select(*keys, *[F.col(f"_p.{c}").alias(c) for c in cols])


def denormalized_issues(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]],
                        cols: Sequence[str] = K.DISPLAY_FIELDS, dataset: str = "source_dataset", row: str = ROW,
                        order: str | None = None) -> DataFrame:
    """Copied display fields that differ from the parent; ``order`` names the parent's row order when keys repeat."""
    names = [c for c, _ in on]
    p = parent.select(*[F.col(pc).alias(c) for c, pc in on], *[F.col(c).alias(f"_p_{c}") for c in cols],
                      *([F.col(order).alias("_o")] if order else []))
    if order:
        p = first_parent(p, names, [f"_p_{c}" for c in cols], "_o")
        sizes = child.groupBy(*names).agg(F.count("*").alias("_n"))
        both = attach(child, p.join(sizes, names), names, "_n", [row])
    else:
        both = child.join(p, names)
    cells = F.array_compact(F.array(*[
        F.when(P.text(c) != P.text(f"_p_{c}"), F.struct(
            F.lit(c).alias("field"), P.text(f"_p_{c}").alias("parent"), P.text(c).alias("child"))) for c in cols]))
    found = both.select(dataset, *[n for n in names if n != dataset], row, F.explode(cells).alias("d"))
    return issue_rows(found, "RESEARCH_DENORMALIZED_FIELD_MISMATCH", "A copied field differs from the parent.",
                      "research_requirements", dataset, names[-1], row, F.col("d.field"),
                      [("parent_value", F.col("d.parent")), ("child_value", F.col("d.child"))])


def child_flag_issues(parent: DataFrame, child: DataFrame, on: Sequence[tuple[str, str]],
                      flag_col: str = "research_requirement_required", dataset: str = "source_dataset",
                      row: str = ROW) -> DataFrame:
    """Flag Yes without children, or No with children. ``on`` lists (child column, parent column)."""
    counts = (child.groupBy(*[F.col(c).alias(p) for c, p in on]).agg(F.count("*").alias("_children")))
    both = parent.join(counts, [p for _, p in on], "left").withColumn("_children", F.coalesce("_children", F.lit(0)))
    rid = on[-1][1]
    rules = [
        Rule("RESEARCH_REQUIRED_WITHOUT_CHILD", (F.col(flag_col) == "Yes") & (F.col("_children") == 0),
             "Details are required but there is no detail row."),
        Rule("RESEARCH_NOT_REQUIRED_WITH_CHILD", (F.col(flag_col) == "No") & (F.col("_children") > 0),
             "Detail rows exist although none are required.", None, (("child_rows", F.col("_children")),)),
    ]
    return apply_rules(both, rules, "master", dataset, rid, row)


# ---- summary --------------------------------------------------------------------------------------------------------

def summarize_issues(issues: DataFrame, n: int = 5) -> DataFrame:
    """One row per code: severity, count, count per dataset and the first ``n`` distinct record ids by row order."""
    counts = (issues.groupBy("code", "severity", "dataset").agg(F.count("*").alias("n"))
              .groupBy("code", "severity").agg(
                  F.sum("n").alias("count"),
                  F.sort_array(F.collect_list(F.struct("dataset", "n"))).alias("by_dataset")))
    ids = (issues.where(~P.is_blank("record_id")).groupBy("code", "record_id")
           .agg(F.min(F.struct("dataset", "row_number")).alias("at")))
    w = Window.partitionBy("code").orderBy("at", "record_id")
    firsts = (ids.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
              .groupBy("code").agg(F.sort_array(F.collect_list(F.struct("rn", "record_id"))).alias("f"))
              .select("code", F.transform("f", lambda x: x["record_id"]).alias("representative_record_ids")))
    return counts.join(firsts, "code", "left")


def count_kinds(issues: DataFrame, kinds: Kinds) -> DataFrame:
    """(table, code, dataset, field): findings, different record ids and the sum of row numbers. ``issues`` have their ``kind``.

    Ids are told apart by one row per record, in which the kinds found of it are bits; a row per finding would move instead.
    """
    of_id, word = F.col("_of_id"), lambda n: f"_bits{n // 64}"
    each = (issues.select("dataset", "record_id", "row_number", "kind", F.explode(F.array(F.lit(False), F.lit(True))).alias("_of_id"))
            .where("NOT _of_id OR record_id IS NOT NULL"))
    bit = F.expr("shiftleft(1L, kind % 64)")
    sums = each.groupBy("dataset", F.when(of_id, F.col("record_id")).alias("_id"), F.when(~of_id, F.col("kind")).alias("_kind")).agg(
        F.count_if(~of_id).alias("_n"), F.sum(F.when(~of_id, F.col("row_number"))).alias("_rows"),
        *[F.bit_or(F.when(of_id & (F.shiftright("kind", 6) == w), bit)).alias(f"_bits{w}") for w in range(-(-len(kinds) // 64))])
    held = F.array_compact(F.array(*[F.when(F.getbit(word(n), F.lit(n % 64)) == 1, F.lit(n)) for n in kinds.values()]))
    counts = (sums.select("dataset", "_n", "_rows", F.col("_id").isNotNull().alias("_one"),
                          F.explode(F.when(F.col("_kind").isNotNull(), F.array("_kind")).otherwise(held)).alias("kind"))
              .groupBy("dataset", "kind").agg(F.sum("_n").alias("n"), F.count_if("_one").alias("ids"), F.sum("_rows").alias("row_numbers")))
    about = F.array(*[F.struct(F.lit(t).alias("table"), F.lit(c).alias("code"), F.lit(f).cast("string").alias("field")) for t, c, f in sorted(kinds, key=kinds.get)])
    return counts.withColumn("_about", F.element_at(about, F.col("kind") + 1)).select(
        "_about.table", "_about.code", "dataset", "_about.field", "n", "ids", "row_numbers")


def issue_status(issues: DataFrame) -> DataFrame:
    """One row: counts by severity and the overall verdict."""
    sums = issues.agg(F.count("*").alias("total_issues"),
                      *[F.count_if(F.col("severity") == s).alias(s) for s in K.SEVERITIES])
    verdict = (F.when(F.col("total_issues") == 0, "passed").when(F.col("error") > 0, "failed")
               .otherwise("passed_with_findings"))
    return sums.withColumn("status", verdict)


def issues_by_dataset(issues: DataFrame) -> DataFrame:
    return (issues.groupBy("dataset").pivot("severity", list(K.SEVERITIES)).agg(F.count("severity"))
            .na.fill(0).withColumn("total", F.col("error") + F.col("warning") + F.col("informational")))


def status_metrics(df: DataFrame, statuses: dict[str, Column], dataset: str = "source_dataset") -> DataFrame:
    """Rows per dataset and mapped status, NULL reported as ``null``."""
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.coalesce(c, F.lit("null")).alias("status"))
                      for n, c in statuses.items()])
    return (df.select(dataset, F.explode(pairs).alias("m")).groupBy(dataset, "m.metric", "m.status")
            .agg(F.count("*").alias("rows")))
