"""Classification of raw text through reviewed exact-value crosswalks. Whatever is not listed stays visibly unknown.

Crosswalks come in long form (one row per membership). They are folded to one row per raw value first, so a lookup
never multiplies records, and joined by broadcast only while they are small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as P
from ..functions.skew import are_small, join_keyed, join_small_or_keyed
from ..sources.shared import settle
from .views import beside

# ---- fixed values: vocabularies and notes of the classification layers -----------------------------------------------
NOTE_MISSING = "原値がSQL NULL"
NOTE_UNMAPPED = "監査済みcrosswalkにない新規原値"
NOTE_CONFLICT = "crosswalk entries of this value differ"
NOTE_NO_RAW = "No frozen exact raw-value mapping."
SAFE_LABELS = ("required", "not_required")
SAFE_FLOORS = ("safe_simple_overall", "safe_overall_with_additional_conditions")
TIERS = ("safe_numeric", "conditional_numeric", "do_not_numeric")
SAFE_CLASS = "simple_overall_minimum"
UNSAFE_FLAGS = ("subject", "and", "or", "branch", "historical", "nonbinding")
CONDITIONAL_TYPES = {
    "or_condition": "alternative_or",
    "overall_and_subject_compound": "compound_and",
    "and_condition": "compound_and",
    "subject_specific_condition": "subject_specific",
    "branch_condition": "branching",
    "range_or_upper_condition": "other",
    "other_complex_numeric": "other",
}
# class -> (condition type, parse status, disposition)
NON_NUMERIC = {
    "unknown": ("unknown", "unknown", "not_searchable"),
    "unresolved": ("other", "unparsed", "review_required"),
    "explicit_no_numeric_threshold": ("no_numeric_threshold", "not_numeric", "not_searchable"),
    "non_numeric_condition": ("qualitative", "not_numeric", "not_searchable"),
    "non_admission_or_inoperative_numeric": ("non_admission_numeric", "not_numeric", "not_searchable"),
    "nonbinding_or_historical_numeric": ("qualitative", "not_numeric", "not_searchable"),
}
SCOPELESS_CLASSES = ("null", "explicit_no_numeric_threshold", "non_numeric_condition")
LONG_STATUSES = ("single", "multi", "review_required")
CONTEXT_KEY = ("source_dataset", "university", "faculty_school", "department", "academic_field")
# ---- end of fixed values ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layer:
    """One derived layer: a one-row-per-key lookup and the columns that follow from it.

    ``on`` pairs record expressions with key columns of ``facts``; ``size_of`` is the crosswalk whose row count proves
    that ``facts`` is small; ``helpers`` are intermediate columns the outputs use.
    """

    facts: DataFrame
    on: tuple[tuple[Column, str], ...]
    size_of: DataFrame
    outputs: dict[str, Column]
    helpers: dict[str, Column] = field(default_factory=dict)


def apply_layers(df: DataFrame, layers: Sequence[Layer], spread: Sequence[str] = ("record_id",)) -> DataFrame:
    """Join every lookup and derive all outputs in one projection.

    Whether the lookups are small enough to broadcast is settled by one counting job for all of them; a larger one is
    joined by key with hot values spread. Those come first, so that what they shuffle has no columns of the others.
    """
    keep = df.columns
    sized = zip(layers, are_small([x.size_of for x in layers]))
    for layer, small in sorted(sized, key=lambda x: x[1]):
        if small:
            cond = reduce(lambda a, b: a & b, [expr == F.col(name) for expr, name in layer.on])
            df = df.join(F.broadcast(layer.facts), cond, "left")
        else:
            keys = {f"_key{i}": expr for i, (expr, _) in enumerate(layer.on)}
            rows = df.withColumns(keys)
            facts = layer.facts.withColumns({f"_key{i}": F.col(name) for i, (_, name) in enumerate(layer.on)})
            df = join_keyed(rows, facts, list(keys), spread).drop(*keys)
    if any(x.helpers for x in layers):
        df = df.select("*", *[c.alias(n) for x in layers for n, c in x.helpers.items()])
    return df.select(*keep, *[c.alias(n) for x in layers for n, c in x.outputs.items()])


def settled(xw: DataFrame, cols: Sequence[str], key: str = "raw_value") -> DataFrame:
    """One row per raw value: ``cols`` of its entries, and ``conflict`` where they do not agree.

    A crosswalk that lists a value twice must not multiply records, nor may the job pick one of two readings.
    """
    same = F.struct(*cols)
    g = xw.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(same).alias("_lo"), F.max(same).alias("_hi"))
    return g.select(key, "_lo.*", (F.col("_lo") != F.col("_hi")).alias("conflict"))


def label_layer(raw: str, xw: DataFrame, on_null: str = "unknown", on_unmapped: str = "unmapped",
                status: str = "requirement_status", names: Sequence[str] = ()) -> Layer:
    """Single-label classification: status, how it was found, its search disposition and the note.

    ``names`` renames these four outputs.
    """
    one = settled(xw, [status, "review_note"])
    facts = one.select(F.col("raw_value").alias("_lraw"), F.when(F.col("conflict"), "review_required").otherwise(F.col(status)).alias("_ls"),
                       F.when(F.col("conflict"), NOTE_CONFLICT).otherwise(F.col("review_note")).alias("_lnote"))
    missing, found, s = F.col(raw).isNull(), F.col("_lraw").isNotNull(), F.col("_ls")
    outputs = (
        F.when(missing, on_null).when(found, s).otherwise(on_unmapped),
        F.when(missing, "missing").when(found, "exact_crosswalk").otherwise("unmapped"),
        F.when(missing, "not_searchable").when(~found, "review_required").when(s.isin(list(SAFE_LABELS)), "safe_exact")
        .when(s == "review_required", "review_required").otherwise("not_searchable"),
        F.when(missing, NOTE_MISSING).when(~found, NOTE_UNMAPPED).otherwise(P.null_if_blank("_lnote")),
    )
    names = names or (status, "parse_status", "search_disposition", "review_note")
    return Layer(facts, ((F.col(raw), "_lraw"),), xw, dict(zip(names, outputs)))


def classify(df: DataFrame, raw: str, xw: DataFrame, on_null: str = "unknown", on_unmapped: str = "unmapped",
             status: str = "requirement_status", spread: Sequence[str] = ("record_id",)) -> DataFrame:
    return apply_layers(df, [label_layer(raw, xw, on_null, on_unmapped, status)], spread)


def threshold_layer(raw: str, xw: DataFrame) -> Layer:
    """Threshold classification: status, integer floor, inclusive flag, additional-condition flag."""
    names = ("grade_requirement_status", "overall_gpa_min_tenths", "overall_gpa_min_inclusive", "overall_gpa_status",
             "additional_grade_conditions")
    one = settled(xw, names)
    read = lambda c: F.when(~F.col("conflict"), F.col(c)).otherwise("review_required") if c.endswith("_status") else F.when(~F.col("conflict"), F.col(c))
    facts = one.select(F.col("raw_value").alias("_traw"), *[read(c).alias(f"_t_{c}") for c in names])
    missing, found = F.col(raw).isNull(), F.col("_traw").isNotNull()
    outputs = {c: F.when(missing, "unknown").when(found, F.col(f"_t_{c}")).otherwise("unmapped") if c.endswith("_status")
               else F.col(f"_t_{c}") for c in names}
    outputs["grade_parse_status"] = F.when(missing, "missing").when(found, "exact_crosswalk").otherwise("unmapped")
    return Layer(facts, ((F.col(raw), "_traw"),), xw, outputs)


def classify_threshold(df: DataFrame, raw: str, xw: DataFrame, spread: Sequence[str] = ("record_id",)) -> DataFrame:
    return apply_layers(df, [threshold_layer(raw, xw)], spread)


def _by_value(c: Column, values: Mapping[str, str | Column], rest: Column | str | None) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return reduce(lambda acc, kv: F.when(c == kv[0], as_col(kv[1])).otherwise(acc), values.items(), as_col(rest).cast("string"))


def _rule_facts(rules: DataFrame) -> DataFrame:
    """The rule table with everything that depends on the rule alone worked out, so a record only picks."""
    tier, cls, flags = F.col("distinct_tier"), F.col("primary_class"), F.split(P.text("feature_flags"), ";")
    flag = lambda name: F.array_contains(flags, name)
    scope = (F.when(cls == "subject_specific_condition", "subject")
             .when((cls == "overall_and_subject_compound") | flag("subject"), "mixed")
             .when(cls.isin(list(SCOPELESS_CLASSES)), "none").when(tier == "conditional_numeric", "overall")
             .otherwise("unknown"))
    by_class = lambda n: _by_value(cls, {k: v[n] for k, v in NON_NUMERIC.items()}, ("other", "unparsed", "review_required")[n])
    # a value with rules that differ counts as unlisted: it goes to review and carries no number
    one = settled(rules, ["distinct_tier", "primary_class", "feature_flags", "safe_gpa_min"]).where("NOT conflict")
    return one.select(
        F.col("raw_value").alias("_rraw"), tier.alias("_tier"), P.to_tenths("safe_gpa_min").alias("_min"), scope.alias("_scope"),
        by_class(0).alias("_type"), by_class(1).alias("_parse"), by_class(2).alias("_disposition"),
        _by_value(cls, CONDITIONAL_TYPES, None).alias("_conditional"), flag("historical").alias("_historical"),
        *[flag(f).alias(f"_has_{f}") for f in RULE_FLAGS])


RULE_FLAGS = ("subject", "and", "or", "branch")


def rule_layer(raw: str, rules: DataFrame, admission_year: str = "admission_year", information_year: str = "information_year",
               fallback: str = "fallback_previous_year", names: Mapping[str, str] | None = None) -> Layer:
    """Numeric rule with time validity. Order matters: missing, last year's, unlisted, safe, conditional, other.

    A safe rule counts only when both years are known and agree. ``names`` renames outputs.
    """
    no = F.lit(False)
    raw_null, found, tier = F.col(raw).isNull(), F.col("_rraw").isNotNull(), F.col("_tier")
    a, i = F.col(admission_year), F.col(information_year)
    historical = F.coalesce(F.col(fallback), no) | F.coalesce("_historical", no) | F.coalesce(a != i, no)
    case = (F.when(raw_null, F.when(historical, "missing_old").otherwise("missing")).when(historical, "historical").when(~found, "unlisted")
            .when(tier == "safe_numeric", F.when(F.coalesce(a == i, no), "safe").otherwise("undated"))
            .when(tier == "conditional_numeric", "conditional").otherwise("other"))
    safe = F.col("_case") == "safe"
    pick = lambda rest, **values: _by_value(F.col("_case"), values, rest)
    missing = lambda v: {"missing": v, "missing_old": v}
    outputs = {
        "numeric_safety_tier": pick("do_not_numeric", safe="safe_numeric", conditional="conditional_numeric"),
        "gpa_min_tenths": F.when(safe, F.col("_min")),
        "gpa_min_inclusive": F.when(safe, F.lit(True)),
        "gpa_max_tenths": F.lit(None).cast("int"),
        "gpa_max_inclusive": F.lit(None).cast("boolean"),
        "gpa_scale": pick("unknown", safe="japanese_5_point", conditional="japanese_5_point"),
        "metric_scope": pick(F.coalesce("_scope", F.lit("unknown")), **missing("none"), unlisted="unknown", undated="unknown", safe="overall"),
        "gpa_condition_type": pick(F.col("_type"), **missing("not_applicable"), historical="historical_reference", unlisted="other",
                                   undated="other", safe="simple_overall_minimum", conditional=F.col("_conditional")),
        "parse_status": pick(F.col("_parse"), **missing("not_applicable"), historical="historical_reference", unlisted="unparsed",
                             undated="unparsed", safe="parsed_safe", conditional="conditional_review"),
        "search_disposition": pick(F.col("_disposition"), **missing("not_searchable"), historical="not_searchable",
                                   unlisted="review_required", undated="review_required", safe="safe_numeric",
                                   conditional="review_required"),
        "source_value_status": pick("current", historical="previous_year_reference", missing_old="previous_year_reference"),
        **{f"has_{f}_condition": F.coalesce(f"_has_{f}", no) for f in RULE_FLAGS},
    }
    names = names or {}
    return Layer(_rule_facts(rules), ((F.col(raw), "_rraw"),), rules, {names.get(n, n): c for n, c in outputs.items()}, {"_case": case})


def classify_rule(df: DataFrame, raw: str, rules: DataFrame, admission_year: str = "admission_year",
                  information_year: str = "information_year", fallback: str = "fallback_previous_year",
                  spread: Sequence[str] = ("record_id",)) -> DataFrame:
    return apply_layers(df, [rule_layer(raw, rules, admission_year, information_year, fallback)], spread)


# ---- memberships -----------------------------------------------------------------------------------------------------

def fold_crosswalk(xw: DataFrame, code: str = "group_code", order: str = "group_order", prefix: str = "") -> DataFrame:
    """Long crosswalk to one row per raw value; the set per value is bounded by the taxonomy.

    A value whose entries differ in status, or that is under review, is under review and has no members.
    """
    member = F.when(~P.is_blank(code), F.struct(F.col(order).cast("int").alias("order"), F.col(code).alias("code")))
    members = F.sort_array(F.collect_set(member))
    return xw.groupBy(F.col("raw_value").alias(prefix + "raw_value")).agg(
        _agreed("mapping_status").alias(prefix + "mapping_status"), F.min("review_note").alias(prefix + "review_note"),
        F.when(_agreed("mapping_status") == "review_required", F.slice(members, 1, 0)).otherwise(members).alias(prefix + "members"))


def _differ(status: str) -> Column:
    """Whether the entries of a group have no one status: two, or none in one of them."""
    return (F.count(status) < F.count(F.lit(1))) | F.coalesce(F.min(status) != F.max(status), F.lit(False))


def _agreed(status: str) -> Column:
    """The status that all entries of a group share; under review if they differ or one has none."""
    return F.when(_differ(status), "review_required").otherwise(F.min(status))


EMPTY_MEMBERS = "array<struct<code:string,order:int,basis:string>>"


def multi_layer(raw: str, xw: DataFrame, on_null: str = "not_applicable", code: str = "group_code", order: str = "group_order",
                names: Sequence[str] = ("mapping_status", "mapping_note", "memberships"), codes_only: bool = False) -> Layer:
    """Multi-label classification: status, note and an ordered array of (code, order, basis), or of codes."""
    p = f"_m_{raw}_"
    missing, found = F.col(raw).isNull(), F.col(p + "raw_value").isNotNull()
    if codes_only:
        shape, empty = lambda m: m["code"], "array<string>"
    else:
        shape = lambda m: F.struct(m["code"].alias("code"), m["order"].alias("order"), F.lit("raw_exact").alias("basis"))
        empty = EMPTY_MEMBERS
    facts = fold_crosswalk(xw, code, order, p).withColumn(p + "members", F.transform(p + "members", shape))
    outputs = (
        F.when(missing, on_null).when(found, F.col(p + "mapping_status")).otherwise("unmapped"),
        F.when(missing, NOTE_MISSING).when(found, P.null_if_blank(p + "review_note")).otherwise(NOTE_UNMAPPED),
        F.coalesce(p + "members", F.array().cast(empty)),
    )
    return Layer(facts, ((F.col(raw), p + "raw_value"),), xw, dict(zip(names, outputs)))


def classify_multi(df: DataFrame, raw: str, xw: DataFrame, on_null: str = "not_applicable", code: str = "group_code",
                   order: str = "group_order", spread: Sequence[str] = ("record_id",)) -> DataFrame:
    """Adds ``mapping_status``, ``mapping_note`` and ``memberships``."""
    return apply_layers(df, [multi_layer(raw, xw, on_null, code, order)], spread)


def membership_rows(df: DataFrame, key: Sequence[str], array: str = "memberships") -> DataFrame:
    """The child table of an array of memberships."""
    return df.select(*key, F.explode(array).alias("m")).select(*key, "m.*")


PAIRS = "array<struct<broad_rank:int,group_code:string,sub_rank:int,subcategory_code:string,parent:string>>"


def fold_pairs(xw: DataFrame, keys: Mapping[str, Column], broad: DataFrame, sub: DataFrame, prefix: str, extra: Sequence[str] = ()) -> DataFrame:
    """Two-level crosswalk to one row per key, its (group, subcategory) pairs carrying their taxonomy ranks."""
    b = broad.select(F.col("group_code").alias("_bg"), F.col("rank").alias("broad_rank"))
    s = sub.select(F.col("subcategory_code").alias("_sc"), F.col("rank").alias("sub_rank"), F.col("parent_group_code").alias("parent"))
    group, code = P.null_if_blank("group_code"), P.null_if_blank("subcategory_code")
    pair = F.when(group.isNotNull(), F.struct("broad_rank", group.alias("group_code"), "sub_rank", code.alias("subcategory_code"), "parent"))
    return (xw.join(b, group == F.col("_bg"), "left").join(s, code == F.col("_sc"), "left")
            .groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
                _agreed("mapping_status").alias(prefix + "status"), *[F.min(e).alias(prefix + e) for e in extra],
                F.min("review_note").alias(prefix + "note"),
                F.when(_differ("mapping_status"), F.array().cast(PAIRS)).otherwise(F.collect_set(pair)).alias(prefix + "pairs")))


def _resolved(facts: DataFrame, keys: Sequence[str], prefix: str, context: bool) -> DataFrame:
    """Final statuses and memberships per crosswalk entry, from its raw pairs ``_xpairs`` and context pairs ``_cpairs``."""
    nothing = F.array().cast(PAIRS)
    mode = F.col("_cmerge_mode") if context else F.lit(None).cast("string")
    facts = facts.withColumn("_cp", F.col("_cpairs") if context else nothing)
    facts = facts.withColumn("_all", F.when(mode == "authoritative", F.col("_cp")).otherwise(F.array_union("_xpairs", "_cp")))

    def codes(pairs: str, name: str) -> Column:
        return F.transform(pairs, lambda p: p[name])

    def members(rank: str, code: str, parent: bool) -> Column:
        ranked = F.sort_array(F.array_distinct(F.transform(
            F.filter("_all", lambda p: p[code].isNotNull()),
            lambda p: F.struct(p[rank].alias("rank"), p[code].alias("code"),
                               (p["parent"] if parent else p[code]).alias("parent")))))
        in_raw = lambda m: F.array_contains(codes("_xpairs", code), m["code"])
        in_ctx = lambda m: F.array_contains(codes("_cp", code), m["code"])
        basis = lambda m: (F.when(in_raw(m) & in_ctx(m), "raw_and_context").when(in_raw(m), "raw_exact")
                           .otherwise("context_exact"))
        return F.transform(ranked, lambda m, n: F.struct(
            m["code"].alias("code"), (n + 1).alias("order"), basis(m).alias("basis"), m["parent"].alias("parent")))

    m = facts.select("*", members("broad_rank", "group_code", False).alias("_b"),
                     members("sub_rank", "subcategory_code", True).alias("_s"))
    nb, ns, none = F.size("_b"), F.size("_s"), F.lit("none")
    review = F.col("_xstatus") == "review_required"
    review = review | (F.col("_cstatus") == "review_required") if context else review
    unresolved = F.when(F.coalesce(review, F.lit(False)), "review_required").otherwise("unmapped")
    effect = F.when((nb > 0) & (F.size("_cp") > 0), F.coalesce(mode, none)).otherwise(none)
    out = {
        "broad": F.when(nb == 0, unresolved).when(nb == 1, "single").otherwise("multi"),
        "sub": F.when(nb == 0, unresolved).when(ns == 0, "none").when(ns == 1, "single").otherwise("multi"),
        "effect": effect, "note": F.col("_cnote") if context else F.col("_xnote"), "b": F.col("_b"), "s": F.col("_s"),
        "bc": codes("_b", "code"), "sc": codes("_s", "code"), "effective": F.size("_cp") > 0,
    }
    return m.select(*keys, *[c.alias(prefix + n) for n, c in out.items()])


MEMBERS = "array<struct<code:string,order:int,basis:string,parent:string>>"


def context_layers(raw_xw: DataFrame, ctx_xw: DataFrame, broad: DataFrame, sub: DataFrame, raw: str = "academic_field",
                   context: Sequence[str] = CONTEXT_KEY) -> list[Layer]:
    """Two-level classification with exact context override, as the raw lookup and the context lookup.

    A context entry is used only for a listed raw value; ``authoritative`` replaces the raw memberships, ``additive``
    joins them. Memberships come in taxonomy order and say whether raw text, context or both gave them. A context key
    ends with the raw value, so both outcomes are settled per crosswalk entry and a record only picks one.
    """
    context = list(context)
    keys = [f"_c{i}" for i in range(len(context))]
    r = fold_pairs(raw_xw, {"_xraw": F.col("raw_value")}, broad, sub, "_x")
    # blank-filled keys make the context join a plain equi-join
    c = fold_pairs(ctx_xw, {k: P.text(name) for k, name in zip(keys, context)}, broad, sub, "_c", ["merge_mode"])
    by_raw = _resolved(r, ["_xraw"], "_r_", False)
    by_context = _resolved(c.join(r, F.col(keys[-1]) == F.col("_xraw")), keys, "_k_", True)

    raw_null, listed, hit = F.col(raw).isNull(), F.col("_xraw").isNotNull(), F.col("_c0").isNotNull()
    either = lambda n: F.when(hit, F.col("_k_" + n)).otherwise(F.col("_r_" + n))
    status = lambda n: F.when(raw_null, "not_applicable").when(~listed, "unmapped").otherwise(either(n))
    array = lambda n, kind: F.coalesce(f"_k_{n}", f"_r_{n}", F.array().cast(kind))
    outputs = {
        "broad_mapping_status": status("broad"), "subcategory_mapping_status": status("sub"),
        "context_mapping_consulted": hit, "context_mapping_effect": F.coalesce(either("effect"), F.lit("none")),
        "context_note": F.when(raw_null, None).when(~listed, NOTE_NO_RAW).otherwise(either("note")),
        "broad_memberships": array("b", MEMBERS), "subcategory_memberships": array("s", MEMBERS),
        "broad_codes": array("bc", "array<string>"), "subcategory_codes": array("sc", "array<string>"),
        "context_effective": F.coalesce(either("effective"), F.lit(False)),
    }
    return [Layer(by_raw, ((F.col(raw), "_xraw"),), raw_xw, {}),
            Layer(by_context, tuple((P.text(name), k) for k, name in zip(keys, context)), ctx_xw, outputs)]


def classify_context(df: DataFrame, raw_xw: DataFrame, ctx_xw: DataFrame, broad: DataFrame, sub: DataFrame,
                     raw: str = "academic_field", context: Sequence[str] = CONTEXT_KEY,
                     spread: Sequence[str] = ("record_id",)) -> DataFrame:
    return apply_layers(df, context_layers(raw_xw, ctx_xw, broad, sub, raw, context), spread)


def classify_records(df: DataFrame, rules: DataFrame, grade: DataFrame, english: DataFrame, field: DataFrame, place: DataFrame,
                     raw_xw: DataFrame, ctx_xw: DataFrame, broad: DataFrame, sub: DataFrame) -> DataFrame:
    """Records with every derived layer as plain columns and arrays: what search, facets and documents read.

    Seven lookups, one size check, one projection.
    """
    return apply_layers(df, [
        rule_layer("gpa_requirement", rules, names={
            "parse_status": "gpa_parse_status", "search_disposition": "gpa_search_disposition",
            "source_value_status": "gpa_source_value_status"}),
        threshold_layer("gpa_requirement", grade),
        label_layer("english_requirement", english, names=(
            "english_requirement_status", "english_parse_status", "english_search_disposition", "english_review_note")),
        multi_layer("academic_field", field, codes_only=True, names=(
            "academic_field_mapping_status", "academic_field_note", "academic_field_groups")),
        multi_layer("prefecture", place, codes_only=True, names=(
            "prefecture_mapping_status", "prefecture_note", "prefecture_memberships")),
        *context_layers(raw_xw, ctx_xw, broad, sub),
    ])


# ---- checks on crosswalks, taxonomies and rule tables ----------------------------------------------------------------

def _failures(checks: dict[str, Column]) -> Column:
    return F.explode(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()])))


def misordered(rows: DataFrame, key: Sequence[str], order: str, rank: str) -> DataFrame:
    """Keys whose entries do not rise in rank along their order.

    Entries are first folded to the lowest and highest order per rank, so what is put side by side for one key has at
    most one element per taxonomy code, however many rows the key owns.
    """
    per = (rows.where(F.col(order).isNotNull() & F.col(rank).isNotNull()).groupBy(*key, F.col(rank).alias("_r"))
           .agg(F.min(order).alias("lo"), F.max(order).alias("hi")))
    seq = per.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_r", "lo", "hi"))).alias("seq"))
    start = F.struct(F.lit(None).cast(rows.schema[order].dataType).alias("hi"), F.lit(False).alias("bad"))
    step = lambda acc, x: F.struct(F.greatest(acc["hi"], x["hi"]).alias("hi"),
                                   (acc["bad"] | F.coalesce(acc["hi"] > x["lo"], F.lit(False))).alias("bad"))
    return seq.select(*key, F.aggregate("seq", start, step)["bad"].alias("misordered")).where("misordered")


def check_crosswalk(xw: DataFrame, taxonomy: DataFrame, code: str = "group_code", order: str = "group_order",
                    rank: str = "display_order") -> DataFrame:
    """Issues per raw value of a long multi-label crosswalk. Everything is judged from one grouped aggregate."""
    tax = taxonomy.select(F.col(code), F.col(rank).cast("int").alias("_rank"))
    n = F.col("_order")
    has = F.col(code).isNotNull()
    c = xw.withColumns({code: P.null_if_blank(code), "_order": F.col(order).cast("string").try_cast("int")}).join(tax, code, "left")
    g = c.groupBy("raw_value").agg(
        F.count_distinct("mapping_status").alias("statuses"), F.min("mapping_status").alias("status"),
        F.count_distinct(P.text("review_note")).alias("notes"), F.max(P.text("review_note")).alias("note"),
        F.count_if(has).alias("codes"), F.count_distinct(code).alias("distinct_codes"),
        F.count_if(has & F.col("_rank").isNull()).alias("unknown_codes"),
        F.min(F.when(has, n)).alias("lo"), F.max(F.when(has, n)).alias("hi"),
        F.count_distinct(F.when(has, n)).alias("orders"),
        F.count_if(~has & ~P.is_blank(F.col(order).cast("string"))).alias("stray_orders"))
    g = g.join(misordered(c, ["raw_value"], "_order", "_rank"), "raw_value", "left")
    mapped_row = F.col("status").isin("single", "multi")
    return g.select("raw_value", _failures({
        "blank_raw_value": P.is_blank("raw_value"),
        "several_statuses": F.col("statuses") != 1,
        "status_not_allowed": ~F.col("status").isin(list(LONG_STATUSES)),
        "several_notes": F.col("notes") != 1,
        "review_without_note": (F.col("status") == "review_required") & (F.col("note") == ""),
        "review_with_codes": (F.col("status") == "review_required") & ((F.col("codes") > 0) | (F.col("stray_orders") > 0)),
        "unknown_code": F.col("unknown_codes") > 0,
        "repeated_code": F.col("codes") != F.col("distinct_codes"),
        "single_needs_one_code": (F.col("status") == "single") & (F.col("codes") != 1),
        "multi_needs_two_codes": (F.col("status") == "multi") & (F.col("codes") < 2),
        "order_not_contiguous": mapped_row & (F.col("codes") > 0) & ~(
            (F.col("lo") == 1) & (F.col("hi") == F.col("codes")) & (F.col("orders") == F.col("codes"))),
        "not_in_taxonomy_order": mapped_row & (F.col("unknown_codes") == 0) & F.col("misordered"),
    }).alias("issue"))


def check_taxonomy(tax: DataFrame, code: str, order: str, section: str | None = None,
                   parents: DataFrame | None = None, parent_code: str | None = None) -> DataFrame:
    """Repeated codes, display order not 1..n per section, unknown parents. ``parents`` has column ``parent_code``."""
    n = F.col(order).cast("string").try_cast("int")
    subject = lambda c: F.col(c).cast("string").alias("subject")
    codes = tax.groupBy(code).agg(F.count("*").alias("n")).where("n > 1")
    out = codes.select(F.lit("repeated_code").alias("issue"), subject(code))
    per = F.lit("all") if section is None else F.coalesce(F.col(section).cast("string"), F.lit("(none)"))
    sections = tax.groupBy(per.alias("_sec")).agg(
        F.count("*").alias("n"), F.min(n).alias("lo"), F.max(n).alias("hi"), F.count_distinct(n).alias("d"))
    gaps = sections.where("not (lo = 1 and hi = n and d = n) or lo is null")
    out = out.unionByName(gaps.select(F.lit("order_not_contiguous").alias("issue"), subject("_sec")))
    if parents is not None:
        lost = tax.join(parents.select(F.col(parent_code).alias(section)), section, "left_anti")
        out = out.unionByName(lost.select(F.lit("unknown_parent").alias("issue"), subject(code)))
    return out


def check_rules(rules: DataFrame) -> DataFrame:
    """Issues of the numeric rule table, one row per (raw value, issue); a missing NULL class is its own issue."""
    flags = F.split(P.text("feature_flags"), ";")
    lo, hi = P.text("safe_gpa_min"), P.text("safe_gpa_max")
    safe = F.col("distinct_tier") == "safe_numeric"
    per_row = rules.select(P.text("raw_value").alias("raw_value"), _failures({
        "tier_not_allowed": ~F.col("distinct_tier").isin(list(TIERS)),
        "not_reviewed": ~F.col("review_status").eqNullSafe("reviewed"),
        "safe_class": safe & (F.col("primary_class") != SAFE_CLASS),
        "safe_bounds": safe & (P.to_tenths(lo).isNull() | (hi != "")),
        "safe_with_unsafe_flag": safe & F.arrays_overlap(flags, F.array(*[F.lit(f) for f in UNSAFE_FLAGS])),
        "unsafe_with_bounds": ~safe & ((lo != "") | (hi != "")),
    }).alias("issue"))
    repeated = (rules.groupBy(P.text("raw_value").alias("raw_value")).agg(F.count("*").alias("n")).where("n > 1")
                .select("raw_value", F.lit("repeated_raw_value").alias("issue")))
    no_null = (rules.agg(F.count_if(P.is_blank("raw_value")).alias("n")).where("n = 0")
               .select(F.lit("").alias("raw_value"), F.lit("null_class_missing").alias("issue")))
    return per_row.unionByName(repeated).unionByName(no_null)


# ---- layer reports ---------------------------------------------------------------------------------------------------

def layer_counts(df: DataFrame, raw: str, status: str, codes: Column | str, taxonomy: DataFrame, code: str) -> DataFrame:
    """Rows per status, distinct raw values per status, and members per taxonomy code with zeros kept."""
    s = (df.groupBy(F.col(status).alias("value"), F.col(raw).alias("_raw")).agg(F.count("*").alias("n"))
         .groupBy("value").agg(F.sum("n").alias("rows"), F.count("_raw").alias("raws")))
    out = s.select(F.lit("status").alias("kind"), "value", "rows").unionByName(
        s.select(F.lit("raw_values").alias("kind"), "value", F.col("raws").alias("rows")))
    hits = df.select(F.explode(codes).alias(code)).groupBy(code).agg(F.count("*").alias("rows"))
    members = taxonomy.select(code).join(hits, code, "left")
    return out.unionByName(members.select(F.lit("membership").alias("kind"), F.col(code).cast("string").alias("value"),
                                          F.coalesce("rows", F.lit(0)).alias("rows")))


def audit_layer(records: DataFrame, layer: DataFrame, members: DataFrame, taxonomy: DataFrame, key: Sequence[str],
                raw: str, version: str, code: str, order: str, rank: str, parent_of: str | None = None,
                broad_members: DataFrame | None = None) -> DataFrame:
    """One row of failure counts for a stored layer.

    ``records`` has key + raw text, ``layer`` key + raw_value + mapping_status + version, ``members`` key + code +
    order. Members are judged per record by combined aggregates, never by a window over a record. With ``parent_of``
    (the taxonomy's parent column) and ``broad_members`` (key + parent code), every member needs its parent among the
    record's broad members.
    """
    key = list(key)
    ranked = members.join(taxonomy.select(code, F.col(rank).cast("int").alias("_rank")), code, "left")
    # counted and written once for both judgements, and these again, so that no task holds all of the steps at once
    ranked = settle(ranked.groupBy(*key, order, "_rank").agg(F.count("*").alias("_copies")), "members")
    child = settle(ranked.groupBy(*key).agg(
                 F.sum("_copies").alias("n"), F.min(order).alias("lo"), F.max(order).alias("hi"),
                 F.count_distinct(order).alias("orders"), F.sum(F.when(F.col("_rank").isNull(), F.col("_copies")).otherwise(0)).alias("unknown"))
             .join(misordered(ranked, key, order, "_rank"), key, "left"), "judged")
    parents = layer.groupBy(*key).agg(
        F.count("*").alias("copies"), F.min("raw_value").alias("raw_value"),
        F.min("mapping_status").alias("mapping_status"), F.min("contract_version").alias("contract_version"))
    r = records.select(*key, F.col(raw).alias("_raw"), F.lit(True).alias("_rec"))
    j = r.join(parents, key, "full_outer").join(child, key, "full_outer")
    n = F.coalesce(F.col("n"), F.lit(0))
    both = F.col("_rec").isNotNull() & F.col("copies").isNotNull()
    mapped_row = F.col("mapping_status").isin("single", "multi")
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    audit = j.agg(
        count(F.col("copies").isNull() & F.col("_rec").isNotNull()).alias("records_without_layer"),
        count(F.col("_rec").isNull()).alias("layer_without_record"),
        count(F.col("copies") > 1).alias("repeated_layer_rows"),
        count(both & ~F.col("_raw").eqNullSafe(F.col("raw_value"))).alias("raw_mismatches"),
        count(F.col("copies").isNotNull() & ~F.col("contract_version").eqNullSafe(version)).alias("other_versions"),
        count((F.col("mapping_status") == "single") & (n != 1)).alias("single_cardinality"),
        count((F.col("mapping_status") == "multi") & (n < 2)).alias("multi_cardinality"),
        count(F.col("copies").isNotNull() & ~mapped_row & (n > 0)).alias("members_on_unmapped"),
        count((n > 0) & ~((F.col("lo") == 1) & (F.col("hi") == n) & (F.col("orders") == n))).alias("order_gaps"),
        count((F.col("unknown") == 0) & F.col("misordered")).alias("order_not_by_rank"),
        F.coalesce(F.sum("unknown"), F.lit(0)).alias("unknown_codes"))
    if parent_of is None or broad_members is None:
        return audit
    parents = members.join(taxonomy.select(code, F.col(parent_of).alias("_parent")), code).where("_parent IS NOT NULL")
    have = broad_members.select(*[F.col(k).alias(f"_b_{k}") for k in key], F.col(broad_members.columns[-1]).alias("_b_code")).distinct()
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_b_{k}") for k in key], F.col("_parent") == F.col("_b_code"))
    lost = parents.join(have, on, "left_anti").agg(F.count("*").alias("members_without_parent"))
    return beside(audit, lost)


def gate_profile(counts: DataFrame, profile: str, status: str = "value", rows: str = "rows") -> DataFrame:
    """Production refuses unmapped rows; candidate keeps and counts them. One row."""
    unmapped = F.coalesce(F.sum(F.when(F.col(status) == "unmapped", F.col(rows))), F.lit(0))
    return counts.where("kind = 'status'").agg(F.coalesce(F.sum(rows), F.lit(0)).alias("rows"), unmapped.alias("unmapped_rows")).select(
        F.lit(profile).alias("profile"), "rows", "unmapped_rows",
        (F.lit(profile != "production") | (F.col("unmapped_rows") == 0)).alias("accepted"))


def crosswalk_drift(df: DataFrame, raw: str, xw: DataFrame, context: Sequence[str] = (),
                    ctx_xw: DataFrame | None = None) -> DataFrame:
    """Raw values without mapping (new), mappings without rows (stale), contexts that no row has."""
    seen = df.where(F.col(raw).isNotNull()).groupBy(F.col(raw).alias("raw_value")).agg(F.count("*").alias("rows"))
    listed = xw.select("raw_value").distinct()
    new = seen.join(listed, "raw_value", "left_anti").select(F.lit("new").alias("kind"), F.col("raw_value").alias("value"), "rows")
    stale = listed.join(seen, "raw_value", "left_anti").select(
        F.lit("stale").alias("kind"), F.col("raw_value").alias("value"), F.lit(0).cast("bigint").alias("rows"))
    out = new.unionByName(stale)
    if ctx_xw is not None:
        filled = lambda d: d.select(*[P.text(k).alias(k) for k in context]).distinct()
        lost = filled(ctx_xw).join(filled(df), list(context), "left_anti")
        out = out.unionByName(lost.select(F.lit("unknown_context").alias("kind"), F.concat_ws(" | ", *context).alias("value"),
                                          F.lit(0).cast("bigint").alias("rows")))
    return out


def coverage_summary(df: DataFrame) -> DataFrame:
    """One row over the result of ``classify_context``: how far raw text and contexts carry."""
    listed = ~F.col("broad_mapping_status").isin("not_applicable") & ~F.col("context_note").eqNullSafe(NOTE_NO_RAW)
    nb, ns = F.size("broad_memberships"), F.size("subcategory_memberships")
    applicable = F.col("broad_mapping_status") != "not_applicable"
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(listed & ~F.col("context_mapping_consulted")).alias("raw_only"),
        F.count_if(F.col("context_mapping_consulted")).alias("context_consulted"),
        F.count_if(F.col("context_effective")).alias("context_effective"),
        F.count_if(nb > 0).alias("broad_coverage"), F.count_if(ns > 0).alias("subcategory_coverage"),
        F.count_if(applicable & (nb == 0)).alias("broad_review_required"),
        F.count_if(applicable & (ns == 0)).alias("subcategory_review_required"),
        F.count_if(applicable & ~listed).alias("unmapped"))


def safe_view(layer: DataFrame, kind: str) -> DataFrame:
    """Rows of a layer that a filter may rely on: 'rule', 'threshold' or 'label'."""
    keep = {
        "rule": (F.col("parse_status") == "parsed_safe") & (F.col("search_disposition") == "safe_numeric"),
        "threshold": F.col("overall_gpa_status").isin(list(SAFE_FLOORS)) & F.col("overall_gpa_min_tenths").isNotNull()
        if kind == "threshold" else None,
        "label": (F.col("parse_status") == "exact_crosswalk") & (F.col("search_disposition") == "safe_exact"),
    }[kind]
    return layer.where(keep)


def project_compat(members: DataFrame, compat: DataFrame, key: Sequence[str], code: str) -> DataFrame:
    """Codes of the newer taxonomy back to the older one, only where the way back is unique; else review.

    ``compat`` has from_group_code, to_group_code.
    """
    back = compat.groupBy(F.col("to_group_code").alias(code)).agg(
        F.count_distinct("from_group_code").alias("n"), F.min("from_group_code").alias("old_code"))
    j = join_small_or_keyed(members, back, [code], list(key))
    unique = F.coalesce(F.col("n") == 1, F.lit(False))
    per = j.groupBy(*key).agg(F.count_if(~unique).alias("_open"),
                              F.sort_array(F.collect_set(F.when(unique, F.col("old_code")))).alias("codes"))
    clean = (F.col("_open") == 0) & (F.size("codes") > 0)
    return per.select(*key, F.when(~clean, "review_required").when(F.size("codes") == 1, "single").otherwise("multi")
                      .alias("mapping_status"), F.when(clean, F.col("codes")).otherwise(F.array().cast("array<string>")).alias("codes"))


def excluded_rows(df: DataFrame, layers: Sequence[tuple[str, Column, Column]], id_: str, n: int = 5) -> DataFrame:
    """Per layer (label, filter, kept-out condition): hits of the filter, rows kept out, first ``n`` ids kept out."""
    tagged = df.select(F.col(id_).alias("_id"), F.explode(F.array(*[
        F.struct(F.lit(label).alias("label"), F.coalesce(hit, F.lit(False)).alias("hit"),
                 F.coalesce(out, F.lit(False)).alias("out")) for label, hit, out in layers])).alias("x")).select("_id", "x.*")
    sums = tagged.groupBy("label").agg(F.count("*").alias("total"), F.count_if("hit").alias("matched"),
                                       F.count_if("out").alias("excluded"))
    w = Window.partitionBy("label").orderBy("_id")
    ids = (tagged.where("out").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
           .groupBy("label").agg(F.sort_array(F.collect_list("_id")).alias("first_ids")))
    return sums.join(ids, "label", "left")


def order_mismatches(children: DataFrame, taxonomy: DataFrame, key: Sequence[str], code: str, order: str, rank: str) -> DataFrame:
    """Members whose stored order is not their row number by taxonomy rank within the record.

    A record has at most one member per taxonomy code, so its window holds no more rows than the taxonomy.
    """
    w = Window.partitionBy(*key).orderBy("_rank", code)
    ranked = children.join(taxonomy.select(code, F.col(rank).alias("_rank")), code)
    return (ranked.withColumn("expected_order", F.row_number().over(w).cast("bigint"))
            .where(F.col("expected_order") != F.col(order)).select(*key, code, order, "expected_order"))


def contiguity(children: DataFrame, key: Sequence[str], order_col: str) -> DataFrame:
    """Records whose orders are not exactly 1..n."""
    return (children.groupBy(*key).agg(F.count("*").alias("n"), F.min(order_col).cast("bigint").alias("lo"),
                                       F.max(order_col).cast("bigint").alias("hi"),
                                       F.count_distinct(order_col).alias("distinct_orders"))
            .where("not (lo = 1 and hi = n and distinct_orders = n)"))

