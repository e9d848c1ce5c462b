"""Classification: nothing is guessed, context rules, check functions."""

import pytest

from catalogue.operators import classify as C
from catalogue.operators import unify as U

BROAD = [("g1", 1), ("g2", 2), ("g3", 3)]
SUB = [("s1", "g1", 1), ("s2", "g2", 2), ("s3", "g3", 3)]
RAW = [("one", "single", "g1", "s1", "n"), ("two", "multi", "g3", None, "n"), ("two", "multi", "g2", "s2", "n"), ("open", "review_required", None, None, "n")]
CTX = "source_dataset string, university string, faculty_school string, department string, academic_field string, mapping_status string, merge_mode string, group_code string, subcategory_code string, review_note string"


def context(spark, rows, contexts):
    df = spark.createDataFrame([(str(i), "kokkoritsu", u, f, None, a) for i, (u, f, a) in enumerate(rows)],
                               "record_id string, source_dataset string, university string, faculty_school string, department string, academic_field string")
    raw = spark.createDataFrame(RAW, "raw_value string, mapping_status string, group_code string, subcategory_code string, review_note string")
    ctx = spark.createDataFrame([("kokkoritsu", u, f, "", a, st, mode, g, s, "c") for u, f, a, st, mode, g, s in contexts], CTX)
    out = C.classify_context(df, raw, ctx, spark.createDataFrame(BROAD, "group_code string, rank int"),
                             spark.createDataFrame(SUB, "subcategory_code string, parent_group_code string, rank int"))
    return {r["record_id"]: r for r in out.collect()}


def members(row, name):
    return [(m["code"], m["basis"]) for m in row[name]]


def test_context_combinations(spark):
    r = context(spark, [("u", None, None), ("u", None, "nowhere"), ("u", None, "one"), ("add", None, "one"), ("auth", "f", "one"), ("same", None, "one"),
                        ("u", None, "open"), ("add", None, "open"), ("empty", None, "one"), ("auth", None, "one"), ("u", None, "two"), ("ghost", None, "nowhere")],
                [("add", "", "one", "single", "additive", "g2", "s2"), ("auth", "f", "one", "single", "authoritative", "g3", None), ("same", "", "one", "single", "additive", "g1", None),
                 ("add", "", "open", "single", "additive", "g1", "s1"), ("empty", "", "one", "review_required", "authoritative", None, None), ("ghost", "", "nowhere", "single", "additive", "g1", None)])
    state = lambda i: (r[i]["broad_mapping_status"], r[i]["subcategory_mapping_status"], r[i]["context_mapping_consulted"], r[i]["context_mapping_effect"])
    assert state("0") == ("not_applicable", "not_applicable", False, "none")
    assert state("1") == ("unmapped", "unmapped", False, "none")
    assert state("2") == ("single", "single", False, "none") and members(r["2"], "broad_memberships") == [("g1", "raw_exact")]
    assert state("3") == ("multi", "multi", True, "additive") and members(r["3"], "subcategory_memberships") == [("s1", "raw_exact"), ("s2", "context_exact")]
    assert state("4") == ("single", "none", True, "authoritative") and members(r["4"], "broad_memberships") == [("g3", "context_exact")]
    assert state("5") == ("single", "single", True, "additive") and members(r["5"], "broad_memberships") == [("g1", "raw_and_context")]
    assert state("6") == ("review_required", "review_required", False, "none")
    assert state("7") == ("single", "single", True, "additive")
    assert state("8") == ("review_required", "review_required", True, "none") and members(r["8"], "broad_memberships") == []
    assert state("9") == ("single", "single", False, "none")
    assert state("10") == ("multi", "single", False, "none") and [m["order"] for m in r["10"]["broad_memberships"]] == [1, 2]
    assert members(r["10"], "broad_memberships") == [("g2", "raw_exact"), ("g3", "raw_exact")]
    assert state("11") == ("unmapped", "unmapped", False, "none")


def test_exact_match_only(spark):
    xw = spark.createDataFrame([("TOEFL", "required", "")], "raw_value string, requirement_status string, review_note string")
    df = spark.createDataFrame([("1", "TOEFL"), ("2", "TOEFL "), ("3", "toefl"), ("4", "TOEFL等"), ("5", None)], "record_id string, raw string")
    got = {r["record_id"]: (r["requirement_status"], r["search_disposition"]) for r in C.classify(df, "raw", xw).collect()}
    assert got == {"1": ("required", "safe_exact"), "5": ("unknown", "not_searchable"), **{i: ("unmapped", "review_required") for i in "234"}}


@pytest.mark.parametrize("raw,a,i,fallback,want", [
    (None, 2027, 2026, False, ("not_applicable", "not_searchable", "previous_year_reference", None)),
    (None, 2027, 2027, False, ("not_applicable", "not_searchable", "current", None)),
    ("safe", 2027, 2027, False, ("parsed_safe", "safe_numeric", "current", 38)),
    ("safe", 2027, None, False, ("unparsed", "review_required", "current", None)),
    ("safe", 2027, 2026, False, ("historical_reference", "not_searchable", "previous_year_reference", None)),
    ("safe", 2027, 2027, True, ("historical_reference", "not_searchable", "previous_year_reference", None)),
    ("old", 2027, 2027, False, ("historical_reference", "not_searchable", "previous_year_reference", None)),
    ("new", 2027, 2027, False, ("unparsed", "review_required", "current", None)),
    ("new", 2027, 2027, True, ("historical_reference", "not_searchable", "previous_year_reference", None)),
    ("either", 2027, 2027, None, ("conditional_review", "review_required", "current", None)),
    ("none", 2027, None, False, ("not_numeric", "not_searchable", "current", None))])
def test_rule_order(spark, raw, a, i, fallback, want):
    rules = spark.createDataFrame([
        (None, "do_not_numeric", "null", "", "", "", "reviewed"), ("safe", "safe_numeric", "simple_overall_minimum", "numeric", "3.8", "", "reviewed"),
        ("old", "do_not_numeric", "nonbinding_or_historical_numeric", "historical", "", "", "reviewed"), ("either", "conditional_numeric", "or_condition", "or", "", "", "reviewed"),
        ("none", "do_not_numeric", "explicit_no_numeric_threshold", "", "", "", "reviewed")],
        "raw_value string, distinct_tier string, primary_class string, feature_flags string, safe_gpa_min string, safe_gpa_max string, review_status string")
    df = spark.createDataFrame([("r", raw, a, i, fallback)], "record_id string, gpa string, admission_year int, information_year int, fallback_previous_year boolean")
    layer = C.classify_rule(df, "gpa", rules)
    row = layer.first()
    assert (row["parse_status"], row["search_disposition"], row["source_value_status"], row["gpa_min_tenths"]) == want
    broken = U.check_constraints(layer.withColumnRenamed("gpa", "raw_value"), U.threshold_checks(), "record_id")
    assert broken.count() == 0
    assert C.check_rules(rules).count() == 0


def test_crosswalk_and_taxonomy_checks_pass_on_good_input(spark):
    tax = spark.createDataFrame([("a", 1), ("b", 2)], "group_code string, display_order int")
    xw = spark.createDataFrame([("x", "multi", "a", "1", ""), ("x", "multi", "b", "2", ""), ("y", "single", "b", "1", ""), ("z", "review_required", "", "", "why")],
                               "raw_value string, mapping_status string, group_code string, group_order string, review_note string")
    assert C.check_crosswalk(xw, tax).count() == 0
    assert C.check_taxonomy(tax, "group_code", "display_order").count() == 0


def test_conflicting_entries_go_to_review(spark):
    """A value listed twice neither multiplies records nor is settled by one of two readings."""
    df = spark.createDataFrame([("1", "same"), ("2", "differs"), ("3", None), ("4", "new")], "record_id string, raw string")
    label = spark.createDataFrame([("same", "required", "n"), ("same", "required", "n"), ("differs", "required", ""), ("differs", "not_required", "")],
                                  "raw_value string, requirement_status string, review_note string")
    got = {r["record_id"]: (r["requirement_status"], r["search_disposition"]) for r in C.classify(df, "raw", label).collect()}
    assert got == {"1": ("required", "safe_exact"), "2": ("review_required", "review_required"), "3": ("unknown", "not_searchable"), "4": ("unmapped", "review_required")}
    many = spark.createDataFrame([("same", "multi", "a", "1", ""), ("same", "multi", "b", "2", ""), ("differs", "single", "a", "1", ""),
                                  ("differs", "review_required", "b", "2", "x")], "raw_value string, mapping_status string, group_code string, group_order string, review_note string")
    rows = {r["record_id"]: (r["mapping_status"], len(r["memberships"])) for r in C.classify_multi(df, "raw", many).collect()}
    assert rows == {"1": ("multi", 2), "2": ("review_required", 0), "3": ("not_applicable", 0), "4": ("unmapped", 0)}
    floors = spark.createDataFrame([("differs", "required", 30, True, "safe_simple_overall", False), ("differs", "required", 35, True, "safe_simple_overall", False)],
                                   "raw_value string, grade_requirement_status string, overall_gpa_min_tenths int, overall_gpa_min_inclusive boolean, overall_gpa_status string, additional_grade_conditions boolean")
    row = C.classify_threshold(df, "raw", floors).where("record_id = '2'").collect()
    assert [(r["grade_requirement_status"], r["overall_gpa_min_tenths"]) for r in row] == [("review_required", None)]


def test_required_integers_may_not_be_blank(spark):
    """The coverage table needs its row count; a blank one is refused rather than adapted to NULL."""
    cols = [c for c in U.K.source_columns(U.K.COVERAGE)]
    row = {c: "" for c in cols} | {"institution_type": "x", "university": "u", "checked_on": "2026-01-01"}
    for value, fails in (("3", False), ("", True), ("x", True)):
        df = spark.createDataFrame([tuple((row | {"master_rows": value})[c] for c in cols)], ", ".join(f"{c} string" for c in cols))
        adapted = U.adapt(df, U.K.COVERAGE, "shidai", "v1")
        if fails:
            with pytest.raises(Exception, match="cannot adapt master_rows"):
                adapted.collect()
        else:
            assert adapted.first()["master_rows"] == 3
