"""Search semantics: NULL is neither Yes, No nor Unknown; pages; trigram search; plan shapes."""

import random

import pytest
from pyspark.sql import functions as F

from catalogue.operators import diff as D
from catalogue.operators import facets as A
from catalogue.operators import ledger as L
from catalogue.operators import review as R
from catalogue.operators import search as S
from catalogue.operators import views as W
from catalogue.operators.search import SearchRequest
from catalogue.plans import bindings as B


def records(spark):
    return spark.createDataFrame(
        [("1", "Yes", True, "parsed_safe", 38, True), ("2", "No", None, "parsed_safe", 38, False), ("3", "Unknown", False, "conditional_review", None, None), ("4", None, True, "unparsed", None, None)],
        "id string, selection_interview string, stem_flag boolean, gpa_parse_status string, gpa_min_tenths int, gpa_min_inclusive boolean"
    ).withColumn("gpa_max_tenths", F.lit(None).cast("int")).withColumn("gpa_max_inclusive", F.lit(None).cast("boolean")).withColumn("university", F.lit("u"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_null_is_not_a_value(spark):
    df = records(spark)
    assert ids(S.search(df, SearchRequest(equals={"selection_interview": ("No", "Unknown")}))) == ["2", "3"]
    assert ids(S.search(df, SearchRequest(flags={"stem_flag": False}))) == ["3"]


def test_threshold_modes(spark):
    df = records(spark)
    hit = lambda v, m: ids(S.search(df, SearchRequest(value_tenths=v, value_mode=m)))
    assert hit(38, "safe") == ["1"] and hit(39, "safe") == ["1", "2"] and hit(37, "safe") == []
    assert hit(38, "review") == ["1", "3"] and hit(38, "all") == ["1", "2", "3", "4"]
    row = S.summarize(df, SearchRequest(value_tenths=38)).first().asDict()
    assert row == {"total_matched_rows": 4, "safe_match_rows": 1, "safe_no_match_rows": 1, "safe_numeric_rule_rows": 2, "conditional_review_rows": 1, "not_evaluable_rows": 1, "group_count": 1}
    none = S.summarize(df, SearchRequest(equals={"id": ("x",)}, exact_fields=("id",))).first()
    assert (none["total_matched_rows"], none["safe_match_rows"], none["group_count"]) == (0, None, 0)


def test_hostile_values_are_literals(spark):
    df = records(spark)
    assert ids(S.search(df, SearchRequest(equals={"id": ("1' OR '1'='1", "2")}, exact_fields=("id",)))) == ["2"]


@pytest.mark.parametrize("bad", [{"value_mode": "x"}, {"value_tenths": 51}, {"english_status": ("unmapped",)}, {"grade_status": "unmapped"}, {"overall_tenths": 30}])
def test_request_is_checked(bad):
    with pytest.raises(ValueError):
        SearchRequest(**bad)


def test_page_order_and_limits(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), ("あ", 4), ("ア", 5)], "k string, id int")
    got = lambda **k: [r["id"] for r in S.page(df, ["k", "id"], **k).collect()]
    assert got() == [2, 3, 1, 4, 5] and got(limit=0) == [] and got(offset=3) == [4, 5] and got(limit=2, offset=1) == [3, 1]


def test_trigram_search_equals_scan(spark):
    rnd = random.Random(7)
    rows = [(i, "".join(rnd.choice("abあ😀 ") for _ in range(rnd.randrange(0, 60)))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, t string")
    index = S.build_trigrams(df, "id", ["t"])
    for phrase in ("abあ", "あ😀a", "aba b", "ab", "😀😀😀", "zzz"):
        want = sorted(i for i, t in rows if phrase in t)
        assert sorted(r["id"] for r in S.trigram_search(df, index, "id", ["t"], phrase).collect()) == want
        assert sorted(r["id"] for r in S.contains_any(df, ["t"], phrase).collect()) == want


def test_match_values_equals_brute_force(spark):
    rnd = random.Random(3)
    rules = [(rnd.choice([None, *range(0, 51)]), rnd.choice([True, False, None])) for _ in range(400)]
    got = W.match_values(spark.range(51).select(F.col("id").cast("int").alias("v")), spark.createDataFrame(rules, "f int, i boolean"), "v", "f", "i")
    want = {v: sum(f is not None and (v > f or (v == f and bool(i))) for f, i in rules) for v in range(51)}
    assert {r["v"]: r["matching_rules"] for r in got.collect()} == want


def test_group_page_covers_all_groups_once(spark):
    df = spark.createDataFrame([(f"g{i % 7}", i) for i in range(40)], "g string, id int")
    extra = spark.createDataFrame([("g3", 100), ("new", 101)], "g string, id int")
    pages = [A.group_page(df, "g", ["id"], page=p, size=3, extra=extra).collect() for p in (1, 2, 3, 4)]
    assert [sorted({r["g"] for r in p}) for p in pages] == [["g0", "g1", "g2"], ["g3", "g4", "g5"], ["g6", "new"], []]
    assert sum(len(p) for p in pages) == 42 and {r["group_no"] for r in pages[0]} == {1, 2, 3}


def test_suppression_wildcard(spark):
    p = spark.createDataFrame([("1", "u", "s", None), ("2", "u", "s", ""), ("3", "u", "s", "f"), ("4", "u", "s", "g"), ("5", "v", "s", None)], "id string, u string, s string, f string")
    c = spark.createDataFrame([("u", "s", "f"), ("u", "s", None)], "u string, s string, f string")
    assert ids(W.suppress(p, c, ["u", "s"], "f")) == ["4", "5"] and ids(W.suppress(p, c, ["u", "s"], "f", kept=False)) == ["1", "2", "3"]
    assert {r["id"]: r["state"] for r in L.publish(p, c, ["u", "s"], "f").collect()} == {"1": "suppressed", "2": "suppressed", "3": "suppressed", "4": "published", "5": "published"}


def test_last_row_wins_in_keyed_diff(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, None), ("m", 3, "x")], "k string, row int, v string")
    assert sorted((r["k"], r["v"]) for r in D.last_by_key(df, ["k"], "row").collect()) == [("k", None), ("m", "x")]


def test_next_crosswalk_refuses_overlap(spark):
    schema = "contract_version string, raw_value string, requirement_status string, review_note string"
    prev = spark.createDataFrame([("0.1", "a", "required", "")], schema)
    with pytest.raises(Exception, match="already decided: a"):
        R.next_crosswalk(prev, spark.createDataFrame([("", "a", "unknown", "")], schema), "0.2").collect()
    assert R.changed_decisions(prev, R.next_crosswalk(prev, spark.createDataFrame([("", "b", "unknown", "")], schema), "0.2")).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_python_and_no_products(spark, sf):
    import __spark_entry__ as entry
    for name in ("sea12_summary", "cls08_context", "val09_domains", "val05_duplicate_key", "dif02_diff_cells", "joi07_suppress", "joi09_match_values", "agg11_group_page", "doc04_projection_gate"):
        p = plan(entry.queries()[name](spark, sf))
        assert "Python" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_crosswalk_lookups_are_broadcast_and_scan_is_pruned(spark, sf):
    p = plan(S.summarize(B.catalogue(spark, sf), SearchRequest(grade_status="required")))
    assert "BroadcastHashJoin" in p and "o_totalprice" not in p
    q = plan(B.table(spark, sf, "orders").where(F.col("o_orderstatus").isin("F")).select("o_orderkey"))
    assert "PushedFilters: [In(o_orderstatus, [F])" in q or "EqualTo(o_orderstatus,F)" in q


@pytest.mark.parametrize("bad", [
    {"value_mode": "safe"}, {"value_mode": "review"}, {"equals": {"id": ("1",)}}, {"equals": {"university": ("",)}}, {"groups": (" ",)},
    {"mapping_status": ("wrong",)}, {"branches": (("A", ("x",)), ("A", ()))}, {"deadline_from": "tomorrow"}, {"deadline_from": "20260101"},
    {"deadline_from": "2026-02-30"}, {"special_flags": (), "families": ()}, {"places": (None,)},
])
def test_requests_that_cannot_be_meant(bad):
    with pytest.raises(ValueError):
        SearchRequest(**bad)


def test_pages_by_key_are_pages_by_offset(spark):
    rows = [(a, b) for a in (None, "x", "y") for b in range(7)]
    df = spark.createDataFrame(rows, "a string, b int")
    got, last = [], None
    while True:
        page = [tuple(r) for r in S.page_after(df, ["a", "b"], 4, last).collect()]
        if not page:
            break
        got, last = got + page, page[-1]
    assert got == rows
