"""Jobs over whole bundles and snapshots: shuffles, cost by what has changed, planted differences."""

import re

from pyspark.sql import functions as F

from catalogue import contract as K
from catalogue.operators import acceptance as AC
from catalogue.operators import bundle
from catalogue.operators import diff as D
from catalogue.operators import equivalence as E
from catalogue.operators import classify as C
from catalogue.operators import rules as V
from catalogue.operators import search as S
from catalogue.operators.search import SearchRequest

from test_stored import plan


def shuffles(df):
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange", tree))


def source(spark, contract, rows):
    cols = K.source_columns(contract)
    data = [("kokkoritsu", k + 2, *[r.get(c, "") for c in cols]) for k, r in enumerate(rows)]
    return spark.createDataFrame(data, "source_dataset string, _row_number long, " + ", ".join(f"{c} string" for c in cols))


def test_set_rules_share_two_aggregates(spark):
    master = source(spark, K.MASTER, [{"record_id": f"R{k % 40}", "university": "u", "research_requirement_required": "Yes"} for k in range(60)])
    research = source(spark, K.RESEARCH, [{"admission_id": "R1", "university": "u" if k % 2 else "v"} for k in range(90)] + [{"admission_id": "none"}])
    coverage = source(spark, K.COVERAGE, [{"institution_type": "国立", "university": "u", "master_rows": "1"}] * 2)
    together = bundle.set_issues(master, coverage, research, hot_rows=10)
    # each rule for itself: keys twice, counts, orphans, copies, flags, exact rows
    fk = [("source_dataset", "source_dataset"), ("admission_id", "record_id")]
    filled = master.where("record_id <> ''")
    alone = [V.duplicate_key_issues(master, ["record_id"], "_row_number"), V.count_mismatch_issues(coverage, master, ["source_dataset", "institution_type", "university"], "master_rows"),
             V.orphan_issues(research, filled, fk), V.denormalized_issues(research, filled, fk, order="_row_number"),
             V.child_flag_issues(V.first_parent(filled, ["source_dataset", "record_id"], ["research_requirement_required", "_row_number"], "_row_number"), research, fk),
             V.duplicate_row_issues(research, K.source_columns(K.RESEARCH), "_row_number")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert shuffles(together) < shuffles(V.union(alone))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    names = ("code", "dataset", "table", "record_id", "field", "row_number")
    some = lambda df: sorted(repr(tuple(r[n] for n in names)) for r in df.where("code <> 'COVERAGE_KEY_DUPLICATE'").collect())
    assert some(together) == some(V.union(alone))


def snapshots(spark, n=200):
    old = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 5).cast("string").alias("status"), F.lit(1).alias("dropped"), F.lit("t").alias("text"))
    new = spark.range(3, n + 2).select(F.col("id").alias("k"), F.when(F.col("id") % 50 == 7, "9").otherwise((F.col("id") % 5).cast("string")).alias("status"), F.lit("t").alias("text"))
    return old, new


def test_acceptance_looks_at_changed_rows_alone(spark, tmp_path):
    old, new = snapshots(spark)
    same = new.withColumn("dropped", F.lit(1)).select(old.columns)
    made = AC.Plan(suite=[("nine", SearchRequest(equals={"status": ("9",)}, exact_fields=("status",)))], transitions={"to nine": F.col("in_old") & (F.col("new_status") == "9")},
                   old_suite=spark.createDataFrame([("nine", 0)], "label string, rows long"), dataset=F.lit("x"),
                   rules=[V.Rule("INVALID_ENUM_VALUE", F.col("status") == "9", "outside", "status")])
    t = AC.accept(old, same, ["k"], str(tmp_path / "a"), made)
    assert {r["state"]: r["rows"] for r in t["states"].collect()} == {"removed": 3, "added": 2, "changed": 4, "unchanged": 193}
    assert t["changes"].count() == 9 and {(r["k"], r["new_value"]) for r in t["cells"].collect()} == {(k, "9") for k in (7, 57, 107, 157)}
    assert t["transitions"].first()["rows"] == 4 and tuple(t["drift"].first()) == ("nine", 0, 4, 4, 0)
    assert [tuple(r) for r in t["findings"].collect()] == [("error", "INVALID_ENUM_VALUE", 0, 4, 4)] and t["gate"].first()["status"] == AC.HOLD_VALIDATION
    for part in (AC.cells(t["changes"], ["k"]), AC.transition_counts(t["changes"], made.transitions), AC.finding_delta(t["changes"], ["k"], made)):
        read = set(re.findall(r"file:(\S+?)[\],]", plan(part)))
        assert read and all(x.endswith("/a/changes") for x in read)
    assert AC.accept(old, new, ["k"], str(tmp_path / "b"), AC.Plan(transitions=made.transitions))["gate"].first()["status"] == AC.HOLD_SCHEMA
    assert AC.accept(old, old, ["k"], str(tmp_path / "c"), made)["gate"].first()["status"] == AC.READY


def test_a_dropped_column_is_a_change(spark):
    old, new = snapshots(spark, 20)
    states = {r["k"]: r["state"] for r in D.diff_keys(old, new, ["k"]).collect()}
    assert states[5] == "changed" and {r["field"] for r in D.diff_cells(old, new, ["k"]).where("k = 5").collect()} == {"dropped"}
    twice = old.unionAll(old.where("k = 4"))
    assert {r["k"]: r["state"] for r in D.diff_keys(old, twice, ["k"]).collect()}[4] == "changed"
    assert D.diff_keys(twice, twice, ["k"]).where("state <> 'unchanged'").count() == 0


def test_one_lost_member_is_found_in_its_queries(spark):
    members = ["a", "b", "c"]
    records = spark.createDataFrame([(f"r{k}", members[:k % 4], "u", "parsed_safe") for k in range(40)], "record_id string, academic_field_groups array<string>, university string, gpa_parse_status string")
    none = F.array().cast("array<string>")
    records = records.withColumns({c: none for c in ("prefecture_memberships", "broad_codes", "subcategory_codes")})
    suite = [(f"any {x}", SearchRequest(groups=(x,))) for x in members] + [("all", SearchRequest())] * 1
    table = records.select("record_id", F.explode("academic_field_groups").alias("code"))
    nothing = table.where("false")
    whole = {"groups": table, "places": nothing, "broad": nothing, "sub": nothing}
    lost = {**whole, "groups": table.where("NOT (record_id = 'r7' AND code = 'c')")}
    assert all(r["same_keys"] and r["same_summary"] for r in E.suite_equivalence(records, whole, ["record_id"], suite).collect())
    assert {r["label"] for r in E.suite_equivalence(records, lost, ["record_id"], suite).where("NOT same_keys").collect()} == {"any c"}
    assert [tuple(r) for r in E.suite_differences(records, lost, ["record_id"], suite).collect()] == [("any c", "r7", "array")]
    assert E.suite_differences(records, whole, ["record_id"], suite).count() == 0
    # more queries than one bit set holds
    many = [(f"q{k}", SearchRequest(groups=(members[k % 3],))) for k in range(130)]
    assert E.suite_equivalence(records, lost, ["record_id"], many).where("NOT same_keys").count() == sum(k % 3 == 2 for k in range(130))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_saved_suite_has_no_row_per_query_and_group(spark):
    df = spark.createDataFrame([("u1", "a", "parsed_safe"), ("u1", "b", "other"), (None, "a", "conditional_review"), ("u2", None, "other")],
                               "university string, source_dataset string, gpa_parse_status string")
    fields = ("source_dataset", "university")
    suite = [("a", SearchRequest(equals={"source_dataset": ("a",)}, exact_fields=fields)), ("all", SearchRequest()), ("none", SearchRequest(equals={"university": ("x",)}, exact_fields=fields))]
    got = S.run_suite(df, suite)
    assert not re.search(r"keys=\[label#\d+[^\]]*_g#", plan_of(got))
    rows = sorted([tuple(r) for r in got.collect()], key=str)
    assert [r for r in rows if r[0] == "all"] == sorted([("all", "a", 2, None, 1, 1), ("all", "b", 1, None, 0, 1), ("all", None, 1, None, 0, 1), ("all", None, 4, None, 1, 2)], key=str)
    assert [r for r in rows if r[0] == "a" and r[2]] == sorted([("a", "a", 2, None, 1, 1), ("a", None, 2, None, 1, 1)], key=str)
    assert len(rows) == 12 and all(r[2] == 0 and r[5] == 0 for r in rows if r[0] == "none")


def test_both_forms_are_made_once(spark):
    """What is counted and listed of a suite reads one written table; no row per query and group exists."""
    records = spark.createDataFrame([(f"r{k}", f"u{k % 2}", "other", ["a"] if k % 2 else ["b"]) for k in range(6)],
                                    "record_id string, university string, gpa_parse_status string, academic_field_groups array<string>")
    empty = records.where("false").select("record_id", F.lit("x").alias("code"))
    children = {"groups": records.where("record_id <> 'r3'").select("record_id", F.explode("academic_field_groups").alias("code")), "places": empty, "broad": empty, "sub": empty}
    suite = [("any a", SearchRequest(groups=("a",))), ("all", SearchRequest())]
    got = E.suite_equivalence(records, children, ["record_id"], suite)
    assert not re.search(r"keys=\[label#\d+, valued#\d+, (g|university)#", plan_of(got))
    assert sorted(tuple(r)[:5] + (r["group_count"],) for r in got.collect()) == [("all", 6, 6, True, True, 2), ("any a", 3, 2, False, False, 1)]
    apart = E.suite_differences(records, children, ["record_id"], suite)
    assert "Join" not in plan_of(apart) and all("/forms/" in f for f in apart.inputFiles())
    assert [tuple(r) for r in apart.collect()] == [("any a", "r3", "array")]


def test_children_of_a_sidecar_are_written_before_the_join(spark):
    parent = spark.createDataFrame([(1, "u", "x"), (2, "u", "y")], "id int, name string, st string")
    coverage = spark.createDataFrame([("u", 2)], "name string, declared int")
    child = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (3, "x")], "pid int, st string")
    out = D.sidecar_report(parent, coverage, child, ["name"], "declared", [("pid", "id")], ["st"])
    assert any("/children/" in f for f in out.inputFiles())
    assert out.first().asDict() == {"missing_coverage": 0, "stale_coverage": 0, "stale_nonzero": 0, "count_mismatches": 0, "child_rows": 4, "duplicate_children": 1, "orphans": 1,
                                    "denormalized_mismatches": 1, "coherent": False}


def test_members_of_an_audit_are_judged_before_the_join(spark):
    records = spark.createDataFrame([(1, "a"), (2, "b")], "id int, raw string")
    layer = spark.createDataFrame([(1, "a", "multi", "1"), (2, "b", "single", "1")], "id int, raw_value string, mapping_status string, contract_version string")
    members = spark.createDataFrame([(1, "y", 1), (1, "x", 2), (1, "x", 2), (2, "z", 1)], "id int, code string, pos int")
    tax = spark.createDataFrame([("x", 1), ("y", 2)], "code string, rank int")
    out = C.audit_layer(records, layer, members, tax, ["id"], "raw", "1", "code", "pos", "rank")
    assert any("/judged/" in f for f in out.inputFiles())
    got = out.first()
    assert (got["order_gaps"], got["order_not_by_rank"], got["unknown_codes"], got["multi_cardinality"], got["single_cardinality"]) == (1, 1, 1, 0, 0)


def test_large_lookups_are_joined_before_small_ones(spark, monkeypatch):
    """The rows that a keyed join shuffles have no columns of the lookups that are broadcast."""
    seen = []
    real = C.join_keyed
    monkeypatch.setattr(C, "are_small", lambda frames: [True, False])
    monkeypatch.setattr(C, "join_keyed", lambda rows, *a: (seen.append(rows.columns), real(rows, *a))[1])
    df = spark.createDataFrame([("r1", "a", "b"), ("r2", None, "c")], "record_id string, p string, q string")
    fact = lambda k, v: spark.createDataFrame([(k, v)], f"{v}_k string, {v}_v string")
    layer = lambda col, facts, n: C.Layer(facts, ((F.col(col), f"{n}_k"),), facts, {f"{n}_out": F.col(f"{n}_v")})
    out = C.apply_layers(df, [layer("p", fact("a", "small"), "small"), layer("q", fact("b", "large"), "large")])
    assert seen == [["record_id", "p", "q", "_key0"]]
    assert sorted(tuple(r) for r in out.fillna("-").collect()) == [("r1", "a", "b", "small", "large"), ("r2", "-", "c", "-", "-")]
