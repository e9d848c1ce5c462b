"""The whole validator on a small bundle: a clean one, and one defect after another."""

import pytest
from pyspark.sql import functions as F

from catalogue import contract as K
from catalogue.operators import bundle
from catalogue.operators import rules as V
from catalogue.operators import unify as U
from catalogue.sources import readers as R
from catalogue.sources import sinks as S

FILLED = {
    "record_id": "A-1", "admission_year": "2027", "information_year": "2027", "institution_type": "国立", "university": "U", "faculty_school": "F",
    "department": "D", "selection_name": "S", "stem_flag": "True", "fallback_previous_year": "No", **{f: "No" for f in K.SPECIAL_FLAGS},
    "research_requirement_required": "Yes", "exclusive_enrollment_status": "不明", "verified_on": "2026-09-01", "source_url": "https://u.example/",
    "research_activity_level": "relevant", "detail_completeness": "detailed",
}
COVERAGE = {"institution_type": "国立", "university": "U", "master_rows": "1", "checked_on": "2026-09-01", "official_source_url": "https://u.example/"}
RESEARCH = {"admission_id": "A-1", "university": "U", "faculty_school": "F", "department": "D", "selection_name": "S", "source_url": "https://u.example/", "verified_on": "2026-09-01"}


def table(spark, contract, rows, dataset="kokkoritsu"):
    cols = K.source_columns(contract)
    data = [(dataset, i + 2, *[r.get(c, "") for c in cols]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "source_dataset string, _row_number bigint, " + ", ".join(f"{c} string" for c in cols))


def issues(spark, master=(FILLED,), coverage=(COVERAGE,), research=(RESEARCH,)):
    return bundle.validate_bundle(table(spark, K.MASTER, master), table(spark, K.COVERAGE, coverage), table(spark, K.RESEARCH, research))


def test_clean_bundle(spark):
    found = issues(spark)
    assert found.collect() == []
    assert V.issue_status(found).first()["status"] == "passed"


DEFECTS = [
    ({"record_id": ""}, {"MASTER_PK_BLANK", "RESEARCH_ORPHAN_FK"}),
    ({"admission_year": " 2027"}, {"INVALID_INTEGER_VALUE", "WHITESPACE_PADDING"}),
    ({"admission_year": "2026"}, {"INVALID_INTEGER_VALUE"}),
    ({"institution_type": "私立"}, {"SOURCE_INSTITUTION_TYPE_MISMATCH", "COVERAGE_MASTER_ROWS_MISMATCH"}),
    ({"returnee_flag": ""}, {"REQUIRED_VALUE_MISSING"}),
    ({"stem_flag": "yes"}, {"INVALID_BOOLEAN_VALUE"}),
    ({"selection_essay": "条件付き"}, {"INVALID_TRISTATE_VALUE"}),
    ({"common_test_required": "条件付き", "selection_common_test": "No"}, {"COMMON_TEST_FIELDS_DIFFER"}),
    ({"exclusive_enrollment_status": "専願"}, {"PROVENANCE_URL_MISSING"}),
    ({"exclusive_enrollment_status": ""}, {"INVALID_ENUM_VALUE", "PROVENANCE_URL_MISSING"}),
    ({"fallback_previous_year": "Yes"}, {"PROVENANCE_URL_MISSING"}),
    ({"application_end": "11月"}, {"DATE_RAW_UNPARSED"}),
    ({"application_end": "2026-11-01 必着"}, {"DATE_RAW_PARTIAL"}),
    ({"notes": "x　"}, {"WHITESPACE_PADDING"}),
    ({"detail_completeness": "complete"}, {"DETAIL_COMPLETENESS_UNMAPPED"}),
    ({"research_requirement_required": "No"}, {"RESEARCH_NOT_REQUIRED_WITH_CHILD"}),
    ({"department": "E"}, {"RESEARCH_DENORMALIZED_FIELD_MISMATCH"})]


def test_one_defect_each(spark):
    """One bundle with a clean record per case and one change in it; findings are told apart by the row."""
    own = lambda base, i: {**base, "university": f"U{i}", **({"record_id": f"A-{i}"} if "record_id" in base else {}), **({"admission_id": f"A-{i}"} if "admission_id" in base else {})}
    n = range(len(DEFECTS))
    found = issues(spark, [{**own(FILLED, i), **DEFECTS[i][0]} for i in n], [own(COVERAGE, i) for i in n], [own(RESEARCH, i) for i in n]).collect()
    got = {i: {f["code"] for f in found if f["row_number"] == i + 2} for i in n}
    assert got == {i: codes for i, (_, codes) in enumerate(DEFECTS)}
    assert all(f["severity"] == K.severity(f["code"]) for f in found)


def test_sets(spark):
    found = issues(spark, master=[FILLED, {**FILLED, "department": "E"}, {**FILLED, "record_id": "A-2"}], coverage=[COVERAGE, COVERAGE], research=[RESEARCH, RESEARCH, {**RESEARCH, "admission_id": "A-9"}])
    got = sorted((i["code"], i["row_number"], (i["details"] or {}).get("first_row_number")) for i in found.collect())
    assert got == [("COVERAGE_KEY_DUPLICATE", 3, "2"), ("COVERAGE_MASTER_ROWS_MISMATCH", 2, None), ("COVERAGE_MASTER_ROWS_MISMATCH", 3, None),
                   ("MASTER_PK_DUPLICATE", 3, "2"), ("RESEARCH_EXACT_DUPLICATE", 3, "2"), ("RESEARCH_ORPHAN_FK", 4, None), ("RESEARCH_REQUIRED_WITHOUT_CHILD", 4, None)]
    assert V.issue_status(found).first()["status"] == "failed"


def test_coverage_rules(spark):
    out = {**COVERAGE, "master_rows": "0", "undergraduate_scope": "対象外（大学院のみ）", "official_source_url": ""}
    assert {i["code"] for i in issues(spark, master=[], coverage=[out], research=[]).collect()} == {"COVERAGE_ZERO_MASTER_ROWS"}
    bad = {**COVERAGE, "master_rows": "-1", "official_source_url": ""}
    assert {i["code"] for i in issues(spark, master=[], coverage=[bad], research=[]).collect()} == {
        "INVALID_INTEGER_VALUE", "PROVENANCE_URL_MISSING", "COVERAGE_MASTER_ROWS_MISMATCH"}


def test_unregistered_code_is_refused(spark):
    with pytest.raises(KeyError):
        V.apply_rules(spark.range(1), [V.Rule("NO_SUCH_CODE", F.lit(True), "x")], "t", F.lit("d"), "id", "id")


def test_adapt_is_strict(spark):
    good = U.adapt(table(spark, K.MASTER, [FILLED]), K.MASTER, "kokkoritsu", "5.83")
    row = good.first()
    assert good.columns == list(K.MASTER_COLUMNS)
    assert (row["stem_flag"], row["detail_completeness_status"], row["detail_completeness_raw"], row["gpa_requirement"]) == (True, "complete", "detailed", None)
    assert U.check_constraints(good, [*U.constraints(K.MASTER), *U.cross_checks()], "record_id").count() == 0
    with pytest.raises(Exception, match="cannot adapt stem_flag"):
        U.adapt(table(spark, K.MASTER, [{**FILLED, "stem_flag": "maybe"}]), K.MASTER, "kokkoritsu", "5.83").collect()
    with pytest.raises(ValueError, match="missing"):
        U.adapt(table(spark, K.MASTER, [FILLED]).drop("notes"), K.MASTER, "kokkoritsu", "5.83")


def test_csv_round_trip(spark, tmp_path):
    rows = [{**FILLED, "notes": 'a "quoted", cell'}, {**FILLED, "record_id": "A-2", "notes": "two\nlines"}, {**FILLED, "record_id": "A-3", "notes": " padded "}]
    src = K.source_contract(K.MASTER)
    S.write_canonical(table(spark, K.MASTER, rows).coalesce(1), str(tmp_path / "m"), src, ["record_id"])
    back = R.read_contract_csv(spark, str(tmp_path / "m"), src)
    assert [(r["_row_number"], r["record_id"], r["notes"]) for r in back.orderBy("_row_number").collect()] == [
        (2, "A-1", 'a "quoted", cell'), (3, "A-2", "two\nlines"), (4, "A-3", " padded ")]
    assert R.csv_width_issues(back, src).count() == 0
    assert R.header_issues(spark, str(tmp_path / "m"), src).count() == 0


def test_csv_defects_and_profile(spark, tmp_path):
    contract = K.TableContract("t", ("id", "name", "note"))
    (tmp_path / "f.csv").write_bytes("﻿id,name,note\r\n1,a,x\r\n2,b\r\n2,\"b, c\",y,extra\r\n1,a,x".encode("utf-8"))
    path = str(tmp_path / "f.csv")
    df = R.read_contract_csv(spark, path, contract)
    assert sorted((r["row_number"], r["actual_count"]) for r in R.csv_width_issues(df, contract).collect()) == [(3, 2), (4, 4)]
    p = R.profile_csv(spark, path, contract, ["id"]).first()
    assert (p["rows"], p["duplicate_keys"], p["exact_duplicate_rows"], p["row_width_mismatches"]) == (4, 2, 1, 2)
    assert (p["bom"], p["crlf"], p["lf"], p["cr"]) == (True, 4, 0, 0)
    (tmp_path / "g.csv").write_bytes(b"id,note,name\n1,a,x\n")
    assert {r["code"] for r in R.header_issues(spark, str(tmp_path / "g.csv"), contract).collect()} == {"SOURCE_COLUMN_ORDER_MISMATCH"}
    with pytest.raises(Exception):
        R.read_contract_csv(spark, str(tmp_path / "g.csv"), contract).collect()


def test_dimension_version_gate(spark, tmp_path):
    (tmp_path / "d.csv").write_text("v,code\n0.1,a\n0.2,b\n")
    with pytest.raises(Exception, match="v is not 0.1"):
        R.read_dimension(spark, str(tmp_path / "d.csv"), ("v", "code"), "v", "0.1").collect()


def test_a_bundle_reads_its_tables_once(spark, tmp_path):
    """What is read several times is written first, so the findings no longer go back to the wide tables."""
    frames = []
    for name, contract, rows in (("m", K.MASTER, [FILLED, FILLED]), ("c", K.COVERAGE, [COVERAGE, COVERAGE]), ("r", K.RESEARCH, [RESEARCH, RESEARCH])):
        table(spark, contract, rows).write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    found = bundle.set_issues(*frames)
    assert not [f for f in found.inputFiles() if str(tmp_path) in f]
    assert {r["code"] for r in found.collect()} == {"MASTER_PK_DUPLICATE", "COVERAGE_KEY_DUPLICATE", "COVERAGE_MASTER_ROWS_MISMATCH", "RESEARCH_EXACT_DUPLICATE"}


def test_a_finding_does_not_carry_its_row(spark):
    df = spark.createDataFrame([("d", "r", 1, " x", "y")], "source_dataset string, record_id string, _row_number long, a string, b string")
    found = V.apply_rules(df, V.whitespace_rules(["a", "b"]), "t", "source_dataset", "record_id")
    generated = [line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate" in line]
    assert len(generated) == 1 and ", a#" not in generated[0] and ", b#" not in generated[0]
    assert found.first()["details"] == {"leading": "true", "trailing": "false"} and found.count() == 1


def test_kinds_are_counted_with_one_row_per_record(spark):
    kinds = {("t", "A", "x"): 0, ("t", "A", None): 1, ("u", "A", "x"): 2, **{("u", "B", f"f{n}"): n for n in range(3, 140)}}
    rows = [("d", "r1", 1, "t", "A", "x"), ("d", "r1", 2, "t", "A", "x"), ("d", "r1", 2, "u", "A", "x"), ("d", "r2", 3, "t", "A", "x"), ("e", "r1", 4, "t", "A", "x"), ("d", None, 5, "t", "A", "x"),
            (None, "r1", 6, "t", "A", None), (None, "r1", 7, "t", "A", None), ("d", "", None, "u", "B", "f63"), ("d", "r1", 8, "u", "B", "f64"), ("d", "r1", 9, "u", "B", "f127"), ("d", "r3", 9, "u", "B", "f139")]
    df = spark.createDataFrame([(*r, kinds[r[3:]]) for r in rows], "dataset string, record_id string, row_number long, table string, code string, field string, kind int")
    wanted = df.groupBy("table", "code", "dataset", "field").agg(F.count("*").alias("n"), F.count_distinct("record_id").alias("ids"), F.sum("row_number").alias("row_numbers"))
    got = V.count_kinds(df, kinds)
    assert got.columns == wanted.columns and sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect()))
    # no row per finding and id is moved: the text of a finding is no key
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_id#" in plan and not [x for x in plan.split("\n") if "Exchange" in x and ("code#" in x or "field#" in x)]


def test_kinds_of_a_bundle(spark):
    """Every finding has the number of its table, code and field, whichever rule it comes from."""
    master = [FILLED, {**FILLED, "notes": " x"}, {**FILLED, "record_id": "A-2", "research_requirement_required": "No", "capacity": "x "}, {**FILLED, "record_id": "A-3", "application_end": "11月"}]
    research = [RESEARCH, RESEARCH, {**RESEARCH, "department": "E"}, {**RESEARCH, "admission_id": "none"}, {**RESEARCH, "admission_id": "A-2", "source_url": ""}, {**RESEARCH, "admission_id": ""}]
    kinds = bundle.kinds()
    found = bundle.validate_bundle(table(spark, K.MASTER, master), table(spark, K.COVERAGE, [COVERAGE, COVERAGE]), table(spark, K.RESEARCH, research), kinds=kinds).persist()
    assert {r["code"] for r in found.collect()} >= {code for _, code, _ in bundle.SET_KINDS} - {"RESEARCH_DENORMALIZED_FIELD_MISMATCH"} and all(
        kinds[r["table"], r["code"], r["field"]] == r["kind"] for r in found.collect())
    wanted = found.groupBy("table", "code", "dataset", "field").agg(F.count("*").alias("n"), F.count_distinct("record_id").alias("ids"), F.sum("row_number").alias("row_numbers"))
    assert sorted(map(repr, V.count_kinds(found, kinds).collect())) == sorted(map(repr, wanted.collect()))
    found.unpersist()


def test_a_master_in_enough_parts_is_not_shuffled(spark):
    """Wide rows are dealt out only where they come in fewer parts than there are cores."""
    cores = spark.sparkContext.defaultParallelism
    rows = table(spark, K.MASTER, [{**FILLED, "record_id": f"A-{k}"} for k in range(4 * cores)])
    moved = lambda parts: "Exchange hashpartitioning(_row_number" in bundle.validate_bundle(
        rows.coalesce(1).repartition(parts), table(spark, K.COVERAGE, [COVERAGE]), table(spark, K.RESEARCH, [RESEARCH]))._jdf.queryExecution().executedPlan().toString()
    assert moved(1) and not moved(cores)


def test_rows_of_no_shared_hash_stay_where_they_are(spark):
    """Copies are found without a shuffle of all rows: only those that share a hash are moved."""
    rows = [{**RESEARCH, "requirement_code": str(k)} for k in range(300)]
    research = bundle.written(table(spark, K.RESEARCH, rows + rows[:2]), K.RESEARCH)
    seen = []
    real = V.repeats
    try:
        V.repeats = lambda df, *a, **k: (seen.append(df.count()), real(df, *a, **k))[1]
        found = V.duplicate_row_issues(research, K.source_columns(K.RESEARCH), "_row_number", written=True).collect()
    finally:
        V.repeats = real
    assert sorted((r["row_number"], r["details"]["first_row_number"]) for r in found) == [(302, "2"), (303, "3")] and 4 <= seen[0] < 60
