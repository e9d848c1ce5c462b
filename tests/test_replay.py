"""The corrections log in log order, on small logs that name every case."""

from catalogue.operators import corrections as C
from catalogue.sources import readers as R

LOG = "seq long, correction_id string, status string, obsolete_record_ids array<string>, replacement_units array<map<string,string>>"


def unit(id_, **cells):
    return {"record_id": id_, **cells}


def log(spark, *entries):
    rows = [(k, e[0], e[3] if len(e) > 3 else "applied", list(e[1]), [u if isinstance(u, dict) else unit(u) for u in e[2]]) for k, e in enumerate(entries)]
    return spark.createDataFrame(rows, LOG)


def records(spark, *ids):
    return spark.createDataFrame([(i, "old") for i in ids], "record_id string, name string")


def after(spark, base, entries):
    return sorted((r["record_id"], r["name"]) for r in C.apply_corrections(base, log(spark, *entries)).collect())


def test_a_unit_that_a_later_entry_retires_is_gone(spark):
    base = records(spark, "A", "Z")
    assert after(spark, base, [("1", ["A"], ["B"]), ("2", ["B"], ["C"])]) == [("C", None), ("Z", "old")]


def test_a_second_run_changes_nothing(spark):
    entries = [("1", ["A"], [unit("B", name="b")]), ("2", ["B"], [unit("C", name="c"), "D"]), ("3", [], [unit("A", name="back")])]
    once = C.apply_corrections(records(spark, "A", "Z"), log(spark, *entries))
    want = [("A", "back"), ("C", "c"), ("D", None), ("Z", "old")]
    assert sorted(map(tuple, once.collect())) == want == after(spark, once, entries)


def test_entries_that_wait_and_entries_written_twice(spark):
    entries = [("1", ["A"], [unit("B", name="first")]), ("2", ["B"], ["C"], "waiting"), ("3", ["Z"], []), ("1", ["A"], [unit("B", name="second")], "applied_partial_pending_detail")]
    assert after(spark, records(spark, "A", "Z"), entries) == [("B", "second")]
    # the repeated entry keeps its place: what came after the first copy still comes after it
    assert after(spark, records(spark, "A"), [("1", ["A"], ["B"]), ("2", ["B"], []), ("1", ["A"], ["B"])]) == []


def test_one_entry_may_replace_an_id_by_itself(spark):
    assert after(spark, records(spark, "A"), [("1", ["A"], [unit("A", name="new")])]) == [("A", "new")]


def test_lineage_follows_chains_of_any_length(spark):
    n = 37
    entries = [(str(k), [f"R{k}"], [f"R{k + 1}"]) for k in range(n)] + [("split", ["X"], ["Y", "R0"]), ("end", ["Y"], [])]
    got = {(r["record_id"], r["retired_at"]): (r["current_id"], r["links"]) for r in C.lineage(log(spark, *entries)).collect()}
    assert all(got[f"R{k}", k] == (f"R{n}", n - k) for k in range(n))
    # R0 came back after its chain began, so X stands as R0; Y came to nothing
    assert got["X", n] == ("R0", 1) and got["Y", n + 1] == (None, 0)


def test_log_issues(spark):
    entries = [("1", ["A"], ["B"]), ("2", ["A"], []), ("3", [], ["B"]), ("4", ["N"], [])]
    got = {tuple(r) for r in C.log_issues(records(spark, "A"), log(spark, *entries)).collect()}
    assert got == {("2", "A", "retired_but_absent"), ("3", "B", "added_over_living"), ("4", "N", "retired_but_absent")}


def test_the_order_of_a_log_file_is_kept(spark, tmp_path):
    lines = [f'{{"correction_id": "{k}", "status": "applied", "obsolete_record_ids": ["R{k}"], "replacement_units": [{{"record_id": "R{k + 1}"}}]}}' for k in range(400)]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = R.read_corrections(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 4
        assert [r["record_id"] for r in C.apply_corrections(records(spark, "R0"), read).collect()] == ["R400"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
