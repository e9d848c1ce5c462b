"""Stored tables: what a query opens, and that it finds the same as a scan."""

import random

import pytest
from pyspark.sql import functions as F

from catalogue import contract as K
from catalogue.functions import ranks
from catalogue.operators import documents as D
from catalogue.operators import facets as A
from catalogue.operators import ranked, textindex
from catalogue.sources import readers as R


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_numbers_are_dense_in_any_order(spark):
    r = random.Random(1)
    rows = [(r.choice([None, "a", "b", "hot", "hot", "hot"]), r.randint(0, 40), k) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(5)
    got = sorted((x["at"], x["g"], x["v"]) for x in ranks.numbered(df, ["g", "v"], "at").collect())
    want = sorted(((g, v) for g, v, _ in rows), key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert got == [(k, *x) for k, x in enumerate(want)]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(2)
    words = ["alpha", "beta", "Gamma", "delta é", "once", "the"]
    return [(k, " ".join(r.choice(words) for _ in range(r.randint(0, 9))) if k % 11 else None, r.choice(["x", None, "tail"])) for k in range(300)] + [(300, "an unique phrase", "y")]


def test_the_index_finds_what_a_scan_finds(spark, texts, tmp_path):
    df = spark.createDataFrame(texts, "k long, a string, b string")
    index = textindex.build_index(df, "k", ["a", "b"], str(tmp_path / "ix"), 4, 4)
    phrases = ["alpha beta", "é o", "unique", "th", "zzz", "tail", "lph", "a", "not there"]
    want = sorted((p, k) for p in phrases for k, *fields in texts if any(p in f for f in fields if f))
    assert sorted(map(tuple, index.find(phrases).collect())) == want
    few, textindex.FETCH_KEYS = textindex.FETCH_KEYS, 3  # more candidates than are fetched by key
    try:
        assert sorted(map(tuple, index.find(phrases).collect())) == want
    finally:
        textindex.FETCH_KEYS = few
    assert textindex.open_index(spark, str(tmp_path / "ix"), "k", ["a", "b"], 4, 4).find(["unique"]).collect() == [("unique", 300)]


def test_a_query_opens_the_files_of_its_own_trigrams(spark, texts, tmp_path):
    df = spark.createDataFrame(texts, "k long, a string, b string")
    index = textindex.build_index(df, "k", ["a", "b"], str(tmp_path / "ix"), 16, 16)
    assert index.chosen(["an unique"], 1) == [[min(textindex.pieces("an unique"), key=lambda t: (index.trigram_counts([t])[t], t))]]
    looked = plan(index.candidates(["unique"]))
    assert "PartitionFilters: [part" in looked and "PushedFilters: [In(trigram" in looked
    fetched = plan(index.find(["unique"]))
    assert "PartitionFilters: [isnotnull(slot" in fetched or "PartitionFilters: [slot" in fetched or "(slot" in fetched.split("PartitionFilters")[1].split("\n")[0]


def test_a_page_opens_its_own_ranges(spark, tmp_path):
    df = spark.createDataFrame([(f"n{k * 7919 % 997:04}", k) for k in range(997)], "name string, k int").repartition(3)
    for collation in (None, "ja"):
        table = ranked.build_ranked(df, str(tmp_path / f"r{collation}"), ("name", "k"), collation, ranges=6)
        assert table.rows == 997 and len(table.starts) > 1
        for offset, limit in ((0, 5), (500, 40), (990, 40), (2000, 5), (table.starts[1][2] - 2, 4)):
            page = table.page(offset, limit)
            assert [(r["rank"], r["name"]) for r in page.collect()] == [(k, f"n{k:04}") for k in range(offset, min(997, offset + limit))]
    deep = plan(table.page(500, 10))
    assert "PartitionFilters: [isnotnull(part" in deep or "PartitionFilters: [part" in deep


def test_slices_of_a_large_group_follow_the_order(spark):
    paged = spark.createDataFrame([(1, "hot", k % 50, k) for k in range(400)] + [(2, "small", 1, 1)], "group_no long, g string, v int, k int").repartition(4)
    got = A.nested_group_page(paged, "g", ["v"], ["v", "k"], rows=30).orderBy("group_no", "slice").collect()
    assert [r["rows"] for r in got] == [30] * 13 + [10, 1]
    assert [x["v"] for r in got[:-1] for x in r["items"]] == sorted(k % 50 for k in range(400))


def test_options_with_one_prefix_come_in_bounded_parts(spark):
    options = spark.range(5000).select(F.lit("url").alias("facet"), F.concat(F.lit("https://same.example/"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("value"),
                                       F.lit(None).cast("int").alias("display_order"), F.lit(1).cast("long").alias("rows"), F.lit(False).alias("sort_last"))
    parts = D.options_document(options, page=100).orderBy("part").collect()
    assert [r["part"] for r in parts] == list(range(50))
    assert all('"value":"https://same.example/%06d"' % (100 * k) in r["options"] for k, r in enumerate(parts))


def test_one_large_csv_is_read_by_several_tasks(spark, tmp_path):
    contract = K.TableContract("t", ("id", "name"), one_line=True)
    for f in ("a", "b"):
        (tmp_path / f"{f}.csv").write_text("id,name\n" + "".join(f"{f}{k},name {k}\n" for k in range(2000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = R.read_contract_csv(spark, str(tmp_path), contract)
        assert df.rdd.getNumPartitions() > 8
        assert {(r["id"], r["_row_number"]) for r in df.collect()} == {(f"{f}{k}", k + 2) for f in "ab" for k in range(2000)}
        assert "SortMergeJoin" not in plan(df)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "b.csv").write_text("name,id\nx,y\n")
    with pytest.raises(Exception, match="not the header"):
        R.read_contract_csv(spark, str(tmp_path), contract).collect()


def test_large_tables_get_more_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranked, "RANGE_ROWS", 50)
    df = spark.createDataFrame([(k * 7919 % 997,) for k in range(997)], "k int")
    table = ranked.build_ranked(df, str(tmp_path / "many"), ("k",), ranges=2)
    assert len(table.starts) >= 15 and max(n for _, n, _ in table.starts) <= 150
    assert [(r["rank"], r["k"]) for r in table.page(700, 5).collect()] == [(k, k) for k in range(700, 705)]


def test_a_slot_of_many_texts_is_cut(spark, texts, tmp_path):
    keep = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(keep, "false")
    try:
        index = textindex.build_index(spark.createDataFrame(texts, "k long, a string, b string"), "k", ["a", "b"], str(tmp_path / "one"), 1, 1)
    finally:
        spark.conf.unset(keep)
    assert len(index.texts.inputFiles()) > 1
    assert index.find(["unique"]).collect() == [("unique", 300)]
