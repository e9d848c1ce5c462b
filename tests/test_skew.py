"""Hot keys: the spread paths give the same rows as the plain ones."""

from collections import Counter

from pyspark.sql import functions as F

from catalogue.functions import skew
from catalogue.operators import classify as C
from catalogue.operators import rules as V
from catalogue.operators import views as W


def hot_rows(spark):
    """A third of the rows share one key, another part has a NULL key."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("k"), "id")


def test_attach_equals_plain_join(spark):
    rows = hot_rows(spark)
    facts = rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    for how in ("inner", "left"):
        plain = rows.join(facts, "k", how).select("k", "id", "n", "first")
        spread = skew.attach(rows, facts, ["k"], "n", ["id"], how, hot_rows=100).select("k", "id", "n", "first")
        assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0


def test_attach_really_spreads(spark):
    rows = hot_rows(spark)
    facts = rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    plan = skew.attach(rows, facts, ["k"], "n", ["id"], hot_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_salts_follow_the_rows_of_a_key_and_missing_keys_are_spread(spark):
    rows = hot_rows(spark)
    facts = rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    spread = lambda hot_rows_: (skew.attach(rows.withColumn("id2", F.col("id")), facts, ["k"], "n", ["id"], "left", hot_rows=hot_rows_))
    for limit in (500, 50):
        plan = spread(limit)
        salts = skew.attach(rows, facts.withColumn("_copy", F.lit(1)), ["k"], "n", ["id"], "left", hot_rows=limit)
        assert salts.count() == plan.count() == 3000


def test_broadcast_checks_bytes(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 1000)
    assert not skew.is_small(spark.range(10).select(F.repeat(F.lit("x"), 200).alias("s")))
    assert skew.is_small(spark.range(10))


def test_repeats_on_hot_and_missing_keys(spark):
    rows = hot_rows(spark)
    seen, want = {}, []
    for r in sorted(rows.collect(), key=lambda r: r["id"]):
        if r["k"] in seen:
            want.append((r["k"], r["id"], seen[r["k"]]))
        else:
            seen[r["k"]] = r["id"]
    got = [(r["k"], r["id"], r["first_row"]) for r in V.repeats(rows, ["k"], "id", hot_rows=100).collect()]
    assert Counter(got) == Counter(want)


def test_large_crosswalk_joins_by_key(spark, monkeypatch):
    """Above the broadcast limit classification takes the keyed path and gives the same result."""
    df = hot_rows(spark).withColumnRenamed("k", "raw").withColumn("record_id", F.col("id").cast("string"))
    xw = df.where("raw is not null and raw <> 'k5'").select(F.col("raw").alias("raw_value")).distinct().select(
        "raw_value", F.when(F.col("raw_value") == "hot", "required").otherwise("unknown").alias("requirement_status"), F.lit("").alias("review_note"))
    small = C.classify(df, "raw", xw)
    monkeypatch.setattr(C, "are_small", lambda frames: [False] * len(frames))
    monkeypatch.setattr(C, "join_keyed", lambda r, f, k, s: skew.join_keyed(r, f, k, s, hot_rows=100))
    large = C.classify(df, "raw", xw)
    assert small.columns == large.columns
    assert small.exceptAll(large).count() == 0 and large.count() == df.count()


def test_nest_splits_a_hot_parent(spark):
    parent = spark.range(5).select(F.col("id").alias("p"))
    child = spark.range(2000).select(F.when(F.col("id") < 1500, 1).otherwise(F.col("id") % 4).cast("bigint").alias("p"), (F.col("id") % 900).alias("v"))
    whole = W.nest(parent, child, [("p", "p")], "kids")
    parts = W.nest(parent, child, [("p", "p")], "kids", page=100)
    flat = lambda d: d.select("p", F.explode("kids").alias("c")).select("p", "c.v", "c.copies")
    assert flat(whole).exceptAll(flat(parts)).count() == 0 and flat(parts).exceptAll(flat(whole)).count() == 0
    assert whole.count() == 5 and parts.where("p = 1").count() > 5
    assert parts.select(F.max(F.size("kids"))).first()[0] < 300
    assert flat(whole).select(F.sum("copies")).first()[0] == 2000
    assert whole.where("p = 4").select(F.size("kids")).first()[0] == 0


def test_fingerprint_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)], "x string, y string")
    assert df.select(skew.fingerprint(["x", "y"]).alias("f")).distinct().count() == 4


def test_size_checks(spark):
    assert skew.are_small([spark.range(5), spark.range(50), spark.range(0)], max_rows=10) == [True, False, True]
    assert not skew.is_small(spark.range(50), 10)


def test_listed_hashes_always_pass(spark):
    rows = spark.range(4000).select("id", F.xxhash64("id").alias("h"))
    listed = rows.where("id % 40 = 0").select("h")
    got = skew.maybe_listed(rows, listed, "h")
    ids = {r["id"] for r in got.collect()}
    assert got.columns == ["id", "h"] and {k for k in range(0, 4000, 40)} <= ids and len(ids) < 400
    # a map that is far too small lets more pass and loses none; nothing listed lets nothing pass
    few = {r["id"] for r in skew.maybe_listed(rows, listed, "h", most=64).collect()}
    assert {k for k in range(0, 4000, 40)} <= few and len(few) > len(ids)
    assert skew.maybe_listed(rows, listed.where("false"), "h").count() == 0
    # many maps
    assert {r["id"] for r in skew.maybe_listed(rows, listed, "h", per_value=20_000).collect()} == {k for k in range(0, 4000, 40)}
