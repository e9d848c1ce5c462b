"""AGG operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import facets as A
from . import bindings as B
from .classify_plans import listing
from .registry import query
from .sources_plans import SIZE_ORACLE

FIELDS = ("institution_type", "prefecture", "academic_field", "selection_category", "common_test_required", "exclusive_enrollment_status")


def f(spark, sf, sql):
    return B.frame(spark, sf, sql)


@query("agg01_facets", B.with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS field, {c} AS value, CAST(COUNT(*) AS BIGINT) AS rows, {c} IS NULL AS sort_last FROM s GROUP BY {c}" for c in FIELDS), s=B.B3))
def agg01(spark, sf):
    return A.facets(f(spark, sf, B.B3), FIELDS)


# the taxonomy has a code more that no record carries
SUB_AND_EMPTY = B.SUB + " UNION ALL SELECT 'NATION_NONE', 'ASIA', CAST(99 AS INT)"


@query("agg02_taxonomy_facet", B.with_ctes("""
SELECT t.subcategory_code, t.parent_group_code, t.rank, CAST(COUNT(m.o_orderkey) AS BIGINT) AS rows FROM t LEFT JOIN m ON m.n_name = t.subcategory_code GROUP BY ALL""",
    t=SUB_AND_EMPTY, m=B.ORDER_NATIONS))
def agg02(spark, sf):
    arrays = f(spark, sf, B.ORDER_NATIONS).groupBy("o_orderkey").agg(F.collect_set("n_name").alias("nations"))
    return A.taxonomy_facet(arrays, "nations", f(spark, sf, SUB_AND_EMPTY), "subcategory_code")


@query("agg03_distinct_count", "SELECT CAST(COUNT(DISTINCT l_partkey) AS BIGINT) AS distinct_values FROM lineitem")
def agg03(spark, sf):
    return A.distinct_count(B.table(spark, sf, "lineitem"), "l_partkey")


NAMED = {"urgent": "selection_name = '1-URGENT'", "interview": "selection_interview = 'Yes'", "stem_no_interview": "stem_flag AND selection_interview = 'No'", "none": "university = 'nobody'"}


@query("agg04_conditional_counts", B.with_ctes("SELECT " + ", ".join(f"CAST(COUNT(*) FILTER ({w}) AS BIGINT) AS \"{n}\"" for n, w in NAMED.items()) + " FROM s", s=B.B3))
def agg04(spark, sf):
    return A.count_where(f(spark, sf, B.B3), {n: F.expr(w) for n, w in NAMED.items()})


@query("agg05_count_by", B.with_ctes("SELECT source_dataset, CAST(COUNT(*) AS BIGINT) AS rows FROM s GROUP BY source_dataset", s=B.B3))
def agg05(spark, sf):
    return A.count_by(f(spark, sf, B.B3), "source_dataset")


@query("agg06_representatives", B.with_ctes("""
SELECT s.university, frequency, record_id AS representative_record_id, prefecture AS representative_prefecture FROM s JOIN (SELECT university, COUNT(*) AS frequency, MIN(o_orderkey) AS k FROM s GROUP BY university) g
ON s.university = g.university AND o_orderkey = k""", s=B.B3))
def agg06(spark, sf):
    return A.representatives(f(spark, sf, B.B3), "university", "o_orderkey", ["record_id", "prefecture"])


@query("agg07_first_ids", B.with_ctes("""
SELECT c.university, CAST(SUM(n) AS BIGINT) AS rows, string_agg(source_dataset || '=' || CAST(n AS VARCHAR), ',' ORDER BY source_dataset) AS by_dataset, MIN(ids) AS first_ids
FROM (SELECT university, source_dataset, COUNT(*) AS n FROM s GROUP BY ALL) c JOIN (SELECT university, string_agg(record_id, ',' ORDER BY o_orderkey) AS ids
 FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY university ORDER BY o_orderkey) AS rn FROM s) q WHERE rn <= 5 GROUP BY university) i USING (university) GROUP BY c.university""", s=B.B3))
def agg07(spark, sf):
    x = A.first_ids(f(spark, sf, B.B3), "university", "record_id", 5, ["o_orderkey"], "source_dataset")
    return x.select("university", "rows", F.array_join(F.transform("by_dataset", lambda d: F.concat_ws("=", d["dataset"], d["n"].cast("string"))), ",").alias("by_dataset"),
                    F.array_join("first_ids", ",").alias("first_ids"))


CURVE = (30, 35, 38, 40, 45)


@query("agg08_threshold_curve", B.with_ctes(" UNION ALL ".join(
    f"SELECT CAST({v} AS INT) AS value_tenths, CAST(COUNT(*) FILTER (gpa_min_tenths < {v} OR (gpa_min_tenths = {v} AND gpa_min_inclusive)) AS BIGINT) AS matches FROM p" for v in CURVE), p=B.PARTS))
def agg08(spark, sf):
    return A.threshold_curve(f(spark, sf, B.PARTS), CURVE)


@query("agg09_size_stats", SIZE_ORACLE)
def agg09(spark, sf):
    return A.size_stats(B.table(spark, sf, "documents").select(F.octet_length("text").alias("bytes")), "bytes")


@query("agg10_compare_counts", B.with_ctes("""
SELECT o_orderpriority, CAST(COALESCE(b, 0) AS BIGINT) AS before, CAST(COALESCE(a, 0) AS BIGINT) AS after, CAST(COALESCE(a, 0) - COALESCE(b, 0) AS BIGINT) AS delta,
 ROUND(CASE WHEN COALESCE(b, 0) > 0 THEN (COALESCE(a, 0) - b) * 100.0 / b END, 2) AS percent
FROM (SELECT o_orderpriority, COUNT(*) AS b FROM o GROUP BY 1) x FULL JOIN (SELECT o_orderpriority, COUNT(*) AS a FROM n GROUP BY 1) y USING (o_orderpriority)""", o=B.B4_OLD, n=B.B4_NEW))
def agg10(spark, sf):
    return A.compare_counts(f(spark, sf, B.B4_OLD), f(spark, sf, B.B4_NEW), ["o_orderpriority"])


EXTRA = "SELECT 'P' || CAST(s_suppkey AS STRING) AS record_id, CASE WHEN s_suppkey % 2 = 0 THEN 'Customer#' || LPAD(CAST(s_suppkey AS STRING), 9, '0') ELSE 'Aaa' || CAST(s_suppkey AS STRING) END AS university FROM {supplier}"


NO_GROUP = """SELECT CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE university END AS university, record_id, source_dataset, o_orderkey FROM ({b3}) b"""


@query("agg07_first_ids_no_value", B.with_ctes("""
SELECT c.university, CAST(SUM(n) AS BIGINT) AS rows, MIN(ids) AS first_ids
FROM (SELECT university, source_dataset, COUNT(*) AS n FROM s GROUP BY ALL) c JOIN (SELECT university, string_agg(record_id, ',' ORDER BY o_orderkey) AS ids
 FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY university ORDER BY o_orderkey) AS rn FROM s) q WHERE rn <= 5 GROUP BY university) i ON c.university IS NOT DISTINCT FROM i.university GROUP BY c.university""", s=NO_GROUP.replace("{b3}", B.B3)))
def agg07_no_value(spark, sf):
    x = A.first_ids(f(spark, sf, NO_GROUP.replace("{b3}", B.B3)), "university", "record_id", 5, ["o_orderkey"], "source_dataset")
    return x.select("university", "rows", F.array_join("first_ids", ",").alias("first_ids"))


@query("agg11_no_group", B.with_ctes("""
, g AS (SELECT university, MIN(record_id) AS pos FROM s GROUP BY university), p AS (SELECT university, ROW_NUMBER() OVER (ORDER BY pos) AS group_no FROM g ORDER BY pos LIMIT 15)
SELECT s.university, record_id, FALSE AS provisional, CAST(group_no AS BIGINT) AS group_no FROM s JOIN p ON s.university IS NOT DISTINCT FROM p.university""", s=NO_GROUP.replace("{b3}", B.B3)))
def agg11_no_group(spark, sf):
    return A.group_page(f(spark, sf, NO_GROUP.replace("{b3}", B.B3)).select("university", "record_id"), "university", ["record_id"])


@query("agg11_nested_page", B.with_ctes("""
, g AS (SELECT university, MIN(record_id) AS pos FROM s GROUP BY university), p AS (SELECT university, ROW_NUMBER() OVER (ORDER BY pos) AS group_no FROM g ORDER BY pos LIMIT 15)
SELECT group_no, university, CAST(place // 50 AS INT) AS slice, COUNT(*) AS rows, string_agg(record_id, ',' ORDER BY place) AS ids
FROM (SELECT CAST(group_no AS BIGINT) AS group_no, s.university, record_id, ROW_NUMBER() OVER (PARTITION BY group_no ORDER BY record_id) - 1 AS place FROM s JOIN p ON s.university IS NOT DISTINCT FROM p.university) q GROUP BY group_no, university, place // 50""", s=NO_GROUP.replace("{b3}", B.B3)))
def agg11_nested(spark, sf):
    df = A.group_page(f(spark, sf, NO_GROUP.replace("{b3}", B.B3)).select("university", "record_id"), "university", ["record_id"])
    nested = A.nested_group_page(df, "university", ["record_id"], ["record_id"], rows=50)
    ids = F.transform("items", lambda r: r["record_id"])
    return nested.select("group_no", "university", "slice", "rows", F.array_join(ids, ",").alias("ids"))


@query("agg11_group_page", B.with_ctes("""
, a AS (SELECT university, record_id, FALSE AS provisional FROM s UNION ALL SELECT university, record_id, TRUE FROM e),
g AS (SELECT university, MIN(CASE WHEN provisional THEN 1 ELSE 0 END) AS src FROM a GROUP BY university),
k AS (SELECT g.university, src, MIN(record_id) AS pos FROM g JOIN a ON a.university = g.university AND (CASE WHEN provisional THEN 1 ELSE 0 END) = src GROUP BY ALL),
p AS (SELECT university, src, pos FROM k ORDER BY src, pos, university LIMIT 15 OFFSET 15)
SELECT university, record_id, provisional, CAST(group_no AS BIGINT) AS group_no FROM a JOIN (SELECT university, ROW_NUMBER() OVER (ORDER BY src, pos) AS group_no FROM p) q USING (university)""", s=B.B3, e=EXTRA))
def agg11(spark, sf):
    df = f(spark, sf, B.B3).select("university", "record_id")
    return A.group_page(df, "university", ["record_id"], page=2, extra=f(spark, sf, EXTRA))
