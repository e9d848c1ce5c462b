"""JOI operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import views as V
from . import bindings as B
from .classify_plans import ENGLISH_SQL, GRADE_SQL, english, grade, listing
from .registry import query


def f(spark, sf, sql):
    return B.frame(spark, sf, sql)


COVERAGE = "SELECT c_name, declared, scope, status FROM (" + B.B2_COVERAGE + ") v"
CHILD = "SELECT l_orderkey, l_linenumber, l_returnflag FROM {lineitem}"


@query("joi01_records_view", B.with_ctes("""
SELECT p.o_orderkey, p.c_name, declared AS coverage_declared, scope AS coverage_scope, status AS coverage_status, CAST(COALESCE(n, 0) AS BIGINT) AS child_rows, n IS NOT NULL AS has_children
FROM p LEFT JOIN v USING (c_name) LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM c GROUP BY l_orderkey) g ON l_orderkey = o_orderkey""", p=B.B2_PARENT, v=COVERAGE, c=CHILD))
def joi01(spark, sf):
    parent = f(spark, sf, B.B2_PARENT).select("o_orderkey", "c_name")
    return V.records_view(parent, f(spark, sf, COVERAGE), f(spark, sf, CHILD), ["c_name"], [("l_orderkey", "o_orderkey")])


@query("joi02_records_with_children", B.with_ctes("""
SELECT o_orderkey, o_orderstatus, l_orderkey AS child_l_orderkey, l_linenumber AS child_l_linenumber, l_returnflag AS child_l_returnflag FROM p LEFT JOIN c ON l_orderkey = o_orderkey""",
    p=B.B2_PARENT, c=CHILD))
def joi02(spark, sf):
    return V.records_with_children(f(spark, sf, B.B2_PARENT).select("o_orderkey", "o_orderstatus"), f(spark, sf, CHILD), [("l_orderkey", "o_orderkey")])


@query("joi03_with_layers", B.with_ctes(f"""
SELECT b3.record_id, university, requirement_status, grade_requirement_status, overall_gpa_min_tenths, n AS nations
FROM b3 JOIN (SELECT record_id, requirement_status FROM ({ENGLISH_SQL}) q) e1 USING (record_id) JOIN ({GRADE_SQL}) g1 USING (record_id)
LEFT JOIN (SELECT 'R' || CAST(o_orderkey AS VARCHAR) AS record_id, CAST(COUNT(*) AS BIGINT) AS n FROM m GROUP BY o_orderkey) k USING (record_id)""",
    b3=B.B3, e=B.ENGLISH, gx=B.GRADE, m=B.ORDER_NATIONS))
def joi03(spark, sf):
    df = f(spark, sf, B.B3).select("record_id", "university")
    nations = (f(spark, sf, B.ORDER_NATIONS).groupBy(F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("record_id")).agg(F.count("*").alias("nations")))
    return V.with_layers(df, english(spark, sf).select("record_id", "requirement_status"),
                         grade(spark, sf).select("record_id", "grade_requirement_status", "overall_gpa_min_tenths"), on=["record_id"], optional=[nations])


WANTED = ("NATION_3", "NATION_17")


def arrays(spark, sf):
    """Orders with their nations and regions as arrays."""
    m = f(spark, sf, B.ORDER_NATIONS).groupBy("o_orderkey").agg(
        F.sort_array(F.collect_set("n_name")).alias("nations"), F.sort_array(F.collect_set("r_name")).alias("regions"))
    return B.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus").join(m, "o_orderkey", "left")


ANY_SQL = B.with_ctes("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM m WHERE n_name IN ('NATION_3', 'NATION_17'))", m=B.ORDER_NATIONS)


@query("joi04_semi_membership", ANY_SQL)
def joi04(spark, sf):
    df = B.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return V.having_child(df, f(spark, sf, B.ORDER_NATIONS), ["o_orderkey"], "n_name", WANTED)


@query("joi04_array_membership", ANY_SQL)
def joi04_array(spark, sf):
    return arrays(spark, sf).where(V.has_any("nations", WANTED)).select("o_orderkey", "o_orderstatus")


BRANCHES = (("AFRICA", ("NATION_5", "NATION_10")), ("EUROPE", ()))
BRANCH_SQL = B.with_ctes("""
SELECT o_orderkey, o_orderstatus FROM orders o WHERE (EXISTS (SELECT 1 FROM m WHERE m.o_orderkey = o.o_orderkey AND r_name = 'AFRICA')
 AND EXISTS (SELECT 1 FROM m WHERE m.o_orderkey = o.o_orderkey AND r_name = 'AFRICA' AND n_name IN ('NATION_5', 'NATION_10')))
 OR EXISTS (SELECT 1 FROM m WHERE m.o_orderkey = o.o_orderkey AND r_name = 'EUROPE')""", m=B.ORDER_NATIONS)


@query("joi05_branches", BRANCH_SQL)
def joi05(spark, sf):
    return arrays(spark, sf).where(V.branch_predicate(BRANCHES, "regions", "nations")).select("o_orderkey", "o_orderstatus")


@query("joi05_branch_semi", BRANCH_SQL)
def joi05_semi(spark, sf):
    df = B.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return V.branch_semi(df, f(spark, sf, B.ORDER_REGIONS), f(spark, sf, B.ORDER_NATIONS), BRANCHES, ["o_orderkey"], "r_name", "n_name", "r_name")


@query("joi06_missing", B.with_ctes("""
SELECT 'orphan' AS kind, l_orderkey AS key, CAST(COUNT(*) AS BIGINT) AS rows FROM c WHERE l_orderkey NOT IN (SELECT o_orderkey FROM p) GROUP BY l_orderkey
UNION ALL SELECT 'without_coverage', o_orderkey, CAST(1 AS BIGINT) FROM p WHERE c_name NOT IN (SELECT c_name FROM v)""", p=B.B2_PARENT_CUT, c=CHILD, v=COVERAGE))
def joi06(spark, sf):
    parent, child = f(spark, sf, B.B2_PARENT_CUT), f(spark, sf, CHILD)
    orphans = V.missing_in(child, parent.withColumnRenamed("o_orderkey", "l_orderkey"), ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").alias("rows"))
    bare = V.missing_in(parent, f(spark, sf, COVERAGE), ["c_name"])
    return (orphans.select(F.lit("orphan").alias("kind"), F.col("l_orderkey").alias("key"), "rows")
            .unionByName(bare.select(F.lit("without_coverage").alias("kind"), F.col("o_orderkey").alias("key"), F.lit(1).cast("bigint").alias("rows"))))


@query("joi07_suppress", B.with_ctes("""
SELECT provisional_id, university, selection_name, faculty_school FROM p WHERE NOT EXISTS (
 SELECT 1 FROM c WHERE c.university = p.university AND c.selection_name = p.selection_name AND (p.faculty_school IS NULL OR p.faculty_school = '' OR c.faculty_school = p.faculty_school))""",
    p=B.PROVISIONAL, c=B.CONFIRMED))
def joi07(spark, sf):
    return V.suppress(f(spark, sf, B.PROVISIONAL).select("provisional_id", "university", "selection_name", "faculty_school"),
                      f(spark, sf, B.CONFIRMED), ["university", "selection_name"], "faculty_school")


@query("joi08_pair", B.with_ctes("""
SELECT o_orderkey, o.o_orderstatus AS old_o_orderstatus, n.o_orderstatus AS new_o_orderstatus, o.price_cents AS old_price_cents, n.price_cents AS new_price_cents,
 o.o_custkey IS NOT NULL AS in_old, n.o_custkey IS NOT NULL AS in_new FROM o FULL JOIN n USING (o_orderkey)""", o=B.B4_OLD, n=B.B4_NEW))
def joi08(spark, sf):
    return V.pair(f(spark, sf, B.B4_OLD), f(spark, sf, B.B4_NEW), ["o_orderkey"], ["o_orderstatus", "price_cents"])


APPLICANTS = "SELECT c_custkey, CAST(c_custkey % 51 AS INT) AS tenths FROM {customer}"


@query("joi09_match_values", B.with_ctes("""
SELECT c_custkey, tenths, CAST(COUNT(r.gpa_min_tenths) AS BIGINT) AS matching_rules FROM a LEFT JOIN r ON tenths > r.gpa_min_tenths OR (tenths = r.gpa_min_tenths AND r.gpa_min_inclusive)
GROUP BY c_custkey, tenths""", a=APPLICANTS, r=B.PARTS))
def joi09(spark, sf):
    return V.match_values(f(spark, sf, APPLICANTS), f(spark, sf, B.PARTS), "tenths", "gpa_min_tenths", "gpa_min_inclusive")


@query("joi10_resolve", B.with_ctes("""
SELECT o_orderkey, CASE WHEN n.o_custkey IS NULL THEN 'stale' ELSE 'current' END AS state, CASE WHEN n.o_custkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
 CASE WHEN n.o_custkey IS NULL THEN o.o_orderpriority ELSE n.o_orderpriority END AS o_orderpriority FROM o LEFT JOIN n USING (o_orderkey)""", o=B.B4_OLD, n=B.B4_NEW))
def joi10(spark, sf):
    return V.resolve(f(spark, sf, B.B4_OLD), f(spark, sf, B.B4_NEW), ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@query("joi11_nest", B.with_ctes("""
SELECT p.o_orderkey, CAST(0 AS INT) AS part, COALESCE(string_agg(CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag || ':' || CAST(n AS VARCHAR), ',' ORDER BY l_linenumber, l_returnflag), '') AS children
FROM p LEFT JOIN (SELECT l_orderkey, l_linenumber, l_returnflag, COUNT(*) AS n FROM c GROUP BY ALL) g ON l_orderkey = o_orderkey GROUP BY p.o_orderkey""", p=B.B2_PARENT, c=CHILD))
def joi11(spark, sf):
    nested = V.nest(f(spark, sf, B.B2_PARENT).select("o_orderkey"), f(spark, sf, CHILD), [("l_orderkey", "o_orderkey")], "children")
    return nested.withColumn("children", listing("children", "l_linenumber", "l_returnflag", "copies"))


INDEX = ("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS returnee_flag, CASE WHEN o_orderkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS adult_selection_flag "
         "FROM {orders} WHERE o_orderkey % 19 <> 0")
INDEX_TWICE = INDEX + " UNION ALL " + INDEX + " AND o_orderkey % 29 = 0"


@query("joi12_attach_flags", B.with_ctes("""
SELECT o.o_orderkey, CAST(COUNT(i.o_orderkey) AS BIGINT) AS index_rows, BOOL_OR(returnee_flag = 'Yes') AS returnee_flag, BOOL_OR(adult_selection_flag = 'Yes') AS adult_selection_flag
FROM orders o LEFT JOIN i USING (o_orderkey) GROUP BY o.o_orderkey""", i=INDEX_TWICE))
def joi12(spark, sf):
    index = V.flag_index(f(spark, sf, INDEX_TWICE), ["o_orderkey"], ["returnee_flag", "adult_selection_flag"])
    return V.attach_flags(B.table(spark, sf, "orders").select("o_orderkey"), index, ["o_orderkey"]).select("o_orderkey", "index_rows", "flags.*")


@query("joi12_flag_gate", B.with_ctes("""
SELECT CAST(COUNT(*) AS BIGINT) AS records, CAST(COUNT(*) FILTER (n = 0) AS BIGINT) AS missing, CAST(COUNT(*) FILTER (n > 1) AS BIGINT) AS repeated
FROM (SELECT o.o_orderkey, COUNT(i.o_orderkey) AS n FROM orders o LEFT JOIN i USING (o_orderkey) GROUP BY o.o_orderkey) q""", i=INDEX_TWICE))
def joi12_gate(spark, sf):
    index = V.flag_index(f(spark, sf, INDEX_TWICE), ["o_orderkey"], ["returnee_flag", "adult_selection_flag"])
    return V.flag_gate(V.attach_flags(B.table(spark, sf, "orders").select("o_orderkey"), index, ["o_orderkey"]))
