"""DOC operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as K
from ..operators import documents as D
from ..operators import views as V
from . import bindings as B
from .classify_plans import listing
from .registry import query
from .search_plans import search_sql


def f(spark, sf, sql):
    return B.frame(spark, sf, sql)


# what the bindings do not have stays NULL or carries the version of the layer
VERSIONS = {"academic_field_mapping_contract_version": "0.2", "academic_field_v2_mapping_contract_version": "0.3", "academic_field_v2_taxonomy_version": "0.2"}
SCALARS = [c for c in D.DERIVED if c not in ("academic_field_groups", "academic_field_v2_broad_memberships", "academic_field_v2_subcategory_memberships", "prefecture_memberships")]
ARRAYS = [c for c in D.DERIVED if c not in SCALARS]


def rows(spark, sf):
    df = B.catalogue(spark, sf)
    return D.search_rows(df.select("*", *[F.lit(v).alias(c) for c, v in VERSIONS.items()]))


def doc_sql() -> str:
    special = {"gpa_max_tenths": "CAST(NULL AS INTEGER)", "gpa_max_inclusive": "CAST(NULL AS BOOLEAN)", **{c: f"'{v}'" for c, v in VERSIONS.items()}}
    out = list(K.SEARCH_FIELDS)
    out += [f"{special.get(src, src)} AS {name}" for name, src in D.DERIVED.items() if name in SCALARS]
    return ", ".join(out)


@query("doc01_search_rows", search_sql(f"""
SELECT {doc_sql()}, array_to_string(academic_field_groups, ',') AS academic_field_groups, array_to_string(prefecture_memberships, ',') AS prefecture_memberships,
 COALESCE((SELECT string_agg(code, ',' ORDER BY rank) FROM gb JOIN bt ON code = group_code WHERE gb.record_id = s.record_id), '') AS academic_field_v2_broad_memberships,
 COALESCE((SELECT string_agg(code, ',' ORDER BY rank) FROM gs JOIN st ON code = subcategory_code WHERE gs.record_id = s.record_id), '') AS academic_field_v2_subcategory_memberships
FROM (SELECT s.*, CASE WHEN nb = 0 THEN unresolved WHEN nb = 1 THEN 'single' ELSE 'multi' END AS broad_mapping_status,
 CASE WHEN nb = 0 THEN unresolved WHEN ns = 0 THEN 'none' WHEN ns = 1 THEN 'single' ELSE 'multi' END AS subcategory_mapping_status FROM s JOIN z USING (record_id)) s"""))
def doc01(spark, sf):
    df = rows(spark, sf)
    return df.select(*[F.array_join(c, ",").alias(c) if c in ARRAYS else F.col(c) for c in df.columns])


LINES = "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM {lineitem}"


def details(spark, sf, n: int = 10_000):
    """Detail documents of the orders: identity, record, one layer, children."""
    df = f(spark, sf, B.B2_PARENT)
    return D.detail_documents(df, f(spark, sf, LINES), ["o_orderkey"], [("l_orderkey", "o_orderkey")],
                              {"flags": ["needs_child", "o_orderstatus"]}, ["c_name", "o_orderpriority"], "0.1", n)


@query("doc02_detail_documents", B.with_ctes("""
SELECT p.o_orderkey, CAST(0 AS INT) AS part, '0.1' AS schema_version, p.o_orderkey AS identity_key, c_name AS university, needs_child,
 COALESCE(string_agg(CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag || ':' || l_linestatus || ':' || CAST(n AS VARCHAR), ',' ORDER BY l_linenumber, l_returnflag, l_linestatus), '') AS children
FROM p LEFT JOIN (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, COUNT(*) AS n FROM c GROUP BY ALL) g ON l_orderkey = o_orderkey GROUP BY p.o_orderkey, c_name, needs_child""", p=B.B2_PARENT, c=LINES))
def doc02(spark, sf):
    return details(spark, sf).select(
        "o_orderkey", "part", "schema_version", F.col("identity.o_orderkey").alias("identity_key"), F.col("record.c_name").alias("university"), F.col("flags.needs_child").alias("needs_child"),
        listing("research_requirements", "l_linenumber", "l_returnflag", "l_linestatus", "copies").alias("children"))


@query("doc02_pages", B.with_ctes("""
SELECT o_orderkey, COUNT(l_orderkey) AS children, COALESCE(CAST(SUM(n) AS BIGINT), 0) AS copies, GREATEST(1, CAST(CEIL(COUNT(l_orderkey) / 3.0) AS BIGINT)) AS parts, TRUE AS unique_parts
FROM p LEFT JOIN (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, COUNT(*) AS n FROM c GROUP BY ALL) g ON l_orderkey = o_orderkey GROUP BY o_orderkey""", p=B.B2_PARENT, c=LINES))
def doc02_pages(spark, sf):
    """Parents below and above one page of children: every child is in one part, and (key, part) is the key."""
    docs = details(spark, sf, 3)
    n = F.size("research_requirements")
    return docs.groupBy("o_orderkey").agg(
        F.sum(n).cast("bigint").alias("children"), F.coalesce(F.sum(F.aggregate("research_requirements", F.lit(0).cast("bigint"), lambda a, x: a + x["copies"])), F.lit(0)).alias("copies"),
        F.count("*").alias("parts"), (F.count_distinct("part") == F.count("*")).alias("unique_parts"))


@query("doc02_document_text", B.with_ctes("""
SELECT o_orderkey, '{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_orderstatus":' || COALESCE('"' || o_orderstatus || '"', 'null') || ',"o_custkey":' || CAST(o_custkey AS VARCHAR) || '}' AS document FROM n""", n=B.B4_NEW))
def doc02_text(spark, sf):
    return D.as_json(f(spark, sf, B.B4_NEW).select("o_orderkey", "o_orderstatus", "o_custkey"), ["o_orderkey"])


FACETS = ("institution_type", "selection_category", "academic_field", "common_test_required", "selection_interview")


def options(spark, sf):
    df = f(spark, sf, B.B3).select("o_orderkey", *FACETS)
    nations = f(spark, sf, B.ORDER_NATIONS).groupBy("o_orderkey").agg(F.collect_set("n_name").alias("nations"), F.collect_set("r_name").alias("regions"))
    return D.filter_options(df.join(nations, "o_orderkey", "left"), FACETS, {
        "broad": ("regions", f(spark, sf, B.BROAD), "group_code", "rank"), "sub": ("nations", f(spark, sf, B.SUB), "subcategory_code", "rank")})


OPTION_SQL = " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value, CAST(NULL AS INTEGER) AS display_order, CAST(COUNT(*) AS BIGINT) AS rows, {c} IS NULL AS sort_last FROM b3 GROUP BY {c}" for c in FACETS) + """
UNION ALL SELECT 'broad', group_code, rank, CAST(COUNT(m.o_orderkey) AS BIGINT), FALSE FROM bt LEFT JOIN (SELECT DISTINCT o_orderkey, r_name FROM m) m ON r_name = group_code GROUP BY ALL
UNION ALL SELECT 'sub', subcategory_code, rank, CAST(COUNT(m.o_orderkey) AS BIGINT), FALSE FROM st LEFT JOIN m ON n_name = subcategory_code GROUP BY ALL"""


@query("doc03_filter_options", B.with_ctes(OPTION_SQL, b3=B.B3, bt=B.BROAD, st=B.SUB, m=B.ORDER_NATIONS))
def doc03(spark, sf):
    return options(spark, sf)


@query("doc03_options_document", B.with_ctes(f""", o AS ({OPTION_SQL})
SELECT facet, CAST(0 AS INT) AS part, '[' || string_agg('{{"value":' || COALESCE('"' || value || '"', 'null') || ',"unfiltered_count":' || CAST(rows AS VARCHAR) || '}}', ',' ORDER BY sort_last, display_order, value) || ']' AS options FROM o GROUP BY facet""",
    b3=B.B3, bt=B.BROAD, st=B.SUB, m=B.ORDER_NATIONS))
def doc03_document(spark, sf):
    return D.options_document(options(spark, sf))


@query("doc03_options_pages", B.with_ctes(f""", o AS ({OPTION_SQL}), n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY facet ORDER BY sort_last, display_order NULLS FIRST, value NULLS FIRST) - 1 AS place FROM o)
SELECT facet, CAST(place // 4 AS INT) AS part, '[' || string_agg('{{"value":' || COALESCE('"' || value || '"', 'null') || ',"unfiltered_count":' || CAST(rows AS VARCHAR) || '}}', ',' ORDER BY place) || ']' AS options FROM n GROUP BY facet, place // 4""",
    b3=B.B3, bt=B.BROAD, st=B.SUB, m=B.ORDER_NATIONS))
def doc03_pages(spark, sf):
    return D.options_document(options(spark, sf), page=4)


# search rows with defects by key: one raw text changed, one row lost, one membership dropped
GATE_KEY = ["o_orderkey"]


@query("doc04_projection_gate", B.with_ctes("""
, r AS (SELECT o_orderkey, COUNT(*) AS n FROM s GROUP BY o_orderkey), k AS (SELECT l_orderkey, COUNT(*) AS n FROM c GROUP BY l_orderkey)
SELECT CAST(COUNT(*) FILTER (o.o_orderkey % 101 = 0) AS BIGINT) AS search_key_mismatches, CAST(COUNT(*) FILTER (o.o_orderkey % 103 = 0) AS BIGINT) AS detail_key_mismatches,
 CAST(COUNT(*) FILTER (o.o_orderkey % 101 <> 0 AND o.o_orderkey % 107 = 0) AS BIGINT) AS raw_mismatches, CAST(COUNT(*) FILTER (o.o_orderkey % 101 <> 0 AND o.o_orderkey % 109 = 0 AND r.n IS NOT NULL) AS BIGINT) AS membership_mismatches,
 CAST(COUNT(*) FILTER (o.o_orderkey % 103 <> 0 AND o.o_orderkey % 113 = 0 AND k.n IS NOT NULL) AS BIGINT) AS child_mismatches,
 CAST(COUNT(*) FILTER (o.o_orderkey % 101 <> 0 AND o.o_orderkey % 127 = 0 AND o.o_orderkey % 109 <> 0 AND r.n IS NOT NULL) AS BIGINT) AS review_rows_with_members,
 (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT r_name, COUNT(DISTINCT o_orderkey) AS want, COUNT(DISTINCT CASE WHEN o_orderkey % 101 <> 0 AND o_orderkey % 109 <> 0 THEN o_orderkey END) AS have FROM s GROUP BY r_name) f WHERE want <> have) AS facet_count_mismatches
FROM orders o LEFT JOIN r USING (o_orderkey) LEFT JOIN k ON l_orderkey = o.o_orderkey""", s=B.ORDER_REGIONS, c=LINES))
def doc04(spark, sf):
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    stored = f(spark, sf, B.ORDER_REGIONS)
    arrays = stored.groupBy("o_orderkey").agg(F.collect_set("r_name").alias("codes"))
    k = F.col("o_orderkey")
    none = F.array().cast("array<string>")
    search = (orders.join(arrays, "o_orderkey", "left").where(k % 101 != 0).select(
        "o_orderkey", F.when(k % 107 == 0, "changed").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(k % 109 == 0, none).otherwise(F.coalesce("codes", none)).alias("codes"), F.when(k % 127 == 0, "review_required").otherwise("multi").alias("status")))
    lines = f(spark, sf, LINES)
    docs = V.nest(orders.where(k % 103 != 0).select("o_orderkey"), lines.where("l_orderkey % 113 <> 0"), [("l_orderkey", "o_orderkey")], "children")
    return D.projection_gate(orders, search, docs, lines.withColumnRenamed("l_orderkey", "o_orderkey"), GATE_KEY, "o_orderpriority", "codes", "status", stored, "r_name", "children")


@query("doc05_pointer_gate", "SELECT CAST(COUNT(*) AS BIGINT) AS unresolved FROM orders WHERE o_orderkey % 89 = 0")
def doc05(spark, sf):
    orders = B.table(spark, sf, "orders")
    return D.pointer_gate(orders, orders.where("o_orderkey % 89 <> 0"), ["o_orderkey"], 256)


@query("doc05_pointers", """
SELECT o_orderkey, 'details/shard=' || CAST(CAST('0x' || substr(sha256('["' || CAST(o_orderkey AS VARCHAR) || '"]'), 1, 16) AS UBIGINT) % 256 AS VARCHAR) AS detail_path FROM orders""")
def doc05_pointers(spark, sf):
    return B.table(spark, sf, "orders").select("o_orderkey", D.detail_pointer(["o_orderkey"], 256).alias("detail_path"))
