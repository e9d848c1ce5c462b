"""SRC and SNK operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..functions import columns as P
from ..operators import unify as U
from ..sources import readers as R
from ..sources import sinks as S
from . import bindings as B
from .registry import query

SOURCE = K.source_contract(K.MASTER)
LINES = K.TableContract("lines", ("id", "status", "priority"))
SNAPSHOT = K.TableContract("snapshot", ("o_orderkey", "admission_year", "stem_flag", "notes"), ("o_orderkey",),
                           ("admission_year",), ("stem_flag",))
SNAPSHOT_SQL = ("SELECT CAST(o_orderkey AS STRING) AS o_orderkey, "
                f"{B.master_columns()['admission_year']} AS admission_year, CASE WHEN o_orderkey % 19 = 0 THEN 'Yes' WHEN o_orderkey % 5 = 0 THEN '' "
                "WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS stem_flag, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS notes FROM {orders}")
DIMENSION = ("taxonomy_version", "code", "parent", "display_order")
DIMENSION_SQL = ("SELECT '0.1' AS taxonomy_version, c_name AS code, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE n_name END AS parent, "
                 "CAST(c_custkey AS STRING) AS display_order FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey")


def write_lines(spark: SparkSession, lines: DataFrame, headers: DataFrame) -> str:
    """Text files, one per part, header first; the lines come as (part, seq, line)."""
    path = B.scratch(spark)
    (headers.unionByName(lines).repartition("part").sortWithinPartitions("part", "seq")
     .select("part", "line").write.partitionBy("part").text(path))
    return path


def headers(spark: SparkSession, texts: list[str]) -> DataFrame:
    cases = F.array(*[F.lit(t) for t in texts])
    return spark.range(len(texts)).select(F.col("id").alias("part"), F.lit(-1).cast("bigint").alias("seq"),
                                          F.element_at(cases, (F.col("id") + 1).cast("int")).alias("line"))


def part_of(path_col: str):
    return F.regexp_extract(path_col, r"part=([0-9]+)", 1).cast("bigint")


SRC01_COLUMNS = ("record_id", "university", "selection_category", "capacity", "notes", "application_start", "source_url",
                 "detail_completeness", "common_test_required")


@query("src01_read_contract_csv", B.with_ctes(
    f"SELECT {', '.join(SRC01_COLUMNS)}, TRUE AS numbered FROM b1", b1=B.B1))
def src01(spark, sf):
    path = B.scratch(spark)
    S.write_canonical(B.frame(spark, sf, B.B1).select(*SOURCE.columns), path, SOURCE)
    df = R.read_contract_csv(spark, path, SOURCE)
    return df.select(*SRC01_COLUMNS, (F.col(R.ROW) >= 2).alias("numbered"))


ONE_LINE = K.TableContract("lines", ("id", "status", "priority"), one_line=True)


@query("src01_split_csv", """
SELECT part, CAST(ROW_NUMBER() OVER (PARTITION BY part ORDER BY o_orderkey) + 1 AS BIGINT) AS _row_number, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, o_orderpriority AS priority
FROM (SELECT *, CAST(o_orderkey % 3 AS BIGINT) AS part FROM orders) s""")
def src01_split(spark, sf):
    """Files of a contract without line breaks, read in pieces: the row numbers of every file."""
    lines = B.table(spark, sf, "orders").select((F.col("o_orderkey") % 3).alias("part"), F.col("o_orderkey").alias("seq"),
                                                F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority").alias("line"))
    path = write_lines(spark, lines, headers(spark, [",".join(ONE_LINE.columns)] * 3))
    df = R.read_contract_csv(spark, path, ONE_LINE)
    return df.select(part_of("_file").alias("part"), R.ROW, "id", "status", "priority")


@query("src02_csv_width", """
SELECT CAST(o_orderkey % 4 AS BIGINT) AS part, CAST(3 AS BIGINT) AS expected_count,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 4 END AS BIGINT) AS actual_count, CAST(COUNT(*) AS BIGINT) AS n
FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 GROUP BY ALL""")
def src02(spark, sf):
    k, s, p = F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', x"'))
    line = (F.when(F.col("o_orderkey") % 5 == 0, F.concat_ws(",", k, p)).when(F.col("o_orderkey") % 7 == 0, F.concat_ws(",", k, s, p, F.lit("")))
            .otherwise(F.concat_ws(",", k, s, p)))
    lines = B.table(spark, sf, "orders").select((F.col("o_orderkey") % 4).alias("part"), F.col("o_orderkey").alias("seq"), line.alias("line"))
    path = write_lines(spark, lines, headers(spark, [",".join(LINES.columns)] * 4))
    issues = R.csv_width_issues(R.read_contract_csv(spark, path, LINES), LINES)
    return issues.groupBy(part_of("file").alias("part"), "expected_count", "actual_count").agg(F.count("*").alias("n"))


@query("src03_profile", B.with_ctes("""
SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(4 AS BIGINT) AS columns,
 (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT record_id FROM b1 GROUP BY record_id HAVING COUNT(*) > 1)) AS duplicate_keys,
 (SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM b1 GROUP BY record_id, slot_type, selection_name, stem_flag)) AS exact_duplicate_rows
FROM b1""", b1=B.B1))
def src03(spark, sf):
    df = B.frame(spark, sf, B.B1).select("record_id", "slot_type", "selection_name", "stem_flag")
    return R.profile_rows(df, ["record_id"])


HEADERS = ['id,status,id,"a,b"', "id,status,priority", 'x,"x",y,y,z']


@query("src03_header_profile", """
SELECT CAST(p AS BIGINT) AS part, CAST(CASE p % 3 WHEN 0 THEN 4 WHEN 1 THEN 3 ELSE 5 END AS BIGINT) AS columns, CASE p % 3 WHEN 0 THEN 'id' WHEN 1 THEN '' ELSE 'x|y' END AS repeated_names
FROM (SELECT DISTINCT o_orderkey % 6 AS p FROM orders) s""")
def src03_headers(spark, sf):
    lines = B.table(spark, sf, "orders").select((F.col("o_orderkey") % 6).alias("part"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("line"))
    path = write_lines(spark, lines, headers(spark, HEADERS * 2))
    return R.header_profile(spark, path).select(part_of("file").alias("part"), "columns", F.array_join("repeated_names", "|").alias("repeated_names"))


@query("src03_profile_bytes", """
SELECT CAST(COUNT(*) AS BIGINT) AS crlf, CAST(0 AS BIGINT) AS cr, FALSE AS bom, CAST(SUM(strlen(source) + 2) AS BIGINT) AS size_bytes FROM documents""")
def src03_bytes(spark, sf):
    path = B.scratch(spark)
    B.table(spark, sf, "documents").select("source").write.option("lineSep", "\r\n").text(path)
    p = R.profile_text(spark, path)
    return p.agg(F.sum("crlf").alias("crlf"), F.sum("cr").alias("cr"), F.bool_or("bom").alias("bom"), F.sum("size_bytes").alias("size_bytes"))


@query("src04_read_typed", B.with_ctes("""
SELECT o_orderkey, CASE WHEN regexp_matches(admission_year, '^-?[0-9]+$') THEN CAST(admission_year AS INT) END AS admission_year,
 CASE stem_flag WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS stem_flag, NULLIF(notes, '') AS notes FROM s""", s=SNAPSHOT_SQL))
def src04(spark, sf):
    return R.typed(B.frame(spark, sf, SNAPSHOT_SQL), SNAPSHOT)


@query("src04_typed_rejects", B.with_ctes("""
SELECT o_orderkey, 'admission_year' AS field, admission_year AS value FROM s WHERE admission_year <> '' AND NOT regexp_matches(admission_year, '^-?[0-9]+$')
UNION ALL SELECT o_orderkey, 'stem_flag', stem_flag FROM s WHERE stem_flag NOT IN ('', 'true', 'false')""", s=SNAPSHOT_SQL))
def src04_rejects(spark, sf):
    return R.typed_rejects(B.frame(spark, sf, SNAPSHOT_SQL), SNAPSHOT, ["o_orderkey"])


@query("src05_read_dimension", B.with_ctes(
    "SELECT taxonomy_version, code, NULLIF(parent, '') AS parent, display_order FROM d", d=DIMENSION_SQL))
def src05(spark, sf):
    path = B.scratch(spark)
    S.write_canonical(B.frame(spark, sf, DIMENSION_SQL), path, K.TableContract("dimension", DIMENSION))
    return R.read_dimension(spark, path, DIMENSION, "taxonomy_version", "0.1")


@query("src06_read_corrections", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def src06(spark, sf):
    return R.parse_json(B.table(spark, sf, "events"), "props", "k bigint").select("event_id", "k")


@query("src06_corrections_log", """
SELECT 'C' || CAST(event_id AS VARCHAR) AS correction_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS dataset, CAST(2 AS INT) AS obsolete, CAST(event_id AS VARCHAR) AS first_obsolete,
 CASE WHEN event_id % 2 = 0 THEN event_type END AS replacement FROM events""")
def src06_log(spark, sf):
    """A log written as JSON lines with optional fields left out, read back by its schema."""
    e, path = B.table(spark, sf, "events"), B.scratch(spark)
    k = F.col("event_id").cast("string")
    unit = F.when(F.col("event_id") % 2 == 0, F.array(F.create_map(F.lit("selection_name"), F.col("event_type"))))
    e.select(F.concat(F.lit("C"), k).alias("correction_id"), F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("dataset"), F.lit("applied").alias("status"),
             F.array(k, F.concat(F.lit("old-"), k)).alias("obsolete_record_ids"), unit.alias("replacement_units")).write.json(path)
    log = R.read_corrections(spark, path)
    return log.select("correction_id", "dataset", F.size("obsolete_record_ids").alias("obsolete"), F.element_at("obsolete_record_ids", 1).alias("first_obsolete"),
                      F.try_element_at("replacement_units", F.lit(1))["selection_name"].alias("replacement"))


@query("src07_read_shards", """
SELECT CAST(COUNT(*) AS BIGINT) AS documents, TRUE AS complete, TRUE AS unique_keys, TRUE AS one_build, TRUE AS one_schema_version FROM orders""")
def src07(spark, sf):
    path = B.scratch(spark)
    docs = B.frame(spark, sf, B.B2_PARENT).select(
        "o_orderkey", "c_name", F.lit("b1").alias("build_id"), F.lit("0.1").alias("schema_version"))
    S.write_shards(docs, ["o_orderkey"], path, shards=8)
    back = R.read_shards(spark, path, "o_orderkey bigint, c_name string, build_id string, schema_version string")
    return R.shard_gate(back, ["o_orderkey"], docs.count(), "build_id", "schema_version")


SNK01_TYPED = K.TableContract("canonical", ("source_dataset", "record_id", "admission_year", "stem_flag", "notes", "application_start"),
                              integers=("admission_year",), booleans=("stem_flag",))


@query("snk01_write_canonical", B.with_ctes("""
SELECT source_dataset, record_id, CAST(NULLIF(admission_year, '') AS INT) AS admission_year,
 CASE stem_flag WHEN 'True' THEN TRUE WHEN 'False' THEN FALSE END AS stem_flag, NULLIF(notes, '') AS notes, NULLIF(application_start, '') AS application_start
FROM b1""", b1=B.B1_CLEAN))
def snk01(spark, sf):
    path = B.scratch(spark)
    src = B.frame(spark, sf, B.B1_CLEAN)
    unified = U.adapt(src, K.MASTER, F.col("source_dataset"), F.col("source_version"))
    S.write_canonical(unified.select(*SNK01_TYPED.columns), path, SNK01_TYPED, ["record_id"])
    return R.read_typed(spark, path, SNK01_TYPED)


KEY_SQL = "SELECT source_dataset, source_version, 'R' || CAST(o_orderkey AS STRING) AS record_id FROM b2"


@query("snk02_shard_plan", B.with_ctes("""
SELECT CAST(CAST('0x' || substr(sha256('["' || source_dataset || '","' || source_version || '","R' || CAST(o_orderkey AS VARCHAR) || '"]'), 1, 16) AS UBIGINT) % 16 AS BIGINT) AS shard,
 CAST(COUNT(*) AS BIGINT) AS documents FROM b3 GROUP BY 1""", b3=B.B3))
def snk02(spark, sf):
    return S.shard_plan(B.frame(spark, sf, B.B3), list(K.KEY), 16)


@query("snk02_sharding", """
SELECT CAST(n AS BIGINT) AS rows, CAST(b AS BIGINT) AS bytes,
 CAST(LEAST(n, CASE WHEN ceil(b / 4096.0) <= 1 THEN 1 ELSE pow(2, ceil(log2(ceil(b / 4096.0)))) END) AS BIGINT) AS shards
FROM (SELECT COUNT(*) AS n, SUM(strlen('{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_orderpriority":"' || o_orderpriority || '"}')) AS b FROM orders) s""")
def snk02_sharding(spark, sf):
    return S.sharding(B.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), 4096)


SIZE_ORACLE = """
WITH s AS (SELECT strlen(text) AS v, ROW_NUMBER() OVER (ORDER BY strlen(text)) AS rn, COUNT(*) OVER () AS n FROM documents)
SELECT CAST(COUNT(*) AS BIGINT) AS records, CAST(SUM(v) AS BIGINT) AS total_bytes, ROUND(AVG(v), 2) AS average_bytes, MEDIAN(v) AS median_bytes,
 CAST(MIN(CASE WHEN rn >= ceil(0.95 * n) THEN v END) AS BIGINT) AS p95_bytes, CAST(MAX(v) AS BIGINT) AS largest_bytes FROM s"""


@query("snk03_size_report", SIZE_ORACLE)
def snk03(spark, sf):
    sizes = B.table(spark, sf, "documents").select(F.octet_length("text").alias("bytes"))
    return S.size_stats(sizes, "bytes")


B4_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "price_cents", "o_orderpriority", "o_orderdate", "fallback_previous_year", "information_year")


@query("snk04_receipt", B.with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS nulls, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct_values FROM n"
    for c in B4_COLUMNS), n=B.B4_NEW))
def snk04(spark, sf):
    return S.content_profile(B.frame(spark, sf, B.B4_NEW))


@query("snk04_verify_receipt", B.with_ctes("""
SELECT 'orders' AS "table", (SELECT CAST(COUNT(*) AS BIGINT) FROM o) AS old_rows, (SELECT CAST(COUNT(*) AS BIGINT) FROM n) AS new_rows,
 EXISTS (SELECT * FROM o EXCEPT ALL SELECT * FROM n) OR EXISTS (SELECT * FROM n EXCEPT ALL SELECT * FROM o) AS changed
UNION ALL SELECT 'children', CAST(COUNT(*) AS BIGINT), CAST(COUNT(*) AS BIGINT), FALSE FROM c""", o=B.B4_OLD, n=B.B4_NEW, c=B.B4_CHILD_OLD))
def snk04_verify(spark, sf):
    old, new = B.frame(spark, sf, B.B4_OLD), B.frame(spark, sf, B.B4_NEW)
    child = B.frame(spark, sf, B.B4_CHILD_OLD)
    before = {"orders": S.receipt(old), "children": S.receipt(child.select(*child.columns))}
    return S.verify_receipt({"orders": new, "children": child}, before)


@query("snk06_assert_same", B.with_ctes("""
SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM o) AS rows_a, (SELECT CAST(COUNT(*) AS BIGINT) FROM n) AS rows_b,
 (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n)) AS only_a,
 (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o)) AS only_b""", o=B.B4_CHILD_OLD, n=B.B4_CHILD_NEW))
def snk06(spark, sf):
    return S.assert_same(B.frame(spark, sf, B.B4_CHILD_OLD), B.frame(spark, sf, B.B4_CHILD_NEW))


CELLS = ("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '=' || source WHEN 1 THEN ' +' || lang WHEN 2 THEN '　@' || source WHEN 3 THEN text WHEN 4 THEN '-1' ELSE source END AS cell, "
         "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang END AS lang FROM {documents}")


@query("snk07_guard_cells", B.with_ctes(r"""
SELECT doc_id, CASE WHEN regexp_matches(COALESCE(cell, ''), '^[\s\p{Z}\x{FEFF}]*[=+@-]|^[\t\r\n]') THEN '''' || cell ELSE COALESCE(cell, '') END AS cell, COALESCE(lang, '') AS lang FROM c""", c=CELLS))
def snk07(spark, sf):
    return S.guard_cells(B.frame(spark, sf, CELLS), ["cell", "lang"])
