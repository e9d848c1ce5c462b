"""UNI operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as K
from ..operators import classify as C
from ..operators import unify as U
from ..operators.rules import Rule
from . import bindings as B
from .projection_plans import adapted
from .registry import query

EVEN, ODD = "source_dataset = 'kokkoritsu'", "source_dataset = 'shidai'"


def parts(spark, sf):
    """The two sources, adapted one by one."""
    src = B.frame(spark, sf, B.B1_CLEAN)
    return {d: U.adapt(src.where(F.col("source_dataset") == d), K.MASTER, d, v) for d, v in K.VERSION_MATRIX.items()}


def unified(spark, sf):
    return U.unify(list(parts(spark, sf).values()))


UNI01 = ("source_dataset", "source_version", "record_id", "admission_year", "stem_flag", "detail_completeness_status", "detail_completeness_raw", "common_test_required",
         "application_start", "notes")


@query("uni01_union", B.with_ctes(f"SELECT {', '.join(adapted(c) for c in UNI01)} FROM b1", b1=B.B1_CLEAN))
def uni01(spark, sf):
    return unified(spark, sf).select(*UNI01)


@query("uni02_row_counts", B.with_ctes("""
SELECT source_dataset, CAST(COUNT(*) AS BIGINT) AS rows_in, CAST(COUNT(*) AS BIGINT) AS rows_out, TRUE AS preserved FROM b1 GROUP BY source_dataset""", b1=B.B1_CLEAN))
def uni02(spark, sf):
    src = B.frame(spark, sf, B.B1_CLEAN)
    return U.gate_row_counts({d: src.where(F.col("source_dataset") == d) for d in K.VERSION_MATRIX}, unified(spark, sf))


COMPARED = ("o_custkey", "o_orderstatus", "price_cents", "o_orderpriority", "o_orderdate")


@query("uni03_lossless", B.with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(COUNT(*) FILTER (o.{c} IS DISTINCT FROM n.{c}) AS BIGINT) AS mismatches FROM o JOIN n USING (o_orderkey)" for c in COMPARED) +
    " UNION ALL SELECT '(unmatched keys)', CAST(COUNT(*) FILTER (o.o_custkey IS NULL OR n.o_custkey IS NULL) AS BIGINT) FROM o FULL JOIN n USING (o_orderkey)", o=B.B4_OLD, n=B.B4_NEW))
def uni03(spark, sf):
    return U.gate_lossless(B.frame(spark, sf, B.B4_OLD), B.frame(spark, sf, B.B4_NEW), ["o_orderkey"], COMPARED)


@query("uni03_lossless_keyless", B.with_ctes("""
SELECT 'missing' AS side, * FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n) a UNION ALL SELECT 'extra', * FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o) b""",
    o=B.B4_CHILD_OLD, n=B.B4_CHILD_NEW))
def uni03_keyless(spark, sf):
    return U.lossless_keyless(B.frame(spark, sf, B.B4_CHILD_OLD), B.frame(spark, sf, B.B4_CHILD_NEW))


@query("uni04_provenance", B.with_ctes("""
SELECT source_dataset, source_version, CAST(COUNT(*) AS BIGINT) AS rows,
 (source_dataset = 'kokkoritsu' AND source_version = '5.83') OR (source_dataset = 'shidai' AND source_version = '1.10') AS in_matrix FROM b1 GROUP BY ALL""", b1=B.B1_VERSIONS))
def uni04(spark, sf):
    return U.gate_provenance(B.frame(spark, sf, B.B1_VERSIONS))


CHILD_KEYS = "SELECT l_orderkey, l_linenumber FROM {lineitem}"


@query("uni05_duplicate_excess", B.with_ctes("SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess FROM (SELECT COUNT(*) AS n FROM c GROUP BY ALL) g".replace("GROUP BY ALL", "GROUP BY l_orderkey, l_linenumber"), c=CHILD_KEYS))
def uni05(spark, sf):
    return U.duplicate_excess(B.frame(spark, sf, CHILD_KEYS))


@query("uni05_multiset", B.with_ctes("""
SELECT CAST(SUM(GREATEST(na - 1, 0)) AS BIGINT) AS source_excess, CAST(SUM(GREATEST(nb - 1, 0)) AS BIGINT) AS output_excess, CAST(COUNT(*) FILTER (na <> nb) AS BIGINT) AS rows_with_other_count FROM (
 SELECT l_orderkey, l_linenumber, l_returnflag, SUM(a) AS na, SUM(b) AS nb FROM (SELECT *, 1 AS a, 0 AS b FROM o UNION ALL SELECT *, 0, 1 FROM n) u GROUP BY 1, 2, 3) g""",
    o=B.B4_CHILD_OLD, n=B.B4_CHILD_NEW))
def uni05_multiset(spark, sf):
    return U.gate_multiset(B.frame(spark, sf, B.B4_CHILD_OLD), B.frame(spark, sf, B.B4_CHILD_NEW))


@query("uni06_relations", B.with_ctes("""
SELECT CAST(0 AS BIGINT) AS duplicate_keys, CAST(0 AS BIGINT) AS duplicate_coverage_keys,
 (SELECT CAST(COUNT(*) AS BIGINT) FROM c WHERE l_orderkey NOT IN (SELECT o_orderkey FROM p)) AS orphans,
 (SELECT CAST(COUNT(*) AS BIGINT) FROM v LEFT JOIN (SELECT c_name, COUNT(*) AS n FROM p GROUP BY c_name) g USING (c_name) WHERE declared <> COALESCE(n, 0)) AS count_mismatches,
 (SELECT CAST(COUNT(*) AS BIGINT) FROM p WHERE c_name NOT IN (SELECT c_name FROM v)) AS parents_without_coverage""", c=B.B2_CHILD, p=B.B2_PARENT_CUT, v=B.B2_COVERAGE))
def uni06(spark, sf):
    return U.gate_relations(B.frame(spark, sf, B.B2_PARENT_CUT), B.frame(spark, sf, B.B2_COVERAGE), B.frame(spark, sf, B.B2_CHILD),
                            ["o_orderkey"], ["c_name"], ["l_orderkey"], "declared")


def violated(rules: dict[tuple[str, str], str], src: str, key: str) -> str:
    return B.with_ctes(" UNION ALL ".join(
        f"SELECT '{n}' AS \"constraint\", '{f}' AS field, CAST(COUNT(*) AS BIGINT) AS rows, CAST(MIN({key}) AS VARCHAR) AS first_key FROM b1 WHERE {w} HAVING COUNT(*) > 0"
        for (n, f), w in rules.items()), b1=src)


# the unified form with the strict gate off: bad cells are NULL, so required and domain constraints have something to find
LOOSE = B.B1


def loose_cell(c: str) -> str:
    if c in K.INTEGER_FIELDS:
        return f"CASE WHEN regexp_matches({c}, '^-?[0-9]+$') THEN CAST({c} AS INT) END"
    if c in K.BOOLEAN_FIELDS:
        return f"CASE WHEN {c} IN ('True', 'Yes') THEN TRUE WHEN {c} IN ('False', 'No') THEN FALSE END"
    return f"NULLIF({c}, '')"


@query("uni07_constraints", violated({
    **{("required", c): f"({loose_cell(c)}) IS NULL" for c in K.MASTER.required if not c.startswith("source_")},
    ("domain", "exclusive_enrollment_status"): "exclusive_enrollment_status NOT IN ('', '専願', '併願可', '条件付き', '不明')",
    ("domain", "verification_grade"): "verification_grade NOT IN ('', 'A', 'B', 'C')"}, LOOSE, "_row_number"))
def uni07(spark, sf):
    src = B.frame(spark, sf, LOOSE)
    # the row number travels as the key through a column the contract copies unchanged
    loose = U.adapt(src.withColumn("capacity", F.col("_row_number").cast("string")), K.MASTER, F.col("source_dataset"), F.col("source_version"), strict=False)
    return U.check_constraints(loose.withColumn("_k", F.col("capacity").cast("bigint")), U.constraints(K.MASTER), "_k")


SEMANTIC = K.TableContract("semantic", ("record_id", "university", "notes", "faculty_school", "selection_interview", "selection_essay"),
                           domains=(("selection_interview", K.TRISTATE), ("selection_essay", K.TRISTATE)))


@query("uni08_semantics", B.with_ctes("""
SELECT CAST(COUNT(*) AS BIGINT) AS rows,
 CAST(SUM(""" + " + ".join(f"CASE WHEN {c} = '' THEN 1 ELSE 0 END" for c in SEMANTIC.columns) + """) AS BIGINT) AS empty_text_cells,
 CAST(SUM(CASE WHEN selection_interview NOT IN ('Yes', 'No', 'Unknown') THEN 1 ELSE 0 END + CASE WHEN selection_essay NOT IN ('Yes', 'No', 'Unknown') THEN 1 ELSE 0 END) AS BIGINT) AS domain_cells
FROM b1""", b1=B.B1))
def uni08(spark, sf):
    return U.gate_semantics(B.frame(spark, sf, B.B1), SEMANTIC)


# a rule layer with defects by key
BROKEN = """SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE 'G' || CAST(p_size AS STRING) END AS raw_value,
 CASE p_partkey % 6 WHEN 0 THEN 'not_applicable' WHEN 1 THEN 'conditional_review' ELSE 'parsed_safe' END AS parse_status,
 CASE WHEN p_partkey % 6 < 2 AND p_partkey % 13 <> 0 THEN 'not_searchable' ELSE 'safe_numeric' END AS search_disposition,
 CAST(CASE WHEN p_partkey % 6 < 2 AND p_partkey % 17 <> 0 THEN NULL WHEN p_partkey % 19 = 0 THEN NULL ELSE p_size + p_partkey % 3 END AS INT) AS gpa_min_tenths,
 CASE WHEN p_partkey % 6 < 2 OR p_partkey % 23 = 0 THEN NULL ELSE TRUE END AS gpa_min_inclusive,
 CAST(CASE WHEN p_partkey % 29 = 0 THEN p_partkey % 60 END AS INT) AS gpa_max_tenths, CASE WHEN p_partkey % 29 = 0 THEN TRUE END AS gpa_max_inclusive FROM {part}"""
SAFE = "parse_status = 'parsed_safe'"
BROKEN_RULES = {
    "raw_null_iff_not_applicable": "(raw_value IS NULL) <> (parse_status = 'not_applicable')",
    "min_in_range": "gpa_min_tenths < 0 OR gpa_min_tenths > 50",
    "max_in_range": "gpa_max_tenths < 0 OR gpa_max_tenths > 50",
    "min_not_above_max": "gpa_min_tenths > gpa_max_tenths",
    "min_with_inclusive": "(gpa_min_tenths IS NULL) <> (gpa_min_inclusive IS NULL)",
    "max_with_inclusive": "(gpa_max_tenths IS NULL) <> (gpa_max_inclusive IS NULL)",
    "safe_has_floor": f"{SAFE} AND gpa_min_tenths IS NULL",
    "unsafe_has_no_bounds": f"NOT ({SAFE}) AND (gpa_min_tenths IS NOT NULL OR gpa_max_tenths IS NOT NULL)",
    "safe_disposition": f"({SAFE}) <> (search_disposition = 'safe_numeric')",
}


@query("uni09_cross_field", violated({("cross_field", n): w for n, w in BROKEN_RULES.items()}, BROKEN, "p_partkey"))
def uni09(spark, sf):
    return U.check_constraints(B.frame(spark, sf, BROKEN), U.threshold_checks(), "p_partkey")
