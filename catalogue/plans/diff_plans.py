"""SET and DIF operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import acceptance as A
from ..operators import diff as D
from ..operators import rules as V
from ..operators.search import SearchRequest
from . import bindings as B
from .registry import query

CLASSES = {"A_material": ("o_orderpriority", "price_cents"), "B_provenance": ("information_year", "fallback_previous_year"), "C_notes": ("o_orderstatus",)}
CELLS = ("o_custkey", "o_orderstatus", "price_cents", "o_orderpriority", "o_orderdate", "fallback_previous_year", "information_year")
OLD_NEW = {"o": B.B4_OLD, "n": B.B4_NEW}


def old_new(spark, sf):
    return B.frame(spark, sf, B.B4_OLD), B.frame(spark, sf, B.B4_NEW)


@query("set01_key_diff", B.with_ctes("""
SELECT o_orderkey, 'only_a' AS side FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n) UNION ALL SELECT o_orderkey, 'only_b' FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)""", **OLD_NEW))
def set01(spark, sf):
    return D.key_diff(*old_new(spark, sf), ["o_orderkey"])


@query("set02_new_values", B.with_ctes("SELECT DISTINCT o_orderpriority FROM n WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN (SELECT o_orderpriority FROM o)", **OLD_NEW))
def set02(spark, sf):
    return D.new_values(*old_new(spark, sf), "o_orderpriority")


@query("set03_multiset_diff", B.with_ctes("""
SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n) a) AS only_a, (SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o) b) AS only_b""",
    o=B.B4_CHILD_OLD, n=B.B4_CHILD_NEW))
def set03(spark, sf):
    return D.multiset_diff(B.frame(spark, sf, B.B4_CHILD_OLD), B.frame(spark, sf, B.B4_CHILD_NEW))


DIFFERENT = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in CELLS)
STATES = (f"SELECT o_orderkey, CASE WHEN o.o_custkey IS NULL THEN 'added' WHEN n.o_custkey IS NULL THEN 'removed' WHEN {DIFFERENT} THEN 'changed' ELSE 'unchanged' END AS state FROM o FULL JOIN n USING (o_orderkey)")


@query("dif01_diff_keys", B.with_ctes(STATES, **OLD_NEW))
def dif01(spark, sf):
    return D.diff_keys(*old_new(spark, sf), ["o_orderkey"])


@query("dif01_state_counts", B.with_ctes(f"""
, s AS ({STATES}) SELECT state, CAST(COUNT(*) AS BIGINT) AS rows, MIN(ex) AS examples FROM s JOIN (
 SELECT state, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ex FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY state ORDER BY o_orderkey) AS rn FROM s) q WHERE rn <= 12 GROUP BY state) x USING (state) GROUP BY state""", **OLD_NEW))
def dif01_counts(spark, sf):
    return D.count_states(D.diff_keys(*old_new(spark, sf), ["o_orderkey"]), "o_orderkey").withColumn("examples", F.array_join("examples", ","))


def cell_class(c: str) -> str:
    return next((k for k, v in CLASSES.items() if c in v), "D_other")


CELL_SQL = " UNION ALL ".join(
    f"SELECT o_orderkey, '{c}' AS field, '{cell_class(c)}' AS classification, CAST(o.{c} AS VARCHAR) AS old_value, CAST(n.{c} AS VARCHAR) AS new_value FROM o JOIN n USING (o_orderkey) WHERE o.{c} IS DISTINCT FROM n.{c}" for c in CELLS)


# the old snapshot has a column that the new one dropped, and both repeat some keys
OLD_MORE = f"SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS dropped FROM ({B.B4_OLD}) q"
REPEATED = "SELECT * FROM ({0}) a UNION ALL SELECT * FROM ({0}) b WHERE o_orderkey % {1} = 0"
OLD_TWICE, NEW_TWICE = REPEATED.format(B.B4_OLD, 14), REPEATED.format(B.B4_NEW, 22)


@query("dif01_dropped_column", B.with_ctes(f"""
, w AS (SELECT o_orderkey, dropped IS NOT NULL AS had FROM m), s AS ({STATES})
SELECT s.o_orderkey, CASE WHEN state = 'unchanged' AND had THEN 'changed' ELSE state END AS state FROM s LEFT JOIN w USING (o_orderkey)""", m=OLD_MORE, **OLD_NEW))
def dif01_dropped(spark, sf):
    return D.diff_keys(B.frame(spark, sf, OLD_MORE), B.frame(spark, sf, B.B4_NEW), ["o_orderkey"])


@query("dif02_dropped_column", B.with_ctes(f"""
{CELL_SQL} UNION ALL SELECT o_orderkey, 'dropped', 'D_other', dropped, NULL FROM m JOIN n USING (o_orderkey) WHERE dropped IS NOT NULL""", m=OLD_MORE, **OLD_NEW))
def dif02_dropped(spark, sf):
    return D.diff_cells(B.frame(spark, sf, OLD_MORE), B.frame(spark, sf, B.B4_NEW), ["o_orderkey"], CLASSES)


@query("dif01_repeated_keys", B.with_ctes(f"""
, s AS ({STATES}) SELECT o_orderkey, CASE WHEN state = 'unchanged' AND (o_orderkey % 14 = 0) <> (o_orderkey % 22 = 0) THEN 'changed' ELSE state END AS state FROM s""", **OLD_NEW))
def dif01_repeated(spark, sf):
    return D.diff_keys(B.frame(spark, sf, OLD_TWICE), B.frame(spark, sf, NEW_TWICE), ["o_orderkey"])


@query("dif02_diff_cells", B.with_ctes(CELL_SQL, **OLD_NEW))
def dif02(spark, sf):
    return D.diff_cells(*old_new(spark, sf), ["o_orderkey"], CLASSES)


@query("dif03_rollup", B.with_ctes(f"""
, c AS ({CELL_SQL}) SELECT 'field' AS kind, field AS value, CAST(COUNT(*) AS BIGINT) AS n FROM c GROUP BY field UNION ALL SELECT 'class', classification, CAST(COUNT(*) AS BIGINT) FROM c GROUP BY classification
UNION ALL SELECT 'records', classification, CAST(COUNT(DISTINCT o_orderkey) AS BIGINT) FROM c GROUP BY classification""", **OLD_NEW))
def dif03(spark, sf):
    return D.rollup_cells(D.diff_cells(*old_new(spark, sf), ["o_orderkey"], CLASSES), ["o_orderkey"])


@query("dif04_transitions", B.with_ctes("""
SELECT CAST(COUNT(*) FILTER (o.o_custkey IS NOT NULL AND n.o_custkey IS NOT NULL AND o.fallback_previous_year AND NOT n.fallback_previous_year) AS BIGINT) AS fallback_removed,
 CAST(COUNT(*) FILTER (o.o_custkey IS NOT NULL AND n.o_custkey IS NOT NULL AND NOT o.fallback_previous_year AND n.fallback_previous_year) AS BIGINT) AS fallback_introduced,
 CAST(COUNT(*) FILTER (o.o_custkey IS NOT NULL AND n.o_custkey IS NOT NULL AND (o.fallback_previous_year OR o.information_year < 2027) AND NOT n.fallback_previous_year AND n.information_year = 2027) AS BIGINT) AS current_year_confirmed,
 CAST(COUNT(*) FILTER (o.o_custkey IS NULL AND n.fallback_previous_year) AS BIGINT) AS added_with_fallback,
 CAST(COUNT(*) FILTER (o.o_custkey IS NOT NULL AND n.o_custkey IS NOT NULL AND o.information_year IS DISTINCT FROM n.information_year) AS BIGINT) AS year_changed FROM o FULL JOIN n USING (o_orderkey)""", **OLD_NEW))
def dif04(spark, sf):
    return D.transitions(*old_new(spark, sf), ["o_orderkey"], D.fallback_rules(), ["fallback_previous_year", "information_year"])


@query("dif05_diff_children", B.with_ctes("""
, g AS (SELECT l_orderkey, l_linenumber, l_returnflag, SUM(a) AS na, SUM(b) AS nb FROM (SELECT *, 1 AS a, 0 AS b FROM o UNION ALL SELECT *, 0, 1 FROM n) u GROUP BY 1, 2, 3)
SELECT CAST(SUM(na) AS BIGINT) AS old_rows, CAST(SUM(nb) AS BIGINT) AS new_rows, CAST(SUM(GREATEST(nb - na, 0)) AS BIGINT) AS rows_added, CAST(SUM(GREATEST(na - nb, 0)) AS BIGINT) AS rows_removed,
 CAST(COUNT(DISTINCT CASE WHEN na <> nb THEN l_orderkey END) AS BIGINT) AS changed_parents FROM g""", o=B.B4_CHILD_OLD, n=B.B4_CHILD_NEW))
def dif05(spark, sf):
    return D.diff_children(B.frame(spark, sf, B.B4_CHILD_OLD), B.frame(spark, sf, B.B4_CHILD_NEW), "l_orderkey")


def snapshot_issues(df):
    rules = [*V.required_rules(["o_orderstatus"]), V.Rule("INVALID_ENUM_VALUE", ~F.coalesce(F.col("o_orderstatus"), F.lit("O")).isin("O", "F", "P"), "outside", "o_orderstatus"),
             V.Rule("COMMON_TEST_FIELDS_DIFFER", F.col("fallback_previous_year") & (F.col("information_year") == 2027), "differ")]
    return V.apply_rules(df, rules, "master", F.lit("x"), "o_orderkey", "o_orderkey")


@query("dif06_issue_delta", B.with_ctes("""
, i AS (SELECT 'o' AS side, * FROM o UNION ALL SELECT 'n', * FROM n),
c AS (SELECT side, 'error' AS severity, 'REQUIRED_VALUE_MISSING' AS code FROM i WHERE o_orderstatus IS NULL UNION ALL SELECT side, 'error', 'INVALID_ENUM_VALUE' FROM i WHERE o_orderstatus NOT IN ('O', 'F', 'P')
 UNION ALL SELECT side, 'informational', 'COMMON_TEST_FIELDS_DIFFER' FROM i WHERE fallback_previous_year AND information_year = 2027)
SELECT severity, code, CAST(COUNT(*) FILTER (side = 'o') AS BIGINT) AS before, CAST(COUNT(*) FILTER (side = 'n') AS BIGINT) AS after, CAST(COUNT(*) FILTER (side = 'n') - COUNT(*) FILTER (side = 'o') AS BIGINT) AS delta FROM c GROUP BY severity, code
UNION ALL SELECT severity, NULL, CAST(COUNT(*) FILTER (side = 'o') AS BIGINT), CAST(COUNT(*) FILTER (side = 'n') AS BIGINT), CAST(COUNT(*) FILTER (side = 'n') - COUNT(*) FILTER (side = 'o') AS BIGINT) FROM c GROUP BY severity""", **OLD_NEW))
def dif06(spark, sf):
    old, new = old_new(spark, sf)
    return D.issue_delta(snapshot_issues(old), snapshot_issues(new))


CHILD = ("SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN 'other' ELSE o_orderstatus END AS o_orderstatus FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey")


@query("dif07_sidecar", B.with_ctes("""
, g AS (SELECT c_name, COUNT(*) AS n FROM p GROUP BY c_name), f AS (SELECT v.c_name AS vn, g.c_name AS gn, declared, n FROM v FULL JOIN g ON v.c_name = g.c_name),
d AS (SELECT COUNT(*) AS n FROM c GROUP BY l_orderkey, l_linenumber, o_orderstatus),
r AS (SELECT (SELECT COUNT(*) FROM f WHERE vn IS NULL) AS missing_coverage, (SELECT COUNT(*) FROM f WHERE gn IS NULL) AS stale_coverage, (SELECT COUNT(*) FROM f WHERE gn IS NULL AND declared <> 0) AS stale_nonzero,
 (SELECT COUNT(*) FROM f WHERE n <> declared) AS count_mismatches, (SELECT COUNT(*) FROM c) AS child_rows, (SELECT SUM(n - 1) FROM d) AS duplicate_children,
 (SELECT COUNT(*) FROM c WHERE l_orderkey NOT IN (SELECT o_orderkey FROM p)) AS orphans,
 (SELECT COUNT(*) FROM c JOIN p ON l_orderkey = o_orderkey WHERE c.o_orderstatus IS DISTINCT FROM p.o_orderstatus) AS denormalized_mismatches)
SELECT CAST(missing_coverage AS BIGINT) AS missing_coverage, CAST(stale_coverage AS BIGINT) AS stale_coverage, CAST(stale_nonzero AS BIGINT) AS stale_nonzero, CAST(count_mismatches AS BIGINT) AS count_mismatches,
 CAST(child_rows AS BIGINT) AS child_rows, CAST(duplicate_children AS BIGINT) AS duplicate_children, CAST(orphans AS BIGINT) AS orphans, CAST(denormalized_mismatches AS BIGINT) AS denormalized_mismatches,
 missing_coverage = 0 AND stale_nonzero = 0 AND count_mismatches = 0 AND orphans = 0 AS coherent FROM r""", p=B.B2_PARENT_CUT, v=B.B2_COVERAGE, c=CHILD))
def dif07(spark, sf):
    return D.sidecar_report(B.frame(spark, sf, B.B2_PARENT_CUT), B.frame(spark, sf, B.B2_COVERAGE), B.frame(spark, sf, CHILD), ["c_name"], "declared",
                            [("l_orderkey", "o_orderkey")], ["o_orderstatus"])


ORDER_FIELDS = ("o_orderstatus", "o_orderpriority")
DRIFT = [
    ("status F", SearchRequest(equals={"o_orderstatus": ("F",)}, exact_fields=ORDER_FIELDS), "o_orderstatus IN ('F')"),
    ("urgent or high", SearchRequest(equals={"o_orderpriority": ("1-URGENT", "2-HIGH")}, exact_fields=ORDER_FIELDS), "o_orderpriority IN ('1-URGENT', '2-HIGH')"),
    ("taken over", SearchRequest(flags={"fallback_previous_year": True}), "fallback_previous_year"),
    ("all", SearchRequest(), "TRUE"),
]


@query("dif08_search_drift", B.with_ctes(", h AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS label, 'o' AS side, o_orderkey, o_custkey FROM o WHERE {w} UNION ALL SELECT '{n}', 'n', o_orderkey, o_custkey FROM n WHERE {w}" for n, _, w in DRIFT) + """),
k AS (SELECT label, o_orderkey, BOOL_OR(side = 'o') AS io, BOOL_OR(side = 'n') AS ine FROM h GROUP BY label, o_orderkey)
SELECT label, CAST(COUNT(*) FILTER (io) AS BIGINT) AS old_rows, CAST(COUNT(*) FILTER (ine) AS BIGINT) AS new_rows, CAST(COUNT(*) FILTER (ine AND NOT io) AS BIGINT) AS added, CAST(COUNT(*) FILTER (io AND NOT ine) AS BIGINT) AS removed,
 CAST(MIN(og) AS BIGINT) AS old_groups, CAST(MIN(ng) AS BIGINT) AS new_groups FROM k JOIN (
 SELECT label, COUNT(DISTINCT CASE WHEN side = 'o' THEN o_custkey END) AS og, COUNT(DISTINCT CASE WHEN side = 'n' THEN o_custkey END) AS ng FROM h GROUP BY label) g USING (label) GROUP BY label""", **OLD_NEW))
def dif08(spark, sf):
    return D.search_drift(*old_new(spark, sf), [(n, r) for n, r, _ in DRIFT], ["o_orderkey"], "o_custkey")


# ---- acceptance of a snapshot as one job ----------------------------------------------------------------------------------

ACCEPT_SUITE = [("urgent", "o_orderpriority", ("1-URGENT",)), ("renamed", "o_orderpriority", ("6-O", "6-F")), ("marked", "o_orderstatus", ("X",)), ("nobody", "o_orderstatus", ("Z",))]
PRIORITY_XW = ("SELECT o_orderpriority AS raw_value, CASE o_orderpriority WHEN '1-URGENT' THEN 'required' ELSE 'not_required' END AS requirement_status "
               "FROM (SELECT DISTINCT o_orderpriority FROM {orders} WHERE o_orderpriority <> '5-LOW') s")
FOUND = {"REQUIRED_VALUE_MISSING": ("error", "o_orderstatus IS NULL"), "INVALID_ENUM_VALUE": ("error", "o_orderstatus NOT IN ('O', 'F', 'P')"),
         "COMMON_TEST_FIELDS_DIFFER": ("informational", "fallback_previous_year AND information_year = 2027")}


def accept_plan(spark, sf, old):
    suite = [(n, SearchRequest(equals={c: v}, exact_fields=("o_orderpriority", "o_orderstatus"))) for n, c, v in ACCEPT_SUITE]
    counts = [old.where(F.col(c).isin(list(v))).agg(F.count("*").alias("rows")).select(F.lit(n).alias("label"), "rows") for n, c, v in ACCEPT_SUITE]
    rules = [*V.required_rules(["o_orderstatus"]), V.Rule("INVALID_ENUM_VALUE", ~F.coalesce(F.col("o_orderstatus"), F.lit("O")).isin("O", "F", "P"), "outside", "o_orderstatus"),
             V.Rule("COMMON_TEST_FIELDS_DIFFER", F.col("fallback_previous_year") & (F.col("information_year") == 2027), "differ")]
    sidecar = D.sidecar_report(B.frame(spark, sf, B.B2_PARENT), B.frame(spark, sf, B.B2_COVERAGE), B.frame(spark, sf, B.B2_CHILD), ["c_name"], "declared", [("l_orderkey", "o_orderkey")])
    return A.Plan(rules=rules, dataset=F.lit("x"), classes=CLASSES, suite=suite, reviews=[A.Review("o_orderpriority", B.frame(spark, sf, PRIORITY_XW), "o_orderkey", ["o_orderkey"])],
                  sidecar=sidecar, old_suite=counts[0].unionAll(counts[1]).unionAll(counts[2]).unionAll(counts[3]),
                  old_findings=snapshot_issues(old).groupBy("severity", "code").agg(F.count("*").alias("rows")))


def suite_lines() -> str:
    hit = lambda side, c, v: f"EXISTS (SELECT 1 FROM {side} x WHERE x.o_orderkey = k.o_orderkey AND x.{c} IN ({', '.join(repr(i) for i in v)}))"
    return " UNION ALL ".join(
        f"SELECT 'drift' AS tab, '{n}' AS name, CAST(COUNT(*) FILTER ({hit('o', c, v)}) AS BIGINT) AS before, CAST(COUNT(*) FILTER ({hit('n', c, v)}) AS BIGINT) AS after, "
        f"CAST(COUNT(*) FILTER ({hit('n', c, v)} AND NOT {hit('o', c, v)}) AS BIGINT) AS n FROM (SELECT o_orderkey FROM o UNION SELECT o_orderkey FROM n) k" for n, c, v in ACCEPT_SUITE)


NULL_PAIR = "CAST(NULL AS BIGINT) AS before, CAST(NULL AS BIGINT) AS after"
MOVES = {"fallback_removed": "paired AND oo.fallback_previous_year AND NOT nn.fallback_previous_year", "fallback_introduced": "paired AND NOT oo.fallback_previous_year AND nn.fallback_previous_year",
         "current_year_confirmed": "paired AND (oo.fallback_previous_year OR oo.information_year < 2027) AND NOT nn.fallback_previous_year AND nn.information_year = 2027",
         "added_with_fallback": "oo.o_orderkey IS NULL AND nn.fallback_previous_year", "year_changed": "paired AND oo.information_year IS DISTINCT FROM nn.information_year"}
ACCEPT_SQL = B.with_ctes(f"""
, s AS ({STATES}), c AS ({CELL_SQL}), b AS (SELECT oo, nn, oo.o_orderkey IS NOT NULL AND nn.o_orderkey IS NOT NULL AS paired FROM o oo FULL JOIN n nn ON oo.o_orderkey = nn.o_orderkey)
, v AS (SELECT o_orderpriority AS raw, COUNT(*) AS n FROM n WHERE o_orderpriority IN (SELECT new_value FROM c WHERE field = 'o_orderpriority' UNION SELECT o_orderpriority FROM n WHERE o_orderkey IN (SELECT o_orderkey FROM s WHERE state = 'added')) GROUP BY 1)
SELECT 'state' AS tab, state AS name, {NULL_PAIR}, CAST(COUNT(*) AS BIGINT) AS n FROM s GROUP BY state
UNION ALL SELECT 'field', field, {NULL_PAIR}, CAST(COUNT(*) AS BIGINT) FROM c GROUP BY field
UNION ALL SELECT 'class', classification, {NULL_PAIR}, CAST(COUNT(*) AS BIGINT) FROM c GROUP BY classification
UNION ALL SELECT 'records', classification, {NULL_PAIR}, CAST(COUNT(DISTINCT o_orderkey) AS BIGINT) FROM c GROUP BY classification
{" ".join(f"UNION ALL SELECT 'transition', '{n}', {NULL_PAIR}, CAST(COUNT(*) FILTER ({w}) AS BIGINT) FROM b" for n, w in MOVES.items())}
{" ".join(f"UNION ALL SELECT 'finding', '{sev}:{code}', (SELECT COUNT(*) FROM o WHERE {w}), (SELECT COUNT(*) FROM n WHERE {w}), (SELECT COUNT(*) FROM n WHERE {w}) - (SELECT COUNT(*) FROM o WHERE {w})" for code, (sev, w) in FOUND.items())}
UNION ALL {suite_lines()}
UNION ALL SELECT 'packet', raw || ':' || CASE WHEN x.raw_value IS NULL THEN 'unmapped' ELSE 'exact_crosswalk_' || requirement_status END, {NULL_PAIR}, CAST(n AS BIGINT)
 FROM v LEFT JOIN x ON raw = x.raw_value WHERE x.raw_value IS NULL OR raw NOT IN (SELECT o_orderpriority FROM o)
UNION ALL SELECT 'gate', 'HOLD_SOURCE_COHERENCE', {NULL_PAIR}, CAST(1 AS BIGINT)""", x=PRIORITY_XW, **OLD_NEW)


@query("dif08_acceptance", ACCEPT_SQL)
def dif08_acceptance(spark, sf):
    """The whole acceptance; its result tables as one list. Coverage lacks some groups, so the gate holds the snapshot."""
    old, new = old_new(spark, sf)
    t = A.accept(old, new, ["o_orderkey"], B.scratch(spark), accept_plan(spark, sf, old))
    none = F.lit(None).cast("bigint")
    lines = [
        t["states"].select(F.lit("state").alias("tab"), F.col("state").alias("name"), none.alias("before"), none.alias("after"), F.col("rows").alias("n")),
        t["rollup"].select("kind", "value", none, none, "n"), t["transitions"].select(F.lit("transition"), "transition", none, none, "rows"),
        t["findings"].select(F.lit("finding"), F.concat_ws(":", "severity", "code"), "before", "after", "delta"),
        t["drift"].select(F.lit("drift"), "label", "old_rows", "new_rows", "added"),
        t["packets"].select(F.lit("packet"), F.concat_ws(":", "raw_or_context", "current_fail_closed_status"), none, none, "frequency"),
        t["gate"].select(F.lit("gate"), "status", none, none, F.lit(1).cast("bigint"))]
    out = lines[0]
    for line in lines[1:]:
        out = out.union(line)
    return out
