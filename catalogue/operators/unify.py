"""Adapting sources to the unified contract, and the gates that prove nothing was lost on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as K
from ..functions import columns as P
from .rules import Rule


def _checked(parsed: Column, raw: str) -> Column:
    """The parsed value; a non-blank cell that did not parse fails the job."""
    broken = F.raise_error(F.concat(F.lit(f"cannot adapt {raw}: "), P.text(raw)))
    return F.when(~P.is_blank(raw) & parsed.isNull(), broken).otherwise(parsed)


def _required(parsed: Column, raw: str) -> Column:
    """The same for the row count of the coverage table, which may not be blank either (years may)."""
    return F.coalesce(parsed, F.raise_error(F.concat(F.lit(f"cannot adapt {raw}: "), P.text(raw))).cast("int"))


def adapt(df: DataFrame, contract: K.TableContract, dataset: Column | str, version: Column | str,
          strict: bool = True) -> DataFrame:
    """Source rows in unified form: tagged, normalised where approved, raw companions kept, contract order.

    Column names are compared up front; ``strict`` fails the job on a value outside its domain.
    """
    want, have = set(K.source_columns(contract)), {c for c in df.columns if not c.startswith("_")}
    have -= {"source_dataset", "source_version"}
    if want - have or have - want:
        raise ValueError(f"{contract.name}: missing {sorted(want - have)}, extra {sorted(have - want)}")
    name = F.lit(dataset) if isinstance(dataset, str) else dataset
    gate = _checked if strict else (lambda parsed, raw: parsed)
    statuses = {"research_activity_level": P.research_status(by=name), "detail_completeness": P.detail_status(by=name)}
    out = []
    for c in contract.columns:
        stem = c.removesuffix("_status").removesuffix("_raw")
        if c == "source_dataset":
            value = name
        elif c == "source_version":
            value = F.lit(version) if isinstance(version, str) else version
        elif stem in statuses and c.endswith("_status"):
            value = statuses[stem]
        elif stem in statuses:
            value = P.null_if_blank(stem)
        elif c in contract.integers:
            value = (_required if strict and c in K.COVERAGE.integers else gate)(P.strict_int(c, "int"), c)
        elif c in contract.booleans:
            value = gate(P.strict_bool(c), c)
        elif c in K.TRISTATE_FIELDS:
            value = gate(P.state_enum(c, K.TRISTATE), c)
        elif c == "common_test_required":
            value = gate(P.state_enum(c, K.TRISTATE, K.QUADSTATE_RENAME), c)
        else:
            value = P.null_if_blank(c)
        out.append(value.alias(c))
    return df.select(*out)


def unify(frames: Sequence[DataFrame]) -> DataFrame:
    """Strict union by name in the given source order; every row of every source stays."""
    return reduce(DataFrame.unionByName, frames)


def gate_row_counts(sources: Mapping[str, DataFrame], out: DataFrame, dataset: str = "source_dataset") -> DataFrame:
    """Per source: rows going in, rows coming out."""
    ins = unify([df.select(F.lit(n).alias(dataset)) for n, df in sources.items()])
    both = unify([ins.select(dataset, F.lit(1).alias("i"), F.lit(0).alias("o")),
                  out.select(dataset, F.lit(0).alias("i"), F.lit(1).alias("o"))])
    return (both.groupBy(dataset).agg(F.sum("i").alias("rows_in"), F.sum("o").alias("rows_out"))
            .withColumn("preserved", F.col("rows_in") == F.col("rows_out")))


def gate_lossless(src: DataFrame, out: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per copied column: cells that differ between source and output, NULL compared as a value; plus unmatched keys."""
    key = list(key)
    a = src.select(*key, *[F.col(c).alias(f"_a{i}") for i, c in enumerate(cols)], F.lit(1).alias("_ina"))
    b = out.select(*key, *[F.col(c).alias(f"_b{i}") for i, c in enumerate(cols)], F.lit(1).alias("_inb"))
    both = a.join(b, key, "full_outer")
    matched = F.col("_ina").isNotNull() & F.col("_inb").isNotNull()
    sums = both.agg(F.count_if(~matched).alias("_unmatched"), *[
        F.count_if(matched & ~F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}"))).alias(f"_d{i}") for i in range(len(cols))])
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").alias("mismatches")) for i, c in enumerate(cols)]
    cells.append(F.struct(F.lit("(unmatched keys)").alias("column"), F.col("_unmatched").alias("mismatches")))
    return sums.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def gate_provenance(df: DataFrame, matrix: Mapping[str, str] = K.VERSION_MATRIX, dataset: str = "source_dataset",
                    version: str = "source_version") -> DataFrame:
    """Rows per (dataset, version) and whether the pair is in the matrix."""
    known = reduce(lambda a, b: a | b, [(F.col(dataset) == d) & (F.col(version) == v) for d, v in matrix.items()])
    return (df.groupBy(dataset, version).agg(F.count("*").alias("rows"))
            .withColumn("in_matrix", F.coalesce(known, F.lit(False))))


def duplicate_excess(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each exact copy."""
    return (df.groupBy(*df.columns).agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess")))


def gate_multiset(src: DataFrame, out: DataFrame) -> DataFrame:
    """Do both frames hold every row equally often; excess copies on each side and rows with another count."""
    cols = src.columns
    both = unify([src.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")),
                  out.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))])
    counts = both.groupBy(*cols).agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))
    over = lambda c: F.coalesce(F.sum(F.greatest(F.col(c) - 1, F.lit(0))), F.lit(0))
    return counts.agg(over("na").alias("source_excess"), over("nb").alias("output_excess"),
                      F.count_if(F.col("na") != F.col("nb")).alias("rows_with_other_count"))


def gate_relations(parent: DataFrame, coverage: DataFrame, child: DataFrame, key: Sequence[str],
                   coverage_key: Sequence[str], child_on: Sequence[str], declared: str) -> DataFrame:
    """One row of five counts: repeated keys, repeated coverage keys, orphans, wrong counts, parents without coverage.

    ``child_on`` are the child's columns in the order of ``key``. Every input is counted per key before it is joined,
    so a key that owns a third of the rows is one row by then.
    """
    key, coverage_key = list(key), list(coverage_key)
    parents = parent.groupBy(*key).agg(F.count("*").alias("n"))
    groups = parent.groupBy(*coverage_key).agg(F.count("*").alias("n"))
    children = child.groupBy(*[F.col(c).alias(k) for c, k in zip(child_on, key)]).agg(F.count("*").alias("n"))
    declared_rows = coverage.groupBy(*coverage_key).agg(F.count("*").alias("c"), F.max(declared).alias("declared"))
    paired = declared_rows.join(groups, coverage_key, "full_outer")
    parts = [
        parents.agg(F.count_if(F.col("n") > 1).alias("duplicate_keys")),
        paired.agg(F.count_if(F.col("c") > 1).alias("duplicate_coverage_keys"),
                   F.count_if(F.col("c").isNotNull() & (F.col("declared") != F.coalesce("n", F.lit(0))))
                   .alias("count_mismatches"),
                   F.coalesce(F.sum(F.when(F.col("c").isNull(), F.col("n"))), F.lit(0))
                   .alias("parents_without_coverage")),
        children.join(parents.select(*key), key, "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")),
    ]
    parts = [p.withColumn("_one", F.lit(1)) for p in parts]
    return reduce(lambda a, b: a.join(b, "_one"), parts).select(
        "duplicate_keys", "duplicate_coverage_keys", "orphans", "count_mismatches", "parents_without_coverage")


# ---- constraints ----------------------------------------------------------------------------------------------------

def constraints(contract: K.TableContract) -> list[Rule]:
    """Row constraints of the unified form: required cells, domains, no empty text."""
    out = [Rule("required", F.col(c).isNull(), "required cell is NULL", c, severity="error") for c in contract.required]
    for c, domain in contract.domains:
        out.append(Rule("domain", F.col(c).isNotNull() & ~F.col(c).isin(list(domain)), "value outside the domain", c,
                        severity="error"))
    for c in contract.columns:
        if c not in contract.integers and c not in contract.booleans:
            out.append(Rule("empty_text", F.coalesce(F.col(c) == "", F.lit(False)), "empty text", c, severity="error"))
    return out


def cross_checks(contract: K.TableContract = K.MASTER) -> list[Rule]:
    """Constraints over several columns: a status is NULL exactly when its raw text is."""
    out = []
    for c in contract.columns:
        if c.endswith("_raw"):
            status = c[: -len("_raw")] + "_status"
            out.append(Rule("status_raw_pair", F.col(c).isNull() != F.col(status).isNull(),
                            "status and raw text must both be NULL or both be set", status, severity="error"))
    return out


def threshold_checks(prefix: str = "gpa_") -> list[Rule]:
    """Constraints of the numeric rule layer: bounds exist exactly on safe rules and lie in 0..50."""
    lo, hi = F.col(f"{prefix}min_tenths"), F.col(f"{prefix}max_tenths")
    lo_inc, hi_inc = F.col(f"{prefix}min_inclusive"), F.col(f"{prefix}max_inclusive")
    safe = F.col("parse_status") == "parsed_safe"
    bad = lambda cond: F.coalesce(cond, F.lit(False))
    return [Rule("cross_field", bad(cond), name, name, severity="error") for name, cond in {
        "raw_null_iff_not_applicable": F.col("raw_value").isNull() != (F.col("parse_status") == "not_applicable"),
        "min_in_range": (lo < 0) | (lo > 50),
        "max_in_range": (hi < 0) | (hi > 50),
        "min_not_above_max": lo > hi,
        "min_with_inclusive": lo.isNull() != lo_inc.isNull(),
        "max_with_inclusive": hi.isNull() != hi_inc.isNull(),
        "safe_has_floor": safe & lo.isNull(),
        "unsafe_has_no_bounds": ~safe & (lo.isNotNull() | hi.isNotNull()),
        "safe_disposition": safe != (F.col("search_disposition") == "safe_numeric"),
    }.items()]


def floor_checks(status: str = "overall_gpa_status") -> list[Rule]:
    """Constraints of the threshold layer: a floor exists exactly on safe statuses and then is complete."""
    floor = F.col("overall_gpa_min_tenths")
    safe = F.col(status).isin("safe_simple_overall", "safe_overall_with_additional_conditions")
    bad = lambda cond: F.coalesce(cond, F.lit(False))
    return [Rule("cross_field", bad(cond), name, name, severity="error") for name, cond in {
        "floor_iff_safe": safe != floor.isNotNull(),
        "floor_needs_required": floor.isNotNull() & (F.col("grade_requirement_status") != "required"),
        "floor_needs_inclusive": floor.isNotNull() & ~F.coalesce(F.col("overall_gpa_min_inclusive"), F.lit(False)),
        "no_floor_no_flags": floor.isNull() & (F.col("overall_gpa_min_inclusive").isNotNull()
                                               | F.col("additional_grade_conditions").isNotNull()),
        "additional_iff_status": floor.isNotNull() & (
            F.col("additional_grade_conditions") != (F.col(status) == "safe_overall_with_additional_conditions")),
    }.items()]


def check_constraints(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """Per violated constraint: offending rows and the smallest offending key. One scan, one combined aggregate."""
    # the rows carry the numbers of the broken rules only; names come back after the aggregate
    broken = F.array_compact(F.array(*[F.when(r.when, F.lit(i + 1)) for i, r in enumerate(rules)]))
    names = F.array(*[F.struct(F.lit(r.code).alias("constraint"), F.lit(r.field).cast("string").alias("field")) for r in rules])
    return (df.select(F.col(key).alias("_key"), F.explode(broken).alias("i")).groupBy("i")
            .agg(F.count("*").alias("rows"), F.min("_key").cast("string").alias("first_key"))
            .select(F.element_at(names, F.col("i")).alias("x"), "rows", "first_key").select("x.*", "rows", "first_key"))


def gate_semantics(df: DataFrame, contract: K.TableContract) -> DataFrame:
    """One row: empty text cells, tri-state cells and quad-state cells outside their domain."""
    texts = [c for c in contract.columns if c not in contract.integers and c not in contract.booleans and c in df.columns]
    states = [(c, d) for c, d in contract.domains if c in df.columns]
    add = lambda conds: reduce(lambda a, b: a + b, [F.when(c, 1).otherwise(0) for c in conds], F.lit(0))
    return df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(add([F.col(c) == "" for c in texts])), F.lit(0)).alias("empty_text_cells"),
        F.coalesce(F.sum(add([~F.col(c).isin(list(d)) for c, d in states])), F.lit(0)).alias("domain_cells"))


def lossless_keyless(src: DataFrame, out: DataFrame) -> DataFrame:
    """Loss check for tables without a key: rows that are missing or extra, copies counted."""
    return src.exceptAll(out).select(F.lit("missing").alias("side"), "*").unionByName(
        out.exceptAll(src).select(F.lit("extra").alias("side"), "*"))
