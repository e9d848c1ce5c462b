"""Literal tables for the row-level functions."""

import pytest
from pyspark.sql import functions as F

from catalogue.functions import columns as P
from catalogue.sources import sinks as S


def values(spark, column, raws, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_strict_int(spark):
    raws = ["7", "-12", " 7", "7 ", "+7", "1_0", "", None, "٣", "7.0", "7\n"]
    assert values(spark, P.strict_int("c"), raws) == [7, -12] + [None] * 9


def test_strict_bool_and_blank(spark):
    assert values(spark, P.strict_bool("c"), ["True", "Yes", "False", "No", "true", "", None]) == [True, True, False, False, None, None, None]
    assert values(spark, P.null_if_blank("c"), ["", " ", "x", None]) == [None, " ", "x", None]


@pytest.mark.parametrize("raw,status", [
    ("2026-11-01", "parsed"), ("2026-02-30", "unparsed"), ("2026-11-01～2026-11-05", "partial"), ("出願 2026-11-01まで", "partial"),
    ("12026-11-01", "unparsed"), ("2026-13-01 or later", "unparsed"), ("11月上旬", "unparsed"), ("", "not_applicable"), (None, "not_applicable"),
    ("2026-11-01\n", "partial"), ("2026-W01-1", "unparsed"), ("2024-02-29", "parsed"), ("2026-02-29", "unparsed")])
def test_date_status(spark, raw, status):
    assert values(spark, P.date_status("c"), [raw]) == [status]


def test_tenths(spark):
    raws = ["3.8", "0", "5", "5.0", "5.1", "3.85", "4.", "-1", " 4.0", "", None]
    assert values(spark, P.to_tenths("c"), raws) == [38, 0, 50, 50] + [None] * 7


def test_whitespace_sees_unicode_space(spark):
    raws = ["　x", "x　", " x", "x\t", "x", "x y", " x", "x\u0085"]
    assert values(spark, P.leading_space("c"), raws) == [True, False, True, False, False, False, True, False]
    assert values(spark, P.trailing_space("c"), raws) == [False, True, False, True, False, False, False, True]


def test_mappings_depend_on_dataset(spark):
    rows = [("kokkoritsu", "detailed_2027", "探究活動必須"), ("kokkoritsu", "partial x", "not_specified"), ("kokkoritsu", "complete", "required"),
            ("shidai", "complete", "required"), ("shidai", "detailed", "related"), ("shidai", "", None)]
    df = spark.createDataFrame(rows, "source_dataset string, detail_completeness string, research_activity_level string")
    got = [tuple(r) for r in df.select(P.detail_status(), P.research_status()).collect()]
    assert got == [("complete", "required"), ("partial", "unknown"), ("unmapped", "unmapped"), ("complete", "required"), ("unmapped", "unmapped"), (None, None)]


def test_special_flags(spark):
    rows = [("総合型選抜", "国際バカロレア選抜", ""), ("総合型選抜", "AO IB", ""), ("総合型選抜", "AO IB", "SAT/ACT方式"), ("総合型選抜", "特別", "IB（内数）"),
            ("私費外国人留学生選抜", "x", ""), ("総合型", "帰国子女", "地域枠"), ("総合型", "x", "一般枠（地域枠2名を内数とする）"), ("総合型", "x", "社会人（内数）"),
            ("総合型", "x", "若干名（社会人を内数とする）"), ("総合型", "AO IB入試", "")]
    df = spark.createDataFrame(rows, "selection_category string, selection_name string, slot_type string")
    got = ["".join("Y" if v == "Yes" else "-" for v in r) for r in df.select(*P.special_flags()).collect()]
    assert got == ["Y----", "Y----", "-----", "-----", "-Y---", "--YY-", "-----", "----Y", "-----", "-----"]


def test_guard_cell(spark):
    raws = ["=1+1", " +x", "　@x", "-1", "\tx", "x=1", "", None]
    assert values(spark, P.guard_cell("c"), raws) == ["'=1+1", "' +x", "'　@x", "'-1", "'\tx", "x=1", "", ""]


@pytest.mark.parametrize("total,target,rows,want", [
    (0, 100, 0, 1), (1, 100, 5, 1), (100, 100, 5, 1), (101, 100, 5, 2), (250, 100, 9, 4), (401, 100, 9, 8), (10**9, 10, 3, 3), (2**40, 1, 10**13, 2**40)])
def test_shard_count(spark, total, target, rows, want):
    assert spark.range(1).select(S.shard_count(F.lit(total).cast("bigint"), target, F.lit(rows).cast("bigint"))).first()[0] == want


def test_evolve_keeps_place_and_content(spark):
    df = spark.createDataFrame([(1, "x", 2)], "a int, b string, c int")
    out = P.evolve(df, "a", {"new": F.lit("n"), "b": F.lit("other")})
    assert out.columns == ["a", "new", "b", "c"] and tuple(out.first()) == (1, "n", "x", 2)
