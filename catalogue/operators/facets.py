"""Aggregations and facets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import numbered
from ..sources.sinks import size_stats  # noqa: F401  (AGG09 is the same aggregate as the shard size report)


def typed_literal(value: object, df: DataFrame, column: str) -> Column:
    return F.lit(value).cast(df.schema[column].dataType)


def facets(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Counts per field and value over one scan; NULL is a value of its own and ``sort_last`` puts it behind the rest."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    return (df.select(F.explode(cells).alias("c")).groupBy("c.field", "c.value").agg(F.count("*").alias("rows"))
            .withColumn("sort_last", F.col("value").isNull()))


def taxonomy_facet(df: DataFrame, array_col: Column | str, taxonomy: DataFrame, code: str) -> DataFrame:
    """Every taxonomy code with its member count, zero included."""
    hits = df.select(F.explode(array_col).alias(code)).groupBy(code).agg(F.count("*").alias("rows"))
    return taxonomy.join(hits, code, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_distinct(col).alias("distinct_values"))


def count_where(df: DataFrame, named_predicates: Mapping[str, Column]) -> DataFrame:
    """One row of conditional counts; zero on empty input."""
    return df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in named_predicates.items()])


def count_by(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("rows"))


def representatives(df: DataFrame, value: str, order: str, cols: Sequence[str]) -> DataFrame:
    """Frequency per value and the columns of its first row by ``order``."""
    g = df.groupBy(value).agg(F.count("*").alias("frequency"), F.min_by(F.struct(*cols), order).alias("_r"))
    return g.select(value, "frequency", *[F.col(f"_r.{c}").alias(f"representative_{c}") for c in cols])


def first_ids(df: DataFrame, value: str, id_: str, n: int, order: Sequence[str], dataset: str) -> DataFrame:
    """First ``n`` ids per value by order, and rows per dataset. The limit is pushed below the shuffle by Spark."""
    w = Window.partitionBy(value).orderBy(*order)
    ids = (df.select(value, id_, *[c for c in order if c != id_]).withColumn("rn", F.row_number().over(w))
           .where(F.col("rn") <= n).groupBy(value)
           .agg(F.sort_array(F.collect_list(F.struct("rn", F.col(id_).alias("id")))).alias("f")))
    counts = (df.groupBy(value, dataset).agg(F.count("*").alias("n")).groupBy(value)
              .agg(F.sum("n").alias("rows"), F.sort_array(F.collect_list(F.struct(F.col(dataset).alias("dataset"), "n"))).alias("by_dataset")))
    ids = ids.select(F.col(value).alias("_value"), F.transform("f", lambda x: x["id"]).alias("first_ids"))
    return counts.join(ids, F.col(value).eqNullSafe(F.col("_value"))).drop("_value")


def threshold_curve(layer: DataFrame, values: Sequence[int], floor: str = "gpa_min_tenths", inclusive: str = "gpa_min_inclusive") -> DataFrame:
    """Matches at each value. Floors are counted first (at most 51 x 2 groups), then compared with the values."""
    g = layer.where(F.col(floor).isNotNull()).groupBy(floor, inclusive).agg(F.count("*").alias("n"))
    hit = lambda v: (F.col(floor) < v) | ((F.col(floor) == v) & F.coalesce(inclusive, F.lit(False)))
    sums = g.agg(*[F.coalesce(F.sum(F.when(hit(v), F.col("n"))), F.lit(0)).alias(f"v{v}") for v in values])
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(v).alias("value_tenths"), F.col(f"v{v}").alias("matches")) for v in values])).alias("x")).select("x.*")


def compare_counts(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts before and after per group with delta and percent (NULL when there was nothing before)."""
    both = (a.select(*by, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
            .unionByName(b.select(*by, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    g = both.groupBy(*by).agg(F.sum("_a").alias("before"), F.sum("_b").alias("after"))
    return (g.withColumn("delta", F.col("after") - F.col("before"))
            .withColumn("percent", F.round(F.when(F.col("before") > 0, F.col("delta") * 100.0 / F.col("before")), 2)))


def group_page(df: DataFrame, group: str, order: Sequence[str], page: int = 1, size: int = 15,
               extra: DataFrame | None = None) -> DataFrame:
    """Rows of one page of groups, groups in order of their first row; ``extra`` rows follow, unknown groups last.

    Group positions come from an aggregate over the groups and a top-k; rows stay flat with their group's number, so
    even a group that owns a third of the rows is never gathered in one place. Rows without a group are a group.
    """
    first = df.groupBy(group).agg(F.min(F.struct(*order)).alias("_at")).withColumn("_src", F.lit(0))
    rows = df.withColumn("provisional", F.lit(False))
    if extra is not None:
        more = extra.groupBy(group).agg(F.min(F.struct(*order)).alias("_at")).withColumn("_src", F.lit(1))
        first = first.unionByName(more).groupBy(group).agg(F.min(F.struct("_src", "_at")).alias("_p")).select(
            group, F.col("_p._src").alias("_src"), F.col("_p._at").alias("_at"))
        rows = rows.unionByName(extra.withColumn("provisional", F.lit(True)))
    top = first.orderBy("_src", "_at").offset((max(1, page) - 1) * size).limit(size)
    # at most ``size`` rows are numbered here
    numbered = top.withColumn("group_no", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("_src", "_at")).cast("bigint"))
    numbered = F.broadcast(numbered.select(F.col(group).alias("_group"), "group_no"))
    return rows.join(numbered, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def nested_group_page(paged: DataFrame, group: str, cols: Sequence[str], order: Sequence[str], rows: int = 1000) -> DataFrame:
    """A page of groups with the rows of each group nested, ``rows`` at most in a slice: (group_no, group, slice, rows, items).

    Slices are cut from the order itself: slice 0 holds a group's first rows, and so on. Rows are numbered by a range partition
    over (group_no, ``order``), so a large group, even of equal rows, is never gathered or sorted in one place.
    """
    placed = numbered(paged.select("group_no", group, *dict.fromkeys([*cols, *order])), ["group_no", *order], "_at", "slices")
    starts = placed.groupBy("group_no").agg(F.min("_at").alias("_first"))  # a page has few groups
    cut = placed.join(F.broadcast(starts), "group_no").withColumn("slice", F.floor((F.col("_at") - F.col("_first")) / rows).cast("int"))
    entry = F.struct("_at", F.struct(*cols).alias("row"))
    return cut.groupBy("group_no", group, "slice").agg(F.count("*").alias("rows"), F.transform(
        F.sort_array(F.collect_list(entry)), lambda e: e["row"]).alias("items"))
