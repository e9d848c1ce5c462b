"""Document projection: flat search rows, nested detail documents, filter options, and the gate over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as K
from ..functions import columns as P
from ..functions.ranks import numbered
from . import views as V
from .facets import facets, taxonomy_facet

# Derived scalars and arrays of a search row: output name -> column of the classified record.
DERIVED = {
    "academic_field_mapping_status": "academic_field_mapping_status",
    "academic_field_groups": "academic_field_groups",
    "academic_field_mapping_contract_version": "academic_field_mapping_contract_version",
    "academic_field_v2_broad_mapping_status": "broad_mapping_status",
    "academic_field_v2_subcategory_mapping_status": "subcategory_mapping_status",
    "academic_field_v2_broad_memberships": "broad_codes",
    "academic_field_v2_subcategory_memberships": "subcategory_codes",
    "academic_field_v2_mapping_contract_version": "academic_field_v2_mapping_contract_version",
    "academic_field_v2_taxonomy_version": "academic_field_v2_taxonomy_version",
    "gpa_parse_status": "gpa_parse_status",
    "gpa_search_disposition": "gpa_search_disposition",
    "gpa_min_tenths": "gpa_min_tenths",
    "gpa_min_inclusive": "gpa_min_inclusive",
    "gpa_max_tenths": "gpa_max_tenths",
    "gpa_max_inclusive": "gpa_max_inclusive",
    "gpa_source_value_status": "gpa_source_value_status",
    "grade_requirement_status": "grade_requirement_status",
    "overall_gpa_min_tenths": "overall_gpa_min_tenths",
    "overall_gpa_min_inclusive": "overall_gpa_min_inclusive",
    "overall_gpa_status": "overall_gpa_status",
    "additional_grade_conditions": "additional_grade_conditions",
    "english_requirement_status": "english_requirement_status",
    "english_requirement_parse_status": "english_parse_status",
    "english_requirement_search_disposition": "english_search_disposition",
    "prefecture_raw": "prefecture",
    "prefecture_mapping_status": "prefecture_mapping_status",
    "prefecture_memberships": "prefecture_memberships",
}
JSON_OPTIONS = {"ignoreNullFields": "false"}


def search_rows(df: DataFrame, fields: Sequence[str] = K.SEARCH_FIELDS, derived: Mapping[str, str] = DERIVED) -> DataFrame:
    """36 base columns and the derived ones; memberships as arrays of codes."""
    return df.select(*fields, *[F.col(c).alias(n) for n, c in derived.items()])


def detail_pointer(key: Sequence[str], n: int, prefix: str = "details/shard=") -> Column:
    """Where the detail document of a key lies; computed from the key alone."""
    return F.concat(F.lit(prefix), P.shard_of(key, n).cast("string"))


def detail_documents(df: DataFrame, children: DataFrame, key: Sequence[str], child_on: Sequence[tuple[str, str]],
                     layers: Mapping[str, Sequence[str]], record: Sequence[str], schema_version: str,
                     page: int = 10_000) -> DataFrame:
    """Nested detail documents: identity, record, one struct per layer, one page of children.

    The key of a document is (``key``, ``part``) at any volume; every record has its part 0.
    """
    nested = V.nest(df, children, child_on, "research_requirements", page)
    return nested.select(
        *key, "part", F.lit(schema_version).alias("schema_version"), F.struct(*key).alias("identity"),
        F.struct(*record).alias("record"), *[F.struct(*cols).alias(name) for name, cols in layers.items()],
        "research_requirements")


def as_json(docs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key columns and the document text; NULL fields are kept."""
    return docs.select(*key, F.to_json(F.struct("*"), JSON_OPTIONS).alias("document"))


def filter_options(df: DataFrame, fields: Sequence[str], memberships: Mapping[str, tuple[str, DataFrame, str, str]]) -> DataFrame:
    """One row per option: facet values in order with NULL last, taxonomy members in display order with zeros kept.

    ``memberships`` maps a facet name to (array column, taxonomy, code column, rank column). Nest the rows with
    ``options_document`` once they are known to be few.
    """
    f = facets(df, fields).select(F.col("field").alias("facet"), "value", F.lit(None).cast("int").alias("display_order"),
                                  "rows", "sort_last")
    for name, (array_col, tax, code, rank) in memberships.items():
        t = taxonomy_facet(df, array_col, tax, code)
        f = f.unionByName(t.select(F.lit(name).alias("facet"), F.col(code).cast("string").alias("value"),
                                   F.col(rank).cast("int").alias("display_order"), "rows", F.lit(False).alias("sort_last")))
    return f


def options_document(options: DataFrame, page: int = 50_000) -> DataFrame:
    """Facets as documents of ``page`` options each, keyed (facet, part) at any volume, in one order over all parts.

    All options are numbered by a range partition over (facet, order): ranges hold equally many options whatever the values
    begin with, so no task orders a facet with many values whole. An option's part follows from its place in the facet.
    """
    order = ["facet", "sort_last", "display_order", "value", "rows"]
    placed = numbered(options.select(*order), order, "_at", "options")
    starts = placed.groupBy("facet").agg(F.min("_at").alias("_first"))  # one row per facet
    cut = placed.join(F.broadcast(starts), "facet").withColumn("part", F.floor((F.col("_at") - F.col("_first")) / page).cast("int"))
    entry = F.struct("_at", "value", "rows")
    return cut.groupBy("facet", "part").agg(F.to_json(F.transform(
        F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["value"].alias("value"), e["rows"].alias("unfiltered_count"))),
        JSON_OPTIONS).alias("options"))


def projection_gate(records: DataFrame, rows: DataFrame, details: DataFrame, children: DataFrame, key: Sequence[str],
                    raw: str, array_col: str, status: str, stored: DataFrame, code: str, child_array: str) -> DataFrame:
    """One row of failure counts over records, search rows, detail documents and the stored membership table.

    Everything is compared per key after folding, so no side is multiplied. The facet over the search rows' arrays has
    to count every code as often as the stored membership table does.
    """
    key = list(key)
    sig = stored.groupBy(*key).agg(F.sort_array(F.collect_set(code)).alias("_m"))
    a = records.select(*key, F.col(raw).alias("_raw"), F.lit(True).alias("_a"))
    b = rows.select(*key, F.col(raw).alias("_raw_b"), F.sort_array(array_col).alias("_arr"), F.col(status).alias("_status"),
                    F.lit(True).alias("_b"))
    c = details.groupBy(*key).agg(
        F.sum(F.aggregate(child_array, F.lit(0).cast("bigint"), lambda acc, x: acc + x["copies"])).alias("_kids"))
    kids = children.groupBy(*key).agg(F.count("*").alias("_want"))
    j = (a.join(b, key, "full_outer").join(c.withColumn("_c", F.lit(True)), key, "full_outer")
         .join(sig, key, "left").join(kids, key, "left"))
    m = F.coalesce("_m", F.array().cast("array<string>"))
    n = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
    counted = rows.select(F.explode(array_col).alias("code")).groupBy("code").agg(F.count("*").alias("_facet"))
    kept = stored.select(*key, F.col(code).alias("code")).distinct().groupBy("code").agg(F.count("*").alias("_stored"))
    facet = counted.join(kept, "code", "full_outer").agg(
        F.count_if(~F.col("_facet").eqNullSafe(F.col("_stored"))).alias("facet_count_mismatches"))
    gate = j.agg(
        n(F.col("_b").isNull() | F.col("_a").isNull()).alias("search_key_mismatches"),
        n(F.col("_c").isNull() | F.col("_a").isNull()).alias("detail_key_mismatches"),
        n(F.col("_a") & F.col("_b") & ~F.col("_raw").eqNullSafe(F.col("_raw_b"))).alias("raw_mismatches"),
        n(F.col("_b") & (m != F.col("_arr"))).alias("membership_mismatches"),
        n(F.col("_c") & (F.coalesce("_kids", F.lit(0)) != F.coalesce("_want", F.lit(0)))).alias("child_mismatches"),
        n(F.col("_status").isin("review_required", "unmapped") & (F.size("_arr") > 0)).alias("review_rows_with_members"))
    return V.beside(gate, facet)


def pointer_gate(rows: DataFrame, details: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """Search rows whose pointer finds no detail document in that shard; any part of a document will do."""
    at = P.shard_of(key, n).alias("_shard")
    return rows.select(*key, at).join(details.select(*key, at), [*key, "_shard"], "left_anti").agg(
        F.count("*").alias("unresolved"))
