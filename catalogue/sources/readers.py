"""Sources: contract CSV, typed snapshots, dimensions, corrections logs and sharded documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..contract import TableContract
from ..functions import columns as P
from ..functions.skew import broadcast_if_small

CORRUPT = "_corrupt_record"
ROW = "_row_number"


def read_contract_csv(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """All-text rows of a contract CSV with the logical row number (the header is row 1).

    The first record of every file has to be the contract's header to the letter, upper and lower case included;
    another one fails the read. Blank cells and cells missing at the end of a short row are empty strings.

    A contract whose cells may hold line breaks forces one task per file. One that says ``one_line`` is read in pieces of a
    file: its rows are numbered by their place in the piece and the counts of the pieces before it.
    """
    schema = T.StructType([*contract.text_schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(schema)
           .options(header=False, multiLine=not contract.one_line, mode="PERMISSIVE", encoding="UTF-8",
                    columnNameOfCorruptRecord=CORRUPT, columnPruning=False, escape='"')
           .csv(path)
           .select(*[P.text(c).alias(c) for c in contract.columns], CORRUPT,
                   F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                   F.monotonically_increasing_id().alias("_at")))
    numbered = number_by_pieces(raw, raw.select("_file", "_block", "_at")).withColumn(ROW, F.col("_row") + 1)
    cells = [F.regexp_replace(c, r"\A\x{FEFF}", "") for c in contract.columns]
    right = F.concat_ws("\x00", *cells) == F.lit("\x00".join(contract.columns))
    wrong = F.raise_error(F.concat(F.lit("not the header of the contract: "), F.concat_ws(",", *cells), F.lit(" in "), "_file"))
    is_row = F.when(F.col(ROW) > 1, True).when(right & F.col(CORRUPT).isNull(), False).otherwise(wrong.cast("boolean"))
    return numbered.where(is_row).select(*contract.columns, ROW, CORRUPT, "_file")


def number_by_pieces(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Adds ``_row``: the row's place in its file, from 0, where each (_file, _block) was read by one task in order of ``_at``.

    What is added up is one count per piece of a file, so it is joined by broadcast and no row is shuffled; ``places`` are the
    columns (_file, _block, _at) of the same rows.
    """
    pieces = places.groupBy("_file", "_block").agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.select("_file", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start")).alias("_base"))
    return rows.join(broadcast_if_small(bases), ["_file", "_block"]).withColumn("_row", F.col("_at") + F.col("_base")).drop("_at", "_base", "_block")


def cell_count(raw: str | Column) -> Column:
    """Cells of one raw CSV record, commas inside quotes left out."""
    bare = F.regexp_replace(P.col(raw), r'"([^"]|"")*"', "")
    return (F.regexp_count(bare, F.lit(",")) + 1).cast("bigint")


def csv_width_issues(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row per record with too many or too few cells."""
    # Spark refuses a scan that needs nothing but the corrupt record, so the first column takes part in the filter
    parsed = F.length(P.text(contract.columns[0])) >= 0
    return (df.where(F.col(CORRUPT).isNotNull() & parsed)
            .select(F.col("_file").alias("file"), F.col(ROW).alias("row_number"),
                    F.lit(len(contract.columns)).cast("bigint").alias("expected_count"),
                    cell_count(CORRUPT).alias("actual_count"))
            .where("expected_count <> actual_count"))


def header_cells(line: str | Column) -> Column:
    """Cells of a header line by the rules of CSV: a quoted name may hold commas and doubled quotes."""
    cells = F.regexp_extract_all(F.regexp_replace(P.col(line), r"[\r\x{FEFF}]", ""), F.lit(r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    bare = lambda c: F.replace(F.regexp_replace(c, r'\A"|"\z', ""), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda c: F.when(c.startswith('"'), bare(c)).otherwise(c))


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of every file."""
    return (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("at"))
            .where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header")))


def header_profile(spark: SparkSession, path: str) -> DataFrame:
    """Per file: how many columns its header has, and the names it has more than once."""
    f = file_headers(spark, path).withColumn("names", header_cells("header"))
    again = F.filter("names", lambda n: F.size(F.filter("names", lambda m: m == n)) > 1)
    return f.select("file", F.size("names").cast("bigint").alias("columns"), F.array_sort(F.array_distinct(again)).alias("repeated_names"))


def header_issues(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """Files whose header differs from the contract in number of columns or in names/order."""
    first = file_headers(spark, path)
    names = header_cells("header")
    want = F.array(*[F.lit(c) for c in contract.columns])
    checked = first.withColumn("actual", names).withColumn("expected", want)
    codes = F.array_compact(F.array(
        F.when(F.size("actual") != F.size("expected"), F.lit("SOURCE_COLUMN_COUNT_MISMATCH")),
        F.when(F.col("actual") != F.col("expected"), F.lit("SOURCE_COLUMN_ORDER_MISMATCH"))))
    return checked.select(F.explode(codes).alias("code"), "file",
                          F.size("expected").cast("bigint").alias("expected_count"),
                          F.size("actual").cast("bigint").alias("actual_count"))


def profile_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, columns, keys used more than once, and rows beyond the first of an exact copy."""
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    whole = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                     F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("exact_duplicate_rows"))
    keys = (rows.groupBy(*key).agg(F.sum("n").alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("duplicate_keys")))
    # both frames hold exactly one row; the constant key joins them without a product
    return (whole.withColumn("_one", F.lit(1)).join(keys.withColumn("_one", F.lit(1)), "_one")
            .select("rows", F.lit(len(df.columns)).cast("bigint").alias("columns"), "duplicate_keys",
                    "exact_duplicate_rows"))


def profile_text(spark: SparkSession, path: str) -> DataFrame:
    """Per file: byte-order mark, and counts of CRLF, LF and CR, from a splittable line scan.

    The line reader drops a byte-order mark and the LFs, so both follow from the file size: size minus line bytes
    minus lines is 0 (all lines ended), -1 (last line open), 3 or 2 (the same with a mark).
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_size").alias("size"),
                     F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at")))
    ends_cr = F.col("value").endswith("\r")
    agg = lines.groupBy("file").agg(
        F.max("size").alias("size_bytes"), F.count("*").alias("lines"),
        F.sum(F.octet_length("value")).alias("line_bytes"),
        F.sum(F.regexp_count("value", F.lit("\r"))).alias("cr_all"),
        F.count_if(ends_cr).alias("ends_cr"), F.max_by(ends_cr, "at").alias("last_cr"))
    rest = F.col("size_bytes") - F.col("line_bytes") - F.col("lines")
    open_end = rest.isin(-1, 2)
    crlf = F.col("ends_cr") - F.when(open_end & F.col("last_cr"), 1).otherwise(0)
    return agg.select("file", "size_bytes", (rest >= 2).alias("bom"), crlf.alias("crlf"),
                      (F.col("lines") - F.when(open_end, 1).otherwise(0) - crlf).alias("lf"),
                      (F.col("cr_all") - crlf).alias("cr"))


def profile_csv(spark: SparkSession, path: str, contract: TableContract, key: Sequence[str]) -> DataFrame:
    """Preflight profile of one contract table: row part, byte part and width part in one row."""
    df = read_contract_csv(spark, path, contract)
    rows = profile_rows(df.select(*contract.columns), key)
    raw = profile_text(spark, path).agg(
        F.sum("size_bytes").alias("size_bytes"), F.bool_or("bom").alias("bom"), F.sum("crlf").alias("crlf"),
        F.sum("lf").alias("lf"), F.sum("cr").alias("cr"))
    width = csv_width_issues(df, contract).agg(F.count("*").alias("row_width_mismatches"))
    one = F.lit(1)
    return (rows.withColumn("_one", one).join(raw.withColumn("_one", one), "_one")
            .join(width.withColumn("_one", one), "_one").drop("_one"))


def _typed_value(contract: TableContract, name: str) -> Column:
    if name in contract.integers:
        return P.strict_int(name, "int")
    if name in contract.booleans:
        return F.when(F.col(name) == "true", True).when(F.col(name) == "false", False)
    return P.null_if_blank(name)


def typed(df: DataFrame, contract: TableContract) -> DataFrame:
    """Canonical snapshot text as typed columns; cells that do not parse are NULL and listed by ``typed_rejects``."""
    return df.select(*[_typed_value(contract, c).alias(c) for c in contract.columns])


def typed_rejects(df: DataFrame, contract: TableContract, key: Sequence[str]) -> DataFrame:
    """One row per non-blank cell whose text is not the canonical form of its type."""
    bad = [F.when(~P.is_blank(c) & _typed_value(contract, c).isNull(),
                  F.struct(F.lit(c).alias("field"), F.col(c).alias("value")))
           for c in contract.columns if c in contract.integers or c in contract.booleans]
    return (df.select(*key, F.explode(F.array_compact(F.array(*bad))).alias("cell"))
            .select(*key, "cell.field", "cell.value"))


def read_typed(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """Typed snapshot; a cell in a non-canonical form fails the read."""
    df = read_contract_csv(spark, path, contract)

    def value(c: str) -> Column:
        parsed = _typed_value(contract, c)
        if c not in contract.integers and c not in contract.booleans:
            return parsed
        broken = F.raise_error(F.concat(F.lit(f"not canonical in {c}: "), F.col(c))).cast(contract.kind(c))
        return F.when(~P.is_blank(c) & parsed.isNull(), broken).otherwise(parsed)

    return df.select(*[value(c).alias(c) for c in contract.columns])


def version_gate(df: DataFrame, version_column: str, version: str) -> DataFrame:
    """Rows pass only when they carry the expected version; another one fails the job."""
    same = F.col(version_column) == version
    message = F.concat(F.lit(f"{version_column} is not {version}: "), P.text(version_column))
    return df.withColumn(version_column, F.when(same, F.col(version_column)).otherwise(
        F.raise_error(message).cast("string")))


def read_dimension(spark: SparkSession, path: str, header: Sequence[str], version_column: str, version: str) -> DataFrame:
    """Taxonomy or crosswalk with exact header and one version; blank cells are NULL."""
    df = read_contract_csv(spark, path, TableContract("dimension", tuple(header)))
    gated = version_gate(df.select(*header), version_column, version)
    return gated.select(*[P.null_if_blank(c).alias(c) for c in header])


CORRECTIONS = T.StructType([
    T.StructField("correction_id", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("obsolete_record_ids", T.ArrayType(T.StringType())),
    T.StructField("replacement_units", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Corrections log, one JSON object per line, with its place in the log (file, piece of the file, line) as ``seq``."""
    lines = spark.read.schema(CORRECTIONS).json(path)
    return lines.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                      F.monotonically_increasing_id().alias("line")).alias("seq"))


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """The update queue: a CSV with its header to the letter, blank cells empty, and the row number."""
    return read_contract_csv(spark, path, TableContract("update_queue", K.QUEUE_COLUMNS))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The audit ledger: a CSV with its header to the letter, blank cells empty, and the row number."""
    return read_contract_csv(spark, path, TableContract("audit_ledger", K.LEDGER_COLUMNS))


def parse_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Nested JSON text as columns; NULL where the text is not that JSON."""
    return df.withColumn("_parsed", F.from_json(column, schema)).select("*", "_parsed.*").drop("_parsed")


def read_shards(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Documents of a sharded set; the shard number comes back from the directory name."""
    return spark.read.schema(schema).json(path)


def shard_gate(docs: DataFrame, key: Sequence[str], declared: int, build: str, schema_version: str) -> DataFrame:
    """One row: is the set complete (declared count), unique by key, from one build and one schema version."""
    keys = docs.groupBy(*key).agg(F.count("*").alias("n"), F.min(build).alias("b0"), F.max(build).alias("b1"),
                                  F.min(schema_version).alias("v0"), F.max(schema_version).alias("v1"))
    return keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents"),
        (F.coalesce(F.sum("n"), F.lit(0)) == declared).alias("complete"),
        (F.count_if(F.col("n") > 1) == 0).alias("unique_keys"),
        F.min("b0").eqNullSafe(F.max("b1")).alias("one_build"),
        F.min("v0").eqNullSafe(F.max("v1")).alias("one_schema_version"))
