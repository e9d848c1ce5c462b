"""Lines that many documents share: normalised lines are exploded, hashed and counted by distinct document, and lines over
the threshold are dropped and the rest put together again by position.

What is shuffled for the counts is a 128-bit hash and an id per line. Whether a line goes depends on its document's id and its
key alone, so the verdict comes back as a short list of positions per text, and only then does each text move, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skew import attach
from ..sources.shared import settle

MIN_CHARS = 40
MIN_DOCUMENTS = 5
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    """What makes two lines the same: white space at both ends and the case of A-Z do not count."""
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def _hash(value: Column) -> list[Column]:
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(7), value).alias("h2")]


def repeated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(h1, h2, n_lines, n_documents, last): keys of at least ``min_chars`` code points in at least ``min_documents`` documents.

    Documents are counted by doc_id; all rows without one are one document. ``last`` is the largest doc_id that holds the key.
    """
    per_document = _lines(documents, min_chars).groupBy("h1", "h2", "doc_id").agg(F.count("*").alias("n"))
    counts = per_document.groupBy("h1", "h2").agg(F.sum("n").alias("n_lines"), F.count("*").alias("n_documents"), F.max("doc_id").alias("last"))
    return counts.where(F.col("n_documents") >= min_documents)


def _texts(documents: DataFrame) -> DataFrame:
    """(doc_id, text, t1, t2): a null text is empty; (t1, t2) tells texts of one doc_id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(7), "text"))


def _lines(documents: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, t1, t2, at, h1, h2) of every line whose key is long enough to count."""
    long_enough = F.octet_length("line") >= min_chars
    lines = _texts(documents).select("doc_id", "t1", "t2", F.posexplode(F.split("text", "\n", -1)).alias("at", "line")).where(long_enough)
    keyed = lines.withColumn("key", F.btrim("line", F.lit(SPACE))).where(F.char_length("key") >= min_chars)
    return keyed.select("doc_id", "t1", "t2", "at", *_hash(lower_ascii(F.col("key"))))


def _without(lines: Column, places: Column) -> Column:
    """Lines but those at ``places`` (ascending), as the stretches between them: linear in the lines."""
    starts = F.concat(F.array(F.lit(-1)), places)
    ends = F.concat(places, F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 2, b - a - 1)))


def drop_repeated_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, hot_rows: int = 100_000) -> DataFrame:
    """One row per document: doc_id, text (what is left), n_lines (before), n_dropped, dropped (their places, from 0).

    Texts are split at ``\\n``; a null or empty text is one empty line. A repeated key loses all its lines except in the
    largest doc_id that holds it, where all of them stay. Rows that repeat a doc_id count as one document and all keep its
    lines if it is the last; rows without a doc_id are one document that comes before all others. A text of which all lines go
    is empty. An empty table gives no rows; further columns are ignored.
    """
    repeated = settle(repeated_lines(documents, min_chars, min_documents), "repeated")
    # a frequent line may stand in a third of all documents, so its rows are spread
    found = attach(_lines(documents, min_chars), repeated, ["h1", "h2"], "n_lines", ["doc_id", "t1", "t2", "at"], hot_rows=hot_rows)
    goes = found.where(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("last")))
    dropped = goes.groupBy("doc_id", "t1", "t2").agg(F.array_sort(F.collect_set("at")).alias("dropped"))
    dropped = settle(dropped.select(F.col("doc_id").alias("d"), F.col("t1").alias("d1"), F.col("t2").alias("d2"), "dropped"), "dropped")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t1") == F.col("d1")) & (F.col("t2") == F.col("d2"))
    rows = _texts(documents).join(dropped, same, "left")
    places = F.coalesce("dropped", F.array().cast("array<int>"))
    # the split lines as a field of an element, so that they are made once and not for every stretch
    split = F.transform(F.array(F.struct(F.split("text", "\n", -1).alias("lines"), places.alias("places"))),
                        lambda x: F.struct(_without(x.lines, x.places).alias("kept"), F.size(x.lines).cast("long").alias("n")))[0]
    whole = F.col("dropped").isNull()
    out = rows.select("doc_id", "text", "dropped", F.when(~whole, split).alias("split"))
    n_lines = F.when(whole, F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).otherwise(F.col("split.n"))
    return out.select("doc_id", F.when(whole, F.col("text")).otherwise(F.array_join("split.kept", "\n")).alias("text"), n_lines.cast("long").alias("n_lines"),
                      F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
