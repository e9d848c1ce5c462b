"""Small tables for the operators: nulls, empty and long texts, ties, repeated rows, columns with other operators' names."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WS = " \t\n\x0b\x0c\r"

ODD = [
    (1, "alpha beta gamma delta", "en", "a", 22), (2, "alpha  beta\tgamma\n\ndelta", "en", "b", 24), (3, None, None, None, None),
    (4, "", "en", "a", 0), (5, " ", "en", "b", 1), (6, "word " * 30000, "en", "b", 150000), (7, "word " * 30000, "de", "c", 150000),
    (7, "word " * 30000, "de", "c", 150000), (None, "no id at all", "fr", "a", 12), (8, "é" * 5000 + " fin", "fr", None, 5004),
    (9, "alpha beta gamma delta ", "en", "a", 23), (10, " x y \U0001f600", "xx", "a", 6), (11, "\t\t", None, "b", 2),
]


def table(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def cluttered(docs):
    """The same documents with further columns named like things that operators use inside."""
    from pyspark.sql import functions as F

    names = ("row", "size", "rank", "start", "sha", "own", "id", "doc", "fp", "u", "v", "i", "h", "name", "level", "copies", "record", "shard", "_key", "_bucket")
    return docs.select("*", *(F.lit(f"x{k}").alias(n) for k, n in enumerate(names)))


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=repr)
