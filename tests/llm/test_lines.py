import random
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from catalogue.llm import lines

from .helpers import DOCS, WS, cluttered, empty, rows, table

LOWER = str.maketrans(lines.UPPER, lines.LOWER)


def key(line):
    return line.strip(WS).translate(LOWER)


def brute(data, min_chars=40, min_documents=5):
    holders = defaultdict(set)
    for doc_id, text, *_ in data:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= min_documents}
    out = []
    for doc_id, text, *_ in data:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if key(x) not in last or (doc_id is not None and doc_id == last[key(x)])]
        out.append((doc_id, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


def some(n=80, seed=3):
    r = random.Random(seed)
    pool = [f"{c * 12} é shared line number {k:04d} of the pool" for k, c in enumerate("ABCdefG")] + ["short", "", "  ", "É" * 40, "é" * 40, "x" * 39, "y" * 40]
    def one():
        return "\n".join(r.choice(["", " ", "\t"]) + r.choice([str.upper, str.lower, str])(r.choice(pool)) + r.choice(["", "  ", "\r"])
                         if r.random() < 0.5 else f"own {r.random()}" for _ in range(r.randint(0, 12)))
    return [(r.choice([k, k, k % 7, None]), one() if r.random() > 0.1 else None, None, "s", 0) for k in range(n)]


def left(df):
    return rows(df, "doc_id", "text", "n_lines", "n_dropped")


def test_matches_brute_force(spark):
    data = some()
    docs = spark.createDataFrame(data, DOCS)
    assert left(lines.drop_repeated_lines(docs)) == brute(data)
    assert left(lines.drop_repeated_lines(docs, 3, 2)) == brute(data, 3, 2)


def test_a_frequent_line_is_spread(spark):
    data = [(k, "the very same line in a third of all documents\n" + ("own" if k % 3 else "The very same line in a third of all documents "), None, "s", 0) for k in range(300)]
    docs = spark.createDataFrame(data, DOCS)
    assert left(lines.drop_repeated_lines(docs, hot_rows=20)) == brute(data)


def test_places_and_stretches(spark):
    data = [(k, "\n".join(["keep a"] + ["drop this line of forty or more characters"] * 2 + ["keep b", "drop this line of forty or more characters"]), None, None, 0) for k in range(6)]
    got = {r["doc_id"]: r for r in lines.drop_repeated_lines(spark.createDataFrame(data, DOCS)).collect()}
    assert got[0]["dropped"] == [1, 2, 4] and got[0]["text"] == "keep a\nkeep b"
    assert got[5]["dropped"] == [] and got[5]["n_lines"] == 5


def test_odd_rows_and_columns(spark):
    data = [tuple(r) for r in table(spark).collect()]
    assert left(lines.drop_repeated_lines(cluttered(table(spark)))) == brute(data)
    assert lines.drop_repeated_lines(empty(spark)).count() == 0
    long_one = [(1, "\n".join(["a line that stands here and there and everywhere"] * 50_000 + ["end"]), None, None, 0)]
    data = long_one + [(k, "A line that stands here and there and everywhere", None, None, 0) for k in range(2, 6)]
    got = {r["doc_id"]: r for r in lines.drop_repeated_lines(spark.createDataFrame(data, DOCS)).collect()}
    assert (got[1]["text"], got[1]["n_lines"], got[1]["n_dropped"]) == ("end", 50_001, 50_000) and got[5]["n_dropped"] == 0


def test_digest_of_what_is_left(spark):
    docs = spark.createDataFrame([(1, "é\n", None, None, 2)], DOCS)
    got = lines.drop_repeated_lines(docs).select(F.sha2(F.col("text").cast("binary"), 256)).first()[0]
    assert got == sha256("é\n".encode()).hexdigest()
