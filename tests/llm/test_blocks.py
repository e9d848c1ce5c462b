import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from catalogue.llm import blocks

from .helpers import cluttered, empty, rows, table

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(data):
    groups = defaultdict(list)
    for doc_id, text in data:
        groups[SPACE.sub(" ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        kept = False
        for i in sorted(ids, key=lambda x: (x is None, x)):
            first = i == keep and not kept
            kept |= first
            out.append((i, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def some(seed, n=60):
    r = random.Random(seed)
    words = ["ab", "abab", "ba", "", "x" * 9, "é", "\t", "\n"]
    return [(k, " ".join(r.choice(words) for _ in range(r.randint(0, 6))) if r.random() > 0.1 else None) for k in range(n)]


def frame(spark, data):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")


def test_matches_brute_force_at_several_block_sizes(spark):
    data = some(1)
    for size in (4, 4096):
        assert rows(blocks.exact_duplicates(frame(spark, data), size)) == brute(data)


def test_colliding_fingerprints_change_nothing(spark):
    data = some(2, 40)
    weak = lambda block: F.lit(7).cast("long")
    assert rows(blocks.exact_duplicates(frame(spark, data), 8, weak)) == brute(data)


def test_odd_rows_and_columns(spark):
    docs = table(spark)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows(blocks.exact_duplicates(cluttered(docs))) == want
    assert blocks.exact_duplicates(empty(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = cluttered(table(spark))
    kept = blocks.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == [(1,), (10,), (3,), (5,), (6,), (8,), (9,), (None,)]
    assert blocks.drop_duplicates(empty(spark)).count() == 0


def test_names_are_dense_ranks(spark):
    named = blocks._named(spark.createDataFrame([(k * 7 % 101, 0) for k in range(101)], "a long, b long"), ["a", "b"])
    assert rows(named, "a", "name") == sorted(((k, k) for k in range(101)), key=repr)
