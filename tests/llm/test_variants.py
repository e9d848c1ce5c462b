import random
import re
import zlib
from collections import Counter

from catalogue.llm import variants

from .helpers import DOCS, cluttered, empty, rows, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(data, min_count=5):
    n = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    form, near = {}, {}
    for w in n:
        near[w] = [v for v in n if one_edit(w, v)]
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out, key=repr)


def corpus(seed, kinds=60, size=12_000):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcÀé") for _ in range(r.randint(6, 9))) for _ in range(kinds)]
    def vary(w):
        i = r.randrange(len(w))
        return r.choice([w[:i] + w[i + 1:], w[:i] + r.choice("abé") + w[i:], w[:i] + r.choice("abé") + w[i + 1:]])
    pool = stems + [vary(w) for w in stems * 3] + [vary(vary(w)) for w in stems]
    weights = [r.choice([1, 5, 30, 200]) for _ in pool]
    out = r.choices(pool, weights, k=size) + ["chaina"] * 6 + ["chainab"] * 35 + ["chainabc"] * 190 + ["chainabcd"] * 960
    return [(k, " ".join(w.upper() if r.random() < 0.1 and w.isascii() else w for w in out[k::200]) + "!", None, None, 0) for k in range(200)]


def test_matches_brute_force(spark):
    for seed in (1, 2):
        data = corpus(seed)
        want = brute(words_of(data))
        assert any(r[1] and r[1] != r[2] for r in want)  # chains of two forms
        assert rows(variants.spelling_variants(spark.createDataFrame(data, DOCS))) == want


def test_equal_letters_in_a_row_count_once(spark):
    n = {"aaaaaaa": 7, "aaaaaa": 50, "aaaaab": 50, "baaaaaa": 6, "aaaaaaaa": 5}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in variants.neighbours(words).collect()}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v))
        assert got[w] == (len(near), n[best], best)


def test_many_replacements_of_one_letter_make_no_pairs(spark):
    letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]
    n = {f"stem{c}end": 5 + k for k, c in enumerate(letters)}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    turned = variants.rotations(words)
    assert turned.groupBy("prefix").count().agg({"count": "max"}).first()[0] == len(letters)
    got = variants.neighbours(words).collect()
    assert len(got) == len(letters) and all(r["n_near"] == len(letters) - 1 for r in got)


def test_odd_rows_and_columns(spark):
    data = [tuple(r) for r in table(spark).collect()]
    data += [(None, "variant Variant VARIANT variant variant variantx", "en", None, 0)] * 5
    docs = spark.createDataFrame(data, DOCS)
    assert rows(variants.spelling_variants(cluttered(docs))) == brute(words_of(data))
    assert variants.spelling_variants(empty(spark)).count() == 0
