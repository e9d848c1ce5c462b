import random
import zlib
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from catalogue.llm import manifest

from .helpers import DOCS, cluttered, empty, rows, table


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fan):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[k:k + fan])) for k in range(0, len(last), fan)])
    return levels


def way(levels, at, fan):
    for nodes in levels[:-1]:
        run = at - at % fan
        yield nodes[run:at], nodes[at + 1:run + fan]
        at //= fan


def brute(data, fan=3):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), tampering with every second id."""
    by_source = defaultdict(list)
    for doc_id, text, lang, source, n_chars in data:
        by_source[source].append((doc_id, text, lang, n_chars))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        own = [(leaf((i, name, lang, n, t)), i, lang, n, t) for i, t, lang, n in by_source[name]]
        own.sort(key=lambda x: (x[1] is not None, x[1] or 0, x[0]))
        trees.append((name, own, tree([x[0] for x in own], fan)))
    top = tree([t[2][-1][0] for t in trees], fan)
    root, out = top[-1][0], []
    for k, (name, own, levels) in enumerate(trees):
        for at, (own_leaf, i, lang, n, t) in enumerate(own):
            path = [*way(levels, at, fan), *way(top, k, fan)]
            node = own_leaf
            if i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and t is not None:
                node = leaf((i, name, lang, n, t.replace("\n", "")))
            for left, right in path:
                node = digest("".join([*left, node, *right]))
            proof = digest("".join(x for left, right in path for x in [*left, *right]))
            out.append((i, own_leaf, levels[-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def check(spark, data, **kw):
    docs = spark.createDataFrame(data, DOCS)
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    assert rows(manifest.manifest(docs, claimed, **kw)) == brute(data, kw.get("fan", 3))


def some(n, sources, seed=1):
    r = random.Random(seed)
    return [(k * 3 % n, r.choice(["a\nb", "plain", None, ""]) if r.random() < 0.8 else "x" * k, r.choice(["en", None]),
             sources[0] if r.random() < 0.4 else r.choice(sources), k) for k in range(n)]


def test_deep_trees_of_several_superblocks(spark):
    # superblocks of 3 and 9: up to five of them above each other
    check(spark, some(100, ["hot", "b", None]), levels=1)
    check(spark, some(100, ["hot", *(f"s{k}" for k in range(30)), None, ""]), levels=2)
    check(spark, some(40, ["a", "é"]), fan=2)


def test_sizes_around_full_runs(spark):
    check(spark, [(k, "t\n", "en", f"s{n:02}", 2) for n in (1, 2, 3, 4, 8, 9, 10, 27, 28) for k in range(n)], levels=2)
    check(spark, [(1, "t\n", "en", "s", 2)])


def test_odd_rows_and_columns(spark):
    data = [tuple(r) for r in table(spark).collect()]
    assert rows(manifest.manifest(cluttered(table(spark)))) == [
        (*r[:5], r[3], True) for r in brute(data)]
    assert manifest.manifest(empty(spark)).count() == 0
    check(spark, [(1, "same", "en", "a", 4)] * 7 + [(None, None, None, None, None)] * 4, levels=1)


def test_proofs_lead_to_the_root(spark):
    docs = spark.createDataFrame(some(50, ["a", "b", "c", "d"]), DOCS)
    for r in manifest.prove(manifest.leaves(docs), levels=2).collect():
        assert manifest.fold(r["leaf"], r["lefts"], r["rights"]) == r["root"] == r["folded_root"]
        assert manifest.fold(digest("another"), r["lefts"], r["rights"]) != r["root"]
