import random

import numpy as np
import xxhash

from catalogue.llm import simhash

from .helpers import cluttered, empty, rows, table


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + 4]) for k in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """Least member of each one's component, by comparing everything."""
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 4:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {f: root(f) for f in fps}


def cloud(seed, centres=6, near=25):
    r = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = r.getrandbits(64)
        for _ in range(near):
            x = c
            for b in r.sample(range(64), r.randint(0, 5)):
                x ^= 1 << b
            out.add(x - (1 << 64) if x >> 63 else x)
    return sorted(out | {r.getrandbits(63) for _ in range(40)})


def test_fingerprints():
    for t in (None, "", "One", "a b c d", "a b c d e f g " * 9, "É Ä ß x Y z", "\x1c a\x0bb\x85c d e"):
        assert simhash.text_fingerprint((t or "").encode()) % (1 << 64) == brute_fingerprint(t)


def test_every_pair_within_reach_meets_at_an_anchor():
    r = random.Random(5)
    for _ in range(300):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), r.randint(0, 4)):
            y ^= 1 << b
        met = [set(simhash.anchors(np.array([v], np.uint64).view(np.int64))[0].tolist()) for v in (x, y)]
        assert met[0] & met[1]


def test_groups_are_linked_whole():
    fps = np.array(cloud(7, 3, 40), np.int64)
    want = components(fps.tolist())
    for a, b in (simhash.forest(fps), simhash.small_groups(fps, np.zeros(len(fps), np.int64))):
        assert len(a) == len(want) - len(set(want.values()))
        label = {int(f): int(f) for f in fps}
        for x, y in zip(a.tolist(), b.tolist()):
            label[x] = y
        same = {}
        for f in want:
            same.setdefault(want[f], set()).add(label[f])
        assert all(len(s) == 1 for s in same.values())
    a, _ = simhash.small_groups(np.repeat(fps, 1), np.arange(len(fps)))
    assert not len(a)  # groups of one have no links


def test_components_match_brute_force(spark):
    fps = cloud(11)
    want = components(fps)
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(4)
    for part_rows in (simhash.PART_ROWS, 5):
        roots = {r["u"]: r["v"] for r in simhash.stars(simhash.links(nodes, part_rows)).collect()}
        assert {f: roots.get(f, f) for f in fps} == want


def test_long_chains_become_stars(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(200)] + [(1000, 5), (7, 7)], "u long, v long")
    assert rows(simhash.stars(edges)) == sorted([(k, 0) for k in range(1, 201)] + [(1000, 0)], key=repr)
    assert simhash.stars(edges.limit(0)).count() == 0


def test_odd_rows_and_columns(spark):
    docs = table(spark)
    got = rows(simhash.near_duplicates(cluttered(docs)))
    assert len(got) == docs.count()
    signed = {f: f - (1 << 64) if f >> 63 else f for f in (brute_fingerprint(r["text"]) for r in docs.collect())}
    root = components(sorted(signed.values()))
    least = {}
    for r in docs.collect():
        c = root[signed[brute_fingerprint(r["text"])]]
        least[c] = min((x for x in (least.get(c), r["doc_id"]) if x is not None), default=None)
    want = [(r["doc_id"], f"{brute_fingerprint(r['text']):016x}", least[root[signed[brute_fingerprint(r["text"])]]]) for r in docs.collect()]
    assert got == sorted(want, key=repr)
    assert simhash.near_duplicates(empty(spark)).count() == 0
