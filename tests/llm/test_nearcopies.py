import random

import corpus_pipeline
from pyspark.sql import functions as F

from catalogue.llm import nearcopies, simhash

from .helpers import cluttered, empty, table


def brute_sets(rows):
    out = []
    for r in rows:
        words = (r["text"] or "").encode().lower().split()
        out.append({tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    return out


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def greedy(rows):
    """doc_ids that stay: in order of doc_id, each without a near copy among those that stay before it."""
    stay = []
    for r, s in sorted(zip(rows, brute_sets(rows)), key=lambda x: x[0]["doc_id"]):
        if not any(similar(s, t) for _, t in stay):
            stay.append((r["doc_id"], s))
    return {i for i, _ in stay}


def corpus(seed):
    """Texts with copies of 1 to 9 replaced words on both sides of the limit, chains of copies of copies, a large group."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    texts = []

    def copy(text, n):
        out = text.split()
        for k in r.sample(range(len(out)), n):
            out[k] = r.choice(words)
        return " ".join(out)

    for _ in range(12):
        text = " ".join(r.choice(words) for _ in range(230))
        texts += [text, *(copy(text, n) for n in range(1, 10))]
    for _ in range(6):
        for _ in range(8):
            texts.append(copy(texts[-1], 3))
    hub = " ".join(r.choice(words) for _ in range(150))
    texts += [copy(hub, 1) for _ in range(60)]
    ids = r.sample(range(10_000), len(texts))
    return [(i, t, "en", "a", 0) for i, t in zip(ids, texts)]


def test_stage_drops_near_copies_and_nothing_else(spark):
    docs = table(spark, corpus(3)).repartition(5)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == greedy(docs.collect())


def test_two_replaced_words_of_230(spark):
    text = [f"w{k * k % 2003}" for k in range(230)]
    other = [*text[:50], "x", *text[51:180], "y", *text[181:]]
    docs = table(spark, [(2, " ".join(text), "en", "a", 0), (1, " ".join(other), "en", "a", 0), (3, " ".join(text[::-1]), "en", "a", 0)])
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3]


def test_odd_rows_and_columns(spark):
    docs = cluttered(table(spark))
    kept = nearcopies.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 6, 8, 10, None}
    assert nearcopies.drop_near_copies(empty(spark)).count() == 0


def family(n, seed=5, shared=240, own=40):
    """Texts of one template with words of their own: similar, but none near another."""
    r = random.Random(seed)
    template = [f"t{k}" for k in range(shared)]
    return [(k, " ".join(template + [f"o{k}x{j}" for j in range(own)]), "en", "a", 0) for k in r.sample(range(100_000), n)]


def test_a_template_family_gives_no_pairs_of_all(spark):
    """Pairs of 0.75 similarity share most bands; none of them has to be compared."""
    got = {}
    for n in (100, 200, 400):
        docs = table(spark, family(n))
        members, sets = nearcopies.banded_members(docs)
        assert sets.count() == n
        got[n] = nearcopies.left_pairs(members, sets).count()
        assert nearcopies.left_pairs(members, sets, small=2).count() <= n
    # chance bands stay small and give a bounded number of pairs a text, whatever the size of the family
    assert got[400] <= 4 * max(got[100], got[200] / 2) and got[400] < 400 * 399 / 2 / 8
    kept = nearcopies.drop_near_copies(table(spark, family(100)))
    assert kept.count() == 100


def test_prefixes_lose_no_near_pair(spark):
    """Families whose members are on both sides of the limit, compared by prefixes alone."""
    rows = corpus(9)
    docs = table(spark, rows + family(40))
    _, sets = nearcopies.banded_members(docs)
    sets = sets.cache()
    pairs = {(r["u"], r["v"]) for r in nearcopies.prefix_pairs(sets.select("node"), sets).collect()}
    known = {r["node"]: set(r["shingles"]) for r in sets.collect()}
    nodes = sorted(known)
    near = {(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1:] if similar(known[a], known[b])}
    assert near and near <= {tuple(sorted(p)) for p in pairs}
    assert {tuple(sorted((r["u"], r["v"]))) for r in nearcopies.near(spark.createDataFrame(sorted(pairs), "u long, v long"), sets).collect()} == near


def test_operator_8_gives_candidates(spark):
    """Each component of operator 8 is a band of its own beside those by minima; the exact check decides."""
    text = [f"w{k * k % 4001}" for k in range(1200)]
    texts = [text, [*text[:600], "x", *text[601:]], [f"v{k}" for k in range(300)]]
    docs = table(spark, [(k + 1, " ".join(t), "en", "a", 0) for k, t in enumerate(texts)])
    linked = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert linked == {1: 1, 2: 1, 3: 3}
    members, _ = nearcopies.banded_members(docs)
    band = members.select(F.xxhash64(F.lit("component"), F.lit(1).cast("long")).alias("b")).first()["b"]
    assert {r["first"] for r in members.where(F.col("band") == band).collect()} == {1, 2}
    assert sorted(r["doc_id"] for r in nearcopies.drop_near_copies(docs).collect()) == [1, 3]


def test_no_links_start_no_python_workers(spark):
    links = spark.range(4).selectExpr("id AS u", "id + 1 AS v")
    for some in (links, links.where("u > v")):
        assert "ExistingRDD" not in nearcopies._kept_first(some)._jdf.queryExecution().toString()
    assert [r["v"] for r in nearcopies._kept_first(links.where("u = 1")).collect()] == [2]
    assert nearcopies._kept_first(links.where("u > v")).count() == 0
    assert "ExistingRDD" in spark.createDataFrame([], "v long")._jdf.queryExecution().toString()
