import re

from catalogue.llm import mixing

from .helpers import cluttered, empty, rows, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(sizes):
    """Targets by handing the excess out again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, target, open_ones = sum(sizes.values()), {}, set(names)
    while open_ones:
        rest = total - sum(target.values())
        over = {s for s in open_ones if rest * weight[s] / sum(weight[x] for x in open_ones) > 3 * sizes[s]}
        if not over:
            target |= {s: rest * weight[s] / sum(weight[x] for x in open_ones) for s in open_ones}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ones -= over
    return target


def docs_of(spark, sizes, per_doc=37):
    data, k = [], 0
    for s, n in sizes.items():
        while n > 0:
            data.append((k, " ".join(f"w{k}x{i}" for i in range(min(n, per_doc))), "en", s, 0))
            n -= per_doc
            k += 1
    return table(spark, data)


def test_targets_and_taken(spark):
    sizes = {"a": 5, "b": 900, "c": 40, "é": 300, "z": 20, None: 700, "\U0001f600": 1}
    got = mixing.mix(docs_of(spark, sizes)).collect()
    want = reshared(sizes)
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by.setdefault(round(r["target"], 6), [0, r["target"]])[0] += r["taken"]
    assert sorted(by) == sorted({round(t, 6) for t in want.values()})
    for s, t in want.items():
        same = [x for x in want.values() if round(x, 6) == round(t, 6)]
        assert abs(by[round(t, 6)][0] - sum(same)) <= len(same)


def test_schedule_keeps_proportions_in_every_stretch(spark):
    docs = docs_of(spark, {f"s{k}": 3000 for k in range(5)}, 50)
    rows_, sources, draws = mixing.schedule(docs)
    target = {r["rank"]: r["target"] for r in sources.collect()}
    rank = {r["row"]: r["rank"] for r in rows_.collect()}
    taken = sorted((r["slot"], rank[r["row"]], r["n_words"]) for r in draws.collect())
    total, seen, done = sum(target.values()), dict.fromkeys(target, 0), 0
    for _, s, n in taken:
        seen[s] += n
        done += n
        if done > 1000:
            for x in target:
                assert abs(seen[x] / done - target[x] / total) < 0.02
    assert done == sum(round(t) for t in target.values())


def test_lattice_visits_every_position_once():
    for need in (1, 2, 7, 1000):
        n, step = mixing.lattice(need)
        assert n >= need and sorted(k * step % n for k in range(n)) == list(range(n))
    big = mixing.block_words(16 * 10**12)
    assert mixing.lattice(16 * 10**12 // big + 1000)[0] <= mixing.MAX_SLOTS


def test_reruns_and_order_of_rows_agree(spark):
    docs = docs_of(spark, {"a": 400, "b": 90, "c": 300})
    assert rows(mixing.mix(docs)) == rows(mixing.mix(docs.repartition(5)))


def test_odd_rows_and_columns(spark):
    docs = cluttered(table(spark))
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["taken"] <= 3 * r["size"]
    assert mixing.mix(empty(spark)).count() == 0
    assert sum(r["taken"] for r in mixing.mix(table(spark, [(1, None, None, None, None)])).collect()) == 0


def test_the_mix_holds_the_words_taken(spark):
    docs = cluttered(docs_of(spark, {"a": 400, "b": 90, None: 300}, 41))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    have = {}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixed.collect():
        assert texts[r["doc_id"]].startswith(r["text"])
        assert r["text"] == texts[r["doc_id"]] or r["n_chars"] == len(r["text"])
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
    assert have == {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect() if r["taken"]}
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_the_lattice_decides_the_slots(spark, monkeypatch):
    docs = docs_of(spark, {"a": 400, "b": 300})
    first = rows(mixing.mix(docs))
    plain = mixing.lattice
    monkeypatch.setattr(mixing, "lattice", lambda slots: (plain(slots)[0], 1))  # slots one after the other
    second = rows(mixing.mix(docs))
    assert first != second and [r[:5] for r in first] == [r[:5] for r in second]
