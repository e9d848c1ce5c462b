import random

import numpy as np

from catalogue.llm import toxicity

from .helpers import cluttered, empty, table

LABELS = "doc_id long, quality int, toxic int"


def text(k, toxic):
    r = random.Random(k)
    words = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 7))) for _ in range(r.randint(20, 90))]
    if toxic:
        for _ in range(3):
            words.insert(r.randrange(len(words)), r.choice(["glumpfy", "Glumpfs", "vraxish"]))
    return " ".join(words)


def test_held_out_documents(spark):
    docs = table(spark, [(k, text(k, k % 3 == 0), None, None, 0) for k in range(500)])
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(400)] + [(None, 1, 1), (3, None, None), (6, 0, 0)], LABELS)
    got = {r["doc_id"]: r for r in toxicity.toxicity(cluttered(docs), labels).collect()}
    right = sum(got[k]["predicted"] == (k % 3 == 0) for k in range(400, 500))
    assert right >= 97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_odd_rows(spark):
    docs = table(spark)
    none = spark.createDataFrame([], LABELS)
    for labels in (none, spark.createDataFrame([(1, 1, 1)], LABELS), spark.createDataFrame([(1, 1, 0)], LABELS),
                   spark.createDataFrame([(1, 1, 0), (6, 1, 1), (6, 1, 1)], LABELS)):
        got = toxicity.toxicity(docs, labels).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert max(r["score"] for r in toxicity.toxicity(docs, none).collect()) < 0.01
    assert toxicity.toxicity(empty(spark), none).count() == 0


def test_grams_are_distinct_whatever_the_piece_size(monkeypatch):
    data = text(1, True) * 40
    whole = np.sort(toxicity.Grams().of(data))
    assert len(set(whole.tolist())) == len(whole)
    monkeypatch.setattr(toxicity, "PIECE_BYTES", 100)
    assert (np.sort(toxicity.Grams().of(data)) == whole).all()
    assert not len(toxicity.Grams().of(""))
