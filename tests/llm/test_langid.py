import random

import numpy as np

from catalogue.llm import langid

from .helpers import cluttered, empty, table


def greedy(text, sample):
    """Number of longest phrases of ``text`` that ``sample`` holds; a byte it lacks is a phrase."""
    n = k = 0
    while k < len(text):
        end = k + 1
        while end < len(text) and text[k:end + 1] in sample:
            end += 1
        n += 1
        k = end
    return n


def test_phrases_are_longest_matches():
    r = random.Random(1)
    for _ in range(60):
        sample = bytes(r.choice(b"abc\0") for _ in range(r.randint(1, 60)))
        texts = sorted((bytes(r.choice(b"abcd") for _ in range(r.randint(0, 40))) for _ in range(5)), key=len, reverse=True)
        lengths = np.array([len(t) for t in texts])
        columns = np.zeros((max(1, lengths.max()), len(texts)), np.uint8)
        for k, t in enumerate(texts):
            columns[:len(t), k] = list(t)
        got = langid.phrases(columns, lengths, langid.automaton(sample))
        assert list(got) == [greedy(t, sample) for t in texts]


WORDS = {"aa": "wato miri keno sapu lori", "bb": "strix brand glump krat frosh", "cc": "éàu oié çèt ùne êra"}


def prose(lang, n, seed):
    r = random.Random(f"{lang}{seed}")
    return " ".join(r.choice(WORDS[lang].split()) + r.choice(["", "", ",", "."]) for _ in range(n))


def test_held_out_texts_and_odd_ones(spark):
    rows = [(k, prose(lang, 40, k), lang, "s", 0) for k, lang in enumerate(["aa", "bb", "cc"] * 30)]
    known = table(spark, [*rows, (900, None, "aa", None, 0), (901, "text", None, None, 0), (902, "123", "zz", None, 0)])
    odd = [(1000, None, None, None, 0), (1001, "", None, None, 0), (1002, "12 34 !?", None, None, 0), (1003, "… — 5", None, None, 0),
           (None, prose("bb", 3000, 1), None, None, 0), (1004, "Ω", None, None, 0)]
    asked = table(spark, [*[(2000 + k, prose(lang, 1 + k % 30, -k - 1), lang, "s", 0) for k, lang in enumerate(["aa", "bb", "cc"] * 30)], *odd])
    got = {r["doc_id"]: r for r in langid.identify(cluttered(asked), known).collect()}
    for k, lang in enumerate(["aa", "bb", "cc"] * 30):
        assert got[2000 + k]["lang_pred"] == lang
    assert got[None]["lang_pred"] == "bb"
    for k in (1000, 1001, 1002, 1003):
        assert (got[k]["lang_pred"], got[k]["score"]) == ("und", 0.0)
    assert got[1004]["lang_pred"] in WORDS
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(empty(spark), known).count() == 0
    assert {r["lang_pred"] for r in langid.identify(asked, empty(spark)).collect()} == {"und"}


def test_the_sample_is_bounded_and_repeats(spark):
    many = table(spark, [(k, prose("aa", 200, k % 5), "aa", None, 0) for k in range(400)])
    first, again = (sorted(tuple(r) for r in langid.sample(d).collect()) for d in (many, many.repartition(4)))
    assert first == again and len(first) == langid.SAMPLE_PIECES
    assert all(len(p) <= langid.SAMPLE_CHARS for _, p in first)
