import base64
import random
import re
from collections import Counter

from catalogue.llm import bands

from .helpers import cluttered, empty, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    times = Counter(windows)
    inside = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    lines, repeats = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            repeats += x in lines
            lines.add(x)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(inside), failed


def prose(n, seed=0):
    r = random.Random(seed)
    words = ["".join(r.choice("etaoinshrdlucmfwypvbgk") for _ in range(r.randint(2, 9))) for _ in range(400)]
    return " ".join(r.choice(words) for _ in range(n))


def noise(n):
    raw = base64.b64encode(random.Random(3).randbytes(n)).decode()
    return " ".join(raw[k:k + 9] for k in range(0, len(raw), 9))


def test_counts_and_columns(spark):
    texts = [None, "", "one two", prose(50), "a b c d e f g h " * 2 + prose(30), "x\ny\nx\n \n \nx", "é ß\x1c\x85x # $ <|>", "a b " * 30,
             "\U0001f600 " * 25, "p q r s t u v w x\tp q r s t u v w  y " + prose(100)]
    docs = table(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    got = {r["doc_id"]: r for r in bands.quality(cluttered(docs)).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(t)
        assert not (r["base_failed"] and r["kept"])
    assert bands.quality(empty(spark)).count() == 0


def test_bands_reject_repetition_and_noise_and_keep_prose(spark):
    near_repeats = " ".join(f"part {k} of the same old sentence" for k in range(400))
    mixed = prose(500) + " " + noise(9000)
    texts = [*(prose(n, n) for n in (25, 60, 200, 800, 3000, 20000)), near_repeats, noise(4000), mixed]
    docs = table(spark, [(k, t, None, None, None) for k, t in enumerate(texts)])
    got = [r["kept"] for r in bands.quality(docs).orderBy("doc_id").collect()]
    assert got == [True] * 6 + [False] * 3
    kept = bands.drop_rejected(cluttered(docs))
    assert kept.columns == cluttered(docs).columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(6))
    assert bands.drop_rejected(empty(spark)).count() == 0


def in_letters(text, first):
    """The text with its letters mapped one to one to those from ``first`` on."""
    return text.translate({ord(c): chr(first + k) for k, c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")})


def test_long_technical_texts_are_kept_in_any_script():
    import zstandard
    from pydoc_data.topics import topics

    compressor = zstandard.ZstdCompressor(level=bands.LEVEL)
    manual = "\n".join(topics[k] for k in sorted(topics))
    for n in (300, 1200, 2400, 5000, 9000, 17000, 34000, 66000, 120000):
        for text in (manual[:n], in_letters(manual[:n], 0x430), in_letters(manual[:n], 0x905)):
            assert bands.measure(text.encode(), compressor)[6]
    repeats = " ".join(f"part {k} of the same old sentence" for k in range(400))
    for text in (repeats, in_letters(repeats, 0x430), in_letters(repeats, 0x905)):
        assert not bands.in_band(text.encode(), compressor)[1]


def test_limits_rise_without_steps():
    limits = [bands.greatest(n, n) for n in range(1, 100_000)]
    assert all(0 <= b - a < 0.01 for a, b in zip(limits, limits[1:])) and bands.greatest(34_000, 34_000) > 4.03
    assert all(bands.greatest(n, n) >= bands.band(n)[1] for n in range(1, 100_000, 7))
