"""The registered queries on the smallest tables: against their SQL, or against brute force."""

import html
import re
import zlib

import duckdb
import pytest

import corpus_pipeline
from catalogue.llm import bands, mixing, packing
from catalogue.llm.queries import ORACLES, QUERIES
from catalogue.plans.bindings import TABLES

from .test_bands import brute as brute_counts
from .test_blocks import SPACE
from .test_nearcopies import greedy
from .test_packing import check as check_pieces
from .test_records import brute as brute_records
from .test_simhash import brute_fingerprint, components


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return [dict(zip(("doc_id", "text", "source"), r)) for r in duck.sql("select doc_id, text, source from documents").fetchall()]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert sorted(repr(tuple(r[c] for c in want.columns)) for r in df.collect()) == sorted(map(repr, want.fetchall()))


def test_every_operator_has_a_query():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


def test_op1(spark, sf, documents):
    got = sorted((tuple(r) for r in QUERIES["op1_token_records"](spark, sf).collect()), key=lambda r: r[1])
    assert got == brute_records(documents, 2)


def test_op5_and_op9(spark, sf, duck, documents):
    lang = dict(duck.sql("select doc_id, lang from documents").fetchall())
    got = QUERIES["op5_cross_parsing"](spark, sf).collect()
    assert len(got) == len(documents) and all(r["held_out"] == held_out(r["doc_id"]) for r in got)
    asked = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in asked) >= 0.95 * len(asked)
    scored = QUERIES["op9_ngram_toxicity"](spark, sf).collect()
    assert len(scored) == len(documents) and all(r["held_out"] == held_out(r["doc_id"]) for r in scored)


def test_op6(spark, sf, documents):
    texts = {d["doc_id"]: d["text"] for d in documents}
    for r in QUERIES["op6_compression_bands"](spark, sf).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_counts(texts[r["doc_id"]])


def test_op7(spark, sf, documents):
    check_pieces(QUERIES["op7_mixture_packing"](spark, sf).collect(), documents, packing.SEQUENCE)


def near_groups(documents):
    fps = {d["doc_id"]: brute_fingerprint(d["text"]) for d in documents}
    root = components(sorted(set(fps.values())))
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(i, least.get(root[f], i))
    return {i: (f"{f:016x}", least[root[f]]) for i, f in fps.items()}


def test_op8(spark, sf, documents):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op8_anchor_simhash"](spark, sf).collect()}
    assert got == near_groups(documents)


BLOCK = re.compile(r"</?(?:p|h[1-6]|li|ul|ol|blockquote|pre|table|tr|td|th|div|section|br)\b[^>]*>", re.I)


def article(page):
    """The blocks of the article by pattern: what its own tags enclose, without embedded notices."""
    inner = "".join(re.findall(r"(?is)<article\b[^>]*>(.*?)</article>", page or ""))
    inner = re.sub(r"(?is)<!--.*?-->|<(script|style|aside|form|nav|figure)\b.*?</\1>|<div class=\"[^\"]*\bad\b[^\"]*\">.*?</div>", "", inner)
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in BLOCK.split(inner))
    return "\n".join(b for b in blocks if b)


def test_op3_keeps_the_article_and_nothing_else(spark, sf, duck):
    pages = dict(duck.sql("select page_id, html from pages").fetchall())
    got = QUERIES["op3_minimum_cut"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"]) > 0


def verdict(text):
    """Kept or not by the bands, computed anew: ratios of the whole text and of its chunks within limits by length and width."""
    import math

    import zstandard

    raw = (text or "").encode()

    def fits(part):
        if not part:
            return True
        ratio = len(part) / len(zstandard.ZstdCompressor(level=bands.LEVEL).compress(part))
        letters = sum(not 0x80 <= c < 0xC0 for c in part)
        row = lambda n: max(k for k, b in enumerate(bands.BANDS) if b[0] <= n)
        low, k = bands.BANDS[row(len(part))][1], row(letters)
        high = bands.BANDS[k][2]
        if 0 < k < len(bands.BANDS) - 1:
            after = bands.BANDS[k + 1]
            high += (after[2] - high) * math.log(letters / bands.BANDS[k][0], 2) / math.log(after[0] / bands.BANDS[k][0], 2)
        return low <= ratio <= high * (len(part) / max(letters, 1)) ** bands.WIDTH

    chunks = [raw[k:k + bands.CHUNK_BYTES] for k in range(0, len(raw), bands.CHUNK_BYTES)] if len(raw) > bands.CHUNK_BYTES else []
    bad = sum(len(c) for c in chunks if not fits(c))
    return not brute_counts(text)[5] and fits(raw) and bad <= bands.BAD_CHUNK_SHARE * len(raw)


def test_op6_keeps_what_is_in_the_bands(spark, sf, documents):
    texts = {d["doc_id"]: d["text"] for d in documents}
    got = {r["doc_id"]: r["kept"] for r in QUERIES["op6_compression_bands"](spark, sf).collect()}
    assert got == {i: verdict(t) for i, t in texts.items()} and 0 < sum(got.values()) < len(got)


def test_pipeline_by_brute_force(spark, sf, documents):
    import zstandard

    compressor = zstandard.ZstdCompressor(level=bands.LEVEL)
    kept = [d for d in documents if bands.measure((d["text"] or "").encode(), compressor)[6]]
    first = {}
    for d in sorted(kept, key=lambda d: d["doc_id"]):
        first.setdefault(SPACE.sub(" ", d["text"]), d)
    single = list(first.values())
    stay = greedy(single)
    left = [d for d in single if d["doc_id"] in stay]
    docs = spark.createDataFrame([(d["doc_id"], d["text"], d["source"]) for d in left], "doc_id long, text string, source string")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    text = {d["doc_id"]: d["text"] for d in left}
    mixed = []
    for i, n in taken.items():
        words = list(re.finditer(r"[^\x20\x09-\x0D]+", text[i]))
        while n > 0:
            mixed.append({"doc_id": i, "text": text[i] if n >= len(words) else text[i][:words[n - 1].end()]})
            n -= len(words)
    pieces = corpus_pipeline.run(spark, sf).collect()
    check_pieces(pieces, mixed, packing.SEQUENCE)


def test_stages_keep_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]
