import gc
import struct
import sys
import tracemalloc
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalogue.llm import records, tokens
from catalogue.llm.tokens import WordEncoder, encoder, vocabulary_path

from .helpers import cluttered, empty, table


def whole(text):
    return encoder(vocabulary_path()).tokenizer.encode(text or "", add_special_tokens=False).ids


def ids_of(raw, width=2):
    return [int.from_bytes(raw[k:k + width], "little") for k in range(0, len(raw), width)]


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aA'sS tTé́İß   \x1c\x85\n\x0b#*<|endoftext|>\U0001f600Σ", max_size=60))
def test_words_give_the_ids_of_whole_texts(text):
    assert ids_of(encoder(vocabulary_path()).encode([text.encode()])[0]) == whole(text)


def test_a_full_cache_starts_afresh():
    small = WordEncoder(vocabulary_path(), cache_words=3)
    texts = ["one two three", "four five", "one six", "seven eight nine ten eleven"]
    assert [ids_of(x) for x in small.encode([t.encode() for t in texts])] == [whole(t) for t in texts]


@given(st.lists(st.binary(max_size=40), max_size=6))
def test_frames_round_trip(payloads):
    data, at, out = b"".join(map(records.frame, payloads)), 0, []
    while at < len(data):
        payload, at = records.unframe(data, at)
        out.append(bytes(payload))
    assert out == payloads


def test_damage_is_noticed():
    data = bytearray(records.frame(b"some payload"))
    for k in range(len(data)):
        bad = bytes(data[:k]) + bytes([data[k] ^ 1]) + bytes(data[k + 1:])
        with pytest.raises(ValueError):
            records.unframe(bad)
    with pytest.raises(ValueError):
        records.unframe(bytes(data[:-1]))


def brute(docs, end):
    start, out = 0, []
    for r in sorted(docs, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "")):
        ids = [*whole(r["text"]), end]
        out.append((r["doc_id"], start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_odd_rows_and_columns(spark):
    docs = table(spark)
    got = records.token_records(cluttered(docs).repartition(3)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute(docs.collect(), records.END_ID)
    assert records.token_records(empty(spark)).count() == 0


def test_shards_hold_records_in_order_and_any_can_be_read_alone(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("text"), "id").alias("text")).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = records.write_records(docs).orderBy("shard").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(manifest) > 1
    seen = []
    for m in manifest:
        reader = records.ShardReader(m["path"])
        assert len(reader) == m["records"]
        seen += [reader.record(k)[0] for k in range(len(reader))]
        for k in reversed(range(len(reader))):
            doc_id, ids = reader.record(k)
            assert list(ids) == [*whole(f"text {doc_id}"), records.END_ID]
    assert seen == list(range(200))


WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "né", "pu", "ra") for b in ("x", "yy", "z") for c in map(chr, range(ord("a"), ord("z") + 1))]


def test_no_call_per_word():
    """New words are cut, told apart and looked up by columns: far fewer calls than words."""
    texts, calls = [", ".join(a + b for b in WORDS[:50]).encode() for a in WORDS], 0
    fresh = WordEncoder(vocabulary_path())
    fresh.encode([b"some words"])

    def count(frame, event, what):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        fresh.encode(texts)
    finally:
        sys.setprofile(None)
    assert calls < 50 * len(texts) / 4


def test_kept_words_are_compact():
    texts = [" ".join(a + b for b in WORDS).encode() for a in WORDS]
    fresh = WordEncoder(vocabulary_path())
    gc.collect()
    tracemalloc.start()
    try:
        fresh.encode(texts)
        gc.collect()
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 1 << 22 and fresh.known.nbytes + fresh.ids.nbytes < 40 * len(WORDS) ** 2


def test_long_texts_and_long_words_are_whole(monkeypatch):
    monkeypatch.setattr(tokens, "BYTES_AT_ONCE", 64)
    texts = ["it's one, two 's " * 40, "é" * 70 + " 'LLm <|endoftext|> " * 20, "", "\n", "word" * 50]
    fresh = WordEncoder(vocabulary_path())
    for _ in range(2):
        assert [ids_of(x) for x in fresh.encode([t.encode() for t in texts])] == [whole(t) for t in texts]
