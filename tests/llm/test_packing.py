import struct
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from catalogue.llm import packing
from catalogue.llm.tokens import encoder, vocabulary_path

from .helpers import cluttered, empty, table


def ids_of(text):
    return [*encoder(vocabulary_path()).tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check(pieces, docs, sequence):
    """Every id in exactly one piece, pieces gapless in their sequences, only the last sequence padded."""
    texts = defaultdict(list)
    for r in docs:
        texts[r["doc_id"]].append(ids_of(r["text"]))
    covered, filled = defaultdict(lambda: defaultdict(int)), defaultdict(list)
    for p in pieces:
        fits = [t for t in texts[p["doc_id"]] if len(t) == p["doc_tokens"]
                and zlib.crc32(struct.pack(f"<{p['length']}I", *t[p["start"]:p["start"] + p["length"]])) == p["ids_crc32"]]
        assert fits and p["length"] > 0
        for k in range(p["start"], p["start"] + p["length"]):
            covered[p["doc_id"], p["doc_tokens"]][k] += 1
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc_id, all_ids in texts.items():
        for n in {len(t) for t in all_ids}:
            assert covered[doc_id, n] == dict.fromkeys(range(n), sum(len(t) == n for t in all_ids))
    for s, parts in filled.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == sequence or s == max(filled) and end < sequence
    assert sorted(filled) == list(range(len(filled)))


def test_odd_rows_and_columns(spark):
    docs = table(spark)
    check(packing.pack(cluttered(docs), sequence=256, run=32).collect(), docs.collect(), 256)
    assert packing.pack(empty(spark)).count() == 0


def test_every_stretch_holds_the_proportions(spark):
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("word"), (F.col("id") % 7 * 40 + 3).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 5 == 0, "mid").otherwise(F.concat(F.lit("s"), F.col("id") % 2)).alias("source"))
    pieces = sorted(packing.pack(docs, sequence=512, run=64).collect(), key=lambda p: (p["sequence_id"], p["offset"]))
    check(pieces, docs.collect(), 512)
    total, seen, done = defaultdict(int), defaultdict(int), 0
    for p in pieces:
        total[p["source"]] += p["length"]
    everything = sum(total.values())
    for p in pieces:
        seen[p["source"]] += p["length"]
        done += p["length"]
        for s in total:  # never off by more than a window and a chunk
            assert abs(seen[s] - done * total[s] / everything) <= 512 + 64


def test_plan_does_not_depend_on_partitions(spark):
    docs = table(spark, [(k, "some words " * (k % 9), "en", f"s{k % 4}", 0) for k in range(80)])
    names = ["doc_id", "start", "length", "sequence_id", "offset"]
    first, second = (sorted(tuple(r[n] for n in names) for r in packing.pack(d, 128, 32).collect()) for d in (docs, docs.repartition(5)))
    assert first == second


def test_every_window_holds_the_shares(spark):
    """20 sources of a few percent each and one of less than a token a window."""
    docs = [(k, f"s{k % 20:02}", 0, k, 50 + k * 7919 % 900) for k in range(1500)] + [(9000, "tiny", 0, 9000, 100)]
    index = spark.createDataFrame(docs, packing.INDEX).repartition(4)
    total, windows, covered = defaultdict(int), defaultdict(lambda: defaultdict(int)), defaultdict(list)
    for _, s, _, _, n in docs:
        total[s] += n
    for p in packing.plan(index).collect():
        windows[p["sequence_id"]][p["source"]] += p["length"]
        covered[p["doc_id"]].append((p["start"], p["length"]))
    for doc_id, *_, n in docs:
        at = 0
        for start, length in sorted(covered[doc_id]):
            assert start == at and length > 0
            at += length
        assert at == n
    everything = sum(total.values())
    largest = max(total, key=total.get)
    assert total["tiny"] * packing.SEQUENCE < everything
    for w in range(len(windows) - 1):
        assert sum(windows[w].values()) == packing.SEQUENCE
        for s in total:  # the one small source comes in runs, and so moves the others by as much
            assert abs(windows[w][s] - packing.SEQUENCE * total[s] / everything) < packing.RUN + (len(total) if s == largest else 1.001)


def test_many_small_sources_come_in_runs(spark):
    """Half of the tokens in one source, the rest in 20 to 1,200 equal ones: few pieces, and windows that hold the mixture."""
    for n in (20, 200, 1200):
        each, size = 600_000 // n, 500
        docs = [(0, "large", 0, k, 600) for k in range(1000)]
        docs += [(0, f"s{s:05}", 1 + s, k, size) for s in range(n) for k in range(each // size)]
        docs = [(i, s, shard, record, tokens) for i, (_, s, shard, record, tokens) in enumerate(docs)]
        index = spark.createDataFrame(docs, packing.INDEX).repartition(4)
        pieces = packing.plan(index).collect()
        total, covered, windows = defaultdict(int), defaultdict(list), defaultdict(lambda: defaultdict(int))
        for _, s, *_, tokens in docs:
            total[s] += tokens
        for p in pieces:
            covered[p["doc_id"]].append((p["start"], p["length"]))
            windows[p["sequence_id"]][p["source"]] += p["length"]
        assert all(sum(x for _, x in covered[i]) == tokens for i, *_, tokens in docs)
        everything = sum(total.values())
        assert len(pieces) <= everything / packing.RUN + len(docs) + 2 * len(windows)
        share = packing.SEQUENCE * total["large"] / everything
        off = {k: abs(w["large"] - share) for k, w in windows.items() if k < len(windows) - 1}
        assert sum(off.values()) / len(off) < packing.RUN
        ends = len(windows) - 2 - packing.RUN / (packing.SEQUENCE * total["s00000"] / everything)
        assert max(x for k, x in off.items() if k < ends) <= 4 * packing.RUN
        for k, w in windows.items():
            if k < len(windows) - 1:
                want = packing.SEQUENCE * total["s00000"] / everything
                assert all(x <= want + 2 * packing.RUN for s, x in w.items() if s != "large")


def test_workers_that_read_pieces_keep_no_encoder(spark, monkeypatch):
    kept, through = [], packing.map_batches
    monkeypatch.setattr(packing, "map_batches", lambda *args, keeps=None: kept.append(keeps) or through(*args, keeps=keeps))
    assert packing.pack(table(spark)).count() > 0
    assert kept == ["encoder", None]
