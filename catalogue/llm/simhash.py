"""Near duplicates by SimHash with anchor-point covering.

A 64-bit fingerprint is read as three segments. Two fingerprints that differ in at most 4 bits differ in at most one
bit of some segment. In each segment the anchors are the words of a covering code: a Hamming code of 15 bits, which has
a word within one bit of everything, beside the segment's other bits taken as they are. A fingerprint is replicated to
every anchor within covering radius plus threshold, 1 + 1 bits. The anchor nearest to one fingerprint of a pair is at
most that far from the other, so every pair meets at an anchor, where whole fingerprints are compared.

What an anchor finds is handed on as a forest of links, and an anchor with many fingerprints is split into pairs of
parts, so neither rows nor tasks grow with the square of a group. Linked groups are joined over all anchors by
alternating star contraction.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate, combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle
from .workers import map_batches

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # (first bit, bits)
CODE_BITS = 15
RADIUS = 1
#: fingerprints of one anchor that are compared in one place
PART_ROWS = 16_384
#: groups up to this size are compared side by side, larger ones one by one
SMALL_GROUP = 64
HASHES_AT_ONCE = 1 << 16


def text_fingerprint(text: bytes) -> int:
    """SimHash of the word shingles of a UTF-8 text, as a signed 64-bit number; 0 if it has no word."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # of bytes: letters A-Z, and white space as in [\x20\x09-\x0D]
    if not words:
        return 0
    joined = b" ".join(words)
    at = list(accumulate(map(len, words), lambda a, b: a + b + 1, initial=0))  # begin of each word, and the end plus 1
    digest = xxhash.xxh64_intdigest
    shingles = [(0, at[-1])] if len(words) <= SHINGLE_WORDS else list(zip(at, at[SHINGLE_WORDS:]))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(shingles), HASHES_AT_ONCE):
        hashes = np.array([digest(joined[a:b - 1], SEED) for a, b in shingles[k:k + HASHES_AT_ONCE]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<i8")[0])


def _fingerprints(batches):
    import pyarrow as pa

    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([text_fingerprint(t or b"") for t in texts], pa.int64())],
                                         names=["doc_id", "fp"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp) of every document."""
    return map_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), 
        _fingerprints, "doc_id long, fp long")


@lru_cache(maxsize=1)
def _code():
    """Syndrome of every value of the code bits, and per segment width and syndrome the patterns that lead to anchors."""
    import numpy as np

    values = np.arange(1 << CODE_BITS)
    syndrome = np.zeros(1 << CODE_BITS, np.int64)
    for i in range(CODE_BITS):
        syndrome ^= np.where(values >> i & 1, i + 1, 0)
    near: dict[int, list] = {}
    for width in {w for _, w in SEGMENTS}:
        lists: list[list[int]] = [[] for _ in range(CODE_BITS + 1)]
        for n in range(RADIUS + MAX_BITS // len(SEGMENTS) + 1):
            for bits in combinations(range(width), n):
                pattern = sum(1 << b for b in bits)
                lists[syndrome[pattern & ((1 << CODE_BITS) - 1)]].append(pattern)
        near[width] = [np.array(x, np.int64) for x in lists]
    return syndrome, near


def anchors(fps):
    """(anchor key, fingerprint) arrays: every anchor of every fingerprint."""
    import numpy as np

    syndrome, near = _code()
    keys, values = [], []
    for segment, (first, width) in enumerate(SEGMENTS):
        part = fps.view(np.uint64) >> np.uint64(first) & np.uint64((1 << width) - 1)
        part = part.astype(np.int64)
        of = syndrome[part & ((1 << CODE_BITS) - 1)]
        for s, patterns in enumerate(near[width]):
            at = np.flatnonzero(of == s)
            keys.append((part[at][:, None] ^ patterns | segment << 32).ravel())
            values.append(np.repeat(fps[at], len(patterns)))
    return np.concatenate(keys), np.concatenate(values)


def _anchored(batches):
    import pyarrow as pa

    for batch in batches:
        for k in range(0, batch.num_rows, 4096):
            key, fp = anchors(batch.column("fp").slice(k, 4096).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["anchor", "fp"])


def _linked(a, b):
    import numpy as np

    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= MAX_BITS


def forest(fps):
    """Links of one group as (fingerprint, first of its part) pairs; any number of fingerprints, each once."""
    import numpy as np

    rest, left, right = fps, [], []
    while len(rest):
        first, rest = rest[:1], rest[1:]
        open_ones = [first]
        while open_ones and len(rest):
            near = _linked(rest, open_ones.pop())
            if near.any():
                found, rest = rest[near], rest[~near]
                left.append(found)
                right.append(np.repeat(first, len(found)))
                open_ones.extend(found[k:k + 1] for k in range(len(found)))
    return (np.concatenate(left), np.concatenate(right)) if left else (fps[:0], fps[:0])


def small_groups(fps, group):
    """The same for many small groups at once: neighbours at every distance inside a group are compared side by side."""
    import numpy as np

    n = len(fps)
    label = np.arange(n)
    left, right = [], []
    at = np.arange(n)
    for lag in range(1, n):
        at = at[at + lag < n]
        at = at[group[at] == group[at + lag]]
        if not len(at):
            break
        hit = at[_linked(fps[at], fps[at + lag])]
        left.append(hit)
        right.append(hit + lag)
    if not left:
        return fps[:0], fps[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _compared(batches):
    """A mapInArrow function over (anchor, a, b, fp) sorted so that groups are together: links as (fp, other)."""
    import numpy as np
    import pyarrow as pa

    def links(columns):
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)) + 1
        sizes = np.diff(np.concatenate(([0], cuts, [len(columns[3])])))
        group = np.repeat(np.arange(len(sizes)), sizes)
        fps, large = columns[3], np.repeat(sizes > SMALL_GROUP, sizes)
        yield small_groups(fps[~large], group[~large])
        ends = np.cumsum(sizes)
        for g in np.flatnonzero(sizes > SMALL_GROUP):
            yield forest(fps[ends[g] - sizes[g]:ends[g]])

    def emit(columns):
        for a, b in links(columns):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])

    held: list | None = None
    for batch in batches:
        new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "a", "b", "fp")]
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        same = np.all([c == c[-1:] for c in held[:3]], axis=0)
        end = len(same) - (len(same) if same.all() else int(np.argmin(same[::-1])))
        if end:  # all but the last group are complete
            yield from emit([c[:end] for c in held])
            held = [c[end:] for c in held]
    if held is not None and len(held[3]):
        yield from emit(held)


def links(distinct: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(u, v): links that connect exactly the fingerprints of ``distinct`` within MAX_BITS of each other, directly or not."""
    anchored = map_batches(distinct.select("fp"), _anchored, "anchor long, fp long")
    crowded = settle(anchored.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > part_rows)
                     .select("anchor", F.ceil(F.col("n") / part_rows).cast("long").alias("parts")), "crowded")
    zero = F.lit(0).cast("long")
    if crowded.isEmpty():
        dealt = anchored.select("anchor", zero.alias("a"), zero.alias("b"), "fp")
    else:
        own = anchored.join(crowded, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
        own = own.withColumn("own", F.pmod(F.xxhash64("fp"), "parts")).withColumn(
            "other", F.explode(F.sequence(zero, F.col("parts") - 1)))
        dealt = own.select("anchor", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")
    dealt = dealt.repartition("anchor", "a", "b").sortWithinPartitions("anchor", "a", "b", "fp")
    return map_batches(dealt, _compared, "u long, v long").distinct()


def _least(edges: DataFrame) -> DataFrame:
    return settle(edges.groupBy("u").agg(F.min("v").alias("low")), "least")


def stars(edges: DataFrame) -> DataFrame:
    """(u, v) with v the least fingerprint of u's connected component; rows only for u other than v.

    Every round points each node's larger neighbours, then its smaller ones, at the smallest; minima are combined
    before they are shuffled and written, so that the joins are plain ones that Spark splits at a node with many links.
    """
    edges = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 998_244_353)).first()
        if now == mark or not now[0]:
            return edges
        mark = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
        large = settle(large.distinct(), "large")
        small = large.join(_least(large), "u")
        small = small.select(F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
        edges = settle(small.select("e.u", "e.v").where("u <> v").distinct(), "small")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links).

    A null text, or one without a word, has fingerprint zero and is linked like any other. Rows that repeat a doc_id
    keep a row each; a null doc_id never names a component unless it has no other. An empty table gives no rows;
    further columns are ignored.
    """
    rows = settle(fingerprints(documents), "fingerprints")
    nodes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = stars(links(nodes)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = settle(nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    groups = settle(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    named = settle(rooted.join(groups, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
