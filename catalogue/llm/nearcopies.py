"""Near copies by exact similarity: word shingles, MinHash bands for the candidates, the full sets for the verdict.

Two texts are near copies if their sets of 5-word shingles have a Jaccard similarity of 0.8 or more. Candidates share one
of 48 bands of 6 minima; a pair at exactly 0.8 shares none with probability (1 - 0.8^6)^48, below one in a million. A
component of operator 8 (fingerprints linked at 4 or fewer differing bits) is one more band. Every candidate is decided on
its whole sets. A text goes only if a near copy of it with a smaller doc_id stays, so no two near
copies stay and nothing goes without one that does.

Texts are first compared with the first of each band, which settles a group with many copies in rows that grow with the
group and not with its square. What is left of a small band is compared pair by pair. What is left of a large one, such as the
pages of one template that are alike but not alike enough, goes by prefixes instead: two sets of given sizes that are near share
one of their rarest shingles, a share of 11 to 20 percent, so texts that have nothing in common but the template never meet.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle
from . import simhash
from .workers import map_batches

SHINGLE_WORDS = 5
SEED = 42
#: a pair is near if common * (LEAST[0] + LEAST[1]) >= LEAST[0] * (size + size), that is common / union >= 4 / 5
LEAST = (4, 5)
BANDS, BAND_ROWS = 48, 6
#: rounds against the first of each band before the pairs of what is left
ROUNDS = 2
#: bands up to this size are compared pair by pair
SMALL_BAND = 24
#: sizes within this ratio are one class; near sets are at most CLASSES classes apart
CLASS_RATIO, CLASSES = 1.05, 5
#: pairs with one set that are compared in one place
RUN_PAIRS = 4096
#: shingles that are hashed for all minima at once
AT_ONCE = 2048

SKETCH = "doc_id long, digest binary, size long, bands array<long>"
SETS = "digest binary, shingles array<long>"


def shingles(text: bytes):
    """Sorted distinct hashes of the word shingles of a UTF-8 text; a text of fewer words is one shingle."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # of bytes: letters A-Z, and white space as in [\x20\x09-\x0D]
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    at = list(accumulate(map(len, words), lambda a, b: a + b + 1, initial=0))
    digest = xxhash.xxh64_intdigest
    cuts = [(0, at[-1])] if len(words) <= SHINGLE_WORDS else zip(at, at[SHINGLE_WORDS:])
    return np.unique(np.fromiter((digest(joined[a:b - 1], SEED) for a, b in cuts), np.uint64))


@lru_cache(maxsize=1)
def _factors():
    """An odd factor for each minimum: a permutation of the 32-bit numbers."""
    import numpy as np

    return np.random.default_rng(SEED).integers(0, 1 << 32, (BANDS * BAND_ROWS, 1), np.uint32) | np.uint32(1)


def bands(hashes) -> list[int]:
    """The band keys of a set of hashes; none for an empty set."""
    import numpy as np
    import xxhash

    if not len(hashes):
        return []
    short, least = (hashes >> np.uint64(32)).astype(np.uint32), None
    for k in range(0, len(short), AT_ONCE):
        part = (short[k:k + AT_ONCE] * _factors()).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    rows = least.reshape(BANDS, BAND_ROWS)
    keys = np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], np.uint64)
    return keys.view(np.int64).tolist()


def _sets(batches):
    """For every text of the batches, some at a time: the batch's part, the digests and the sets."""
    import pyarrow as pa
    import xxhash

    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            sets = [shingles(t or b"") for t in part.column("text").cast(pa.binary()).to_pylist()]
            yield part, pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), sets


def _sketched(batches):
    import pyarrow as pa

    for part, digests, sets in _sets(batches):
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), digests, pa.array(map(len, sets), pa.int64()),
                                          pa.array(map(bands, sets), pa.list_(pa.int64()))], names=["doc_id", "digest", "size", "bands"])


def _whole(batches):
    import pyarrow as pa

    for _, digests, sets in _sets(batches):
        yield pa.RecordBatch.from_arrays([digests, pa.array([s.view("int64") for s in sets], pa.list_(pa.int64()))], names=["digest", "shingles"])


def _before(a: str, b: str):
    """Whether text a stays rather than b: the smaller doc_id, null last, then the smaller node."""
    rank = [F.struct(F.col(f"{x}.first").isNull().alias("no"), F.col(f"{x}.first").alias("first"), F.col(f"{x}.node").alias("node")) for x in (a, b)]
    return rank[0] < rank[1]


def _matched(batches):
    """A mapInArrow function over (u, salt, v, shingles) sorted by u and salt, u's own set first (v null): the near (u, v)."""
    import numpy as np
    import pyarrow as pa

    own = None
    for batch in batches:
        found_u, found_v = [], []
        sets = batch.column("shingles")
        # sorted as the unsigned numbers that they are
        values, cuts = sets.values.to_numpy(zero_copy_only=False).view(np.uint64), sets.offsets.to_numpy()
        for k, (u, v) in enumerate(zip(batch.column("u").to_pylist(), batch.column("v").to_pylist())):
            other = values[cuts[k]:cuts[k + 1]]
            if v is None:
                own = other.copy()
                continue
            short, long_ = (own, other) if len(own) < len(other) else (other, own)
            at = np.searchsorted(long_, short)
            at[at == len(long_)] = 0
            common = int((long_[at] == short).sum()) if len(long_) else 0
            if common * sum(LEAST) >= (len(own) + len(other)) * LEAST[0]:
                found_u.append(u)
                found_v.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(found_u, pa.int64()), pa.array(found_v, pa.int64())], names=["u", "v"])


def near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (u, v) pairs of nodes whose sets are similar enough.

    The set of v travels with its pair, that of u once per ``RUN_PAIRS`` of its pairs; both are sorted and compared as arrays.
    """
    counts = pairs.groupBy("u").agg(F.count("*").alias("n"))
    runs = counts.select("u", F.ceil(F.col("n") / RUN_PAIRS).cast("long").alias("runs"))
    own = sets.join(runs, F.col("node") == F.col("u")).select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)).alias("salt"),
                                                              F.lit(None).cast("long").alias("v"), "shingles")
    others = pairs.join(runs.where("runs > 1"), "u", "left").join(sets.select(F.col("node").alias("v"), "shingles"), "v")
    salt = F.pmod(F.xxhash64("v"), F.coalesce("runs", F.lit(1).cast("long")))
    rows = own.unionByName(others.select("u", salt.alias("salt"), "v", "shingles"))
    rows = rows.repartition("u", "salt").sortWithinPartitions("u", "salt", F.col("v").asc_nulls_first())
    return map_batches(rows, _matched, "u long, v long")


def _prefixes(shingles: DataFrame) -> DataFrame:
    """(node, size, first, shingle, low, apart, side): what each set is looked up by, per class of sizes of its partners.

    Shingles stand from the rarest to the most frequent among these sets. A partner of at least m shingles that is near shares
    t = 4 / 9 * (size + m) of them, so it has one of the first size - t + 1. ``side`` is 0 for the smaller set of a pair of classes.
    """
    often = shingles.groupBy("shingle").agg(F.count("*").alias("n"))
    ranked = shingles.join(often, "shingle").groupBy("node", "size", "first").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("ranked"))
    own = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(CLASS_RATIO))).cast("int")
    ranked = ranked.withColumn("class", own)

    def rows(side: int) -> DataFrame:
        apart = F.explode(F.sequence(F.lit(0), F.lit(CLASSES)))
        x = ranked.withColumn("apart", apart) if side == 0 else ranked.withColumn("apart", apart).where("apart > 0")
        other = F.col("class") + (F.col("apart") if side == 0 else -F.col("apart"))
        # a class may begin a rounding error earlier, so one is taken off
        least = F.floor(F.pow(F.lit(CLASS_RATIO), other)) - 1
        if side == 1:
            least = F.greatest(least, F.ceil(F.col("size") * LEAST[0] / LEAST[1]))
        common = F.ceil((F.col("size") + F.greatest(least, F.lit(0))) * LEAST[0] / sum(LEAST))
        length = F.least(F.col("size") - common + 1, F.col("size")).cast("int")
        low = F.col("class") if side == 0 else other
        cut = x.withColumn("length", length).where("length > 0")
        return cut.select("node", "size", "first", low.alias("low"), "apart", F.lit(side).alias("side"),
                          F.explode(F.slice("ranked", F.lit(1), F.col("length"))).alias("s")).withColumn("shingle", F.col("s.shingle")).drop("s")

    return rows(0).unionByName(rows(1))


def prefix_pairs(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v), u before v: pairs of ``nodes`` (node) that share a prefix shingle; all near ones are among them."""
    shingles = sets.join(nodes, "node", "left_semi").select("node", "size", "first", F.explode("shingles").alias("shingle"))
    looked = settle(_prefixes(shingles), "prefixes")
    small, large = looked.where("side = 0"), looked.where("side = 1 OR apart = 0")
    both = small.alias("a").join(large.alias("b"), ["shingle", "low", "apart"]).where(F.col("a.node") != F.col("b.node"))
    fits = F.least("a.size", "b.size") * LEAST[1] >= F.greatest("a.size", "b.size") * LEAST[0]
    u = F.when(_before("a", "b"), F.col("a.node")).otherwise(F.col("b.node"))
    v = F.when(_before("a", "b"), F.col("b.node")).otherwise(F.col("a.node"))
    return both.where(fits).select(u.alias("u"), v.alias("v")).distinct()


def left_pairs(members: DataFrame, sets: DataFrame, small: int = SMALL_BAND) -> DataFrame:
    """(u, v), u before v: what has to be compared of the bands that the rounds have left."""
    sizes = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    few = members.join(sizes.where(F.col("n") <= small).select("band"), "band", "left_semi")
    fits = F.least("a.size", "b.size") * LEAST[1] >= F.greatest("a.size", "b.size") * LEAST[0]
    pairs = few.alias("a").join(few.alias("b"), "band").where(_before("a", "b") & fits)
    pairs = pairs.select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))
    crowded = settle(members.join(sizes.where(F.col("n") > small).select("band"), "band", "left_semi").select("node").distinct(), "crowded")
    if crowded.isEmpty():
        return pairs.distinct()
    return pairs.unionByName(prefix_pairs(crowded, sets)).distinct()


def _kept_first(links: DataFrame) -> DataFrame:
    """Which nodes of (u, v) links, u before v, go if each goes that has a link from one that stays; as (v).

    A round settles two links of every chain of near copies that are not near the first; links are few and chains short here,
    since the rounds before have taken whatever is near the first of a band.
    """
    gone = links.select("v").limit(0)  # of a frame: rows from the driver would start further Python workers, which stay
    while not links.isEmpty():
        later = links.select(F.col("v").alias("u")).distinct()
        ready = links.join(later, "u", "left_anti").select("v").distinct()  # linked from one that certainly stays
        ready = settle(ready, "go")
        gone = gone.unionByName(ready)
        links = settle(links.join(ready, "v", "left_anti").join(ready.withColumnRenamed("v", "u"), "u", "left_anti"), "left")
    return gone


def gone_nodes(members: DataFrame, sets: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(v): the nodes that go. ``members`` has node, first, size and a band that nodes share; ``sets`` node, first, size, shingles."""
    gone = []
    fits = F.least("a.size", "b.size") * LEAST[1] >= F.greatest("a.size", "b.size") * LEAST[0]
    for k in range(rounds + 1):
        if gone:
            members = members.join(gone[-1].withColumnRenamed("v", "node"), "node", "left_anti")
        key = F.struct(F.col("first").isNull().alias("no"), "first", "node", "size")
        heads = members.groupBy("band").agg(F.min(key).alias("h"), F.count("*").alias("n")).where("n > 1").select("band", "h.*")
        if k < rounds:
            pairs = heads.alias("a").join(members.alias("b"), "band").where(F.col("a.node") != F.col("b.node"))
            pairs = pairs.where(fits).select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()
        else:
            members = settle(members, "remaining")
            pairs = left_pairs(members, sets)
        links = settle(near(settle(pairs, "pairs"), sets), "near")
        if k < rounds:  # only links from nodes that certainly stay: not behind another one in any of their bands
            behind = heads.withColumnRenamed("node", "h").join(members, "band").where("h <> node").select(F.col("node").alias("u"))
            links = links.join(behind.distinct(), "u", "left_anti")
            gone.append(settle(links.select("v").distinct(), "gone"))
        else:
            gone.append(_kept_first(links))
    out = gone[0]
    for g in gone[1:]:
        out = out.unionByName(g)
    return out.distinct()


def _sketches(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sketched rows, and one node per distinct set with the smallest doc_id that has it."""
    rows = settle(map_batches(texts, _sketched, SKETCH).withColumn("row", F.monotonically_increasing_id()), "sketches")
    nodes = rows.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("first"), F.min("size").alias("size"))
    return rows, settle(nodes, "nodes")


def _linked(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, band): the components of operator 8 that hold several documents, each a band of the nodes its documents name."""
    found = simhash.near_duplicates(texts).select("doc_id", "component_id")
    several = found.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("component_id").alias("c"))
    found = found.join(several, F.col("component_id").eqNullSafe(F.col("c")), "left_semi")
    band = F.xxhash64(F.lit("component"), "component_id").alias("band")
    return nodes.join(found, F.col("first").eqNullSafe(F.col("doc_id"))).select("node", band).distinct()


def _candidates(texts: DataFrame, rows: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of bands that several nodes share, and the whole sets of those nodes."""
    # every row brings its bands; those of rows that name no node fall out where the nodes are joined
    minima = rows.select(F.col("row").alias("node"), F.explode("bands").alias("band"))
    banded = minima.unionByName(settle(_linked(texts, nodes), "linked"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    members = settle(banded.join(shared, "band", "left_semi").join(nodes.select("node", "first", "size"), "node"), "members")
    asked = settle(nodes.join(members.select("node").distinct(), "node", "left_semi").select("digest", "node", "first", "size"), "asked")
    found = texts.join(asked.select("first").distinct(), F.col("doc_id").eqNullSafe(F.col("first")), "left_semi")
    sets = map_batches(found, _whole, SETS).join(asked, "digest").select("node", "first", "size", "shingles")
    return members, settle(sets.dropDuplicates(["node"]), "sets")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def banded_members(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is compared: (node, first, size, band) of shared bands, and (node, first, size, shingles)."""
    texts = _plain(docs)
    return _candidates(texts, *_sketches(texts))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents of which no near copy with a smaller doc_id stays, with all their columns.

    Texts with equal sets, and all texts without a word, are copies of each other. What is joined to the texts is the list
    of ids that go. An id that repeats stays if any of its rows does.
    """
    texts = _plain(docs)
    rows, nodes = _sketches(texts)
    out = settle(gone_nodes(*_candidates(texts, rows, nodes)), "out").withColumn("goes", F.lit(True))
    named = rows.select("doc_id", "digest").join(nodes.select("digest", "node", "first"), "digest").join(out.withColumnRenamed("v", "node"), "node", "left")
    stays = F.col("goes").isNull() & F.col("doc_id").eqNullSafe(F.col("first"))
    gone = settle(named.groupBy("doc_id").agg(F.bool_or(stays).alias("stays")).where("NOT stays").select(F.col("doc_id").alias("id")), "ids")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    return whole.join(gone, F.col("doc.doc_id").eqNullSafe(F.col("id")), "left_anti").select("doc.*")
