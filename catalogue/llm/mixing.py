"""Mixing sources to target weights by a low-discrepancy schedule.

The slots of the schedule are the points of a golden-ratio lattice: with N a Fibonacci number F(k), slot n stands at
n * F(k-1) mod N, which visits every position of 0..N-1 once and spreads any interval of positions evenly over time.
The positions are dealt to sources by cumulative weights, slots are ranked per source, and the r-th slot of a source
takes the r-th block of equally many words from its shuffled documents (read up to three times over).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle
from .prefix import running_start

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 1024
#: a small corpus gets smaller blocks, so that the schedule has at least this many slots where there are words for it
MIN_SLOTS = 1 << 17
#: N * N has to fit a signed 64-bit integer
MAX_SLOTS = 2_971_215_073
BUCKET_ROWS = 2048
PIECE_SLOTS = 4096


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column) -> Column:
    """Place of a document in its source's shuffled order: 60 bits of a digest of its id."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) to (source, source_size, rank, target): the shares of the words by weight.

    A target stops at MAX_REPEATS times the source's size and the excess is shared among the others by weight, until
    none is above: target = min(cap, level * weight), where level makes the targets add up to all words. Sources are
    taken by cap / weight, so the level is found in one pass over the list of sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("rank", F.row_number().over(by_name).cast("long"))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int")).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * MAX_REPEATS).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "rank")
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy()
    s = s.withColumn("left", F.sum("source_size").over(everything) - before).withColumn("rest", rest)
    s = s.withColumn("fits", F.col("left") * F.col("weight") <= F.col("cap") * F.col("rest"))
    level = F.min_by(F.when(F.col("fits"), F.col("left") / F.col("rest")), F.when(F.col("fits"), F.struct("ratio", "rank"))).over(everything)
    first = F.min(F.when(F.col("fits"), F.struct("ratio", "rank"))).over(everything)
    target = F.when(F.struct("ratio", "rank") >= first, level * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return s.select("source", "source_size", "rank", target.alias("target"))


def lattice(slots: int) -> tuple[int, int]:
    """The smallest Fibonacci number of at least ``slots``, and the one before it."""
    a, b = 1, 2
    while b < slots:
        a, b = b, a + b
    return b, a


def block_words(words: int) -> int:
    block = max(1, min(BLOCK_WORDS, words // MIN_SLOTS))
    return max(block, -(-2 * words // MAX_SLOTS))


def schedule(documents: DataFrame, row: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as three frames: rows (row, doc_id, rank, size, source_size, target), sources, and draws.

    A draw (slot, row, epoch, first_word, n_words) takes a run of words of one document into a slot; the mix read by
    slot has the target proportions in every stretch. All of a source's draws add up to its rounded target. ``row``
    names a column that numbers the documents; without it they are numbered here.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = settle(documents.select(number.alias("row"), "doc_id", "source",
                                   word_count(F.col("text")).alias("size")), "sizes")
    sources = settle(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources")
    totals = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.count("*").alias("n")).first()
    documents_n = rows.count()
    block = block_words(totals["words"])
    quota = F.round("target").cast("long")
    sources = sources.withColumn("quota", quota).withColumn("slots", F.ceil(quota / block).cast("long"))
    rows = rows.join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")

    # slots: positions of each source's stretch, in pieces of a bounded number, then their place in time
    n, step = lattice(totals["words"] // block + totals["n"] + 1)
    inverse = pow(step, -1, n)
    ahead = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    stretch = sources.where("slots > 0").withColumn("lo", F.coalesce(F.sum("slots").over(ahead), F.lit(0)))
    pieces = stretch.select("rank", "lo", (F.col("lo") + F.col("slots")).alias("hi"),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / PIECE_SLOTS))).alias("k"))
    pieces = pieces.select("rank", (F.col("lo") + F.col("k") * PIECE_SLOTS).alias("lo"),
                           (F.least("hi", F.col("lo") + (F.col("k") + 1) * PIECE_SLOTS) - 1).alias("hi")).repartition("rank", "lo")
    slots = pieces.select("rank", F.explode(F.sequence("lo", "hi")).alias("position"))
    slots = slots.select("rank", ((F.col("position") * inverse) % n).alias("slot"))
    # slots stand evenly on 0..n-1, so equal stretches of time hold equally many
    slots = slots.withColumn("_one", F.lit(1).cast("long")).withColumn("_bucket", F.floor(F.col("slot") / BUCKET_ROWS))
    slots = running_start(slots, ["rank"], "_bucket", ["slot"], "_one", "nth").select("rank", "slot", "nth")

    # the shuffled documents of each source end to end
    bits = max(0, (documents_n // BUCKET_ROWS).bit_length())
    rows = rows.withColumn("_key", shuffle_key(F.col("doc_id"))).withColumn("_bucket", F.shiftright("_key", 60 - bits))
    queued = running_start(rows, ["rank"], "_bucket", ["_key", "doc_id", "row"], "size", "start")
    passes = queued.where("size > 0").select("rank", "row", "size", "quota", "source_size", "start", F.explode(
        F.sequence(F.lit(0), F.lit(MAX_REPEATS - 1))).alias("epoch"))
    passes = passes.withColumn("lo", F.col("start") + F.col("epoch") * F.col("source_size"))
    passes = passes.withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("quota"))).where("lo < hi")
    parts = passes.select("rank", "row", "epoch", "lo", "hi", F.explode(
        F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))).alias("nth"))
    draws = parts.join(slots, ["rank", "nth"]).select(
        "slot", "row", "epoch", (F.greatest("lo", F.col("nth") * block) - F.col("lo")).alias("first_word"),
        (F.least("hi", (F.col("nth") + 1) * block) - F.greatest("lo", F.col("nth") * block)).alias("n_words"))
    return rows.select("row", "doc_id", "rank", "size", "source_size", "target"), sources, draws


def mix(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, first_slot, n_draws, draws_checksum.

    The last three say where the schedule puts the document: its earliest slot (null if it takes nothing), how many slots draw
    from it, and a checksum over slot, pass, first word and number of words of these draws.

    A null text has no words, a null source is a source of its own and comes last, and a null doc_id is shuffled like
    any other. Documents without words, and sources without any, take nothing. Rows that repeat a doc_id are mixed one
    by one. An empty table gives no rows; further columns are ignored.
    """
    rows, _, draws = schedule(documents)
    mark = (F.col("slot") * 1_000_003 + F.col("epoch") * 65_537 + F.col("first_word") * 8191 + F.col("n_words")) % 2_147_483_647
    taken = draws.groupBy("row").agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_draws"),
                                     F.sum(mark).alias("draws_checksum"))
    none = F.lit(0).cast("long")
    return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", none).alias("taken"), "first_slot",
                                                  F.coalesce("n_draws", none).alias("n_draws"), F.coalesce("draws_checksum", none).alias("draws_checksum"))


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: a document once per pass that takes it, cut after the last word taken, with n_chars to match."""
    whole = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    whole = settle(whole, "mixed")
    rows, _, draws = schedule(whole.select("row", "doc.doc_id", "doc.source", "doc.text"), "row")
    passes = draws.groupBy("row", "epoch").agg(F.sum("n_words").alias("words"))
    passes = passes.groupBy("row").agg(F.collect_list("words").alias("words"))
    passes = passes.join(rows.select("row", "size"), "row")
    out = whole.join(passes, "row").withColumn("taken", F.explode("words"))
    complete = F.col("taken") >= F.col("size")
    text = F.when(complete, F.col("doc.text")).otherwise(_first_words(F.col("doc.text"), F.col("taken")))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        n_chars = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(complete, F.col("doc.n_chars")).otherwise(n_chars)
    return out.select(*(changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))
