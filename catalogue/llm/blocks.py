"""Exact duplicates by deterministic block naming.

A text is cut into fixed-size blocks. The distinct blocks are sorted and each gets its rank as an integer name; then
adjacent names are paired, the distinct pairs are sorted and named the same way, until every document has one name.
Names are ranks of distinct contents, so two documents share an identity exactly when their texts are equal.

Blocks are sorted by (fingerprint, length, content). Contents only have to be compared where one fingerprint and
length belong to several contents, so what travels per block is narrow; distinct contents are moved once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle

BLOCK_BYTES = 4096
#: white space that separates words, as in ``[\x20\x09-\x0D]+``
LONG_OR_OTHER_SPACE = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty. Single spaces are left untouched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), LONG_OR_OTHER_SPACE, " ")


def fingerprint(block: Column) -> Column:
    return F.xxhash64(block)


def _blocks(content: Column, size: int) -> Column:
    """The bytes of a text in blocks of ``size``; an empty text is one empty block."""
    last = F.greatest(F.lit(0), F.floor((F.octet_length(content) - 1) / size)).cast("int")
    return F.transform(F.sequence(F.lit(0), last),
                       lambda i: F.substring(content, i * size + 1, F.lit(size)))


def _named(keys: DataFrame, order: list[str]) -> DataFrame:
    """Distinct keys with their rank in sort order. Ranks do not depend on how the rows were dealt out."""
    ranked = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ranked.select(*order, F.monotonically_increasing_id().alias("_id")), "names")
    placed = placed.withColumn("_task", F.shiftright("_id", 33)).withColumn("_nth", F.col("_id").bitwiseAND((1 << 33) - 1))
    tasks = placed.groupBy("_task").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # one row per task of the sort: as many as it has partitions, whatever the number of rows
    return placed.join(F.broadcast(tasks), "_task").select(*order, (F.col("_base") + F.col("_nth")).alias("name"))


def _first_names(docs: DataFrame, block_bytes: int, hash_fn) -> DataFrame:
    """(doc_id, sha, copies, i, name): one row per block of a distinct row, named by content."""
    cut = docs.select("doc_id", "sha", F.posexplode(_blocks(F.col("_content"), block_bytes)).alias("i", "block"))
    cut = cut.withColumn("h", hash_fn(F.col("block"))).withColumn("size", F.octet_length("block"))
    contents = settle(cut.groupBy("h", "size", "block").agg(F.lit(1).alias("one")).groupBy("h", "size")
                      .agg(F.count("*").alias("contents")), "keys")
    instances = cut.groupBy("doc_id", "sha", "i", "h", "size")
    shared = contents.where("contents > 1").select("h", "size")
    if shared.isEmpty():
        placed = instances.agg(F.count("*").alias("copies")).withColumn("nth", F.lit(0).cast("long"))
        keys = contents.select("h", "size", F.lit(0).cast("long").alias("nth"))
    else:
        # several contents behind one fingerprint: tell them apart by their order among themselves
        apart = cut.join(shared, ["h", "size"]).groupBy("h", "size", "block").agg(F.lit(1).alias("one"))
        apart = settle(apart.select("h", "size", "block", (F.row_number().over(
            Window.partitionBy("h", "size").orderBy("block")) - 1).cast("long").alias("nth")), "collisions")
        placed = cut.join(apart, ["h", "size", "block"], "left").groupBy(
            "doc_id", "sha", "i", "h", "size", F.coalesce("nth", F.lit(0)).alias("nth")).agg(F.count("*").alias("copies"))
        keys = contents.where("contents = 1").select("h", "size", F.lit(0).cast("long").alias("nth")).unionByName(
            apart.select("h", "size", "nth"))
    names = _named(keys, ["h", "size", "nth"])
    return settle(placed.join(names, ["h", "size", "nth"]).select("doc_id", "sha", "copies", "i", "name"), "level")


def identities(documents: DataFrame, block_bytes: int = BLOCK_BYTES, hash_fn=fingerprint) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, sha (bytes), copies, level, name.

    (level, name) is the identity: equal for two rows exactly if their normalised texts are equal. ``hash_fn`` only
    decides which blocks have to be compared, never the outcome.
    """
    content = normalised(F.col("text"))
    docs = documents.select("doc_id", F.encode(content, "UTF-8").alias("_content"))
    docs = docs.withColumn("sha", F.unhex(F.sha2("_content", 256)))
    level = _first_names(docs, block_bytes, hash_fn)
    n = 0
    done: DataFrame | None = None
    while True:
        if level.where("i > 0").isEmpty():
            last = level.select("doc_id", "sha", "copies", F.lit(n).alias("level"), "name")
            return last if done is None else done.unionByName(last)
        paired = level.groupBy("doc_id", "sha", F.shiftright("i", 1).alias("i")).agg(
            F.max("copies").alias("copies"), F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
            F.max("i").alias("_last"))
        paired = settle(paired, "pairs")
        # a document of one block is done and stays out of the pairs
        ended = paired.where("i = 0 AND _last = 0").select("doc_id", "sha", "copies", F.lit(n).alias("level"), F.col("a").alias("name"))
        done = ended if done is None else done.unionByName(ended)
        more = paired.where("NOT (i = 0 AND _last = 0)")
        names = _named(more.select("a", "b").distinct(), ["a", "b"])
        level = settle(more.join(names, ["a", "b"]).select("doc_id", "sha", "copies", "i", "name"), "level")
        n += 1


def exact_duplicates(documents: DataFrame, block_bytes: int = BLOCK_BYTES, hash_fn=fingerprint) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` becomes one space; a null text counts as
    empty. Of equal texts the row with the smallest doc_id stays; a null doc_id comes after all others. Rows that
    repeat both doc_id and text are one document in several copies: each counts in group_size and has its row, and
    only the first of them can be kept. An empty table gives no rows; further columns are ignored.
    """
    named = settle(identities(documents, block_bytes, hash_fn), "identities")
    # written first, so that both sides of the join are plain shuffles that Spark can split at a hot identity
    groups = settle(named.groupBy("level", "name").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")), "groups")
    rows = named.join(groups, ["level", "name"])
    rows = rows.select("doc_id", "keep_id", "group_size", F.lower(F.hex("sha")).alias("text_sha256"),
                       F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    What is joined to the texts is the list of ids that go, so texts move only where that list is too long to send to
    every task. An id of which some rows stay and others go is settled by its texts.
    """
    verdict = settle(exact_duplicates(docs), "exact")
    by_id = verdict.groupBy("doc_id").agg(F.bool_or("kept").alias("some"), F.bool_and("kept").alias("all"))
    ids = settle(by_id.where("NOT all").select(F.col("doc_id").alias("id"), "some"), "ids")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    same_id = F.col("doc.doc_id").eqNullSafe(F.col("id"))
    if ids.where("some").isEmpty():
        return whole.join(ids.select("id"), same_id, "left_anti").select("doc.*")
    sha = F.unhex(F.sha2(F.encode(normalised(F.col("doc.text")), "UTF-8"), 256))
    keys = verdict.where("kept").select(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("sha"))
    partly = whole.join(ids.where("some").select("id"), same_id, "left_semi").withColumn("own", sha)
    partly = partly.join(keys, same_id & (F.col("own") == F.col("sha")), "left_semi")
    one = partly.groupBy("doc.doc_id", "own").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    return whole.join(ids.select("id"), same_id, "left_anti").unionByName(one.select("doc")).select("doc.*")
