"""Mixture-controlled packing: deficit round-robin over source queues into sequences of fixed length.

Every source has a queue of its documents. In each round a source earns its share of one window of tokens as credit. One that
earns ``RUN`` tokens or more a round is served what it has, to the token. One that earns less waits: its deficit is carried from
round to round until it holds a run of ``RUN`` tokens, and then that run is served whole, so a window holds no crumbs of a
thousand small sources. Small sources begin with different credits, dealt evenly, so that their runs do not fall together.

What the first k rounds have served of a source follows from k alone, so its place in the rounds is known from a token's place
in the queue, without a pass through one task. The largest source goes first in a round. The stream of rounds is cut into
sequences; nothing but the end of the last one is padding. Since all documents are packed, the target proportions are the
sources' shares of all tokens. A window holds a large source's share to within a few runs, and of a small one a run or none;
only in the last RUN / credit rounds, when small sources come to their ends, it may be off by more.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import scratch, settle
from .mixing import shuffle_key
from .prefix import running_start
from .records import ShardReader, shard_path, write_shards
from .tokens import vocabulary_path
from .workers import map_batches

SEQUENCE = 2048
#: tokens that a source with less than so many a round waits for
RUN = 64
END_ID = 1
GOLDEN = 0.6180339887498949
BUCKET_ROWS = 2048
BUCKET_ROUNDS = 64
#: records of one shard that a task reads together
GROUP_RECORDS = 1024

INDEX = "doc_id long, source string, shard long, record long, n_tokens long"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def plan(index: DataFrame, sequence: int = SEQUENCE, run: int = RUN) -> DataFrame:
    """Pieces of the records of ``index``: which tokens of which record go where in which sequence."""
    by_size = Window.orderBy(F.col("source_tokens").desc(), F.col("source").asc_nulls_last())  # one row per source
    sources = index.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"))
    sources = sources.withColumn("rank", F.row_number().over(by_size).cast("long"))
    everything = F.sum("source_tokens").over(Window.partitionBy())
    # a low-discrepancy first credit of 0 to a run, so that runs of equal sources are spread over the rounds
    first = (F.col("rank") * GOLDEN - F.floor(F.col("rank") * GOLDEN)) * run
    sources = settle(sources.select("source", "rank", "source_tokens", (F.col("source_tokens") / everything * sequence).alias("quantum"),
                                    first.alias("credit"), F.ceil(everything / sequence).alias("rounds")), "shares")
    rows = index.join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    bits = (index.count() // BUCKET_ROWS).bit_length()
    rows = rows.withColumn("_key", shuffle_key(F.col("doc_id"))).withColumn("_bucket", F.shiftright("_key", 60 - bits))
    queued = running_start(rows, ["rank"], "_bucket", ["_key", "doc_id", "shard", "record"], "n_tokens", "at")

    quantum, end, one, last = F.col("quantum"), F.col("at") + F.col("n_tokens"), F.lit(1).cast("long"), F.col("rounds")
    whole = quantum >= run
    by_round = F.sequence(F.greatest(one, F.least(last, F.floor(F.col("at") / quantum))), F.least(last, F.ceil(end / quantum) + 1))
    by_run = F.sequence(F.floor(F.col("at") / run), F.floor((end - 1) / run))
    cut = queued.withColumn("k", F.explode(F.when(whole, by_round).otherwise(by_run)))
    served = lambda k: F.when(k >= last, F.col("source_tokens")).otherwise(F.floor(k * quantum))
    lo = F.when(whole, F.greatest("at", served(F.col("k") - 1))).otherwise(F.greatest("at", F.col("k") * run))
    hi = F.when(whole, F.least(end, served(F.col("k")))).otherwise(F.least(end, (F.col("k") + 1) * run))
    cut = cut.withColumn("turn", lo).withColumn("length", hi - F.col("turn")).where("length > 0")
    cut = cut.withColumn("from", F.col("turn") - F.col("at"))
    # the round in which the run's credit is complete; the last run of a source needs credit for what is left
    full = F.ceil((F.least((F.col("k") + 1) * run, "source_tokens") - F.col("credit")) / quantum)
    cut = cut.withColumn("round", F.when(whole, F.col("k")).otherwise(F.greatest(one, F.least(last, full))).cast("long"))
    cut = cut.select("doc_id", "source", "shard", "record", "n_tokens", "rank", "round", "turn", "from", "length",
                     F.floor(F.col("round") / BUCKET_ROUNDS).alias("_bucket"))
    stream = running_start(cut, [], "_bucket", ["round", "rank", "turn"], "length", "at")

    cut = stream.withColumn("sequence_id", F.explode(F.sequence(
        F.floor(F.col("at") / sequence), F.floor((F.col("at") + F.col("length") - 1) / sequence))))
    lo, hi = F.greatest("at", F.col("sequence_id") * sequence), F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * sequence)
    return cut.select("doc_id", "source", "shard", "record", "n_tokens", (F.col("from") + lo - F.col("at")).alias("start"),
                      (hi - lo).alias("length"), "sequence_id", (lo - F.col("sequence_id") * sequence).alias("offset"))


def _joined(c: dict) -> list:
    """The first of each run of pieces that follow each other in their record and in their sequence."""
    import numpy as np

    end, place = c["start"] + c["length"], c["offset"] + c["length"]
    on = np.ones(len(end), bool)
    same = [c[k][1:] == c[k][:-1] for k in ("shard", "record", "n_tokens", "sequence_id")]
    on[1:] = ~(np.all(same, axis=0) & (c["start"][1:] == end[:-1]) & (c["offset"][1:] == place[:-1]))
    return np.flatnonzero(on)


def _read_pieces(folder: str):
    """A mapInArrow function over pieces sorted by shard, record and start: joins neighbours, adds the ids' checksum."""
    import numpy as np
    import pyarrow as pa

    numbers = ("shard", "record", "n_tokens", "start", "length", "sequence_id", "offset")

    def read(batches):
        reader, open_shard = None, None

        def ids_of(shard: int, record: int) -> memoryview:
            nonlocal reader, open_shard
            if shard != open_shard:
                if reader:
                    reader.close()
                reader, open_shard = ShardReader(shard_path(folder, shard)), shard
            return memoryview(reader.near_record(record)[1]).cast("B")

        def checked(c: dict, doc_id, source):
            first = _joined(c)
            length = np.add.reduceat(c["length"], first)
            starts, stops = (c["start"][first] * 4).tolist(), ((c["start"][first] + length) * 4).tolist()
            record = c["record"][first]
            turns = np.flatnonzero(np.concatenate(([True], (record[1:] != record[:-1]) | (c["shard"][first][1:] != c["shard"][first][:-1])))).tolist()
            sums: list[int] = []
            for i, j in zip(turns, [*turns[1:], len(first)]):
                ids = ids_of(int(c["shard"][first[i]]), int(record[i]))
                sums += [zlib.crc32(ids[a:b]) for a, b in zip(starts[i:j], stops[i:j])]
            at = pa.array(first)
            return pa.RecordBatch.from_arrays([doc_id.take(at), pa.array(c["start"][first]), pa.array(length), pa.array(sums, pa.int64()),
                                               pa.array(c["n_tokens"][first]), pa.array(c["sequence_id"][first]), pa.array(c["offset"][first]), source.take(at)],
                                              names=[x.split()[0] for x in PIECES.split(", ")])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            c = {k: table.column(k).to_numpy() for k in numbers}
            # the last run may go on in the next batch
            end = int(_joined(c)[-1]) if table.num_rows else 0
            if end:
                done = table.slice(0, end)
                yield checked({k: v[:end] for k, v in c.items()}, done.column("doc_id").combine_chunks(), done.column("source").combine_chunks())
            held = table.slice(end)
        if held is not None and held.num_rows:
            c = {k: held.column(k).to_numpy() for k in numbers}
            yield checked(c, held.column("doc_id").combine_chunks(), held.column("source").combine_chunks())
        if reader:
            reader.close()

    return read


def pack(documents: DataFrame, sequence: int = SEQUENCE, run: int = RUN, end_id: int = END_ID,
         vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source.

    Texts are encoded once and written as token records; the plan moves record numbers, and each piece's ids are read
    from its record. A null or empty text is the end id alone; a null source is a source of its own; rows that repeat
    a doc_id, or have none, are packed one by one. An empty table gives no rows; further columns are ignored.
    """
    folder = f"{scratch(documents.sparkSession)}/tokens"
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                             F.col("text").cast("string").alias("text"))
    index = settle(map_batches(texts, write_shards(folder, end_id, vocabulary or vocabulary_path(), per_record=True), INDEX, keeps="encoder"), "index")
    pieces = plan(index, sequence, run).withColumn("_group", F.floor(F.col("record") / GROUP_RECORDS))
    pieces = pieces.repartition("shard", "_group").sortWithinPartitions("shard", "record", "start").drop("_group")
    return map_batches(pieces, _read_pieces(folder), PIECES)
