"""Token ids as length-delimited binary records with a separate offset index.

A shard is a file of records, each framed as

    length of the payload    8 bytes, little-endian
    masked CRC-32 of those   4 bytes
    payload
    masked CRC-32 of it      4 bytes

where masking rotates the checksum right by 15 bits and adds a constant, so that checksums of data that holds
checksums stay sound. The payload is a header (flags, bytes per id, number of ids, document id) and the ids, little-endian.
Next to each shard stands its index: 16 bytes per record (offset, framed length), so record k of a shard can be read
on its own and a reader can visit records in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import scratch, settle
from .tokens import encoder, vocabulary_path
from .workers import map_batches

END_ID = 2
MASK_DELTA = 0xA282EAD8  # fixed value of the record format
LENGTH, CHECK, HEADER, INDEX = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BBHIq"), struct.Struct("<QQ")
FRAME_BYTES = LENGTH.size + 2 * CHECK.size
HAS_ID = 1
WRITE_BYTES = 8 << 20

MANIFEST = "shard long, path string, records long, tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes | memoryview) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = LENGTH.pack(len(payload))
    return b"".join((length, CHECK.pack(masked(length)), payload, CHECK.pack(masked(payload))))


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return HEADER.pack(HAS_ID * (doc_id is not None), width, 0, len(ids) // width, doc_id or 0) + ids


def unframe(data: bytes | memoryview, at: int = 0) -> tuple[memoryview, int]:
    """Payload of the frame at ``at`` and the place after it; ValueError if it is cut short or damaged."""
    view = memoryview(data)
    if len(view) < at + FRAME_BYTES:
        raise ValueError(f"record at {at} is cut short")
    (n,), (check,) = LENGTH.unpack_from(view, at), CHECK.unpack_from(view, at + LENGTH.size)
    if check != masked(view[at:at + LENGTH.size]):
        raise ValueError(f"length of the record at {at} is damaged")
    begin = at + LENGTH.size + CHECK.size
    if len(view) < begin + n + CHECK.size:
        raise ValueError(f"record at {at} is cut short")
    payload = view[begin:begin + n]
    if CHECK.unpack_from(view, begin + n)[0] != masked(payload):
        raise ValueError(f"record at {at} is damaged")
    return payload, begin + n + CHECK.size


def unpack(payload: bytes | memoryview):
    """(doc_id, ids as unsigned 32-bit numbers)."""
    import numpy as np

    flags, width, _, n, doc_id = HEADER.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width}", n, HEADER.size).astype("<u4")
    return (doc_id if flags & HAS_ID else None), ids


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


class ShardWriter:
    """Writes one shard and its index under names of this attempt, and moves them into place at the end.

    A task that runs again, or twice at once, writes the same content, so whichever attempt comes last changes nothing.
    """

    def __init__(self, path: str, attempt: str):
        self.fs, self.path = _store(path)
        self.attempt = attempt
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.data, self.index = (self.fs.open_output_stream(f"{self.path}.{kind}.{attempt}") for kind in ("rec", "idx"))
        self.held: list[bytes] = []
        self.held_bytes = self.offset = self.records = self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes, width: int) -> None:
        record = frame(pack(doc_id, ids, width))
        self.index.write(INDEX.pack(self.offset, len(record)))
        self.held.append(record)
        self.held_bytes += len(record)
        self.offset += len(record)
        self.records += 1
        self.tokens += len(ids) // width
        if self.held_bytes >= WRITE_BYTES:
            self.flush()

    def flush(self) -> None:
        self.data.write(b"".join(self.held))
        self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self.flush()
        for stream, kind in ((self.data, "rec"), (self.index, "idx")):
            stream.close()
            self.fs.move(f"{self.path}.{kind}.{self.attempt}", f"{self.path}.{kind}")


class ShardReader:
    """Reads records of a shard by number."""

    def __init__(self, path: str):
        import numpy as np

        self.fs, self.path = _store(path)
        with self.fs.open_input_stream(f"{self.path}.idx") as f:
            self.entries = np.frombuffer(f.read(), "<u8").reshape(-1, 2)
        self.data = self.fs.open_input_file(f"{self.path}.rec")
        self.block: tuple[int, int, bytes] = (0, 0, b"")

    def __len__(self) -> int:
        return len(self.entries)

    def record(self, k: int):
        offset, n = map(int, self.entries[k])
        return unpack(unframe(self.data.read_at(n, offset))[0])

    def near_record(self, k: int):
        """The same for records asked for in ascending order: they are read together, up to ``WRITE_BYTES`` ahead."""
        first, end, data = self.block
        if not first <= k < end:
            first, offset = k, int(self.entries[k][0])
            ends = self.entries[k:, 0] + self.entries[k:, 1] - offset
            end = k + max(1, int((ends <= WRITE_BYTES).sum()))
            data = self.data.read_at(int(ends[end - 1 - k]), offset)
            self.block = first, end, data
        at = int(self.entries[k][0]) - int(self.entries[first][0])
        return unpack(unframe(data, at)[0])

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """All records in order, read in large pieces: (number of the first record, framed records)."""
        k = 0
        while k < len(self):
            offset, end = int(self.entries[k][0]), k + 1
            while end < len(self) and int(self.entries[end].sum()) - offset <= WRITE_BYTES:
                end += 1
            yield k, self.data.read_at(int(self.entries[end - 1].sum()) - offset, offset)
            k = end

    def close(self) -> None:
        self.data.close()


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:06d}"


def write_shards(folder: str, end_id: int, vocabulary: str, per_record: bool = False):
    """A mapInArrow function over (doc_id, text, ...): one shard per task.

    Yields the shard's manifest row, or with ``per_record`` a row per record (shard, record, n_tokens) after the
    input's further columns.
    """
    import pyarrow as pa

    def write(batches):
        task = TaskContext.get()
        shard = task.partitionId()
        enc = encoder(vocabulary)
        end = end_id.to_bytes(enc.width, "little")
        out = ShardWriter(shard_path(folder, shard), f"{task.taskAttemptId()}")
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            first, sizes = out.records, []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode([t or b"" for t in texts])):
                ids += end
                out.add(doc_id, ids, enc.width)
                sizes.append(len(ids) // enc.width)
            if per_record:
                n = len(sizes)
                rest = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in rest), pa.array([shard] * n, pa.int64()),
                     pa.array(range(first, first + n), pa.int64()), pa.array(sizes, pa.int64())],
                    names=[*rest, "shard", "record", "n_tokens"])
        out.close()
        if not per_record:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
                (shard, pa.int64()), (shard_path(folder, shard), pa.string()), (out.records, pa.int64()), (out.tokens, pa.int64()))],
                names=["shard", "path", "records", "tokens"])

    return write


def write_records(documents: DataFrame, end_id: int = END_ID, vocabulary: str | None = None, folder: str | None = None) -> DataFrame:
    """Encodes every document and writes the shards in ascending doc_id order (null first); returns the manifest.

    Only the texts are shuffled, once; the ids go straight from the encoder to the shard. ``folder`` is where the
    shards go, a path or URI that all executors reach; without it they are scratch of this process.
    """
    folder = folder or f"{scratch(documents.sparkSession)}/records"
    ordered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return settle(map_batches(ordered, write_shards(folder, end_id, vocabulary or vocabulary_path()), MANIFEST, keeps="encoder"), "manifest")


def read_records(manifest: DataFrame) -> DataFrame:
    """One row per record of the shards: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all earlier records, over all shards; the checksum is the one of the ids as little-endian
    unsigned 32-bit integers, taken from what the file holds after its own checksums have been verified.
    """
    import pyarrow as pa

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    placed = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    shards = max(1, manifest.count())

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                reader = ShardReader(path)
                for _, data in reader.blocks():
                    rows, at = [], 0
                    while at < len(data):
                        payload, at = unframe(data, at)
                        doc_id, ids = unpack(payload)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids)))
                        start += len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                     names=["doc_id", "start", "n_tokens", "ids_crc32"])
                reader.close()

    return map_batches(placed.repartition(shards), read, ROWS, keeps="encoder")


def token_records(documents: DataFrame, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """Writes all documents as token records and reads them back: doc_id, start, n_tokens, ids_crc32.

    A null or empty text is a record of the end id alone. A null doc_id comes first and is kept as such; rows that
    repeat a doc_id are records of their own, ordered by text. An empty table gives empty shards and no rows; further
    columns are ignored.
    """
    return read_records(write_records(documents, end_id, vocabulary))
