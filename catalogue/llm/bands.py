"""Quality rules by compression bands.

Zstandard ratios (bytes before : bytes after) of the whole text and of fixed chunks. Repetitive text compresses far
better than prose of its length, random or encoded text hardly at all; since a ratio grows with length, each length has
its own band. Letters of several bytes compress better without any repetition, so the greatest ratio is that of a text of
as many letters, scaled by the bytes a letter takes; it rises with the length without steps. A text outside its band, or with too many chunks outside theirs, is rejected.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from itertools import accumulate
from math import log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from .workers import map_batches

LEVEL = 3
CHUNK_BYTES = 2048
#: (bytes from, least ratio, greatest ratio); prose of the lowest lengths may not compress at all
BANDS = ((0, 0.0, 3.0), (256, 1.05, 3.0), (512, 1.15, 3.0), (1024, 1.25, 3.2), (2048, 1.35, 3.4), (4096, 1.4, 3.6),
         (16384, 1.4, 4.0), (65536, 1.4, 4.5))
#: the same prose in letters of b bytes has b ** WIDTH times the ratio (0.6 for two and three bytes)
WIDTH = 0.6
CONTINUED = bytes(range(0x80, 0xC0))
#: a text is rejected if more than this share of its bytes stands in chunks outside their band
BAD_CHUNK_SHARE = 0.3

MIN_WORDS = 20
WINDOW_WORDS = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
       "kept boolean, ratio double, bad_chunk_share double")


def band(n_bytes: int) -> tuple[float, float]:
    return BANDS[bisect_right([b[0] for b in BANDS], n_bytes) - 1][1:]


def greatest(n_letters: int, n_bytes: int) -> float:
    """The greatest ratio of a text: between the lengths of BANDS by the logarithm, times what its letters' width adds."""
    k = bisect_right([b[0] for b in BANDS], n_letters) - 1
    limit = BANDS[k][2]
    if 0 < k < len(BANDS) - 1:
        (low, _, _), (high, _, above) = BANDS[k:k + 2]
        limit += (above - limit) * log2(n_letters / low) / log2(high / low)
    return limit * (n_bytes / n_letters) ** WIDTH if n_letters else limit


def in_band(raw: bytes, compressor) -> tuple[float, bool]:
    ratio = len(raw) / len(compressor.compress(raw)) if raw else 0.0
    letters = len(raw) if raw.isascii() else len(raw.translate(None, CONTINUED))
    return ratio, not raw or band(len(raw))[0] <= ratio <= greatest(letters, len(raw))


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of WINDOW_WORDS that the text holds at least twice."""
    if len(words) <= WINDOW_WORDS:
        return 0
    at = list(accumulate(map(len, words), lambda a, b: a + b + 1, initial=0))
    joined = b" ".join(words)
    windows = [joined[a:b - 1] for a, b in zip(at, at[WINDOW_WORDS:])]
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total = end = 0
    for k, w in enumerate(windows):
        if times[w] > 1:
            total += k + WINDOW_WORDS - max(end, k)
            end = k + WINDOW_WORDS
    return total


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def code_points(words: list[bytes]) -> int:
    joined = b"".join(words)
    return len(joined) if joined.isascii() else len(joined.decode())


def measure(raw: bytes, compressor) -> tuple:
    words = raw.split()  # white space as in [\x20\x09-\x0D]
    n, repeats = len(words), repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    ratio, fine = in_band(raw, compressor)
    bad = 0
    if len(raw) > CHUNK_BYTES:
        for k in range(0, len(raw), CHUNK_BYTES):
            chunk = raw[k:k + CHUNK_BYTES]
            if not in_band(chunk, compressor)[1]:
                bad += len(chunk)
    share = bad / len(raw) if raw else 0.0
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return (n, code_points(words), symbols, duplicate_lines(raw), repeats, failed,
            not failed and fine and share <= BAD_CHUNK_SHARE, ratio, share)


def _measured(batches):
    import pyarrow as pa
    import zstandard

    compressor = zstandard.ZstdCompressor(level=LEVEL)
    fields = [f.split() for f in OUT.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    for batch in batches:
        rows = [measure(t or b"", compressor) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        columns = list(zip(*rows)) or [[]] * (len(fields) - 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields[1:]))], names=[f for f, _ in fields])


def quality(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, and the ratios behind the verdict.

    A null text has no words and fails like any text of fewer than MIN_WORDS words. Rows that repeat a doc_id, or have
    none, are judged one by one. An empty table gives no rows; further columns are ignored.
    """
    return map_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), _measured, OUT)


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns; one pass, nothing is shuffled."""
    names = docs.columns

    def keep(batches):
        import pyarrow as pa
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([measure(t or b"", compressor)[6] for t in texts], pa.bool_()))

    return map_batches(docs.select(*names), keep, docs.schema)
