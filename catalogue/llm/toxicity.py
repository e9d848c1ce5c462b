"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its lower-cased UTF-8 bytes, hashed. Each feature is scaled by the log
ratio of its (smoothed) document counts in toxic and other texts, and a logistic regression is fitted on the scaled
features, both classes weighing the same and weights shrunk towards zero, so that few labels are not learned by heart.
The fit uses a bounded sample of labelled rows; every document is scored on its whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from .workers import map_batches

GRAMS = (3, 4, 5)
HASH_BITS = 18
#: labelled rows that the model is fitted on, at most, per class
SAMPLE_TOXIC, SAMPLE_OTHER = 1000, 2500
ROUNDS = 40
STEP = 0.1
FIRST_WEIGHT = 0.2
SHRINKAGE = 3e-5
THRESHOLD = 0.3
PIECE_BYTES = 1 << 20
#: texts of the sample whose features are gone through together
TEXTS_AT_ONCE = 256

OUT = "doc_id long, score double"


class Grams:
    """Distinct hashed n-grams of one text after another."""

    def __init__(self):
        import numpy as np

        self.place = np.zeros(1 << HASH_BITS, np.int32)
        self.seen = np.full(1 << HASH_BITS, -1, np.int64)
        self.texts = 0

    def _piece(self, raw: bytes):
        import numpy as np

        b = np.frombuffer(raw, np.uint8).astype(np.uint32)
        h, out = b, []
        for n in range(2, max(GRAMS) + 1):
            if len(b) < n:
                break
            h = (h[:-1] * np.uint32(0x01000193)) ^ b[n - 1:]
            if n in GRAMS:
                out.append((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS))
        if not out:
            return np.zeros(0, np.uint32)
        x = np.concatenate(out)
        order = np.arange(len(x), dtype=np.int32)
        self.place[x] = order
        return x[self.place[x] == order]

    def of(self, text: str):
        import numpy as np

        raw = f" {text.lower()} ".encode()
        if len(raw) <= PIECE_BYTES:
            return self._piece(raw)
        self.texts += 1
        parts = []
        for k in range(0, len(raw), PIECE_BYTES):
            x = self._piece(raw[k:k + PIECE_BYTES + max(GRAMS) - 1])
            x = x[self.seen[x] != self.texts]
            self.seen[x] = self.texts
            parts.append(x)
        return np.concatenate(parts)


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A bounded sample of labelled documents, the same on every run: per class those whose id hashes lowest."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("_at", F.xxhash64("doc_id"))
    picked = known.where("toxic = 1").orderBy("_at", "doc_id").limit(SAMPLE_TOXIC).unionByName(
        known.where("toxic <> 1").orderBy("_at", "doc_id").limit(SAMPLE_OTHER))
    # at most SAMPLE_TOXIC + SAMPLE_OTHER ids
    rows = documents.select("doc_id", "text").join(F.broadcast(picked.select("doc_id", "toxic")), "doc_id")
    return rows.groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.max("text").alias("text"))


def fit(sample: DataFrame):
    """(weight per feature, bias) of the model; the sample's features are made by Spark, the bounded rest here."""
    import numpy as np

    def features(batches):
        import pyarrow as pa

        grams = Grams()
        for batch in batches:
            found = [np.sort(grams.of(t or "")).astype("<i4") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array([x.tobytes() for x in found], pa.binary())],
                                             names=["toxic", "grams"])

    rows = map_batches(sample.select("doc_id", "toxic", "text"), features, "toxic int, grams binary").collect()
    rows = sorted((r["toxic"], bytes(r["grams"])) for r in rows)  # sums do not depend on how the rows arrive
    y = np.array([float(t == 1) for t, _ in rows])
    size = 1 << HASH_BITS
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        return np.zeros(size, np.float32), float(np.log(max(share, 1e-6) / (1 - min(share, 1 - 1e-6))))
    parts = []  # (first text, last text, their n-grams, number of the text of each)
    for k in range(0, len(rows), TEXTS_AT_ONCE):
        x = [np.frombuffer(g, "<i4") for _, g in rows[k:k + TEXTS_AT_ONCE]]
        parts.append((k, k + len(x), np.concatenate(x), np.repeat(np.arange(len(x), dtype=np.int16), [len(f) for f in x])))
    del rows

    toxic, other = np.ones(size), np.ones(size)
    for k, end, column, row in parts:
        toxic += np.bincount(column, y[k:end][row], size)
        other += np.bincount(column, 1 - y[k:end][row], size)
    ratio = np.log(toxic / (y.sum() + 2)) - np.log(other / (len(y) - y.sum() + 2))
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, b, m, v = np.full(size, FIRST_WEIGHT), 0.0, np.zeros(size), np.zeros(size)
    for n in range(1, ROUNDS + 1):
        g, slope = SHRINKAGE * w, 0.0
        scaled = ratio * w
        for k, end, column, row in parts:
            length = 1 / np.sqrt(np.bincount(row, minlength=end - k) + 1)
            z = np.bincount(row, scaled[column], end - k) * length + b
            error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[k:end]) * share[k:end]
            g += ratio * np.bincount(column, (error * length)[row], size)
            slope += error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= STEP * (m / (1 - 0.9 ** n)) / (np.sqrt(v / (1 - 0.99 ** n)) + 1e-10)
        b -= 5 * slope
    return (ratio * w).astype(np.float32), float(b)


def score(documents: DataFrame, model) -> DataFrame:
    """(doc_id, score) of every document; the model is of fixed size whatever the corpus."""
    weight, bias = model

    def scored(batches):
        import numpy as np
        import pyarrow as pa

        grams = Grams()
        for batch in batches:
            z = []
            for text in batch.column("text").to_pylist():
                f = grams.of(text or "")
                z.append(float(weight[f].sum(dtype=np.float64)) / (len(f) + 1) ** 0.5 + bias)
            p = 1 / (1 + np.exp(-np.clip(np.array(z), -50, 50)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], names=["doc_id", "score"])

    return map_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), scored, OUT)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 from THRESHOLD up).

    ``labels`` (doc_id, toxic) are the rows to learn from; null ids and null marks are left out, repeated ids count
    once with their highest mark. Without two classes every text gets the same score: the share of toxic labels, near
    zero if there are none. A null or empty text has the score of a text without n-grams. Rows that repeat a doc_id, or
    have none, are scored one by one. An empty table gives no rows; further columns are ignored.
    """
    model = fit(labelled(documents, labels))
    return score(documents, model).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
