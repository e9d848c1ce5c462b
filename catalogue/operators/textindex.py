"""Stored text index: an inverted table of trigrams, the counts to start with the rarest, and the texts to check against.

Built once, asked often. Three tables lie below one folder, each cut into directories by a checksum that a query can compute
for itself, so that it opens the files of its own trigrams and keys and no others:

* ``postings`` (part; trigram, key) in the order of trigram and key; a frequent trigram is cut into several files;
* ``counts`` (part; trigram, n), one row per trigram;
* ``texts`` (slot; key, fields) in the order of the key.

A phrase is looked up by its rarest trigrams. What holds them all is checked on the text itself, so the answer is exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import settle
from .search import trigrams_of

PARTS = 64
SLOTS = 64
#: trigrams of a phrase that are intersected; the text decides about the rest
RAREST = 3
#: how many times longer than the shortest a list may be
LONGER = 8
#: phrases that are looked up together
AT_ONCE = 50
#: up to so many candidates are fetched by key, more are joined
FETCH_KEYS = 1000


def _part(value: Column, parts: int) -> Column:
    return (F.crc32(value.cast("string").cast("binary")) % parts).cast("int")


def part_of(value: str, parts: int) -> int:
    return zlib.crc32(value.encode()) % parts


def pieces(phrase: str) -> list[str]:
    """The distinct trigrams of a phrase in order; none if it is shorter."""
    return list(dict.fromkeys(phrase[i:i + 3] for i in range(len(phrase) - 2)))


@dataclass(frozen=True)
class TextIndex:
    """An opened index; ``key`` is unique in the indexed table. The tables are listed once, when the index is opened."""

    key: str
    fields: tuple[str, ...]
    texts: DataFrame
    postings: DataFrame
    counts: DataFrame
    parts: int = PARTS
    slots: int = SLOTS

    def trigram_counts(self, trigrams: Sequence[str]) -> dict[str, int]:
        """Rows per trigram; as many rows as were asked for at most."""
        at = sorted({part_of(t, self.parts) for t in trigrams})
        found = self.counts.where(F.col("part").isin(at) & F.col("trigram").isin(list(trigrams)))
        return {r["trigram"]: r["n"] for r in found.select("trigram", "n").collect()}

    def chosen(self, phrases: Sequence[str], rarest: int = RAREST) -> list[list[str]]:
        """Of every phrase the trigrams to look up, the rarest first; phrases with a trigram that no text holds are left out.

        A list so many times longer than the shortest is not worth reading: the text is checked anyway.
        """
        wanted = [pieces(p) for p in phrases if len(p) >= 3]
        counts = self.trigram_counts(list(dict.fromkeys(t for ts in wanted for t in ts))) if wanted else {}
        out = []
        for trigrams in wanted:
            if all(t in counts for t in trigrams):
                first = sorted(trigrams, key=lambda t: (counts[t], t))[:rarest]
                out.append([t for t in first if counts[t] <= LONGER * counts[first[0]]])
        return out

    def candidates(self, phrases: Sequence[str], rarest: int = RAREST) -> DataFrame:
        """(key): rows that hold the chosen trigrams of a phrase of three characters or more; each at least once."""
        chosen = self.chosen(phrases, rarest)
        all_of = list(dict.fromkeys(t for ts in chosen for t in ts))
        if not chosen:
            return self.postings.where("false").select(self.key)
        at = sorted({part_of(t, self.parts) for t in all_of})
        rows = self.postings.where(F.col("part").isin(at) & F.col("trigram").isin(all_of))
        if all(len(ts) == 1 for ts in chosen):
            return rows.select(self.key)
        has = {t: F.bool_or(F.col("trigram") == t).alias(f"t{k}") for k, t in enumerate(all_of)}
        met = rows.groupBy(self.key).agg(*has.values())
        name = {t: f"t{k}" for k, t in enumerate(all_of)}
        both = [reduce(lambda a, b: a & b, [F.col(name[t]) for t in ts]) for ts in chosen]
        return met.where(reduce(lambda a, b: a | b, both)).select(self.key)

    def find(self, phrases: Sequence[str]) -> DataFrame:
        """(phrase, key): every row whose text holds the phrase in any field; an empty phrase is in every non-null field.

        What the trigrams leave is checked on the texts, all phrases at once. Phrases shorter than a trigram are looked for in
        all texts. Phrases are asked ``AT_ONCE`` together.
        """
        phrases = list(dict.fromkeys(phrases))
        long_ones, short = [p for p in phrases if len(p) >= 3], [p for p in phrases if len(p) < 3]
        out = [self._checked(self._rows_of(long_ones[k:k + AT_ONCE]), long_ones[k:k + AT_ONCE]) for k in range(0, len(long_ones), AT_ONCE)]
        if short or not phrases:
            out.append(self._checked(self.texts, short))
        return reduce(DataFrame.unionByName, out)

    def _rows_of(self, phrases: Sequence[str]) -> DataFrame:
        """The texts of the candidates: fetched by key while they are few, else joined."""
        found = self.candidates(phrases)
        few = [r[0] for r in found.limit(FETCH_KEYS + 1).collect()]
        if len(few) > FETCH_KEYS:
            return self.texts.join(found, self.key, "left_semi")
        at = sorted({part_of(str(k), self.slots) for k in few})
        return self.texts.where(F.col("slot").isin(at) & F.col(self.key).isin(few)) if few else self.texts.where("false")

    def _checked(self, rows: DataFrame, phrases: Sequence[str]) -> DataFrame:
        held = F.array_compact(F.array(*[F.when(self._holds(F.lit(p)), F.lit(p)) for p in phrases]).cast("array<string>"))
        return rows.select(F.explode(held).alias("phrase"), self.key)

    def _holds(self, phrase: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.col(c), phrase), F.lit(False)) for c in self.fields])


def build_index(df: DataFrame, key: str, fields: Sequence[str], path: str, parts: int = PARTS, slots: int = SLOTS) -> TextIndex:
    """Writes the index of ``fields`` of ``df`` (one row per ``key``) below ``path`` and opens it."""
    fields, spark = tuple(fields), df.sparkSession
    rows = df.select(key, *[F.col(c).cast("string").alias(c) for c in fields])
    # texts go first, so that the trigrams are taken from evenly dealt files, once
    texts = settle(rows.withColumn("slot", _part(F.col(key), slots)).repartition(key), "texts")
    # as with the postings, the key is part of the range: tasks and files follow the size of the texts, not the number of slots
    texts.repartitionByRange("slot", key).sortWithinPartitions("slot", key).write.partitionBy("slot").parquet(f"{path}/texts")
    found = F.flatten(F.array(*[F.coalesce(trigrams_of(F.col(c)), F.array().cast("array<string>")) for c in fields]))
    postings = texts.select(F.explode(F.array_distinct(found)).alias("trigram"), key).withColumn("part", _part(F.col("trigram"), parts))
    # the key is part of the range, so a trigram that most rows hold is cut into several files
    (settle(postings, "postings").repartitionByRange("part", "trigram", key).sortWithinPartitions("part", "trigram", key)
     .write.partitionBy("part").parquet(f"{path}/postings"))
    counts = spark.read.parquet(f"{path}/postings").groupBy("part", "trigram").agg(F.count("*").alias("n"))
    counts.repartition("part").sortWithinPartitions("part", "trigram").write.partitionBy("part").parquet(f"{path}/counts")
    return open_index(spark, path, key, fields, parts, slots)


def open_index(spark: SparkSession, path: str, key: str, fields: Sequence[str], parts: int = PARTS, slots: int = SLOTS) -> TextIndex:
    texts, postings, counts = (spark.read.parquet(f"{path}/{t}") for t in ("texts", "postings", "counts"))
    return TextIndex(key, tuple(fields), texts, postings, counts, parts, slots)
