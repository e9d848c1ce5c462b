"""Spelling variants by permuterm rotations.

A word is marked with a terminator and turned into all its rotations. Turned so that an edited character comes last, two words
that differ in it alone share the prefix before it; a word that lacks it has that prefix as a whole rotation. So with all
rotations sorted by prefix, the words of one prefix are each other's replacements, and the word that is the prefix itself is one
deletion away from them. A prefix names its words but for one character: no group has more rows than there are characters.

Every pair of near words meets in one group only (of equal characters in a row the first stands for the deletion), so a group
hands on one row per word: how many near words it has there, and the best of them. No pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle
from .lines import lower_ascii
from .workers import map_batches

RUN = r"[A-Za-zÀ-ÿ]+"
#: not in any run
END = "$"
MIN_CHARS = 6
MIN_COUNT = 5
#: a form is at least so many times as frequent
RATIO = 5
#: one of so many occurrences loses a character
TYPO_EVERY = 199

FOUND = "word string, n_near long, best_n long, best string"


def typed(doc_id: Column, run: Column, every: int = TYPO_EVERY) -> Column:
    """A lower-cased run as typed in a document: where ``every`` divides its checksum, one code point is missing."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % every == 0, short).otherwise(run)


def vocabulary(documents: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all texts of at least ``min_chars`` code points that occur at least ``min_count`` times."""
    text = F.col("text").cast("string")
    runs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= min_chars).withColumn("run", lower_ascii(F.col("run")))
    words = runs.select(typed(F.col("doc_id"), F.col("run")).alias("word")).where(F.char_length("word") >= min_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(word, n, prefix, last, leads): every rotation whole (``last`` empty), and without its last character where that is a letter.

    ``leads`` says that the character before the last one in the word is another one, so this is where its run begins.
    """
    size = F.char_length("word")
    marked = words.withColumn("i", F.explode(F.sequence(F.lit(0), size)))
    # i characters come behind the terminator; the last of them is the edited one
    turned = marked.withColumn("turned", F.concat(F.substring("word", F.col("i") + 1, size), F.lit(END), F.substring("word", F.lit(1), F.col("i"))))
    last = F.substring("word", F.col("i"), F.lit(1))
    leads = (F.col("i") == 1) | (F.substring("word", F.col("i") - 1, F.lit(1)) != last)
    whole = F.struct(F.col("turned").alias("prefix"), F.lit("").alias("last"), F.lit(True).alias("leads"))
    gap = F.struct(F.substring("turned", F.lit(1), size).alias("prefix"), last.alias("last"), leads.alias("leads"))
    both = F.when(F.col("i") > 0, F.array(whole, gap)).otherwise(F.array(whole))
    return turned.select("word", "n", F.explode(both).alias("r")).select("word", "n", "r.prefix", "r.last", "r.leads")


def _better(a, b):
    return a if b is None or a is not None and (-a[0], a[1]) <= (-b[0], b[1]) else b


def group_rows(group: list[tuple]) -> list[tuple]:
    """(word, n_near, best_n, best) for the (word, n, last, leads) rows of one prefix."""
    whole = next(((n, w) for w, n, last, _ in group if not last), None)
    gaps = [(w, n, leads) for w, n, last, leads in group if last]
    ranked = sorted(((n, w) for w, n, _ in gaps), key=lambda x: (-x[0], x[1]))[:2]
    out = []
    for w, n, leads in gaps:
        other = next((x for x in ranked if x[1] != w), None)
        best = _better(other, whole) if leads else other
        count = len(gaps) - 1 + bool(leads and whole)
        if count:
            out.append((w, count, *best))
    near = [(n, w) for w, n, leads in gaps if leads]
    if whole and near:
        out.append((whole[1], len(near), *min(near, key=lambda x: (-x[0], x[1]))))
    return out


def _scanned(batches):
    """A mapInArrow function over rotations sorted by prefix."""
    import pyarrow as pa

    def made(rows):
        words, counts, best_n, best = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.string())],
                                          names=["word", "n_near", "best_n", "best"])

    at, group, out = None, [], []
    for batch in batches:
        for prefix, word, n, last, leads in zip(*(batch.column(c).to_pylist() for c in ("prefix", "word", "n", "last", "leads"))):
            if prefix != at:
                if len(group) > 1:
                    out += group_rows(group)
                at, group = prefix, []
            group.append((word, n, last, leads))
        if len(out) > 10_000:
            yield made(out)
            out = []
    if len(group) > 1:
        out += group_rows(group)
    if out:
        yield made(out)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): words with near ones, how many, and the most frequent of them (the first of equals)."""
    turned = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", "last")
    found = map_batches(turned.select("prefix", "word", "n", "last", "leads"), _scanned, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    grouped = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return grouped.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that the forms lead to. Each round doubles the steps taken.

    A form is RATIO times as frequent as its word, so no chain is longer than the logarithm of the corpus.
    """
    now = settle(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = settle(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def spelling_variants(documents: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters with A-Z lower-cased, counted over all texts; some occurrences lose a character by a
    checksum of document and word (``typed``; a null doc_id counts as empty there). Two words are near if exactly one inserted,
    deleted or replaced code point tells them apart. A word's form is its most frequent near word (of equals the first in
    code-point order) if that is at least ``ratio`` times as frequent; its root is the end of its forms, or itself. A null or
    empty text has no words; rows that repeat count each time. An empty table gives no rows; further columns are ignored.
    """
    words = settle(vocabulary(documents, min_chars, min_count), "words")
    near = settle(neighbours(words), "near")
    rows = words.join(near, "word", "left")
    better = F.col("best_n") >= F.col("n") * ratio
    rows = settle(rows.select("word", F.when(better, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(better, F.col("best_n")).alias("form_n")), "variants")
    ends = roots(rows.where("form IS NOT NULL").select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
