"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a bounded sample of its labelled text. A text is parsed into the
longest phrases that the sample holds; N phrases of a sample of n bytes cost about N * log2(n) bits, and the language
with the fewest bits per byte of text wins. The parse runs byte by byte over many pieces of text side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from .workers import large, map_batches

#: the sample of a language: so many of the pieces of so many characters that its labelled texts are cut into
SAMPLE_PIECES, SAMPLE_CHARS = 128, 256
#: a text is parsed in pieces of so many bytes, so many at a time
PIECE_BYTES, PIECES_AT_ONCE = 512, 16_384
UNKNOWN = "und"

OUT = "doc_id long, lang_pred string, score double"
#: ASCII other than letters separates words, as does all white space
WORDS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)).lower()


def cleaned(text: str | None) -> bytes:
    """Lower-case UTF-8 words with single spaces around them; empty if the text has no letter."""
    if not text:
        return b""
    words = b" ".join(text.lower().encode().translate(WORDS_ONLY).split())
    if not words or not any(map(str.isalpha, words.decode())):
        return b""
    return b" " + words + b" "


def sample(documents: DataFrame) -> DataFrame:
    """(lang, piece): per language up to SAMPLE_PIECES pieces of all its labelled texts, those that hash lowest.

    Every text is cut into pieces of SAMPLE_CHARS from its beginning to its end, and each piece may be drawn, so long texts are
    as likely to be heard in their middle as at their start. Spark keeps only that many rows per language and task before
    anything is shuffled.
    """
    last = F.greatest(F.lit(0), F.floor((F.char_length("text") - 1) / SAMPLE_CHARS)).cast("int")
    known = documents.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "doc_id", "text", F.explode(F.sequence(F.lit(0), last)).alias("_i"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_at", "doc_id", "_i"))
    rows = known.select("lang", "doc_id", "_i", F.xxhash64("doc_id", "_i").alias("_at"), F.substring("text", F.col("_i") * SAMPLE_CHARS + 1, F.lit(SAMPLE_CHARS)).alias("piece"))
    return rows.where(F.trim("piece") != "").withColumn("_nth", nth).where(F.col("_nth") <= SAMPLE_PIECES).select("lang", "piece")


def automaton(data: bytes):
    """Transitions of the suffix automaton of ``data`` as (symbol of each byte, table of states x symbols); -1: none.

    Byte 0 stands between pieces and is not a symbol of any text.
    """
    import numpy as np

    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in follow[p]:
            follow[p][c] = state
            p = link[p]
        if p != -1:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    used = sorted(set(data) - {0})
    symbol = np.zeros(256, np.uint8)  # 0: a byte that the sample lacks
    symbol[used] = np.arange(1, len(used) + 1)
    table = np.full((len(follow), len(used) + 1), -1, np.int32)
    for state, edges in enumerate(follow):
        for c, to in edges.items():
            if c:
                table[state, symbol[c]] = to
    return symbol, table


@large(maxsize=4)
def _automata(samples: tuple[tuple[str, bytes], ...]):
    return [automaton(data) for _, data in samples]


def phrases(pieces, lengths, model):
    """Number of longest-match phrases of each piece: ``pieces`` holds them as columns, longest first."""
    import numpy as np

    symbol, table = model
    width, flat, root = table.shape[1], table.ravel(), table[0]
    coded = symbol[pieces]
    state, count = np.zeros(len(lengths), np.int32), np.zeros(len(lengths), np.int64)
    alive = len(lengths)
    for j in range(len(coded)):
        while alive and lengths[alive - 1] <= j:
            alive -= 1
        c = coded[j, :alive]
        to = flat[state[:alive] * width + c]
        missed = np.flatnonzero(to < 0)
        if len(missed):
            # the phrase so far ends here, and the byte begins the next one; a byte that the sample lacks is one by itself
            begin = root[c[missed]]
            count[missed] += (state[missed] > 0).astype(np.int64) + (begin < 0)
            to[missed] = np.maximum(begin, 0)
        state[:alive] = to
    return count + (state > 0)


def _costs(texts: list[bytes], samples):
    """Bits per byte of each text under each language."""
    import numpy as np

    owner = np.repeat(np.arange(len(texts)), [-(-len(t) // PIECE_BYTES) for t in texts])
    cut = [t[k:k + PIECE_BYTES] for t in texts for k in range(0, len(t), PIECE_BYTES)]
    total = np.zeros((len(samples), len(texts)))
    for k in range(0, len(cut), PIECES_AT_ONCE):
        part, own = cut[k:k + PIECES_AT_ONCE], owner[k:k + PIECES_AT_ONCE]
        lengths = np.array([len(p) for p in part])
        order = np.argsort(-lengths, kind="stable")
        padded = np.frombuffer(b"".join(p.ljust(PIECE_BYTES, b"\0") for p in part), np.uint8).reshape(-1, PIECE_BYTES)
        columns = np.ascontiguousarray(padded[order].T)[:lengths.max()]
        for n, model in enumerate(_automata(samples)):
            np.add.at(total[n], own[order], phrases(columns, lengths[order], model))
    bits = np.array([np.log2(max(2, len(data))) for _, data in samples])
    return total * bits[:, None] / np.maximum(1, [len(t) for t in texts])


def identify(documents: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0 to 1: how much dearer the second language is).

    ``labelled`` (doc_id, text, lang) is what is learned from; null languages and null texts are left out. A text that
    is null or has no letter is ``und`` with score 0, as is every text if there is nothing to learn from; with one
    language that one is predicted with score 1. Equal costs go to the name that sorts first. Rows that repeat a doc_id,
    or have none, are judged one by one. An empty table gives no rows; further columns are ignored.
    """
    known: dict[str, list[bytes]] = {}
    for row in sample(labelled).collect():  # bounded: SAMPLE_PIECES short pieces per language
        known.setdefault(row["lang"], []).append(cleaned(row["piece"]))
    samples = tuple((lang, b"\0".join(sorted(x for x in pieces if x))) for lang, pieces in sorted(known.items()) if any(pieces))

    def judged(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = [cleaned(t) for t in batch.column("text").to_pylist()]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if samples and texts:
                costs = _costs(texts, samples)
                best = costs.argmin(axis=0)
                ranked = np.sort(costs, axis=0)
                for k, t in enumerate(texts):
                    if t:
                        names[k] = samples[best[k]][0]
                        scores[k] = 1.0 - ranked[0, k] / ranked[1, k] if len(samples) > 1 else 1.0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return map_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), judged, OUT, keeps="_automata")
