"""Token ids of whole texts with a public tokenizer, at the cost of the distinct pieces.

The tokenizer drops white space and never joins characters across it: normalisation, splitting and merges all stay
inside a word that ASCII white space delimits. A word of plain Latin letters, digits and signs is further cut, as the
tokenizer does, into runs of letters, single digits, runs of signs and ends like 's; any other word stays whole and as it
is. So a text's ids are the ids of these pieces in order. Pieces are cut and told apart by whole columns, never one by one,
and each worker keeps the ids of those it has met in two Arrow columns; only new ones go to the tokenizer. ``tests/llm``
holds all this against encoding whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

from .workers import large

VOCABULARY = "word_bpe_49k.json"
#: pieces whose ids a worker keeps, and the bytes of the longest; beyond that it starts afresh, so its memory stays bounded
CACHE_WORDS, LONGEST = 300_000, 48
#: texts of so many bytes are looked up together, and longer ones in parts of that size
BYTES_AT_ONCE = 1 << 21

#: pieces that the tokenizer gets as one text
TOGETHER = 256

BLANK = re.compile(rb"[\x20\x09-\x0D]")
SPECIAL = b"<|"
#: the first of the two bytes of a letter À to ÿ
LATIN = b"\xc3"
#: kinds of bytes
SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
KINDS = bytes(SPACE if BLANK.match(c) else LETTER if c.isalpha() else DIGIT if c.isdigit() else SIGN if b"!" <= c <= b"~" else OTHER
              for c in (bytes([k]) for k in range(256)))
LOWER = bytes(range(256)).lower()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _ends_like_s(low, kinds):
    """First and next-to-last place of each 's 't 're 've 'm 'll 'd; the tokenizer sees one only where no run of signs goes on."""
    import numpy as np

    at = np.flatnonzero(low == ord("'"))
    at = at[kinds[at - 1] != SIGN]
    one, two = low[at + 1], low[at + 2]
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    found = long | np.isin(one, np.frombuffer(b"stmd", np.uint8))
    return at[found], at[found] + 2 + long[found]


def _pieces(texts: Sequence[bytes]):
    """The pieces of all texts as one Arrow column, which of them are whole odd words, and how many end by the end of each text."""
    import numpy as np
    import pyarrow as pa

    joined = b" ".join([b"", *texts, b"", b""])  # blanks on both sides, so that each byte has neighbours
    raw, kinds = np.frombuffer(joined, np.uint8), np.frombuffer(joined.translate(KINDS), np.uint8)
    low = np.frombuffer(joined.translate(LOWER), np.uint8)
    if LATIN in joined:
        kinds, low = kinds.copy(), low.copy()
        at = np.flatnonzero(raw == LATIN[0])
        code = raw[at + 1] & 0x3F
        letter = code & 0x1F != 0x17  # all but the signs of multiplication and division
        kinds[at[letter]] = kinds[at[letter] + 1] = LETTER
        low[at[letter & (code < 0x1F)] + 1] |= 0x20
    filled = kinds != SPACE
    first = np.zeros(len(raw), bool)
    np.not_equal(kinds[1:], kinds[:-1], out=first[1:])
    first |= kinds == DIGIT
    if b"'" in joined:
        begin, end = _ends_like_s(low, kinds)
        first[begin + 1] = False
        first[end] = True
    first &= filled
    inside = np.zeros(len(raw), np.int8)
    odd = kinds == OTHER
    if SPECIAL in joined:
        odd[:-1] |= (raw[:-1] == SPECIAL[0]) & (raw[1:] == SPECIAL[1])
    if odd.any():
        edges = np.flatnonzero(filled[1:] != filled[:-1]) + 1  # begin and end of each word in turn
        words = np.unique(np.searchsorted(edges, np.flatnonzero(odd), "right") - 1)
        inside[edges[words]], inside[edges[words + 1]] = 1, -1
        inside = np.cumsum(inside, dtype=np.int8)
        first[inside == 1] = False
        first[edges[words]] = True
        low = np.where(inside == 1, raw, low)
    starts = np.flatnonzero(first)
    ends = np.cumsum([len(t) + 1 for t in texts])
    before = np.searchsorted(starts, ends)
    places = np.cumsum(filled, dtype=np.int32)
    offsets = np.append(places[starts] - 1, places[-1]).astype(np.int32)
    column = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(low[filled])])
    return column, inside[starts] == 1, before


class WordEncoder:
    """Encodes UTF-8 texts to little-endian ids of ``width`` bytes each."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        import numpy as np
        import pyarrow as pa
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.cache_words = cache_words
        self.known = self.ids = pa.array([], pa.binary())
        # the same model for pieces that are cut and lower-case already
        self.of_pieces = Tokenizer(self.tokenizer.model)
        self.of_pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.tokenizer.get_vocab_size()
        self.closes = np.fromiter(((self.tokenizer.id_to_token(k) or "").endswith("</w>") for k in range(size)), bool, size)

    def _whole(self, texts: list[str]) -> list[bytes]:
        from array import array

        kind = "H" if self.width == 2 else "I"
        return [array(kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _split(self, pieces) -> list:
        """The same for a column of pieces, many in one text: the last id of each is one that closes a piece."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        out = []
        cuts = np.append(np.arange(0, len(pieces), TOGETHER), len(pieces))
        runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pieces.cast(pa.string())), " ").to_pylist()
        for begin, end, e in zip(cuts, cuts[1:], self.of_pieces.encode_batch_fast(runs, add_special_tokens=False)):
            ids = np.array(e.ids, f"<u{self.width}")
            ends = (np.flatnonzero(self.closes[ids]) + 1) * self.width
            if len(ends) == end - begin and ends[-1] == ids.nbytes:
                offsets = np.append(0, ends).astype(np.int32)
                out.append(pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]))
            else:
                out.append(pa.array(self._whole(pieces[begin:end].cast(pa.string()).to_pylist()), pa.binary()))
        return out

    def _learn(self, pieces, odd):
        """Ids of a column of pieces that are not known; those that are ``odd`` go to the tokenizer as they are."""
        import numpy as np
        import pyarrow as pa

        plain, other = pieces.filter(pa.array(~odd)), pieces.filter(pa.array(odd)).cast(pa.string())
        where = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
        return pa.concat_arrays([*self._split(plain), pa.array(self._whole(other.to_pylist()), pa.binary())]).take(pa.array(where))

    def _together(self, texts: Sequence[bytes]) -> list[bytes]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        pieces, whole, before = _pieces(texts)
        if not len(pieces):
            return [b""] * len(texts)
        pieces = pieces.dictionary_encode()
        met, pieces = pieces.dictionary, pieces.indices
        at = pc.index_in(met, value_set=self.known)
        if at.null_count:
            odd = np.zeros(len(met), bool)
            odd[pieces] = whole
            at = np.array(at.fill_null(-1))
            new = met.filter(pa.array(at < 0))
            ids = pa.concat_arrays([self.ids, self._learn(new, odd[at < 0])])
            at[at < 0] = np.arange(len(self.ids), len(ids))
            met_ids = ids.take(pa.array(at))
            if len(ids) <= self.cache_words:
                known = pa.concat_arrays([self.known, new])
            else:
                known, ids = met, met_ids
            short = pc.less_equal(pc.binary_length(known), LONGEST)
            self.known, self.ids = known.filter(short), ids.filter(short)
        else:
            met_ids = self.ids.take(at)
        ids = met_ids.take(pieces)
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int32, len(ids) + 1)[before].tolist()
        data = memoryview(data)
        return [bytes(data[i:j]) for i, j in zip([0, *ends], ends)]

    def _long(self, text: bytes) -> Iterator[bytes]:
        begin = 0
        while begin < len(text):
            blank = BLANK.search(text, begin + BYTES_AT_ONCE)
            end = blank.start() if blank else len(text)
            yield self._together([text[begin:end]])[0]
            begin = end

    def encode(self, texts: Sequence[bytes]) -> list[bytes]:
        out: list[bytes] = []
        k = 0
        while k < len(texts):
            end, size = k + 1, len(texts[k])
            while end < len(texts) and size + len(texts[end]) <= BYTES_AT_ONCE:
                size += len(texts[end])
                end += 1
            out += self._together(texts[k:end]) if size <= BYTES_AT_ONCE else [b"".join(self._long(texts[k]))]
            k = end
        return out


@large(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per worker process and vocabulary, as long as the worker's tasks encode."""
    return WordEncoder(path)
