"""Token ids of whole texts through the tokenizers library, one encoding per distinct word.

For a tokenizer whose splits never hold white space, the ids of a text are those
of its words in turn. Each worker keeps the ids of the words it has met, up to a
fixed number, so a frequent word is encoded once. Words of plain letters, with
closing signs, go straight to the model; all others through the whole library.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from glossarion.llm._bytes import spans

#: Words, and word parts, that a worker keeps; beyond it they are forgotten and learned anew.
MAX_WORDS, MAX_PIECES = 150_000, 300_000
#: Bytes of words that a worker keeps; a single call's words may be more.
MAX_BYTES = 1 << 25

PLAIN = r"^(?P<head>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-&(-/:-@\[-`{-~]*)$"


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: visible Latin-1
    characters stand for themselves, the others in turn for U+0100 and up."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in visible:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class WordIds:
    """``by_word``: the tokenizer splits at white space, folds case and keeps letter runs and sign
    runs apart (checked when loaded); else every word goes through the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.clear()
        probe = "The quick fox, jumped; over 12 dogs -- don't ÜBER café!"
        parts = [i for w in probe.split() for i in self.tokenizer.encode(w, add_special_tokens=False).ids]
        if parts != self.tokenizer.encode(probe, add_special_tokens=False).ids:
            raise ValueError("this tokenizer's ids depend on the white space around words")
        self.fast = True
        for w in ("Hello,", "ÜBER", "a", "straße!!", "x%%%", "Été"):
            self.fast &= self.encode(pa.array([w]))[0].tolist() == self.tokenizer.encode(w, add_special_tokens=False).ids
        self.clear()

    def clear(self, words_only: bool = False) -> None:
        # known words and pieces are Arrow arrays: they are looked up, and held, without a Python object for each
        self.words = pa.array([""])
        if words_only:
            return
        self.pieces, self.piece_places = pa.array([""]), np.zeros(1, np.int64)
        self.long: dict[int, np.ndarray] = {}  # words of very many ids
        self.fresh: list[int] = []
        self.places = np.zeros((1 << 16, 2), np.int64)
        self.pool, self.used = np.zeros(1 << 18, np.uint32), 0

    def _pieces(self, col: pa.Array) -> np.ndarray:
        """For each piece its place in the pool, and in the low 16 bits the number of its ids; 0 for an empty one."""
        coded, letters, tokenize = col.dictionary_encode(), self.letters, self.model.tokenize
        at = pc.index_in(coded.dictionary, value_set=self.pieces)
        if at.null_count:
            new = coded.dictionary.filter(at.is_null())
            words = [p if p.isascii() else "".join([letters[b] for b in p.encode()]) for p in new.to_pylist()]
            ids = [[t.id for t in tokenize(w)] for w in words]
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            places = (self.used + len(self.fresh) + np.cumsum(lens) - lens) << 16 | lens
            self.fresh += chain.from_iterable(ids)
            at = at.fill_null(-1).to_numpy(zero_copy_only=False).copy()
            at[at < 0] = len(self.pieces) + np.arange(len(ids))
            self.pieces, self.piece_places = pa.concat_arrays([self.pieces, new]), np.concatenate([self.piece_places, places])
        return self.piece_places[np.asarray(at)[coded.indices.to_numpy(zero_copy_only=False)]]

    def _place(self, ids: list[int]) -> int:
        at = self.used + len(self.fresh)
        self.fresh += ids
        return at << 16 | len(ids)

    def _learn(self, words: pa.Array) -> None:
        """Places of new words: of the letters and of the closing signs, or of the whole word in pieces of 65,535 ids."""
        n, new = len(self.words), len(words)
        places = np.zeros((new, 2), np.int64)
        plain = np.zeros(new, bool)
        if self.fast:
            parts = pc.extract_regex(words, PLAIN)
            plain = np.asarray(parts.is_valid()) & (pc.utf8_length(words).to_numpy(zero_copy_only=False) < 10_000)
            parts = parts.filter(pa.array(plain))
            places[plain, 0] = self._pieces(pc.utf8_lower(parts.field("head")))
            places[plain, 1] = self._pieces(parts.field("tail"))
        odd = np.flatnonzero(~plain)
        for i, e in zip(odd.tolist(), self.tokenizer.encode_batch(words.take(pa.array(odd)).to_pylist(), add_special_tokens=False), strict=True):
            ids = e.ids
            if len(ids) > 120_000:
                self.long[n + i] = np.array(ids, np.uint32)
                continue
            places[i] = self._place(ids[:60_000]), self._place(ids[60_000:])
        while self.used + len(self.fresh) > len(self.pool):
            self.pool = np.concatenate([self.pool, self.pool])
        self.pool[self.used : self.used + len(self.fresh)] = self.fresh
        self.used += len(self.fresh)
        self.fresh = []
        while n + new > len(self.places):
            self.places = np.concatenate([self.places, self.places])
        self.places[n : n + new] = places
        self.words = pa.concat_arrays([self.words, words])

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text); a null is empty."""
        if not pa.types.is_string(col.type):
            col = col.cast(pa.string())
        if col.null_count:
            col = col.fill_null("")
        split = pc.ascii_split_whitespace(col)
        coded = split.values.dictionary_encode() if split.offset == 0 else split.flatten().dictionary_encode()
        if len(self.words) + len(coded.dictionary) > MAX_WORDS or self.words.nbytes > MAX_BYTES:
            self.clear(len(self.pieces) < MAX_PIECES and not self.long and self.used < 8 * MAX_PIECES)
        at = pc.index_in(coded.dictionary, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            n = len(self.words)
            self._learn(coded.dictionary.take(pa.array(missing)))
            at[missing] = np.arange(n, n + len(missing))
        at = at[coded.indices.to_numpy(zero_copy_only=False)]
        places = self.places[at].ravel()
        parts = places & 0xFFFF
        lens = parts[0::2] + parts[1::2]
        if self.long and len(found := np.flatnonzero(np.isin(at, list(self.long)))):
            pool = np.concatenate([self.pool, *self.long.values()])
            ends = len(self.pool) + np.cumsum([len(x) for x in self.long.values()])
            begin = dict(zip(self.long, ends - [len(x) for x in self.long.values()], strict=True))
            starts = places >> 16
            for k in found:
                starts[2 * k], parts[2 * k], lens[k] = begin[at[k]], len(self.long[at[k]]), len(self.long[at[k]])
            ids = pool[spans(starts, parts)]
        else:
            ids = self.pool[spans(places >> 16, parts)]
        bounds = np.concatenate([[0], np.cumsum(lens)])[np.asarray(split.offsets, np.int64) - split.offsets[0].as_py()]
        return ids, np.diff(bounds)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """The worker's own instance: it outlives a task."""
    return WordIds(path)
