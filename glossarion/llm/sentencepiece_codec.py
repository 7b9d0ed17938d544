"""SentencePiece models run by the tokenizers library.

The model's protobuf is read by its wire format; from it come the normaliser, the
metaspace marker, unigram scores or BPE merges, and byte fallback. A text splits
into chunks (white space and the run after it) where no piece of the vocabulary can
cross; each worker keeps the ids of the chunks it has met, up to a fixed number,
and encodes the others in one multithreaded batch. Every new chunk is encoded by
the sentencepiece library as well; a document's ``parity`` says that all its chunks agree.
BPE chunks go to both libraries some tens in a string, as a call costs more than a chunk:
the pieces that begin with the marker show where each chunk's ids begin.

Null or empty text: no ids, parity and round trip hold. Repeated rows repeat.
An empty table gives no row.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarion.llm._bytes import slices, spans, string_buffers

MARK = "▁"
MAX_CHUNKS = 150_000
#: Chunks given to the libraries at once.
BATCH = 4096
#: Chunks in a string.
JOINED = 64
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    bpe: bool = False
    byte_fallback: bool = False
    suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    collapse: bool = True
    escape: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + n]
            at += n


def parse_model(data: bytes) -> Model:
    """The parts of a serialised model that encoding and decoding need."""
    m = Model()
    for number, value in _fields(data):
        if number == 1:
            got = dict(_fields(value))
            m.pieces.append((got.get(1, b"").decode(), struct.unpack("<f", got.get(2, bytes(4)))[0], got.get(3, NORMAL)))
        elif number == 2:
            got = dict(_fields(value))
            if got.get(3, 1) not in (1, 2):
                raise ValueError("only unigram and BPE models are supported")
            m.bpe, m.byte_fallback, m.suffix = got.get(3, 1) == 2, bool(got.get(35, 0)), bool(got.get(24, 0))
        elif number == 3:
            got = dict(_fields(value))
            m.charsmap, m.dummy_prefix, m.collapse, m.escape = got.get(2, b""), bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1))
    return m


def _merges(m: Model) -> list[tuple[str, str]]:
    """All ways to join two pieces into a third, by the third's score; of one piece by the parts' ids."""
    ids = {p: i for i, (p, _, _) in enumerate(m.pieces)}
    out = []
    for piece, score, kind in m.pieces:
        if kind in (NORMAL, USER):
            ways = [(ids[piece[:k]], ids[piece[k:]], piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids]
            out += [(-score, *w) for w in ways]
    out.sort(key=lambda x: x[0])
    return [(x[3], x[4]) for x in out]


def build_tokenizer(m: Model):
    """A tokenizers.Tokenizer with the model's normaliser and decoder."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = next(i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN)
    if m.bpe:
        model = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, _merges(m), unk_token=m.pieces[unknown][0], fuse_unk=True, byte_fallback=m.byte_fallback)
    else:
        model = models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=unknown, byte_fallback=m.byte_fallback)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.collapse:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    if m.escape:
        steps.append(normalizers.Replace(" ", MARK))
    t = Tokenizer(model)
    t.normalizer = normalizers.Sequence(steps)
    t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else [])])
    return t


class Decoder:
    """Ids to bytes; needs the parsed model alone."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.model = m = parse_model(f.read())
        raw = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else b" \xe2\x81\x87 " if k == UNKNOWN else p.replace(MARK, " ").encode() for p, _, k in m.pieces]
        self.piece_lens = np.array([len(x) for x in raw], np.int64)
        self.piece_at = np.cumsum(self.piece_lens) - self.piece_lens
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes of all texts, offsets), without the marker before a text."""
        n = self.piece_lens[ids]
        raw = self.piece_bytes[spans(self.piece_at[ids], n)]
        off = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(lens)])]
        if self.model.dummy_prefix:
            head = off[:-1][np.diff(off) > 0]
            head = head[raw[head] == 32]
            keep = np.ones(len(raw), bool)
            keep[head] = False
            gone = np.concatenate([[0], np.cumsum(~keep)])
            raw, off = raw[keep], off - gone[off]
        return raw, off


class Codec(Decoder):
    def __init__(self, path: str, threads: int = 1):
        super().__init__(path)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece
        from tokenizers import Tokenizer

        m = self.model
        self.tokenizer = build_tokenizer(m)
        self.bare = Tokenizer(self.tokenizer.model)
        self.other = sentencepiece.SentencePieceProcessor(model_file=path)
        #: No piece has the marker after another character: chunks are independent.
        self.chunked = m.escape and not m.suffix and not any(MARK in p.lstrip(MARK) for p, _, k in m.pieces if k in (NORMAL, USER)) and not any(k == USER for _, _, k in m.pieces)
        self.plain = self.chunked and not m.charsmap and not m.collapse and m.dummy_prefix
        #: Pieces that begin a chunk.
        self.opens = np.array([p.startswith(MARK) for p, _, _ in m.pieces], bool)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.lens, self.at, self.agree = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, bool)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(ids, number of ids of each chunk, whether both libraries agree) by strings of several chunks; None unless each
        chunk has one marker, at its beginning and not alone, and both libraries begin as many chunks as there are."""
        lines = ["".join(chunks[k : k + JOINED]) for k in range(0, len(chunks), JOINED)]
        if sum(x.count(MARK) for x in lines) != len(chunks) or not all(len(c) > 1 and c[0] == MARK for c in chunks):
            return None
        ours = np.fromiter(chain.from_iterable([e.ids for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)]), np.uint32)
        other = np.fromiter(chain.from_iterable(self.other.encode([x[1:].replace(MARK, " ") for x in lines])), np.uint32)
        begin, theirs = np.flatnonzero(self.opens[ours]), np.flatnonzero(self.opens[other])
        if len(begin) != len(chunks) or len(theirs) != len(chunks) or begin[0] or theirs[0]:
            return None
        lens = np.diff(begin, append=len(ours))
        if np.array_equal(ours, other):
            return ours, lens, np.ones(len(chunks), bool)
        agree = lens == np.diff(theirs, append=len(other))
        same = np.flatnonzero(agree)
        differs = ours[spans(begin[same], lens[same])] != other[spans(theirs[same], lens[same])]
        agree[np.repeat(same, lens[same])[differs]] = False
        return ours, lens, agree

    def _alone(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same, each chunk by itself."""
        ids = [e.ids for e in self.bare.encode_batch_fast(chunks, add_special_tokens=False)]
        if self.plain:
            one = [self.other.piece_to_id(MARK)]  # alone it cannot be asked for: an empty text has no marker
            both = self.other.encode([c[1:].replace(MARK, " ") if c[0] == MARK else c for c in chunks])
            agree = [a == b or c[0] != MARK or c == MARK and a == one for a, b, c in zip(ids, both, chunks, strict=True)]
        else:
            agree = [True] * len(ids)  # whole texts are compared instead
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)), np.array(agree, bool)

    def _learn(self, chunks: list[str]) -> None:
        """Ids of new chunks; in small batches, as the libraries' own results are large."""
        for k in range(0, len(chunks), BATCH):
            some = chunks[k : k + BATCH]
            ids, lens, agree = (self.plain and self.model.bpe and self._joined(some)) or self._alone(some)
            n, m, total = len(self.index), len(some), len(ids)
            while n + m > len(self.lens):
                self.lens, self.at, self.agree = (np.concatenate([x, x]) for x in (self.lens, self.at, self.agree))
            while self.used + total > len(self.pool):
                self.pool = np.concatenate([self.pool, self.pool])
            self.at[n : n + m] = self.used + np.cumsum(lens) - lens
            self.lens[n : n + m], self.agree[n : n + m] = lens, agree
            self.pool[self.used : self.used + total] = ids
            self.used += total
            self.index.update(zip(some, range(n, n + m)))

    def _lookup(self, chunks: list[str]) -> np.ndarray:
        if len(self.index) + len(chunks) > MAX_CHUNKS:
            self.clear()
        missing = [c for c in dict.fromkeys(chunks) if c not in self.index]
        if missing:
            self._learn(missing)
        return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids one text after another, number of ids, whether both libraries agree)."""
        if col.null_count:
            col = col.fill_null("")
        if not self.chunked:
            texts = col.to_pylist()
            ids = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            ids = [x if t else [] for x, t in zip(ids, texts, strict=True)]
            agree = np.array([a == b for a, b in zip(ids, self.other.encode(texts), strict=True)], bool)
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter((x for y in ids for x in y), np.uint32, int(lens.sum())), lens, agree
        if self.plain:
            marked = pc.replace_substring(pc.replace_substring(col, " ", " " + MARK), " ", "\0") if pc.any(pc.match_substring(col, "\0")).as_py() is not True else None
            if marked is not None:
                marked = pc.if_else(pc.equal(col, ""), "", pc.binary_join_element_wise(pa.scalar(MARK), marked, ""))
                split = pc.split_pattern(marked, "\0")
                chunks, counts = split.flatten(), np.diff(np.asarray(split.offsets, np.int64))
                coded = chunks.dictionary_encode()
                names = coded.dictionary.to_pylist()
                codes = coded.indices.to_numpy(zero_copy_only=False)
                odd = ((pc.count_substring(coded.dictionary, MARK).to_numpy() != 1) | (pc.utf8_length(coded.dictionary).to_numpy() < 2)) if len(names) else np.zeros(0, bool)
                rows = np.repeat(np.arange(len(col)), counts)
                bad = np.unique(rows[odd[codes]]) if odd.any() else np.zeros(0, np.int64)
                if len(bad):  # runs of spaces, spaces at an end, markers in the text: split those texts by the pattern
                    return self._by_pattern(col.to_pylist())
                at = self._lookup(names)[codes]
                return self._gather(at, counts)
        return self._by_pattern(col.to_pylist())

    def _by_pattern(self, texts: list[str]):
        normal = [self.tokenizer.normalizer.normalize_str(t) if t else "" for t in texts]
        chunks = [CHUNK.findall(t) for t in normal]
        at = self._lookup([c for x in chunks for c in x])
        ids, lens, agree = self._gather(at, np.fromiter(map(len, chunks), np.int64, len(chunks)))
        if not self.plain:
            bounds = np.concatenate([[0], np.cumsum(lens)])
            agree = np.array([ids[a:b].tolist() == x for a, b, x in zip(bounds[:-1], bounds[1:], self.other.encode(texts), strict=True)], bool)
        return ids, lens, agree

    def _gather(self, at: np.ndarray, counts: np.ndarray):
        lens, ends = self.lens[at], np.cumsum(counts)
        total = np.concatenate([[0], np.cumsum(lens)])
        wrong = np.concatenate([[0], np.cumsum(~self.agree[at])])
        return self.pool[spans(self.at[at], lens)], total[ends] - total[ends - counts], wrong[ends] == wrong[ends - counts]


@lru_cache(maxsize=2)
def codec(path: str, threads: int) -> Codec:
    return Codec(path, threads)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _encode(path: str, threads: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, threads)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids, lens, agree = coder.encode(part.column("text"))
                ends = np.concatenate([[0], np.cumsum(lens) * 4]).astype("<i4")
                raw = pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "text": part.column("text"), "n_tokens": lens, "ids": raw, "parity": agree})

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = decoder(path)
        for batch in batches:
            for part in slices(batch, "ids", 2 << 20):
                raw, off = string_buffers(part.column("ids"))
                ids = np.frombuffer(raw.tobytes(), "<u4").astype(np.int64)
                data, bounds = coder.decode(ids, np.diff(off) // 4)
                text = pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(bounds.astype("<i4").tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_pydict({n: part.column(n) for n in part.schema.names} | {"decoded": text})

    return run


def encode(docs: DataFrame, path: str, threads: int = 2) -> DataFrame:
    """doc_id, text, n_tokens, ids (little-endian 32-bit), parity with the sentencepiece library."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_encode(path, threads), "doc_id long, text string, n_tokens long, ids binary, parity boolean")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (any columns with ``ids``) with decoded: the texts' UTF-8 bytes."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(_decode(path), schema + ", decoded binary")
