"""Token ids in grammar-compressed files (Re-Pair), with random access.

A file holds blocks. A block holds whole documents: their ids and lengths, the
rules of its grammar, the expansion length of every symbol and the sequence of
symbols, with the number of ids before every 1024th of them. In each round the most
frequent pairs of neighbouring symbols become new symbols; a pair overlapping the pair
before it waits. Rounds go on until no pair is frequent. The container is
Parquet written by Spark, so any store that Spark writes will do, and a lost
executor's part is written again.

Null text: an empty document. A null ``doc_id`` sorts first. Equal ids keep
all their rows, one after another. An empty table gives an empty store.
Columns beyond ``doc_id`` and ``text`` are not read, so no name can clash. A very long
text is one document of one block, whose size it sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarion.llm._bytes import slices, spans
from glossarion.llm.wordids import word_ids

BLOCK_TOKENS = 1 << 19
#: Symbols between two places of which a block stores how many ids come before.
MARK = 1 << 10
#: Bits of a hash slot of pairs.
SLOTS = 18
STORE_SCHEMA = "part int, block int, start long, n_tokens long, has_id binary, doc_ids binary, doc_lens binary, first_rule int, rules binary, rule_lens binary, width int, symbols binary, marks binary"
READ_SCHEMA = "part int, doc_id long, start long, n_tokens long, ids binary"


def compress(ids: np.ndarray, per_round: int = 4096, least: int = 16) -> tuple[int, np.ndarray, np.ndarray]:
    """(first nonterminal, rules as pairs, symbols), once no pair occurs ``least`` times.

    A round puts pairs into hash slots, counts the last pair of each frequent slot, and replaces the
    ``per_round`` most frequent. Another round has another hash; if none of its slots shows a
    frequent pair though some are full, pairs in full slots are sorted and counted. A pair of
    symbols that are there already can only become rarer, so after the first round only pairs that
    were frequent, and those of a symbol just made, are looked at.
    """
    seq = ids.astype(np.uint32)
    first = int(seq.max()) + 1 if len(seq) else 0
    rules: list[np.ndarray] = []
    top, turn, held = first, 0, np.zeros(1 << SLOTS, np.uint64)
    place_of = np.full(1 << SLOTS, -1, np.int32)
    at = np.arange(max(0, len(seq) - 1))
    while len(at):
        turn += 1
        # 32-bit arithmetic and few passes: a block's arrays are larger than the processor's cache
        left, right = seq[at], seq[at + 1]
        slot = left * np.uint32(0x9E3779B1 + 2 * turn) + right * np.uint32(0x85EBCA6B)
        slot ^= slot >> np.uint32(15)
        slot *= np.uint32(0x2C1B3C6D)
        slot >>= np.uint32(32 - SLOTS)
        slot = slot.view(np.int32)
        full = np.flatnonzero((np.bincount(slot, minlength=1 << SLOTS) >= least)[slot])
        if not len(full):
            break
        at, slot = at[full], slot[full]
        pair = (left[full].astype(np.uint64) << np.uint64(32)) | right[full]
        held[slot] = pair
        mine = held[slot] == pair
        counts = np.bincount(slot[mine], minlength=1 << SLOTS)
        best = np.flatnonzero(counts >= least)
        if len(best):
            best = best[np.argsort(-counts[best], kind="stable")[:per_round]]
            chosen = held[best]
            place_of[best] = np.arange(len(best))
            place = np.where(mine, place_of[slot], -1)
            place_of[best] = -1
        else:
            kinds, n = np.unique(pair, return_counts=True)
            best = np.argsort(-n, kind="stable")[:per_round]
            chosen = np.sort(kinds[best[n[best] >= least]])
            if not len(chosen):
                break
            place = np.minimum(np.searchsorted(chosen, pair), len(chosen) - 1)
            place[chosen[place] != pair] = -1
        look = np.zeros(len(seq), bool)
        look[at] = True
        at, place = at[place >= 0], place[place >= 0]
        run = np.concatenate([[True], np.diff(at) > 1])
        begin = at[run][np.cumsum(run) - 1]
        keep = (at - begin) % 2 == 0
        at, place = at[keep], place[keep]
        seq[at] = top + place
        look[at] = True
        look[at[at > 0] - 1] = True
        stays = np.ones(len(seq), bool)
        stays[at + 1] = False
        # a symbol before one just made may stand two places before it
        look[at[at > 1] - 2] |= ~stays[at[at > 1] - 1]
        seq, look = seq[stays], look[stays]
        at = np.flatnonzero(look[:-1])
        rules.append(np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        top += len(chosen)
    return first, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), seq


def expansion_lengths(first: int, rules: np.ndarray) -> np.ndarray:
    """How many ids each rule stands for; a rule names only ids and rules before it."""
    lens: list[int] = []
    for a, b in rules.tolist():
        lens.append((lens[a - first] if a >= first else 1) + (lens[b - first] if b >= first else 1))
    return np.array(lens, np.int64)


class Grammar:
    """Decodes one block, or any range of its ids, by the stored expansion lengths.

    ``marks``: the ids before each ``MARK``-th symbol. A range reads the symbols between the
    marks around it and expands those that cover it, and only the rules that these name.
    """

    def __init__(self, first: int, rules: np.ndarray, symbols: np.ndarray, lens: np.ndarray | None = None, marks: np.ndarray | None = None):
        self.first, self.rules, self.symbols = first, rules, symbols
        self.lens = expansion_lengths(first, rules) if lens is None else lens.astype(np.int64)
        self.marks = self.marks_of(first, self.lens, symbols) if marks is None else marks.astype(np.int64)

    @staticmethod
    def marks_of(first: int, lens: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        n = np.ones(len(symbols), np.int64)
        n[symbols >= first] = lens[symbols[symbols >= first] - first]
        return np.concatenate([[0], np.cumsum(n)])[:-1:MARK] if len(n) else np.zeros(0, np.int64)

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        out = symbols.astype(np.uint32)
        while (big := out >= self.first).any():
            n = 1 + big.astype(np.int64)
            ends, rule = np.cumsum(n), self.rules[out[big] - self.first]
            longer = np.empty(int(ends[-1]), np.uint32)
            longer[(ends - n)[~big]] = out[~big]
            at = (ends - n)[big]
            longer[at], longer[at + 1] = rule[:, 0], rule[:, 1]
            out = longer
        return out

    def decode(self) -> np.ndarray:
        """All ids: every rule is expanded once, in one array, and copied to where its symbols stand."""
        flat, begin = self._expand(np.arange(self.first, self.first + len(self.rules))), np.cumsum(self.lens) - self.lens
        big = self.symbols >= self.first
        rule = self.symbols[big].astype(np.int64) - self.first
        n = np.ones(len(self.symbols), np.int64)
        n[big] = self.lens[rule]
        at = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.uint32)
        out[at[~big]] = self.symbols[~big]
        out[spans(at[big], n[big])] = flat[spans(begin[rule], n[big])]
        return out

    def decode_range(self, start: int, stop: int) -> np.ndarray:
        """ids[start:stop]."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        i = (int(np.searchsorted(self.marks, start, "right")) - 1) * MARK
        j = int(np.searchsorted(self.marks, stop, "left")) * MARK
        some = self.symbols[i:j]
        n = np.ones(len(some), np.int64)
        big = some >= self.first
        n[big] = self.lens[some[big].astype(np.int64) - self.first]
        ends = int(self.marks[i // MARK]) + np.cumsum(n)
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        before = int(ends[a] - n[a])
        return self._expand(some[a:b])[start - before : stop - before]


def _blocks(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = word_ids(path), TaskContext.get().partitionId()
        ids, lens, names, held, start, block = [], [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            all_ids, all_lens = np.concatenate(ids), np.concatenate(lens)
            doc = pa.concat_arrays(names)
            first, rules, symbols = compress(all_ids)
            rule_lens = expansion_lengths(first, rules)
            marks = Grammar.marks_of(first, rule_lens, symbols)
            width = 2 if not len(symbols) or int(symbols.max()) < 1 << 16 else 4
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "start": [start], "n_tokens": [len(all_ids)],
                 "has_id": [np.asarray(doc.is_valid()).astype(np.uint8).tobytes()], "doc_ids": [doc.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()],
                 "doc_lens": [all_lens.astype("<u4").tobytes()], "first_rule": pa.array([first], pa.int32()), "rules": [rules.astype("<u4").tobytes()],
                 "rule_lens": [rule_lens.astype("<u4").tobytes()], "width": pa.array([width], pa.int32()), "symbols": [symbols.astype(f"<u{width}").tobytes()], "marks": [marks.astype("<u4").tobytes()]}
            )

        for batch in batches:
            for piece in slices(batch, "text", 4 << 20):
                got, n = coder.encode(piece.column("text"))
                if end_id is not None:
                    got, n = np.insert(got, np.cumsum(n), end_id), n + 1
                ids.append(got)
                lens.append(n)
                names.append(piece.column("doc_id"))
                held += len(got)
                if held >= BLOCK_TOKENS:
                    yield flush()
                    start, block = start + held, block + 1
                    ids, lens, names, held = [], [], [], 0
        if names:
            yield flush()

    return run


def write_token_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = 1) -> None:
    """Encode every text and write the ids in ascending ``doc_id`` order below ``path``.

    One shuffle deals the documents out by ranges of ``doc_id``; each range is one
    task's file, so the order of files and blocks is the order of documents.
    """
    (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(_blocks(tokenizer_path, end_id), STORE_SCHEMA)
        .write.mode("overwrite")
        .parquet(path)
    )


def _grammar(row: dict) -> Grammar:
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    lens, marks = (np.frombuffer(row[c], "<u4") for c in ("rule_lens", "marks"))
    return Grammar(row["first_rule"], rules, np.frombuffer(row["symbols"], f"<u{row['width']}"), lens, marks)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = _grammar(row).decode().astype("<u4")
            lens = np.frombuffer(row["doc_lens"], "<u4").astype(np.int64)
            ends = np.cumsum(lens)
            has = np.frombuffer(row["has_id"], np.uint8).astype(bool)
            raw = pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(np.concatenate([[0], ends * 4]).astype("<i4").tobytes()), pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([row["part"]] * len(lens), pa.int32()), "doc_id": pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=~has),
                 "start": row["start"] + ends - lens, "n_tokens": lens, "ids": raw}
            )


def read_token_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian 32-bit).

    The offsets of the parts are one row a written part: their number is that of
    the writing tasks, whatever the documents, so they are collected.
    """
    store = spark.read.schema(STORE_SCHEMA).parquet(path)
    totals = dict(store.groupBy("part").agg(F.sum("n_tokens")).collect())
    before, offsets = 0, []
    for part in sorted(totals):
        offsets.append((part, before))
        before += totals[part]
    docs = store.mapInArrow(_documents, READ_SCHEMA)
    at = spark.createDataFrame(offsets, "part int, before long")
    return docs.join(F.broadcast(at), "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id, n_tokens and ids of a few documents by random access: of a block only the ranges
    of these documents are expanded. ``doc_ids`` is the caller's own, short list."""
    wanted = np.unique(np.array(doc_ids, np.int64))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names, has = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["has_id"], np.uint8).astype(bool)
                ends = np.cumsum(np.frombuffer(row["doc_lens"], "<u4").astype(np.int64))
                at = np.flatnonzero(has & np.isin(names, wanted))
                if len(at):
                    grammar, begin = _grammar(row), np.concatenate([[0], ends])
                    ids = [grammar.decode_range(int(begin[k]), int(ends[k])).astype("<u4").tobytes() for k in at]
                    yield pa.RecordBatch.from_pydict({"doc_id": names[at], "n_tokens": ends[at] - begin[at], "ids": pa.array(ids, pa.binary())})

    return spark.read.schema(STORE_SCHEMA).parquet(path).mapInArrow(some, "doc_id long, n_tokens long, ids binary")
