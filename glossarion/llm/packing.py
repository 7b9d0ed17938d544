"""Vector bin packing of token sequences by the dot-product heuristic.

Examples have three sizes: tokens, segments (one each) and loss-bearing tokens.
A bin is filled by taking, again and again, the example that fits and whose
size vector has the largest dot product with what is left of the bin. When no
whole example fits, the longest waiting one is cut to fill the bin exactly. Each
task packs its own rows: nothing is shuffled. What is left of a task at its end
is closed at powers of two, so no id is padding.

Null text: an empty document, which is its end id alone. Repeated rows are
packed once each. An empty table gives no row. Of the columns only ``doc_id``,
``text`` and what ``loss`` names are read, so no name can clash. A very long text is
cut over as many sequences as it fills. Ties in the dot product go to the example
that came first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarion.llm._bytes import slices
from glossarion.llm.wordids import word_ids

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Examples that wait at most before bins are filled from them.
POOL = 2048


class Bins:
    """Fills sequences from a pool of waiting examples."""

    def __init__(self, limits: tuple[int, int, int]):
        self.limits = np.array(limits, np.float64)
        self.items: list[tuple] = []  # (document, start, ids, doc_tokens, loss-bearing flags or None)

    def add(self, doc, ids: np.ndarray, loss: np.ndarray | None = None) -> None:
        self.items.append((doc, 0, ids, len(ids), loss))

    def _sizes(self) -> np.ndarray:
        return np.array([[len(i[2]), 1, len(i[2]) if i[4] is None else int(i[4].sum())] for i in self.items], np.float64).reshape(-1, 3)

    def fill(self, until: int) -> Iterator[list[tuple]]:
        """Full bins, while more than ``until`` tokens wait."""
        sizes, live = self._sizes(), np.ones(len(self.items), bool)
        items, waiting = self.items, sizes[:, 0].sum()
        scale = 1 / self.limits
        while waiting > until:
            left, bin_ = self.limits.copy(), []
            while left[0] > 0 and left[1] > 0 and left[2] >= 0:
                fits = live & (sizes <= left).all(1)
                if fits.any():
                    score = np.where(fits, (sizes * scale) @ (left * scale), -1.0)
                    k = int(score.argmax())
                    bin_.append(items[k])
                    live[k] = False
                    left -= sizes[k]
                    continue
                score = np.where(live, sizes[:, 0], -1.0)
                k = int(score.argmax())
                if score[k] < 0:
                    break
                doc, start, ids, total, loss = items[k]
                take = min(int(left[0]), len(ids), int(left[2]) if loss is None else int(np.searchsorted(np.cumsum(loss), left[2], "right")))
                if not take:
                    break
                bin_.append((doc, start, ids[:take], total, None if loss is None else loss[:take]))
                left -= (take, 1, take if loss is None else int(loss[:take].sum()))
                items[k] = (doc, start + take, ids[take:], total, None if loss is None else loss[take:])
                sizes[k] = (len(items[k][2]), 1, len(items[k][2]) if loss is None else int(items[k][4].sum()))
                live[k] = len(items[k][2]) > 0
            if not bin_:
                break
            waiting -= sum(len(i[2]) for i in bin_)
            yield bin_
        self.items = [x for x, alive in zip(items, live, strict=True) if alive]

    def rest(self) -> Iterator[list[tuple]]:
        """What is left, cut into bins whose lengths are powers of two."""
        yield from self.fill(int(self.limits[0]) - 1)
        waiting = sum(len(i[2]) for i in self.items)
        full = self.limits[0]
        while waiting:
            self.limits[0] = min(full, 1 << (int(waiting).bit_length() - 1))
            took = 0
            for b in self.fill(waiting - 1):
                took += sum(len(i[2]) for i in b)
                yield b
            waiting = sum(len(i[2]) for i in self.items)
            if not took:
                break
        self.limits[0] = full


def _pack(path: str, end_id: int | None, limits: tuple[int, int, int], flagged: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, sequence, bins = word_ids(path), TaskContext.get().partitionId() << 36, Bins(limits)

        def out(made: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            rows: list[tuple] = []
            for b in made:
                at = 0
                for doc, start, ids, total, _ in b:
                    rows.append((doc, start, len(ids), total, sequence, at, ids.astype("<u4").tobytes()))
                    at += len(ids)
                sequence += 1
            for i in range(0, len(rows), 4096):
                cols = list(zip(*rows[i : i + 4096], strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            for piece in slices(batch, "text", 4 << 20):
                ids, lens = coder.encode(piece.column("text"))
                if end_id is not None:
                    ids, lens = np.insert(ids, np.cumsum(lens), end_id), lens + 1
                ends = np.cumsum(lens)
                bears = piece.column("loss").fill_null(False).to_pylist() if flagged else [True] * len(lens)
                for doc, a, b, some in zip(piece.column("doc_id").to_pylist(), ends - lens, ends, bears, strict=True):
                    bins.add(doc, ids[a:b], None if some else np.zeros(b - a, bool))
                if len(bins.items) >= POOL:
                    yield from out(_full_first(bins, limits[0]))
        yield from out(_full_first(bins, limits[0]))
        yield from out(bins.rest())

    return run


def _full_first(bins: Bins, most: int) -> Iterator[list[tuple]]:
    """Sequences that one document fills alone, then bins of what remains."""
    kept = []
    for doc, start, ids, total, loss in bins.items:
        while len(ids) >= most and (bins.limits[2] >= most if loss is None else not loss[:most].any()):
            yield [(doc, start, ids[:most], total, None if loss is None else loss[:most])]
            start, ids, loss = start + most, ids[most:], None if loss is None else loss[most:]
        if len(ids):
            kept.append((doc, start, ids, total, loss))
    bins.items = kept
    yield from bins.fill(16 * most)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, max_tokens: int = 4096, max_segments: int | None = None, max_loss_tokens: int | None = None, loss: Column | None = None) -> DataFrame:
    """Pieces of documents with their ids and their places in sequences.

    ``sequence_id`` is unique over all tasks; ``offset`` runs gapless from 0.
    ``loss`` (boolean, such as a test of a turn's role): whether a row's tokens bear
    loss; without it all do. Without limits of their own, segments and loss-bearing
    tokens are limited by the tokens alone. Limits that close a sequence before it is
    full leave its length open: the caller pads it.
    """
    limits = (max_tokens, max_segments or max_tokens, max_loss_tokens or max_tokens)
    columns, flagged = [F.col("doc_id").cast("long"), F.col("text").cast("string")], loss is not None
    if flagged:
        columns.append(loss.cast("boolean").alias("loss"))
    return docs.select(*columns).mapInArrow(_pack(tokenizer_path, end_id, limits, flagged), PIECES)
