"""Document fingerprints by locally consistent parsing.

A level turns a sequence of names into phrases: runs of one name become one,
then deterministic coin tossing (the place and value of the lowest bit in which a
name differs from its left neighbour, four times over) gives labels below six
of which neighbours differ, and phrases begin at labels that exceed both neighbours.
A phrase's name is a hash of its names. Whether a phrase begins at a place
depends on a few neighbours alone, so equal passages have equal inner phrases
wherever they stand. Levels go on until one phrase is left.

A set holds the 64 least of the phrases' 32-bit hashes, in base64;
likeness is the estimate of the share of common phrases from two such sets.
Phrases of the second level on count (some ten characters and more), whatever the
length, so equal passages of a short and a long text share their phrases; a text
with one level counts that. Null or empty text: an empty fingerprint, whose likeness
to itself is 1 and to others 0. Very long texts stay whole: work and memory of a
batch are in proportion to its bytes. An empty table gives no row. Columns beyond
``doc_id`` and ``text`` are not read, so no name can clash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarion.llm._bytes import mix, slices
from glossarion.llm._shared import Workspace

KEPT = 64
ONE = np.uint64(1)
RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing; ``first`` marks places without a left neighbour."""
    d = x.copy()
    d[1:] ^= x[:-1]
    d[first] = ONE
    low = np.bitwise_count((d & (~d + ONE)) - ONE).astype(np.uint64)
    return (low << ONE) | ((x >> low) & ONE)


def parse(names: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of one level, and their offsets; no sequence may be empty."""
    n = len(names)
    first = np.zeros(n, bool)
    first[off[:-1]] = True
    begin = first.copy()
    begin[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(begin)
    runs = np.diff(np.concatenate([at, [n]]))
    x, first = names[at], first[at]
    many = runs > 1
    x = np.where(many, mix(x + runs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), x)
    label = x
    for _ in range(4):
        label = _toss(label, first)
    label = label.astype(np.int8)
    left, right = np.empty_like(label), np.empty_like(label)
    left[1:], right[:-1] = label[:-1], label[1:]
    left[0] = right[-1] = 127
    starts = np.flatnonzero(first)
    ends = np.concatenate([starts[1:], [len(x)]])
    right[ends - 1] = 127  # no phrase begins at a sequence's last place
    cut = first | ((label > left) & (label >= right))
    head = np.flatnonzero(cut)
    # a phrase's name: the sum of a mixed value for each name and its place in the phrase
    tail = np.concatenate([head[1:], [len(x)]])
    place = np.arange(len(x)) - np.repeat(head, tail - head)
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(mix(x + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), out=sums[1:])
    made = mix(sums[tail] - sums[head] + (tail - head).astype(np.uint64))
    return made, np.concatenate([np.searchsorted(head, starts), [len(head)]])


def phrases(texts: list[str]) -> list[list[np.ndarray]]:
    """Phrase names of each text, level by level, the last level being one phrase."""
    return [[names[a:b] for names, a, b in x] for x in _levels(texts)]


def _levels(texts: list[str]):
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    who = np.array([i for i, p in enumerate(points) if len(p)], np.int64)
    out: list[list] = [[] for _ in texts]
    if not len(who):
        return out
    names = mix(np.concatenate([points[i] for i in who]).astype(np.uint64) + ONE)
    off = np.concatenate([[0], np.cumsum([len(points[i]) for i in who])])
    while len(who):
        names, off = parse(names, off)
        for i, a, b in zip(who.tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
            out[i].append((names, a, b))
        more = np.diff(off) > 1
        if not more.all():
            keep = np.repeat(more, np.diff(off))
            names, lens, who = names[keep], np.diff(off)[more], who[more]
            off = np.concatenate([[0], np.cumsum(lens)])
    return out


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The least hashes, sorted, of each text's phrases of the second level on."""
    out = []
    for levels in _levels(texts):
        parts = [names[a:b] for names, a, b in levels[min(1, len(levels) - 1) :]] if levels else []
        out.append(np.unique((mix(np.concatenate(parts)) >> np.uint64(32)).astype(np.uint32))[:KEPT] if parts else np.zeros(0, np.uint32))
    return out


def encoded(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u4").tobytes()).decode()


def decoded(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common phrases among the least of both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:][both[1:] == both[:-1]]
    least = np.concatenate([both[:1], both[1:][both[1:] != both[:-1]]])
    k = KEPT if len(a) == KEPT or len(b) == KEPT else len(least)
    least = least[:k]
    return float((twice <= least[-1]).sum() / len(least))


def edited(text: str, following: str) -> str:
    """``text`` whose last half of code points is replaced by the first of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(ids: list, texts: list[str], prints: list[np.ndarray], following: list[str], after: list[np.ndarray]) -> dict:
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    new = sketches(changed)
    return {
        "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
        "fingerprint": pa.array([encoded(p) for p in prints], pa.string()), "edited_fingerprint": pa.array([encoded(p) for p in new], pa.string()),
        "near_edited": pa.array([likeness(p, q) for p, q in zip(prints, new, strict=True)], pa.float64()),
        "near_next": pa.array([likeness(p, q) for p, q in zip(prints, after, strict=True)], pa.float64()),
    }


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each document of a sorted range with the next; the range's first and last wait for their neighbours."""
    part, last = TaskContext.get().partitionId(), None

    def row(side: str, doc, text: str) -> pa.RecordBatch:
        none = {c: pa.nulls(1, t) for c, t in (("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()))}
        return pa.RecordBatch.from_pydict({"doc_id": pa.array([doc], pa.int64())} | none | {"part": pa.array([part], pa.int32()), "side": [side], "text": pa.array([text], pa.string())})

    for batch in batches:
        for piece in slices(batch, "text", 1 << 20):
            ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
            prints = sketches(texts)
            if last is None:
                yield row("first", ids[0], texts[0])
            else:
                ids, texts, prints = [last[0], *ids], [last[1], *texts], [last[2], *prints]
            last = (ids[-1], texts[-1], prints[-1])
            made = _compare(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
            n = len(ids) - 1
            yield pa.RecordBatch.from_pydict(made | {"part": pa.array([part] * n, pa.int32()), "side": pa.nulls(n, pa.string()), "text": pa.nulls(n, pa.string())})
    if last is not None:
        yield row("last", last[0], last[1])


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, after = (batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))
        yield pa.RecordBatch.from_pydict(_compare(ids, texts, sketches(texts), after, sketches(after)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint and the comparison with the next document by ``doc_id`` (after the last the first).

    One shuffle deals the documents out by ranges of ``doc_id``. The first and last
    document of each range, two rows for each task, meet afterwards. Null ids sort
    first; rows of equal id are ordered by their texts.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "phrases")
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = space.write(ordered.mapInArrow(_in_order, RESULT + ", part int, side string, text string"), "made")
    parts = [r.part for r in made.where("side = 'first'").select("part").orderBy("part").collect()]  # one row for each task that had rows
    after = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]], strict=True)), "part int, next int")
    firsts = made.where("side = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    edges = made.where("side = 'last'").join(after, "part").join(firsts, "next").select("doc_id", "text", "following").mapInArrow(_at_edges, RESULT)
    return made.where("side is null").drop("part", "side", "text").unionByName(edges)
