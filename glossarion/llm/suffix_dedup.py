"""Exact removal of repeated byte strings, by suffix arrays over the places where repeats can be.

1. Every ``length``-byte window of a text has an anchor: the window's k-gram of the
   least hash. Neighbouring windows of one anchor make a piece. Equal windows have
   equal anchors, so a window can repeat only if its anchor does.
2. Pieces are counted by anchor and by content. A piece found twice repeats in all
   its windows. A piece found once, whose anchor occurs elsewhere, is open.
3. Open pieces, with one piece of each content that repeats under the same anchor,
   go to shards by anchor. A shard sorts all suffixes by induction, computes
   permuted common prefixes, and marks windows that share ``length`` bytes.
4. An anchor with more than ``max_group`` contents is not put into one shard: its
   windows are counted by a 128-bit hash, aggregated before the shuffle. This is exact
   as well and holds for any size of group.

Only counts and positions are shuffled in steps 1 and 2; texts are shuffled once for
step 3 and once for the result. Null or empty text: no bytes. Rows of equal
``doc_id`` stay apart unless their texts are equal too; such rows repeat each
other. A null ``doc_id`` is kept. An empty table gives no row. Columns beyond
``doc_id`` and ``text`` pass through. A very long text is searched in overlapping parts
and cut as a whole. Ties: of repeated contents every place counts alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarion.llm._bytes import PrefixHash, slices, spans, string_buffers
from glossarion.llm._shared import Workspace, carried
from glossarion.llm.induced_sorting import permuted_common_prefixes, suffix_array

FIRST = -(1 << 63)
BLOCK = 1 << 20
SHARD_BYTES = 1_500_000
KEY = ("doc", "th")


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    k = 1
    while 2 * k <= width:
        a = np.minimum(a[: len(a) - k], a[k:])
        k *= 2
    return np.minimum(a[: len(a) - (width - k)], a[width - k :]) if k < width else a


def pieces(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """(row, first window, last window, anchor place, anchor hash, content hash) of each piece, places within the row."""
    n = len(data)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.view(np.uint64), z.view(np.uint64)
    sums = PrefixHash(data)
    starts = np.arange(n - gram + 1)
    h = sums.of(starts, starts + gram)
    order = (h & ~np.uint64((1 << 24) - 1)) | starts.astype(np.uint64)
    at = (_least(order, length - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    inside = np.zeros(n + 1, np.int32)
    lens = np.diff(off)
    long = lens >= length
    inside[off[:-1][long]] += 1
    inside[off[1:][long] - length + 1] -= 1
    ok = np.cumsum(inside[: len(at)]) > 0
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (ok[1:] != ok[:-1])
    new[off[:-1][long]] = True
    s = np.flatnonzero(new)
    e = np.concatenate([s[1:], [len(at)]]) - 1
    keep = ok[s]
    s, e = s[keep], e[keep]
    a = at[s]
    content = sums.of(s, e + length) + (a - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    row = np.searchsorted(off, s, "right") - 1
    base = off[row]
    return row, s - base, e - base, a - base, h[a], content


def _blocks(data: np.ndarray, off: np.ndarray, length: int):
    """Row ranges of about BLOCK bytes; a longer row alone, in overlapping parts.

    Yields (first row, bytes, offsets, place of the part in its row)."""
    i, n, part = 0, len(off) - 1, 1 << 21
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + BLOCK, "right")) - 1)
        if off[j] - off[i] <= part:
            yield i, data[off[i] : off[j]], off[i : j + 1] - off[i], 0
        else:
            for at in range(0, int(off[j] - off[i]) - length + 1, part):
                end = min(int(off[j] - off[i]), at + part + length - 1)
                yield i, data[off[i] + at : off[i] + end], np.array([0, end - at]), at
        i = j


def _find_pieces(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = string_buffers(part.column("text"))
                doc, th = (part.column(c).to_numpy(zero_copy_only=False) for c in KEY)
                for first, raw, bounds, shift in _blocks(data, off, length):
                    row, s, e, _, h, content = pieces(raw, bounds, length, gram)
                    yield pa.RecordBatch.from_pydict(
                        {"doc": doc[first + row], "th": th[first + row], "s": (s + shift).astype(np.int32), "w": (e - s + 1).astype(np.int32), "h": h.view(np.int64), "p": content.view(np.int64)}
                    )

    return run


def _open_pieces(length: int):
    """Bytes of open pieces, one row each; of anchors in large groups one row for each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                data, off = string_buffers(part.column("text"))
                items = part.column("items")
                of = np.repeat(np.arange(len(items)), np.diff(np.asarray(items.offsets, np.int64)))
                flat = items.flatten()
                s, w, h, kind = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("s", "w", "h", "kind"))
                doc, th = (part.column(c).to_numpy(zero_copy_only=False) for c in KEY)
                for hot in (False, True):
                    k = np.flatnonzero((kind & 3 > 0) & ((kind & 4 > 0) == hot))
                    begin = off[of[k]] + s[k]
                    if not hot:
                        lens = (w[k] + length - 1).astype(np.int64)
                        raw = data[spans(begin, lens)]
                        ends = np.concatenate([[0], np.cumsum(lens)]).astype("<i4")
                        text = pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])
                        yield _rows(doc[of[k]], th[of[k]], s[k], w[k], h[k], np.zeros(len(k), np.int64), text)
                    elif len(k):
                        lens = w[k].astype(np.int64)
                        at = spans(begin, lens)
                        who = np.repeat(k, lens)
                        g = [PrefixHash(data, seed).of(at, at + length).view(np.int64) for seed in (0, 1)]
                        yield _rows(doc[of[who]], th[of[who]], at - off[of[who]], np.ones(len(at)), g[0], g[1], pa.nulls(len(at), pa.binary()))

    return run


def _rows(doc, th, s, w, h, g, text):
    return pa.RecordBatch.from_pydict({"doc": doc, "th": th, "s": s.astype(np.int32), "w": w.astype(np.int32), "h": h, "g": g, "text": text})


def repeated_windows(texts: list[bytes], length: int) -> np.ndarray:
    """Whether each window of the texts, one text after another, occurs twice in them."""
    lens = np.array([len(x) for x in texts], np.int64)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sa = suffix_array(joined)
    common = permuted_common_prefixes(joined, sa, length)[sa]
    left = np.repeat(np.cumsum(lens), lens) - np.arange(len(joined))
    group = np.cumsum(common < length)
    valid = left[sa] >= length
    twice = np.bincount(group[valid], minlength=int(group[-1]) + 1) >= 2 if len(sa) else np.zeros(0, bool)
    out = np.zeros(len(joined), bool)
    out[sa] = valid & twice[group]
    return out[left >= length]


def _sort_shards(length: int):
    def shard(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        hit = repeated_windows([x.as_py() for x in table.column("text")], length)
        w = table.column("w").to_numpy().astype(np.int64)
        s, row = table.column("s").to_numpy(), np.repeat(np.arange(len(w)), w)
        window = spans(s.astype(np.int64), w)
        edge = np.concatenate([[True], row[1:] != row[:-1]])
        begin = np.flatnonzero(hit & (edge | ~np.concatenate([[False], hit[:-1]])))
        last = np.concatenate([edge[1:], [True]])
        end = np.flatnonzero(hit & (last | ~np.concatenate([hit[1:], [False]])))
        doc, th = (table.column(c).to_numpy()[row[begin]] for c in KEY)
        return pa.RecordBatch.from_pydict({"doc": doc, "th": th, "s": window[begin].astype(np.int32), "w": (end - begin + 1).astype(np.int32)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            h = batch.column("h").to_numpy()
            _, off = string_buffers(batch.column("text"))
            at = 0
            for cut in [*(np.flatnonzero(h[1:] != h[:-1]) + 1), len(h)]:
                if size >= SHARD_BYTES and h[at] != last:
                    yield shard(held)
                    held, size = [], 0
                held.append(batch.slice(at, cut - at))
                size += int(off[cut] - off[at])
                last, at = h[at], cut
        if held:
            yield shard(held)

    return run


def _cut(length: int, whole_characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = string_buffers(part.column("text"))
                cover = np.zeros(len(data) + 1, np.int32)
                for name in ("items", "found"):
                    items = part.column(name)
                    if items.null_count == len(items):
                        continue
                    of = np.repeat(np.arange(len(items)), items.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                    flat = items.flatten()
                    s, w = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("s", "w"))
                    if name == "items":
                        whole = flat.field("kind").to_numpy(zero_copy_only=False) & 1 == 0
                        of, s, w = of[whole], s[whole], w[whole]
                    np.add.at(cover, off[of] + s, 1)
                    np.add.at(cover, off[of] + s + w + length - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                if whole_characters and len(data):
                    of_char = np.cumsum((data & 0xC0) != 0x80)
                    gone &= (np.bincount(of_char[~gone], minlength=int(of_char[-1]) + 1) == 0)[of_char]
                before = np.concatenate([[0], np.cumsum(gone)])
                n_removed = before[off[1:]] - before[off[:-1]]
                edge = np.zeros(len(gone), bool)
                edge[off[:-1][off[:-1] < len(gone)]] = True
                begin = np.flatnonzero(gone & (edge | ~np.concatenate([[False], gone[:-1]])))
                last = np.concatenate([edge[1:], [True]])[: len(gone)]
                end = np.flatnonzero(gone & (last | ~np.concatenate([gone[1:], [False]])[: len(gone)])) + 1
                row = np.searchsorted(off, begin, "right") - 1
                counts = np.bincount(row, minlength=len(off) - 1)
                runs = pa.StructArray.from_arrays([pa.array(begin - off[row]), pa.array(end - off[row])], ["start", "end"])
                kept_off = np.concatenate([[0], np.cumsum(np.diff(off) - n_removed)]).astype("<i4")
                kept = pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(kept_off.tobytes()), pa.py_buffer(data[~gone].tobytes())])
                cols = {n: part.column(n) for n in part.schema.names if n not in ("text", "items", "found", *KEY)}
                yield pa.RecordBatch.from_pydict(
                    cols | {"n_bytes": np.diff(off), "n_removed": n_removed, "n_spans": counts.astype(np.int64),
                            "removed": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), runs), "kept": kept}
                )

    return run


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 64, max_group: int = 20_000, whole_characters: bool = False, prefix: str = "") -> DataFrame:
    """``docs`` without ``text``; n_bytes, n_removed, n_spans (long), removed (spans), kept (the bytes left).

    ``whole_characters``: a code point goes only if all its bytes do, so what is left is valid UTF-8.
    ``prefix`` goes before the names of the results; a column of ``docs`` of such a full name
    is replaced, all others pass through under any name.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "repeats")
    own = ("n_bytes", "n_removed", "n_spans", "removed", "kept")
    docs, back = carried(docs, tuple(prefix + c for c in own))
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    keyed = docs.withColumn("doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST))).withColumn("th", F.xxhash64("text"))
    texts = keyed.select("doc", "th", "text")
    found = space.write(texts.mapInArrow(_find_pieces(length, gram), "doc long, th long, s int, w int, h long, p long"), "pieces")
    contents = space.write(found.groupBy("h", "p").agg(F.count("*").alias("n"), F.min(F.col("doc")).alias("rd")), "contents")
    anchors = contents.groupBy("h").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("single")).where("all > 1")
    # kind: 1 open, 2 stands for a repeated content beside open ones; 4 added for large groups; 0 repeats as a whole
    judged = contents.join(anchors, "h").select("h", "p", "n", "rd", (F.col("single") > 0).alias("beside"), (F.col("kinds") > max_group).alias("large"))
    kind = (
        F.when(F.col("n") == 1, 1).when(F.col("beside") & (F.col("doc") == F.col("rd")), 2).otherwise(0) + F.when(F.col("large"), 4).otherwise(0)
    ).cast("int")
    at = found.join(judged, ["h", "p"]).select(*KEY, F.struct("s", "w", "h", kind.alias("kind")).alias("x"))
    items = space.write(at.groupBy(*KEY).agg(F.collect_list("x").alias("items")), "items")
    space.drop("pieces", "contents")
    space.release_shuffles()
    to_open = items.where(F.exists("items", lambda x: x["kind"].bitwiseAND(3) > 0))
    opened = texts.join(to_open, list(KEY)).mapInArrow(_open_pieces(length), "doc long, th long, s int, w int, h long, g long, text binary")
    opened = space.write(opened, "open")
    space.release_shuffles()
    sharded = opened.where("text is not null").repartition("h").sortWithinPartitions("h")
    sorted_ = sharded.mapInArrow(_sort_shards(length), "doc long, th long, s int, w int")
    windows = opened.where("text is null")
    twice = windows.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").select("h", "g")
    spread = windows.join(twice, ["h", "g"]).select(*KEY, "s", "w")
    more = space.write(sorted_.unionByName(spread).groupBy(*KEY).agg(F.collect_list(F.struct("s", "w")).alias("found")), "found")
    space.drop("open")
    space.release_shuffles()
    joined = keyed.join(items, list(KEY), "left").join(more, list(KEY), "left")
    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_bytes long, n_removed long, n_spans long, removed array<struct<start:long,end:long>>, kept binary"
    out = joined.mapInArrow(_cut(length, whole_characters), schema)
    return out.select("doc_id", *(F.col(k).alias(c) for k, c in back.items()), *(F.col(c).alias(prefix + c) for c in own))
