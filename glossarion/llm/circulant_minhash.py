"""Near-duplicate documents by circulant MinHash, banding and exact verification.

Two permutations make all coordinates: the first places a shingle, the second,
shifted by one place for each coordinate, gives its value; so the values of a
shingle are one slice of the second permutation. Bands of coordinates make
buckets. Links are confirmed on full sets of shingles, each named by a 64-bit hash.

Equal sets collapse first. Buckets are then not expanded into pairs: in each of
a few rounds every document is compared with one centre of each bucket that is
not yet in its component; first with the document that has the fewest shingles
of its own. Pairs that rounds leave open (same bucket, different components)
go through a prefix filter: sets that reach the threshold share one of their
rarest shingles, and the first they share stands so early in both that what follows
can still reach it. Sets meet in classes of the smaller one's size, and only
where one of the two is not in a key's most common component. Throughout, shingles
that a document shares with none bound its likeness to all others. These tests are
exact. No bucket, partner or candidate is capped.

Very long texts are whole sets; a batch is cut at texts, so one text is the bound of
memory. Only ``doc_id`` and ``text`` are read, so no other column's name can clash.
Ties and repeated rows: equal sets are always linked, of several centres as good the
smallest id counts. Null or empty text: an empty set, linked with nothing. With fewer words than a
shingle, the whole sequence is one. Rows of equal ``doc_id`` are one vertex; a
null ``doc_id`` is a vertex of its own that counts as the smallest, its
component is null. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossarion.llm._bytes import mix, segment_hash, slices, string_buffers, words
from glossarion.llm._shared import Workspace
from glossarion.llm.components import components

FIRST = -(1 << 63)
PLACES_LOG2 = 20
STEPS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))


def shingles(col: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z folded."""
    data, off = string_buffers(col)
    start, end, row = words(data, off)
    w = segment_hash(data, start, end, 0, True)
    bounds = np.searchsorted(row, np.arange(len(col) + 1))
    n = max(0, len(w) - width + 1)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h += mix(w[k : k + n] + np.uint64(k)) * STEPS[k]
    h = mix(h)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= width:
            yield np.unique(h[a : b - width + 1])
        elif b > a:
            x = np.uint64(b - a)
            for k, y in enumerate(w[a:b]):
                x = x + mix(np.array([y + np.uint64(k)])) * STEPS[k]
            yield mix(x)
        else:
            yield np.zeros(0, np.uint64)


@lru_cache(maxsize=2)
def _slices_of_second(coordinates: int) -> np.ndarray:
    second = np.random.Generator(np.random.PCG64(7)).permutation(1 << PLACES_LOG2).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[: coordinates - 1]]), coordinates)


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """All coordinates: the least value, over the set, of the shifted second permutation."""
    places = (mix(hashes) >> np.uint64(64 - PLACES_LOG2)).astype(np.int64)
    table = _slices_of_second(coordinates)
    out = table[places[:4096]].min(0)
    for i in range(4096, len(places), 4096):
        np.minimum(out, table[places[i : i + 4096]].min(0), out=out)
    return out


def _sketch(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(rows)], np.uint64)
        for batch in batches:
            for part in slices(batch, "text"):
                n, k1, k2, sigs = [], [], [], []
                for s in shingles(part.column("text"), width):
                    n.append(len(s))
                    k1.append(_set_key(s))
                    k2.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) if len(s) else 0)
                    sigs.append(signature(s, bands * rows) if len(s) else np.zeros(bands * rows, np.int32))
                sig = np.array(sigs, np.uint64).reshape(len(sigs), bands, rows) + np.uint64(1)
                band = mix((mix(sig) * powers).sum(2, dtype=np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"doc": part.column("doc"), "n": pa.array(n, pa.int64()), "k1": np.array(k1, np.uint64).view(np.int64), "k2": np.array(k2, np.uint64).view(np.int64),
                     "bands": pa.FixedSizeListArray.from_arrays(pa.array(band.ravel()), bands).cast(pa.list_(pa.int64()))}
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = [s.astype("<u8").tobytes() for s in shingles(part.column("text"), width)]
                yield pa.RecordBatch.from_pydict({"doc": part.column("doc"), "set": pa.array(made, pa.binary())})

    return run


def _set_key(hashes: np.ndarray) -> np.uint64:
    return mix(hashes).sum(dtype=np.uint64) if len(hashes) else np.uint64(0)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each set, with the set's key."""
    for batch in batches:
        raw, off = string_buffers(batch.column(1))
        n, s = np.diff(off) // 8, np.frombuffer(raw.tobytes(), "<u8")
        keys = np.array([_set_key(s[a:b]) for a, b in zip(off[:-1] // 8, off[1:] // 8, strict=True)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_pydict({"doc": np.repeat(batch.column(0).to_numpy(zero_copy_only=False), n), "k1": np.repeat(keys, n), "s": s.view(np.int64)})


def _linked(share: tuple[int, int]):
    num, den = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                keep[i] = den * both >= num * (len(x) + len(y) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return run


def _prefixes(share: tuple[int, int]):
    num, den = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, out = [], []
            for doc, k1, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                values = items.values
                f, s = values.field(0).to_numpy(zero_copy_only=False), values.field(1).to_numpy(zero_copy_only=False)
                n = len(s)
                keep = n - -(-num * n // den) + 1
                at = np.lexsort((s, f))[:keep]
                at, place = at[f[at] > 1], np.flatnonzero(f[at] > 1)
                # as the smaller set of a pair: at least 2 * num * n / (num + den) shingles are shared, from the first on
                short = place[(num + den) * (n - place) >= 2 * num * n]
                sizes, roles, places, which = [np.full(len(short), _size_class(n))], [np.zeros(len(short), bool)], [short], [s[at[: len(short)]]]
                # as the larger set: a row for each class that a set of num / den * n to n shingles may be of
                for c in range(_size_class(-(-num * n // den)), _size_class(n) + 1):
                    if c >= 64 and c & 63 < 32:  # no size has such a class
                        continue
                    least = max(_class_start(c), -(-num * n // den))
                    long = place[(num + den) * (n - place) >= num * (n + least)]
                    sizes.append(np.full(len(long), c)), roles.append(np.ones(len(long), bool)), places.append(long), which.append(s[at[: len(long)]])
                out.append([np.concatenate(x) for x in (which, sizes, roles, places)])
                docs.append([np.full(len(out[-1][0]), v, np.int64) for v in (doc, k1, n)])
            if out:
                doc, k1, n = (np.concatenate(x) for x in zip(*docs, strict=True))
                s, size, role, place = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_pydict({"doc": doc, "k1": k1, "n": n, "s": s, "size": size.astype(np.int32), "larger": role, "place": place.astype(np.int64)})

    return run


def _size_class(n: int) -> int:
    """Sizes of one class differ by a 32nd at most."""
    k = max(0, n.bit_length() - 6)
    return (k << 6) + (n >> k)


def _class_start(c: int) -> int:
    return (c & 63) << (c >> 6)


def near_duplicates(docs: DataFrame, width: int = 5, share: tuple[int, int] = (80, 100), bands: int = 36, rows: int = 5, rounds: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``.

    Linked: intersection / union of the shingle sets is at least ``share``. With 36
    bands of 5 a pair at 0.8 has no common bucket with probability below 1e-6.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "near")
    num, den = share
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("doc"), F.col("text").cast("string"))
    sketches = space.write(texts.mapInArrow(_sketch(width, bands, rows), "doc long, n long, k1 long, k2 long, bands array<long>"), "sketches")
    classes = space.write(sketches.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("doc").alias("rep")), "classes")
    # a document whose rows hold several sets is one vertex: its sets' classes are linked
    reps = sketches.where("n > 0").join(classes.select(F.col("rep").alias("doc"), "k1", "k2"), ["doc", "k1", "k2"]).dropDuplicates(["doc", "k1", "k2"])
    placed = reps.select("doc", "n", "k1", F.posexplode("bands").alias("band", "v"))
    crowded = placed.groupBy("band", "v").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("band", "v")
    members = space.write(placed.join(crowded, ["band", "v"]).select("band", "v", "doc", "n", "k1").distinct(), "members")
    wanted = members.select("doc").distinct()
    sets = space.write(texts.join(wanted, "doc", "left_semi").mapInArrow(_sets(width), "doc long, set binary"), "sets")
    alone = sketches.where("n > 0").select("doc", "k1", "k2").join(classes, ["k1", "k2"]).where("doc <> rep")
    links = space.write(alone.select(F.col("doc").alias("a"), F.col("rep").alias("b")).distinct(), "same")
    tables = ["same"]

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.join(sets.select(F.col("doc").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("doc").alias("b"), F.col("set").alias("sb")), "b")
        return space.write(both.select("a", "b", "sa", "sb").mapInArrow(_linked(share), "a long, b long").distinct(), name)

    # shingles that no other document of a bucket has bound every likeness of theirs from above
    lone = sets.mapInArrow(_members, "doc long, k1 long, s long").groupBy("s").agg(F.count("*").alias("f"), F.min(F.struct("doc", "k1")).alias("x")).where("f = 1").groupBy("x.doc", "x.k1").agg(F.count("*").alias("lone"))
    members = members.join(lone, ["doc", "k1"], "left").withColumn("r", F.col("n") - F.coalesce("lone", F.lit(0))).drop("lone").where(den * F.col("r") >= num * F.col("n"))
    members = space.write(members, "open")

    def possible(n: str, r: str, m: str, q: str):
        most = F.least(F.col(r), F.col(q))
        return (den * F.least(F.col(n), F.col(m)) >= num * F.greatest(F.col(n), F.col(m))) & (den * most >= num * (F.col(n) + F.col(m) - most))

    def untested(pairs: DataFrame) -> DataFrame:
        for t in tested:
            pairs = pairs.join(t, ["a", "b"], "left_anti").join(t.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
        return pairs

    state, comps, tested = members.withColumn("comp", F.col("doc")), None, []
    for k in range(rounds):
        # the first centres have the fewest lone shingles, later ones are random
        order = F.xxhash64("doc", F.lit(k)) if k else (F.col("n") - F.col("r")) / F.col("n")
        key = F.struct(order.alias("key"), F.col("doc").alias("c"), F.col("n").alias("cn"), F.col("r").alias("cr"), F.col("comp").alias("cc"))
        centres = state.groupBy("band", "v").agg(F.min(key).alias("x")).select("band", "v", "x.c", "x.cn", "x.cr", "x.cc")
        pairs = state.join(centres, ["band", "v"]).where((F.col("comp") != F.col("cc")) & possible("n", "r", "cn", "cr")).select(F.col("c").alias("a"), F.col("doc").alias("b")).distinct()
        pairs = space.write(untested(pairs), f"pairs{k}")
        tested.append(pairs)
        new = verified(pairs, f"links{k}")
        tables += [f"pairs{k}", f"links{k}"]
        if k and new.isEmpty():
            continue
        links = links.unionByName(new)
        comps = space.write(components(space, links, f"cc{k}-"), f"comps{k}")
        of = comps.select(F.col("v").alias("doc"), "comp")
        state = members.join(of, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
        mixed = state.groupBy("band", "v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band", "v")
        state = space.write(state.join(mixed, ["band", "v"]).select("band", "v", "doc", "n", "k1", "r", "comp"), f"state{k}")
        if state.isEmpty():
            break
    else:
        # the exact rest
        open_sets = state.select("doc", "k1", "r", "comp").distinct()
        held = space.write(sets.join(open_sets.select("doc"), "doc", "left_semi").mapInArrow(_members, "doc long, k1 long, s long").join(open_sets.select("doc", "k1"), ["doc", "k1"], "left_semi"), "held")
        common = held.groupBy("s").agg(F.count("*").alias("f")).where("f > 1")
        ranked = held.join(common, "s", "left").select("doc", "k1", "s", F.coalesce("f", F.lit(1)).alias("f"))
        grouped = ranked.groupBy("doc", "k1").agg(F.collect_list(F.struct("f", "s")).alias("items"))
        schema = "doc long, k1 long, n long, s long, size int, larger boolean, place long"
        prefix = space.write(grouped.mapInArrow(_prefixes(share), schema).join(open_sets, ["doc", "k1"]), "prefix")
        # of each key the most common component: pairs within it are linked already
        tops = prefix.groupBy("s", "size", "comp").agg(F.count("*").alias("x")).groupBy("s", "size").agg(F.max(F.struct("x", "comp")).alias("x"), F.count("*").alias("comps")).where("comps > 1").select("s", "size", F.col("x.comp").alias("top"))
        keyed = prefix.join(tops, ["s", "size"])
        small = keyed.where("not larger").select("s", "size", F.col("doc").alias("a"), F.col("n").alias("an"), F.col("r").alias("ar"), F.col("comp").alias("ac"), F.col("place").alias("ap"), F.col("top").alias("at"))
        large = keyed.where("larger").drop("larger", "k1")
        left = F.least(F.col("n") - F.col("place"), F.col("an") - F.col("ap"))
        near = ((F.col("an") < F.col("n")) | (F.col("an") == F.col("n")) & (F.col("a") < F.col("doc"))) & (F.col("ac") != F.col("comp")) & possible("n", "r", "an", "ar") & ((num + den) * left >= num * (F.col("n") + F.col("an")))
        meet = lambda x, y: x.join(y, ["s", "size"]).where(near).select(F.least("a", "doc").alias("a"), F.greatest("a", "doc").alias("b"))
        rest = meet(small.where("ac <> at"), large).unionByName(meet(small.where("ac = at"), large.where("comp <> top"))).distinct()
        new = verified(space.write(untested(rest), "rest"), "last")
        if not new.isEmpty():
            comps = space.write(components(space, links.unionByName(new), "cc-"), "comps")
    drop = ["sets", "members", "open", "held", "prefix", "rest", "last", "classes", *tables, *(f"state{k}" for k in range(rounds))]
    space.drop(*drop)
    found = sketches.join(comps.select(F.col("v").alias("doc"), "comp"), "doc", "left")
    comp = F.coalesce("comp", "doc")
    return found.select(
        F.when(F.col("doc") != FIRST, F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"), F.when(comp != FIRST, comp).alias("component_id"), (comp == F.col("doc")).alias("kept")
    )

