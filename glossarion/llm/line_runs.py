"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches of ascending ``doc_id``. A run holds distinct 128-bit
hashes of line keys with the smallest document that has the line, bucketed and
sorted by hash. A batch's hashes are merged with the runs; those that no run has
become a new run of level 0. When a level has ``fanout`` runs, they are merged
into one of the next level, so a hash is rewritten once a level.

A line goes if its key has ``min_chars`` code points, is in two documents at
least and this is not the smallest of them. Null or empty text: one empty line.
A null ``doc_id`` counts as the smallest; rows of equal ``doc_id`` are one
document. Hot lines: keys are aggregated before they are shuffled, and the join
that brings owners back to documents may split a hot key. An empty table gives no row.
A very long text is one slice of a batch: its own size bounds memory. A line repeated in
its smallest document stays there each time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarion.llm._bytes import segment_hash, slices, string_buffers
from glossarion.llm._shared import Workspace, carried

KEY = ("k1", "k2")
FIRST = -(1 << 63)


def _lines(col: pa.Array, min_chars: int):
    """(lines, row of each line, key hashes, whether the key is long enough)."""
    split = pc.split_pattern(col.fill_null("") if col.null_count else col, "\n")
    lines = split.flatten()
    rows = np.repeat(np.arange(len(col)), np.diff(np.asarray(split.offsets, np.int64)))
    keys = pc.ascii_lower(pc.ascii_trim_whitespace(lines))
    long = pc.utf8_length(keys).to_numpy(zero_copy_only=False) >= min_chars
    data, off = string_buffers(keys)
    hashes = [segment_hash(data, off[:-1], off[1:], seed).view(np.int64) for seed in (0, 1)]
    return lines, rows, hashes, long


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, rows, (k1, k2), long = _lines(part.column("text"), min_chars)
                at = np.flatnonzero(long)
                order = at[np.lexsort((k2[at], k1[at], rows[at]))]
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(rows[order]) != 0) | (np.diff(k1[order]) != 0) | (np.diff(k2[order]) != 0)
                order = order[new]
                yield pa.RecordBatch.from_pydict({"k1": k1[order], "k2": k2[order], "doc": part.column("doc").take(pa.array(rows[order]))})

    return run


def _without(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines, rows, (k1, k2), long = _lines(part.column("text"), min_chars)
                lost = part.column("lost")
                drop = np.zeros(len(rows), bool)
                if len(lost) - lost.null_count:
                    pairs = lost.flatten()
                    of = np.repeat(np.arange(len(lost)), pc.fill_null(pc.list_value_length(lost), 0).to_numpy(zero_copy_only=False))
                    bad = np.stack([of, pairs.field("k1").to_numpy(zero_copy_only=False), pairs.field("k2").to_numpy(zero_copy_only=False)], 1).astype(np.int64)
                    row = np.dtype([("r", np.int64), ("a", np.int64), ("b", np.int64)])
                    mine = np.ascontiguousarray(np.stack([rows, k1, k2], 1).astype(np.int64)).view(row).ravel()
                    drop = long & np.isin(mine, np.ascontiguousarray(bad).view(row).ravel())
                kept = lines.filter(pa.array(~drop))
                counts = np.bincount(rows[~drop], minlength=len(lost))
                off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array(off), kept), "\n")
                n_lines = np.bincount(rows, minlength=len(lost))
                cols = {n: part.column(n) for n in part.schema.names if n not in ("text", "lost")}
                yield pa.RecordBatch.from_pydict(cols | {"text": text, "n_lines": n_lines, "n_dropped": n_lines - counts})

    return run


class Runs:
    """The levels of sorted runs, each a table bucketed and sorted by hash, below one folder of the shared store.

    ``save`` notes the runs in that folder, and ``open`` finds them again in another session, so
    a later batch meets the lines of all batches before it.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, fanout: int):
        self.spark, self.path, self.buckets, self.fanout = spark, path.rstrip("/"), buckets, fanout
        self.levels: list[list[str]] = []

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int, fanout: int = 3) -> Runs:
        """The runs saved below ``path``; none yet: no runs. Saved runs keep their number of buckets."""
        noted = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/levels")
        if not noted.getFileSystem(spark._jsc.hadoopConfiguration()).exists(noted):
            return cls(spark, path, buckets, fanout)
        rows = spark.read.schema("level int, place int, name string, buckets int").parquet(f"{path.rstrip('/')}/levels").orderBy("level", "place").collect()
        out = cls(spark, path, rows[0].buckets if rows else buckets, fanout)
        out.levels = [[r.name for r in rows if r.level == k] for k in range(1 + max((r.level for r in rows), default=-1))]
        for r in rows:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {r.name} (k1 BIGINT, k2 BIGINT, owner BIGINT) USING parquet CLUSTERED BY (k1, k2) SORTED BY (k1, k2) INTO {r.buckets} BUCKETS LOCATION '{out.path}/{r.name}'")
        return out

    def save(self) -> None:
        rows = [(level, place, name, self.buckets) for level, names in enumerate(self.levels) for place, name in enumerate(names)]
        self.spark.createDataFrame(rows, "level int, place int, name string, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/levels")

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.path}/{name}").format("parquet").saveAsTable(name)
        return name

    def merge(self, owners: DataFrame) -> DataFrame:
        """``owners`` with ``before``, the owner that a run has for the hash. Runs share no hash; each is read in its
        buckets as it lies, so only ``owners`` is shuffled, once for all runs."""
        names = [t for level in self.levels for t in level]
        out = owners.repartition(self.buckets, *KEY) if names else owners
        for k, t in enumerate(names):
            out = out.join(self.spark.table(t).select(*KEY, F.col("owner").alias(f"before{k}")).hint("merge"), list(KEY), "left")
        before = F.coalesce(*(f"before{k}" for k in range(len(names)))) if names else F.lit(None).cast("long")
        return out.select(*owners.columns, before.alias("before"))

    def add(self, rows: DataFrame) -> None:
        """A new run of level 0; compacts full levels. Runs share no hash, so a merge only sorts."""
        level, run = 0, self._write(rows)
        while True:
            if len(self.levels) <= level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            old, self.levels[level] = self.levels[level], []
            merged = self.spark.table(old[0])
            for t in old[1:]:
                merged = merged.unionByName(self.spark.table(t))
            run = self._write(merged)
            self.forget(old)
            level += 1

    def forget(self, tables: list[str]) -> None:
        for t in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{t}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        self.forget([t for level in self.levels for t in level])
        self.levels = []


def batches_of(docs: DataFrame, n: int) -> list[tuple[int | None, int | None]]:
    """Half-open ranges of ``doc_id`` with about as many rows each."""
    cuts = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 1000)).first()[0] if n > 1 else None
    cuts = sorted(set(cuts or []))
    return list(zip([None, *cuts], [*cuts, None], strict=True))


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 3, buckets: int | None = None, prefix: str = "", store: str | None = None) -> DataFrame:
    """``docs`` with the lines dropped from ``text``, and n_lines and n_dropped (long).

    ``prefix`` goes before the names of the two counts; a column of ``docs`` of such a
    full name is replaced, all others pass through under any name. ``store``: a folder all
    executors share, in which the runs stay: lines of earlier calls go as well, whatever the ids,
    and the lines of this call are added. Without it the runs last for the call.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "line-runs")
    counts, columns = (f"{prefix}n_lines", f"{prefix}n_dropped"), docs.columns
    docs, back = carried(docs, counts)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = Runs.open(spark, store, n, fanout) if store else Runs(spark, space.path, n, fanout)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("doc"), F.col("text").cast("string"))
    # the texts are read once; a batch is a range of what is written, by the files' own bounds
    all_pairs = space.write(texts.mapInArrow(_keys(min_chars), "k1 long, k2 long, doc long"), "pairs")
    lost, written = None, ["pairs"]
    ranges = batches_of(docs, batches)
    for k, (low, high) in enumerate(ranges):
        pairs = all_pairs
        if low is not None:
            pairs = pairs.where(F.col("doc") >= low)
        if high is not None:
            pairs = pairs.where(F.col("doc") < high)
        owners = pairs.groupBy(*KEY).agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))
        merged = runs.merge(owners)
        merged = space.write(merged, f"merged{k}")
        if store or k + 1 < len(ranges):  # else no batch meets the run
            runs.add(merged.where("before is null").select(*KEY, "owner"))
        shared = merged.where("before is not null or owner < last").select(*KEY, F.coalesce("before", "owner").alias("owner"), (F.col("before").isNotNull()).alias("known"))
        gone = pairs.join(shared.hint("merge"), list(KEY)).where("doc <> owner or known").select("doc", *KEY)
        lost = gone if lost is None else lost.unionByName(gone)
        written.append(f"merged{k}")
    by_doc = space.write(lost.groupBy("doc").agg(F.collect_list(F.struct(*KEY)).alias("lost")), "lost")
    if store:
        runs.save()
    else:
        runs.close()
    space.drop(*written)
    joined = docs.withColumn("doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST))).join(by_doc, "doc", "left").drop("doc")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text") + ", text string, n_lines long, n_dropped long"
    names = {c: k for k, c in back.items()} | {"doc_id": "doc_id", "text": "text"}
    out = joined.mapInArrow(_without(min_chars), schema)
    return out.select(*(F.col(names[c]).alias(c) for c in columns if c in names), *(F.col(c).alias(prefix + c) for c in ("n_lines", "n_dropped")))
