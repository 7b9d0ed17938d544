"""Readers of entries, word lists, ratings, frequency lists, synset archives and configuration."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossarion.functions import lexical

ENTRY_SCHEMA = (
    "id string, pos string, wc int, codes array<string>, lemma string, nsyll int, phrase_type string, spelling_region string, sources array<string>, license_sources map<string,array<string>>, frequency_tier string, frequency_rank int, "
    "concreteness string, concreteness_rating double, register_tags array<string>, temporal_tags array<string>, domain_tags array<string>, region_tags array<string>, is_inflected boolean, is_abbreviation boolean, sense_offset long, sense_length int"
)


def entries(spark: SparkSession, path: str, strict: bool = False, schema: str = ENTRY_SCHEMA) -> DataFrame:
    """JSON lines under an explicit schema. Strict fails on a bad line; lenient drops it. Blank lines never count."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    rows = spark.read.schema(f"{schema}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return rows.where(F.col("_bad").isNull()).drop("_bad")


def with_order(df: DataFrame, key: str = "ord") -> DataFrame:
    """Input order: increasing within files read in path order."""
    return df.withColumn(key, F.monotonically_increasing_id())


def last_wins(df: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    others = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("x")).select(key, "x.*")


def grouped(df: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    """Rows of each key as one array, in input order."""
    others = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, *others))), lambda x: x.dropFields(order)).alias("rows"))


def word_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(lexical.normalize_word(F.col("value")).alias("id")).where("id <> ''").distinct()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, line (from 1): each file part counts its own lines, the parts' totals are added."""
    rows = spark.read.text(path).withColumn("__id", F.monotonically_increasing_id())
    rows = rows.withColumns({"__p": F.shiftright("__id", 33), "__k": F.col("__id").bitwiseAND((1 << 33) - 1)})
    totals = rows.groupBy("__p").agg(F.count("*").alias("__n"))
    before = totals.withColumn("__b", F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__n")).drop("__n")
    return rows.join(F.broadcast(before), "__p").select("value", (F.col("__b") + F.col("__k") + 1).alias("line"))


def frequency_list(spark: SparkSession, path: str) -> DataFrame:
    """word, rank: the line number; blank lines and words with an outer apostrophe use a rank up and are dropped; of a repeated word the last."""
    rows = numbered_lines(spark, path).select(F.lower(F.regexp_extract("value", r"^\s*(\S+)", 1)).alias("word"), F.col("line").cast("int").alias("rank"))
    rows = rows.where((F.col("word") != "") & ~F.col("word").startswith("'") & ~F.col("word").endswith("'"))
    return rows.groupBy("word").agg(F.max("rank").alias("rank"))


def _table(spark: SparkSession, path: str, least: int) -> DataFrame:
    rows = numbered_lines(spark, path).where("line > 1").select(F.split("value", "\t").alias("c"), "line")
    return rows.where(F.size("c") >= least)


def concreteness(spark: SparkSession, path: str) -> DataFrame:
    """word, mean, sd from columns 0, 2 and 3; unreadable means are dropped, a missing sd is 0, of a repeated word the last."""
    num = lambda k: F.expr(f"try_cast(get(c, {k}) as double)")
    rows = _table(spark, path, 3).select(F.lower(F.trim(F.get("c", F.lit(0)))).alias("word"), num(2).alias("mean"), F.coalesce(num(3), F.lit(0.0)).alias("sd"), "line").where("mean is not null")
    return last_wins(rows, "word", "line")


def aoa(spark: SparkSession, path: str) -> DataFrame:
    """word, mean, sd, known; known is the share of raters who knew the word."""
    num = lambda k: F.expr(f"try_cast(get(c, {k}) as double)")
    rows = _table(spark, path, 4).select(F.lower(F.trim(F.get("c", F.lit(0)))).alias("word"), num(1).alias("mean"), F.coalesce(num(2), F.lit(0.0)).alias("sd"), F.coalesce(num(3), F.lit(0.0)).alias("known"), "line").where("mean is not null")
    return last_wins(rows, "word", "line")


def commented_list(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path).select(F.lower(F.trim(F.col("value"))).alias("id"))
    return rows.where((F.col("id") != "") & ~F.col("id").startswith("#")).distinct()


def severity_list(spark: SparkSession, path: str) -> DataFrame:
    """id, severity from a JSON array of {match, severity}; alternatives apart, of a repeated word the first."""
    rows = spark.read.option("multiLine", True).schema("match string, severity int").json(path).withColumn("ord", F.monotonically_increasing_id())
    words = rows.select(F.posexplode(F.split("match", r"\|")).alias("k", "id"), "severity", "ord").withColumn("id", F.lower(F.trim("id"))).where("id <> ''")
    names = F.when(F.col("s") == 1, "mild").when(F.col("s") == 2, "medium").when(F.col("s") == 3, "strong").when(F.col("s") == 4, "severe")
    return words.groupBy("id").agg(F.min_by("severity", F.struct("ord", "k")).alias("s")).select("id", names.alias("severity"))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import yaml

    pos = {"n": "NOU", "v": "VRB", "a": "ADJ", "s": "ADJ", "r": "ADV"}
    for batch in batches:
        rows = []
        for content in batch.column(0).to_pylist():
            with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
                for member in tar:
                    name = member.name.rsplit("/", 1)[-1]
                    if not name.endswith((".yaml", ".yml")):
                        continue
                    body = yaml.safe_load(tar.extractfile(member)) or {}
                    if name.startswith("entries"):
                        rows += [(lemma, pos[p], s["synset"], None) for lemma, kinds in body.items() for p, x in kinds.items() if p in pos for s in (x or {}).get("sense", [])]
                    else:
                        rows += [(None, None, synset, name.rsplit(".", 1)[0]) for synset in body]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], names=["lemma", "pos", "synset", "lexname"])


def synsets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(edges: lemma, pos, synset; names: synset, lexname) of a tar archive of YAML files."""
    rows = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_unpack, "lemma string, pos string, synset string, lexname string")
    return rows.where("lemma is not null").select("lemma", "pos", "synset"), rows.where("lexname is not null").select("synset", "lexname").distinct()


def sections(spark: SparkSession, path: str) -> DataFrame:
    """section, line: lines below ``=== name ===`` headers."""
    rows = numbered_lines(spark, path)
    name = F.nullif(F.regexp_extract("value", r"^===\s*(.*?)\s*===$", 1), F.lit(""))
    # names run on within ranges of lines; a range's last name runs on into the ranges after it
    rows = rows.withColumns({"__s": name, "__r": F.floor(F.col("line") / 100_000)})
    last = rows.groupBy("__r").agg(F.max_by("__s", F.when(F.col("__s").isNotNull(), F.col("line"))).alias("__l"))
    before = last.select("__r", F.last("__l", ignorenulls=True).over(W.orderBy("__r").rowsBetween(W.unboundedPreceding, -1)).alias("__b"))
    own = F.last("__s", ignorenulls=True).over(W.partitionBy("__r").orderBy("line").rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = rows.withColumn("__o", own).join(before, "__r").withColumn("section", F.coalesce("__o", "__b"))
    return rows.where(name.isNull() & F.col("section").isNotNull() & (F.trim("value") != "")).select("section", F.col("value").alias("line"))


def first_existing(spark: SparkSession, *paths: str) -> str | None:
    """The first path that the session's file systems have."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return p
    return None
