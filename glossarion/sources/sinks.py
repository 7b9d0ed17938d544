"""Writers of word lists, entries, maps, statistics and manifests."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Module -> (column, description). More can be added.
MODULES = {
    "frequency": ("frequency_tier", "frequency tier"),
    "concreteness": ("concreteness", "concreteness category"),
    "syllables": ("nsyll", "syllable count"),
    "sources": ("sources", "sources of the word"),
}
ENTRY_ORDER = ("id", "pos", "wc", "nsyll", "codes", "lemma", "morphology", "definition_level", "definition_type", "senseid")
DEFAULTS = {"frequency_tier": "Z", "is_phrase": False, "is_inflected": False}


def scratch(spark: SparkSession) -> str:
    """A fresh folder below the one that all executors share; only where the session names none (tests) a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        import tempfile

        root = "file://" + tempfile.mkdtemp(prefix="glossarion-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/lexicon-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once: branches of a plan that read it do not each make it anew."""
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def module_values(words: DataFrame, module: str) -> DataFrame:
    """word, value: non-null (and non-empty) values of a module."""
    c = MODULES[module][0]
    out = words.select(F.col("id").alias("word"), F.col(c).alias("value")).where("value is not null")
    return out.where(F.size("value") > 0) if module == "sources" else out


def without_defaults(df: DataFrame, defaults=None) -> DataFrame:
    """Columns equal to their default become null, which JSON writers leave out; known fields come first."""
    for name, value in (defaults or DEFAULTS).items():
        if name in df.columns:
            df = df.withColumn(name, F.when(F.col(name) != value, F.col(name)))
    first = [c for c in ENTRY_ORDER if c in df.columns]
    return df.select(*first, *(c for c in df.columns if c not in first))


def write_jsonl(df: DataFrame, path: str, sorted_keys: bool = False, gzip: bool = False) -> None:
    """A line for each row, nulls left out."""
    out = df.select(sorted(df.columns)) if sorted_keys else df
    out.write.mode("overwrite").option("compression", "gzip" if gzip else "none").json(path)


def lines(words: DataFrame, fmt: str = "text", fields: list[str] | None = None) -> DataFrame:
    """The output block's formats as one ``value`` column; an unknown format is a list of words."""
    cols = ["id", *(c for c in fields or [] if c != "id")]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    if fmt == "jsonl":
        return words.select((F.to_json(F.struct(*sorted(words.columns))) if fields is not None else F.to_json(F.struct("id"))).alias("value"))
    if fmt == "csv" and fields:
        return words.select(F.concat_ws(",", *(F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"')) for t in text)).alias("value"))
    if fmt in ("text", "tsv") and fields:
        return words.select(F.concat_ws("\t", *text).alias("value"))
    return words.select(F.col("id").alias("value"))


def write_list(words: DataFrame, path: str, fmt: str = "text", fields: list[str] | None = None) -> None:
    """Sorted lines in ordered part files; csv and tsv with a header line in each part."""
    ordered = words.orderBy("id")
    if fmt in ("csv", "tsv") and fields:
        cols = ["id", *(c for c in fields if c != "id")]
        out = ordered.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in cols))
        out.write.mode("overwrite").csv(path, header=True, sep="," if fmt == "csv" else "\t", quoteAll=fmt == "csv", escape='"')
    else:
        lines(ordered, fmt, fields).write.mode("overwrite").text(path)


def json_array(words: DataFrame, limit: int, full: bool = False) -> str:
    """An indented JSON array of a limited result."""
    rows = [json.loads(r[0]) for r in words.limit(limit).select(F.to_json(F.struct(*words.columns))).collect()]
    return json.dumps(rows if full else [r["id"] for r in rows], indent=2, sort_keys=True, ensure_ascii=False)


def project(df: DataFrame, expression: str) -> DataFrame:
    """The object projection ``{a, b: .c}`` of a row; other expressions are refused."""
    body = expression.strip()
    if not (body.startswith("{") and body.endswith("}")):
        raise ValueError("only object projections are supported")
    out = []
    for part in filter(None, (p.strip() for p in body[1:-1].split(","))):
        name, _, source = part.partition(":")
        out.append(F.col((source.strip() or name).lstrip(".")).alias(name.strip().lstrip(".")))
    return df.select(*out)


def manifest(spark, path: str) -> DataFrame:
    """path, bytes, sha256 and entries (lines that are no comment) of each file; entries only for text tables."""
    files = spark.read.format("binaryFile").load(path)
    text = F.split(F.col("content").cast("string"), "\n")
    n = F.size(F.filter(text, lambda x: (F.trim(x) != "") & ~x.startswith("#")))
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.when(F.col("path").rlike(r"\.(txt|tsv|csv)$"), n).alias("entries"), F.col("modificationTime").alias("modified"))


def statistics_json(frames: dict[str, DataFrame], **more) -> str:
    """Small aggregates in one document; each frame is a bounded summary."""
    body = {name: [r.asDict(True) for r in df.collect()] for name, df in frames.items()}
    return json.dumps(body | more, indent=2, sort_keys=True, default=str, ensure_ascii=False)
