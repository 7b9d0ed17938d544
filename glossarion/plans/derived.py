"""A lexicon derived from the driver's tables: words, senses, ranks and ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glossarion.functions import lexical
from glossarion.operators import lexicon as lx
from glossarion.sources.sinks import kept

POS_OF_LANG = {"en": "NOU", "fr": "VRB", "de": "ADJ", "es": "ADV"}
REGION_OF_LANG = {"en": "ENUS", "de": "ENGB"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_lang(mapping: dict[str, str], c: Column) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def tokens(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with a row and an ``id`` for each run of a-z of the lower-case text."""
    return df.withColumn("id", F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), 0)))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text")
    return tokens(docs).groupBy("id").agg(F.count("*").alias("n"))


def rank_by_count(df: DataFrame, name: str = "rank") -> DataFrame:
    """Rank by descending count, then word, without one task for all words: words are ranked within their
    count, and each count's words come after those of all larger counts, of which there are few kinds. ``df`` is read three times, so it is written first."""
    keyed = kept(df).withColumn("__p", F.substring("id", 1, 2))
    totals = keyed.groupBy("n", "__p").agg(F.count("*").alias("__k"))
    per = totals.groupBy("n").agg(F.sum("__k").alias("__c"))
    before = per.withColumn("__b", F.sum("__c").over(W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__c")).drop("__c")
    # the many words of a small count are ranked within their first two letters
    parts = totals.withColumn("__q", F.sum("__k").over(W.partitionBy("n").orderBy("__p").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__k")).drop("__k")
    inner = F.row_number().over(W.partitionBy("n", "__p").orderBy("id"))
    out = keyed.withColumn("__r", inner).join(parts, ["n", "__p"]).join(before, "n")
    return out.withColumn(name, (F.col("__b") + F.col("__q") + F.col("__r")).cast("int")).drop("__b", "__q", "__r", "__p")


def ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_by_count(counts(spark, sf_dir)).select(F.col("id").alias("word"), "rank", F.col("n").alias("count"))


def other_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    one = lambda t, c: tokens(table(spark, sf_dir, t).select(c), c).select("id").distinct()
    return {"eowl": one("benchmark", "text"), "wordnet": one("conversations", "text"), "brysbaert": one("part", "p_name")}


def words(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> DataFrame:
    """id, sources, wc, license_sources, frequency_rank, frequency_tier, nsyll, lemma and region columns; ``counted``: ``counts``, if made already."""
    base = rank_by_count(counts(spark, sf_dir) if counted is None else counted, "frequency_rank").select("id", F.array(F.lit("wikt")).alias("sources"), F.lit(1).alias("wc"), "frequency_rank")
    out = lx.merge_sources(base, other_sources(spark, sf_dir))
    n = F.regexp_count("id", F.lit("[aeiouy]+"))
    return (
        out.withColumn("frequency_tier", lexical.rank_to_tier(F.col("frequency_rank")))
        .withColumn("nsyll", F.when(n > 0, n).cast("int"))
        .withColumn("spelling_region", F.when(F.col("id").endswith("our"), "en-GB").when(F.col("id").endswith("or"), "en-US"))
        .withColumn("concreteness_rating", F.when(F.length("id") % 3 != 0, (F.ascii("id") % 5 + 1).cast("double")))
        .withColumn("concreteness", lexical.concreteness_category(F.col("concreteness_rating")))
        .withColumn("is_inflected", F.col("id").rlike("(ing|ed)$"))
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, lang, source, n, sense_ord (least document), toxic and quality of all places of a word in texts of a language and source.

    Labels are joined with documents, not with their words: a word's least values are the same over all its places, so nothing is grouped per document.
    """
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text").join(labels, "doc_id", "left")
    return tokens(docs).groupBy("id", "lang", "source").agg(F.count("*").alias("n"), F.min("doc_id").alias("sense_ord"), F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))


def senses(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """One sense for each word, language and source: id, sense_ord, pos, codes, lemma; ``rows``: ``places``, if made already."""
    rows = places(spark, sf_dir) if rows is None else rows
    inflected = F.col("id").rlike("(ing|ed)$")
    codes = F.array_sort(F.array_compact(F.array(F.when(F.col("toxic") == 1, "RVLG"), F.when(F.col("quality") == 0, "TARC"), by_lang(REGION_OF_LANG, F.col("lang")), F.when(inflected, "INFL"))))
    stem = F.regexp_extract("id", "^(.*?)(ing|ed)$", 1)
    return rows.select("id", "sense_ord", by_lang(POS_OF_LANG, F.col("lang")).alias("pos"), codes.alias("codes"), F.when(inflected & (F.length(stem) > 1), stem).alias("lemma"), "source")


def words_and_senses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``words`` and ``senses`` of texts that are read once."""
    rows = kept(places(spark, sf_dir))
    return words(spark, sf_dir, rows.groupBy("id").agg(F.sum("n").alias("n"))), senses(spark, sf_dir, rows)


def part_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, mean, sd, known, from the words of part names."""
    t = tokens(table(spark, sf_dir, "part").select("p_name", "p_size"), "p_name")
    return t.groupBy(F.col("id").alias("word")).agg((F.avg("p_size") / 10).alias("mean"), (F.max("p_size") / 50).alias("sd"), (F.min("p_size") / 2).alias("known"))
