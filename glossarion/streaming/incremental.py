"""Incremental paths: entries from a drop folder enriched as they come, a running tier histogram, cache upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glossarion.functions import lexical
from glossarion.sources.readers import ENTRY_SCHEMA


def entry_stream(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(ENTRY_SCHEMA).option("maxFilesPerTrigger", per_trigger).json(folder)


def enrich_stream(stream: DataFrame, ranks: DataFrame) -> DataFrame:
    """Stateless: a stream-static join by lower-case word gives rank and tier."""
    r = ranks.select(F.col("word").alias("__k"), F.col("rank").alias("__r"))
    out = stream.withColumn("__k", F.lower("id")).join(r, "__k", "left").withColumn("frequency_rank", F.col("__r"))
    return out.withColumn("frequency_tier", lexical.rank_to_tier(F.col("frequency_rank"))).drop("__k", "__r")


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def tier_histogram(stream: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    counts = stream.groupBy("frequency_tier").agg(F.count("*").alias("n"))
    return counts.writeStream.format("memory").queryName(name).option("checkpointLocation", checkpoint).outputMode("complete").trigger(availableNow=True).start()


def upsert_missing(stream: DataFrame, cache_path: str, key: str, fetch, checkpoint: str) -> StreamingQuery:
    """For each micro-batch: keys that the cache at ``cache_path`` lacks are given to ``fetch`` (DataFrame -> DataFrame) and appended."""

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
        new = df.select(key).distinct()
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            new = new.join(spark.read.parquet(cache_path).select(key), key, "left_anti")
        fetch(new).write.mode("append").parquet(cache_path)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
