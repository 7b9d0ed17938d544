"""Shared folder, written tables and ordered buckets used by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none (tests in local mode) a temporary folder
    is created and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="glossarion-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Workspace:
    """A fresh folder below the shared one for the tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back: cuts lineage, survives lost executors."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names or ("",):
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(conf).delete(path, True)

    def release_shuffles(self) -> None:
        """Let the driver drop references to finished shuffles, so that their files go."""
        import gc

        gc.collect()
        self.spark._jvm.System.gc()


def carried(docs: DataFrame, own: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with every column but ``doc_id`` and ``text`` under a name of the operators' own, and
    the names to give back. A column that is named like one of ``own`` results goes: it is replaced."""
    taken = {c.lower() for c in own}
    back = {f"__carried_{k}": c for k, c in enumerate(docs.columns) if c not in ("doc_id", "text") and c.lower() not in taken}
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), *(F.col(f"`{c}`").alias(k) for k, c in back.items())), back


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
