"""From raw documents to packed training sequences.

Every stage reads all that its predecessor kept and is written as Parquet, so a
lost executor costs tasks of one stage. All stages but the last return the
columns of ``documents``. Nulls, empty texts, repeated rows and empty tables are
treated as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarion.llm import circulant_minhash, decision_list, line_runs, packing, suffix_dedup
from glossarion.llm._shared import Workspace, table
from glossarion.llm.queries import tokenizer_file


def _with_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents; n_chars follows the text."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(columns) if "n_chars" in columns else df.select(columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list rejects."""
    rules = decision_list.fit(docs, table(spark, sf_dir, "labels"))
    return decision_list.judge(docs, rules, "__q_").where("__q_kept").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has."""
    return _with_text(line_runs.dedup_lines(docs, prefix="__lines_"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; rows of one id are one document."""
    kept = circulant_minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")), "left_semi").select(docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the code points that repeated 200-byte strings cover."""
    out = suffix_dedup.remove_repeats(docs, whole_characters=True, prefix="__cut_")
    return _with_text(out.withColumn("text", F.col("__cut_kept").cast("string")), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in sequences of 4096 tokens."""
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("packing", pack_sequences),
]

#: SQL can't express the learned rules, the tokenizer and the packing; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    space, docs = Workspace(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = space.write(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            space.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
