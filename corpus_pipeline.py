"""From raw documents to packed token sequences, in stages that are each written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bundlescope.llm.decontamination import without_leaks
from bundlescope.llm.line_dedup import kept_lines
from bundlescope.llm.near_dups import without_near_duplicates
from bundlescope.llm.packing import packed_digest
from bundlescope.llm.quality import kept_documents
from bundlescope.session import delete_scratch, scratch_path, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules and their host's verdict keep."""
    return kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a later document keeps."""
    return kept_lines(docs, length="n_chars")


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return without_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document left, each with its sequence and place."""
    return packed_digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("minhash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Tokenizing and similarity components are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are a table that the next one reads.

    What a stage wrote for itself goes when its rows are written, and a stage's rows go when
    the next one's are, so the shared folder holds two stages' rows at most.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        delete_scratch(spark, before)
        before = [path]
    return docs
