"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from homestat.llm import decontam, linededup, neardup, packing, quality
from homestat.llm.common import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that the base rule or the lost share rejects go."""
    return quality.clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from all documents but the one with the largest id."""
    return linededup.clean(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return neardup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontam.decontaminate(docs, bench)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, placed in sequences."""
    return packing.pack(docs.select("doc_id", "text"), packing.vocabulary_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

#: The last stage tokenises, which SQL cannot express; the run is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch(spark, f"stage-{name}")
            docs.write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
    return docs
