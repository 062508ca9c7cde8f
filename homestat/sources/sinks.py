"""Sinks: Parquet/CSV outputs, view export, JSON publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.sources.files import CSV_OPTIONS, read_view
from homestat.streaming.speed import to_envelope


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, compression: str = "none", records_per_file: int = 0) -> None:
    """Cleaned table as CSV with header (no index column); ``read_clean`` gives back the same rows.

    No file has more than ``records_per_file`` records, if that is given.
    """
    df.write.mode("overwrite").options(**CSV_OPTIONS, compression=compression, maxRecordsPerFile=records_per_file).csv(path)


def export_views(spark: SparkSession, views: dict[str, str], target: str) -> DataFrame:
    """Copy named views to ``target``/<name>; a missing view is skipped.

    Returns (view, rows, status) with counts taken from the written copy.
    """
    report = []
    for name, source in views.items():
        df = read_view(spark, source)
        if df is None:
            report.append((name, None, "missing"))
            continue
        out = f"{target.rstrip('/')}/{name}"
        write_parquet(df, out)
        report.append((name, spark.read.parquet(out).count(), "ok"))
    return spark.createDataFrame(report, "view string, rows bigint, status string")


def publish_json(listings: DataFrame) -> DataFrame:
    """Key/value frame of the publisher: key = listing_id, value = UTF-8 JSON."""
    return to_envelope(listings).select("key", "value")


def write_kafka(listings: DataFrame, servers: str, topic: str) -> None:
    """Publish listings to a Kafka topic (needs the Kafka connector on the classpath)."""
    (
        publish_json(listings)
        .select(F.col("key").cast("binary"), F.encode("value", "UTF-8").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
