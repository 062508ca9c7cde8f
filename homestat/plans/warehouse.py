"""Warehouse (serving) layer: external tables, statistics tables and the merged view.

The catalog objects are a database with external Parquet tables over the
cleaned and speed folders, one managed table per report (declared once in
``operators.views``) and a persistent ``merged_listings`` view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.operators.views import MERGED_TABLES, WAREHOUSE_TABLES, Report
from homestat.schema import CLEAN_SCHEMA, MERGED_COLUMNS, SPEED_SCHEMA, ddl


def merged_listings(clean: DataFrame, speed: DataFrame) -> DataFrame:
    """The shared columns of batch and stream rows, each with its source; no row is removed."""
    tagged = [df.select(*MERGED_COLUMNS, F.lit(name).alias("data_source")) for name, df in (("batch", clean), ("stream", speed))]
    return tagged[0].unionByName(tagged[1])


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")


def external_table(spark: SparkSession, db: str, name: str, schema, path: str) -> DataFrame:
    """An external Parquet table over ``path`` with a declared schema."""
    spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
    spark.sql(f"CREATE TABLE {db}.{name} ({ddl(schema)}) USING PARQUET LOCATION '{path}'")
    return spark.table(f"{db}.{name}")


def report_table(spark: SparkSession, db: str, name: str, report: Report, source: str) -> DataFrame:
    """A managed table with a report's rows over the table or view ``source``."""
    report.over(spark.table(f"{db}.{source}")).write.mode("overwrite").format("parquet").saveAsTable(f"{db}.{name}")
    return spark.table(f"{db}.{name}")


def merged_view(spark: SparkSession, db: str) -> DataFrame:
    """The persistent view over both external tables."""
    columns = ", ".join(MERGED_COLUMNS)
    parts = [f"SELECT {columns}, '{name}' AS data_source FROM {db}.{source}"
             for name, source in (("batch", "listings"), ("stream", "streaming_listings"))]
    spark.sql(f"CREATE OR REPLACE VIEW {db}.merged_listings AS {' UNION ALL '.join(parts)}")
    return spark.table(f"{db}.merged_listings")


def publish(spark: SparkSession, db: str, listings_path: str, speed_path: str | None,
            location: str | None = None) -> dict[str, int]:
    """Create database, external tables, statistics tables and the merged view.

    ``location`` places the database (and its managed tables) in a given folder;
    by default the catalog's warehouse is used.  Only a missing speed folder is
    treated as "no stream yet"; any other error propagates.  Returns row
    counts of what was created.
    """
    create_database(spark, db, location)
    counts = {"listings": external_table(spark, db, "listings", CLEAN_SCHEMA, listings_path).count()}
    for name, report in WAREHOUSE_TABLES.items():
        counts[name] = report_table(spark, db, name, report, "listings").count()
    if speed_path is None or not _exists(spark, speed_path):
        return counts
    counts["streaming_listings"] = external_table(spark, db, "streaming_listings", SPEED_SCHEMA, speed_path).count()
    merged_view(spark, db)
    for name, report in MERGED_TABLES.items():
        counts[name] = report_table(spark, db, name, report, "merged_listings").count()
    return counts


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)
