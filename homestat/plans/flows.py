"""Composite flows a user runs: batch, speed and serve.

Each flow writes its outputs as Parquet under one root folder and reads
them back for the next step, so lineage is cut at every published table and a
lost executor only recomputes the current step.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from homestat.constants import PREDICTION_ROWS
from homestat.operators import clean as C
from homestat.operators import ml as M
from homestat.operators import serve as SV
from homestat.operators import views as V
from homestat.plans import warehouse as W
from homestat.sources import files as SF
from homestat.sources import sinks as SK
from homestat.streaming import speed as ST

#: Every batch output that the export copies, in the order of the jobs that write them.
EXPORTED = [
    "by_district", "by_type", "price_dist", "cluster_stats", "clustered", "by_legal", "by_direction",
    "lr_metrics", "lr_coefficients", "lr_predictions", "lr_category_map", "lr_model_params",
]


def _report(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(sorted(counts.items()), "output string, rows bigint")


def batch_outputs(clean: DataFrame, with_models: bool = True) -> dict[str, DataFrame]:
    """The named batch outputs over the cleaned table."""
    out = {name: report.over(clean) for name, report in V.BATCH_VIEWS.items()}
    if with_models:
        seg = M.segments(clean)
        pm = M.train_price_model(clean)
        out |= {"clustered": seg.clustered, "cluster_stats": seg.stats_named,
                "lr_metrics": M.metrics(pm), "lr_coefficients": M.coefficients(pm),
                "lr_predictions": M.predictions(pm, PREDICTION_ROWS), "lr_category_map": M.category_map(pm),
                "lr_model_params": M.model_params(pm)}
    return out


def batch(spark: SparkSession, raw: DataFrame, root: str, with_models: bool = True) -> DataFrame:
    """clean -> EDA views -> K-Means -> regression -> warehouse -> export; returns output row counts."""
    return batch_of(spark, C.clean_listings(raw), root, with_models)


def batch_of(spark: SparkSession, cleaned: DataFrame, root: str, with_models: bool = True) -> DataFrame:
    """``batch`` from the cleaning that is handed in, which is run once, into the written table."""
    cleaned_path = f"{root}/cleaned"
    SK.write_parquet(cleaned, cleaned_path)
    clean = SF.read_clean(spark, cleaned_path)
    counts = {"cleaned": clean.count()}
    for name, df in batch_outputs(clean, with_models).items():
        SK.write_parquet(df, f"{root}/batch/{name}")
        counts[name] = spark.read.parquet(f"{root}/batch/{name}").count()
    db = f"listings_{uuid.uuid4().hex[:10]}"
    counts.update({f"wh.{k}": v for k, v in W.publish(spark, db, cleaned_path, None, f"{root}/warehouse").items()})
    report = export(spark, root, f"{root}/export")
    counts.update({f"export.{r['view']}": r["rows"] for r in report.collect() if r["status"] == "ok"})
    return _report(spark, counts)


def export(spark: SparkSession, root: str, target: str) -> DataFrame:
    """Copy the cleaned table and all batch outputs to the serving location; what is missing is skipped."""
    views = {"cleaned": f"{root}/cleaned"} | {name: f"{root}/batch/{name}" for name in EXPORTED}
    return SK.export_views(spark, views, target)


def speed(spark: SparkSession, clean: DataFrame, root: str, files_per_batch: int | None = None) -> DataFrame:
    """Publish listings as envelope files, run the stream (availableNow) into the
    speed folder plus the live aggregate; returns row counts.  ``files_per_batch``
    bounds a micro-batch; unset, one batch takes what is there."""
    ST.publish_files(clean, f"{root}/topic")
    src = ST.read_envelope_files(spark, f"{root}/topic", max_files_per_trigger=files_per_batch)
    name = f"live_{uuid.uuid4().hex[:10]}"
    ST.run_speed_layer(spark, src, f"{root}/speed", f"{root}/ckpt", trigger=None,
                       aggregate_sink="memory", aggregate_name=name)
    counts = {"speed": SF.read_speed(spark, f"{root}/speed").count(), "live_groups": spark.table(name).count()}
    return _report(spark, counts)


def serve(spark: SparkSession, root: str) -> dict[str, int]:
    """Speed views, merged views and the summary from ``root``/{cleaned,batch,speed}.

    Without a speed folder the summary is batch-only and no merge is written.
    """
    clean = SF.read_clean(spark, f"{root}/cleaned")
    speed_df = SF.read_speed(spark, f"{root}/speed")
    out = f"{root}/serve"
    counts = {}
    if speed_df is not None:
        sd, st = V.speed_by_district(speed_df), V.speed_by_type(speed_df)
        SK.write_parquet(sd, f"{out}/speed_by_district")
        SK.write_parquet(st, f"{out}/speed_by_type")
        bd = SF.read_view(spark, f"{root}/batch/by_district")
        bt = SF.read_view(spark, f"{root}/batch/by_type")
        if bd is not None:
            SK.write_parquet(SV.merge_by_district(bd, spark.read.parquet(f"{out}/speed_by_district")),
                             f"{out}/merged_by_district")
            counts["merged_by_district"] = spark.read.parquet(f"{out}/merged_by_district").count()
        if bt is not None:
            SK.write_parquet(SV.merge_by_type(bt, spark.read.parquet(f"{out}/speed_by_type")),
                             f"{out}/merged_by_type")
            counts["merged_by_type"] = spark.read.parquet(f"{out}/merged_by_type").count()
    SK.write_parquet(V.speed_summary(clean, speed_df), f"{out}/speed_summary")
    counts["speed_summary"] = 1
    return counts


__all__ = ["batch", "batch_of", "batch_outputs", "export", "speed", "serve"]
