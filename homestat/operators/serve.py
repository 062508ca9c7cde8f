"""Serving views: batch ⟗ speed merges, weighted averages and the batch-first fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weighted_avg(n_a: str, avg_a: str, n_b: str, avg_b: str, scale: int = 3) -> Column:
    """round((n_a*avg_a + n_b*avg_b) / max(n_a+n_b, 1), scale) over already-rounded averages."""
    return F.round(
        (F.col(n_a) * F.col(avg_a) + F.col(n_b) * F.col(avg_b))
        / F.greatest(F.col(n_a) + F.col(n_b), F.lit(1)),
        scale,
    )


def _merge(batch: DataFrame, speed: DataFrame, keys: list[str], fill: dict) -> DataFrame:
    """Full outer equi-join on ``keys`` (NULL keys do not match: they stay one row
    per side), fill the missing side, add merged count and weighted price.

    Both inputs are per-key aggregates, so this join is small whatever the
    listing volume; Spark plans it as a shuffled hash or sort-merge join.
    """
    merged = batch.join(speed, on=keys, how="full").fillna(fill)
    return merged.withColumns({
        "merged_listings": F.col("total_listings") + F.col("stream_listings"),
        "merged_avg_price": weighted_avg("total_listings", "avg_price_billion",
                                         "stream_listings", "stream_avg_price"),
    })


def merge_by_district(batch_by_district: DataFrame, speed_by_district: DataFrame) -> DataFrame:
    return _merge(batch_by_district, speed_by_district, ["district", "city"], {
        "total_listings": 0, "stream_listings": 0,
        "avg_price_billion": 0.0, "stream_avg_price": 0.0, "avg_price_per_m2": 0.0,
    })


def merge_by_type(batch_by_type: DataFrame, speed_by_type: DataFrame) -> DataFrame:
    return _merge(batch_by_type, speed_by_type, ["property_type"], {
        "total_listings": 0, "stream_listings": 0,
        "avg_price_billion": 0.0, "stream_avg_price": 0.0,
    })


def first_non_empty(*candidates: DataFrame | None) -> DataFrame | None:
    """The first candidate that exists and has a row (a one-row probe job each)."""
    for df in candidates:
        if df is not None and not df.isEmpty():
            return df
    return None
