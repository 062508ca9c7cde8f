"""Dashboard queries: facets, filter, KPIs, fallbacks, top-k, feed and detail.

Everything is a DataFrame computed by Spark; only scalars (facet bounds, a
quantile) come back to the driver, never listing rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestat.constants import (
    ALL_FACET,
    DETAIL_ROWS,
    LATEST_FEED_ROWS,
    PRICE_TIER_LABELS,
    SAMPLE_ROWS,
    TOP_DISTRICTS,
)
from homestat.functions.parse import truncate_title
from homestat.operators.quantiles import value_at_ranks
from homestat.schema import DETAIL_COLUMNS


@dataclass(frozen=True)
class Facets:
    property_type: str = ALL_FACET
    city: str = ALL_FACET
    price_lo: float | None = None
    price_hi: float | None = None


def facet_values(clean: DataFrame) -> DataFrame:
    """Selectable values: sorted distinct property types and cities (NULL dropped).

    Both facets come from one scan (unpivot), then one distinct aggregate.
    """
    return (
        clean.selectExpr("stack(2, 'property_type', property_type, 'city', city) as (facet, value)")
        .where(F.col("value").isNotNull()).distinct().orderBy("facet", "value")
    )


def price_range(clean: DataFrame) -> DataFrame:
    """Default price slider: minimum price and the 0.95 quantile (linear interpolation).

    One aggregate gives the count and the minimum; the exact quantile then
    reads only the two ranks it needs.
    """
    values = clean.select(F.col("price_billion").cast("double").alias("x")).where(
        F.col("x").isNotNull() & ~F.isnan("x"))
    head = values.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo")).first()
    n, lo = head["n"], head["lo"]
    p95 = None
    if n:
        spot = 0.95 * (n - 1)
        ranks = sorted({math.floor(spot), math.ceil(spot)})
        got = value_at_ranks(values, ranks, n)
        a, b = got[math.floor(spot)], got[math.ceil(spot)]
        p95 = a + (b - a) * (spot - math.floor(spot))
    spark = clean.sparkSession
    return spark.createDataFrame([(lo, p95)], "min_price double, max_price double")


def default_facets(clean: DataFrame) -> Facets:
    row = price_range(clean).first()
    return Facets(price_lo=row["min_price"], price_hi=row["max_price"])


def filter_facets(clean: DataFrame, facets: Facets) -> DataFrame:
    """Equality on type and city unless 'all'; closed price range.  Pushed to the scan."""
    df = clean
    if facets.property_type != ALL_FACET:
        df = df.where(F.col("property_type") == facets.property_type)
    if facets.city != ALL_FACET:
        df = df.where(F.col("city") == facets.city)
    if facets.price_lo is not None:
        df = df.where(F.col("price_billion") >= facets.price_lo)
    if facets.price_hi is not None:
        df = df.where(F.col("price_billion") <= facets.price_hi)
    return df


def kpi_cards(filtered: DataFrame, speed: DataFrame | None, recent: DataFrame | None = None) -> DataFrame:
    """One row: total (filtered + stream), mean price, mean price/m², most listed
    district (ties -> smallest name), stream total and latest feed size: the rows
    of the ``recent`` files, or the stream total when there are none.

    Two-level aggregation: per-district partial sums (map-side combined), then
    one small fold; the speed count is stacked in, not joined.
    """
    per_district = filtered.groupBy("district").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price_billion").alias("sp"), F.count("price_billion").alias("np"),
        F.sum("price_per_m2_million").alias("sm"), F.count("price_per_m2_million").alias("nm"),
    )
    batch = per_district.agg(
        F.sum("n").alias("filtered_rows"),
        (F.sum("sp") / F.sum("np")).alias("avg_price"),
        (F.sum("sm") / F.sum("nm")).alias("avg_price_per_m2"),
        F.min_by("district", F.when(F.col("district").isNotNull(),
                                    F.struct((-F.col("n")).alias("k"), F.col("district").alias("d")))
                 ).alias("top_district"),
    )
    if speed is not None:
        stream = speed.agg(F.count(F.lit(1)).alias("stream_total"))
        rows = batch.unionByName(stream, allowMissingColumns=True)
    else:
        rows = batch.withColumn("stream_total", F.lit(0).cast("bigint"))
    if recent is not None:
        rows = rows.unionByName(recent.agg(F.count(F.lit(1)).alias("recent_rows")), allowMissingColumns=True)
    else:
        rows = rows.withColumn("recent_rows", F.lit(None).cast("bigint"))
    return rows.agg(
        (F.coalesce(F.sum("filtered_rows"), F.lit(0)) + F.coalesce(F.sum("stream_total"), F.lit(0)))
        .cast("bigint").alias("total_listings"),
        F.max("avg_price").alias("avg_price"),
        F.max("avg_price_per_m2").alias("avg_price_per_m2"),
        F.max("top_district").alias("top_district"),
        F.coalesce(F.sum("stream_total"), F.lit(0)).cast("bigint").alias("stream_total"),
        F.coalesce(F.nullif(F.max("recent_rows"), F.lit(0)), F.sum("stream_total"), F.lit(0)).cast("bigint").alias("latest_feed_rows"),
    )


def layer_status(clean: DataFrame | None, speed: DataFrame | None, merged: DataFrame | None) -> DataFrame:
    """Batch present / speed has rows / merged view present, with counts."""
    parts = []
    if clean is not None:
        parts.append(clean.agg(F.count(F.lit(1)).alias("batch_total")))
    if speed is not None:
        parts.append(speed.agg(F.count(F.lit(1)).alias("stream_total")))
    if merged is not None:
        parts.append(merged.agg(F.count(F.lit(1)).alias("merged_rows")))
    if not parts:
        raise ValueError("no layer given")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    for c in ("batch_total", "stream_total", "merged_rows"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("bigint"))
    folded = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
                        for c in ("batch_total", "stream_total", "merged_rows")])
    return folded.select(
        (F.col("batch_total") > 0).alias("batch_ok"),
        (F.col("stream_total") > 0).alias("speed_ok"),
        (F.col("merged_rows") > 0).alias("serving_ok"),
        "batch_total", "stream_total",
        (F.col("batch_total") + F.col("stream_total")).alias("merged_total"),
    )


def district_fallback(filtered: DataFrame) -> DataFrame:
    """district -> mean price, listing count (NULL district dropped, as a pandas groupby does)."""
    return filtered.where(F.col("district").isNotNull()).groupBy("district").agg(
        F.avg("price_billion").alias("avg_price_billion"),
        F.count("listing_id").alias("merged_listings"),
    )


def direction_fallback(filtered: DataFrame) -> DataFrame:
    """direction -> listing count, mean price/m²; NULL and the text 'None' dropped."""
    return (
        filtered.where(F.col("direction").isNotNull())
        .groupBy("direction").agg(
            F.count("listing_id").alias("count"),
            F.avg("price_per_m2_million").alias("avg_price_per_m2"),
        )
        .where(F.col("direction") != "None")
    )


def group_sizes(filtered: DataFrame) -> DataFrame:
    """Row counts per property_type, price_tier and legal_status in one pass
    (grouping sets); NULL keys dropped."""
    dims = ["property_type", "price_tier", "legal_status"]
    g = filtered.groupingSets([[d] for d in dims], *dims).agg(
        F.count(F.lit(1)).alias("count"),
        F.grouping_id().alias("gid"),
    )
    n = len(dims)
    dim_expr = None
    value_expr = None
    for i, d in enumerate(dims):
        gid = (2 ** n - 1) - 2 ** (n - 1 - i)
        dim_expr = (F.when(F.col("gid") == gid, F.lit(d)) if dim_expr is None
                    else dim_expr.when(F.col("gid") == gid, F.lit(d)))
        value_expr = (F.when(F.col("gid") == gid, F.col(d)) if value_expr is None
                      else value_expr.when(F.col("gid") == gid, F.col(d)))
    return (
        g.select(dim_expr.alias("dimension"), value_expr.alias("value"), "count")
        .where(F.col("value").isNotNull())
    )


def type_ppm(source: DataFrame) -> DataFrame:
    """property_type -> mean price/m², ascending (NULL means dropped)."""
    return (
        source.groupBy("property_type").agg(F.avg("price_per_m2_million").alias("avg_price_per_m2"))
        .where(F.col("avg_price_per_m2").isNotNull())
        .orderBy("avg_price_per_m2", "property_type")
    )


def top_districts(district_view: DataFrame, n: int = TOP_DISTRICTS) -> DataFrame:
    """The ``n`` districts with most listings among rows with a price column.

    Uses the merged columns when present, else the batch ones.
    """
    cols = district_view.columns
    price_col = next(c for c in ["merged_avg_price", "avg_price_billion", "avg_price"] if c in cols)
    count_col = next(c for c in ["merged_listings", "total_listings", "count"] if c in cols)
    keys = [c for c in ["district", "city"] if c in cols]
    return (
        district_view.where(F.col(price_col).isNotNull())
        .orderBy(F.desc(count_col), *[F.asc_nulls_first(k) for k in keys])
        .limit(n)
        .select(*keys, F.col(price_col).alias("avg_price"), F.col(count_col).alias("listings"))
    )


def tier_ordinal(col: str = "price_tier"):
    expr = None
    for i, label in enumerate(PRICE_TIER_LABELS):
        expr = F.when(F.col(col) == label, i) if expr is None else expr.when(F.col(col) == label, i)
    return expr


def sort_tiers(tier_view: DataFrame) -> DataFrame:
    """Tier rows in the fixed cheap-to-expensive order, not text order."""
    return tier_view.withColumn("tier_order", tier_ordinal()).orderBy(F.asc_nulls_last("tier_order"))


def latest_feed(speed: DataFrame, n: int = LATEST_FEED_ROWS) -> DataFrame:
    """The newest ``n`` stream rows (ties by listing_id), for a feed card."""
    return (
        speed.orderBy(F.desc("ingestion_time"), "listing_id")
        .limit(n)
        .select(
            "listing_id",
            truncate_title("title").alias("title"),
            "property_type", "district", "price_raw", "ingestion_time",
        )
    )


def detail_rows(filtered: DataFrame, n: int = DETAIL_ROWS) -> DataFrame:
    return filtered.select(*DETAIL_COLUMNS).orderBy("listing_id").limit(n)


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sample_rows(filtered: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """A repeatable pseudo-random sample of at most ``n`` rows (hash order)."""
    return (
        filtered.orderBy(F.md5("listing_id"), "listing_id")
        .limit(n)
        .select("listing_id", "price_billion", "area_m2", "property_type")
    )


def _has_rows(df: DataFrame | None) -> bool:
    return df is not None and not df.isEmpty()


def _sizes(filtered: DataFrame, column: str, name: str) -> DataFrame:
    return filtered.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))


def _named(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != "None"))


def chart_sources(views: dict[str, DataFrame | None], filtered: DataFrame) -> dict[str, DataFrame]:
    """The table behind each chart: the published view if it has rows (the merged one before the
    batch one), else the same figures from the filtered listings.

    ``views`` may hold merged_by_district, by_district, merged_by_type, by_type, price_dist,
    by_legal and by_direction.
    """
    def first(*names: str) -> DataFrame | None:
        return next((views[n] for n in names if _has_rows(views.get(n))), None)

    def either(view: DataFrame | None, other) -> DataFrame:
        return view if view is not None else other()

    by_type = first("merged_by_type", "by_type")
    return {
        "district": either(first("merged_by_district", "by_district"), lambda: district_fallback(filtered)),
        "type": either(by_type, lambda: _sizes(filtered, "property_type", "merged_listings")),
        "price_tier": sort_tiers(either(first("price_dist"), lambda: _sizes(filtered, "price_tier", "count"))),
        "type_ppm": either(by_type.where(F.col("avg_price_per_m2").isNotNull()).orderBy("avg_price_per_m2", "property_type")
                           if by_type is not None else None, lambda: type_ppm(filtered)),
        "legal": _named(either(first("by_legal"), lambda: _sizes(filtered, "legal_status", "count")), "legal_status"),
        "direction": _named(either(first("by_direction"), lambda: direction_fallback(filtered)), "direction"),
    }
