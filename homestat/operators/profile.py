"""Data-quality profile of the raw listings, as one-pass Spark aggregates.

Per-column statistics are computed in a single wide aggregate and then
unpivoted, so the table is scanned once however many columns it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homestat.constants import HISTOGRAM_BINS, NULL_BAD_PCT, NULL_WARN_PCT, PROFILE_TOPK
from homestat.operators.quantiles import exact_quantiles, exact_quantiles_by_column
from homestat.schema import PROFILE_CATEGORIES, PROFILE_NUMERIC


def _visible(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def shape(raw: DataFrame) -> DataFrame:
    """Rows and columns, and the columns' names and types."""
    cols = _visible(raw)
    types = dict(raw.dtypes)
    return raw.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(cols)).alias("columns"),
                   F.lit(cols).alias("names"), F.lit([types[c] for c in cols]).alias("dtypes"))


def head(raw: DataFrame, n: int = 10) -> DataFrame:
    return raw.select(*_visible(raw)).limit(n)


def nulls(raw: DataFrame) -> DataFrame:
    """Per column: null_count, null_pct (2 dp), non_null, dtype; most nulls first."""
    cols = _visible(raw)
    wide = raw.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols],
    )
    dtypes = dict(raw.dtypes)
    stack = "stack({}, {}) as (column_name, dtype, null_count)".format(
        len(cols), ", ".join(f"'{c}', '{dtypes[c]}', `{c}`" for c in cols))
    long = wide.selectExpr("__n", stack)
    return (
        long.select(
            "column_name",
            F.col("null_count").cast("bigint").alias("null_count"),
            F.round(F.try_divide("null_count", "__n") * 100, 2).alias("null_pct"),
            (F.col("__n") - F.col("null_count")).cast("bigint").alias("non_null"),
            "dtype",
        )
        .orderBy(F.desc("null_count"), "column_name")
    )


def null_bands(null_table: DataFrame) -> DataFrame:
    """bad: > 30 %, warn: > 5 % and ≤ 30 %, else ok."""
    pct = F.col("null_pct")
    return null_table.select(
        "column_name", "null_pct",
        F.when(pct > NULL_BAD_PCT, "bad").when(pct > NULL_WARN_PCT, "warn").otherwise("ok").alias("band"),
    )


def describe(raw: DataFrame, columns: list[str] = PROFILE_NUMERIC) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (linear), max per numeric column."""
    present = [c for c in columns if c in raw.columns]
    wide = raw.agg(*[
        agg.alias(f"{c}__{name}") for c in present for name, agg in (
            ("count", F.count(c)), ("mean", F.avg(c)), ("std", F.stddev_samp(c)),
            ("min", F.min(c).cast("double")), ("max", F.max(c).cast("double")))
    ]).first()
    quantiles = exact_quantiles_by_column(raw, present, [0.25, 0.5, 0.75])
    rows = []
    for c in present:
        q25, q50, q75 = quantiles[c]
        rows.append((c, int(wide[f"{c}__count"]), wide[f"{c}__mean"], wide[f"{c}__std"],
                     wide[f"{c}__min"], q25, q50, q75, wide[f"{c}__max"]))
    schema = ("column_name string, count bigint, mean double, std double, min double, "
              "p25 double, p50 double, p75 double, max double")
    return raw.sparkSession.createDataFrame(rows, schema)


def histograms(raw: DataFrame, columns: list[str], bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Values ≤ p95 of each column in ``bins`` equal-width bins over their [min, max]; the last bin is closed.

    One exact-quantile search for all cut-offs, one aggregate for all bounds,
    one aggregate over (column, bin)."""
    p95 = {c: q[0] for c, q in exact_quantiles_by_column(raw, columns, [0.95]).items()}
    present = [c for c in columns if p95[c] is not None]
    if not present:
        return raw.sparkSession.createDataFrame([], "column_name string, bin int, bin_lo double, bin_hi double, count bigint")
    stack = "stack({}, {}) as (column_name, x)".format(
        len(present), ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in present))
    cut = None
    for c in present:
        cond = (F.col("column_name") == c) & (F.col("x") <= F.lit(p95[c]))
        cut = cond if cut is None else cut | cond
    kept = raw.selectExpr(stack).where(F.col("x").isNotNull() & cut)
    b = kept.groupBy("column_name").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    lo = {r["column_name"]: r["lo"] for r in b}
    width = {r["column_name"]: ((r["hi"] - r["lo"]) / bins if r["hi"] > r["lo"] else 1.0) for r in b}
    lo_e = F.create_map(*[F.lit(x) for c in lo for x in (c, lo[c])])[F.col("column_name")]
    w_e = F.create_map(*[F.lit(x) for c in width for x in (c, width[c])])[F.col("column_name")]
    binned = F.least(F.floor((F.col("x") - lo_e) / w_e), F.lit(bins - 1)).cast("int")
    return (
        kept.groupBy("column_name", binned.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
        .select("column_name", "bin",
                (lo_e + F.col("bin") * w_e).alias("bin_lo"),
                (lo_e + (F.col("bin") + 1) * w_e).alias("bin_hi"),
                "count")
        .orderBy("column_name", "bin")
    )


def distribution_stats(raw: DataFrame, column: str) -> DataFrame:
    """n, mean, median and p95 of a column (the histogram's annotations)."""
    med, p95 = exact_quantiles(raw, column, [0.5, 0.95])
    return raw.agg(
        F.lit(column).alias("column_name"),
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.lit(med).cast("double").alias("median"),
        F.lit(p95).cast("double").alias("p95"),
    )


def topk_categories(raw: DataFrame, columns: list[str] = PROFILE_CATEGORIES, k: int = PROFILE_TOPK) -> DataFrame:
    """Per column: the ``k`` most frequent values (ties by value) and the distinct count.

    Columns are unpivoted and counted in one aggregate keyed by (column, value);
    the ranking runs over the much smaller table of distinct values.
    """
    present = [c for c in columns if c in raw.columns]
    stack = "stack({}, {}) as (column_name, value)".format(
        len(present), ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in present))
    counts = (
        raw.selectExpr(stack).where(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    )
    # rank <= k over a rank-only window lets Spark keep a per-task top-k before
    # the shuffle (window group limit), so no column's distinct values meet in one task
    w = Window.partitionBy("column_name").orderBy(F.desc("count"), "value")
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    distinct = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    # one row per profiled column: bounded by the column list
    return top.join(F.broadcast(distinct), "column_name").select(
        "column_name", "rank", "value", "count", "distinct_values")


def duplicates(raw: DataFrame, key: str = "listing_id") -> DataFrame:
    """Rows beyond the first per key (NULL keys count as one key) and their share; without
    the key column, rows beyond the first of each whole row."""
    if key in raw.columns:
        agg = raw.agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct(key).alias("ids"),
            F.max(F.col(key).isNull().cast("int")).alias("has_null"),
        )
    else:
        groups = raw.groupBy(*[F.col(f"`{c}`") for c in _visible(raw)]).agg(F.count(F.lit(1)).alias("__n"))
        agg = groups.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("ids"),
                         F.lit(0).alias("has_null"))
    dup = F.col("rows") - F.col("ids") - F.coalesce(F.col("has_null"), F.lit(0))
    return agg.select(
        "rows",
        dup.cast("bigint").alias("duplicates"),
        F.round(F.try_divide(dup, F.col("rows")) * 100, 1).alias("duplicate_pct"),
    )


def summary(raw: DataFrame) -> DataFrame:
    """One row: totals, distinct district/city/type, bad and warn columns, duplicates."""
    bands = null_bands(nulls(raw))
    band_lists = bands.agg(
        F.array_sort(F.collect_list(F.when(F.col("band") == "bad", F.col("column_name")))).alias("bad_columns"),
        F.array_sort(F.collect_list(F.when(F.col("band") == "warn", F.col("column_name")))).alias("warn_columns"),
    )
    totals = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(_visible(raw))).alias("columns"),
        F.countDistinct("district").alias("districts"),
        F.countDistinct("city").alias("cities"),
        F.countDistinct("property_type").alias("property_types"),
    )
    dup = duplicates(raw).select("duplicates")
    stacked = totals.unionByName(band_lists, allowMissingColumns=True).unionByName(dup, allowMissingColumns=True)
    return stacked.agg(
        F.max("rows").alias("rows"), F.max("columns").alias("columns"),
        F.max("districts").alias("districts"), F.max("cities").alias("cities"),
        F.max("property_types").alias("property_types"),
        F.max("bad_columns").alias("bad_columns"), F.max("warn_columns").alias("warn_columns"),
        F.max("duplicates").alias("duplicates"),
    )
