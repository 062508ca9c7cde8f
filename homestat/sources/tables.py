"""Listings derived from the driver's star-schema tables.

The test tables are order/line/part/supplier data, not listings, so one fixed
mapping turns every line item into one raw listing (see FIXTURES.md §3).  The
same mapping is written in DuckDB SQL in ``homestat.checks.duckdb_sql`` so
every operator can be checked against an independent engine.

Join plan: the fact table joins part and supplier on their keys, then orders on
the order key (both large: a sort-merge join on that key); Catalyst and AQE
broadcast a dimension only when its measured size is under the broadcast
threshold, otherwise they shuffle-join it, splitting skewed keys.  Orders come
last: the shuffles before carry no order columns, and the joined rows lie by
order key, as the dedup of listings needs them.
nation and region are fixed-size dimensions (25 and 5 rows by the schema's
definition), so they are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.constants import UNIT_BILLION, UNIT_MILLION
from homestat.schema import RAW_COLUMNS

# Mapping constants (test fixture choices, not domain values).
LISTING_BASE_URL = "https://listings.example"
NEGOTIABLE_PRICE = "Thỏa thuận"
NULL_DISTRICT_NATION = 24
#: The two numbers of a listing id: the key of listings that have one.
LISTING_KEY = ["l_orderkey", "l_linenumber"]
DEDUP_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
# First word of the part type -> listing category slug; PROMO stays unknown.
TYPE_WORD_SLUGS = {
    "STANDARD": "ban-nha-tp-hcm",
    "SMALL": "ban-can-ho-chung-cu",
    "MEDIUM": "ban-dat-tp-hcm",
    "LARGE": "ban-biet-thu-lien-ke",
    "ECONOMY": "ban-nha-rieng",
    "PROMO": "ban-khac",
}


# Columns read from each driver table (explicit, so no file footer is read to
# infer a schema and only these columns are scanned).
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a scan over ``spark.homestat.scanPartitions`` tasks, if that is set.

    Meant for tables in a few single-row-group files, whose rows would go through
    as few tasks up to the first shuffle; unset, the scan stays as it is.  Hashing
    on ``keys`` (not round-robin) keeps the row placement the same when a lost
    task is recomputed.
    """
    n = df.sparkSession.conf.get("spark.homestat.scanPartitions", None)
    return df.repartition(int(n), *keys) if n else df


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ part ⋈ supplier ⋈ nation ⋈ region, pruned to used columns."""
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate"), "l_orderkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    # supplier joins on its own so the planner sizes it from its files; the
    # fixed-size geography is attached afterwards by broadcast
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(supplier, li.l_suppkey == supplier.s_suppkey)
        .join(F.broadcast(geo), F.col("s_nationkey") == geo.n_nationkey)
        .join(orders, li.l_orderkey == orders.o_orderkey)
    )


def _listing_id() -> Column:
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def _price() -> Column:
    area0 = F.col("l_quantity") * 8
    ppm0 = F.lit(20) + F.col("l_extendedprice") / 1000
    base = area0 * ppm0 / 1000
    size = F.col("p_size") % 25
    return (
        F.when(size == 3, F.lit(None).cast("double"))
        .when(size == 1, base * F.lit(50.0))
        .when(size == 2, base * F.lit(0.01))
        .otherwise(base)
    )


def _price_text(price: Column) -> Column:
    whole = F.floor(price)
    tenth = F.floor(price * 10) - F.floor(price) * 10
    millions = F.floor(price * 1000)
    return (
        F.when(price.isNull(), F.lit(NEGOTIABLE_PRICE))
        .when(price >= 1, F.concat(whole.cast("bigint").cast("string"), F.lit(","),
                                   tenth.cast("bigint").cast("string"), F.lit(" " + UNIT_BILLION)))
        .otherwise(F.concat(millions.cast("bigint").cast("string"), F.lit(" " + UNIT_MILLION)))
    )


def _listing_columns() -> dict[str, Column]:
    """The 20 listing columns over ``joined_lines``."""
    district = F.when(F.col("n_nationkey") != NULL_DISTRICT_NATION, F.col("n_name"))
    area0 = F.col("l_quantity") * 8
    price = _price()
    return {
        "listing_id": _listing_id(),
        "title": F.concat(F.col("p_name"), F.lit(" "), F.col("n_name")),
        "property_type": F.col("p_type"),
        "price_raw": _price_text(price),
        "price_billion": price,
        "area_m2": F.when(F.col("l_quantity") != 50, area0),
        "price_per_m2_million": F.when(F.col("l_linenumber") % 2 != 0, F.lit(20) + F.col("l_extendedprice") / 1000),
        "city": F.col("r_name"),
        "district": district,
        "ward": F.col("s_name"),
        "address": F.concat_ws(", ", F.col("s_name"), district, F.col("r_name")),
        "bedrooms": F.col("l_linenumber").cast("int"),
        "bathrooms": (F.col("p_size") % 3 + 1).cast("int"),
        "floors": (F.col("p_size") % 5 + 1).cast("int"),
        "direction": F.when(F.col("p_size") % 10 != 0, F.col("o_orderpriority")),
        "legal_status": F.col("o_orderstatus"),
        "posted_date": F.date_format("o_orderdate", "dd/MM/yyyy"),
        "contact": F.concat(F.lit("agent-"), F.col("o_custkey").cast("string")),
        "url": F.concat(F.lit(LISTING_BASE_URL + "/listing/"), _listing_id()),
        "scraped_at": F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"),
    }


def raw_listings(spark: SparkSession, sf_dir: str, with_order: bool = True) -> DataFrame:
    """One raw listing per line item (20 typed columns, plus ``_seq`` for "first")."""
    cols = _listing_columns()
    out = [cols[c].alias(c) for c in RAW_COLUMNS]
    if with_order:
        out.append(F.struct(*DEDUP_ORDER).alias("_seq"))
    return joined_lines(spark, sf_dir).select(*out)


def listing_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, Column], list[str]]:
    """What listings are made of: the joined lines, the listing columns over them, and the key of a listing.

    The key is the two numbers of the listing id; where one is missing, and so the id, both are.
    """
    order = F.when(F.col("l_linenumber").isNotNull(), F.col("l_orderkey"))
    return joined_lines(spark, sf_dir).withColumn("_order", order), _listing_columns(), ["_order", "l_linenumber"]


def listing_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card text as a listing page shows it: id, title, link, price, area, location, category."""
    j = joined_lines(spark, sf_dir)
    district = F.when(F.col("n_nationkey") != NULL_DISTRICT_NATION, F.col("n_name"))
    lid = _listing_id()
    slug = F.coalesce(
        F.try_element_at(
            F.create_map(*[F.lit(x) for kv in TYPE_WORD_SLUGS.items() for x in kv]),
            F.substring_index(F.col("p_type"), " ", 1)),
        F.lit(""))
    return j.select(
        F.when(F.col("l_linenumber") % 3 != 0, lid).otherwise(F.lit("")).alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("n_name")).alias("title"),
        F.when(F.col("l_linenumber") != 7, F.concat(F.lit("/listing/"), lid)).otherwise(F.lit("")).alias("href"),
        _price_text(_price()).alias("price_text"),
        F.concat(F.floor(F.col("l_quantity") * 8).cast("bigint").cast("string"), F.lit(" m²")).alias("area_text"),
        F.concat_ws(", ", F.col("s_name"), district, F.col("r_name")).alias("location_text"),
        slug.alias("category"),
    )
