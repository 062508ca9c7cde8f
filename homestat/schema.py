"""One explicit schema module: every reader uses these, nothing infers types."""

from pyspark.sql import types as T

# ---- fixed values: the listing's columns, their order and types ------------------------
RAW_COLUMNS = [
    "listing_id", "title", "property_type", "price_raw", "price_billion",
    "area_m2", "price_per_m2_million", "city", "district", "ward", "address",
    "bedrooms", "bathrooms", "floors", "direction", "legal_status",
    "posted_date", "contact", "url", "scraped_at",
]

NUMERIC_TYPES = {
    "price_billion": T.DoubleType(),
    "area_m2": T.DoubleType(),
    "price_per_m2_million": T.DoubleType(),
    "bedrooms": T.IntegerType(),
    "bathrooms": T.IntegerType(),
    "floors": T.IntegerType(),
}

TEXT_NORMALIZED = ["city", "district", "ward", "property_type", "direction", "legal_status"]

CLEAN_COLUMNS = RAW_COLUMNS + ["price_tier", "area_tier"]
# ---- end of fixed values ---------------------------------------------------------------

# Raw CSV as written by the collector: all text.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Cleaned listing (22 columns).
CLEAN_SCHEMA = T.StructType(
    [T.StructField(c, NUMERIC_TYPES.get(c, T.StringType()), True) for c in CLEAN_COLUMNS]
)

# JSON payload of a stream message: the cleaned listing fields.
STREAM_VALUE_SCHEMA = CLEAN_SCHEMA

# Stream envelope (key/value/timestamp), the shape of a Kafka record.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# Speed-layer listing (24 columns).
SPEED_COLUMNS = CLEAN_COLUMNS + ["kafka_timestamp", "ingestion_time"]
SPEED_SCHEMA = T.StructType(
    list(CLEAN_SCHEMA.fields)
    + [T.StructField("kafka_timestamp", T.TimestampType(), True),
       T.StructField("ingestion_time", T.TimestampType(), True)]
)

# The 19 columns shared by batch and stream in the merged view.
MERGED_COLUMNS = [
    "listing_id", "title", "property_type", "price_raw", "price_billion",
    "area_m2", "price_per_m2_million", "city", "district", "ward", "address",
    "bedrooms", "bathrooms", "floors", "direction", "legal_status",
    "posted_date", "price_tier", "area_tier",
]

# Dashboard detail table.
DETAIL_COLUMNS = [
    "listing_id", "title", "property_type", "price_billion", "area_m2",
    "price_per_m2_million", "district", "city", "bedrooms", "legal_status", "price_tier",
]

KMEANS_FEATURES = ["price_billion", "area_m2", "price_per_m2_million", "bedrooms"]
LR_NUM_FEATURES = ["area_m2", "bedrooms", "bathrooms", "floors"]
LR_CAT_FEATURES = ["property_type", "district"]
LR_LABEL = "price_billion"

PROFILE_NUMERIC = ["price_billion", "area_m2", "price_per_m2_million", "bedrooms", "bathrooms", "floors"]
PROFILE_CATEGORIES = ["property_type", "city", "district", "legal_status", "direction"]


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE from a StructType."""
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
