"""DuckDB SQL twin of each registered query (same column names and meaning).

Queries whose rows the data alone do not define (an unordered head) have no
entry here; they are checked by row count and by the unit tests instead.
"""

from __future__ import annotations

from homestat.checks.duckdb_sql import (
    area_tier_sql,
    category_sql,
    normalize_sql,
    ppm_sql,
    price_tier_sql,
    q,
    rnd,
    with_ctes,
)
from homestat.checks.model_sql import kmeans_ctes, predicted, regression_ctes
from homestat.constants import (
    COEF_FEATURES,
    EMPTY_TITLE,
    FEATURE_LABELS,
    METRIC_NAMES,
    NULL_BAD_PCT,
    NULL_WARN_PCT,
    PRICE_MAX,
    PRICE_MIN,
    PRICE_TIER_LABELS,
    SEGMENT_NAMES,
    TITLE_MAX_CHARS,
    UNIT_BILLION,
    UNIT_MILLION,
)
from homestat.functions.listing import NUMBER_PATTERN
from homestat.schema import (
    CLEAN_COLUMNS,
    DETAIL_COLUMNS,
    KMEANS_FEATURES,
    LR_CAT_FEATURES,
    LR_LABEL,
    LR_NUM_FEATURES,
    MERGED_COLUMNS,
    NUMERIC_TYPES,
    PROFILE_CATEGORIES,
    PROFILE_NUMERIC,
    RAW_COLUMNS,
    SPEED_COLUMNS,
)
from homestat.sources.tables import LISTING_BASE_URL

STRIP = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\p{Z}]"
RAW_DTYPES = {c: {"price_billion": "double", "area_m2": "double", "price_per_m2_million": "double",
                  "bedrooms": "int", "bathrooms": "int", "floors": "int"}.get(c, "string") for c in RAW_COLUMNS}


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{STRIP}+|{STRIP}+$', '', 'g')"


def _cols(cols) -> str:
    return ", ".join(cols)


# ---- reusable CTE fragments ------------------------------------------------------------

BY_DISTRICT = f"""bd AS (
    SELECT district, city, COUNT(*) AS total_listings,
           {rnd('AVG(price_billion)', 3)} AS avg_price_billion,
           {rnd('AVG(price_per_m2_million)', 1)} AS avg_price_per_m2,
           {rnd('quantile_disc(price_billion, 0.5)', 3)} AS median_price
    FROM clean GROUP BY district, city)"""

BY_TYPE = f"""bt AS (
    SELECT property_type, COUNT(*) AS total_listings,
           {rnd('AVG(price_billion)', 3)} AS avg_price_billion,
           {rnd('AVG(area_m2)', 1)} AS avg_area_m2,
           {rnd('AVG(price_per_m2_million)', 1)} AS avg_price_per_m2,
           {rnd('MIN(price_billion)', 3)} AS min_price,
           {rnd('MAX(price_billion)', 3)} AS max_price
    FROM clean GROUP BY property_type)"""

SPEED_DISTRICT = f"""sd AS (
    SELECT district, city, COUNT(*) AS stream_listings,
           {rnd('AVG(price_billion)', 3)} AS stream_avg_price,
           {rnd('AVG(price_per_m2_million)', 1)} AS stream_avg_m2
    FROM speed GROUP BY district, city)"""

SPEED_TYPE = f"""st AS (
    SELECT property_type, COUNT(*) AS stream_listings,
           {rnd('AVG(price_billion)', 3)} AS stream_avg_price
    FROM speed GROUP BY property_type)"""

WEIGHTED = rnd("(total_listings * avg_price_billion + stream_listings * stream_avg_price) "
               "/ greatest(total_listings + stream_listings, 1)", 3)

MERGED_DISTRICT = f"""{BY_DISTRICT}, {SPEED_DISTRICT},
md0 AS (
    SELECT district, city,
           COALESCE(total_listings, 0) AS total_listings,
           COALESCE(avg_price_billion, 0.0) AS avg_price_billion,
           COALESCE(avg_price_per_m2, 0.0) AS avg_price_per_m2,
           median_price,
           COALESCE(stream_listings, 0) AS stream_listings,
           COALESCE(stream_avg_price, 0.0) AS stream_avg_price,
           stream_avg_m2
    FROM bd FULL OUTER JOIN sd USING (district, city)),
md AS (SELECT *, total_listings + stream_listings AS merged_listings, {WEIGHTED} AS merged_avg_price FROM md0)"""

MERGED_TYPE = f"""{BY_TYPE}, {SPEED_TYPE},
mt0 AS (
    SELECT property_type,
           COALESCE(total_listings, 0) AS total_listings,
           COALESCE(avg_price_billion, 0.0) AS avg_price_billion,
           avg_area_m2, avg_price_per_m2, min_price, max_price,
           COALESCE(stream_listings, 0) AS stream_listings,
           COALESCE(stream_avg_price, 0.0) AS stream_avg_price
    FROM bt FULL OUTER JOIN st USING (property_type)),
mt AS (SELECT *, total_listings + stream_listings AS merged_listings, {WEIGHTED} AS merged_avg_price FROM mt0)"""

FILTERED = """bounds AS (SELECT MIN(price_billion) AS lo, quantile_cont(price_billion, 0.95) AS hi FROM clean),
f AS (SELECT c.* FROM clean c, bounds b WHERE c.price_billion >= b.lo AND c.price_billion <= b.hi)"""

MERGED_ROWS = (f"SELECT {_cols(MERGED_COLUMNS)}, 'batch' AS data_source FROM clean "
               f"UNION ALL SELECT {_cols(MERGED_COLUMNS)}, 'stream' AS data_source FROM speed")


def _report(source: str, keys: str, count: str, where: str, **measures: tuple[str, int]) -> str:
    """One grouped statement: measures are output name -> (aggregate expression, decimals)."""
    found = ", ".join(f"{rnd(expr, decimals)} AS {name}" for name, (expr, decimals) in measures.items())
    return (f"SELECT {keys}, CAST(COUNT(*) AS BIGINT) AS {count}{', ' + found if found else ''} FROM {source} "
            f"{'WHERE ' + where if where else ''} GROUP BY {keys}")


GAPPED = """g AS (SELECT * REPLACE (
      CASE WHEN floors <> 5 THEN price_billion END AS price_billion, CASE WHEN floors <> 5 THEN price_tier END AS price_tier,
      CASE floors WHEN 2 THEN 'None' WHEN 3 THEN NULL ELSE legal_status END AS legal_status) FROM clean)"""
PRICE3, AREA1, PPM1 = ("AVG(price_billion)", 3), ("AVG(area_m2)", 1), ("AVG(price_per_m2_million)", 1)


def _district_stats(source: str) -> str:
    return _report(source, "district, city", "total_listings", "price_billion IS NOT NULL", avg_price_billion=PRICE3, avg_price_per_m2=PPM1,
                   min_price=("MIN(price_billion)", 3), max_price=("MAX(price_billion)", 3), avg_area_m2=AREA1)


def _index_cte(feature: str, name: str) -> str:
    return f"""{name} AS (
    SELECT '{feature}' AS feature, {feature} AS label,
           CAST(row_number() OVER (ORDER BY n DESC, {feature}) - 1 AS DOUBLE) AS "index"
    FROM (SELECT {feature}, COUNT(*) AS n FROM model WHERE {feature} IS NOT NULL GROUP BY {feature}))"""


MODEL = f"model AS (SELECT {_cols(LR_NUM_FEATURES + LR_CAT_FEATURES + [LR_LABEL])} FROM clean WHERE " + \
    " AND ".join(f"{c} IS NOT NULL" for c in LR_NUM_FEATURES + LR_CAT_FEATURES + [LR_LABEL]) + ")"


def _title(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN {q(EMPTY_TITLE)} "
            f"WHEN length({x}) > {TITLE_MAX_CHARS} THEN substring({x}, 1, {TITLE_MAX_CHARS}) || '…' ELSE {x} END")


def _price_parse(x: str) -> str:
    s = _strip(f"replace(lower({x}), ',', '.')")

    def num(unit: str) -> str:
        return f"TRY_CAST(regexp_replace(split_part({s}, '{unit}', 1), '[^0-9.]', '', 'g') AS DOUBLE)"

    return (f"CASE WHEN contains({s}, '{UNIT_BILLION}') THEN {num(UNIT_BILLION)} "
            f"WHEN contains({s}, '{UNIT_MILLION}') THEN {rnd(num(UNIT_MILLION) + ' / 1000', 4)} END")


def _abs_url(h: str) -> str:
    base = LISTING_BASE_URL
    return (f"CASE WHEN {h} IS NULL OR {h} = '' THEN '' "
            f"WHEN regexp_matches({h}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {h} "
            f"WHEN starts_with({h}, '//') THEN 'https:' || {h} "
            f"WHEN starts_with({h}, '/') THEN {q(base)} || {h} "
            f"WHEN starts_with({h}, '?') OR starts_with({h}, '#') THEN {q(base)} || {h} "
            f"ELSE {q(base + '/')} || {h} END")


def _cast_numeric(x: str, dtype: str) -> str:
    t = _strip(f"CAST({x} AS VARCHAR)")
    d = f"CASE WHEN regexp_full_match({t}, '{NUMBER_PATTERN}') THEN TRY_CAST({t} AS DOUBLE) END"
    if dtype == "int":
        return f"CASE WHEN {d} = floor({d}) THEN TRY_CAST({d} AS INTEGER) END"
    return d


def _loc(part: int) -> str:
    parts = f"list_transform(string_split(COALESCE(location_text, ''), ','), lambda p: {_strip('p')})"
    return f"COALESCE({parts}[{part}], '')"


def _tier_order() -> str:
    return "CASE " + " ".join(f"WHEN price_tier = {q(t)} THEN {i}" for i, t in enumerate(PRICE_TIER_LABELS)) + " END"


def _nulls_union() -> str:
    parts = []
    for c in RAW_COLUMNS:
        nc = f"(COUNT(*) - COUNT({c}))"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST({nc} AS BIGINT) AS null_count, "
            f"{rnd(f'{nc} / COUNT(*) * 100', 2)} AS null_pct, CAST(COUNT({c}) AS BIGINT) AS non_null, "
            f"'{RAW_DTYPES[c]}' AS dtype FROM raw")
    return " UNION ALL ".join(parts)


def _bands() -> str:
    return (f"SELECT column_name, null_pct, CASE WHEN null_pct > {NULL_BAD_PCT} THEN 'bad' "
            f"WHEN null_pct > {NULL_WARN_PCT} THEN 'warn' ELSE 'ok' END AS band FROM ({_nulls_union()})")


def _describe() -> str:
    parts = []
    for c in PROFILE_NUMERIC:
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS count, AVG({c}) AS mean, stddev_samp({c}) AS std, "
            f"CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
            f"quantile_cont({c}, 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM raw")
    return " UNION ALL ".join(parts)


def _histogram(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, bin, lo + bin * w AS bin_lo, lo + (bin + 1) * w AS bin_hi, COUNT(*) AS count
    FROM (
      SELECT CAST(LEAST(floor((x - lo) / w), 49) AS INTEGER) AS bin, lo, w FROM (
        SELECT x, lo, CASE WHEN hi > lo THEN (hi - lo) / 50 ELSE 1.0 END AS w FROM (
          SELECT x, MIN(x) OVER () AS lo, MAX(x) OVER () AS hi FROM (
            SELECT CAST({c} AS DOUBLE) AS x FROM raw
            WHERE {c} IS NOT NULL AND {c} <= (SELECT quantile_cont({c}, 0.95) FROM raw)))))
    GROUP BY bin, lo, w"""


def _dist_stats(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, COUNT({c}) AS n, AVG({c}) AS mean, "
            f"quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.95) AS p95 FROM raw")


def _topk() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS count FROM raw "
        f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in PROFILE_CATEGORIES)
    return f"""SELECT column_name, rank, value, count, distinct_values FROM (
      SELECT column_name, value, count,
             CAST(row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value) AS INTEGER) AS rank,
             COUNT(*) OVER (PARTITION BY column_name) AS distinct_values
      FROM ({counts})) WHERE rank <= 12"""


DUPLICATES = """SELECT COUNT(*) AS rows,
       CAST(COUNT(*) - COUNT(DISTINCT listing_id) - MAX(CASE WHEN listing_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
       {pct} AS duplicate_pct
    FROM raw"""
DUPLICATES = DUPLICATES.format(pct=rnd(
    "(COUNT(*) - COUNT(DISTINCT listing_id) - MAX(CASE WHEN listing_id IS NULL THEN 1 ELSE 0 END)) / COUNT(*) * 100", 1))


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    raw_cols = _cols(RAW_COLUMNS)
    clean_cols = _cols(CLEAN_COLUMNS)

    # 2.1 sources
    awkward = ("CASE WHEN bedrooms = 7 THEN title || chr(10) || '\"a, b\" \\ end ' ELSE title END AS title, "
               "CASE WHEN bedrooms = 7 THEN '  ' || address || chr(9) ELSE address END AS address")
    sql["src_csv_raw"] = with_ctes("raw") + (
        f"SELECT {raw_cols} FROM (SELECT * REPLACE ({awkward}, CASE WHEN floors = 1 THEN NULL ELSE direction END AS direction) FROM raw)")
    sql["src_csv_clean"] = with_ctes("clean") + f"SELECT * REPLACE ({awkward}) FROM clean"
    sql["src_parquet_views"] = with_ctes("clean") + f", {BY_DISTRICT} SELECT * FROM bd"
    sql["src_speed_parquet"] = with_ctes("speed") + "SELECT * FROM speed"
    sql["src_warehouse_table"] = with_ctes("clean") + "SELECT * FROM clean"
    sql["src_fallback_view"] = with_ctes("speed") + f", {MERGED_DISTRICT} SELECT * FROM md"

    # 2.2 sinks
    sql["sink_csv_clean"] = sql["src_csv_clean"]
    sql["sink_parquet_overwrite"] = with_ctes("clean") + f", {BY_TYPE} SELECT * FROM bt"
    sql["sink_kafka_json"] = with_ctes("clean") + (
        "SELECT listing_id AS key, CAST(to_json(struct_pack("
        + ", ".join(f"{c} := {c}" for c in CLEAN_COLUMNS) + ")) AS VARCHAR) AS value FROM clean")
    sql["sink_ctas"] = with_ctes("clean") + _district_stats("clean")
    sql["sink_external_table"] = with_ctes("speed") + "SELECT * FROM speed"
    sql["sink_view"] = with_ctes("speed") + MERGED_ROWS
    sql["sink_speed_summary"] = with_ctes("speed") + (
        "SELECT (SELECT COUNT(*) FROM speed) AS stream_total, (SELECT COUNT(*) FROM clean) AS batch_total, "
        "COALESCE((SELECT CAST(MAX(ingestion_time) AS VARCHAR) FROM speed), 'N/A') AS latest_ingestion")

    # 2.3 parsing and cleaning
    sql["parse_price"] = with_ctes("cards") + f"SELECT price_text, {_price_parse('price_text')} AS price_billion FROM cards"
    sql["parse_area"] = with_ctes("cards") + (
        "SELECT area_text, TRY_CAST(regexp_replace(area_text, '[^0-9.]', '', 'g') AS DOUBLE) AS area_m2 FROM cards")
    sql["parse_location"] = with_ctes("cards") + (
        f"SELECT location_text, {_loc(-1)} AS city, {_loc(-2)} AS district, {_loc(-3)} AS ward FROM cards")
    sql["parse_category"] = with_ctes("cards") + f"SELECT category, {category_sql('category')} AS property_type FROM cards"
    sql["abs_url"] = with_ctes("cards") + f"SELECT href, {_abs_url('href')} AS url FROM cards"
    sql["derive_id"] = with_ctes("cards") + (
        f"SELECT product_id, url, CASE WHEN product_id IS NOT NULL AND product_id <> '' THEN product_id "
        f"ELSE substring(md5(url), 1, 12) END AS listing_id FROM (SELECT product_id, {_abs_url('href')} AS url FROM cards)")
    price, area = _price_parse("price_text"), "TRY_CAST(regexp_replace(area_text, '[^0-9.]', '', 'g') AS DOUBLE)"
    sql["html_card_listings"] = with_ctes("cards") + f"""
      SELECT CASE WHEN product_id <> '' THEN product_id ELSE substring(md5(url), 1, 12) END AS listing_id, title, property_type,
             price_text AS price_raw, price_billion, area_m2,
             CASE WHEN price_billion > 0 AND area_m2 > 0 THEN {rnd('price_billion * 1000 / area_m2', 2)} END AS price_per_m2_million,
             city, district, ward, location_text AS address, url
      FROM (SELECT *, {price} AS price_billion, {area} AS area_m2, {_loc(-1)} AS city, {_loc(-2)} AS district, {_loc(-3)} AS ward,
                   {_abs_url('href')} AS url, {category_sql('category')} AS property_type FROM cards)"""
    # the pages themselves, by regular expressions instead of a parser
    nulls = lambda kind, *names: ", ".join(f"CAST(NULL AS {kind}) AS {n}" for n in names)
    plain = lambda x: f"trim(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&amp;', '&'))"
    sql["html_extract"] = f"""SELECT page_id, substring(md5(''), 1, 12) AS listing_id, {plain("regexp_extract(html, '<article>.*?<h1>(.*?)</h1>', 1, 's')")} AS title,
        {category_sql("regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+/([^/?#]+)', 1)")} AS property_type, '' AS price_raw,
        {nulls("DOUBLE", "price_billion", "area_m2", "price_per_m2_million")}, '' AS city, '' AS district, '' AS ward, '' AS address,
        {nulls("INTEGER", "bedrooms", "bathrooms", "floors")}, {nulls("VARCHAR", "direction", "legal_status", "posted_date", "contact")},
        '' AS url, '2024-01-01T00:00:00' AS scraped_at FROM pages WHERE regexp_matches(html, '<article>.*?<h1>.*?</article>', 's')"""
    entry = lambda label: f"list_filter(entries, lambda x: contains(lower(x), '{label}'))[1]"
    sql["html_detail"] = f"""WITH read AS (SELECT *, list_transform(
            regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<li><a[^>]*>(.*?)</a>', 1), lambda x: {plain("x")}) AS entries FROM pages)
        SELECT page_id, url, COALESCE({entry("the")}, {entry("une")}) AS bedrooms, COALESCE({entry("der")}, {entry("la")}) AS bathrooms,
        {entry("ing")} AS floors, COALESCE({entry("en")}, {entry("er")}) AS direction, COALESCE({entry("que")}, {entry("and")}) AS legal_status,
        CASE WHEN contains(html, '</article><footer>') THEN {plain("regexp_extract(html, '<footer>(.*?)</footer>', 1, 's')")} END AS posted_date,
        CASE WHEN contains(html, '<div class="ad">') THEN {plain("regexp_extract(html, '<div class=.ad.>(.*?)</div>', 1, 's')")} END AS contact FROM read"""
    sql["html_detail_join"] = with_ctes("raw") + (
        "SELECT listing_id, url, bedrooms, bathrooms, floors, direction, legal_status, posted_date, contact FROM raw "
        "QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY "
        "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) = 1")
    sql["cast_numeric"] = with_ctes("raw") + (
        "SELECT listing_id, " + ", ".join(f"{_cast_numeric(c, 'int' if c in ('bedrooms', 'bathrooms', 'floors') else 'double')} AS {c}"
                                          for c in NUMERIC_TYPES)
        + f", {_cast_numeric('price_raw', 'double')} AS price_raw_number FROM raw")
    sql["derive_ppm"] = with_ctes("raw") + f"SELECT listing_id, price_billion, area_m2, {ppm_sql()} AS price_per_m2_million FROM raw"
    sql["price_tier"] = with_ctes("raw") + (
        f"SELECT listing_id, price_billion, {price_tier_sql()} AS price_tier, "
        f"{price_tier_sql(null_as_top=True)} AS price_tier_stream FROM raw")
    sql["area_tier"] = with_ctes("raw") + (
        f"SELECT listing_id, area_m2, {area_tier_sql()} AS area_tier, "
        f"{area_tier_sql(null_as_top=True)} AS area_tier_stream FROM raw")
    sql["normalize_text"] = with_ctes("raw") + (
        "SELECT listing_id, " + ", ".join(f"{normalize_sql(c)} AS {c}" for c in
                                          ["city", "district", "ward", "property_type", "direction", "legal_status"])
        + """ FROM (SELECT * REPLACE (CASE WHEN bedrooms = 2 THEN chr(160) || ' ' || ward || chr(9) ELSE ward END AS ward,
                                 CASE WHEN floors = 4 THEN ' nan' ELSE direction END AS direction) FROM raw)""")
    notnull = "listing_id IS NOT NULL AND title IS NOT NULL AND price_billion IS NOT NULL"
    sql["dropna_subset"] = with_ctes("raw") + f"SELECT {raw_cols} FROM raw WHERE {notnull}"
    sql["dedup_listing"] = with_ctes("raw") + (
        f"SELECT {raw_cols} FROM raw WHERE {notnull} QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY "
        "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) = 1")
    sql["filter_outlier"] = with_ctes("raw") + f"SELECT {raw_cols} FROM raw WHERE price_billion BETWEEN {PRICE_MIN} AND {PRICE_MAX}"
    sql["clean_listings"] = with_ctes("clean") + "SELECT * FROM clean"
    sql["clean_summary"] = with_ctes("clean") + (
        "SELECT COUNT(*) AS rows, MIN(price_billion) AS min_price, MAX(price_billion) AS max_price, "
        "COUNT(DISTINCT district) AS districts FROM clean")
    sql["filter_not_null"] = with_ctes("clean") + f", {GAPPED} SELECT * FROM g WHERE price_billion IS NOT NULL AND price_tier IS NOT NULL"
    sql["filter_legal"] = with_ctes("clean") + f", {GAPPED} SELECT * FROM g WHERE legal_status IS NOT NULL AND legal_status <> 'None'"
    sql["filter_facets"] = with_ctes("clean") + f", {FILTERED} SELECT {clean_cols} FROM f"
    sql["select_columns"] = with_ctes("clean") + f"SELECT {_cols(DETAIL_COLUMNS)} FROM clean"
    sql["fillna_defaults"] = with_ctes("speed") + (
        f", {MERGED_DISTRICT} SELECT district, city, total_listings, stream_listings, avg_price_billion, "
        "stream_avg_price, avg_price_per_m2, stream_avg_m2, median_price FROM md")
    sql["truncate_title"] = with_ctes("clean") + f"SELECT listing_id, {_title('title')} AS title FROM clean"

    # 2.4 aggregations
    sql["eda_by_type"] = with_ctes("clean") + f", {BY_TYPE} SELECT * FROM bt"
    sql["eda_by_district"] = with_ctes("clean") + f", {BY_DISTRICT} SELECT * FROM bd"
    sql["eda_price_dist"] = with_ctes("clean") + (
        f"SELECT price_tier, COUNT(*) AS count, {rnd('AVG(area_m2)', 1)} AS avg_area_m2 FROM clean GROUP BY price_tier")
    sql["eda_by_legal"] = with_ctes("clean") + (
        f"SELECT legal_status, COUNT(*) AS count, {rnd('AVG(price_billion)', 3)} AS avg_price FROM clean GROUP BY legal_status")
    sql["eda_by_direction"] = with_ctes("clean") + (
        f"SELECT direction, COUNT(*) AS count, {rnd('AVG(price_per_m2_million)', 1)} AS avg_price_per_m2 "
        "FROM clean GROUP BY direction")
    sql["wh_district_stats"] = with_ctes("clean") + f", {GAPPED} " + _district_stats("g")
    sql["wh_type_stats"] = with_ctes("clean") + f", {GAPPED} " + _report(
        "g", "property_type", "total_listings", "price_billion IS NOT NULL", avg_price=PRICE3, avg_area=AREA1, avg_price_per_m2=PPM1,
        avg_bedrooms=("AVG(bedrooms)", 1))
    sql["wh_price_distribution"] = with_ctes("clean") + f", {GAPPED} " + _report(
        "g", "price_tier", "count", "price_tier IS NOT NULL", avg_area=AREA1, avg_price_per_m2=PPM1)
    sql["wh_legal_stats"] = with_ctes("clean") + f", {GAPPED} " + _report(
        "g", "legal_status", "count", "legal_status <> 'None'", avg_price=PRICE3, avg_price_per_m2=PPM1)
    # the same reports by batches, and with exact medians
    sql["eda_by_district_exact"] = sql["eda_by_district"]
    for name in ("eda_by_district", "eda_by_type", "wh_district_stats", "wh_legal_stats"):
        sql[f"{name}_batches"] = sql[name]
    merged = with_ctes("speed") + f", merged AS ({MERGED_ROWS}) "
    sql["wh_merged_district_stats"] = merged + _report(
        "merged", "district, city, data_source", "total_listings", "price_billion IS NOT NULL",
        avg_price_billion=PRICE3, avg_price_per_m2=PPM1, avg_area_m2=AREA1)
    sql["wh_merged_type_stats"] = merged + _report(
        "merged", "property_type, data_source", "total_listings", "price_billion IS NOT NULL", avg_price_billion=PRICE3, avg_price_per_m2=PPM1)
    sql["wh_source_counts"] = merged + _report("merged", "data_source", "records", "")
    sql["wh_stream_count"] = with_ctes("speed") + "SELECT COUNT(*) AS cnt FROM speed"
    sql["speed_by_district"] = with_ctes("speed") + f", {SPEED_DISTRICT} SELECT * FROM sd"
    sql["speed_by_type"] = with_ctes("speed") + f", {SPEED_TYPE} SELECT * FROM st"
    sql["speed_latest"] = with_ctes("speed") + "SELECT CAST(MAX(ingestion_time) AS VARCHAR) AS latest_ingestion FROM speed"
    sql["kpi_cards"] = with_ctes("speed") + f""", {FILTERED},
      dc AS (SELECT district, COUNT(*) AS n FROM f WHERE district IS NOT NULL GROUP BY district)
      SELECT CAST((SELECT COUNT(*) FROM f) + (SELECT COUNT(*) FROM speed) AS BIGINT) AS total_listings,
             {rnd('(SELECT AVG(price_billion) FROM f)', 6)} AS avg_price,
             {rnd('(SELECT AVG(price_per_m2_million) FROM f)', 6)} AS avg_price_per_m2,
             (SELECT district FROM dc ORDER BY n DESC, district LIMIT 1) AS top_district,
             (SELECT COUNT(*) FROM speed) AS stream_total,
             (SELECT COUNT(*) FROM speed) AS latest_feed_rows"""
    sql["layer_status"] = with_ctes("speed") + f""", {MERGED_DISTRICT}
      SELECT b > 0 AS batch_ok, s > 0 AS speed_ok, m > 0 AS serving_ok, b AS batch_total, s AS stream_total,
             b + s AS merged_total
      FROM (SELECT (SELECT COUNT(*) FROM clean) AS b, (SELECT COUNT(*) FROM speed) AS s, (SELECT COUNT(*) FROM md) AS m)"""
    sql["facet_values"] = with_ctes("clean") + (
        "SELECT DISTINCT * FROM (SELECT 'property_type' AS facet, property_type AS value FROM clean "
        "UNION ALL SELECT 'city' AS facet, city AS value FROM clean) WHERE value IS NOT NULL")
    sql["facet_price_range"] = with_ctes("clean") + (
        "SELECT MIN(price_billion) AS min_price, quantile_cont(price_billion, 0.95) AS max_price FROM clean")
    sql["dash_district_fallback"] = with_ctes("clean") + f""", {FILTERED}
      SELECT district, AVG(price_billion) AS avg_price_billion, COUNT(listing_id) AS merged_listings
      FROM f WHERE district IS NOT NULL GROUP BY district"""
    sql["dash_direction_fallback"] = with_ctes("clean") + f""", {FILTERED}
      SELECT direction, COUNT(listing_id) AS count, AVG(price_per_m2_million) AS avg_price_per_m2
      FROM f WHERE direction IS NOT NULL AND direction <> 'None' GROUP BY direction"""
    sql["dash_group_sizes"] = with_ctes("clean") + f""", {FILTERED}
      SELECT 'property_type' AS dimension, property_type AS value, COUNT(*) AS count FROM f WHERE property_type IS NOT NULL GROUP BY property_type
      UNION ALL SELECT 'price_tier', price_tier, COUNT(*) FROM f WHERE price_tier IS NOT NULL GROUP BY price_tier
      UNION ALL SELECT 'legal_status', legal_status, COUNT(*) FROM f WHERE legal_status IS NOT NULL GROUP BY legal_status"""
    sql["dash_type_ppm"] = with_ctes("clean") + f""", {FILTERED}
      SELECT * FROM (SELECT property_type, AVG(price_per_m2_million) AS avg_price_per_m2 FROM f GROUP BY property_type)
      WHERE avg_price_per_m2 IS NOT NULL"""

    # 2.5 profiling
    sql["prof_shape"] = with_ctes("raw") + (
        f"SELECT COUNT(*) AS rows, {len(RAW_COLUMNS)} AS columns, {RAW_COLUMNS} AS names, {[RAW_DTYPES[c] for c in RAW_COLUMNS]} AS dtypes FROM raw")
    sql["prof_nulls"] = with_ctes("raw") + _nulls_union()
    sql["prof_null_bands"] = with_ctes("raw") + _bands()
    sql["prof_describe"] = with_ctes("raw") + _describe()
    sql["prof_histogram"] = with_ctes("raw") + _histogram("price_billion") + " UNION ALL " + _histogram("area_m2")
    sql["prof_dist_stats"] = with_ctes("raw") + _dist_stats("price_billion") + " UNION ALL " + _dist_stats("area_m2")
    sql["prof_topk_categories"] = with_ctes("raw") + _topk()
    sql["prof_duplicates"] = with_ctes("raw") + DUPLICATES
    sql["prof_summary"] = with_ctes("raw") + f""", bands AS ({_bands()}), dup AS ({DUPLICATES})
      SELECT COUNT(*) AS rows, {len(RAW_COLUMNS)} AS columns, COUNT(DISTINCT district) AS districts,
             COUNT(DISTINCT city) AS cities, COUNT(DISTINCT property_type) AS property_types,
             (SELECT COALESCE(list_sort(list(column_name) FILTER (WHERE band = 'bad')), []) FROM bands) AS bad_columns,
             (SELECT COALESCE(list_sort(list(column_name) FILTER (WHERE band = 'warn')), []) FROM bands) AS warn_columns,
             (SELECT duplicates FROM dup) AS duplicates
      FROM raw"""

    # 2.6 joins, 2.7 set operations
    sql["merge_by_district"] = with_ctes("speed") + f", {MERGED_DISTRICT} SELECT * FROM md"
    sql["merge_by_type"] = with_ctes("speed") + f", {MERGED_TYPE} SELECT * FROM mt"
    sql["weighted_merge_avg"] = with_ctes("speed") + f", {MERGED_TYPE} SELECT property_type, merged_listings, merged_avg_price FROM mt"
    sql["lookup_category_index"] = with_ctes("clean") + f""", {MODEL}, {_index_cte('property_type', 'ti')},
      {_index_cte('district', 'di')}
      SELECT c.listing_id, COALESCE(ti."index", 0.0) AS type_idx, COALESCE(di."index", 0.0) AS dist_idx
      FROM clean c LEFT JOIN ti ON c.property_type = ti.label LEFT JOIN di ON c.district = di.label"""
    sql["union_merged_listings"] = with_ctes("speed") + MERGED_ROWS
    sql["union_category_map"] = with_ctes("clean") + f""", {MODEL}, {_index_cte('property_type', 'ti')},
      {_index_cte('district', 'di')} SELECT * FROM ti UNION ALL SELECT * FROM di"""

    # 2.8 sort / limit
    sql["topk_districts"] = with_ctes("speed") + f""", {MERGED_DISTRICT}
      SELECT district, city, merged_avg_price AS avg_price, merged_listings AS listings FROM md
      WHERE merged_avg_price IS NOT NULL ORDER BY merged_listings DESC, district NULLS FIRST, city NULLS FIRST LIMIT 15"""
    sql["latest_feed"] = with_ctes("speed") + f"""
      SELECT listing_id, {_title('title')} AS title, property_type, district, price_raw,
             CAST(ingestion_time AS VARCHAR) AS ingestion_time
      FROM speed ORDER BY speed.ingestion_time DESC, listing_id LIMIT 8"""
    sql["sort_tier_ordinal"] = with_ctes("clean") + (
        f"SELECT price_tier, COUNT(*) AS count, {rnd('AVG(area_m2)', 1)} AS avg_area_m2, "
        f"{_tier_order()} AS tier_order FROM clean GROUP BY price_tier")
    sql["detail_top100"] = with_ctes("clean") + f", {FILTERED} SELECT {_cols(DETAIL_COLUMNS)} FROM f ORDER BY listing_id LIMIT 100"
    sql["stats_top10"] = with_ctes("clean") + (
        f"SELECT * FROM ({_district_stats('clean')}) "
        "ORDER BY total_listings DESC, district NULLS FIRST, city NULLS FIRST LIMIT 10")

    # 2.10 machine learning (SQL-expressible parts)
    feats = " AND ".join(f"{c} IS NOT NULL" for c in KMEANS_FEATURES)
    sql["ml_assemble_scale"] = with_ctes("clean") + (
        "SELECT listing_id, " + ", ".join(
            f"({c} - AVG({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}_z" for c in KMEANS_FEATURES)
        + f" FROM clean WHERE {feats}")
    keyed = f"""keyed AS (SELECT listing_id, {_cols(LR_NUM_FEATURES + LR_CAT_FEATURES + [LR_LABEL])},
        ('0x' || substring(md5(listing_id), 1, 8))::BIGINT % 10 < 8 AS in_train FROM clean WHERE """ + " AND ".join(
        f"{c} IS NOT NULL" for c in LR_NUM_FEATURES + LR_CAT_FEATURES + [LR_LABEL]) + ")"
    sql["ml_split"] = with_ctes("clean") + f", {keyed} SELECT * EXCLUDE (in_train), CASE WHEN in_train THEN 'train' ELSE 'test' END AS part FROM keyed"
    train = f"{keyed}, model AS (SELECT * FROM keyed WHERE in_train), {_index_cte('property_type', 'ti')}, {_index_cte('district', 'di')}"
    sql["ml_category_map"] = with_ctes("clean") + f", {train} SELECT * FROM ti UNION ALL SELECT * FROM di"
    fit = with_ctes("clean") + f", {train}, {regression_ctes()}"
    labelled = "CASE feature " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in FEATURE_LABELS.items()) + " ELSE feature END"
    nine = lambda c: f"{rnd(c, 9)} AS {c}"
    coef = f"coef AS (SELECT unnest([{', '.join(q(n) for n in COEF_FEATURES)}]) AS feature, unnest([{', '.join(f'c{i}' for i in range(1, 7))}]) AS coefficient FROM fitted)"
    sql["ml_coefficients"] = fit + f", {coef} SELECT feature, {nine('coefficient')} FROM coef"
    sql["sort_coefficients"] = fit + f", {coef} SELECT feature, {nine('coefficient')}, {labelled} AS label, CASE WHEN coefficient < 0 THEN 'negative' ELSE 'positive' END AS sign FROM coef"
    parameters = ["intercept", "coef_area_m2", "coef_bedrooms", "coef_bathrooms", "coef_floors", "coef_property_type", "coef_district"]
    sql["ml_model_params"] = sql["ml_linreg"] = fit + " SELECT " + ", ".join(
        f"{rnd(c, 9)} AS {p}" for c, p in zip(["intercept", *[f"c{i}" for i in range(1, 7)]], parameters)) + " FROM fitted"
    tested = f"""tested AS (SELECT keyed.*, price_billion AS actual, {predicted()} AS prediction FROM keyed, fitted, ti, di
        WHERE NOT in_train AND property_type = ti.label AND district = di.label)"""
    shown = f"actual, {rnd('prediction', 3)} AS predicted, property_type, district, area_m2"
    first = f"SELECT {shown} FROM tested ORDER BY listing_id, {_cols(LR_NUM_FEATURES)}, price_billion LIMIT 800"
    sql["ml_predictions"] = fit + f", {tested} SELECT {shown} FROM tested"
    sql["limit_predictions"] = fit + f", {tested} {first}"
    sql["pred_plot_filter"] = fit + f", {tested}, sampled AS MATERIALIZED ({first}), top AS (SELECT quantile_cont(actual, 0.95) AS p FROM sampled) " \
        "SELECT sampled.* FROM sampled, top WHERE actual <= p AND predicted <= 1.5 * p"
    values = ["round(1 - mse / v, 4)", "round(sqrt(mse), 3)", "round(mae, 3)", "(SELECT COUNT(*) FROM keyed WHERE in_train)", "(SELECT COUNT(*) FROM keyed WHERE NOT in_train)"]
    sql["ml_eval"] = fit + f""", {tested}, e AS (SELECT AVG((prediction - actual) * (prediction - actual)) AS mse, AVG(abs(prediction - actual)) AS mae, var_pop(actual) AS v FROM tested)
      SELECT unnest([{', '.join(q(m) for m in METRIC_NAMES)}]) AS metric, unnest([{', '.join(f'{v}::DOUBLE' for v in values)}]) AS value FROM e"""
    raw_price = predicted(kind='COALESCE(ti."index", 0.0)', district='COALESCE(di."index", 0.0)')
    sql["score_fitted"] = fit + f""", s AS (SELECT listing_id, area_m2, {raw_price} AS p FROM clean c CROSS JOIN fitted
        LEFT JOIN ti ON c.property_type = ti.label LEFT JOIN di ON c.district = di.label),
      priced AS (SELECT *, CASE WHEN p > 0 THEN p ELSE 0.0 END AS price FROM s)
      SELECT listing_id, {rnd('price', 6)} AS predicted_price, {rnd('CASE WHEN area_m2 > 0 THEN price / area_m2 * 1000 ELSE 0.0 END', 6)} AS predicted_price_per_m2 FROM priced"""
    clusters = with_ctes("clean") + f", {kmeans_ctes()}"
    stats = f"""stats AS (SELECT cluster, COUNT(*) AS count, {rnd('AVG(price_billion)', 3)} AS avg_price, {rnd('AVG(area_m2)', 1)} AS avg_area,
        {rnd('AVG(price_per_m2_million)', 1)} AS avg_price_per_m2 FROM clustered GROUP BY cluster)"""
    segment = f"segment AS (SELECT cluster, [{', '.join(q(n) for n in SEGMENT_NAMES)}][row_number() OVER (ORDER BY avg_price, cluster)] AS segment FROM stats)"
    sql["ml_kmeans"] = clusters + " SELECT * FROM clustered"
    sql["cluster_stats"] = clusters + f", {stats} SELECT * FROM stats"
    sql["ml_segments"] = clusters + f", {stats}, {segment} SELECT * FROM clustered JOIN segment USING (cluster)"
    sql["map_lookup"] = clusters + f", {stats}, {segment} SELECT listing_id, cluster, segment FROM clustered JOIN segment USING (cluster)"
    sql["join_cluster_names"] = clusters + f", {stats}, {segment} SELECT * FROM stats JOIN segment USING (cluster)"
    sql["score_listings"] = with_ctes("clean") + f""", {MODEL}, {_index_cte('property_type', 'ti')}, {_index_cte('district', 'di')},
      s AS (SELECT listing_id, area_m2, 1.5::DOUBLE + 0.03::DOUBLE * area_m2 + 0.25::DOUBLE * bedrooms + (-0.5)::DOUBLE * bathrooms
              + 0.125::DOUBLE * floors + (-1.75)::DOUBLE * COALESCE(ti."index", 0.0) + 0.0625::DOUBLE * COALESCE(di."index", 0.0) AS p
            FROM clean c LEFT JOIN ti ON c.property_type = ti.label LEFT JOIN di ON c.district = di.label)
      SELECT listing_id, CASE WHEN p > 0 OR p IS NULL THEN COALESCE(p, 0.0) ELSE 0.0 END AS predicted_price,
             CASE WHEN area_m2 > 0 THEN CASE WHEN p > 0 THEN p ELSE 0.0 END / area_m2 * 1000 ELSE 0.0 END AS predicted_price_per_m2 FROM s"""
    sql["sample_500"] = with_ctes("clean") + f""", {FILTERED}
      SELECT listing_id, price_billion, area_m2, property_type FROM f ORDER BY md5(listing_id), listing_id LIMIT 500"""
    sql["ml_string_index"] = with_ctes("clean") + f", {MODEL}, {_index_cte('district', 'di')} SELECT * FROM di"

    # 2.11 streaming
    ts = "CAST(strptime(scraped_at, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP)"
    sql["stream_parse"] = with_ctes("messages") + f"SELECT {clean_cols}, {ts} AS kafka_timestamp FROM messages"
    sql["stream_enrich"] = with_ctes("speed") + f"SELECT {_cols(SPEED_COLUMNS)} FROM speed"
    sql["stream_append"] = with_ctes("speed") + f"SELECT {_cols(SPEED_COLUMNS[:-1])} FROM speed"
    sql["sink_stream_parquet"] = sql["stream_append"]
    steps = "steps AS (SELECT greatest(10, CAST(ceil(COUNT(*) / 100000.0) AS BIGINT)) AS n FROM messages), " \
        "late AS (SELECT speed.*, n - ('0x' || substring(md5(listing_id), 1, 8))::BIGINT % n AS age FROM speed, steps)"
    sql["src_recent_files"] = with_ctes("speed") + f", {steps} SELECT {_cols(SPEED_COLUMNS[:-1])} FROM late WHERE age <= 8"
    sql["union_recent_files"] = with_ctes("speed") + f", {steps} SELECT district, property_type, COUNT(*) AS rows FROM late WHERE age <= 4 GROUP BY ALL"
    sql["src_kafka_stream"] = with_ctes("messages") + (
        "SELECT listing_id AS key, CAST(to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in CLEAN_COLUMNS)
        + f")) AS VARCHAR) AS value, {ts} AS timestamp FROM messages")
    sql["stream_run"] = with_ctes("speed") + "SELECT COUNT(*) AS rows FROM speed"
    sql["flow_speed"] = with_ctes("speed") + """
      SELECT 'speed' AS output, COUNT(*) AS rows FROM speed
      UNION ALL SELECT 'live_groups', COUNT(*) FROM (SELECT DISTINCT district, property_type FROM speed)"""
    sql["flow_serve"] = sql["merge_by_district"]
    counted = {
        "cleaned": "SELECT COUNT(*) FROM clean", "by_type": "SELECT COUNT(*) FROM bt", "by_district": "SELECT COUNT(*) FROM bd",
        "price_dist": "SELECT COUNT(*) FROM (SELECT DISTINCT price_tier FROM clean)",
        "by_legal": "SELECT COUNT(*) FROM (SELECT DISTINCT legal_status FROM clean)",
        "by_direction": "SELECT COUNT(*) FROM (SELECT DISTINCT direction FROM clean)",
        "clustered": f"SELECT COUNT(*) FROM clean WHERE {feats}", "cluster_stats": "SELECT 5", "lr_metrics": "SELECT 5",
        "lr_coefficients": "SELECT 6", "lr_model_params": "SELECT 1",
        "lr_predictions": "SELECT least(800, COUNT(*)) FROM keyed WHERE NOT in_train AND property_type IN (SELECT label FROM ti) "
                          "AND district IN (SELECT label FROM di)",
        "lr_category_map": "SELECT (SELECT COUNT(*) FROM ti) + (SELECT COUNT(*) FROM di)",
    }
    warehouse = {
        "listings": "SELECT COUNT(*) FROM clean", "district_stats": f"SELECT COUNT(*) FROM ({_district_stats('clean')})",
        "type_stats": "SELECT COUNT(*) FROM bt",
        "price_distribution": "SELECT COUNT(DISTINCT price_tier) FROM clean",
        "legal_stats": "SELECT COUNT(DISTINCT legal_status) FROM clean WHERE legal_status <> 'None'",
    }
    outputs = counted | {f"wh.{k}": v for k, v in warehouse.items()} | {f"export.{k}": v for k, v in counted.items()}
    base = with_ctes("clean") + f", {BY_DISTRICT}, {BY_TYPE}, {train} "
    sql["flow_batch"] = base + " UNION ALL ".join(f"SELECT '{k}' AS output, CAST(({v}) AS BIGINT) AS rows" for k, v in outputs.items())
    sql["sink_export_views"] = base + " UNION ALL ".join(
        f"SELECT '{k}' AS view, CAST(({v}) AS BIGINT) AS rows, 'ok' AS status" for k, v in counted.items() if k != "by_direction"
    ) + " UNION ALL SELECT 'by_direction', NULL, 'missing'"
    named = "IS NOT NULL AND {0} <> 'None'"
    charts = []
    for state in ("merged", "batch", "none"):
        table, kind, count = {"merged": ("md", "mt", "merged_listings"), "batch": ("bd", "bt", "total_listings"), "none": ("", "", "")}[state]
        if state == "none":
            charts += [
                ("district", "district, COUNT(listing_id), AVG(price_billion) FROM f WHERE district IS NOT NULL GROUP BY district"),
                ("type", "property_type, COUNT(*), NULL FROM f WHERE property_type IS NOT NULL GROUP BY property_type"),
                ("price_tier", "price_tier, COUNT(*), NULL FROM f WHERE price_tier IS NOT NULL GROUP BY price_tier"),
                ("type_ppm", "property_type, NULL, AVG(price_per_m2_million) FROM f GROUP BY property_type HAVING AVG(price_per_m2_million) IS NOT NULL"),
                ("legal", "legal_status, COUNT(*), NULL FROM f WHERE legal_status " + named.format("legal_status") + " GROUP BY legal_status"),
                ("direction", "direction, COUNT(listing_id), AVG(price_per_m2_million) FROM f WHERE direction " + named.format("direction") + " GROUP BY direction"),
            ]
        else:
            price = "merged_avg_price" if state == "merged" else "avg_price_billion"
            charts += [
                ("district", f"district, {count}, {price} FROM {table}"), ("type", f"property_type, {count}, NULL FROM {kind}"),
                ("price_tier", "price_tier, COUNT(*), NULL FROM clean GROUP BY price_tier"),
                ("type_ppm", f"property_type, NULL, avg_price_per_m2 FROM {kind} WHERE avg_price_per_m2 IS NOT NULL"),
                ("legal", "legal_status, COUNT(*), NULL FROM clean WHERE legal_status " + named.format("legal_status") + " GROUP BY legal_status"),
                ("direction", f"direction, COUNT(*), {rnd('AVG(price_per_m2_million)', 1)} FROM clean WHERE direction "
                              + named.format("direction") + " GROUP BY direction"),
            ]
        charts[-6:] = [(state, *c) for c in charts[-6:]]
    one_of = [f"SELECT '{state}' AS state, '{chart}' AS chart, x.* FROM (SELECT {body}) x(key, n, value)" for state, chart, body in charts]
    sql["dash_chart_sources"] = with_ctes("speed") + (
        f", {MERGED_DISTRICT}, {MERGED_TYPE}, {FILTERED} SELECT state, chart, key, CAST(n AS BIGINT) AS n, CAST(value AS DOUBLE) AS value FROM ("
        + " UNION ALL ".join(one_of) + ")")
    live = (f"SELECT district, property_type, COUNT(*) AS new_listings, {rnd('AVG(price_billion)', 3)} AS avg_price, "
            f"{rnd('AVG(price_per_m2_million)', 1)} AS avg_price_m2 FROM speed GROUP BY district, property_type")
    sql["stream_agg_complete"] = with_ctes("speed") + live
    sql["sink_stream_complete"] = sql["stream_agg_complete"]
    return sql


def oracle_sql() -> dict[str, str]:
    return build()
