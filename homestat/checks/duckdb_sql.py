"""The listing mapping and cleaning steps written in DuckDB SQL.

These common table expressions are the independent oracle: every registered
Spark query has a SQL twin built from them (see ``homestat.checks.oracle``).
"""

from __future__ import annotations

from homestat.constants import (
    AREA_TIER_BOUNDS,
    AREA_TIER_LABELS,
    CATEGORY_TYPES,
    DEFAULT_PROPERTY_TYPE,
    PRICE_MAX,
    PRICE_MIN,
    PRICE_TIER_BOUNDS,
    PRICE_TIER_LABELS,
)
from homestat.schema import CLEAN_COLUMNS
from homestat.sources.tables import (
    DEDUP_ORDER,
    LISTING_BASE_URL,
    NEGOTIABLE_PRICE,
    NULL_DISTRICT_NATION,
    TYPE_WORD_SLUGS,
)

STRIP = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\p{Z}]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rnd(expr: str, scale: int) -> str:
    """Spark's round() on a double: half-up on the shortest decimal form of the value.

    The double is printed (shortest round-trip text), read as a decimal and
    rounded there; values too large for DECIMAL(38,18) round as doubles.
    """
    return (f"COALESCE(CAST(round(TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {scale}) AS DOUBLE), "
            f"round({expr}, {scale}))")


def tier_sql(x: str, bounds, labels, null_as_top: bool = False) -> str:
    parts = [f"WHEN {x} < {b} THEN {q(lab)}" for b, lab in zip(bounds, labels[:-1])]
    tail = f"ELSE {q(labels[-1])}" if null_as_top else f"WHEN {x} IS NOT NULL THEN {q(labels[-1])}"
    return "CASE " + " ".join(parts) + f" {tail} END"


def price_tier_sql(x: str = "price_billion", null_as_top: bool = False) -> str:
    return tier_sql(x, PRICE_TIER_BOUNDS, PRICE_TIER_LABELS, null_as_top)


def area_tier_sql(x: str = "area_m2", null_as_top: bool = False) -> str:
    return tier_sql(x, AREA_TIER_BOUNDS, AREA_TIER_LABELS, null_as_top)


def normalize_sql(x: str) -> str:
    return f"NULLIF(regexp_replace({x}, '^{STRIP}+|{STRIP}+$', '', 'g'), 'nan')"


def ppm_sql(price="price_billion", area="area_m2", ppm="price_per_m2_million") -> str:
    return (f"COALESCE({ppm}, CASE WHEN {price} IS NOT NULL AND {area} IS NOT NULL AND {area} > 0 "
            f"THEN {rnd(f'{price} * 1000 / {area}', 2)} END)")


JOINED = """
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey"""


def _price_text_sql(p: str) -> str:
    return (f"CASE WHEN {p} IS NULL THEN {q(NEGOTIABLE_PRICE)} "
            f"WHEN {p} >= 1 THEN CAST(CAST(floor({p}) AS BIGINT) AS VARCHAR) || ',' || "
            f"CAST(CAST(floor({p} * 10) - floor({p}) * 10 AS BIGINT) AS VARCHAR) || ' tỷ' "
            f"ELSE CAST(CAST(floor({p} * 1000) AS BIGINT) AS VARCHAR) || ' triệu' END")


_LINES = f"""lines AS (
    SELECT l.*, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate,
           p.p_name, p.p_type, p.p_size, s.s_name, n.n_nationkey, n.n_name, r.r_name,
           CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS lid,
           CASE WHEN n.n_nationkey = {NULL_DISTRICT_NATION} THEN NULL ELSE n.n_name END AS dist,
           l.l_quantity * 8 AS area0,
           20 + l.l_extendedprice / 1000 AS ppm0,
           CASE WHEN p.p_size % 25 = 3 THEN NULL
                WHEN p.p_size % 25 = 1 THEN l.l_quantity * 8 * (20 + l.l_extendedprice / 1000) / 1000 * CAST(50.0 AS DOUBLE)
                WHEN p.p_size % 25 = 2 THEN l.l_quantity * 8 * (20 + l.l_extendedprice / 1000) / 1000 * CAST(0.01 AS DOUBLE)
                ELSE l.l_quantity * 8 * (20 + l.l_extendedprice / 1000) / 1000 END AS price
    {JOINED}
)"""

_RAW = f"""raw AS (
    SELECT
      lid AS listing_id,
      p_name || ' ' || n_name AS title,
      p_type AS property_type,
      {_price_text_sql('price')} AS price_raw,
      price AS price_billion,
      CASE WHEN l_quantity = 50 THEN NULL ELSE area0 END AS area_m2,
      CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE ppm0 END AS price_per_m2_million,
      r_name AS city,
      dist AS district,
      s_name AS ward,
      concat_ws(', ', s_name, dist, r_name) AS address,
      CAST(l_linenumber AS INTEGER) AS bedrooms,
      CAST(p_size % 3 + 1 AS INTEGER) AS bathrooms,
      CAST(p_size % 5 + 1 AS INTEGER) AS floors,
      CASE WHEN p_size % 10 = 0 THEN NULL ELSE o_orderpriority END AS direction,
      o_orderstatus AS legal_status,
      strftime(o_orderdate, '%d/%m/%Y') AS posted_date,
      'agent-' || CAST(o_custkey AS VARCHAR) AS contact,
      {q(LISTING_BASE_URL + '/listing/')} || lid AS url,
      strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS scraped_at,
      {', '.join(DEDUP_ORDER)}
    FROM lines
)"""

_TYPED = f"""typed AS (
    SELECT * REPLACE (
      {ppm_sql()} AS price_per_m2_million,
      {normalize_sql('city')} AS city,
      {normalize_sql('district')} AS district,
      {normalize_sql('ward')} AS ward,
      {normalize_sql('property_type')} AS property_type,
      {normalize_sql('direction')} AS direction,
      {normalize_sql('legal_status')} AS legal_status),
      {price_tier_sql()} AS price_tier,
      {area_tier_sql()} AS area_tier
    FROM raw
)"""

_CLEAN = f"""clean AS (
    SELECT {', '.join(CLEAN_COLUMNS)} FROM (
      SELECT * FROM typed
      WHERE listing_id IS NOT NULL AND title IS NOT NULL AND price_billion IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY {', '.join(DEDUP_ORDER)}) = 1
    ) WHERE price_billion BETWEEN {PRICE_MIN} AND {PRICE_MAX}
)"""

# What the stream brings: no rows of one region, new district names in another, and
# the second line of every order twice.
_MESSAGES = """arrived AS (
    SELECT * REPLACE (CASE WHEN city = 'ASIA' THEN 'NEW ' || district ELSE district END AS district)
    FROM clean WHERE city IS DISTINCT FROM 'AFRICA'
),
messages AS (
    SELECT * FROM arrived UNION ALL SELECT * FROM arrived WHERE listing_id LIKE '%-2'
)"""

# Speed layer = every message through the stream enrich step; the message
# timestamp is the listing's scrape time, also used as ingestion time.
_SPEED = f"""speed AS (
    SELECT * REPLACE (
      {price_tier_sql(null_as_top=True)} AS price_tier,
      {area_tier_sql(null_as_top=True)} AS area_tier),
      CAST(strptime(scraped_at, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS kafka_timestamp,
      CAST(strptime(scraped_at, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS ingestion_time
    FROM messages
    WHERE listing_id IS NOT NULL AND price_billion IS NOT NULL
)"""

_SLUGS = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in TYPE_WORD_SLUGS.items())
_CATS = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in CATEGORY_TYPES.items())

_CARDS = f"""cards AS (
    SELECT
      CASE WHEN l_linenumber % 3 <> 0 THEN lid ELSE '' END AS product_id,
      p_name || ' ' || n_name AS title,
      CASE WHEN l_linenumber <> 7 THEN '/listing/' || lid ELSE '' END AS href,
      {_price_text_sql('price')} AS price_text,
      CAST(CAST(floor(l_quantity * 8) AS BIGINT) AS VARCHAR) || ' m²' AS area_text,
      concat_ws(', ', s_name, dist, r_name) AS location_text,
      COALESCE(CASE split_part(p_type, ' ', 1) {_SLUGS} END, '') AS category
    FROM lines
)"""


def category_sql(slug: str) -> str:
    return f"COALESCE(CASE {slug} {_CATS} END, {q(DEFAULT_PROPERTY_TYPE)})"


def with_ctes(*names: str) -> str:
    """WITH clause holding the named CTEs and everything they depend on."""
    order = ["lines", "raw", "typed", "clean", "messages", "speed", "cards"]
    deps = {"lines": [], "raw": ["lines"], "typed": ["raw"], "clean": ["typed"],
            "messages": ["clean"], "speed": ["messages"], "cards": ["lines"]}
    text = {"lines": _LINES, "raw": _RAW, "typed": _TYPED, "clean": _CLEAN,
            "messages": _MESSAGES, "speed": _SPEED, "cards": _CARDS}
    need: set[str] = set()

    def visit(n: str) -> None:
        if n not in need:
            need.add(n)
            for d in deps[n]:
                visit(d)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(text[n] for n in order if n in need) + "\n"
