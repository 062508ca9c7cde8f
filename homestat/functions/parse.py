"""Parsers for collected listing text (price, area, location, category, id, url)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from homestat.constants import (
    CATEGORY_TYPES,
    DEFAULT_PROPERTY_TYPE,
    ELLIPSIS,
    EMPTY_TITLE,
    TITLE_MAX_CHARS,
    UNIT_BILLION,
    UNIT_MILLION,
)
from homestat.functions.listing import strip

_NOT_NUMBER = r"[^0-9.]"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c: Column) -> Column:
    return strip(c)


def _number_before(text: Column, unit: str) -> Column:
    head = F.substring_index(text, unit, 1)
    return F.regexp_replace(head, _NOT_NUMBER, "").try_cast("double")


def parse_price(text: str | Column) -> Column:
    """'5,2 tỷ' -> 5.2, '950 triệu' -> 0.95 (billions); anything else -> NULL.

    The comma is read as the decimal mark; only the digits and dots before the
    first unit word count, so '3 tỷ 500 triệu' is 3.0 and '1.2.3 tỷ' is NULL.
    """
    s = _strip(F.replace(F.lower(_col(text)), F.lit(","), F.lit(".")))
    return (
        F.when(s.contains(UNIT_BILLION), _number_before(s, UNIT_BILLION))
        .when(s.contains(UNIT_MILLION), F.round(_number_before(s, UNIT_MILLION) / 1000, 4))
    )


def parse_area(text: str | Column) -> Column:
    """Keep digits and dots and read a number: '65 m²' -> 65.0; empty -> NULL."""
    return F.regexp_replace(_col(text), _NOT_NUMBER, "").try_cast("double")


def parse_location(text: str | Column) -> Column:
    """'ward, district, city' -> struct(city, district, ward); missing parts are ''.

    The last comma-separated part is the city, the one before the district and
    the one before that the ward.
    """
    parts = F.transform(F.split(F.coalesce(_col(text), F.lit("")), ",", -1), _strip)
    return F.struct(
        F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")).alias("city"),
        F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit("")).alias("district"),
        F.coalesce(F.try_element_at(parts, F.lit(-3)), F.lit("")).alias("ward"),
    )


def parse_category(slug: str | Column) -> Column:
    """Category slug -> property type; unknown slugs get the generic type."""
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(CATEGORY_TYPES.items())])
    return F.coalesce(F.try_element_at(mapping, _col(slug)), F.lit(DEFAULT_PROPERTY_TYPE))


def derive_id(product_id: str | Column, url: str | Column) -> Column:
    """The given product id, else the first 12 hex digits of md5(url)."""
    pid = _col(product_id)
    return F.when(pid.isNotNull() & (pid != ""), pid).otherwise(F.substring(F.md5(_col(url)), 1, 12))


def abs_url(href: str | Column, base: str) -> Column:
    """Resolve a link against ``base`` the way a browser does; empty stays ''."""
    h = _col(href)
    origin = F.regexp_extract(F.lit(base), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(F.lit(base), r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    base_dir = F.regexp_extract(F.lit(base), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*/)?)", 1)
    base_dir = F.when(base_dir.endswith("/"), base_dir).otherwise(F.concat(base_dir, F.lit("/")))
    return (
        F.when(h.isNull() | (h == ""), F.lit(""))
        .when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(origin, h))
        .when(h.startswith("?") | h.startswith("#"), F.concat(F.lit(base), h))
        .otherwise(F.concat(base_dir, h))
    )


def truncate_title(title: str | Column, max_chars: int = TITLE_MAX_CHARS) -> Column:
    """First ``max_chars`` characters plus an ellipsis when longer; empty -> placeholder."""
    t = _col(title)
    return (
        F.when(t.isNull() | (t == ""), F.lit(EMPTY_TITLE))
        .when(F.length(t) > max_chars, F.concat(F.substring(t, 1, max_chars), F.lit(ELLIPSIS)))
        .otherwise(t)
    )
