"""Listing expressions shared by the batch clean step and the stream enrich step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestat.constants import (
    AREA_TIER_BOUNDS,
    AREA_TIER_LABELS,
    PRICE_TIER_BOUNDS,
    PRICE_TIER_LABELS,
)

# Characters Python's str.strip() removes: ASCII whitespace and separators
# (\t \n \v \f \r, U+001C-U+001F, space), NEL, and the Unicode space, line and
# paragraph separators (NBSP, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F,
# U+205F, U+3000).
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# A plain decimal number, optionally signed, optionally with exponent.  Anything
# else ('nan', 'inf', '5d', '0x1A') is not a number for the cleaning step.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace characters (native, no regex)."""
    return F.btrim(c, F.lit(STRIP_CHARS))


def tier(value: str | Column, bounds: list, labels: list[str], null_as_top: bool = False) -> Column:
    """Bucket a number into labelled tiers; lower bounds inclusive.

    ``null_as_top`` reproduces the stream behaviour where a missing value falls
    through every comparison into the top tier; the batch behaviour keeps NULL.
    """
    v = _col(value)
    expr = F.when(v < bounds[0], labels[0])
    for bound, label in zip(bounds[1:], labels[1:-1]):
        expr = expr.when(v < bound, label)
    if null_as_top:
        return expr.otherwise(labels[-1])
    return expr.when(v.isNotNull(), labels[-1])


def price_tier(value: str | Column = "price_billion", null_as_top: bool = False) -> Column:
    return tier(value, PRICE_TIER_BOUNDS, PRICE_TIER_LABELS, null_as_top)


def area_tier(value: str | Column = "area_m2", null_as_top: bool = False) -> Column:
    return tier(value, AREA_TIER_BOUNDS, AREA_TIER_LABELS, null_as_top)


def derive_ppm(price: str | Column = "price_billion", area: str | Column = "area_m2",
               ppm: str | Column = "price_per_m2_million") -> Column:
    """Keep a given price per m²; else derive round(price*1000/area, 2) when area > 0."""
    p, a, m = _col(price), _col(area), _col(ppm)
    derived = F.when(p.isNotNull() & a.isNotNull() & (a > 0), F.round(p * 1000 / a, 2))
    return F.coalesce(m, derived)


def normalize_text(value: str | Column) -> Column:
    """Strip Unicode whitespace at both ends; the text 'nan' becomes NULL."""
    stripped = strip(_col(value).cast("string"))
    return F.when(stripped != F.lit("nan"), stripped)


def cast_numeric(value: str | Column, dtype: T.DataType) -> Column:
    """Coerce to a number, anything unparsable becomes NULL.

    Text is accepted only when it is a plain decimal number (surrounding
    whitespace allowed), so 'nan', 'inf' or '5d' do not turn into NaN, infinity
    or 5.0 the way a bare cast would.  Integer columns take integral values only.
    """
    v = _col(value)
    text = strip(v.cast("string"))
    as_double = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
        return F.when(as_double == F.floor(as_double), as_double.try_cast(dtype)).cast(dtype)
    return as_double.cast(dtype)
