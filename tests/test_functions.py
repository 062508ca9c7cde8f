"""Edge tables for the parsing and cleaning expressions (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestat.constants import AREA_TIER_LABELS, DEFAULT_PROPERTY_TYPE, EMPTY_TITLE, PRICE_TIER_LABELS
from homestat.functions import (
    abs_url,
    area_tier,
    cast_numeric,
    derive_id,
    derive_ppm,
    normalize_text,
    parse_area,
    parse_category,
    parse_location,
    parse_price,
    price_tier,
    truncate_title,
)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_price(spark):
    got = one_col(spark, ["5,2 tỷ", "950 triệu", "3 tỷ 500 triệu", "1.2.3 tỷ", "Thỏa thuận", "", None, "12 TỶ"],
                  parse_price)
    assert got == [5.2, 0.95, 3.0, None, None, None, None, 12.0]


def test_parse_area(spark):
    assert one_col(spark, ["65 m²", "1,200 m²", "65 m2", "", None], parse_area) == [65.0, 1200.0, 652.0, None, None]


def test_parse_location(spark):
    rows = one_col(spark, ["P1, Q1, HCM", "HCM", "", None, " a ,b,  c , d "], parse_location)
    assert [(r.ward, r.district, r.city) for r in rows] == [
        ("P1", "Q1", "HCM"), ("", "", "HCM"), ("", "", ""), ("", "", ""), ("b", "c", "d")]


def test_parse_category(spark):
    got = one_col(spark, ["ban-can-ho-chung-cu", "unknown", None], parse_category)
    assert got == ["Căn hộ chung cư", DEFAULT_PROPERTY_TYPE, DEFAULT_PROPERTY_TYPE]


def test_cast_numeric(spark):
    got = one_col(spark, ["abc", "5d", "nan", "", " 5.5 ", "inf", "1e3", "-2"],
                  lambda c: cast_numeric(c, T.DoubleType()))
    assert got == [None, None, None, None, 5.5, None, 1000.0, -2.0]
    ints = one_col(spark, ["3", "3.0", "3.5", "x"], lambda c: cast_numeric(c, T.IntegerType()))
    assert ints == [3, 3, None, None]


@pytest.mark.parametrize("stream", [False, True])
def test_tiers(spark, stream):
    prices = one_col(spark, [1.99, 2.0, 5.0, 10.0, 20.0, None], lambda c: price_tier(c, stream), "double")
    top = PRICE_TIER_LABELS[-1] if stream else None
    assert prices == PRICE_TIER_LABELS[:1] + PRICE_TIER_LABELS[1:] + [top]
    areas = one_col(spark, [39.9, 40.0, 80.0, 150.0, 300.0, None], lambda c: area_tier(c, stream), "double")
    assert areas == AREA_TIER_LABELS + [AREA_TIER_LABELS[-1] if stream else None]


def test_derive_ppm(spark):
    df = spark.createDataFrame(
        [(2.0, 50.0, None), (2.0, 0.0, None), (2.0, None, None), (2.0, 50.0, 7.0), (None, 50.0, None),
         (4.475925, 1.0, None)],
        "p double, a double, m double")
    got = [r[0] for r in df.select(derive_ppm("p", "a", "m")).collect()]
    assert got == [40.0, None, None, 7.0, None, 4475.93]


def test_normalize_text(spark):
    got = one_col(spark, [" Quận 1\t", "nan", " a  b ", None, "　x "], normalize_text)
    assert got == ["Quận 1", None, "a  b", None, "x"]


def test_truncate_title(spark):
    long = "x" * 61
    got = one_col(spark, ["short", long, "", None, "y" * 60], truncate_title)
    assert got == ["short", "x" * 60 + "…", EMPTY_TITLE, EMPTY_TITLE, "y" * 60]


def test_abs_url_and_id(spark):
    base = "https://site.example"
    got = one_col(spark, ["/a/b", "", "https://o.example/x", "//cdn.example/y", "rel"], lambda c: abs_url(c, base))
    assert got == ["https://site.example/a/b", "", "https://o.example/x", "https://cdn.example/y",
                   "https://site.example/rel"]
    df = spark.createDataFrame([("123", "u"), ("", "https://site.example/a"), (None, "")], "pid string, url string")
    ids = [r[0] for r in df.select(derive_id("pid", "url")).collect()]
    import hashlib
    assert ids == ["123", hashlib.md5(b"https://site.example/a").hexdigest()[:12], hashlib.md5(b"").hexdigest()[:12]]
