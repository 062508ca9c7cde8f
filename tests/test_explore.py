"""Dashboard operators on hand-made rows."""

import datetime as dt

from homestat.constants import PRICE_TIER_LABELS
from homestat.operators import explore as E


def test_top_districts_uses_merged_columns_and_ties(spark):
    rows = [(f"D{i}", "C", float(i), 10 if i < 3 else i) for i in range(20)] + [(None, "C", None, 99)]
    df = spark.createDataFrame(rows, "district string, city string, merged_avg_price double, merged_listings bigint")
    got = [(r.district, r.listings) for r in E.top_districts(df, 5).collect()]
    assert got == [("D19", 19), ("D18", 18), ("D17", 17), ("D16", 16), ("D15", 15)]  # NULL price row dropped
    ties = E.top_districts(df.where("district in ('D0','D1','D2')"), 2).collect()
    assert [r.district for r in ties] == ["D0", "D1"]


def test_latest_feed_order_and_titles(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(f"L{i}", "x" * (70 if i == 9 else 5), "T", "D", "1 tỷ", t + dt.timedelta(minutes=i % 5)) for i in range(10)]
    df = spark.createDataFrame(rows, "listing_id string, title string, property_type string, district string, "
                               "price_raw string, ingestion_time timestamp")
    got = E.latest_feed(df, 3).collect()
    assert [r.listing_id for r in got] == ["L4", "L9", "L3"]
    assert got[1].title == "x" * 60 + "…"


def test_sort_tiers_fixed_order(spark):
    df = spark.createDataFrame([(t, i) for i, t in enumerate(sorted(PRICE_TIER_LABELS))], "price_tier string, count int")
    assert [r.price_tier for r in E.sort_tiers(df).collect()] == PRICE_TIER_LABELS


def test_group_sizes_dimensions(spark):
    rows = [("A", "2-5 tỷ", "F"), ("A", "2-5 tỷ", None), ("B", None, "F")]
    df = spark.createDataFrame(rows, "property_type string, price_tier string, legal_status string")
    got = {(r.dimension, r.value): r["count"] for r in E.group_sizes(df).collect()}
    assert got == {("property_type", "A"): 2, ("property_type", "B"): 1, ("price_tier", "2-5 tỷ"): 2,
                   ("legal_status", "F"): 2}


def test_filter_facets_equalities(spark):
    rows = [("A", "C1", 1.0), ("A", "C2", 5.0), ("B", "C1", 9.0)]
    df = spark.createDataFrame(rows, "property_type string, city string, price_billion double")
    f = E.filter_facets(df, E.Facets(property_type="A", price_lo=0.5, price_hi=5.0))
    assert sorted(r.city for r in f.collect()) == ["C1", "C2"]
    assert E.filter_facets(df, E.Facets(city="C1")).count() == 2


def test_latest_feed_size_is_the_recent_rows_or_the_total(spark):
    schema = "district string, price_billion double, price_per_m2_million double"
    some = spark.createDataFrame([("a", 1.0, 2.0)] * 5, schema)
    for recent, want in ((some.limit(2), 2), (some.limit(0), 5), (None, 5)):
        assert E.kpi_cards(some, some, recent).first().latest_feed_rows == want
    assert E.kpi_cards(some, None).first().latest_feed_rows == 0


def test_profiles_of_empty_and_keyless_tables(spark):
    from homestat.operators import ml as M
    from homestat.operators import profile as P
    from homestat.schema import KMEANS_FEATURES
    empty = spark.createDataFrame([], "listing_id string, city string")
    assert P.duplicates(empty).first().asDict() == {"rows": 0, "duplicates": 0, "duplicate_pct": None}
    assert {r.null_pct for r in P.nulls(empty).collect()} == {None}
    keyless = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None), ("c", 1)], "city string, n int")
    assert P.duplicates(keyless).first().duplicates == 2
    shape = P.shape(keyless).first()
    assert (shape.rows, shape.columns, shape.names, shape.dtypes) == (5, 2, ["city", "n"], ["string", "int"])
    flat = spark.createDataFrame([("x", *[3.0] * len(KMEANS_FEATURES))] * 3, "listing_id string, " + ", ".join(f"{c} double" for c in KMEANS_FEATURES))
    assert {v for r in M.zscores(flat).collect() for v in r[1:]} == {0.0}


def test_charts_prefer_published_views(spark):
    filtered = spark.createDataFrame([("i", "T", "D", "tier", "None", "N", 1.0, 2.0)],
                                     "listing_id string, property_type string, district string, price_tier string, legal_status string, "
                                     "direction string, price_billion double, price_per_m2_million double")
    view = spark.createDataFrame([("V", 7, 3.5)], "property_type string, total_listings long, avg_price_per_m2 double")
    given = E.chart_sources({"by_type": view, "merged_by_type": view.limit(0)}, filtered)
    assert given["type"].first().total_listings == 7 and given["type_ppm"].first().avg_price_per_m2 == 3.5
    assert given["district"].first().merged_listings == 1 and given["legal"].count() == 0 and given["direction"].first()["count"] == 1
