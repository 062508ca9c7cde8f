"""Streaming (file source, micro-batches, restart), ML fixtures, quantiles and HTML cards."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from homestat.constants import SEGMENT_NAMES
from homestat.operators import html as H
from homestat.operators import ml as M
from homestat.operators.quantiles import exact_quantiles, value_at_ranks
from homestat.schema import ENVELOPE_SCHEMA
from homestat.streaming import speed as ST


def envelope_rows(n, start=0):
    rows = []
    for i in range(start, start + n):
        value = {"listing_id": f"L{i}", "title": "t", "property_type": "A" if i % 2 else "B",
                 "price_billion": float(1 + i % 30), "area_m2": None if i % 5 == 0 else 30.0 + i,
                 "price_per_m2_million": None, "district": f"D{i % 3}", "bedrooms": 2}
        rows.append((f"L{i}", json.dumps(value, ensure_ascii=False), None))
    return rows


def test_stream_parse_edges(spark):
    rows = [
        ("k1", '{"listing_id": 12, "price_billion": 3, "bedrooms": 3.0, "area_m2": 50}', None),
        ("k2", "{not json", None),
        ("k3", '{"listing_id": "x", "price_billion": null}', None),
    ]
    env = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    out = ST.enrich(ST.parse(env)).collect()
    assert len(out) == 1
    r = out[0]
    assert r.listing_id == "12" and r.bedrooms is None and r.price_per_m2_million == 60.0
    assert r.price_tier == "2-5 tỷ"


def test_stream_equals_batch_and_restart(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    for part in range(3):
        spark.createDataFrame(envelope_rows(20, part * 20), ENVELOPE_SCHEMA).write.mode("append").parquet(src)
    stream = ST.read_envelope_files(spark, src, max_files_per_trigger=1)
    q = ST.start_append(ST.enrich(ST.parse(stream)), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", trigger=None)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3  # several micro-batches
    first = spark.read.parquet(f"{tmp_dir}/out").count()
    batch = ST.enrich(ST.parse(spark.read.schema(ENVELOPE_SCHEMA).parquet(src))).count()
    assert first == batch == 60
    # restart on the same checkpoint: nothing is written twice
    q2 = ST.start_append(ST.enrich(ST.parse(ST.read_envelope_files(spark, src))), f"{tmp_dir}/out",
                         f"{tmp_dir}/ckpt", trigger=None)
    q2.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 60
    # new input is picked up once
    spark.createDataFrame(envelope_rows(5, 100), ENVELOPE_SCHEMA).write.mode("append").parquet(src)
    q3 = ST.start_append(ST.enrich(ST.parse(ST.read_envelope_files(spark, src))), f"{tmp_dir}/out",
                         f"{tmp_dir}/ckpt", trigger=None)
    q3.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 65


def test_live_aggregate_complete_mode(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    for part in range(3):
        spark.createDataFrame(envelope_rows(10, part * 10), ENVELOPE_SCHEMA).write.mode("append").parquet(src)
    queries = ST.run_speed_layer(spark, ST.read_envelope_files(spark, src, max_files_per_trigger=1),
                                 f"{tmp_dir}/out", f"{tmp_dir}/ckpt", trigger=None,
                                 aggregate_sink="memory", aggregate_name="live_test")
    assert all(not q.isActive for q in queries)
    live = {(r.district, r.property_type): r.new_listings for r in spark.table("live_test").collect()}
    batch = ST.live_aggregate(ST.enrich(ST.parse(spark.read.schema(ENVELOPE_SCHEMA).parquet(src))))
    assert live == {(r.district, r.property_type): r.new_listings for r in batch.collect()}
    assert sum(live.values()) == 30


def test_kmeans_planted_segments(spark):
    rng = random.Random(7)
    rows = []
    for c in range(5):
        for i in range(60):
            base = (c + 1) * 10.0
            rows.append((f"{c}-{i}", "T", "D", "C", base + rng.random(), 50 * (c + 1) + rng.random(),
                         100.0 * (c + 1) + rng.random(), c + 1))
    df = spark.createDataFrame(rows, "listing_id string, property_type string, district string, city string, "
                               "price_billion double, area_m2 double, price_per_m2_million double, bedrooms int")
    seg = M.segments(df)
    stats = seg.stats.collect()
    assert sorted(r["count"] for r in stats) == [60] * 5
    named = {r.listing_id.split("-")[0]: r.segment for r in seg.clustered.collect()}
    assert [named[str(c)] for c in range(5)] == SEGMENT_NAMES


def test_regression_recovers_coefficients(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        a, b, ba, f = rng.uniform(20, 200), int(rng.integers(1, 6)), int(rng.integers(1, 4)), int(rng.integers(1, 6))
        t, d = ["X", "Y"][i % 2], ["P", "Q", "R"][i % 3]
        price = 0.5 + 0.05 * a + 0.3 * b + 0.2 * ba + 0.1 * f
        rows.append((a, b, ba, f, t, d, float(price)))
    df = spark.createDataFrame(rows, "area_m2 double, bedrooms int, bathrooms int, floors int, "
                               "property_type string, district string, price_billion double")
    model = M.fit_regression(df, reg=0.0)
    coefs = model.stages[-1].coefficients.toArray()
    assert np.allclose(coefs[:4], [0.05, 0.3, 0.2, 0.1], atol=1e-6)


def test_score_unseen_and_negative(spark):
    params = {"intercept": -10.0, "coef_area_m2": 0.1, "coef_bedrooms": 0.0, "coef_bathrooms": 0.0,
              "coef_floors": 0.0, "coef_property_type": 1.0, "coef_district": 2.0}
    cats = spark.createDataFrame([("property_type", "A", 1.0), ("district", "D", 3.0)],
                                 "feature string, label string, index double")
    listings = spark.createDataFrame(
        [("1", "A", "D", 100.0, 1, 1, 1), ("2", "Z", "Q", 100.0, 1, 1, 1), ("3", "A", "D", 10.0, 1, 1, 1)],
        "listing_id string, property_type string, district string, area_m2 double, bedrooms int, "
        "bathrooms int, floors int")
    got = {r.listing_id: (r.predicted_price, r.predicted_price_per_m2) for r in M.score(listings, params, cats).collect()}
    assert got["1"] == pytest.approx((7.0, 70.0))
    assert got["2"] == (0.0, 0.0)  # unseen labels index 0 -> -10 + 10 = 0
    assert got["3"] == (0.0, 0.0)  # negative sum clipped


def test_exact_quantiles_band_search(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.lognormal(1, 1, 5000), np.full(3000, 7.0)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(4)
    got = exact_quantiles(df, "x", [0.25, 0.5, 0.95])
    assert got == pytest.approx(list(np.quantile(vals, [0.25, 0.5, 0.95])), rel=1e-12)
    srt = np.sort(vals)
    ranks = [0, 10, 4000, 7999]
    band = value_at_ranks(df.select("x"), ranks, len(vals), band_rows=500, accuracy=100)
    assert [band[r] for r in ranks] == [srt[r] for r in ranks]


CARD_PAGE = """<html><body>
<div class="js__card" data-product-id="P1"><a class="js__card-title" href="/nha-1">Nhà đẹp <b>Q1</b></a>
  <span class="re__card-config-price">5,2 tỷ</span><span class="re__card-config-area">65 m²</span>
  <div class="re__card-location">P1, Quận 1, Hồ Chí Minh</div></div>
<div class="js__card"><h3><a href="/nha-2">Nhà hai</a></h3><span class="price">950 triệu</span></div>
<div class="js__card"><span class="price">1 tỷ</span></div>
</body></html>"""

DETAIL_PAGE = """<html><body>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Số phòng ngủ</span>
  <span class="re__pr-specs-content-item-value">3 phòng</span></div>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Toilet</span>
  <span class="re__pr-specs-content-item-value">2</span></div>
<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Pháp lý</span>
  <span class="re__pr-specs-content-item-value">Sổ đỏ</span></div>
<div class="re__pr-short-info-item"><span class="title">Ngày đăng</span><span class="value">01/02/2024</span></div>
<div class="re__contact-name">Anh A</div>
</body></html>"""


def test_html_cards(spark):
    pages = spark.createDataFrame([(1, "https://site.example/ban-can-ho-chung-cu/p2", CARD_PAGE)],
                                  "page_id long, url string, html string")
    rows = H.extract_listings(pages, base_url="https://site.example",
                              category="ban-can-ho-chung-cu").orderBy("price_billion").collect()
    assert len(rows) == 2  # the card without a title is dropped
    cheap, dear = rows
    assert dear.listing_id == "P1" and dear.title == "Nhà đẹpQ1" and dear.price_billion == 5.2
    assert dear.area_m2 == 65.0 and dear.price_per_m2_million == 80.0
    assert (dear.ward, dear.district, dear.city) == ("P1", "Quận 1", "Hồ Chí Minh")
    assert dear.url == "https://site.example/nha-1" and dear.property_type == "Căn hộ chung cư"
    import hashlib
    assert cheap.listing_id == hashlib.md5(b"https://site.example/nha-2").hexdigest()[:12]
    assert cheap.price_billion == 0.95 and cheap.city == ""


def test_html_details(spark):
    pages = spark.createDataFrame([(1, "u1", DETAIL_PAGE), (2, "u2", "<html></html>")],
                                  "page_id long, url string, html string")
    got = {r.url: r for r in H.extract_details(pages).collect()}
    d = got["u1"]
    assert (d.bedrooms, d.bathrooms, d.floors, d.legal_status) == ("3 phòng", "2", None, "Sổ đỏ")
    assert d.posted_date == "01/02/2024" and d.contact == "Anh A"
    assert got["u2"].bedrooms is None


def test_errors_are_shown_on_request(spark):
    broken = "<div data-product-id><![broken"
    pages = spark.createDataFrame([(1, "https://site.example/a", CARD_PAGE), (2, "https://site.example/b", broken), (3, None, None)],
                                  "page_id long, url string, html string")
    rows = H.extract_listings(pages, base_url="https://site.example", with_errors=True).collect()
    assert [(r.page_id, r.error) for r in rows] == [(1, None), (1, None)]  # broken markup is read as far as it goes
    assert {r.page_id: r.error for r in H.extract_details(pages, with_errors=True).collect()} == {1: None, 2: None, 3: None}
    assert "error" not in H.extract_listings(pages).columns and "error" not in H.extract_details(pages).columns
    # what the parser cannot take is a row with its error
    failed, = H._cards_of(7, "u", 5, H.CARD_SELECTORS)
    assert failed[:2] == (7, "u") and failed[-1].startswith("TypeError")


def test_pages_equal_their_sql_twin(spark, duck):
    from __spark_entry__ import oracle_sql, queries
    for name in ("html_extract", "html_detail"):
        found = queries()[name](spark, "/root/testdata/sf0.001")
        want = duck.execute(oracle_sql()[name])
        columns = [c[0] for c in want.description]
        assert sorted(map(tuple, found.select(columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_exact_quantiles_by_column(spark, monkeypatch):
    from homestat.operators.quantiles import exact_quantiles_by_column
    rng = np.random.default_rng(5)
    a = rng.normal(0, 1, 3000)
    b = rng.integers(0, 20, 3000).astype(float)
    rows = [(float(x), float(y) if i % 7 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    got = exact_quantiles_by_column(df, ["a", "b"], [0.25, 0.5, 0.75])
    bb = np.array([y for i, y in enumerate(b) if i % 7])
    assert got["a"] == pytest.approx(list(np.quantile(a, [0.25, 0.5, 0.75])), rel=1e-12)
    assert got["b"] == pytest.approx(list(np.quantile(bb, [0.25, 0.5, 0.75])), rel=1e-12)
    for band, accuracy in ((100, 100), (1, 20), (1, 10_000)):  # brackets are narrowed, down to single rows
        from homestat.operators import quantiles as Q
        rounds = []
        narrow = Q._narrow
        monkeypatch.setattr(Q, "_narrow", lambda long, open_, acc: (rounds.append(len(open_)), narrow(long, open_, accuracy)))
        big = exact_quantiles_by_column(df, ["a", "b"], [0.0, 0.5, 1.0], band_rows=band)
        monkeypatch.setattr(Q, "_narrow", narrow)
        assert rounds and rounds[0] > 3  # all columns and ranks in one round
        assert big["a"] == pytest.approx(list(np.quantile(a, [0.0, 0.5, 1.0])), rel=1e-12)
        assert big["b"] == pytest.approx(list(np.quantile(bb, [0.0, 0.5, 1.0])), rel=1e-12)


def test_histograms_match_numpy(spark):
    from homestat.operators.profile import histograms
    rng = np.random.default_rng(9)
    a = rng.lognormal(2, 0.7, 4000)
    b = rng.uniform(10, 400, 4000)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = {(r.column_name, r.bin): r["count"] for r in histograms(df, ["a", "b"], bins=50).collect()}
    for name, v in (("a", a), ("b", b)):
        kept = v[v <= np.quantile(v, 0.95)]
        lo, hi = kept.min(), kept.max()
        idx = np.minimum(np.floor((kept - lo) / ((hi - lo) / 50)), 49).astype(int)
        expect = {(name, int(i)): int(n) for i, n in zip(*np.unique(idx, return_counts=True))}
        assert {k: v_ for k, v_ in got.items() if k[0] == name} == expect


def test_publish_json_frame(spark):
    import json as _json
    from homestat.schema import CLEAN_SCHEMA
    from homestat.sources.sinks import publish_json
    row = {f.name: None for f in CLEAN_SCHEMA.fields}
    row.update(listing_id="L1", title="Nhà đẹp Quận 1", price_billion=5.2, bedrooms=3, price_tier="5-10 tỷ")
    no_id = dict(row, listing_id=None)
    df = spark.createDataFrame([tuple(r[f.name] for f in CLEAN_SCHEMA.fields) for r in (row, no_id)], CLEAN_SCHEMA)
    out = publish_json(df).collect()
    assert len(out) == 1 and out[0].key == "L1"
    assert "Nhà đẹp Quận 1" in out[0].value and "\\u" not in out[0].value
    parsed = _json.loads(out[0].value)
    assert list(parsed) == [f.name for f in CLEAN_SCHEMA.fields]
    assert parsed["area_m2"] is None and parsed["price_billion"] == 5.2 and parsed["bedrooms"] == 3


def test_deep_pages_and_errors_lose_no_card(spark):
    card = '<div class="js__card" data-product-id="{}"><h3><a href="/x">T{}</a></h3></div>'
    deep = "<p>" * 2500 + card.format("deep", 1) + "<div>" * 2500 + card.format("deeper", 2)
    pages = spark.createDataFrame([(1, "u1", deep), (2, "u2", card.format("flat", 3)), (3, None, None)],
                                  "page_id long, url string, html string")
    rows = H.card_text(pages).collect()
    assert sorted(r.product_id for r in rows if r.error is None) == ["deep", "deeper", "flat"]
    assert not [r for r in rows if r.error]


def test_failed_cards_are_reported(monkeypatch):
    def broken(card, sel):
        if card.attrs["data-product-id"] == "2":
            raise ValueError("no such thing")
        return ("1", "t", "", "", "", "", None)
    monkeypatch.setattr(H, "_card", broken)
    rows = H._cards_of(7, "u", '<div data-product-id="1"></div><div data-product-id="2"></div>', H.CARD_SELECTORS)
    assert [r[-1] for r in rows] == [None, "ValueError: no such thing"] and rows[1][:2] == (7, "u")
    with pytest.raises(ValueError):
        H.select(H._Dom("<p>").root, "p > a")


def _outline(node):
    return [c if isinstance(c, str) else (c.tag, c.attrs, _outline(c)) for c in node.children]


def test_plain_pages_are_read_without_the_tolerant_parser(monkeypatch):
    card = ('<html><body><div class="js__card" data-product-id="7&amp;8"><H3><a href="/x">a &lt; b</a></H3><br><p><span class="price">'
            '5,2 tỷ</span></div></p> tail</body></html>')
    detail = ('<div class="re__pr-specs-content-item"><span class="re__pr-specs-content-item-title">Số tầng</span>'
              '<span class="re__pr-specs-content-item-value">3</span></div><div class="re__contact-name">x</div>')
    for page in (card, detail, "text", "</p>a<p>b", '<p class="a" class="b">'):
        assert _outline(H._tree(page)) == _outline(H._Dom(page).root)
    for page in ("a < b", "<br/>", "<!-- <p> -->x", "<script>'<p>'</script>", "<p x=y>", "<p", "a &am", "</p x>"):
        assert _outline(H._tree(page)) == _outline(H._Dom(page).root)
    monkeypatch.setattr(H, "_Dom", None)
    assert H._cards_of(1, "u", card, H.CARD_SELECTORS) == [(1, "u", "7&8", "a < b", "/x", "5,2 tỷ", "", "", None)]
    assert H._details_of(1, "u", detail, H.DETAIL_SELECTORS) == (1, "u", [{"title": "Số tầng", "value": "3"}], None, "x", None)


def test_an_interval_is_sketched_once(spark, monkeypatch):
    from homestat.operators import quantiles as Q
    df = spark.range(3000).select(F.col("id").cast("double").alias("x"))
    made = []
    real = F.percentile_approx
    monkeypatch.setattr(Q.F, "percentile_approx", lambda *a: (made.append(a), real(*a))[1])
    assert Q.exact_quantiles_by_column(df, ["x"], [0.25, 0.5, 0.75], band_rows=100) == {"x": [749.75, 1499.5, 2249.25]}
    assert len(made) == 1
