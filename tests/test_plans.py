"""Physical-plan properties the design relies on at scale."""

from homestat.operators import clean as C
from homestat.operators import explore as E
from homestat.operators import views as V
from homestat.sources import files as SF
from homestat.sources.sinks import write_parquet
from homestat.sources.tables import joined_lines, raw_listings

SF_SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_each_map_task_before_the_shuffle(spark):
    p = plan(C.clean_listings(raw_listings(spark, SF_SMALL)))
    assert p.count("WindowGroupLimit") == 2
    # printed top-down: Final, the exchange on the id, Partial
    final, partial = p.index("Final"), p.index("Partial")
    assert final < p.index("hashpartitioning(listing_id") < partial


def test_statistics_aggregate_partially_before_shuffle(spark):
    p = plan(V.by_district(C.clean_listings(raw_listings(spark, SF_SMALL))))
    assert "partial_count" in p and "partial_avg" in p and "partial_percentile_approx" in p


def test_geography_is_broadcast(spark):
    p = plan(joined_lines(spark, SF_SMALL))
    assert p.count("BroadcastExchange") >= 2


def test_clean_table_scan_prunes_and_pushes(spark, tmp_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    write_parquet(C.clean_listings(raw_listings(spark, SF_SMALL)), f"{tmp_dir}/clean")
    clean = SF.read_clean(spark, f"{tmp_dir}/clean")
    filtered = E.filter_facets(clean, E.Facets(property_type="STANDARD POLISHED TIN", price_lo=1.0, price_hi=50.0))
    p = plan(filtered.select("listing_id", "price_billion"))
    assert "PushedFilters: [IsNotNull(property_type), IsNotNull(price_billion), EqualTo(property_type" in p
    assert "GreaterThanOrEqual(price_billion,1.0)" in p and "LessThanOrEqual(price_billion,50.0)" in p
    read_schema = p[p.index("ReadSchema"):].split("\n")[0]
    assert "listing_id" in read_schema and "title" not in read_schema and "district" not in read_schema


def test_group_sizes_is_one_scan(spark, tmp_dir):
    write_parquet(C.clean_listings(raw_listings(spark, SF_SMALL)), f"{tmp_dir}/clean")
    clean = SF.read_clean(spark, f"{tmp_dir}/clean")
    p = plan(E.group_sizes(clean))
    assert p.count("FileScan parquet") == 1 and "Expand" in p


def test_top_categories_limit_map_side(spark):
    from homestat.operators.profile import topk_categories
    p = plan(topk_categories(raw_listings(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_kpi_has_no_cross_join(spark):
    c = C.clean_listings(raw_listings(spark, SF_SMALL))
    from homestat.streaming.speed import replay
    p = plan(E.kpi_cards(c, replay(c)))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scoring_does_not_shuffle_listings(spark, tmp_dir):
    from homestat.operators import ml as M
    write_parquet(C.clean_listings(raw_listings(spark, SF_SMALL)), f"{tmp_dir}/clean")
    clean = SF.read_clean(spark, f"{tmp_dir}/clean")
    labels = spark.createDataFrame([("property_type", "a", 0.0), ("district", "b", 0.0)], "feature string, label string, index double")
    p = plan(M.with_category_index(clean, labels))
    assert p.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in p


def test_stream_message_parsed_once(spark):
    from homestat.streaming.speed import replay
    c = C.clean_listings(raw_listings(spark, SF_SMALL))
    opt = replay(c, through_json=True)._jdf.queryExecution().optimizedPlan().toString()
    assert opt.count("from_json") == 1 and opt.count("StructsToJson") == 1


def test_serving_flow_writes_the_cleaned_table_once(spark, monkeypatch):
    from homestat.plans import queries as Q

    wide = []
    monkeypatch.setattr(Q.SK, "write_parquet", lambda df, path: (wide.append(path.rsplit("/", 1)[-1]), write_parquet(df, path))[1])
    kept = Q.S.materialize
    monkeypatch.setattr(Q.S, "materialize", lambda df, name: (wide.append(name), kept(df, name))[1])
    assert Q.flow_serve(spark, SF_SMALL).count() > 0
    assert [n for n in wide if n.startswith("clean")] == ["cleaned"]


def test_cleaned_listings_are_not_shuffled_again_for_their_dedup(spark):
    from homestat.plans.queries import clean
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")  # as with large orders
    try:
        p = plan(clean(spark, SF_SMALL))
    finally:
        spark.conf.set(name, before)
    assert "Window" in p and "hashpartitioning(l_orderkey" in p
    assert not any("hashpartitioning" in line and "l_linenumber" in line for line in p.splitlines())


def test_models_read_written_rows(spark):
    from homestat.operators import ml as M
    rows = [(f"{i}-1", ("a", "b")[i % 2], ("x", "y")[i % 3 % 2], "c", 1.0 + i % 7, 30.0 + i, 50.0, i % 4 + 1, 1, 2) for i in range(60)]
    c = spark.createDataFrame(rows, "listing_id string, property_type string, district string, city string, price_billion double, "
                                    "area_m2 double, price_per_m2_million double, bedrooms int, bathrooms int, floors int")
    pm = M.train_price_model(c)
    assert "md5" not in plan(pm.train) and "md5" not in plan(pm.predictions)
    assert pm.train.count() + pm.test.count() == 60
    assert "Aggregate" not in plan(M.segments(c).stats)
