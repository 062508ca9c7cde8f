"""Reports by batches, exact medians of groups, places in a global order."""

import random

import pytest
from pyspark.sql import functions as F

from homestat.operators import incremental as INC
from homestat.operators import ml as M
from homestat.operators import views as V
from homestat.operators.ranking import global_rank, lower_quantile

COLUMNS = "district string, city string, property_type string, price_tier string, legal_status string, " \
    "price_billion double, price_per_m2_million double, area_m2 double, bedrooms int"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    maybe = lambda x: None if rng.random() < 0.1 else x
    data = [(maybe(rng.choice(["hot"] * 9 + ["a", "b"])), maybe(rng.choice(["x", "y"])), maybe(rng.choice("pqr")), maybe(rng.choice("uv")),
             rng.choice(["red", "None", None]), maybe(rng.choice([1.0, 2.5, 3.0, rng.randint(1, 400) / 8])), maybe(rng.randint(1, 90) / 4),
             maybe(rng.randint(8, 800) / 2), maybe(rng.randint(1, 5))) for _ in range(600)]
    data += [("late", "x", "only nulls", None, "red", None, None, None, None)] * 2
    return spark.createDataFrame(data, COLUMNS).withColumns({
        "direction": F.col("city"), "batch": F.pmod(F.monotonically_increasing_id(), F.lit(3))}).cache()


REPORTS = {**V.BATCH_VIEWS, **V.WAREHOUSE_TABLES}


@pytest.mark.parametrize("name", REPORTS)
def test_batches_give_the_full_rebuild(spark, rows, tmp_dir, name):
    report = REPORTS[name]
    state = INC.ReportState(spark, f"{tmp_dir}/state", report)
    assert state.result() is None
    for n in range(3):
        assert state.add(rows.where(F.col("batch") == n), n)
        assert not state.add(rows, n)  # handed in again
    assert state.result().collect() == report.over(rows).collect()


def test_an_empty_batch_changes_nothing(spark, rows, tmp_dir):
    state = INC.ReportState(spark, f"{tmp_dir}/state", V.BATCH_VIEWS["by_district"])
    state.add(rows.limit(0), 0)
    assert state.result().collect() == []
    state.add(rows, 1)
    state.add(rows.limit(0), 2)
    assert state.result().collect() == V.by_district(rows).collect()


def test_lower_quantile_equals_sorting(spark):
    rng = random.Random(3)
    data = [(k, None if rng.random() < 0.05 else rng.choice([7.0, -1.5, rng.randint(-40, 40) / 4]), rng.randint(1, 4))
            for k in ["hot"] * 800 + ["a", "b", None] * 15 + ["one"]]
    data += [("void", None, 1), ("nan", float("nan"), 3), ("nan", 1.0, 2)]
    counts = spark.createDataFrame(data, "k string, x double, n int").repartition(7)
    for p in (0.0, 0.25, 0.5, 0.9, 1.0):
        want = {}
        for k in {d[0] for d in data}:
            flat = sorted((x for kk, x, n in data if kk == k and x is not None for _ in range(n)), key=lambda x: (x != x, x))
            if flat:
                place = max(-int(-(len(flat) * p) // 1), 1) - 1
                want[k] = repr(flat[place])
        got = {r.k: repr(r.q) for r in lower_quantile(counts, ["k"], "x", "n", "q", p).collect()}
        assert got == want


def test_places_span_range_partitions_without_one_task(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(5)
    ranked = global_rank(df, [F.desc("x")])
    assert [(r.x, r["rank"]) for r in ranked.orderBy("rank").collect()] == [(4999 - i, i) for i in range(5000)]
    assert global_rank(df.limit(0), ["x"]).count() == 0
    labels = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "t string")
    index = M.string_index(labels, "t")
    assert {r.label: r["index"] for r in index.collect()} == {"b": 0.0, "a": 1.0, "c": 2.0}
    assert "SinglePartition" not in index._jdf.queryExecution().executedPlan().toString()
