"""The repeatable K-Means: planted groups, partitions, edge inputs, and Spark ML's cost."""

import random

from pyspark.sql import functions as F

from homestat.operators import kmeans
from homestat.operators import ml as M
from homestat.schema import KMEANS_FEATURES


def rows(n, seed=1):
    own = random.Random(seed)
    centres = [(1, 30, 40, 1), (4, 60, 70, 2), (12, 100, 110, 3), (40, 200, 150, 4), (200, 400, 300, 6)]
    out = []
    for i in range(n):
        c = centres[i % 5]
        out.append((f"id-{i}", *[x * own.uniform(0.95, 1.05) for x in c[:3]], c[3]))
    return out


SCHEMA = "listing_id string, price_billion double, area_m2 double, price_per_m2_million double, bedrooms int"


def test_planted_groups_whatever_the_partitions(spark):
    data = spark.createDataFrame(rows(600), SCHEMA)
    fits = [kmeans.fit(df) for df in (data.repartition(1), data.repartition(7), data.orderBy(F.rand(3)))]
    assert fits[0] == fits[1] == fits[2]
    got = {r.listing_id: r.cluster for r in fits[0].assign(data).collect()}
    groups = {}
    for i in range(600):
        groups.setdefault(got[f"id-{i}"], set()).add(i % 5)
    assert sorted(map(len, groups.values())) == [1] * 5


def test_no_worse_than_random_seeds(spark):
    own = random.Random(4)
    data = spark.createDataFrame([(f"x{i}", own.lognormvariate(1, 1), own.uniform(20, 300), own.gauss(80, 20), own.randint(1, 6)) for i in range(1500)], SCHEMA)
    model = M.fit_kmeans(data)
    fit = kmeans.fit(data)
    scores = fit.scale.scores(KMEANS_FEATURES)
    nearest = F.least(*[sum(((z / kmeans.UNIT - F.lit(c / kmeans.UNIT)) ** 2 for z, c in zip(scores, centre)), F.lit(0.0)) for centre in fit.centres])
    cost = data.agg(F.sum(nearest)).first()[0]
    assert cost <= 1.1 * model.stages[-1].summary.trainingCost


def test_edge_inputs(spark):
    few = spark.createDataFrame(rows(3), SCHEMA)
    assert len(kmeans.fit(few).centres) == 3
    none = kmeans.fit(few.limit(0))
    assert none.centres == [] and [r.cluster for r in none.assign(few).collect()] == [None] * 3
    same = spark.createDataFrame([(f"s{i}", 1.0, 2.0, 3.0, 4) for i in range(9)], SCHEMA)
    assert {r.cluster for r in kmeans.fit(same).assign(same).collect()} == {0}


def test_nearest_centre_by_comparison(spark):
    rows = [(0, 0), (5, 0), (10, 0), (None, 1), (100, 7)]
    df = spark.createDataFrame(rows, "z0 long, z1 long")
    centres = [(0.0, 0.0), (10.0, 0.0), (10.0, 0.0), (100.0, 0.0)]
    nearest = kmeans.nearest_centre([F.col("z0"), F.col("z1")], centres)
    assert [r[0] for r in df.select(nearest).collect()] == [0, 0, 1, 0, 3]  # ties, and no scores, to the smallest number
    assert [r[0] for r in df.select(kmeans.nearest_centre([F.col("z0"), F.col("z1")], centres[:1])).collect()] == [0] * 5
    plan = df.select(nearest)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_min" not in plan
