"""K-Means whose result does not depend on partitions or on the order of addition.

Features are taken as whole multiples of a millionth, and so are their z-scores, so that every sum
is exact.  Seeds come from a bounded number of rows in the order of their ids' hashes.  A step is
one aggregate: the points' sums by nearest centre, k rows for the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestat.schema import KMEANS_FEATURES
from homestat.session import materialize

#: Units of a feature or a z-score.
UNIT = 1_000_000
#: Rows, in hash order, of which the seeds are chosen.
SEED_ROWS = 200


def units(x: Column) -> Column:
    return F.floor(x * F.lit(float(UNIT)) + F.lit(0.5)).cast("long")


@dataclass(frozen=True)
class Scale:
    """Mean and sample deviation of each feature, in units; no deviation: the score is 0."""

    mean: tuple[float, ...]
    deviation: tuple[float, ...]

    def scores(self, features: list[str]) -> list[Column]:
        return [units((units(F.col(c).cast("double")).cast("double") - F.lit(m)) / F.lit(s)) if s else F.lit(0).cast("long")
                for c, m, s in zip(features, self.mean, self.deviation)]


def fit_scale(data: DataFrame, features: list[str]) -> Scale:
    """One aggregate of exact sums."""
    exact = lambda c: units(F.col(c).cast("double")).cast("decimal(19,0)")
    sums = data.agg(F.count(F.lit(1)).alias("n"), *[F.sum(exact(c)).alias(f"s{i}") for i, c in enumerate(features)],
                    *[F.sum((exact(c) * exact(c)).cast("decimal(38,0)")).alias(f"q{i}") for i, c in enumerate(features)]).first()
    n = sums["n"]
    if not n:
        return Scale((0.0,) * len(features), (0.0,) * len(features))
    mean, deviation = [], []
    for i in range(len(features)):
        s, q = float(sums[f"s{i}"]), float(Decimal(sums[f"q{i}"]))
        mean.append(s / n)
        deviation.append(max(0.0, (q - s * s / n) / (n - 1)) ** 0.5 if n > 1 else 0.0)
    return Scale(tuple(mean), tuple(deviation))


def choose_seeds(points: list[tuple[int, ...]], k: int) -> list[tuple[float, ...]]:
    """Greedy: each seed is the point that brings all points' distances to the seeds down most; ties to the first."""
    between = [[sum((x - y) ** 2 for x, y in zip(p, q)) for q in points] for p in points]
    nearest = [None] * len(points)
    picked: list[int] = []
    for _ in range(min(k, len(points))):
        cost = lambda j: sum(d if best is None or d < best else best for d, best in zip(between[j], nearest))
        new = min(range(len(points)), key=lambda j: (cost(j), j))
        picked.append(new)
        nearest = [d if best is None or d < best else best for d, best in zip(between[new], nearest)]
    return [tuple(float(x) for x in points[j]) for j in picked]


def nearest_centre(scores: list[Column], centres: list[tuple[float, ...]]) -> Column:
    """The number of the nearest centre; ties to the smallest number."""
    def distance(centre):
        total = None
        for z, c in zip(scores, centre):
            part = (z.cast("double") - F.lit(c)) * (z.cast("double") - F.lit(c))
            total = part if total is None else total + part
        return total

    distances = [distance(c) for c in centres]
    least = F.least(*distances) if len(distances) > 1 else distances[0]
    number = F.lit(0)  # also without scores
    for i in reversed(range(1, len(centres))):
        number = F.when(distances[i] <= least, F.lit(i)).otherwise(number)
    return F.when(distances[0] <= least, F.lit(0)).otherwise(number)


@dataclass
class Segmentation:
    features: list[str]
    scale: Scale
    centres: list[tuple[float, ...]]
    steps: int

    def assign(self, data: DataFrame, column: str = "cluster") -> DataFrame:
        if not self.centres:
            return data.withColumn(column, F.lit(None).cast("int"))
        return data.withColumn(column, nearest_centre(self.scale.scores(self.features), self.centres))


def fit(data: DataFrame, k: int = 5, max_iter: int = 30, features: list[str] = KMEANS_FEATURES, row_id: str = "listing_id") -> Segmentation:
    """Lloyd's steps from greedy seeds until no centre moves, ``max_iter`` at most.

    ``data`` is scanned three times, so it should be a written table; its scores are written and scanned once a step.  A centre without points stays
    where it is.  With fewer rows than ``k`` there are as many centres as rows; without rows, none.
    """
    scale = fit_scale(data, features)
    scores = scale.scores(features)
    names = [f"z{i}" for i in range(len(features))]
    first = data.orderBy(F.md5(F.col(row_id).cast("string")), row_id, *features).limit(SEED_ROWS).select(*[z.alias(n) for z, n in zip(scores, names)])
    # a limit keeps the order of the sort before it
    centres = choose_seeds([tuple(r) for r in first.collect()], k)
    # the steps read the scores alone
    points = materialize(data.select(*[z.alias(n) for z, n in zip(scores, names)]), "points")
    step = 0
    while centres and step < max_iter:
        step += 1
        sums = points.groupBy(nearest_centre([F.col(n) for n in names], centres).alias("c")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).collect()
        moved = list(centres)
        for r in sums:
            moved[r["c"]] = tuple(float(r[n]) / float(r["n"]) for n in names)
        if moved == centres:
            break
        centres = moved
    return Segmentation(list(features), scale, centres, step)
