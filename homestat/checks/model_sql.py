"""The fitted models once more, in DuckDB SQL.

The regression comes from the Gram matrix of its standardised features, solved by elimination
steps; K-Means from its steps written one after the other.  Neither shares code with the fits.
"""

from __future__ import annotations

from homestat.schema import KMEANS_FEATURES, LR_LABEL, LR_NUM_FEATURES


def regression_ctes(reg: float = 0.1) -> str:
    """``fitted`` (intercept, c1..c6) from ``model``, ``ti`` and ``di`` (training rows and label indexes)."""
    xs = [f"x{i}" for i in range(1, 7)]
    columns = ", ".join(f"{c}::DOUBLE AS {x}" for c, x in zip(LR_NUM_FEATURES, xs))
    grid = [(i, j) for i in range(6) for j in range(6)]
    moments = ", ".join(f"AVG({x}) AS m{i}, stddev_pop({x}) AS s{i}" for i, x in enumerate(xs))
    z = lambda i: f"(x{i + 1} - m{i}) / s{i}"
    gram = ", ".join(f"AVG({z(i)} * {z(j)}) + {f'{reg}::DOUBLE / any_value(sy)' if i == j else '0'} AS a{i}{j}" for i, j in grid)
    right = ", ".join(f"AVG({z(i)} * (y - my) / sy) AS b{i}" for i in range(6))
    steps = []
    for p in range(6):
        new = [f"a{i}{j}" if i == p else f"a{i}{j} - a{i}{p} * a{p}{j} / a{p}{p} AS a{i}{j}" for i, j in grid]
        new += [f"b{i}" if i == p else f"b{i} - a{i}{p} * b{p} / a{p}{p} AS b{i}" for i in range(6)]
        steps.append(f"g{p + 1} AS (SELECT {', '.join(new)} FROM g{p})")
    coef = ", ".join(f"b{i} / a{i}{i} * sy / s{i} AS c{i + 1}" for i in range(6))
    return f"""x AS (SELECT {LR_LABEL}::DOUBLE AS y, {columns}, ti."index" AS x5, di."index" AS x6
        FROM model JOIN ti ON property_type = ti.label JOIN di ON district = di.label),
      moments AS (SELECT AVG(y) AS my, stddev_pop(y) AS sy, {moments} FROM x),
      g0 AS (SELECT {gram}, {right} FROM x, moments),
      {', '.join(steps)},
      weights AS (SELECT {coef} FROM g6, moments),
      fitted AS (SELECT my - {' - '.join(f'c{i + 1} * m{i}' for i in range(6))} AS intercept, {', '.join(f'c{i}' for i in range(1, 7))} FROM weights, moments)"""


def predicted(area: str = "area_m2", kind: str = 'ti."index"', district: str = 'di."index"') -> str:
    return f"intercept + c1 * {area} + c2 * bedrooms + c3 * bathrooms + c4 * floors + c5 * {kind} + c6 * {district}"


def kmeans_ctes(k: int = 5, steps: int = 30, seeds: int = 200, unit: int = 1_000_000) -> str:
    """``clustered``: the rows of ``clean`` with all features, and their cluster."""
    dims = range(len(KMEANS_FEATURES))
    units = lambda e: f"CAST(floor(({e}) * {unit}.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)"
    raw = ", ".join(f"{units(f'{c}::DOUBLE')} AS u{i}" for i, c in enumerate(KMEANS_FEATURES))
    moments = ", ".join(
        f"SUM(u{i})::DOUBLE / COUNT(*) AS m{i}, sqrt(greatest(0, (SUM(u{i}::HUGEINT * u{i})::DOUBLE - SUM(u{i})::DOUBLE * SUM(u{i})::DOUBLE / COUNT(*)) / (COUNT(*) - 1))) AS s{i}"
        for i in dims)
    scores = ", ".join(f"CASE WHEN s{i} > 0 THEN {units(f'(u{i}::DOUBLE - m{i}) / s{i}')} ELSE 0 END AS z{i}" for i in dims)
    gap = lambda a, b: " + ".join(f"({a}.z{i} - {b}.z{i})::HUGEINT * ({a}.z{i} - {b}.z{i})" for i in dims)
    out = [f"points AS MATERIALIZED (SELECT *, {raw} FROM clean WHERE {' AND '.join(f'{c} IS NOT NULL' for c in KMEANS_FEATURES)})",
           f"spread AS (SELECT {moments} FROM points)",
           f"scored AS MATERIALIZED (SELECT points.*, {scores} FROM points, spread)",
           f"few AS MATERIALIZED (SELECT row_number() OVER (ORDER BY md5(listing_id), listing_id) AS i, {', '.join(f'z{i}' for i in dims)} FROM scored "
           f"QUALIFY i <= {seeds})",
           f"gaps AS MATERIALIZED (SELECT p.i AS i, q.i AS j, {gap('p', 'q')} AS d FROM few p, few q)",
           "near0 AS (SELECT i, NULL::HUGEINT AS d FROM few)"]
    for p in range(k):
        out.append(f"pick{p} AS MATERIALIZED (SELECT j FROM gaps JOIN near{p} n USING (i) GROUP BY j ORDER BY SUM(least(gaps.d, n.d)), j LIMIT 1)")
        out.append(f"near{p + 1} AS MATERIALIZED (SELECT n.i, least(gaps.d, n.d) AS d FROM near{p} n JOIN gaps ON gaps.i = n.i JOIN pick{p} USING (j))")
    first = ", ".join(f"(SELECT z{i}::DOUBLE FROM few JOIN pick{p} ON j = i) AS c{p}_{i}" for p in range(k) for i in dims)
    out.append(f"step0 AS MATERIALIZED (SELECT {first})")
    distance = lambda p: " + ".join(f"(z{i}::DOUBLE - c{p}_{i}) * (z{i}::DOUBLE - c{p}_{i})" for i in dims)
    distances = ", ".join(f"{distance(p)} AS d{p}" for p in range(k))
    nearest = "CASE " + " ".join(f"WHEN {' AND '.join([f'd{p} <= d{q}' for q in range(k) if q != p])} THEN {p}" for p in range(k)) + " END"
    for t in range(steps):
        means = ", ".join(f"COALESCE(SUM(z{i}) FILTER (c = {p})::DOUBLE / NULLIF(COUNT(*) FILTER (c = {p}), 0)::DOUBLE, any_value(c{p}_{i})) AS c{p}_{i}"
                          for p in range(k) for i in dims)
        out.append(f"step{t + 1} AS MATERIALIZED (SELECT {means} FROM (SELECT *, {nearest} AS c FROM (SELECT *, {distances} FROM scored, step{t})))")
    out.append(f"clustered AS MATERIALIZED (SELECT listing_id, property_type, district, city, {', '.join(KMEANS_FEATURES)}, CAST({nearest} AS INTEGER) AS cluster "
               f"FROM (SELECT *, {distances} FROM scored, step{steps}))")
    return ", ".join(out)
