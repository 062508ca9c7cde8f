import math
import random

import numpy as np
import pytest
from homestat.llm import topk as M


def brute(rows, k=M.K, every=100):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * x) for x in v]

    ready = [(i, whole(v)) for i, v in rows]
    ready = [(i, v) for i, v in ready if v is not None]
    out = []
    for at, (q, v) in enumerate(ready):
        if q is None or q % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for b, (i, w) in enumerate(ready) if b != at]
        out += [(q, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def result(spark, rows, k=M.K, every=100):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score long, rank string" if len(rows[0]) == 4 else "vec_id long, embedding array<double>")
    return sorted([tuple(r) for r in M.top_k(df, M.F.col("vec_id") % every == 0, k).collect()], key=repr)


def clustered(n, width, seed=3):
    own = np.random.default_rng(seed)
    centres = own.normal(size=(8, width)) / width ** 0.5
    return [(i, (centres[i % 8] + own.normal(size=width) / (3 * width ** 0.5)).tolist()) for i in range(n)]


@pytest.mark.parametrize("shard", [64, 4096])
def test_matches_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(M, "SHARD_ROWS", shard)
    rows = clustered(900, 16)
    assert result(spark, rows, every=10) == brute(rows, every=10)


def test_ties_repeated_rows_and_unusable_vectors(spark):
    own = random.Random(5)
    rows = [(i, [own.randint(-1, 1) / 4 for _ in range(4)]) for i in range(120)]
    rows += [(100, [0.25] * 4), (100, [0.25] * 4), (7, [0.25] * 4), (None, [0.25] * 4), (None, [0.25] * 4), (200, None), (300, [0.1, None]), (400, [float("nan")] * 4),
             (500, [float("inf"), 0.0, 0.0, 0.0]), (600, []), (700, [0.5]), (800, [0.1] * 6)]
    own.shuffle(rows)
    assert result(spark, rows) == brute(rows)
    assert result(spark, [(i, v, 1, "x") for i, v in rows], k=3) == brute(rows, 3)


def test_several_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_COMPONENTS", 60)
    rows = clustered(200, 8)
    assert result(spark, rows, every=10) == brute(rows, every=10)


def test_large_components_stay_exact(spark):
    own = random.Random(6)
    rows = [(i, [own.uniform(-2e5, 2e5) for _ in range(5)]) for i in range(130)]
    assert result(spark, rows) == brute(rows)
    rows += [(i + 1000, [v * 4 for v in x]) for i, x in rows[:40]]
    got = result(spark, rows)
    assert got == brute(rows) and max(abs(r[3]) for r in got) > 1 << 53


def test_fewer_rows_than_k(spark):
    rows = [(0, [0.5]), (1, [0.25]), (100, [0.125])]
    assert result(spark, rows) == brute(rows) and len(brute(rows)) == 4


def test_lists_of_low_bounds_are_only_probed():
    own = np.random.default_rng(2)
    vectors = np.floor(1024 * own.normal(size=(500, 6)) * [1, 1, 0.01, 0.01, 0.01, 0.01])
    best = M.Best(np.array([2e6]), 3)
    M.search(best, vectors[:1], np.array([0]), vectors, np.arange(500), np.zeros(500, bool), np.arange(500))
    scores = vectors @ vectors[0]
    want = sorted([s for i, s in enumerate(scores) if i and s >= 2e6], reverse=True)[:3]
    assert (best.held[1].tolist() if best.held else []) == want
