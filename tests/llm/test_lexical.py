import math
import random
import re

import numpy as np
import pytest
from fixture import prose
from homestat.llm import lexical as M


def terms(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=M.K):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n, length = len(held), sum(len(w) for _, w in held)
    out = []
    for item, text in items:
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in w for _, w in held) + 1))) for t in set(terms(text))}
        scored = []
        for i, w in held:
            m = 50 + 50 * len(w) * n // length
            score = sum(weight[t] * (10**9 * w.count(t) // (1000 * w.count(t) + 20 * m)) for t in weight if t in w)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus():
    own = random.Random(4)
    docs = [(i, prose(own, own.randint(1, 60))) for i in range(250)]
    docs += [(i + 1000, docs[i % 20][1]) for i in range(60)]  # ties
    docs += [(3, "ba ce di"), (None, "ba ce"), (None, "ba ce"), (900, None), (901, ""), (902, " .,;"), (903, "Ba-ce_DI\tfo É é ba"), (904, prose(own, 4000))]
    own.shuffle(docs)
    items = [(i, prose(own, own.randint(1, 30))) for i in range(12)] + [(5, "ba ce di fo"), (6, None), (7, ""), (8, "nowhere zzz"), (None, "BA, é"), (9, "ba " * 30)]
    return docs, items


@pytest.mark.parametrize("shard,step,k", [(300, 2, 5), (1_000_000, 64, 50), (5000, 8, 50)])
def test_matches_brute_force(spark, monkeypatch, shard, step, k):
    monkeypatch.setattr(M, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(M, "STEP", step)
    docs, items = corpus()
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, terms string")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = sorted([tuple(r) for r in M.search(d, q, k).collect()], key=repr)
    assert got == brute(docs, items, k)


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_TERMS", 40)
    docs, items = corpus()
    got = M.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(docs, items)


def test_reading_stops_before_the_lists_end(monkeypatch):
    monkeypatch.setattr(M, "STEP", 4)
    own = np.random.default_rng(1)
    n = 3000
    batch = M.pa.table({"doc_id": M.pa.array(range(n), M.pa.int64()), "n": M.pa.array(own.integers(5, 500, n)),
                        "terms": M.pa.array([[0, 1, 2]] * n, M.pa.list_(M.pa.int32())),
                        "tf": M.pa.array([[int(x)] * 3 for x in own.integers(1, 40, n)], M.pa.list_(M.pa.int32()))})
    shard = M.Shard.of(batch, np.array([100, 200, 300]), n, n * 250)
    docs, scores, reads = M.best_positions(shard, np.arange(3), np.full(3, -1), 10, 0)
    want = np.sort(np.bincount(shard.owner, weights=shard.impact))[::-1][:10]
    assert sorted(scores.tolist(), reverse=True)[:10] == want.astype(int).tolist()
    assert reads < 3 * n / 20
