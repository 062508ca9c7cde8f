import random

import numpy as np
from fixture import prose
from homestat.llm import neardup as N
from homestat.llm.graph import components


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and i is not None and j is not None and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return sorted([(i, len(x), None if i is None else find(i), i is None or find(i) == i) for i, x in sets], key=repr)


def variants():
    own = random.Random(11)
    rows, n = [], 0
    for _ in range(12):  # chains of edits: ends are alike only through the middle
        words = prose(own, 150).split()
        for _ in range(own.randint(1, 8)):
            rows.append((n, " ".join(words)))
            n += 1
            for _ in range(own.randint(0, 3)):
                words[own.randrange(len(words))] = prose(own, 1)
    own.shuffle(rows)
    rows += [(500, None), (501, ""), (502, " \n"), (503, "A b"), (504, "a\tB"), (505, "a b c d e"), (506, "A B C D E"), (507, "b a"),
             (None, rows[0][1]), (None, None), (503, rows[3][1]), (600, rows[5][1]), (600, rows[5][1])]
    return rows


def test_matches_brute_force(spark):
    rows = variants()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted([tuple(r) for r in N.near_duplicates(docs).collect()], key=repr)
    assert got == brute(rows)


def test_each_text_of_a_shared_id_keeps_its_links(spark):
    own = random.Random(12)
    rows = []
    for k in range(6):  # the id is the smallest of all its classes; near copies of each text, at two distances
        texts = [prose(own, 120) for _ in range(3)]
        rows += [(10 * k, t) for t in texts]
        for j, t in enumerate(texts):
            words = t.split()
            rows += [(10 * k + 2 * j + 1, " ".join(words[:-1])), (10 * k + 2 * j + 2, " ".join(words[3:]))]
    own.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted([tuple(r) for r in N.near_duplicates(docs).collect()], key=repr)
    assert got == brute(rows) and {r[2] for r in got} == {0, 10, 20, 30, 40, 50}
    assert {r.doc_id for r in N.keep_one(docs).collect()} == {0, 10, 20, 30, 40, 50}


def test_blocks_of_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 300)
    rows = variants()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = N.stored(N.signatures(docs, "doc_id", "text").where("set_key is not null").dropDuplicates(["set_key"]), "classes")
    # all classes in one bucket, each a part of its own: the blocks alone must find all components
    members = classes.select(N.F.lit(1).alias("key"), "doc", N.F.col("doc").alias("part"))
    sets = N.full_sets(docs, classes.select("doc", "set_key"), "doc_id", "text").dropDuplicates(["doc"])
    pairs = N.block_links(members, classes, sets).collect()
    own = [(r.doc, next(t for i, t in rows if i == r.doc and N.set_key(next(N.shingle_sets(N.pa.array([t])))) == bytes(r.set_key)))
           for r in classes.select("doc", "set_key").collect()]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {i: got.get(i, i) for i, _ in own} == {i: root for i, _, root, _ in brute(own)}
    assert len(pairs) < 3 * len(own)


def test_keep_one_keeps_columns(spark):
    rows = [(1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (None, "a b c d e f", "z"), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    assert sorted([tuple(r) for r in N.keep_one(docs).collect()], key=repr) == sorted([rows[0], rows[2], rows[3]], key=repr)


def test_sequential_test_keeps_similar_pairs_and_prunes_the_rest():
    own = np.random.default_rng(1)

    def alive(j, n):
        same = own.random((n, N.CHECKS)) < j
        left = own.integers(0, 256, (n, N.CHECKS), np.uint8)
        return len(N.not_pruned(left, np.where(same, left, own.integers(0, 256, (n, N.CHECKS), np.uint8)))) / n

    assert alive(0.75, 20_000) > 0.999 and alive(1.0, 100) == 1.0
    assert alive(0.1, 5_000) < 0.01 and alive(0.3, 5_000) < 0.2


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == set(range(301)) | set(range(1000, 1200))
    assert all(v == (0 if k < 1000 else 1000) for k, v in got.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
