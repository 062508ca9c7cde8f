import random
import re
from collections import Counter

import pytest
from homestat.llm import phrases as M


def brute(rows, least=M.LEAST, k=M.K):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        c = f.setdefault(lang, Counter())
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                c.update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and p in [q[i:i + len(p)] for i in range(len(q) - len(p) + 1)] and 100 * b >= 50 * a for q, b in candidates.items()):
                continue
            cuts = [(10**6 * a * a // (c[p[:j]] * c[p[j:]]), j) for j in range(1, len(p))]
            s, j = min(cuts)
            rows.append((-s, -a, " ".join(p).encode(), c[p[:j]], c[p[j:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:k])]
    return sorted(out)


def corpus():
    own = random.Random(8)
    words = [f"w{i}" for i in range(12)] + ["The", "of", "É", "é", "漢字", "\x1c", "a-b", "x\x85y"]
    rows = []
    for _ in range(400):
        picks = own.choices(words, weights=[1] * 12 + [30, 20] + [2] * 6, k=own.randint(0, 40))
        text = "".join(w + own.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ";", "!"]) for w in picks)
        rows.append((own.choice(["en", "en", "en", "de", None, "und", ""]), text + own.choice(["", "new york city", "new york"])))
    return rows + [("en", None), ("en", ""), ("fr", "one two"), (None, None), ("en", "the the the the " * 50), rows[0], rows[0]]


def result(spark, rows, **how):
    df = spark.createDataFrame([(lang, t, 1, "x") for lang, t in rows], "lang string, text string, rank int, w1 string").repartition(5)
    return sorted(tuple(r) for r in M.collocations(df, **how).collect())


@pytest.mark.parametrize("slice_bytes,slice_words,entries", [(8_000_000, 200_000, 1_000_000), (2000, 40, 100), (2000, 300, 1), (8_000_000, 40, 1)])
def test_matches_brute_force(spark, monkeypatch, slice_bytes, slice_words, entries):
    monkeypatch.setattr(M, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(M, "BUCKET_WORDS", slice_words)
    monkeypatch.setattr(M, "MERGE_ENTRIES", entries)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        rows = corpus()
        got = result(spark, rows)
        assert got == brute(rows) and len(got) > 100
        assert result(spark, rows, least=2, k=30) == brute(rows, 2, 30)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)


def test_products_beyond_64_bits_are_exact(spark):
    rows = [(10**15 + 7, 10**15 + 9, 10**15 + 8), (3 * 10**12, 3 * 10**12, 3 * 10**12 + 1)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r.s for r in df.select(M.score("a", "l", "r").alias("s")).collect()]
    assert got == [10**6 * a * a // (x * y) for a, x, y in rows]
