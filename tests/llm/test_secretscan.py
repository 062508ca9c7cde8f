import re

from homestat.llm import secretscan as S

BRUTE = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}


def brute(text):
    order = list(BRUTE)
    found = [(m.start(), order.index(k), k, m.end()) for k, (p, g, n) in BRUTE.items() for m in p.finditer(text or "") if len(m[g]) >= n]
    return sorted(found)


def test_base_spans_match_brute_force(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").select("doc_id", "text")
    rows = S.scan(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert [tuple(s) for s in r.spans if s.rank < 3] == brute(r.text)
    kinds = {s.kind for r in rows for s in r.spans}
    assert kinds == {"assign", "access", "hex", "github", "bearer", "pem", "urlauth"}


def test_only_unseen_pairs_are_scanned(spark):
    ledger = S.Ledger(spark)
    first = spark.createDataFrame([("a", 1, "token = abcdefgh1"), ("b", 1, "token = abcdefgh1"), ("c", 1, None)], "path string, version int, text string")
    assert [len(r.spans) for r in S.scan(first, ledger, rules=S.BASE).orderBy("path").collect()] == [1, 1, 0]
    assert ledger.rows().count() == 2  # two blobs: the copies are one
    S.scan(first, ledger, rules=S.BASE).collect()
    assert ledger.rows().count() == 2
    later = first.union(spark.createDataFrame([("a", 2, "ghp_" + "x" * 36)], first.schema))
    out = {(r.path, r.version): [s.kind for s in r.spans] for r in S.scan(later, ledger).collect()}
    assert out == {("a", 1): ["assign"], ("b", 1): ["assign"], ("c", 1): [], ("a", 2): ["github"]}
    scanned = [sorted(r.scanned) for r in ledger.rows().collect()]
    extra = sorted(r.key for r in S.EXTRA)
    base = sorted(r.key for r in S.BASE)
    assert sorted(scanned) == sorted([base, base, extra, extra, sorted(base + extra)])


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "AKIA" + "A" * 20, "x")], "_blob long, text string, spans string")
    out = S.scan(docs)
    assert out.columns == ["_blob", "text", "spans", "spans_"]
    assert [tuple(s) for s in out.first().spans_] == [(0, 1, "access", 24)]


def test_bearer_in_any_casing(spark):
    texts = [f"{w} {'a1B2' * 6}" for w in ("Bearer", "BEARER", "BeArEr", "BEArer", "bEaReR", "bearer", "bearr")]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in S.scan(docs).collect()}
    rank = [r.kind for r in S.RULES].index("bearer")
    assert got == {i: [] if texts[i].startswith("bearr") else [(0, rank, "bearer", 31)] for i in range(len(texts))}


def test_long_texts_take_linear_time(spark):
    import time
    hexes = " ".join(f"{i:032x}" for i in range(100_000))
    texts = [hexes, "a" * 1_000_000, "x" * 500_000 + "://me:pw@host " + "y" * 500_000, "a://" * 100_000, "token=abcdefgh " * 20_000, None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    start = time.time()
    got = {r.doc_id: (r.n, r.last) for r in S.scan(docs).select(
        "doc_id", S.F.size("spans").alias("n"), S.F.try_element_at("spans", S.F.lit(-1)).alias("last")).collect()}
    assert time.time() - start < 60
    assert got[0][0] == 100_000 and tuple(got[0][1]) == (33 * 99_999, 2, "hex", 33 * 99_999 + 32)
    assert got[1][0] == 1 and [tuple(got[2][1])] == [(0, 8, "urlauth", 500_009)] and got[4][0] == 20_000 and got[5][0] == 0 and got[3][0] == 0


def test_second_ingest_moves_no_texts(spark):
    ledger = S.Ledger(spark)
    docs = spark.createDataFrame([(i, f"token = abcdefgh{i}" + " word" * 2000) for i in range(40)], "doc_id long, text string")
    want = sorted(tuple(map(tuple, r.spans)) for r in S.scan(docs, ledger).collect())
    ledger.ingest(docs)
    assert ledger.rows().count() == 40
    assert sorted(tuple(map(tuple, r.spans)) for r in S.scan(docs, ledger).collect()) == want
