import re

from homestat.llm import licensescan as L
from homestat.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(text, index):
    w = words(text)
    places = [(i, label) for phrase, label in L.PHRASES for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    base = sorted({label for _, label in places})
    seen = [x for x in index["words"] if x in w][:L.Matching().lookups]
    votes = {}
    for i, x in enumerate(w):
        for e in index["postings"].get(x, []) if x in seen else []:
            votes[e["t"], i - e["p"]] = votes.get((e["t"], i - e["p"]), 0) + 1
    labels, best = set(), 0.0
    for (t, o), n in votes.items():
        need = index["needs"][t]
        if n >= need["least"] and all(o + p["at"] >= 0 and " ".join(w[o + p["at"]:o + p["at"] + p["n"]]) == p["text"] for p in need["phrases"]):
            labels.add(need["label"])
            best = max(best, n / need["places"])
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(base),
            ",".join(sorted(labels | set(base))), 1.0 if places else best)


def test_matches_brute_force_on_awkward_rows(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").select("doc_id", "text").collect()
    vocabulary = L.template_words(L.TEMPLATES)
    counts = {v: sum(v in words(r.text) for r in docs) for v in vocabulary}
    index = L.index_of(counts)
    want = sorted([(r.doc_id, *brute(r.text, index)) for r in docs], key=repr)
    got = sorted([tuple(r) for r in QUERIES["op3_license_scan"](spark, corpus).collect()], key=repr)
    assert got == want
    assert {"apache-2.0,mit", "gpl,gpl-3.0,reserved"} <= {r[6] for r in got}


def test_clashing_columns_and_repeated_notices(spark):
    text = "Released under the MIT License. " * 500
    docs = spark.createDataFrame([(1, text, "x"), (2, None, None)], "score long, text string, labels string")
    out = L.scan(docs)
    assert out.columns[3:] == ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels_", "score_"]
    rows = {r.score: r for r in out.collect()}
    assert rows[1].labels_ == "mit" and rows[1].score_ == 1.0 and rows[2].labels_ == "" and rows[2].n_words == 0


def phrase_search(text):
    """Labels of templates that stand in the text in full, and of base phrases; no index."""
    w = " " + " ".join(words(text)) + " "
    return ",".join(sorted({t.label for t in L.TEMPLATES if f" {t.text} " in w} | {label for p, label in L.PHRASES if f" {p} " in w}))


def test_bundled_notices_lose_no_label(spark):
    notices = [t.text for t in L.TEMPLATES]
    texts = [" ".join(notices), ". Filler words. ".join(reversed(notices)), " / ".join(notices[1:10]), " ".join(notices[::2] * 40)]
    # common words of the notices, as in the given tables, are not the same as the rarest of a short list
    texts += ["released under the terms of the license 2 0 version public software"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in L.scan(docs).collect()}
    assert rows[0].labels.split(",") == sorted({t.label for t in L.TEMPLATES} | {"cc-by", "gpl"})
    assert [rows[i].labels for i in range(len(texts))] == [phrase_search(t) for t in texts]
    index = L.index_of({v: sum(v in words(t) for t in texts) for v in L.template_words(L.TEMPLATES)})
    assert len(index["words"]) > 24
    capped = {r.doc_id: r.labels for r in L.scan(docs, how=L.Matching(lookups=24)).collect()}
    assert set(capped[0].split(",")) < set(rows[0].labels.split(","))


def test_a_bundle_of_all_notices_equals_the_sql(spark, sql, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from homestat.llm import oracles as O
    notices = [line.split("'")[-2] for line in O.NOTICES.replace("), (", "),\n(").split("\n") if line.count("'") >= 4]
    assert len(notices) >= 15
    texts = ["\n".join(notices), " and ".join(reversed(notices)), notices[0], "nothing here", None]
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": texts}), f"{tmp_path}/documents.parquet")
    columns, want = sql(str(tmp_path), O.OP3)
    found = L.op3(spark, str(tmp_path)).select(columns)
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert len(dict(zip(columns, sorted(want)[0]))["labels"].split(",")) >= 10
