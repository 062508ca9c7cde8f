import random

from fixture import prose
from homestat.llm import toxicity as X


def edits(word):
    letters = "abcdefghijklmnopqrstuvwxyz0"
    for i in range(1, len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1:]
            for c in letters:
                yield word[:i] + c + word[i + 1:]


def test_automaton_finds_every_single_edit():
    terms = {"idiot": 5.0, "worthless": 4.0, "scum": 4.0, "mor*": 2.0, "weak": 1.0}
    machine = X.Automaton(terms, 5, 3.0)
    for term in ("idiot", "worthless"):
        near = set(edits(term)) - {term}
        assert machine.match(term) == (term, 0)
        assert all(machine.match(w) == (term, 1) for w in near)
    assert machine.match("morning") == ("mor*", 0)
    for word in ("", "scun", "xidiot", "ddiot", "iddoot", "mo", "idio t"[:4] + "ss"):
        assert machine.match(word) is None


def test_quoted_finds_count_less():
    scorer = X.Scorer({"idiot": 5.0}, X.Training())
    plain, quoted, reported = (next(scorer.rows(X.pa.array([t]))) for t in (
        "you are an idiot my friend", 'one wrote "idiot" on it', "they called him idiot once"))
    assert plain[0] == 5.0 and quoted[0] == reported[0] == 1.0 and plain[4] == 5.0


def corpus(own, n):
    rows = []
    for i in range(n):
        words = prose(own, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for w in own.sample(["blockhead", "nitwit", "scoundrel"], 2):
                words.insert(own.randrange(60), w)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_and_edge_rows(spark, tmp_path):
    rows = corpus(random.Random(5), 400)
    docs = [(i, t) for i, t, _ in rows] + [(9001, "such a blockheed and a blockhead " + prose(random.Random(1), 40)), (9002, None), (9003, ""), (None, "x"), (7, rows[7][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, y) for i, _, y in rows] + [(None, None, 1), (5000, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = X.op7(spark, str(tmp_path)).collect()
    assert len(out) == len(docs)
    truth = {i: y for i, _, y in rows}
    test = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(test) > 50 and all(r.predicted == truth[r.doc_id] and 0 <= r.score <= 1 for r in test)
    assert all(r.held_out == X.held_out(r.doc_id) for r in out if r.doc_id is not None)
    by_id = {r.doc_id: r for r in out}
    assert by_id[9001].predicted == 1 and by_id[9002].score == by_id[9003].score < 0.5


def test_labels_of_held_out_rows_are_not_used(spark, tmp_path):
    rows = corpus(random.Random(6), 200)
    spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    scores = []
    for k, flip in enumerate((False, True)):
        root = tmp_path / str(k)
        labels = [(i, 1, 1 - y if flip and X.held_out(i) else y) for i, _, y in rows]
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        found = X.learn(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet"))
        scores.append((found.weights, found.misspelled, found.model.round(9).tolist()))
    assert scores[0] == scores[1]
