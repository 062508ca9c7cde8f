from homestat.llm import quality


def test_line_rules():
    verdict = quality.line_verdict
    assert verdict(b"") == verdict(b"  \t") == ""
    assert verdict(b"A short sentence.") == verdict('Quoted “end.”'.encode()[:-3] + b'"') == ""
    assert verdict(b"no end mark") == "punctuation"
    assert verdict(b"w " * 30) == ""
    assert verdict(b"Log In") == verdict(b"Home | About | Login.") == "navigation"
    assert verdict(b"Powered by something.") == "boilerplate"
    assert verdict(b"a$$ b** c## word.") == verdict(b"AU!! ER!! DIE??") == "symbols"


def test_repeated_words():
    assert quality.repeated_words([b"a", b"b"]) == 0
    assert quality.repeated_words(b"a b c a b c".split()) == 6
    assert quality.repeated_words(b"a a a a".split()) == 4
    assert quality.repeated_words(b"a b c d e a b c".split()) == 6


def test_clean_keeps_columns_and_drops_lines(spark):
    good = " ".join(f"Word{i} passes." for i in range(40))
    rows = [(1, good + "\nMenu\nno end mark", 0, True, "x"), (2, None, 0, False, None), (3, "too short.", 0, None, "y"), (None, good, 7, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, kept boolean, _q_kept string")
    out = {r.doc_id: r for r in quality.clean(docs).collect()}
    assert set(out) == {1, None} and out[1].asDict().keys() == set(docs.columns)
    assert out[1].text == good and out[1].n_chars == len(good) and out[1].kept is True and out[1]._q_kept == "x"


def test_document_that_loses_most_lines_is_rejected(spark):
    bad = "\n".join(f"line{i} has{i} no{i} end{i}" for i in range(20))
    docs = spark.createDataFrame([(1, bad)], "doc_id long, text string")
    row = quality.judge(docs).first()
    assert not row.base_failed and not row.kept and row.n_bad_lines == 20


def test_a_worker_gets_texts_in_slices(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from homestat.llm import common
    name, docs = "spark.sql.execution.arrow.maxRecordsPerBatch", 3000
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        df = spark.range(0, docs, 1, 1).select("id", F.repeat(F.lit("x"), 2000).alias("text"))
        got = common.extend(df, [("held", T.LongType())], lambda texts: [[sum(map(len, texts))] * len(texts)]).select("id", "held").collect()
    finally:
        spark.conf.set(name, before)
    assert sorted(r["id"] for r in got) == list(range(docs))
    assert max(r["held"] for r in got) <= common.SLICE_BYTES
