from homestat.llm import linededup as D

LINE = "This line stands in many documents."


def brute(rows):
    held = {}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(D.BLANKS))
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), set()).add(D.NO_ID if i is None else i)
    out = []
    for i, t in rows:
        own = D.NO_ID if i is None else i
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= 3 and own < max(held[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_any_batching_gives_the_brute_force_result(spark):
    rows = [(i, f"Own line of number {i}, long enough.\n{LINE.upper() if i % 2 else LINE}\n\t{LINE} \n") for i in range(12)]
    rows += [(3, "another text\n" + LINE), (None, LINE), (None, None), (20, ""), (21, "\n"), (21, "\n"), (22, f"Pair line that only two hold.\n{LINE}"), (23, "Pair line that only two hold.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches, fanout in ((1, 2), (3, 2), (5, 3)):
        out = D.dedup_lines(docs, batches=batches, fanout=fanout)
        assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()], key=repr) == brute(rows)


def batch(spark, ids, text):
    return D.known_lines(spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string"))


NEW = "A line that nobody had before it."


def test_runs_hold_each_key_once_and_are_levelled(spark):
    from homestat.llm.common import scratch
    runs = D.LineRuns(spark, scratch(spark, "runs"), fanout=2, buckets=4)
    sizes = lambda levels: [[runs.table(r).count() for r in level] for level in levels]
    runs.ingest(batch(spark, [1, 2], LINE))
    assert sizes(runs.levels) == [[1]] and sizes(runs.updates) == []
    runs.ingest(batch(spark, [3], LINE + "\n" + NEW))
    # the unseen key got into a run, the seen one into the updates; the full level was merged
    assert sizes(runs.levels) == [[], [2]] and sizes(runs.updates) == [[1]]
    runs.ingest(batch(spark, [0], NEW))
    assert sizes(runs.levels) == [[0], [2]] and sizes(runs.updates) == [[], [2]]
    assert sorted((r.docs, r.last_doc) for r in runs.records().collect()) == [(2, 3), (3, 3)]
    runs.ingest(batch(spark, [5], LINE))
    assert [r.last_doc for r in runs.repeated().collect()] == [5]
    runs.close()


def test_state_goes_on_in_a_later_session(spark):
    from homestat.llm.common import child_names, scratch
    root = scratch(spark, "runs")
    first = D.LineRuns.open(spark, root, fanout=2, buckets=4)
    assert first.ingest(batch(spark, [1, 2], LINE), "a")
    first.close()
    later = D.LineRuns.open(spark.newSession(), root)
    assert (later.buckets, later.fanout, later.batches) == (4, 2, ["a"])
    assert not later.ingest(batch(spark, [1, 2], LINE), "a")  # handed in again
    assert later.ingest(batch(spark, [7], LINE), "b")
    assert [(r.docs, r.last_doc) for r in later.records().collect()] == [(3, 7)]
    # only runs that the manifest names are left
    named = {r for level in later.levels + later.updates for r in level}
    assert {n for n in child_names(spark, root) if not n.startswith(("manifest-", "."))} == named
    later.close()


def test_runs_are_neither_moved_nor_sorted_again(spark):
    from homestat.llm.common import scratch
    runs = D.LineRuns(spark, scratch(spark, "runs"), fanout=3, buckets=4)
    runs.ingest(batch(spark, [1, 2], LINE))
    runs.ingest(batch(spark, [3], LINE + "\n" + NEW))
    with D.sorted_buckets(spark):
        new = runs._write(D.run_records(batch(spark, [4], LINE + "\n" + NEW)), "batch")
        plan = runs.unseen(runs.table(new))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and " Sort " not in plan
    runs.close()
    runs._forget([new])


def test_an_empty_batch_and_an_empty_start(spark):
    from homestat.llm.common import scratch
    runs = D.LineRuns(spark, scratch(spark, "runs"), buckets=2)
    runs.ingest(batch(spark, [1], ""))
    runs.ingest(batch(spark, [2, 3, 4], LINE))
    assert [r.last_doc for r in runs.repeated().collect()] == [4]
    runs.close()


def test_clean_keeps_columns(spark):
    docs = spark.createDataFrame([(i, LINE + "\nx", 5, "d") for i in range(3)] + [(9, None, 0, None)], "doc_id long, text string, n_chars long, _drop string")
    out = {r.doc_id: r for r in D.clean(docs).collect()}
    assert out[0].text == "x" and out[0].n_chars == 1 and out[2].text == LINE + "\nx" and out[9].text is None and out[0]._drop == "d"


def test_lines_are_written_as_one_file_a_task(spark, monkeypatch):
    made, keep = [], D.stored
    monkeypatch.setattr(D, "stored", lambda df, name: made.append((name, df.rdd.getNumPartitions(), out := keep(df, name))) or out)
    text = "the same long line of text\nanother long line of text"
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string").repartition(2)
    assert D.dedup_lines(docs).where("n_dropped > 0").count() == 39
    [(tasks, lines)] = [(n, df) for name, n, df in made if name == "lines"]
    assert len(lines.inputFiles()) <= tasks
