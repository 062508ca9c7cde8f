import random

from homestat.llm import decontam


def brute(text, items):
    words = decontam.words_of((text or "").encode())
    hit, found = set(), set()
    for name, t in items:
        own = decontam.words_of((t or "").encode())
        k = min(13, len(own))
        for i in range(len(own) - k + 1 if own else 0):
            for j in range(len(words) - k + 1):
                if words[j:j + k] == own[i:i + k]:
                    hit.update(range(j, j + k))
                    found.add(str(name))
    return len(words), len(hit), sorted(found)


def test_blocks_give_the_same_as_brute_force(spark):
    own = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4)]
    items = [(i, " ".join(own.choice(vocabulary) for _ in range(own.randint(0, 16)))) for i in range(12)]
    texts = [" ".join(own.choice(vocabulary) for _ in range(own.randint(0, 300))) for _ in range(20)] + [None, "", items[0][1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "spans long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {i: brute(t, items) for i, t in enumerate(texts)}
    for limit in (decontam.BLOCK_WINDOWS, 5):
        found = decontam.scan(docs, bench, limit=limit)
        assert found.columns[2:] == ["n_words", "spans_", "items"]
        got = {r[0]: (r[2], sum(s.end - s.first for s in r[3]), r[4]) for r in found.collect()}
        assert got == want


def test_removing_spans_and_documents(spark):
    item = " ".join(f"word{i}" for i in range(15))
    rows = [(1, f"Before, {item.upper()}! after it."), (2, "clean text"), (3, item + " " + "x " * 1000), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontam.decontaminate(docs, bench).collect()) == [2, 3, 4]
    cut = {r.doc_id: r.text for r in decontam.decontaminate(docs, bench, remove="spans").collect()}
    assert cut == {1: "Before, ! after it.", 2: "clean text", 3: rows[2][1], 4: None}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(docs, none).count() == 4
