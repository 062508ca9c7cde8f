import random
import zlib
from collections import Counter

import numpy as np
import pytest

from homestat.llm import packing as P

pytest.importorskip("public_tokenizers")


def test_shortest_pack_first_places_every_length_once():
    own = random.Random(2)
    for _ in range(200):
        histogram = {own.randint(1, 64): own.randint(1, 40) for _ in range(own.randint(0, 20))}
        patterns = P.shortest_pack_first(histogram, 64)
        placed = Counter()
        for count, lengths in patterns:
            assert count > 0 and 0 < sum(lengths) <= 64
            for length in lengths:
                placed[length] += count
        assert placed == histogram


def test_token_ids_equal_the_tokenizer(corpus, spark):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(P.vocabulary_path())
    texts = [r.text for r in spark.read.parquet(f"{corpus}/documents.parquet").collect()]
    texts += ["It's don't 'S '' a.b,c 3.14!!", "x<|endoftext|>y <|ENDOFTEXT|>", "e\u0301te\u0301, \u0301a \ufb01 \u01c5 \u0149", "it'lL we'RE. cafe\u0301!"]
    own = P.tokenizer(P.vocabulary_path())
    got = list(own.texts(P.pa.array(texts, P.pa.string())))
    for t, raw in zip(texts, got):
        assert np.frombuffer(raw, "<u4").tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_token_ids_equal_the_tokenizer_on_any_letters():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(P.vocabulary_path())
    own = P.tokenizer(P.vocabulary_path())
    rng = random.Random(5)
    letters = [c for c in map(chr, range(0x80, 0x20000)) if c.isalpha()]
    # every letter alone and before a mark; then words of letters, marks and blanks
    texts = ["K\u0130\u015e\u0130. \u0130STANBUL'DAK\u0130, EV\u0130"] + [" ".join(f"{c}. a{c}, {c}" for c in letters[i:i + 200]) for i in range(0, len(letters), 200)]
    texts += ["iI\u0338\u0307", "I\u093c\u0307 K\u0130\u0307."]
    few = "\u0130\u0130\u0131iI\u015e\u0958\u0915\u093c\u0301\u0307\u0338e\u00e9\u03a3\u03c3\u1e9e\ufb01\ufb4e"
    for _ in range(6000):
        kinds = rng.choice([few, few + "aB", rng.sample(letters, 12)])
        texts.append("".join(rng.choice([rng.choice(kinds), rng.choice(kinds), rng.choice(" .,!'=<>-\"9\t\u00a0")]) for _ in range(rng.randint(1, 25))))
    for t, raw in zip(texts, own.texts(P.pa.array(texts, P.pa.string()))):
        assert np.frombuffer(raw, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_pieces_cover_documents_and_sequences_are_gapless(corpus, spark):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(P.vocabulary_path())
    docs = spark.read.parquet(f"{corpus}/documents.parquet").select("doc_id", "text")
    rows = P.pack(docs, P.vocabulary_path(), size=256, with_ids=True).collect()
    want = Counter()
    for r in docs.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [P.END_ID]
        for start in range(0, len(ids), 256):
            part = ids[start:start + 256]
            want[r.doc_id, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids), tuple(part)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, tuple(r.ids)) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert sum(r.length for r in rows) > 0.95 * 256 * (len(sequences) - 1)


def test_hot_length_gets_distinct_ranks(spark):
    docs = spark.createDataFrame([(i, "same text") for i in range(500)] + [(None, None)] * 3, "doc_id long, text string")
    rows = P.pack(docs, P.vocabulary_path(), size=64).collect()
    assert len(rows) == 503 and len({(r.sequence_id, r.offset) for r in rows}) == 503
