"""The pipeline against a brute-force run of its stages on a small corpus."""

import numpy as np
from fixture import write
from test_decontam import brute as contamination
from test_linededup import brute as deduped
from test_neardup import brute as near

import corpus_pipeline
from homestat.llm import packing, quality


def test_run_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer
    root = write(str(tmp_path))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    judged = [(i, quality.measure(None if t is None else t.encode())) for i, t in docs]
    docs = [(i, m[-1].decode()) for i, m in judged if m[-2]]
    docs = [(i, kept) for i, _, _, kept in deduped(docs)]
    gone = {i for i, _, _, kept in near(docs) if not kept}
    docs = [(i, t) for i, t in docs if i not in gone]
    left = []
    for i, t in docs:
        n, hit, _ = contamination(t, items)
        if not (hit and 20 * hit >= n):
            left.append((i, t))
    plain = Tokenizer.from_file(packing.vocabulary_path())
    want = []
    for i, t in left:
        ids = plain.encode(t, add_special_tokens=False).ids + [packing.END_ID]
        want += [(i, s, len(ids[s:s + 2048]), packing.zlib.crc32(np.array(ids[s:s + 2048], "<u4").tobytes()), len(ids)) for s in range(0, len(ids), 2048)]
    out = corpus_pipeline.run(spark, root).collect()
    assert sorted([(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out], key=repr) == sorted(want, key=repr)
    assert len(want) > 20


def test_stages_keep_the_columns_of_documents(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, corpus)
        assert out.dtypes == docs.dtypes
