"""The queries against their SQL twins, on rows that the given tables lack."""

import pytest

from homestat.llm.oracles import ORACLES
from homestat.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql_on_awkward_rows(spark, corpus, plain_corpus, sql, name):
    root = plain_corpus if name.startswith("op9") else corpus  # the SQL of op9 takes ids as unique
    df = QUERIES[name](spark, root)
    columns, want = sql(root, ORACLES[name])
    assert sorted(columns) == sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, corpus, tmp_path, name):
    for table in ("documents", "benchmark", "pages", "conversations", "embeddings"):
        spark.read.parquet(f"{corpus}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = QUERIES[name](spark, str(tmp_path)).collect()
    assert [r.conv_id for r in left] == ([-7] if name.startswith("op6") else []) if name.startswith("op6") else left == []
