"""What queries leave on disk while they run: shuffle files, written tables, raw text."""

import os
import time

import pytest
from pyspark.sql import functions as F

from homestat import session as S
from homestat.plans import queries as Q
from homestat.schema import CLEAN_COLUMNS, CLEAN_SCHEMA, RAW_COLUMNS
from homestat.sources import csv_records as R
from homestat.sources import files as SF
from homestat.sources import sinks as SK
from homestat.streaming import published as PB


def shuffle_blocks(spark):
    """The shuffle files of the session that have been written; ids only grow."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in (blocks.apply(i).toString() for i in range(blocks.size())) if name.startswith("shuffle_")}


def scratch_names(spark):
    return set(PB.Folder(spark, f"{S.checkpoint_root(spark)}/homestat").names())


def listings(spark, n):
    rows = []
    for i in range(n):
        row = dict.fromkeys(CLEAN_COLUMNS) | {"listing_id": f"{i}-{i % 3}", "title": f"t{i}", "price_billion": float(i % 40 + 1), "area_m2": 50.0, "city": "EUROPE",
                                              "district": f"d{i % 4}", "property_type": f"p{i % 3}", "scraped_at": "2026-01-01T00:00:00", "bedrooms": i % 9, "floors": i % 5}
        rows.append(tuple(row[c] for c in CLEAN_COLUMNS))
    return spark.createDataFrame(rows, CLEAN_SCHEMA)


def test_a_table_written_for_a_block_leaves_nothing(spark):
    blocks, names = shuffle_blocks(spark), scratch_names(spark)
    with S.materialized(spark.range(5000).repartition(5, "id"), "some") as table:
        until = time.time() + 20  # removed in the background
        while shuffle_blocks(spark) - blocks and time.time() < until:
            time.sleep(0.2)
        assert not shuffle_blocks(spark) - blocks
        assert table.count() == 5000 and all(".zstd." in f for f in table.inputFiles())
        assert len(scratch_names(spark) - names) == 1
    assert scratch_names(spark) <= names
    with pytest.raises(RuntimeError), S.materialized(spark.range(5), "some"):
        raise RuntimeError("lost")
    assert scratch_names(spark) <= names


@pytest.mark.parametrize("before", [None, "false"])
def test_the_setting_of_shuffle_files_is_put_back(spark, before):
    if before is not None:
        spark.conf.set(S.SHUFFLE_CLEANUP, before)
    was = spark.conf.get(S.SHUFFLE_CLEANUP, None)
    with pytest.raises(RuntimeError), S.shuffles_dropped(spark):
        assert spark.conf.get(S.SHUFFLE_CLEANUP) == "true"
        raise RuntimeError("lost")
    assert spark.conf.get(S.SHUFFLE_CLEANUP, None) == was
    spark.conf.unset(S.SHUFFLE_CLEANUP)


def test_raw_csv_is_packed_in_files_of_bounded_length(spark, monkeypatch):
    r = listings(spark, 900).select(*RAW_COLUMNS)
    monkeypatch.setattr(Q, "raw", lambda spark, sf: r)
    monkeypatch.setattr(Q, "CSV_RECORDS", 100)
    names, written, kept = scratch_names(spark), [], SK.write_csv
    monkeypatch.setattr(SK, "write_csv", lambda df, path, **how: (written.append(path), kept(df, path, **how))[1])
    got = Q.src_csv_raw(spark, "/nowhere")
    want = Q.awkward(r).withColumn("direction", F.when(F.col("floors") != 1, F.col("direction")))
    assert got.count() == 900 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    files = [f"{path}/{n}" for path in written for n in PB.Folder(spark, path).names() if n.startswith("part-")]
    assert len(files) >= 9 and all(f.endswith(".csv.gz") for f in files)
    assert {n.rsplit("-", 1)[0] for n in scratch_names(spark) - names} == {"raw_csv", "raw_csv_reversed", "splits", "parts"}


def test_packed_files_are_read_as_plain_ones(spark, tmp_dir):
    names = ["listing_id", "title"]
    rows = [(f"id-{i}", ["two\nlines", 'say "hi"', "a,b", " pad ", "\n\n"][i % 5] * (i % 4 + 1)) for i in range(400)]
    df = spark.createDataFrame(rows, names).repartition(3, "listing_id")
    SK.write_csv(df, f"{tmp_dir}/plain")
    SK.write_csv(df, f"{tmp_dir}/packed", compression="gzip", records_per_file=50)
    assert len([n for n in os.listdir(f"{tmp_dir}/packed") if n.endswith(".csv.gz")]) >= 8
    for kind in ("plain", "packed"):
        assert sorted(map(tuple, SF.read_raw_csv(spark, f"{tmp_dir}/{kind}").select(*names).collect())) == sorted(rows)


def test_no_line_is_shuffled_for_its_split(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('a,b\n1,x\n2,"y\nz"\n')
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = R.read_records(spark, tmp_dir, SF.CSV_OPTIONS)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted((r.a, r.b) for r in df.collect()) == [("1", "x"), ("2", "y\nz")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_steps_dealt_in_passes_are_one_file_each_and_are_deleted(spark, monkeypatch):
    c = listings(spark, 600)
    monkeypatch.setattr(Q, "clean", lambda spark, sf: c)
    monkeypatch.setattr(Q, "STEP_MESSAGES", 20)
    sent = Q.messages(c).withColumn("n", F.conv(F.substring(F.md5("listing_id"), 1, 8), 16, 10).cast("long"))
    steps = -(-sent.count() // 20)
    assert steps // Q.LEAST_STEPS > 1  # several passes
    names, files, read = scratch_names(spark), [], Q.ST.read_envelope_files

    def counted(spark, path, **how):
        files.extend(spark.read.parquet(path).inputFiles())
        return read(spark, path, **how)

    monkeypatch.setattr(Q.ST, "read_envelope_files", counted)
    out = Q.stepwise_stream(spark, "/nowhere", Q.STREAM_FILES)
    arrived = {r.n % steps for r in sent.collect()}
    assert len(files) == len(arrived) and {f.split("step=")[1].split("/")[0] for f in files} == {str(k) for k in arrived}
    committed = spark.read.parquet(*[r.path for r in PB.committed_files(spark, out).collect()])
    ids = lambda df: sorted(r.listing_id for r in df.select("listing_id").collect())
    assert ids(committed) == ids(sent)
    new = scratch_names(spark) - names
    assert {n.rsplit("-", 1)[0] for n in new} == {"steps"}  # the written messages are gone
    assert sorted(n for n in PB.Folder(spark, out.removesuffix("/out")).names() if not n.startswith(".")) == ["ckpt", "out"]
