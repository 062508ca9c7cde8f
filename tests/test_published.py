"""Committed files only, atomic snapshots, compaction."""

import pytest
from pyspark.sql import functions as F

from homestat.sources import files as SF
from homestat.schema import CLEAN_COLUMNS, CLEAN_SCHEMA, SPEED_SCHEMA
from homestat.streaming import published as P
from homestat.streaming import speed as ST


def listing(i, price=2.0, district="d"):
    row = {c: None for c in CLEAN_COLUMNS} | {"listing_id": str(i), "title": f"t{i}", "price_billion": price, "area_m2": 50.0,
                                               "district": district, "property_type": "p", "scraped_at": "2026-01-01T00:00:00"}
    return tuple(row[c] for c in CLEAN_COLUMNS)


def arrive(spark, root, ids, price=2.0):
    ST.publish_files(spark.createDataFrame([listing(i, price) for i in ids], CLEAN_SCHEMA).coalesce(1), f"{root}/in/{ids[0]}")


def step(spark, root, ids):
    """One batch of the append stream."""
    arrive(spark, root, ids)
    src = ST.read_envelope_files(spark, f"{root}/in/*")
    ST.start_append(ST.enrich(ST.parse(src)), f"{root}/out", f"{root}/ckpt", trigger=None).awaitTermination()


def test_uncommitted_files_are_not_read(spark, tmp_dir):
    for k in range(4):
        step(spark, tmp_dir, [10 * k, 10 * k + 1])
    rows = SF.read_speed(spark, f"{tmp_dir}/out")
    rows.withColumn("listing_id", F.lit("planted")).write.mode("append").parquet(f"{tmp_dir}/out")
    recent = SF.recent_files(spark, f"{tmp_dir}/out", 2)
    assert sorted(r.listing_id for r in recent.collect()) == ["20", "21", "30", "31"]
    assert P.committed_files(spark, f"{tmp_dir}/out").count() == 4
    assert P.committed_files(spark, tmp_dir) is None


def test_compacted_logs_keep_all_files(spark, tmp_dir):
    for k in range(12):  # the sink compacts its log every ten batches
        step(spark, tmp_dir, [k])
    assert P.committed_files(spark, f"{tmp_dir}/out").count() == 12
    assert sorted(r.listing_id for r in SF.recent_files(spark, f"{tmp_dir}/out", 3).collect()) == ["10", "11", "9"]


def test_compaction_keeps_rows_and_bounds_files(spark, tmp_dir):
    table = P.CompactedStream(spark, f"{tmp_dir}/out", f"{tmp_dir}/compact")
    assert table.compact() == 0 and table.read(SPEED_SCHEMA).collect() == []
    for k in range(6):
        step(spark, tmp_dir, [10 * k, 10 * k + 1, 10 * k + 2])
    want = sorted(str(10 * k + j) for k in range(6) for j in range(3))
    ids = lambda: sorted(r.listing_id for r in table.read(SPEED_SCHEMA).collect())
    assert ids() == want and len(table.files()) == 6
    assert table.compact() == 6
    assert ids() == want and len(table.files()) == 1
    step(spark, tmp_dir, [70])
    SF.read_speed(spark, f"{tmp_dir}/out").write.mode("append").parquet(f"{tmp_dir}/out")  # never committed
    assert ids() == sorted([*want, "70"]) and len(table.files()) == 2
    table.compact()  # the small compacted file is packed again with the new one
    assert ids() == sorted([*want, "70"]) and len(table.files()) == 1
    size = table.listed().where("kind = 'file'").first()["size"]
    table.target = size // 2
    step(spark, tmp_dir, [80])
    table.compact()
    assert ids() == sorted([*want, "70", "80"]) and len(table.files()) == 2
    assert table.compact() == 0
    for k in range(4):
        step(spark, tmp_dir, [100 + k])
    table.run_files = 3
    table.compact()
    table.compact()
    assert ids() == sorted([*want, "70", "80", "100", "101", "102", "103"])


def test_failed_compaction_changes_nothing(spark, tmp_dir, monkeypatch):
    for k in range(3):
        step(spark, tmp_dir, [k])
    table = P.CompactedStream(spark, f"{tmp_dir}/out", f"{tmp_dir}/compact")
    with monkeypatch.context() as m:
        m.setattr(P.Snapshots, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.compact()
    assert len(table.files()) == 3
    table.compact()
    assert sorted(r.listing_id for r in table.read(SPEED_SCHEMA).collect()) == ["0", "1", "2"] and len(table.files()) == 1


def test_bins_are_runs_of_at_least_the_target():
    assert P.bins([("a", 5), ("b", 5), ("c", 1), ("d", 20), ("e", 2)], 10) == [["a", "b"], ["c", "d"], ["e"]]
    assert P.bins([], 10) == []


def test_snapshots_survive_a_failed_write_and_a_replay(spark, tmp_dir, monkeypatch):
    table = P.Snapshots(spark, f"{tmp_dir}/t", keep=2)
    assert table.read() is None
    assert table.write(spark.range(3), 0)
    with monkeypatch.context() as m:  # the attempt dies between its data and its marker
        m.setattr(P.Folder, "create", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.write(spark.range(50), 1)
    assert table.read().count() == 3
    assert table.write(spark.range(7), 1) and table.read().count() == 7
    assert not table.write(spark.range(99), 1) and table.read().count() == 7
    table.write(spark.range(8), 2)
    assert table.versions() == [1, 2] and sorted(P.Folder(spark, f"{tmp_dir}/t").names()) == ["_published", "v-1", "v-2"]


def test_live_aggregate_restarts_after_a_killed_batch(spark, tmp_dir, monkeypatch):
    def run():
        src = ST.read_envelope_files(spark, f"{tmp_dir}/in/*")
        live = ST.live_aggregate(ST.enrich(ST.parse(src)))
        P.start_snapshots(live, f"{tmp_dir}/agg", f"{tmp_dir}/ckpt", trigger=None).awaitTermination()

    table = P.Snapshots(spark, f"{tmp_dir}/agg")
    arrive(spark, tmp_dir, [1, 2])
    run()
    assert [(r.district, r.new_listings, r.avg_price) for r in table.read().collect()] == [("d", 2, 2.0)]
    arrive(spark, tmp_dir, [3], price=5.0)
    with monkeypatch.context() as m:
        m.setattr(P.Folder, "create", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(Exception, match="killed"):
            run()
    assert table.read().first().new_listings == 2  # readers still see the version before
    run()
    assert [(r.new_listings, r.avg_price) for r in table.read().collect()] == [(3, 3.0)]
    run()
    assert table.read().first().new_listings == 3


def test_messages_and_stream_output_are_packed_densely(spark, tmp_dir):
    step(spark, tmp_dir, [1, 2])
    data = [n for found in (f"{tmp_dir}/in/1", f"{tmp_dir}/out") for n in P.Folder(spark, found).names() if n.endswith(".parquet")]
    assert len(data) >= 2 and all(n.endswith(".zstd.parquet") for n in data)
    assert {r.listing_id for r in spark.read.parquet(f"{tmp_dir}/out").collect()} == {"1", "2"}
