"""The job sequence on files, as a user runs it: raw CSV -> clean -> views -> stream -> serve."""

from homestat.__main__ import main
from homestat.schema import RAW_COLUMNS
from homestat.sources.tables import raw_listings

SF_SMALL = "/root/testdata/sf0.001"


def test_pipeline_on_files(spark, tmp_dir, capsys):
    raw = raw_listings(spark, SF_SMALL, with_order=False)
    text = raw.select(*[raw[c].cast("string").alias(c) for c in RAW_COLUMNS])
    text.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{tmp_dir}/raw")
    root = f"{tmp_dir}/root"
    main(["clean", "--input", f"{tmp_dir}/raw", "--output", f"{root}/cleaned"], spark)
    main(["eda", "--input", f"{root}/cleaned", "--output", f"{root}/batch"], spark)
    main(["publish", "--input", f"{root}/cleaned", "--output", f"{tmp_dir}/topic"], spark)
    main(["stream", "--source", f"{tmp_dir}/topic", "--output", f"{root}/speed",
          "--checkpoint", f"{tmp_dir}/ckpt"], spark)
    main(["serve", "--root", root], spark)
    main(["warehouse", "--db", "cli_test", "--listings", f"{root}/cleaned", "--speed", f"{root}/speed",
          "--location", f"{tmp_dir}/db"], spark)
    out = capsys.readouterr().out
    cleaned = spark.read.parquet(f"{root}/cleaned").count()
    assert cleaned > 0 and spark.read.parquet(f"{root}/speed").count() == cleaned
    merged = spark.read.parquet(f"{root}/serve/merged_by_district")
    assert merged.where("merged_listings = total_listings + stream_listings").count() == merged.count()
    summary = spark.read.parquet(f"{root}/serve/speed_summary").first()
    assert summary.stream_total == cleaned and summary.batch_total == cleaned
    assert spark.table("cli_test.merged_listings").count() == 2 * cleaned
    assert '"rows"' in out
