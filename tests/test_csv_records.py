"""Splittable quoted CSV: equal to a one-task read, columns by name."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from homestat.schema import RAW_COLUMNS
from homestat.sources import csv_records as R
from homestat.sources.files import NA_TOKENS, read_raw_csv


def write(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator=end, quoting=quoting).writerows(rows)


def listing_rows(n, seed):
    own = random.Random(seed)
    pieces = ["plain", "two\nlines", 'say "hi"', '"', '""', "a,b", "\n\nthree\n", " padded ", "back\\slash", "é漢字", "", "N/A", "x" * 300, "\n" * 40, 'end"\n"start']
    return [[f"id-{i}"] + ["".join(own.choice(pieces) for _ in range(own.randint(0, 3))) for _ in range(3)] for i in range(n)]


def plain(rows, names):
    """What a one-task reader gives: NA texts and empty fields are missing."""
    return [{c: (None if v in NA_TOKENS else v) for c, v in zip(names, r)} for r in rows]


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_read_by_many_tasks_equals_one_task(spark, tmp_dir, small_splits, end):
    names = ["listing_id", "title", "address", "contact"]
    rows = listing_rows(600, 1)
    rows[200][1] = "long\n" * 3000  # goes on over several splits
    write(f"{tmp_dir}/a b.csv", [names, *rows], end)
    lines = R.input_lines(spark, tmp_dir)
    assert lines.select("block").distinct().count() > 20
    df = read_raw_csv(spark, tmp_dir)
    got = [r.asDict() for r in df.orderBy("_seq").select(*names).collect()]
    assert got == plain(rows, names)
    assert [c for c in df.columns if c != "_seq"][:4] == names and set(RAW_COLUMNS) < set(df.columns)
    if end == "\n":
        one = spark.read.options(header=True, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(tmp_dir)
        assert one.exceptAll(R.read_records(spark, tmp_dir, {"quote": '"', "escape": '"'}).select(*names)).isEmpty()


@pytest.mark.parametrize("multiline", [True, False])
def test_files_with_different_headers_are_matched_by_name(spark, tmp_dir, multiline):
    write(f"{tmp_dir}/1.csv", [["listing_id", "title", "price_billion", "area_m2"], ["a", "first", "1.5", "10"]])
    write(f"{tmp_dir}/2.csv", [["listing_id", "price_billion", "title", "area_m2"], ["b", "3.5", "second", "20"]])
    write(f"{tmp_dir}/3.csv", [["Unnamed: 0", "extra", "title", "listing_id"], ["0", "more", "third", "c"]], quoting=csv.QUOTE_ALL)
    write(f"{tmp_dir}/4.csv", [["listing_id", "title"]])
    open(f"{tmp_dir}/5.csv", "w").close()
    df = read_raw_csv(spark, tmp_dir, multiline)
    got = {r.listing_id: (r.title, r.price_billion, r.area_m2, r.extra, r.city) for r in df.collect()}
    assert got == {"a": ("first", "1.5", "10", None, None), "b": ("second", "3.5", "20", None, None), "c": ("third", None, None, "more", None)}
    assert "Unnamed: 0" not in df.columns


def test_splits_hold_whole_lines_and_running_parity(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/a.csv", [["listing_id", "title", "b", "c"], *listing_rows(300, 3)])
    write(f"{tmp_dir}/b.csv", [["listing_id", "title", "b", "c"], *listing_rows(200, 4)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = R.numbered(R.input_lines(spark, tmp_dir)).orderBy("file", "block", "at").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    text = {}
    for r in rows:
        text.setdefault(r.file.rsplit("/", 1)[1], []).append(r.value)
    for name, values in text.items():
        assert "\n".join(values) + "\n" == open(f"{tmp_dir}/{name}", newline="").read()
    split, at, quotes = None, 0, 0
    for r in rows:
        at, quotes = (at + 1, quotes) if split == (r.file, r.block) else (0, 0)
        split = (r.file, r.block)
        assert (r.at, r.odd) == (at, quotes % 2 == 1)
        quotes += r.quotes


def test_edge_files(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w", newline="", encoding="utf-8") as f:
        f.write('﻿listing_id,title\n\n1,x\n\n2\n3,y,z\n4,"never closed\nends')
    got = sorted((r.listing_id, r.title) for r in read_raw_csv(spark, tmp_dir).collect())
    assert got == [("1", "x"), ("2", None), ("3", "y"), ("4", "never closed\nends")]


def test_bad_headers_are_errors(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", [["listing_id", "title", "title"], ["1", "x", "y"]])
    with pytest.raises(ValueError, match="twice"):
        read_raw_csv(spark, tmp_dir)


def test_no_file_gives_no_rows(spark, tmp_dir):
    open(f"{tmp_dir}/a.csv", "w").close()
    assert read_raw_csv(spark, tmp_dir).select(*RAW_COLUMNS, F.col("_seq.file")).collect() == []


def test_texts_do_not_go_to_python(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("a,b\n1,x\n")
    lines = R.input_lines(spark, tmp_dir)
    plan = R.numbered(lines)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    called = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    assert "value#" not in called.split("[")[1]
