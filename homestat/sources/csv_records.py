"""Quoted CSV files read by many tasks each, with columns matched by name.

A line break inside quotes does not end a record, so a task that starts in the middle of a file
cannot tell records from its own bytes alone.  The number of quotes before a line decides it: an
odd number means that the line continues a quoted field.  Quotes are counted per file split, the
counts are summed up over a file's splits, and every line then knows whether it starts a record.
Only records of several lines are brought together, first within their split, then across splits.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homestat.session import materialize, materialized, shuffles_dropped
from homestat.sources.paths import one_name

HEAD_THREADS = 16
SPLIT = ["file", "block"]


def input_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, value, quotes) of every line; ``block`` is where the line's split starts in its file."""
    lines = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), value,
        (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))).alias("quotes"))


def file_headers(spark: SparkSession, path: str | list[str]) -> list[tuple[str, tuple[str, ...]]]:
    """(file, column names) of every file that Spark reads under ``path``; files without a line have none.

    Only the first line of each file is opened, through the same file-system API as Spark's readers.
    A name that stands twice in a header is an error, as is a line break inside a name.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def head(uri: str) -> tuple[str, tuple[str, ...]]:
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        stream = target.getFileSystem(conf).open(target)
        try:
            codec = codecs.getCodec(target)
            source = codec.createInputStream(stream) if codec is not None else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
        finally:
            stream.close()
        if line is None:
            return uri, ()
        if line.count('"') % 2:
            raise ValueError(f"{uri}: a line break inside a column name")
        names = tuple(next(csv.reader([line.removeprefix("﻿")]), ()))
        if len(set(names)) < len(names):
            raise ValueError(f"{uri}: a column name stands twice in the header")
        return uri, names

    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(HEAD_THREADS) as pool:
        return list(pool.map(head, files))


def numbered(lines: DataFrame) -> DataFrame:
    """``lines`` plus ``at``, a line's number in its split, and ``odd``: an odd number of quotes before it there.

    A running sum in the order of the split is all that is computed, so only the split and the number
    of quotes go to Python; the texts stay where they are.
    """

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, line, odd = None, 0, 0
        for files, blocks, counts in batches:
            if not len(files):
                continue
            file, block = files.to_numpy(), blocks.to_numpy()
            new = np.concatenate(([last != (file[0], block[0])], (np.diff(file) != 0) | (np.diff(block) != 0)))
            first = np.flatnonzero(new)
            start = np.where(np.cumsum(new) > 0, np.append(first, 0)[np.maximum(np.cumsum(new) - 1, 0)], -1)
            quotes = counts.to_numpy().astype(np.int64)
            before = np.cumsum(quotes) - quotes
            at = np.arange(len(file)) - start
            parity = before - np.where(start >= 0, before[np.maximum(start, 0)], 0)
            open_ = start < 0  # the split began in an earlier batch
            at[open_] += line - 1
            parity[open_] += odd
            parity &= 1
            last, line, odd = (file[-1], block[-1]), int(at[-1]) + 1, int(parity[-1] + quotes[-1]) & 1
            yield pa.StructArray.from_arrays([pa.array(at), pa.array(parity.astype(bool))], names=["at", "odd"])

    # depends on the rows before, so no filter may be moved below it
    place = F.arrow_udf(run, "at long, odd boolean").asNondeterministic()
    placed = lines.withColumn("place", place(F.xxhash64("file"), F.col("block"), F.col("quotes")))
    return placed.select(*lines.columns, "place.at", "place.odd")


def joined_lines(part: Column, order: Column) -> Column:
    """The texts of one record in order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), part.alias("t")))), lambda s: s["t"]), "\n")


def records(spark: SparkSession, path: str | list[str], headers: DataFrame) -> DataFrame:
    """(file, block, at, header, text) of every record but the headers; ``headers`` is (file, header).

    Quotes follow RFC 4180: a field with a quote is quoted, and quotes inside are doubled.  A record is
    placed where it starts; one that no quote ends goes on to the end of its file.  Empty lines between
    records are skipped; line ends inside a field are kept as line feeds.
    """
    lines = input_lines(spark, path)
    totals = lines.groupBy(*SPLIT).agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = totals.select(*SPLIT, one_name(F.col("file")).alias("name"), (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    # file names are brought to one form here, once a split
    splits = materialize(splits.join(headers.withColumnRenamed("file", "name"), "name"), "splits")
    # as many rows as the list of splits that the driver plans a scan with: no line is shuffled for them
    placed = numbered(lines).join(F.broadcast(splits), SPLIT).drop("file").withColumnRenamed("name", "file")
    starts = F.col("odd") == F.col("inside")
    whole = starts & (F.col("quotes") % 2 == 0)
    single = placed.where(whole).select(*SPLIT, "at", "header", F.col("value").alias("text"))
    # lines of records that have several: few, so they are written once and brought together
    several = placed.where(~whole).select(*SPLIT, "at", "header", "value", "quotes", starts.alias("starts"))
    with materialized(several, "loose") as loose:
        so_far = Window.partitionBy(*SPLIT).orderBy("at")
        record = F.max(F.when(F.col("starts"), F.col("at"))).over(so_far)
        parts = loose.withColumn("record", record).groupBy(*SPLIT, "record").agg(
            F.first("header").alias("header"), (F.sum("quotes") % 2 == 1).alias("open"), joined_lines(F.col("value"), F.col("at")).alias("text"))
        with shuffles_dropped(spark):
            parts = materialize(parts, "parts")
    ended = F.col("record").isNotNull() & ~F.col("open")
    within = parts.where(ended).select(*SPLIT, F.col("record").alias("at"), "header", "text")
    # at most two parts a split are left: the end of an earlier split's record, and an open one
    order = F.struct("block", F.coalesce("record", F.lit(-1)).alias("record"))
    of = F.max(F.when(F.col("record").isNotNull(), order)).over(Window.partitionBy("file").orderBy(order))
    across = parts.where(~ended).withColumn("start", of).groupBy("file", "start").agg(
        F.first("header").alias("header"), joined_lines(F.col("text"), order).alias("text"))
    across = across.select("file", F.col("start.block").alias("block"), F.col("start.record").alias("at"), "header", "text")
    every = single.unionByName(within).unionByName(across)
    text = F.when(F.contains("text", F.lit("\r")), F.regexp_replace(F.regexp_replace("text", "\r\n", "\n"), "\r$", "")) \
        .otherwise(F.col("text"))  # most records have no carriage return to look for
    return every.where(~((F.col("block") == 0) & (F.col("at") == 0))).withColumn("text", text).where(F.col("text") != "")


def read_records(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> DataFrame:
    """Every column named by any header, as text, plus (_file, _block, _at), where a record starts.

    A file lacking a column has NULL there, whatever the order of its own columns.  Fields beyond the
    header are left out, missing ones are NULL.
    """
    heads = file_headers(spark, path)
    kinds = sorted({names for _, names in heads if names})
    number = {names: i for i, names in enumerate(kinds)}
    headers = spark.createDataFrame([(f, number[n]) for f, n in heads if n], "file string, header int") \
        .withColumn("file", one_name(F.col("file")))
    width = max(map(len, kinds), default=0)
    if not width:
        return spark.createDataFrame([], "_file string, _block long, _at long")
    fields = [f"_c{i}" for i in range(width)]
    parse = F.from_csv("text", ", ".join(f"{c} string" for c in fields), options)
    # a generator keeps the parsed fields apart from later filters: each record is parsed once
    parsed = records(spark, path, headers).select("file", "block", "at", "header", F.inline(F.array(parse)))
    columns = list(dict.fromkeys(c for names in kinds for c in names))
    picked = []
    for c in columns:
        places: dict[int, list[int]] = {}
        for names in kinds:
            if c in names:
                places.setdefault(names.index(c), []).append(number[names])
        everywhere = len(places) == 1 and sum(map(len, places.values())) == len(kinds)
        cases = [F.col(f"_c{i}") if everywhere else F.when(F.col("header").isin(own), F.col(f"_c{i}")) for i, own in places.items()]
        picked.append(F.coalesce(*cases).alias(c))
    return parsed.select(*picked, F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("at").alias("_at"))
