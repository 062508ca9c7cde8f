"""What a stream has published: files of committed batches, atomic snapshots, compaction.

A file sink writes data files first and then lists a batch's files in its log; files of failed or
running attempts stand in the same folder, so readers must go by the log.  A snapshot table holds
one folder per version and makes a version visible by creating an empty marker, which is atomic on
any file system: a reader sees the old version or the new one, never half of one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from homestat.session import shuffles_dropped
from homestat.sources.paths import one_name

LOG_FOLDER = "_spark_metadata"
#: A compacted file holds at least this much, but for the last one.
TARGET_BYTES = 128 * 1024 * 1024


class Folder:
    """A folder on any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str = ""):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def exists(self, name: str = "") -> bool:
        fs, target = self._at(name)
        return fs.exists(target)

    def names(self, name: str = "") -> list[str]:
        fs, target = self._at(name)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def create(self, name: str) -> bool:
        """Create an empty file; False if it is there already."""
        fs, target = self._at(name)
        fs.mkdirs(target.getParent())
        return fs.createNewFile(target)

    def delete(self, name: str) -> None:
        fs, target = self._at(name)
        fs.delete(target, True)


# ---- the file sink's log ------------------------------------------------------------------

ENTRY = "path string, size long, modificationTime long, action string"


def committed_files(spark: SparkSession, path: str) -> DataFrame | None:
    """(path, size, modified, batch) of the files that a stream's committed batches wrote; None without a log.

    ``batch`` is the first log file that lists the entry: a batch's own, or the compacted log that
    replaced it and earlier ones.
    """
    folder = Folder(spark, path)
    logs = [n for n in folder.names(LOG_FOLDER) if re.fullmatch(r"\d+(\.compact)?", n)]
    if not logs:
        return None
    # a compacted log repeats all that came before it
    start = max([int(n.split(".")[0]) for n in logs if n.endswith(".compact")], default=-1)
    used = [n for n in logs if n.endswith(".compact") and int(n.split(".")[0]) == start or int(n.split(".")[0]) > start]
    # table readers skip hidden folders, so the lines are read as an RDD of texts
    parts = [spark.read.schema(ENTRY).json(spark.sparkContext.textFile(f"{folder.path}/{LOG_FOLDER}/{n}"))
             .withColumn("batch", F.lit(int(n.split(".")[0]))) for n in used]
    lines = reduce(DataFrame.union, parts)
    entries = lines.where(F.col("path").isNotNull() & (F.coalesce("action", F.lit("add")) == "add"))
    return entries.groupBy("path").agg(F.max("size").alias("size"), F.max("modificationTime").alias("modified"), F.min("batch").alias("batch"))


def newest_committed(spark: SparkSession, path: str, n: int) -> list[str] | None:
    """The ``n`` files committed last: by batch, then by time, then by name; None without a log."""
    files = committed_files(spark, path)
    if files is None:
        return None
    return [r.path for r in files.orderBy(F.desc("batch"), F.desc("modified"), F.desc("path")).limit(n).collect()]


# ---- snapshots ----------------------------------------------------------------------------


@dataclass
class Snapshots:
    """A table published version by version; the newest marked version is the table."""

    spark: SparkSession
    path: str
    #: versions kept for readers that still read them
    keep: int = 3

    @property
    def folder(self) -> Folder:
        return Folder(self.spark, self.path)

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self.folder.names("_published") if n.isdigit())

    def write(self, df: DataFrame, version: int) -> bool:
        """Publish ``df`` as ``version``; False if that version is published already (a replayed batch)."""
        done = self.versions()
        if version in done:
            return False
        df.write.mode("overwrite").parquet(f"{self.path}/v-{version}")
        self.folder.create(f"_published/{version}")
        for old in sorted([*done, version])[:-self.keep]:
            self.folder.delete(f"_published/{old}")  # first the marker: nobody starts to read it any more
            self.folder.delete(f"v-{old}")
        return True

    def read(self, schema: T.StructType | str | None = None) -> DataFrame | None:
        """The newest published version, or None before the first."""
        done = self.versions()
        if not done:
            return None
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(f"{self.path}/v-{done[-1]}")


def start_snapshots(table: DataFrame, path: str, checkpoint: str, trigger: str | None = "10 seconds") -> StreamingQuery:
    """Publish a complete-mode aggregate: every batch's whole result is a version named by the batch.

    A batch that failed half-way left no marker and is written again; one that was published and
    is replayed after a restart changes nothing.
    """
    target = Snapshots(table.sparkSession, path)
    writer = table.writeStream.outputMode("complete").option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda batch, number: target.write(batch, number))
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


# ---- compaction ---------------------------------------------------------------------------


def bins(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """Files in order, cut into runs of at least ``target`` bytes, but for the last run."""
    out, run, held = [], [], 0
    for name, size in sizes:
        run.append(name)
        held += size
        if held >= target:
            out.append(run)
            run, held = [], 0
    return [*out, run] if run else out


@dataclass
class CompactedStream:
    """A stream's output with few files: compacted ones, and the sink's own files that are newer.

    ``stream`` is the file sink's folder, which stays untouched.  ``path`` holds the compacted files and
    published lists of (kind, path, size, place): the files to read, and the sink's files that they cover.
    """

    spark: SparkSession
    stream: str
    path: str
    target: int = TARGET_BYTES
    #: files rewritten in one run; the next run goes on with the rest
    run_files: int = 100_000

    LIST = "kind string, path string, size long, place long"

    @property
    def lists(self) -> Snapshots:
        return Snapshots(self.spark, f"{self.path}/lists")

    def listed(self) -> DataFrame:
        found = self.lists.read(self.LIST)
        return found if found is not None else self.spark.createDataFrame([], self.LIST)

    def newer(self) -> DataFrame:
        """The sink's committed files that no compacted file covers."""
        files = committed_files(self.spark, self.stream)
        if files is None:
            files = self.spark.createDataFrame([], "path string, size long, modified long, batch long")
        return files.join(self.listed().where("kind = 'source'").select("path"), "path", "left_anti")

    def compact(self) -> int:
        """Pack the newer files, and compacted ones below the target, into new files; how many were packed.

        Files of the target size or more are listed as they are.  A run that fails leaves the published
        list, and so what readers see, unchanged.
        """
        old = self.listed().where("kind = 'file'").orderBy("place").collect()
        new = self.newer().orderBy("batch", "modified", "path").limit(self.run_files).collect()
        if not new:
            return 0
        large = [(r.path, r.size) for r in [*old, *new] if r.size >= self.target]
        runs = bins([(r.path, r.size) for r in [*old, *new] if r.size < self.target], self.target)
        number = (self.lists.versions() or [-1])[-1] + 1
        made: list[tuple[str, int]] = []
        if runs:
            group = self.spark.createDataFrame([(p, i) for i, run in enumerate(runs) for p in run], "file string, run int") \
                .select(one_name(F.col("file")).alias("file"), "run")
            rows = self.spark.read.parquet(*[p for run in runs for p in run])
            # at most ``run_files`` rows are broadcast
            placed = rows.select("*", one_name(F.col("_metadata.file_path")).alias("_file")).join(
                F.broadcast(group.withColumnsRenamed({"file": "_file", "run": "_run"})), "_file").drop("_file")
            out = Folder(self.spark, f"{self.path}/run-{number}")
            with shuffles_dropped(self.spark):
                placed.repartition(len(runs), "_run").write.mode("overwrite").partitionBy("_run").parquet(out.path)
            for i in range(len(runs)):
                fs, target = out._at(f"_run={i}")
                made += [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(target) if s.getPath().getName().endswith(".parquet")]
        files = self.spark.createDataFrame([("file", p, n, i) for i, (p, n) in enumerate([*large, *made])], self.LIST)
        covered = self.spark.createDataFrame([("source", r.path, r.size, None) for r in new], self.LIST)
        self.lists.write(files.unionByName(covered).unionByName(self.listed().where("kind = 'source'")), number)
        self._drop_unused()
        return sum(map(len, runs))

    def _drop_unused(self) -> None:
        """Delete compacted files that no kept list names."""
        kept = [self.spark.read.schema(self.LIST).parquet(f"{self.lists.path}/v-{v}") for v in self.lists.versions()]
        used = {p.split("/run-")[-1].split("/")[0] for df in kept for (p,) in df.where("kind = 'file'").select("path").collect()}
        home = Folder(self.spark, self.path)
        for name in home.names():
            if name.startswith("run-") and name.removeprefix("run-") not in used:
                home.delete(name)

    def files(self) -> list[str]:
        return [r.path for r in self.listed().where("kind = 'file'").select("path").union(self.newer().select("path")).collect()]

    def read(self, schema: T.StructType | str) -> DataFrame:
        """All committed rows of the stream."""
        files = self.files()
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)
