"""Line dedup over levelled sorted runs of line hashes.

State is a set of runs: Parquet tables bucketed and sorted by line hash, one record per line key
with the number of documents that hold it and the largest of their ids. A new batch of documents
is merge-anti-joined with the runs: its unseen keys become a run of its own at level 0, the other
keys an update of records that the runs hold. When a level holds ``fanout`` runs they are merged
into one run of the next level. Buckets are aligned, so neither joins nor merges move or sort the
runs again. Everything is DataFrame code.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.llm.common import BLANKS, ascii_lower, child_names, discard, fresh_name, scratch, stored, table, write_line

MIN_CHARS = 20
MIN_DOCS = 3
#: Documents without an id count as one document that is smaller than any other.
NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_hash(key: Column) -> Column:
    """128 bits, so that keys of a large corpus don't collide."""
    return F.unhex(F.md5(key))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def known_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, version, line, hash) of every line long enough to count; version tells rows with one id apart."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("version"),
                       F.posexplode(text_lines(F.col(text))).alias("line", "raw"))
    # a cheap test first: the key has no more characters than the line
    rows = rows.where(F.char_length("raw") >= min_chars)
    keyed = rows.select("doc", "version", "line", line_key(F.col("raw")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select("doc", "version", "line", line_hash(F.col("key")).alias("hash"))


def run_records(lines: DataFrame) -> DataFrame:
    """One record per line key of a batch: documents that hold it, and the largest of their ids.

    The first aggregation groups by (hash, doc), so a key that a third of all documents hold is
    spread; the second is pre-aggregated in the map tasks.
    """
    held = lines.groupBy("hash", "doc").agg(F.lit(1).cast("long").alias("one"))
    return held.groupBy("hash").agg(F.sum("one").alias("docs"), F.max("doc").alias("last_doc"))


@contextmanager
def sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Let scans of bucketed tables tell the planner that one-file buckets are sorted."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@dataclass
class LineRuns:
    """Levelled sorted runs in a shared folder, bucketed and sorted by line hash.

    ``levels`` hold the runs proper: every key stands in exactly one of them, because a batch adds
    only the keys that the merge-anti-join with the runs found unseen. ``updates`` hold, level by
    level as well, what later batches add to keys that the runs hold already. The counts of a key
    are its record in the runs plus its records in the updates, so the runs are never aggregated.

    A manifest names the runs; it is written under a new number after the runs it names, and runs
    that it no longer names are deleted after it. So a batch that was cut off leaves the old state,
    and ``LineRuns.open`` goes on with it in any later session.
    """

    spark: SparkSession
    root: str
    fanout: int = 3
    buckets: int = 0
    levels: list[list[str]] = field(default_factory=list)
    updates: list[list[str]] = field(default_factory=list)
    batches: list[str] = field(default_factory=list)
    version: int = 0

    SCHEMA = "hash binary, docs long, last_doc long"

    def __post_init__(self) -> None:
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    # ---- state ---------------------------------------------------------------------------

    @classmethod
    def open(cls, spark: SparkSession, root: str, **new) -> LineRuns:
        """The state that the newest manifest under ``root`` names; an empty one if there is none."""
        found = sorted(n for n in child_names(spark, root) if n.startswith("manifest-"))
        if not found:
            return cls(spark, root, **new)
        rows = spark.read.text(f"{root}/{found[-1]}").collect()  # one line
        return cls(spark, root, **json.loads(rows[0][0]), version=int(found[-1].removeprefix("manifest-")))

    def _commit(self) -> None:
        said = json.dumps({k: getattr(self, k) for k in ("fanout", "buckets", "levels", "updates", "batches")})
        self.version += 1
        write_line(self.spark, f"{self.root}/manifest-{self.version:08d}", said)

    def _write(self, records: DataFrame, name: str) -> str:
        """A new run: one sorted file a bucket."""
        run = f"{name}_{uuid.uuid4().hex[:12]}"
        records.repartition(self.buckets, "hash").write.mode("overwrite").bucketBy(self.buckets, "hash").sortBy("hash") \
            .option("path", f"{self.root}/{run}").format("parquet").saveAsTable(run)
        return run

    def table(self, run: str) -> DataFrame:
        """A run by name, as a bucketed table of this session's catalog."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {run} ({self.SCHEMA}) USING PARQUET CLUSTERED BY (hash) SORTED BY (hash) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/{run}'")
        return self.spark.table(run)

    def _forget(self, runs: list[str], files: bool = True) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")
            if files:
                discard(self.spark, f"{self.root}/{run}")

    def close(self) -> None:
        """Take the runs out of the session's catalog; the files and the manifest stay."""
        self._forget([r for level in self.levels + self.updates for r in level], files=False)

    # ---- batches -------------------------------------------------------------------------

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Records of keys that no run holds: one merge-anti-join a run, bucket by bucket."""
        for run in (r for level in self.levels for r in level):
            batch = batch.join(self.table(run).select("hash").hint("merge"), "hash", "left_anti")
        return batch

    def ingest(self, lines: DataFrame, batch: str | None = None) -> bool:
        """Add one batch: (doc, hash) rows of documents that no earlier batch held.

        A named batch that the state holds already changes nothing (False), so a job that is
        started again after a failure may hand in its batches again.
        """
        if batch is not None and batch in self.batches:
            return False
        records = run_records(lines)
        with sorted_buckets(self.spark):
            if not any(self.levels):
                put(self.levels, 0, self._write(records, "run"))
            else:
                whole = self._write(records, "batch")
                fresh = self._write(self.unseen(self.table(whole)), "run")
                # the other keys of the batch: those that did not get into its run
                held = self.table(whole).join(self.table(fresh).select("hash").hint("merge"), "hash", "left_anti")
                put(self.updates, 0, self._write(held, "update"))
                put(self.levels, 0, fresh)
                self._forget([whole])
            if batch is not None:
                self.batches.append(batch)
            old = self._compact(self.levels, "run") + self._compact(self.updates, "update")
        self._commit()
        self._forget(old)
        return True

    def _compact(self, levels: list[list[str]], name: str) -> list[str]:
        """Merge each level that is full into one run of the next level; returns the runs merged."""
        merged, level = [], 0
        while level < len(levels):
            if len(levels[level]) >= self.fanout:
                both = reduce(DataFrame.unionByName, [self.table(r) for r in levels[level]])
                # a key stands once in the runs, but may stand in many updates
                put(levels, level + 1, self._write(total(both) if name == "update" else both, name))
                merged += levels[level]
                levels[level] = []
            level += 1
        return merged

    # ---- reading -------------------------------------------------------------------------

    def records(self) -> DataFrame | None:
        """(hash, docs, last_doc), one row a key over all batches; None before the first batch."""
        runs = [r for level in self.levels for r in level]
        later = [r for level in self.updates for r in level]
        if not runs:
            return None
        if not later:
            return reduce(DataFrame.unionByName, [self.table(r) for r in runs])
        added = total(reduce(DataFrame.unionByName, [self.table(r) for r in later])) \
            .select("hash", F.col("docs").alias("more"), F.col("last_doc").alias("later"))
        parts = [self.table(r).hint("merge").join(added, "hash", "left").select(
            "hash", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"),
            F.greatest("last_doc", "later").alias("last_doc")) for r in runs]
        return reduce(DataFrame.unionByName, parts)

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame | None:
        """(hash, last_doc) of keys in at least ``min_docs`` documents over all batches."""
        found = self.records()
        return None if found is None else found.where(F.col("docs") >= min_docs).select("hash", "last_doc")


def put(levels: list[list[str]], level: int, run: str) -> None:
    while len(levels) <= level:
        levels.append([])
    levels[level].append(run)


def total(records: DataFrame) -> DataFrame:
    return records.groupBy("hash").agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc"))


def dropped_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = 3, fanout: int = 2,
                  min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, version, drop): the line numbers that each affected document loses.

    Lines are extracted and hashed once into a table split into batches by document id; the
    batches go through the runs one by one. ``drop`` holds line numbers of one document only.
    """
    spark = docs.sparkSession
    lines = known_lines(docs, doc_id, text, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int"))
    # one file a task: the lines are narrow, so that a batch may as well read them all
    lines = stored(lines, "lines")
    runs = LineRuns(spark, scratch(spark, "runs"), fanout)
    for b in range(batches):
        runs.ingest(lines.where(F.col("batch") == b))
    # written, so that a hot key's lines can be split among tasks in the join below
    with sorted_buckets(spark):
        repeated = stored(runs.repeated(min_docs), "repeated")
    runs.close()
    lost = lines.join(repeated, "hash").where(F.col("doc") < F.col("last_doc"))
    return lost.groupBy("doc", "version").agg(F.collect_set("line").alias("drop"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` plus three last columns: n_lines, n_dropped and the kept text.

    A key (line stripped of ASCII blanks, A-Z lower-cased) of at least 20 code points that at
    least 3 documents hold loses all its lines but those in the largest document id. Null and
    empty texts are one empty line. Rows that share an id are one document; a null id is one
    document before all others. Column names get underscores where the input has them already.
    """
    names = [fresh_name(docs, n) for n in ("n_lines", "n_dropped", "kept_text")]
    tmp = [fresh_name(docs, n) for n in ("_doc", "_version", "_drop")]
    lost = dropped_lines(docs, doc_id, text, **how).select(
        F.col("doc").alias(tmp[0]), F.col("version").alias(tmp[1]), F.col("drop").alias(tmp[2]))
    keyed = docs.withColumn(tmp[0], F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))) \
        .withColumn(tmp[1], F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    both = keyed.join(lost, tmp[:2], "left")
    drop = F.col(tmp[2])
    lines = text_lines(F.col(text))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    return both.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size(lines).cast("long").alias(names[0]),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias(names[1]),
        F.when(drop.isNull(), F.coalesce(F.col(text), F.lit("")))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")).alias(names[2]))


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with the kept lines as text, in its own columns; n_chars follows. A null text stays null."""
    out = dedup_lines(docs, doc_id, text, **how)
    kept = F.when(F.col(text).isNotNull(), F.col(out.columns[-1]))
    return out.select(*[
        kept.alias(c) if c == text
        else F.char_length(kept).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns])


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
