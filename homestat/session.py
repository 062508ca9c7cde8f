"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings a job needs for correctness or scale; everything else comes from the cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches handed to Python (HTML pages are large rows): bound the
    # rows per batch so one batch stays small in the Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: Shuffle files go when the execution that wrote them ends, not when the driver's JVM collects its plan.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app: str = "homestat",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session; master/memory come from spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, whose Python functions import it.

    Registered queries do it for sessions that the caller made; once per application.  Workers of
    a local session may lack the package too, if it is only on the caller's own path.
    """
    sc = spark.sparkContext
    if getattr(sc, "_homestat_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="homestat-pkg-")) / "homestat.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in package.rglob("*.py"):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._homestat_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    On a cluster the setting names a shared file system; it is read, never
    overridden, and a cluster without it is an error.  Only in local mode with
    nothing set (tests) a private folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on the cluster's shared file system")
        configured = tempfile.mkdtemp(prefix="homestat-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one job's outputs, deleted when the driver ends."""
    own = f"{checkpoint_root(spark).rstrip('/')}/homestat/{name}-{uuid.uuid4().hex[:12]}"
    target = spark._jvm.org.apache.hadoop.fs.Path(own)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return f"{own}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint root and read it back.

    Used where one result feeds several jobs (a quantile pass, then a filter,
    then a replay): the inputs are computed once and later jobs start from
    the written table, which also cuts lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block leave no shuffle files behind: a write's plan is not run again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that no later job reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def materialized(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialize`` for the jobs of one block: packed densely, deleted after them.

    Nothing that outlives the block may read it.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    try:
        with shuffles_dropped(spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path.rpartition("/")[0])
