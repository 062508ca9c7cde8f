"""Shared helpers: tables, shared scratch folders, Arrow row mapping.

Every operator reads only the columns it names, so extra columns of the input
(also ones named like an operator's outputs) cannot clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestat.session import checkpoint_root

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that a Python worker turns into rows at once.
SLICE_BYTES = 2 << 20
#: ASCII white space, the six characters that separate plain words.
BLANKS = " \t\n\x0b\x0c\r"
#: Everything of ASCII but letters and digits: separators of normalised words.
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: bytes.translate table that lower-cases A-Z and blanks the separators.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder, deleted when the driver's JVM ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/homestat-llm/{name}-{uuid.uuid4().hex[:12]}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later read needs."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def write_line(spark: SparkSession, path: str, line: str) -> None:
    """A file of one line that is seen whole or not at all: written beside its place, then renamed."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    part, target = hadoop(f"{path.rsplit('/', 1)[0]}/_part-{uuid.uuid4().hex}"), hadoop(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(part)
    try:
        out.write(bytearray(line.encode() + b"\n"))
    finally:
        out.close()
    if not fs.rename(part, target):
        raise RuntimeError(f"another writer made {path}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts lineage, survives lost executors)."""
    path = scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does it for pure ASCII; other strings go through ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def byte_rows(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 byte strings, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def byte_objects(column: pa.Array) -> list[bytes]:
    """As ``byte_rows``, faster for many short strings without nulls."""
    return column.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def extend(df: DataFrame, fields: list[tuple[str, T.DataType]],
           rows: Callable[[list[bytes | None]], list[list]], text: str = "text") -> DataFrame:
    """``df`` with columns computed from its text column, batch by batch.

    ``rows`` gets texts of a batch (UTF-8 bytes or None) and returns one list per field; a batch of
    many bytes is handed over in slices, since a task holds a text in several forms at once. Row
    order and all other columns pass through untouched.
    """
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, t, True) for n, t in fields]])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        kinds = [to_arrow_type(t) for _, t in fields]
        for part in (p for batch in batches for p in in_slices(batch, at, SLICE_BYTES)):
            made = rows(byte_rows(part.column(at)))
            arrays = [pa.array(values, kind) for values, kind in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[f.name for f in schema])

    return df.mapInArrow(run, schema)


def in_slices(batch: pa.RecordBatch, text: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``limit`` bytes; a longer text is a run of its own."""
    sizes = np.fromiter((0 if t is None else len(t) for t in byte_rows(batch.column(text))), np.int64, len(batch))
    ends = np.cumsum(sizes)
    at = 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def words_in_order(texts: list[bytes | None], kinds: np.ndarray, shown: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, row, piece) of all words of ``texts``, without a step per word.

    ``kinds`` says of each byte whether it belongs to a word (0), separates words (1) or ends a
    piece (2); ``shown`` is the byte that stands for it. Pieces never reach beyond their text.
    """
    raw = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)
    starts = np.cumsum([0] + [len(t or b"") + 1 for t in texts], dtype=np.int64)[:-1]
    ends = starts[1:] - 1  # the added line ends always close a piece
    kind = kinds[raw].copy()
    kind[ends], kind[-1] = 2, 2
    inside = kind == 0
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate(([0], np.cumsum(last - first))).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(shown[raw[inside]]))])
    row = np.searchsorted(starts, first, "right") - 1
    return words, row, np.searchsorted(np.flatnonzero(kind == 2), first)


def ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (sizes[i] numbers), one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)
