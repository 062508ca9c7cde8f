"""Benchmark decontamination by a broadcast set of normalised test n-grams.

Test items become windows of 13 consecutive words (a shorter item is one window). Their hashes
are broadcast in blocks of bounded size; a document's word windows are looked up by hash, every
find is verified word by word, and the hit words are removed as spans or the document is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestat.llm.common import WORD_BYTES, byte_rows, fresh_name, stored, table

WINDOW = 13
#: Most windows broadcast at once; a larger benchmark is scanned in several blocks.
BLOCK_WINDOWS = 2_000_000
MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit polynomial hash of every window of ``width`` word numbers."""
    out = np.zeros(len(ids) - width + 1, np.uint64)
    for k in range(width):
        out = out * MULT + ids[k:k + len(out)]
    return out


class Grams:
    """One block's test windows: word numbers, hashes by window width, and per window its items."""

    def __init__(self, windows: dict[bytes, list[str]]):
        self.items = windows
        self.vocab: dict[bytes, int] = {}
        for gram in windows:
            for w in gram.split(b" "):
                self.vocab.setdefault(w, len(self.vocab) + 1)
        hashes: dict[int, list] = {}
        for gram in windows:
            ids = np.array([self.vocab[w] for w in gram.split(b" ")], np.uint64)
            hashes.setdefault(len(ids), []).append(rolling(ids, len(ids))[0])
        self.hashes = {width: np.unique(np.array(h, np.uint64)) for width, h in hashes.items()}

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans (first word, end exclusive) and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        ids = np.fromiter(map(self.vocab.get, words, [0] * len(words)), np.uint64, len(words))
        for width, hashes in self.hashes.items():
            if width > len(words):
                continue
            # a window holding a word that no test item has cannot match
            unknown = np.concatenate(([0], np.cumsum(ids == 0)))
            starts = np.flatnonzero(unknown[width:] == unknown[:-width])
            if not len(starts):
                continue
            found = rolling(ids, width)[starts]
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            for i in starts[hashes[at] == found].tolist():
                names = self.items.get(b" ".join(words[i:i + width]))  # the exact check
                if names is not None:
                    spans.append((i, i + width))
                    items.update(names)
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_windows(bench: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(window, item) of every test item; items without words give none. Item null: window without a name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, names = [], []
            for name, t in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
                words = words_of(t)
                width = min(WINDOW, len(words))
                for i in range(len(words) - width + 1 if words else 0):
                    grams.append(b" ".join(words[i:i + width]))
                    names.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array(names, pa.string())],
                                             names=["gram", "item"])

    named = bench.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return named.mapInArrow(run, "gram binary, item string").distinct()


def blocks(bench: DataFrame, limit: int = BLOCK_WINDOWS) -> Iterator[tuple[dict[bytes, list[str]], bool]]:
    """The benchmark's windows in blocks of about ``limit`` (by hash), one at a time; and whether it is the last."""
    windows = stored(item_windows(bench), "windows")
    n = windows.count()
    parts = max(1, -(-n // limit))
    for k in range(parts):
        block: dict[bytes, list[str]] = {}
        for row in windows.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == k).toLocalIterator():
            names = block.setdefault(bytes(row.gram), [])
            if row.item is not None:
                names.append(row.item)
        yield block, k == parts - 1


#: The tables of the block that a Python worker saw last, so that its next task need not build them again.
_LATEST: dict[str, Grams] = {}


def grams_of(key: str, block: dict[bytes, list[str]]) -> Grams:
    if key not in _LATEST:
        _LATEST.clear()
        _LATEST[key] = Grams(block)
    return _LATEST[key]


SPANS = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def scan(docs: DataFrame, bench: DataFrame, text: str = "text", limit: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` plus (n_words, spans, items): words hit by any benchmark window, and the items found.

    The column names get underscores if the input has them already; the last three columns are
    the added ones, in this order. No shuffle: each block of the benchmark is broadcast and the
    documents stream past it, handing spans and items on to the next block. Null or empty texts
    have no words and no hits; so has everything when the benchmark is empty. With several blocks,
    what one has found is written before the next one is loaded: the driver and the workers hold one.
    """
    spark = docs.sparkSession
    names = [fresh_name(docs, n) for n in ("n_words", "spans", "items")]
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType()),
                           T.StructField(names[1], SPANS), T.StructField(names[2], T.ArrayType(T.StringType()))])
    at, width = docs.columns.index(text), len(docs.columns)
    out = docs
    for k, (block, last) in enumerate(blocks(bench, limit)):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first=not k, key=uuid4().hex) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type
            kinds = [to_arrow_type(f.dataType) for f in schema.fields[width:]]
            grams = grams_of(key, shared.value)
            for batch in batches:
                counts, spans, items = [], [], []
                before = None if first else [batch.column(width + j).to_pylist() for j in (1, 2)]
                for i, t in enumerate(byte_rows(batch.column(at))):
                    words = words_of(t)
                    hit, found = grams.scan(words)
                    if before:
                        hit += [(s["first"], s["end"]) for s in before[0][i]]
                        found |= set(before[1][i])
                    counts.append(len(words))
                    spans.append([{"first": a, "end": b} for a, b in merged(hit)])
                    items.append(sorted(found))
                made = [pa.array(v, kind) for v, kind in zip((counts, spans, items), kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], *made], names=schema.names)

        out = out.mapInArrow(run, schema)
        if not last:
            out = stored(out, "scanned")
            shared.unpersist()
    return out


def hits(spans: str):
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["first"]).cast("long"))


def is_contaminated(n_words: str, spans: str):
    """Some word is hit, and at least a twentieth of all words."""
    n_hit = hits(spans)
    return (n_hit > 0) & (20 * n_hit >= F.col(n_words))


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the characters from each span's first to its last word."""
    plain = text.translate(WORD_BYTES)
    out, last, word, i, n = [], 0, 0, 0, len(plain)
    todo = list(spans)
    while i < n and todo:
        while i < n and plain[i] == 32:
            i += 1
        if word == todo[0][0]:
            out.append(text[last:i])
        while i < n and plain[i] != 32:
            i += 1
        word += 1
        if word == todo[0][1]:
            last = i
            todo.pop(0)
    return b"".join(out) + text[last:]


def decontaminate(docs: DataFrame, bench: DataFrame, remove: str = "documents", text: str = "text") -> DataFrame:
    """``docs`` without contaminated documents, or (remove='spans') with their hit spans cut out.

    The columns of ``docs`` come back; documents that are not contaminated keep their text.
    """
    found = scan(docs, bench, text)
    n_words, spans, _ = found.columns[-3:]
    if remove == "documents":
        return found.where(~is_contaminated(n_words, spans)).select(*[F.col(f"`{c}`") for c in docs.columns])
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")

    @F.pandas_udf("string")
    def cut(texts, where):
        import pandas as pd
        return pd.Series([
            None if t is None else
            without_spans(t.encode(), [(s["first"], s["end"]) for s in w]).decode("utf-8", "replace")
            for t, w in zip(texts, where)])

    shorter = F.when(is_contaminated(n_words, spans), cut(F.col(text), F.col(spans))).otherwise(F.col(text))
    return found.select(*[shorter.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def digest_items(items: str):
    return F.sha2(F.array_join(F.array_sort(F.col(items)), ","), 256)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    found = scan(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]))
    return found.select(
        "doc_id", "n_words", hits("spans").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        digest_items("items").alias("items_sha256"), is_contaminated("n_words", "spans").alias("contaminated"))


