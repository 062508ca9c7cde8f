"""Exact top-k inner products by MaxScore.

A vector's components are its terms, and each shard of vectors keeps one posting list per
dimension. For a query, a list's score bound is the most that its dimension can add within the
shard. Lists whose bounds together stay below what the query still needs are non-essential: the
essential lists are traversed for the whole shard, and the others are probed, highest bound
first, only for vectors that are still competitive. Each task hands on its best k; they are
merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homestat.llm.common import scratch, stored, table

K = 10
SCALE = 1024
#: Vectors of a shard, and queries scored against it at once.
SHARD_ROWS, SLICE_QUERIES = 4096, 256
#: Components in a block of queries; a larger query set goes through in several blocks.
BLOCK_COMPONENTS = 4_000_000
#: Non-essential lists probed between two looks at the bounds.
STEP = 8
#: Doubles add integers exactly below this; larger sums use Python integers.
EXACT = float(1 << 53)


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number, also after scaling."""
    limit = float(np.finfo(np.float64).max) / SCALE
    fine = F.forall(vector, lambda x: F.coalesce((x >= -limit) & (x <= limit), F.lit(False)))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of floor(SCALE * x), padded with zeros to the longest vector."""
    sizes = np.diff(column.offsets.to_numpy())
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(column), int(sizes.max(initial=0))))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def whole_numbers(rows: np.ndarray) -> np.ndarray:
    """The same integers as Python integers, whose sums never round."""
    return np.array([[int(x) for x in row] for row in rows], object).reshape(rows.shape)


def seed(vectors: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best score among the block's other queries, which are candidates too.

    -inf with fewer than k others, or where doubles could not hold the sums.
    """
    n = len(vectors)
    out = np.full(n, -np.inf)
    if n <= k or np.abs(vectors).max(initial=0) ** 2 * max(1, vectors.shape[1]) >= EXACT:
        return out
    for at in range(0, n, SLICE_QUERIES):
        scores = vectors[at:at + SLICE_QUERIES] @ vectors.T
        own = np.arange(len(scores))
        scores[own, at + own] = -np.inf
        out[at:at + SLICE_QUERIES] = np.partition(scores, n - k, axis=1)[:, n - k]
    return out


class Best:
    """The k best (score, id, row) of every query; equal scores go to the smaller id, null ids last."""

    def __init__(self, need: np.ndarray, k: int):
        self.k = k
        self.need = need.copy()
        self.held: tuple[np.ndarray, ...] | None = None

    def add(self, *found: np.ndarray) -> None:
        """``found``: query, score, null id, id, row of new vectors."""
        all_ = [np.concatenate(pair) for pair in zip(self.held, found)] if self.held else list(found)
        query, score, null, ids, rows = all_
        if score.dtype == object:
            order = np.array(sorted(range(len(query)), key=lambda i: (query[i], -score[i], null[i], ids[i], rows[i])), np.int64)
        else:
            order = np.lexsort((rows, ids, null, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        order, rank = order[rank < self.k], rank[rank < self.k]
        self.held = tuple(x[order] for x in all_)
        full = rank == self.k - 1
        at = self.held[0][full]
        if self.held[1].dtype == object:
            self.need = self.need.astype(object)
        self.need[at] = np.maximum(self.need[at], self.held[1][full])


def search(best: Best, queries: np.ndarray, asking: np.ndarray, vectors: np.ndarray, ids: np.ndarray, null: np.ndarray, rows: np.ndarray) -> None:
    """Score one shard of ``vectors`` for all ``queries`` (their own row numbers are ``asking``)."""
    width = max(queries.shape[1], vectors.shape[1])
    queries, lists = widened(queries, width), widened(vectors, width).T.copy()
    if (np.abs(queries) @ np.abs(lists).max(axis=1)).max(initial=0) >= EXACT:
        queries, lists = whole_numbers(queries), whole_numbers(lists)
    high, low = lists.max(axis=1), lists.min(axis=1)
    for at in range(0, len(queries), SLICE_QUERIES):
        part = queries[at:at + SLICE_QUERIES]
        need = best.need[at:at + SLICE_QUERIES]
        bounds = np.maximum(part * high, part * low)
        order = np.argsort(bounds, axis=1, kind="stable")
        # sums[i, j]: what the j lists of least bound can add together
        sums = np.concatenate((np.zeros((len(part), 1), bounds.dtype), np.cumsum(np.take_along_axis(bounds, order, 1), axis=1)), axis=1)
        beside = (np.maximum.accumulate(sums[:, 1:], axis=1) < need[:, None]).sum(axis=1)
        essential = part.copy()
        np.put_along_axis(essential, order, np.where(np.arange(width) < beside[:, None], 0, np.take_along_axis(part, order, 1)), 1)
        scores = essential @ lists
        if scores.shape[1] > best.k and (need == -np.inf).any():
            # nothing is known of these queries yet: all lists were essential, so the scores are whole
            new = need == -np.inf
            need = need.astype(scores.dtype) if scores.dtype == object else need.copy()
            need[new] = np.sort(scores[new], axis=1)[:, -best.k - 1]  # one more, as the query itself may be among them
        rest = np.take_along_axis(sums, beside[:, None], 1)
        query, vector = np.nonzero((scores + rest >= need[:, None]).astype(bool))
        other = asking[at + query] != rows[vector]
        query, vector = query[other], vector[other]
        got, left = scores[query, vector], beside[query]
        while (left > 0).any():
            for k in range(1, STEP + 1):
                open_ = left >= k
                column = order[query[open_], left[open_] - k]
                got[open_] += part[query[open_], column] * lists[column, vector[open_]]
            left = np.maximum(left - STEP, 0)
            fits = (got + sums[query, left] >= need[query]).astype(bool)
            query, vector, got, left = query[fits], vector[fits], got[fits], left[fits]
        best.add(at + query, got, null[vector], ids[vector], rows[vector])


def scan(rows: DataFrame, block: pa.Table, k: int) -> DataFrame:
    """(query, query_id, vec_id, row, score): each task's best ``k`` for every query of ``block`` (row, vec_id, vector)."""
    vectors = matrix(block.column("vector").combine_chunks())
    shared = rows.sparkSession.sparkContext.broadcast(
        (vectors, block.column("row").to_numpy(), block.column("vec_id").to_numpy(), seed(vectors, k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, asking, names, need = shared.value
        best = Best(need, k)
        held: list[pa.RecordBatch] = []

        def close() -> None:
            shard = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            name = shard.column(1).combine_chunks()
            search(best, queries, asking, matrix(shard.column(2).combine_chunks()), name.fill_null(0).to_numpy(),
                   name.is_null().to_numpy(zero_copy_only=False), shard.column(0).to_numpy())

        for batch in batches:
            for at in range(0, len(batch), SHARD_ROWS):
                held.append(batch.slice(at, SHARD_ROWS))
                if sum(map(len, held)) >= SHARD_ROWS:
                    close()
        if held:
            close()
        if best.held:
            query, score, null, ids, own = best.held
            yield pa.RecordBatch.from_arrays(
                [pa.array(asking[query]), pa.array(names[query]), pa.array(ids, mask=null), pa.array(own),
                 pa.array([int(s) for s in score], pa.int64())], names=["query", "query_id", "vec_id", "row", "score"])

    return rows.select("row", "vec_id", "vector").mapInArrow(run, "query long, query_id long, vec_id long, row long, score long")


def top_k(vectors: DataFrame, asks: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of every row where ``asks`` holds.

    Components count as floor(1024 * x); the score is the integer inner product, the shorter vector
    padded with zeros; a score beyond 64 bits is an error. Rows whose vector is null or holds a null
    or non-finite component take no part, an empty vector scores 0. Ties go to the smaller id, null
    ids last. A query's own row is left out by its place in the table: rows that repeat an id are
    candidates of each other, and each of them is a query of its own. Empty tables give no rows.

    Queries go through in blocks of bounded size, one broadcast at a time; every block reads the
    vectors once, without a shuffle. What is merged is k rows a query and task, less those that
    the query block itself shows to be too low.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"),
                           F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = stored(named.where(usable(F.col("vector"))).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asking = rows.where("asks")
    size = asking.agg(F.sum(F.size("vector") + 1).alias("n")).first().n or 0
    blocks = max(1, -(-size // BLOCK_COMPONENTS))
    path = scratch(spark, "best")
    for b in range(blocks):
        block = asking.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "vec_id", "vector").toArrow()
        scan(rows, block, k).write.mode("overwrite").parquet(f"{path}/block={b}")
    best = spark.read.schema("query long, query_id long, vec_id long, row long, score long, block int").parquet(path)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), F.col("vec_id") % 100 == 0)
