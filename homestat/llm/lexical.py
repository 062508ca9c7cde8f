"""Ranked lexical search by the Best Position Algorithm.

Each shard of documents keeps one impact list per query term: its postings, highest contribution
first. For an item, positions are read list by list; every document met is scored at once by
direct accesses to all of the item's lists, and the positions where it stands there are marked as
seen. A list's best position is the last one up to which all are seen, often well beyond the last
one read. No unseen document can add up to more than the next positions of all lists together, so
the item is done once that sum is strictly below its k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homestat.llm.common import WORD_BYTES, byte_rows, in_slices, ranges, scratch, stored, table, words_in_order

K = 50
#: Terms of the items that go through at once; a larger set of items goes through in blocks.
BLOCK_TERMS = 500_000
#: Text bytes split into words at once, and postings of a shard.
SLICE_BYTES, SHARD_POSTINGS = 4_000_000, 1_000_000
#: Positions read in each list between two looks at the threshold.
STEP = 64
SHOWN = np.frombuffer(WORD_BYTES, np.uint8)
KINDS = (SHOWN == 32).astype(np.uint8)
HITS = "doc_id long, n long, terms array<int>, tf array<int>"
FOUND = "item int, doc_id long, score long"


def hits(docs: DataFrame, vocabulary: list[bytes], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, tf) of every document with a word: its length and the query terms it holds."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.large_binary())
        for whole in batches:
            for batch in in_slices(whole, 1, SLICE_BYTES):
                words, row, _ = words_in_order(byte_rows(batch.column(1)), KINDS, SHOWN)
                n = np.bincount(row, minlength=len(batch))
                coded = words.dictionary_encode()
                term = pc.index_in(coded.dictionary, known).fill_null(-1).to_numpy()[coded.indices.to_numpy()]
                held = term >= 0
                pairs, tf = np.unique(row[held] * len(known) + term[held], return_counts=True)
                own, term = pairs // max(1, len(known)), pairs % max(1, len(known))
                some = n > 0
                sizes = np.bincount(own, minlength=len(batch))[some]
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(pa.array(some)), pa.array(n[some]), pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))], names=["doc_id", "n", "terms", "tf"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, HITS)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, row, terms) of every item with a word; each term once, whatever its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(set((t or b"").translate(WORD_BYTES).split())) for t in byte_rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.binary()))], names=["item_id", "terms"])

    kind = items.schema[item_id].dataType.simpleString()
    named = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    found = named.mapInArrow(run, f"item_id {kind}, terms array<binary>").where(F.size("terms") > 0)
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "item-terms")


@dataclass
class Shard:
    """Postings of some documents, by document (``start``) and, in ``order``, by term and impact.

    ``place`` is each posting's position in its term's list, ``list_start`` where the lists begin.
    """

    docs: np.ndarray
    null: np.ndarray
    start: np.ndarray
    term: np.ndarray
    impact: np.ndarray
    owner: np.ndarray
    order: np.ndarray
    place: np.ndarray
    list_start: np.ndarray

    @classmethod
    def of(cls, batch: pa.Table, weight: np.ndarray, n_docs: int, n_words: int) -> Shard:
        names, lists, counts = (batch.column(c).combine_chunks() for c in ("doc_id", "terms", "tf"))
        n = batch.column("n").to_numpy()
        m = 50 + 50 * n * n_docs // n_words
        sizes = np.diff(lists.offsets.to_numpy())
        term, tf = lists.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(n)), sizes)
        impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[owner]))
        some = impact > 0
        term, impact, owner = term[some], impact[some], owner[some]
        order = np.lexsort((-impact, term))
        list_start = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(weight)))))
        place = np.empty(len(term), np.int64)
        place[order] = np.arange(len(term)) - list_start[term[order]]
        start = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(n)))))
        return cls(names.fill_null(0).to_numpy(), names.is_null().to_numpy(zero_copy_only=False), start, term, impact, owner, order, place, list_start)


def best_positions(shard: Shard, terms: np.ndarray, list_of: np.ndarray, k: int, need: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, positions read) of the documents met before the threshold falls below the k-th score.

    ``list_of`` maps all terms to -1 and is put back so. At least ``need`` is asked of a score (the
    item's k-th score so far, elsewhere).
    """
    terms = terms[shard.list_start[terms + 1] > shard.list_start[terms]]
    first = shard.list_start[terms]
    sizes = shard.list_start[terms + 1] - first
    ends = np.cumsum(sizes)
    base = ends - sizes
    list_of[terms] = np.arange(len(terms))
    seen = np.zeros(ends[-1] if len(ends) else 0, bool)
    met = np.zeros(len(shard.docs), bool)
    best = np.zeros(len(terms), np.int64)
    docs, scores, reads = [], [], 0
    while True:
        open_ = np.flatnonzero(best < sizes)
        rest = int(shard.impact[shard.order[first[open_] + best[open_]]].sum())
        if not rest or rest < need:
            break
        run = np.minimum(STEP, sizes[open_] - best[open_])
        at = ranges(first[open_] + best[open_], run)
        reads += len(at)
        new = np.unique(shard.owner[shard.order[at]])
        new = new[~met[new]]
        met[new] = True
        # direct accesses: all postings of the documents met, in whichever of the item's lists they stand
        held = shard.start[new + 1] - shard.start[new]
        posting = ranges(shard.start[new], held)
        which = list_of[shard.term[posting]]
        of_item = which >= 0
        posting, which = posting[of_item], which[of_item]
        total = np.zeros(len(new), np.int64)
        np.add.at(total, np.repeat(np.arange(len(new)), held)[of_item], shard.impact[posting])
        seen[base[which] + shard.place[posting]] = True
        docs.append(new)
        scores.append(total)
        for j in open_.tolist():
            left = seen[base[j] + best[j]:ends[j]]
            gap = int(left.argmin())
            best[j] += len(left) if left[gap] else gap
        if sum(map(len, scores)) >= k:
            top = np.concatenate(scores)
            need = max(need, int(np.partition(top, len(top) - k)[len(top) - k]))
    list_of[terms] = -1
    return np.concatenate(docs) if docs else met[:0].astype(np.int64), np.concatenate(scores) if scores else best[:0], reads


def ranked(hit: DataFrame, items: list[np.ndarray], weight: np.ndarray, n_docs: int, n_words: int, k: int) -> DataFrame:
    """(item, doc_id, score): each task's ``k`` best documents of every item."""
    shared = hit.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weights = shared.value
        list_of = np.full(len(weights), -1, np.int64)
        top: list[tuple] = [(np.zeros(0, np.int64),) * 3] * len(wanted)
        held: list[pa.RecordBatch] = []

        def close() -> None:
            shard = Shard.of(pa.Table.from_batches(held).combine_chunks(), weights, n_docs, n_words)
            held.clear()
            for i, terms in enumerate(wanted):
                need = int(top[i][0][k - 1]) if len(top[i][0]) == k else 0
                docs, scores, _ = best_positions(shard, terms, list_of, k, need)
                docs, scores = docs[scores >= need], scores[scores >= need]
                both = [np.concatenate(p) for p in zip(top[i], (scores, shard.null[docs].astype(np.int64), shard.docs[docs]))]
                order = np.lexsort((both[2], both[1], -both[0]))[:k]
                top[i] = tuple(x[order] for x in both)

        def postings(batch: pa.RecordBatch) -> int:
            return len(batch.column(2).flatten()) + len(batch)

        size = 0
        for batch in batches:
            held.append(batch)
            size += postings(batch)
            if size >= SHARD_POSTINGS:
                close()
                size = 0
        if held:
            close()
        for i, (scores, null, docs) in enumerate(top):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), i), pa.int32()), pa.array(docs, mask=null.astype(bool)),
                                                  pa.array(scores)], names=["item", "doc_id", "score"])

    return hit.mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest positive score for every item.

    Terms are the runs of letters and digits (ASCII marks separate, A-Z lower-cased) of whole texts;
    null and empty texts have none. Scores are integers: a term weighs floor(1000 ln((2N+2)/(2df+1))),
    its frequency saturates and is held against the document's length. Equal scores go by document id,
    null ids last. Every row of ``docs`` is a document, every row of ``items`` an item, also where ids
    repeat. Empty tables give no rows.

    Items go through in blocks of bounded size. The texts are read once a block; what is kept of them
    are the postings of the block's terms, which also give the term statistics. No text is shuffled.
    """
    spark = docs.sparkSession
    asked = item_terms(items, item_id, item_text)
    size = asked.agg(F.sum(F.size("terms")).alias("n")).first().n or 0
    blocks = max(1, -(-size // BLOCK_TERMS))
    path = scratch(spark, "ranked")
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "terms").collect()
        vocabulary = sorted({bytes(t) for r in block for t in r.terms})
        number = {t: i for i, t in enumerate(vocabulary)}
        hit = stored(hits(docs, vocabulary, doc_id, text), "hits")
        total = hit.agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
        held = {r.term: r["count"] for r in hit.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
        df = np.array([held.get(i, 0) for i in range(len(vocabulary))], np.int64)
        weight = np.floor(1000 * np.log((2 * total.docs + 2) / (2 * df + 1))).astype(np.int64)
        wanted = [np.array([number[bytes(t)] for t in r.terms], np.int64) for r in block]
        found = ranked(hit, wanted, weight, total.docs, total.words or 1, k)
        rows = spark.createDataFrame([(i, r.row) for i, r in enumerate(block)], "item int, row long")
        found.join(F.broadcast(rows), "item").select("row", "doc_id", "score").write.mode("overwrite").parquet(f"{path}/block={b}")
    found = spark.read.schema("row long, doc_id long, score long, block int").parquet(path)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents", ["doc_id", "text"]), table(spark, sf_dir, "benchmark", ["item_id", "text"]))
