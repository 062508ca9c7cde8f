"""MinHash near-dedup with sequential Bayesian verification.

Documents with equal shingle sets form classes; one signature per class is banded. Candidates
within a bucket are compared signature batch by signature batch: a pair is pruned as soon as the
posterior probability of a similarity at or above the threshold falls below the chosen miss
probability. Survivors are verified on their full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.llm.common import byte_objects, fresh_name, stored, table
from homestat.llm.graph import components

WORDS = 5
#: Link at 100 * intersection >= 75 * union.
PERCENT = 75
#: 28 bands of 4 rows: a pair at the threshold shares no band with probability 2.4e-5.
BANDS, ROWS = 28, 4
#: Further hashes, one byte each, for the sequential test in batches of 16.
CHECKS, BATCH = 64, 16
#: Chance that a pair at or above the threshold is pruned in one batch.
MISS = 1e-6
SLICE_ROWS = 2000
#: Shingles in a chunk of a large bucket; a task holds two chunks at once.
BLOCK_SHINGLES = 500_000
MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


@lru_cache
def constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers of the shingle hash, and multipliers and offsets of the minhash functions."""
    own = np.random.Generator(np.random.PCG64(9))
    return (own.integers(1, 2**63, WORDS + 1, np.uint64) * np.uint64(2) + np.uint64(1),
            own.integers(0, 2**31, BANDS * ROWS + CHECKS, np.uint32) * np.uint32(2) + np.uint32(1),
            own.integers(0, 2**32, BANDS * ROWS + CHECKS, np.uint32))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX1
    x = (x ^ (x >> np.uint64(29))) * MIX2
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text; empty without words."""
    import xxhash

    factor = constants()[0]
    for at in range(0, len(texts), SLICE_ROWS):
        part = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.slice(at, SLICE_ROWS), "")))
        split = pc.ascii_split_whitespace(part)
        words = split.flatten().dictionary_encode()
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in byte_objects(words.dictionary)], np.uint64)
        blank = pc.equal(part, "").to_numpy(zero_copy_only=False)
        each = hashes[words.indices.to_numpy()] if len(hashes) else np.zeros(0, np.uint64)
        full = np.zeros(max(0, len(each) - WORDS + 1), np.uint64)
        for k in range(WORDS):
            full += each[k:k + len(full)] * factor[k]
        full = mix(full)
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        for i in range(len(part)):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if blank[i]:
                yield full[:0]
            elif b - a < WORDS:  # the whole sequence is one shingle, unlike any of five words
                yield mix((each[a:b] * factor[:b - a]).sum(dtype=np.uint64, keepdims=True) + factor[WORDS:] * np.uint64(b - a))
            else:
                yield np.unique(full[a:b - WORDS + 1])


def minima(shingles: np.ndarray) -> np.ndarray:
    _, a, b = constants()
    low = shingles.astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 4096):
        out = np.minimum(out, (a[:, None] * low[None, k:k + 4096] + b[:, None]).min(axis=1))
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    factor = constants()[0]
    rows = mins[:BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    keys = (rows * factor[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * factor[WORDS]
    return mix(keys).view(np.int64)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes(), usedforsecurity=False).digest()


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, n, set_key, bands, checks) of every row; the last three are null without words or id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            n, keys, bands, checks = [], [], [], []
            for name, s in zip(ids, shingle_sets(batch.column(1))):
                n.append(len(s))
                if not len(s) or name is None:
                    keys.append(None), bands.append(None), checks.append(None)
                    continue
                mins = minima(s)
                keys.append(set_key(s))
                bands.append(band_keys(mins))
                checks.append((mins[BANDS * ROWS:] & 0xFF).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(checks, pa.binary())],
                names=["doc", "n", "set_key", "bands", "checks"])

    return docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "doc long, n long, set_key binary, bands array<long>, checks binary")


@lru_cache
def least_matches(threshold: float = PERCENT / 100, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """(hashes compared, fewest matches not pruned) after each batch.

    One-byte hashes agree with probability s = j + (1 - j) / 256. With a flat prior on j, the
    posterior of j after m matches among n hashes is proportional to s^m (1 - s)^(n - m).
    """
    j = (np.arange(20_000) + 0.5) / 20_000
    s = j + (1 - j) / 256
    out = []
    for n in range(BATCH, CHECKS + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log1p(-s)
            weight = np.exp(log - log.max())
            if weight[j >= threshold].sum() >= miss * weight.sum():
                out.append((n, m))
                break
    return tuple(out)


def not_pruned(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which rows of two check arrays (pairs x CHECKS bytes) survive all batches."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for n, least in least_matches():
        matches = matches + (left[alive, n - BATCH:n] == right[alive, n - BATCH:n]).sum(axis=1)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
    return alive


def surviving(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) that the size bound and the sequential test leave."""
    side = lambda c: classes.select(F.col("doc").alias(c), F.col("n").alias(f"n{c}"), F.col("checks").alias(f"s{c}"))
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * small >= PERCENT * large)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, CHECKS) for k in (2, 3))
            yield batch.select([0, 1]).take(pa.array(not_pruned(left, right)))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def full_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, by: str = "doc") -> DataFrame:
    """(doc, shingles) of the wanted classes (doc, set_key), made again from the text; ``by`` has the id of a row with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sets = [], []
            for name, key, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(batch.column(2))):
                if set_key(s) == key:  # another row may have the same id and another text
                    names.append(name)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], names=["doc", "shingles"])

    texts = docs.select(F.col(doc_id).cast("long").alias(by), F.col(text).cast("string").alias("text"))
    rows = wanted.join(texts, by).select("doc", "set_key", "text")
    return rows.mapInArrow(run, "doc long, shingles binary")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(len(batch)):
                left, right = (np.frombuffer(batch.column(k)[i].as_buffer(), np.uint64) for k in (2, 3))
                common = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * common >= PERCENT * (len(left) + len(right) - common):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    side = lambda c: sets.select(F.col("doc").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def group_links(docs: list[int], parts: list[int], chunks: list[int], checks: np.ndarray,
                sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join parts of one block: pairs of different parts (and, in a block of two chunks, of
    different chunks) through the sequential test, survivors on their full sets. Pairs that earlier
    links have joined already are left out, so there are fewer links than rows."""
    n = len(docs)
    order = {p: i for i, p in enumerate(dict.fromkeys(parts))}
    root = np.array([order[p] for p in parts])
    chunk = np.array(chunks)
    split = len(set(chunks)) > 1
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    by_value = np.argsort(values, kind="stable")
    values, owner = values[by_value], np.repeat(np.arange(n), sizes)[by_value]
    out = []
    for a in range(n - 1):
        other = np.arange(a + 1, n)
        mask = root[other] != root[a]
        mask &= 100 * np.minimum(sizes[other], sizes[a]) >= PERCENT * np.maximum(sizes[other], sizes[a])
        if split:
            mask &= chunk[other] != chunk[a]
        other = other[mask]
        if not len(other):
            continue
        other = other[not_pruned(np.broadcast_to(checks[a], (len(other), CHECKS)), checks[other])]
        if not len(other):
            continue
        low, high = np.searchsorted(values, sets[a], "left"), np.searchsorted(values, sets[a], "right")
        spans = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(spans)[:-1])), spans) + np.arange(spans.sum())
        common = np.bincount(owner[at], minlength=n)[other]
        for x in other[100 * common >= PERCENT * (sizes[a] + sizes[other] - common)].tolist():
            if root[x] != root[a]:
                out.append((min(docs[a], docs[x]), max(docs[a], docs[x])))
                root[root == root[x]] = root[a]
    return out


def block_links(members: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between different parts of the buckets in ``members`` (key, doc, part).

    A bucket is cut into blocks of bounded size by the shingles it holds: each pair of its chunks
    is a block, and blocks are spread over the tasks. Blocks are compared inside the task; what
    comes out grows with the members, not with their pairs.
    """
    weighed = members.join(classes.select("doc", "n", "checks"), "doc")
    blocks = weighed.groupBy("key").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = weighed.join(blocks, "key").withColumn("chunk", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = spread.select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                         "doc", "part", "chunk", "checks").join(sets, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, group, found = None, [], []

        def close():
            if len({g[1] for g in group}) > 1:
                checks = np.frombuffer(b"".join(g[3] for g in group), np.uint8).reshape(-1, CHECKS)
                found.extend(group_links([g[0] for g in group], [g[1] for g in group], [g[2] for g in group], checks,
                                         [np.frombuffer(g[4], np.uint64) for g in group]))
            group.clear()

        def flush():
            pairs = list(zip(*found)) or [[], []]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in pairs], names=["a", "b"])

        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in range(8)]):
                if row[:3] != block:
                    close()
                    block = row[:3]
                if not group or group[-1][0] != row[3]:  # a document stands in its bucket once
                    group.append(row[3:])
            yield flush()
        close()
        yield flush()

    grouped = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "doc")
    return grouped.select("key", "i", "j", "doc", "part", "chunk", "checks", "shingles").mapInArrow(run, "a long, b long").distinct()


def near_links(docs: DataFrame, classes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Links (a, b) between ids of classes, enough of them to join all classes that are alike.

    ``doc`` is a class's number, ``id`` its smallest id. First every bucket member is compared with
    the bucket's smallest class, so large groups of near copies cost one pair a member. Buckets of
    three and more whose members these links tie to different classes are compared in blocks.
    """
    keyed = classes.select(F.explode("bands").alias("key"), "doc")
    # aggregates are written before they are joined: Spark can then split the rows of a hot key, or
    # broadcast a table that it sees is small without dealing out the other side first
    firsts = stored(keyed.groupBy("key").agg(F.min("doc").alias("first"), F.count("*").alias("size")).where("size > 1"), "firsts")
    members = stored(keyed.join(firsts, "key"), "buckets")
    pairs = members.where(F.col("doc") != F.col("first")).select(F.col("first").alias("a"), F.col("doc").alias("b")).distinct()
    left = stored(surviving(pairs, classes), "survivors")
    # one pass over the texts makes the sets of both steps
    involved = left.select(F.col("a").alias("doc")).union(left.select("b")).union(members.where("size > 2").select("doc")).distinct()
    wanted = involved.join(classes.select("doc", "id", "set_key"), "doc")
    sets = stored(full_sets(docs, wanted, doc_id, text, "id").dropDuplicates(["doc"]), "sets")
    links = stored(linked(left, sets), "links")
    star = links.groupBy("b").agg(F.min("a").alias("part")).select(F.col("b").alias("doc"), "part")
    parts = stored(members.where("size > 2").select("key", "doc").join(star, "doc", "left").select(
        "key", "doc", F.coalesce("part", "doc").alias("part")), "parts")
    mixed = stored(parts.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key"), "mixed")
    still = stored(parts.join(mixed, "key"), "open-buckets")
    found = links.unionByName(stored(block_links(still, classes, sets), "block-links"))
    name = lambda c, to: classes.select(F.col("doc").alias(c), F.col("id").alias(to))
    return found.join(name("a", "ia"), "a").join(name("b", "ib"), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Null and empty texts, and texts without words, have no shingles and are linked with nothing.
    Rows that share an id are one document: their links are joined. A row without an id cannot
    be named in a component; it is kept, with a null component. Empty tables give no rows.
    """
    rows = stored(signatures(docs, doc_id, text), "signatures")
    with_set = rows.where(F.col("set_key").isNotNull())
    # one row per class of equal sets, folded in the map tasks first, so that a large group of copies is no
    # hot key. Classes go by a number, as several classes may have the same smallest id
    classes = stored(with_set.groupBy("set_key").agg(
        F.min("doc").alias("id"), F.max("doc").alias("last"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("checks").alias("checks")).withColumn("doc", F.monotonically_increasing_id()), "classes")
    links = near_links(docs, classes, doc_id, text)
    # the graph's nodes are ids: a class ties its rows to its smallest id, and an id ties its rows' classes
    copies = with_set.select("set_key", F.col("doc").alias("b")).join(
        classes.where("id < last").select("set_key", F.col("id").alias("a")), "set_key").select("a", "b")
    roots = components(links.unionByName(copies))
    out = rows.select("doc", "n").join(roots.withColumnRenamed("node", "doc"), "doc", "left")
    component = F.coalesce("root", "doc")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id. Rows without id stay."""
    gone = near_duplicates(docs, doc_id, text).where(~F.col("kept")).select(F.col("doc_id").alias(fresh_name(docs, "_gone"))).distinct()
    return docs.join(gone, docs[doc_id].cast("long") == F.col(gone.columns[0]), "left_anti")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", ["doc_id", "text"]))
