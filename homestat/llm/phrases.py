"""Phrase collocation mining with stripes.

A prefix word keys one stripe: an associative counter of its next words, each with the counter of
the words after that. Tasks count stripes for slices of the texts, equal stripes are merged
elementwise, and one merged stripe gives the word's total, its extensions by one and two words
and the most frequent extension of each. Stripes travel in buckets of many prefixes; those of
words so frequent that they would weigh on one task are cut by the hash of the words that follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homestat.llm.common import byte_objects, byte_rows, ranges, stored, table, words_in_order

LEAST, PERCENT, K = 10, 50, 2000
NO_LANGUAGE = "und"
#: Text bytes counted into stripes at once, and stripe entries merged at once.
SLICE_BYTES, MERGE_ENTRIES = 8_000_000, 400_000
#: Words of the texts that one bucket holds; also the occurrences in one slice of a frequent
#: word's stripe, unless this share of all words is more.
BUCKET_WORDS, SLICE_SHARE = 200_000, 1 / 100_000
#: Groups of a language whose best phrases are taken before those of the language.
TOP_GROUPS = 256
#: Bytes that end a piece, bytes that separate words within it.
PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"
KINDS = np.array([2 if b in PIECE_ENDS else 1 if b in BLANKS else 0 for b in range(256)], np.uint8)
SHOWN = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

STRIPES = ("lang string, bucket long, word string, sizes binary, ends binary, next string, counts binary, fans binary, "
           "after string, after_counts binary")
COUNTS = "lang string, w1 string, w2 string, w3 string, f long, most long"


def text_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes | None]]]:
    """(languages, texts) of rows that together hold about SLICE_BYTES; a longer text is a run of its own."""
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), byte_rows(batch.column(1))):
            langs.append(lang)
            texts.append(text)
            size += len(text or b"")
            if size >= SLICE_BYTES:
                yield langs, texts
                langs, texts, size = [], [], 0
    if texts:
        yield langs, texts


class Tokens:
    """The words of some texts: ``word`` numbers into ``words``, ``lang`` numbers into ``langs``."""

    def __init__(self, langs: list[str], texts: list[bytes | None]):
        found, row, self.piece = words_in_order(texts, KINDS, SHOWN)
        coded = found.dictionary_encode()
        self.words = coded.dictionary.cast(pa.binary()).cast(pa.string())
        self.word = coded.indices.to_numpy().astype(np.int64)
        self.langs, number = np.unique(np.array(langs, object), return_inverse=True)
        self.lang = number[row]


def frequent_words(docs: DataFrame) -> tuple[int, dict[tuple[str, str], int]]:
    """(buckets, slices of the stripe of every (language, word) that needs more than one).

    Words below the share in all slices of text are not counted: they can need only one slice. What
    reaches the driver is bounded: at most 1 / SLICE_SHARE words. The results do not depend on it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in text_runs(batches):
            t = Tokens(langs, texts)
            keys, n = np.unique(t.lang * max(1, len(t.words)) + t.word, return_counts=True)
            keys, n = keys[n >= SLICE_SHARE * len(t.word)], n[n >= SLICE_SHARE * len(t.word)]
            lang = [None, *t.langs[keys // max(1, len(t.words))]]
            word = pa.concat_arrays([pa.array([None], pa.string()), t.words.take(pa.array(keys % max(1, len(t.words))))])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), word, pa.array(np.concatenate(([len(t.word)], n)), pa.int64())],
                                             names=["lang", "word", "n"])

    counts = stored(docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "frequent")
    total = counts.where("word is null").agg(F.sum("n").alias("n")).first().n or 0
    room = max(BUCKET_WORDS, total * SLICE_SHARE)
    found = counts.where(F.col("word").isNotNull() & (F.col("n") > room)).collect()
    return max(1, -(-total // BUCKET_WORDS)), {(r.lang, r.word): int(-(-r.n // room)) for r in found}


def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value of little-endian 32-bit numbers per run of ``values``."""
    data = pa.py_buffer(np.ascontiguousarray(values.astype("<u4")))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((4 * bounds).astype(np.int32)), data])


def joined(words: pa.Array, codes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One string of the blank-joined words per run of ``codes``."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.take(pa.array(codes))), " ")


def stripe_rows(t: Tokens, key: np.ndarray, bucket: np.ndarray, word: np.ndarray, count: np.ndarray, fan: np.ndarray,
                after: np.ndarray, after_count: np.ndarray) -> pa.RecordBatch:
    """Stripes of entries that are sorted by (language, bucket, key): a row per language and bucket.

    A key is a language and a word; an entry's next word ``len(words)`` is a piece's end.
    """
    size = len(t.words)
    lang = key // size
    new_row = (np.diff(lang, prepend=-1) != 0) | (np.diff(bucket, prepend=-1) != 0)
    new_key = new_row | (np.diff(key, prepend=-1) != 0)
    keys, first = np.flatnonzero(new_key), np.flatnonzero(new_row)
    is_end = word == size
    ends = np.add.reduceat(np.where(is_end, count, 0), keys) if len(keys) else count[:0]
    at_key = lambda total: total[np.append(keys, len(key))]
    at_row = lambda total: total[np.append(first, len(key))]
    nexts, fans = np.concatenate(([0], np.cumsum(~is_end))), np.concatenate(([0], np.cumsum(fan)))
    heads = np.concatenate(([0], np.cumsum(new_key)))
    return pa.RecordBatch.from_arrays(
        [pa.array(t.langs[lang[first]], pa.string()), pa.array(bucket[first]), joined(t.words, key[keys] % size, at_row(heads)),
         packed(np.diff(at_key(nexts)), at_row(heads)), packed(ends, at_row(heads)),
         joined(t.words, word[~is_end], at_row(nexts)), packed(count[~is_end], at_row(nexts)), packed(fan[~is_end], at_row(nexts)),
         joined(t.words, after, at_row(fans)), packed(after_count, at_row(fans))],
        names=["lang", "bucket", "word", "sizes", "ends", "next", "counts", "fans", "after", "after_counts"])


def count_stripes(langs: list[str], texts: list[bytes | None], buckets: int, slices: dict[tuple[str, str], int]) -> Iterator[pa.RecordBatch]:
    """The stripes of some texts."""
    import xxhash

    t = Tokens(langs, texts)
    size = len(t.words)
    if not size:
        return
    follows = t.piece[1:] == t.piece[:-1]
    after_next = follows[1:] & follows[:-1]
    second = np.append(np.where(follows, t.word[1:], size), size)
    pairs, which, count = np.unique((t.lang * size + t.word) * (size + 1) + second, return_inverse=True, return_counts=True)
    at = np.flatnonzero(after_next)
    triples, after_count = np.unique(which[at] * size + t.word[at + 2], return_counts=True)
    of_pair, after = triples // size, triples % size
    del which, second, follows, after_next, at, triples
    key, word = pairs // (size + 1), pairs % (size + 1)
    fan = np.bincount(of_pair, minlength=len(pairs))
    hashes = np.array([xxhash.xxh3_64_intdigest(w) >> 8 for w in byte_objects(t.words)] + [0], np.int64)
    # slices of the stripes of frequent words
    many = np.ones(len(t.langs) * size, np.int64)
    number = {lang: i for i, lang in enumerate(t.langs)}
    names = [(number[lang] * size, w, n) for (lang, w), n in slices.items() if lang in number]
    codes = pc.index_in(pa.array([w for _, w, _ in names], pa.string()), t.words).fill_null(-1).to_numpy() if names else []
    for (base, _, n), code in zip(names, codes):
        if code >= 0:
            many[base + code] = n
    wide = many[key] > 1
    slim = ~wide[of_pair]
    bucket = hashes[key % size] % buckets
    order = np.flatnonzero(~wide)
    order = order[np.lexsort((bucket[order], key[order] // size))]
    starts = np.cumsum(fan) - fan
    run = ranges(starts[order], fan[order])
    yield stripe_rows(t, key[order], bucket[order], word[order], count[order], fan[order], after[run], after_count[run])
    if not wide.any():
        return
    # the words after a frequent word are dealt to its slices; those after a frequent pair, too
    home = hashes[word] % many[key]
    both = wide & (many[(key // size) * size + np.minimum(word, size - 1)] > 1) & (word < size)
    pair, third, n3 = of_pair[~slim], after[~slim], after_count[~slim]
    place = np.where(both[pair], (hashes[word[pair]] // 7 + hashes[third]) % many[key[pair]], home[pair])
    at = np.flatnonzero(wide)
    all_key, all_place = np.concatenate((key[at], key[pair])), np.concatenate((home[at], place))
    all_bucket = (bucket[np.concatenate((at, pair))] + all_place) % buckets
    all_word, all_third = np.concatenate((word[at], word[pair])), np.concatenate((np.full(len(at), -1), third))
    all_count = np.concatenate((count[at], n3))
    order = np.lexsort((all_third, all_word, all_key, all_bucket, all_key // size))
    all_key, all_bucket, all_word, all_third, all_count = (x[order] for x in (all_key, all_bucket, all_word, all_third, all_count))
    first = np.flatnonzero(np.diff(all_key, prepend=-1) | np.diff(all_bucket, prepend=-1) | np.diff(all_word, prepend=-1))
    is_third = all_third >= 0
    yield stripe_rows(t, all_key[first], all_bucket[first], all_word[first], np.add.reduceat(np.where(is_third, 0, all_count), first),
                      np.add.reduceat(is_third.astype(np.int64), first), all_third[is_third], all_count[is_third])


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, index of each key among them, sum of the counts of each)."""
    distinct, which = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, which, counts)
    return distinct, which, total


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, how many in each row) of a column of packed numbers."""
    return np.frombuffer(b"".join(byte_rows(column)), "<u4").astype(np.int64), pc.binary_length(column).to_numpy() // 4


def split(column: pa.Array, sizes: np.ndarray) -> pa.Array:
    """All words of a column of blank-joined words; a row without words is an empty string."""
    return pc.split_pattern(column.filter(pa.array(sizes > 0)), " ").flatten()


def merge_stripes(rows: pa.Table, least: int) -> pa.RecordBatch:
    """Totals, pairs and triples of stripes that are sorted by (lang, bucket), whole groups of them."""
    rows = rows.combine_chunks()
    column = lambda name: rows.column(name).combine_chunks()
    lang = column("lang")
    new = (np.diff(lang.dictionary_encode().indices.to_numpy(), prepend=-1) != 0) | (np.diff(column("bucket").to_numpy(), prepend=-1) != 0)
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    sizes, n_words = numbers(column("sizes"))
    counts, n_next = numbers(column("counts"))
    fans, _ = numbers(column("fans"))
    after_counts, n_after = numbers(column("after_counts"))
    every = pa.concat_arrays([split(column("word"), n_words), split(column("next"), n_next), split(column("after"), n_after)]).dictionary_encode()
    codes, size = every.indices.to_numpy().astype(np.int64), max(1, len(every.dictionary))
    head, second, third = np.split(codes, [len(sizes), len(sizes) + len(counts)])
    heads, of_head, total = summed(np.repeat(group, n_words) * size + head, numbers(column("ends"))[0])
    pairs, of_pair, f2 = summed(np.repeat(of_head, sizes) * size + second, counts)
    triples, _, f3 = summed(np.repeat(of_pair, fans) * size + third, after_counts)
    np.add.at(total, pairs // size, f2)
    triples, f3 = triples[f3 >= least], f3[f3 >= least]
    most = np.zeros(len(pairs), np.int64)
    np.maximum.at(most, triples // size, f3)
    good = np.flatnonzero((f2 >= least) | (most > 0))
    pair = triples // size
    words = every.dictionary
    of = np.concatenate((np.arange(len(heads)), pairs[good] // size, pairs[pair] // size))
    none = lambda n: pa.nulls(n, pa.string())
    return pa.RecordBatch.from_arrays(
        [lang.take(pa.array(first[heads[of] // size])), words.take(pa.array(heads[of] % size)),
         pa.concat_arrays([none(len(heads)), words.take(pa.array(pairs[good] % size)), words.take(pa.array(pairs[pair] % size))]),
         pa.concat_arrays([none(len(heads)), none(len(good)), words.take(pa.array(triples % size))]),
         pa.array(np.concatenate((total, f2[good], f3))), pa.array(np.concatenate((np.zeros(len(heads), np.int64), most[good], np.zeros(len(pair), np.int64))))],
        names=["lang", "w1", "w2", "w3", "f", "most"])


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted stripes in tables of about MERGE_ENTRIES entries that end with a bucket's last row."""
    held, entries = [], 0
    key = lambda b, i: (b.column(0)[i].as_py(), b.column(1)[i].as_py())
    for batch in batches:
        ends = np.cumsum((pc.binary_length(batch.column(6)).to_numpy() + pc.binary_length(batch.column(9)).to_numpy()) // 4 + 1)
        for i in range(len(batch)):
            if held and entries >= MERGE_ENTRIES and key(batch, i) != held[-1][1]:
                yield pa.Table.from_batches([b for b, _ in held])
                held, entries = [], 0
            held.append((batch.slice(i, 1), key(batch, i)))
            entries += int(ends[i] - (ends[i - 1] if i else 0))
    if held:
        yield pa.Table.from_batches([b for b, _ in held])


def stripes(docs: DataFrame, least: int) -> DataFrame:
    """(lang, w1, w2, w3, f, most) of ``docs`` (lang, text), from merged stripes.

    Rows without w2 hold part of the word's total; rows without w3 the pair's count and its most
    frequent extension, either 0 where another slice has it; the others the triple's count.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_words(docs))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in text_runs(batches):
            yield from count_stripes(langs, texts, *shared.value)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches):
            yield merge_stripes(rows, least)

    counted = docs.mapInArrow(count, STRIPES)
    dealt = counted.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
    return stored(dealt.mapInArrow(merge, COUNTS), "stripes")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exact."""
    whole = lambda c: f"cast({c} as decimal(19,0))"
    return F.expr(f"(cast({whole(a)} * {whole(a)} as decimal(38,0)) * 1000000) div cast({whole(left)} * {whole(right)} as decimal(38,0))")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, percent: int = PERCENT, k: int = K) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``k`` best phrases of two or three words.

    Words are the runs between blanks of the pieces between marks and line ends, A-Z lower-cased, of
    whole texts; null and empty texts have none, a null language counts as ``und``. A phrase that
    occurs ``least`` times is scored at its weakest cut and goes if a longer such phrase holds it in
    at least ``percent`` of 100 of its occurrences. Equal scores go by count, then by phrase. All
    rows count, also repeated ones. Other columns are not read. Empty tables give no rows.
    """
    plain = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).cast("string").alias("text"))
    counts = stripes(plain, least)
    words = stored(counts.where("w2 is null").groupBy("lang", "w1").agg(F.sum("f").alias("f")), "words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    words = words.where(F.col("f") >= least)
    pairs = stored(counts.where("w2 is not null and w3 is null").groupBy("lang", "w1", "w2").agg(F.sum("f").alias("a"), F.max("most").alias("most")), "pairs")
    triples = counts.where("w3 is not null").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))
    one = lambda c, f: words.select("lang", F.col("w1").alias(c), F.col("f").alias(f))
    two = lambda c, d, f: pairs.select("lang", F.col("w1").alias(c), F.col("w2").alias(d), F.col("a").alias(f))
    # a pair's extensions to the right are in its own stripe, those to the left end other stripes
    before = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("before"))
    free = pairs.join(before, ["lang", "w1", "w2"], "left").where(
        100 * F.greatest("most", F.coalesce("before", F.lit(0))) < percent * F.col("a"))
    of_two = free.join(one("w1", "l"), ["lang", "w1"]).join(one("w2", "r"), ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", score("a", "l", "r").alias("score"))
    cuts = triples.join(one("w1", "l1"), ["lang", "w1"]).join(two("w2", "w3", "r1"), ["lang", "w2", "w3"]) \
        .join(two("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(one("w3", "r2"), ["lang", "w3"])
    cuts = cuts.withColumns({"s1": score("a", "l1", "r1"), "s2": score("a", "l2", "r2")})
    first = F.col("s1") <= F.col("s2")
    of_three = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                           F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    best = ranked(ranked(of_two.unionByName(of_three), k, F.pmod(F.xxhash64("phrase"), F.lit(TOP_GROUPS))), k)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def ranked(phrases: DataFrame, k: int, *group: Column) -> DataFrame:
    """The ``k`` best phrases of each language, or of each group of it."""
    order = Window.partitionBy("lang", *group).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents", ["lang", "text"]))
