"""Sequence packing, shortest pack first over the length histogram.

Documents are tokenised once; each is cut into full sequences and a rest. Only the histogram of
piece lengths (at most ``size`` counters) reaches the driver, where lengths are placed longest
first into packing patterns with counts. The patterns are joined back to the pieces by their
rank within their length.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homestat.llm.common import byte_objects, stored, table

SIZE = 2048
END_ID = 1
#: Distinct text chunks in each of the two generations of a Python worker's memory.
CACHE_CHUNKS = 700_000
#: Rows whose chunks are looked up at once.
SLICE_ROWS = 2000
#: Last code points of the letters that take the short way (Latin), and of those that end a run of
#: letters before marks for sure (Latin, Greek and Cyrillic: letters to every version of Unicode).
LATIN_END, LETTER_END = "\u024f", "\u052f"
#: Texts that are encoded as a whole.
WHOLE = "<\\||\u0307"


def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkTokenizer(dict):
    """Token ids of whole texts, by way of their chunks between ASCII white space.

    The vocabulary lower-cases and never matches across white space, so a text's ids are those
    of its lower-cased chunks in order. Chunks repeat a lot: Arrow numbers the distinct ones of a
    slice of rows, and this dict (chunk -> its ids as bytes) remembers the latest generations of
    them, a bounded number. A text that may hold a special token is encoded as a whole, as is one
    with a combining dot: it makes another letter of a capital I than of a small one.
    """

    #: ASCII marks but the apostrophe, which some patterns join to letters
    MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.normal = self.tokenizer.normalizer
        self.letters = byte_letters()
        self.old: dict[bytes, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def chunk_ids(self, chunk: bytes) -> bytes:
        word = chunk.rstrip(self.MARKS)
        if word != chunk:
            # a run of letters ends before the marks
            return self[word] + self[chunk[len(word):]] if self.ends_in_letter(word) else self.encode(chunk.decode())
        if word.isalpha() and word.islower():
            shown = word.decode()
        else:
            plain = word.decode()
            if not (plain.isalpha() and max(plain) <= LATIN_END and plain == plain.lower()):
                return self.encode(plain)
            shown = word.decode("latin-1").translate(self.letters)
        # one run of lower-case composed letters is one word for the vocabulary's model
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def ends_in_letter(self, word: bytes) -> bool:
        """Whether the vocabulary sees a letter at the word's end: some letters decompose into one and a mark."""
        if word.isascii():
            return word[-1:].isalpha()
        end = (self.normal.normalize_str(word.decode()) if self.normal else word.decode())[-1:]
        return end.isalpha() and end <= LETTER_END

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self.chunk_ids(chunk)
        if len(self) >= CACHE_CHUNKS:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null counts as empty."""
        for at in range(0, len(texts), SLICE_ROWS):
            part = pc.fill_null(texts.slice(at, SLICE_ROWS), "")
            whole = {i: self.encode(part[i].as_py())
                     for i in np.flatnonzero(pc.match_substring_regex(part, WHOLE).to_numpy(zero_copy_only=False)).tolist()}
            chunks = pc.ascii_split_whitespace(pc.ascii_lower(part))
            words = chunks.flatten().dictionary_encode()
            ids = [self[w] if w else b"" for w in byte_objects(words.dictionary)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            flat = np.frombuffer(b"".join(ids), "<u4")
            first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            which = words.indices.to_numpy()
            ends = np.concatenate(([0], np.cumsum(sizes[which])))
            take = np.repeat(first[which] - ends[:-1], sizes[which]) + np.arange(ends[-1])
            out = flat[take]
            bounds = ends[chunks.offsets.to_numpy() - chunks.offsets[0].as_py()]
            for i in range(len(part)):
                yield whole[i] if i in whole else out[bounds[i]:bounds[i + 1]].tobytes()


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    if path not in _TOKENIZERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, vocabulary: str, size: int = SIZE, doc_id: str = "doc_id", text: str = "text",
           with_ids: bool = False) -> DataFrame:
    """The pieces of every document: full sequences of ``size`` ids and a rest. Null text: the end id alone."""
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            names = batch.column(0).to_pylist()
            for name, raw in zip(names, own.texts(batch.column(1))):
                raw += end
                total = len(raw) // 4
                for start in range(0, total, size):
                    part = raw[4 * start:4 * (start + size)]
                    found = (name, start, len(part) // 4, zlib.crc32(part), total,
                             np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None)
                    for column, value in zip(rows, found):
                        column.append(value)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
            arrays = [pa.array(v, k) for v, k in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(kinds)])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (count, lengths) for a histogram of lengths.

    Lengths are placed longest first. Each goes to the open patterns with the most room, that is
    the shortest packs, as often as that pattern occurs; what finds no room opens new packs.
    """
    #: open patterns by room left, each a stack of (count, lengths); rooms sorted
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    rooms: list[int] = []
    done: list[tuple[int, tuple[int, ...]]] = []

    def put(room: int, count: int, lengths: tuple[int, ...]) -> None:
        if room == 0:
            done.append((count, lengths))
            return
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:
                # longer packs of this length alone hold it several times over
                fit = size // length
                full, rest = divmod(left, fit)
                if full:
                    put(size - fit * length, full, (length,) * fit)
                if rest:
                    put(size - rest * length, 1, (length,) * rest)
                break
            room = rooms[-1]
            count, lengths = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(bisect_left(rooms, room))
            fit = min(room // length, -(-left // count))
            if fit * count <= left:
                put(room - fit * length, count, lengths + (length,) * fit)
                left -= fit * count
            else:
                # the last round: some packs get one more than others
                full, rest = divmod(left, fit)
                if full:
                    put(room - fit * length, full, lengths + (length,) * fit)
                if rest:
                    put(room - rest * length, 1, lengths + (length,) * rest)
                if count - full - bool(rest):
                    put(room, count - full - bool(rest), lengths)
                left = 0
    return done + [p for stack in by_room.values() for p in stack]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, its slots: first rank, first sequence, and offset in the sequence.

    A pattern that occurs ``count`` times gives each of its places ``count`` ranks of that length.
    """
    out: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            first = ranks.get(length, 0)
            out.setdefault(length, []).append((first, sequence, offset))
            ranks[length] = first + count
            offset += length
        sequence += count
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in out.items()}


def ranked(parts: DataFrame, groups: int) -> DataFrame:
    """``parts`` with ``rank``: 0, 1, ... within each length, in a fixed order.

    A length that a third of all pieces have is spread over ``groups`` hash groups: rows are
    numbered inside (length, group), and the groups' sizes are summed up in a small table.
    """
    spread = parts.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    sizes = spread.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    order = Window.partitionBy("length", "_group").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = spread.withColumn("_row", F.row_number().over(order))
    return numbered.join(bases, ["length", "_group"]).withColumn("rank", F.col("_base") + F.col("_row") - 1) \
        .drop("_group", "_base", "_row")


def pack(docs: DataFrame, vocabulary: str, size: int = SIZE, doc_id: str = "doc_id", text: str = "text",
         with_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence_id and offset; gapless offsets from 0 in each sequence.

    A document's ids plus the end id are cut every ``size`` ids, so each id lies in one piece.
    Null and empty texts are the end id alone. Rows that share an id are packed each on their
    own. An empty table gives an empty table. The driver sees the histogram (at most ``size``
    rows) and the patterns, whose number depends on ``size`` and not on the documents.
    """
    spark = docs.sparkSession
    parts = stored(pieces(docs, vocabulary, size, doc_id, text, with_ids), "pieces")
    histogram = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(slots(shortest_pack_first(histogram, size)))
    groups = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = ranked(parts, groups)
    schema = parts.schema.simpleString()[7:-1].replace(":", " ") + ", sequence_id bigint, offset bigint"
    columns = parts.columns
    at, rank = columns.index("length"), len(columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = shared.value
        for batch in batches:
            lengths = batch.column(at).to_numpy()
            ranks = batch.column(rank).to_numpy()
            sequence = np.empty(len(ranks), np.int64)
            offset = np.empty(len(ranks), np.int64)
            for length in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == length)
                first, base, offsets = table_[length]
                k = np.searchsorted(first, ranks[mine], "right") - 1
                sequence[mine] = base[k] + ranks[mine] - first[k]
                offset[mine] = offsets[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:rank], pa.array(sequence), pa.array(offset)],
                                             names=[*columns, "sequence_id", "offset"])

    return rows.select(*columns, "rank").mapInArrow(place, schema)


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", ["doc_id", "text"]), vocabulary_path())
