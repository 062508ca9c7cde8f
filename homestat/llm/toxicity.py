"""Toxicity scores: Levenshtein automata intersected with a lexicon trie.

The lexicon (words and word beginnings) is learned from labelled rows. A text's words run through
the product of the lexicon trie and the one-edit automaton of its entries, so misspelled terms are
caught. A window around each find tells quotation from abuse. A logistic model on a few sums of
the finds gives the score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestat.llm.common import extend, stored, table

SLICE_ROWS = 1000
#: Words on each side of a find that are looked at.
WINDOW = 6
#: English words that report speech, and words that address somebody; others add nothing.
REPORTING = frozenset("said says wrote called quote quoted quoting word term phrase reported means meaning".split())
ADDRESSING = frozenset("you your you're youre u are such".split())
#: What a find counts in a quotation or report, and at most when it is one edit off.
QUOTED, MISSPELLED = 0.2, 0.7
QUOTES = "\"'“”„«»‘’`"
STRIP = QUOTES + ".,;:!?()[]{}<>|*#$%&/\\+=~^_-…"


@dataclass(frozen=True)
class Training:
    #: labelled rows that the lexicon and the model are fitted on, per label; the sample is bounded
    max_rows_per_label: int = 3000
    #: a term must be in so many toxic documents of the sample, and so many times likelier there
    min_docs: int = 5
    min_ratio: float = 4.0
    max_terms: int = 1500
    #: word beginnings of these lengths are terms too
    prefixes: tuple[int, ...] = (4, 5, 6, 7, 8)
    #: whole words at least this long and this telling (log of the ratio) may be one edit off, never in the first letter
    fuzzy_from: int = 5
    fuzzy_weight: float = 3.0


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


class Automaton:
    """The lexicon trie times the one-edit Levenshtein automaton, made deterministic on demand.

    A state is a set of (trie node, edits). Entries ending in ``*`` are word beginnings: they
    match as soon as their last letter is reached. ``match`` gives (entry, edits) of the best
    entry: fewest edits, then greatest weight, then text.
    """

    def __init__(self, weights: dict[str, float], fuzzy_from: int, fuzzy_weight: float = 0.0):
        self.weights = weights
        self.loose = {e for e, w in weights.items() if e[-1] != "*" and len(e) >= fuzzy_from and w >= fuzzy_weight}
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[str]] = [[]]
        self.fuzzy: list[bool] = [False]  # some entry below may be misspelled
        for entry in sorted(weights):
            node, stem = 0, entry.rstrip("*")
            for c in stem:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.fuzzy.append(False)
                node = self.children[node][c]
                self.fuzzy[node] |= entry in self.loose
            self.ends[node].append(entry)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple] = []  # per state: entries complete here, word beginnings only, all
        self.start = self.state(frozenset([(0, 0)]))

    def state(self, nodes: frozenset) -> int:
        best: dict[int, int] = {}
        todo = list(nodes)
        while todo:
            node, edits = todo.pop()
            if best.get(node, 9) <= edits:
                continue
            best[node] = edits
            if edits == 0 and node:  # a letter of the entry is missing in the word
                todo += [(c, 1) for c in self.children[node].values() if self.fuzzy[c]]
        closed = frozenset(best.items())
        if closed not in self.states:
            self.states[closed] = len(self.sets)
            self.sets.append(closed)
            self.steps.append({})
            hits = [(edits, -self.weights[e], e) for node, edits in closed for e in self.ends[node]
                    if not edits or e in self.loose]
            whole, begun = min(hits, default=None), min((h for h in hits if h[2][-1] == "*"), default=None)
            self.found.append((whole, begun))
        return self.states[closed]

    def step(self, state: int, c: str) -> int:
        to = self.steps[state].get(c)
        if to is None:
            nodes = []
            for node, edits in self.sets[state]:
                if c in self.children[node]:
                    nodes.append((self.children[node][c], edits))
                if edits == 0 and node:
                    if self.fuzzy[node]:
                        nodes.append((node, 1))  # a letter too many
                    nodes += [(child, 1) for x, child in self.children[node].items() if x != c and self.fuzzy[child]]
            to = self.steps[state][c] = self.state(frozenset(nodes)) if nodes else -1
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        state, best = self.start, None
        for c in word:
            state = self.step(state, c)
            if state < 0:
                break
            begun = self.found[state][1]
            if begun and (best is None or begun < best):
                best = begun
        else:
            whole = self.found[state][0]
            if whole and (best is None or whole < best):
                best = whole
        return (best[2], best[0]) if best else None


def clean_words(chunk: str) -> list[str]:
    """The words of a lower-cased chunk between white space; digits stay, as they may stand for letters."""
    word = chunk.strip(STRIP)
    if word.isalpha():
        return [word]
    return "".join(c if c.isalnum() else " " for c in word).split()


FEATURES = ("sum", "top", "kinds", "density", "abuse")


@dataclass
class Scorer:
    """Finds of a text as numbers, and their logistic score.

    ``misspelled`` has the weights of finds that are one edit off.
    """

    weights: dict[str, float]
    training: Training
    misspelled: dict[str, float] = field(default_factory=dict)
    model: np.ndarray | None = None
    automaton: Automaton | None = None
    cache: dict[str, tuple | None] = field(default_factory=dict)

    def find(self, chunk: str) -> tuple[str, int] | None:
        if chunk not in self.cache:
            if len(self.cache) >= 500_000:
                self.cache.clear()
            if self.automaton is None:
                self.automaton = Automaton(self.weights, self.training.fuzzy_from, self.training.fuzzy_weight)
            finds = [m for m in map(self.automaton.match, clean_words(chunk)) if m]
            self.cache[chunk] = min(finds, key=lambda m: (m[1], -self.weights[m[0]], m[0]), default=None)
        return self.cache[chunk]

    def features(self, words: list[str] | pa.Array, finds: list[tuple[int, tuple[str, int]]], n: int) -> list[float]:
        """Sums over the finds; a quoted or reported find counts a fifth, addressed ones are summed apart."""
        total = top = abuse = 0.0
        kinds: dict[str, float] = {}
        for i, (entry, edits) in finds:
            w = self.misspelled.get(entry, MISSPELLED * self.weights[entry]) if edits else self.weights[entry]
            if w <= 0:
                continue
            low, high = max(0, i - WINDOW), min(n, i + WINDOW + 1)
            around = [str(x) for x in words[low:high]]
            own = around[i - low]
            before, after = around[:i - low], around[i - low + 1:]
            opened = any(x[:1] in QUOTES for x in [*before[-3:], own] if x)
            closed = any(x.rstrip(".,;:!?")[-1:] in QUOTES for x in [own, *after[:3]] if x.rstrip(".,;:!?"))
            near = {x.strip(STRIP) for x in around}
            if opened and closed or near & REPORTING:
                w *= QUOTED
            if near & ADDRESSING:
                abuse += w
            total += w
            top = max(top, w)
            kinds[entry] = max(kinds.get(entry, 0.0), w / self.weights[entry])
        return [total, top, sum(kinds.values()), 100 * total / (n + 20), abuse]

    def rows(self, texts: pa.Array) -> Iterator[list[float]]:
        for at in range(0, len(texts), SLICE_ROWS):
            split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts.slice(at, SLICE_ROWS), "")))
            flat = split.flatten()
            coded = flat.dictionary_encode()
            finds = [self.find(c) for c in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
            is_find = np.array([f is not None for f in finds], bool)
            which = coded.indices.to_numpy()
            hits = np.flatnonzero(is_find[which]) if len(finds) else np.zeros(0, np.int64)
            bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
            cuts = np.searchsorted(hits, bounds)
            for k in range(len(split)):
                a, n = int(bounds[k]), int(bounds[k + 1] - bounds[k])
                own = [(int(h) - a, finds[which[h]]) for h in hits[cuts[k]:cuts[k + 1]]]
                yield self.features(flat.slice(a, n), own, n)

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.model is None:
            return np.zeros(len(features))
        z = np.column_stack([np.log1p(np.maximum(features, 0)), np.ones(len(features))]) @ self.model
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def newton(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit_logistic(features: np.ndarray, y: np.ndarray, penalty: float = 0.5) -> np.ndarray:
    """Ridge logistic regression on the logs of the features.

    No weight is negative, so a further find never lowers a score: a feature whose weight comes
    out negative is left out, and the rest is fitted again.
    """
    x = np.column_stack([np.log1p(np.maximum(features, 0)), np.ones(len(features))])
    used = list(range(x.shape[1]))
    while True:
        beta = newton(x[:, used], y, penalty)
        low = int(np.argmin(beta[:-1])) if len(used) > 1 else -1
        if low < 0 or beta[low] >= 0:
            out = np.zeros(x.shape[1])
            out[used] = beta
            return out
        del used[low]


def sample(labels: DataFrame, how: Training) -> DataFrame:
    """(doc, toxic) of the bounded training sample: per label the rows of least hashed id, held-out rows never."""
    doc = F.col("doc_id").cast("long")
    known = labels.where(doc.isNotNull() & F.col("toxic").isin(0, 1) & (F.pmod(F.crc32(doc.cast("string")), F.lit(5)) != 0))
    per_label = [known.where(F.col("toxic") == y).groupBy(doc.alias("doc")).agg(F.lit(y).alias("toxic"))
                 .orderBy(F.xxhash64("doc"), "doc").limit(how.max_rows_per_label) for y in (0, 1)]
    return per_label[0].unionByName(per_label[1])


def term_counts(rows: DataFrame, how: Training) -> DataFrame:
    """(term, clean, toxic): documents of each label with the term; folded in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {w for c in set((text or "").lower().split()) for w in clean_words(c) if len(w) >= 3}
                terms = set(words)
                for w in words:
                    terms.update(w[:k] + "*" for k in how.prefixes if len(w) >= k)
                counts[y].update(terms)
            terms = sorted(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *[pa.array([c[t] for t in terms], pa.int64()) for c in counts]],
                names=["term", "clean", "toxic"])

    return rows.select("toxic", "text").mapInArrow(run, "term string, clean long, toxic long").groupBy("term") \
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def misspelled_counts(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """(term, clean, toxic): documents where an entry is found one edit off; at most a row an entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = (Counter(), Counter())
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                finds = [scorer.find(c) for c in set((text or "").lower().split())]
                counts[y].update({f[0] for f in finds if f and f[1]})
            terms = sorted(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *[pa.array([c[t] for t in terms], pa.int64()) for c in counts]],
                names=["term", "clean", "toxic"])

    return rows.select("toxic", "text").mapInArrow(run, "term string, clean long, toxic long").groupBy("term") \
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, how: Training = Training(), doc_id: str = "doc_id", text: str = "text") -> Scorer:
    """A scorer fitted on the training sample.

    The driver gets at most ``max_terms`` terms with counts and, per sampled row, its label and
    a handful of numbers; texts stay in the cluster. Without both labels every score is 0.
    """
    chosen = stored(sample(labels, how), "toxic-sample")
    own = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    rows = stored(own.join(F.broadcast(chosen), "doc").select("doc", "toxic", "text"), "toxic-texts")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Scorer({}, how)
    rate = (F.col("toxic") + 0.5) / (sizes[1] + 1.0) / ((F.col("clean") + 0.5) / (sizes[0] + 1.0))
    best = term_counts(rows, how).where((F.col("toxic") >= how.min_docs) & (rate >= how.min_ratio))
    found = best.select("term", "toxic", F.log(rate).alias("weight")) \
        .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "term").limit(how.max_terms).collect()
    scorer = Scorer({r.term: r.weight for r in found}, how)
    odds = lambda t, c: float(np.log((t + 0.5) / (sizes[1] + 1) / ((c + 0.5) / (sizes[0] + 1))))
    scorer.misspelled = {r.term: min(MISSPELLED * scorer.weights[r.term], max(0.0, odds(r.toxic, r.clean)))
                         for r in misspelled_counts(rows, scorer).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array(list(scorer.rows(batch.column(1))), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in made.T]], names=["toxic", *FEATURES])

    numbers = rows.select("toxic", "text").mapInArrow(run, "toxic int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas()
    scorer.model = fit_logistic(numbers[list(FEATURES)].to_numpy(), numbers["toxic"].to_numpy().astype(float))
    return scorer


def score(docs: DataFrame, scorer: Scorer, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` plus the score of each text, 0 to 1; null and empty texts have no finds.

    One narrow pass: each task gets the scorer, whose size is bounded by its lexicon.
    """
    slim = Scorer(scorer.weights, scorer.training, scorer.misspelled, scorer.model)

    def rows(texts):
        made = np.array(list(slim.rows(pa.array(texts, pa.binary()).cast(pa.string()))), float).reshape(-1, len(FEATURES))
        return [slim.score(made).tolist()]

    return extend(docs, [(name, T.DoubleType())], rows, text)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    scorer = learn(docs, table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return score(docs, scorer).select(
        "doc_id", F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
