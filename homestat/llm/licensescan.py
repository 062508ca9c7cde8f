"""License scans with a positional rare-token index.

Template words get an IDF from all documents. The rarest words of each template are posted with
their positions. All posted words of a document are looked up, the postings are intersected by
relative position, and a template counts if enough of its rare words line up and its mandatory
phrases stand at the implied places. Everything is DataFrame code.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.llm.common import NOT_WORD, ascii_lower, fresh_name, table

#: Phrases whose places are counted, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Template:
    """Normalised notice; each mandatory phrase is part of it."""

    label: str
    text: str
    mandatory: tuple[str, ...]


TEMPLATES = (
    Template("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("source and binary forms", "with or without modification")),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "creative commons cc0 1 0 universal", ("cc0 1 0",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("with or without fee",)),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("hereby granted free of charge",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
)


@dataclass(frozen=True)
class Matching:
    #: a template's rarest distinct words that are posted
    anchors: int = 4
    #: a document's rarest distinct licence words that are looked up, at all their places; None looks up all
    lookups: int | None = None
    #: percent of a template's posted places that must line up
    aligned_pct: int = 50


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, -1), "")


def template_words(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()})


def document_counts(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents with each template word, over all documents; at most one row a template word comes back."""
    own = F.array_intersect(F.col("words"), F.array(*[F.lit(w) for w in vocabulary]))
    counts = words.select(F.explode(own).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {w: 0 for w in vocabulary} | {r.word: r.n for r in counts.collect()}


def index_of(counts: dict[str, int], templates: tuple[Template, ...] = TEMPLATES, how: Matching = Matching()) -> dict:
    """The index: posted words, rarest first (the order of IDF), their postings, and what templates need."""
    rarity = lambda w: (counts[w], w)
    postings: dict[str, list[dict]] = {}
    needs = []
    for t, template in enumerate(templates):
        words = template.text.split()
        posted = set(sorted(set(words), key=rarity)[:how.anchors])
        places = [p for p, w in enumerate(words) if w in posted]
        for p in places:
            postings.setdefault(words[p], []).append({"t": t, "p": p})
        phrases = []
        for phrase in template.mandatory:
            own = phrase.split()
            at = next(i for i in range(len(words)) if words[i:i + len(own)] == own)
            phrases.append({"at": at, "n": len(own), "text": phrase})
        needs.append({"label": template.label, "places": len(places), "least": -(-how.aligned_pct * len(places) // 100), "phrases": phrases})
    return {"words": sorted(postings, key=rarity), "postings": postings, "needs": needs}


POSTING = "array<struct<t:int,p:int>>"
NEED = "array<struct<label:string,places:int,least:int,phrases:array<struct<at:int,n:int,text:string>>>>"


def scan(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES, how: Matching = Matching()) -> DataFrame:
    """``docs`` plus n_words, n_base, first_word, last_word, base_labels, labels, score (the last columns).

    A null text counts as empty: no words, no places, empty labels, score 0. first_word and
    last_word are null without a base phrase. The score is 1 with a base phrase, else the best
    share of a template's posted words that line up around its verified phrases. Two narrow
    passes over the documents, no shuffle of texts; repeated rows are judged alike.
    """
    names = [fresh_name(docs, n) for n in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")]
    index = index_of(document_counts(docs.select(words_of(F.col(text)).alias("words")), template_words(templates)), templates, how)
    starts = [p.split()[0] for p, _ in PHRASES]
    words, hits, places, seen = (fresh_name(docs, n) for n in ("_words", "_hits", "_places", "_seen"))
    w = F.col(words)
    looked_up = sorted({*index["words"], *starts})
    out = docs.withColumn(words, words_of(F.col(text)))
    out = out.withColumn(hits, F.array_compact(F.transform(w, lambda x, i: F.when(x.isin(looked_up), i))))

    def stands(phrase: str):
        """Whether the phrase's words stand from place i."""
        own = phrase.split()

        def at(i: Column) -> Column:
            fits = F.get(w, i) == own[0]
            for k, x in enumerate(own[1:], 1):
                fits = fits & F.coalesce(F.get(w, i + k) == x, F.lit(False))
            return fits
        return at

    base = [F.filter(F.col(hits), stands(p)) for p, _ in PHRASES]
    # the rarest licence words first
    ranks = F.array(*[F.lit(x) for x in index["words"]])
    rarest = F.array_intersect(ranks, F.transform(F.col(hits), lambda i: F.get(w, i)))
    if how.lookups is not None:
        rarest = F.slice(rarest, 1, how.lookups)
    postings = F.from_json(F.lit(json.dumps(index["postings"])), f"map<string,{POSTING}>")
    found = F.flatten(F.transform(
        F.filter(F.col(hits), lambda i: F.array_contains(F.col(seen), F.get(w, i))),
        lambda i: F.transform(F.try_element_at(postings, F.get(w, i)), lambda e: F.struct(e["t"].alias("t"), (i - e["p"]).alias("o")))))
    out = out.withColumn(places, F.when(F.size(hits) > 0, F.concat(*base)).otherwise(F.array().cast("array<int>")))
    out = out.withColumn(seen, F.when(F.size(hits) > 0, rarest).otherwise(F.array().cast("array<string>")))

    needs = F.from_json(F.lit(json.dumps(index["needs"])), NEED)
    zero = F.struct(F.lit(-1).alias("t"), F.lit(0).alias("o"), F.lit(0).alias("n"), F.lit(False).alias("ok"),
                    F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("best"))

    def verified(need: Column, o: Column) -> Column:
        return F.forall(need["phrases"], lambda p: (o + p["at"] >= 0) & (
            F.array_join(F.slice(w, F.greatest(o + p["at"], F.lit(0)) + 1, p["n"]), " ") == p["text"]))

    def step(s: Column, c: Column) -> Column:
        need = F.get(needs, c["t"])
        n = F.when((s["t"] == c["t"]) & (s["o"] == c["o"]), s["n"] + 1).otherwise(F.lit(1))
        ok = F.when(n == need["least"], verified(need, c["o"])).otherwise((n > need["least"]) & s["ok"])
        return F.struct(c["t"].alias("t"), c["o"].alias("o"), n.alias("n"), ok.alias("ok"),
                        F.when(ok, F.array_union(s["labels"], F.array(need["label"]))).otherwise(s["labels"]).alias("labels"),
                        F.when(ok, F.greatest(s["best"], n / need["places"])).otherwise(s["best"]).alias("best"))

    aligned = F.when(F.size(seen) > 0, F.aggregate(F.array_sort(found), zero, step, lambda s: F.struct(s["labels"].alias("labels"), s["best"].alias("best"))))
    extra = fresh_name(docs, "_aligned")
    out = out.withColumn(extra, aligned)
    base_labels = F.array_compact(F.array(*[F.when(F.exists(F.col(places), stands(p)), F.lit(label)) for p, label in PHRASES]))
    some = F.size(places) > 0
    base_labels = F.when(some, F.array_sort(base_labels)).otherwise(F.array().cast("array<string>"))
    more = F.coalesce(F.col(extra)["labels"], F.array().cast("array<string>"))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size(w).cast("long").alias(names[0]), F.size(places).cast("long").alias(names[1]),
        F.array_min(places).cast("long").alias(names[2]), F.array_max(places).cast("long").alias(names[3]),
        F.array_join(base_labels, ",").alias(names[4]),
        F.array_join(F.array_sort(F.array_union(base_labels, more)), ",").alias(names[5]),
        F.when(some, F.lit(1.0)).otherwise(F.coalesce(F.col(extra)["best"], F.lit(0.0))).alias(names[6]))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", ["doc_id", "text"])).drop("text")
