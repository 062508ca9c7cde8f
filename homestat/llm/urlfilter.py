"""URL filters by association rules.

Pages that a listed host rule decides are the labelled ones. FP-growth mines combinations of URL
tokens that go with a label, one length of combination after the other; rules pruned by support,
confidence and redundancy decide the other pages, found through an inverted index from token to
rules. Everything is DataFrame code.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homestat.llm.common import LOWER, UPPER, fresh_name, stored, table

#: The listed rules (verdict, host, path).
LISTED = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
ALLOW, BLOCK = "label:allow", "label:block"


@dataclass(frozen=True)
class Mining:
    min_support: float = 0.01
    min_confidence: float = 0.9
    #: tokens on a rule's left side
    max_tokens: int = 3
    #: rules sent to the driver and compiled into the index; more is an error, never a cut
    max_rules: int = 5000
    #: frequent combinations of one length; more is an error, never a cut
    max_combinations: int = 100_000


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s)(.*?)://(.*)$", 2)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.regexp_extract(url, r"^(?s)(.*?)://(.*)$", 2), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for label, h, p in sorted(LISTED, key=lambda r: len(r[1] + r[2])):  # later ones win
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(label)).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels, path segments, names of query fields, fragment."""
    scheme = F.regexp_extract(url, r"^(?s)(.*?)://", 1)
    query = F.split(F.regexp_extract(url, r"^(?s)[^?#]*\?([^#]*)", 1), "&")
    tag = lambda kind, parts: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(kind + ":"), p))
    all_ = F.concat(
        tag("s", F.array(scheme)), tag("h", F.split(host, r"\.")), tag("p", F.split(path, "/")),
        tag("q", F.transform(query, lambda q: F.substring_index(q, "=", 1))),
        tag("f", F.array(F.regexp_extract(url, r"^(?s)[^#]*#(.*)$", 1))))
    return F.array_distinct(F.coalesce(all_, F.array().cast("array<string>")))


def longer(known: Column, size: int) -> Column:
    """Combinations of ``size`` tokens from pairs of known ones (sorted arrays) that differ in their last token only."""
    def grown(p: Column) -> Column:
        ends = F.filter(known, lambda q: (F.slice(q, 1, size - 2) == F.slice(p, 1, size - 2)) & (q[size - 2] > p[size - 2]))
        return F.transform(ends, lambda q: F.array_append(p, q[size - 2]))

    return F.flatten(F.transform(known, grown))


def mine_level(combos: DataFrame, least: int, how: Mining) -> tuple[dict[tuple, int], set[tuple], list[tuple]]:
    """FP-growth over (combination, label) pairs: (pages of each frequent combination, those that one
    label does not decide alone, rules as (tokens, verdict, confidence, pages))."""
    items = combos.select(F.array(F.to_json("combo"), F.concat(F.lit("label:"), F.col("verdict"))).alias("items"))
    n = items.count()
    if not n:
        return {}, set(), []
    # the support is a count of pages, not a share of the pairs: half below it, so that rounding cannot matter
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=how.min_confidence).fit(items)
    one = F.get(F.filter("items", lambda t: ~t.isin(ALLOW, BLOCK)), 0)
    sets = model.freqItemsets.select(F.from_json(one, "array<string>").alias("combo"), F.size("items").alias("size"), "freq") \
        .where("combo is not null").limit(how.max_combinations + 1).collect()
    if len(sets) > how.max_combinations:
        raise ValueError(f"more than {how.max_combinations} combinations: raise min_support or max_combinations")
    pages = {tuple(r.combo): r.freq for r in sets if r.size == 1}
    mixed = {tuple(r.combo) for r in sets if r.size == 2 and r.freq < pages[tuple(r.combo)]}
    left, right = F.col("antecedent")[0], F.col("consequent")[0]
    rules = model.associationRules.where((F.size("antecedent") == 1) & right.isin(ALLOW, BLOCK)).select(
        F.from_json(left, "array<string>").alias("tokens"), F.substring(right, 7, 5).alias("verdict"), "confidence",
        F.round(F.col("support") * n).cast("long").alias("pages"))
    return pages, mixed, [(tuple(r.tokens), r.verdict, r.confidence, r.pages) for r in rules.collect()]


def mine(labelled: DataFrame, how: Mining = Mining()) -> list[tuple[list[str], str, float, int]]:
    """(tokens, verdict, confidence, pages) of the rules mined from (tokens, verdict) rows.

    A rule is redundant if a part of its tokens gives the same verdict with no less confidence.
    So a combination is grown only while its parts leave something to decide: a combination on
    as many pages as one of its parts, or with pages of one label only, has no longer rule worth
    keeping. No combination is longer than ``max_tokens``, however many tokens the pages share.
    The best rules come first: confidence, then pages, then fewer tokens.
    """
    labelled = stored(labelled.select(F.array_sort(F.array_distinct("tokens")).alias("tokens"), "verdict"), "labelled")
    n = labelled.count()
    if not n:
        return []
    least = max(1, -int(-how.min_support * n // 1))
    known = F.transform("tokens", lambda t: F.array(t))
    found: list[tuple] = []
    pages: dict[tuple, int] = {}
    for size in range(1, how.max_tokens + 1):
        combos = labelled.select(F.explode(known if size == 1 else longer(known, size)).alias("combo"), "verdict")
        level, mixed, rules = mine_level(combos, least, how)
        fewer = {c for c in level if all(level[c] < pages.get(c[:i] + c[i + 1:], n + 1) for i in range(size))}
        found += [r for r in rules if r[0] in fewer]
        if len(found) > how.max_rules:
            raise ValueError(f"more than {how.max_rules} rules: raise min_support, min_confidence or max_rules")
        pages |= level
        grow = sorted(json.dumps(c, ensure_ascii=False, separators=(",", ":")) for c in fewer & mixed)
        if not grow:
            break
        # the page's combinations that can still grow
        keep = F.array(*[F.from_json(F.lit(c), "array<string>") for c in grow])
        labelled = stored(labelled.select("tokens", "verdict", F.array_intersect(
            known if size == 1 else longer(known, size), keep).alias("known")), "grown")
        known = F.col("known")
    kept: list = []
    for r in sorted(found, key=lambda r: (len(r[0]), r[0], r[1])):
        if not any(k[1] == r[1] and k[2] >= r[2] and set(k[0]) < set(r[0]) for k in kept):
            kept.append(r)
    kept.sort(key=lambda r: (-r[2], -r[3], len(r[0]), r[0], r[1]))
    return [(list(t), verdict, confidence, m) for t, verdict, confidence, m in kept]


def best_match(tokens: Column, rules: list[tuple[list[str], str, float, int]]) -> Column:
    """The verdict of the best rule whose tokens the page has; null without one.

    Each rule is listed in the index under the one of its tokens that fewest rules share. A page
    looks its tokens up, and only those rules' tokens are compared.
    """
    if not rules:
        return F.lit(None).cast("string")
    uses: dict[str, int] = {}
    for tokens_, *_ in rules:
        for t in tokens_:
            uses[t] = uses.get(t, 0) + 1
    index: dict[str, list[dict]] = {}
    always: list[dict] = []
    for k, (tokens_, verdict, *_) in enumerate(rules):
        entry = {"k": k, "tokens": tokens_, "verdict": verdict}
        (index.setdefault(min(tokens_, key=lambda t: (uses[t], t)), []) if tokens_ else always).append(entry)
    entry = "array<struct<k:int,tokens:array<string>,verdict:string>>"
    postings = F.from_json(F.lit(json.dumps(index)), f"map<string,{entry}>")
    # a hashed look-up first: a map is searched key by key
    indexed = F.filter(tokens, lambda t: t.isin(list(index))) if index else tokens
    candidates = F.flatten(F.transform(indexed, lambda t: F.coalesce(F.try_element_at(postings, t), F.array().cast(entry))))
    if always:
        candidates = F.concat(candidates, F.from_json(F.lit(json.dumps(always)), entry))
    fitting = F.filter(candidates, lambda r: F.size(F.array_except(r["tokens"], tokens)) == 0)
    return F.array_min(F.transform(fitting, lambda r: F.struct(r["k"], r["verdict"])))["verdict"]


def judge(pages: DataFrame, url: str = "url", how: Mining = Mining()) -> DataFrame:
    """``pages`` with four last columns: host, path, rule, verdict.

    A listed rule decides; else the best mined rule; else the page is allowed. Null urls and urls
    without ``://`` have an empty host, path and no tokens. Rows are judged one by one, so repeated
    rows agree. Clashing column names get underscores. No labelled page: nothing is mined.
    """
    names = [fresh_name(pages, n) for n in ("host", "path", "rule", "verdict")]
    tokens, host, path = fresh_name(pages, "_tokens"), F.col(names[0]), F.col(names[1])
    text = F.col(url)
    parts = pages.withColumns({names[0]: host_of(text), names[1]: path_of(text)})
    rule, verdict = listed_rule(host, path)
    parts = parts.withColumns({names[2]: rule, names[3]: verdict})
    labelled = parts.where(F.col(names[2]).isNotNull()).select(tokens_of(text, host, path).alias("tokens"), F.col(names[3]).alias("verdict"))
    rules = mine(labelled, how)
    out = parts.withColumn(tokens, F.when(F.col(names[2]).isNull(), tokens_of(text, host, path)))
    decided = F.coalesce(F.col(names[3]), best_match(F.col(tokens), rules), F.lit("allow"))
    return out.withColumn(names[3], decided).select(*[F.col(f"`{c}`") for c in pages.columns], *names)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages", ["page_id", "url"])).drop("url")
