"""Line-first quality rules.

Every line is judged on its own (punctuation, navigation, boilerplate); failing lines are
removed, and a document that loses too large a share of its words is rejected. A base rule
on the whole text comes first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestat.llm.common import extend, fresh_name

SYMBOLS = b"#*$%&|<>"
#: A line of running text ends with one of these (closing quotes and brackets may follow).
LINE_END = re.compile(rb"""(?:[.!?:;,]|\xe2\x80\xa6|\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f)["')\]}]*$""")
#: Separators of menu parts; a line with two or more, one to every five words, is navigation.
MENU = re.compile(rb"\s(?:\||>|\xc2\xbb|\xe2\x80\xba|\xe2\x80\xa2|\xc2\xb7)\s")
NAVIGATION = frozenset((
    b"home", b"menu", b"login", b"log in", b"sign in", b"sign up", b"register", b"search", b"next", b"previous",
    b"back to top", b"skip to content", b"contact us", b"about us", b"share", b"print", b"read more", b"sitemap"))
BOILERPLATE = (
    b"all rights reserved", b"terms of use", b"terms of service", b"privacy policy", b"cookie policy",
    b"use cookies", b"uses cookies", b"accept cookies", b"enable javascript", b"javascript is disabled",
    b"lorem ipsum", b"subscribe to our newsletter", b"click here to", b"powered by ")


@dataclass(frozen=True)
class Rules:
    """Thresholds. Shares are whole percents, so that every comparison is exact."""

    min_words: int = 50
    max_repeat_pct: int = 50
    #: a long line (this many words) may lack closing punctuation
    long_line: int = 20
    #: share of a line's words with a symbol or doubled marks (!!, ??), above which the line is noise
    max_symbol_pct: int = 50
    #: share of a document's words in failing lines, above which the document is rejected
    max_lost_pct: int = 50


def line_verdict(line: bytes, rules: Rules = Rules()) -> str:
    """'' if the line passes, else the rule it fails: symbols, navigation, boilerplate or punctuation.

    A line without words passes: it carries no text and costs nothing.
    """
    words = line.split()
    if not words:
        return ""
    noisy = sum(len(w.translate(None, SYMBOLS)) != len(w) or b"!!" in w or b"??" in w for w in words)
    if 100 * noisy > rules.max_symbol_pct * len(words) and len(words) > 1:
        return "symbols"
    low = line.lower().strip(b" \t\n\x0b\x0c\r")
    parts = len(MENU.findall(line))
    if low in NAVIGATION or parts >= 2 and 5 * parts >= len(words):
        return "navigation"
    if len(words) <= 2 * rules.long_line and any(p in low for p in BOILERPLATE):
        return "boilerplate"
    if len(words) < rules.long_line and not LINE_END.search(low):
        return "punctuation"
    return ""


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that stand at least twice in the text."""
    n = len(words) - 2
    if n < 2:
        return 0
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == n:
        return 0
    seen: dict[tuple, int] = {}
    covered = bytearray(len(words))
    for i, gram in enumerate(grams):
        j = seen.setdefault(gram, i)
        if j != i:
            covered[i:i + 3] = b"\1\1\1"
            covered[j:j + 3] = b"\1\1\1"
    return covered.count(1)


def measure(text: bytes | None, rules: Rules = Rules()) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_bad_lines, n_lost, kept, clean)."""
    text = text or b""
    words = text.split()
    n = len(words)
    # code points: bytes that do not continue a character, less the white space
    chars = len(text.decode("utf-8", "replace")) - sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    dup = 0
    for line in lines:
        if line in seen:
            dup += 1
        elif line.split():
            seen.add(line)
    repeat = repeated_words(words)
    base_failed = n < rules.min_words or 100 * repeat > rules.max_repeat_pct * n
    good, bad, lost = [], 0, 0
    verdicts: dict[bytes, str] = {}
    for line in lines:
        if line not in verdicts:
            verdicts[line] = line_verdict(line, rules)
        if verdicts[line]:
            bad += 1
            lost += len(line.split())
        else:
            good.append(line)
    kept = not base_failed and 100 * lost <= rules.max_lost_pct * n
    return n, chars, symbols, dup, repeat, base_failed, bad, lost, kept, b"\n".join(good)


FIELDS = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
          ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()),
          ("n_bad_lines", T.LongType()), ("n_lost_words", T.LongType()), ("kept", T.BooleanType()),
          ("clean_text", T.StringType())]


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text", prefix: str = "",
          with_text: bool = True) -> DataFrame:
    """``docs`` with the measures of every document, its verdict and its cleaned text.

    One narrow pass, no shuffle: a row is judged from its own text, so hot sources and groups
    of copies cost no more than other rows. A null text counts as empty (no words, base rule
    failed, kept false). Repeated rows are judged alike. Clashing column names: give a prefix.
    """
    fields = [(prefix + n, t) for n, t in (FIELDS if with_text else FIELDS[:-1])]

    def rows(texts):
        made = [measure(t, rules)[:len(fields)] for t in texts]
        out = [list(c) for c in zip(*made)] if made else [[] for _ in fields]
        if with_text:
            out[-1] = [t.decode("utf-8", "replace") for t in out[-1]]
        return out

    return extend(docs, fields, rows, text)


def clean(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The accepted documents, without their failing lines, in the columns of ``docs``.

    ``n_chars``, if there is one, follows the shorter text. An empty table gives an empty table.
    """
    prefix = fresh_name(docs, "_q")
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    judged = judge(docs, rules, text, prefix + "_").where(F.col(f"{prefix}_kept"))
    cleaned = F.col(f"{prefix}_clean_text")
    return judged.select(*[
        cleaned.alias(c) if c == text
        else F.char_length(cleaned).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c in docs.columns])


def op1(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs, with_text=False).drop("text")
