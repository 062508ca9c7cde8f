"""Listing extraction from collected web pages, as a Spark job over a pages table.

Spark partitions the pages; inside each Arrow batch a small stdlib HTML parser
(``_Dom``) finds the card and field elements.  Everything after the raw text
is pulled out — price/area/location parsing, ids, urls, detail labels — is done
with Spark column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestat.functions.parse import abs_url, derive_id, parse_area, parse_category, parse_location, parse_price

# ---- fixed values: selectors and labels of the listing site ---------------------------
CARD_SELECTORS = {
    "card": "div.js__card, div[data-product-id]",
    "title": "span.js__card-title, a.js__card-title, h3 a",
    "price": "span.re__card-config-price, .price",
    "area": "span.re__card-config-area, .area",
    "location": "div.re__card-location, .location, span.re__card-config-location",
}
DETAIL_SELECTORS = {
    "spec_row": "div.re__pr-specs-content-item",
    "spec_title": ".re__pr-specs-content-item-title",
    "spec_value": ".re__pr-specs-content-item-value",
    "posted": "div.re__pr-short-info-item span.title",
    "contact": "div.re__contact-name",
}
# Detail fields: labels tried in order (case-insensitive containment).
DETAIL_LABELS = {
    "bedrooms": ["phòng ngủ", "bedroom"],
    "bathrooms": ["phòng tắm", "toilet"],
    "floors": ["số tầng"],
    "direction": ["hướng nhà", "hướng ban công"],
    "legal_status": ["pháp lý", "giấy tờ"],
}
# ---- end of fixed values ---------------------------------------------------------------

# Selector set for generic article pages (one article per page, heading as title).
PAGE_SELECTORS = {
    "card": "article",
    "title": "h1",
    "price": ".price",
    "area": ".area",
    "location": ".location",
}
# And as detail pages: the navigation's entries as fields, the footer as date, the notice as contact.
PAGE_DETAIL_SELECTORS = {
    "spec_row": "nav li",
    "spec_title": "a",
    "spec_value": "a",
    "posted": "article",
    "contact": "div.ad",
}
PAGE_DETAIL_LABELS = {
    "bedrooms": ["the", "une"],
    "bathrooms": ["der", "la"],
    "floors": ["ing"],
    "direction": ["en", "er"],
    "legal_status": ["QUE", "and"],
}

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_RAW_TEXT = {"script", "style"}


def _classes(attrs: dict) -> frozenset[str]:
    return frozenset((attrs.get("class") or "").split())


class _Node:
    """An element.  ``page`` lists the page's elements in document order: those below one, however deep
    they nest, stand right behind it, as far as they are deeper."""

    __slots__ = ("tag", "attrs", "classes", "children", "parent", "page", "at", "depth")

    def __init__(self, tag: str, attrs: dict, parent: _Node | None, classes: frozenset[str] | None = None):
        self.tag = tag
        self.attrs = attrs
        self.classes = _classes(attrs) if classes is None else classes
        self.children: list = []  # _Node or str
        self.parent = parent
        if parent is None:
            self.page, self.at, self.depth = [self], 0, 0
        else:
            self.page = page = parent.page
            self.at = len(page)
            self.depth = parent.depth + 1
            page.append(self)
            parent.children.append(self)

    def next_element_sibling(self) -> _Node | None:
        if self.parent is None:
            return None
        sibs = [c for c in self.parent.children if isinstance(c, _Node)]
        i = sibs.index(self)
        return sibs[i + 1] if i + 1 < len(sibs) else None


def _closed(cur: _Node, tag: str) -> _Node:
    """Where the page goes on after an end tag: unclosed tags close with their parent."""
    n = cur
    while n is not None and n.tag != tag:
        n = n.parent
    return n.parent if n is not None and n.parent is not None else cur


class _Dom(HTMLParser):
    """Tolerant tree builder: unclosed tags close at their parent's end tag."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.cur = self.root
        self.feed(html or "")
        self.close()

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        if tag not in _VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        _Node(tag, {k: (v or "") for k, v in attrs}, self.cur)

    def handle_endtag(self, tag):
        self.cur = _closed(self.cur, tag)

    def handle_data(self, data):
        self.cur.children.append(data)


#: A tag in its plainest spelling, which every parser reads the same way.
_PLAIN_TAG = re.compile(r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?: +[a-zA-Z][a-zA-Z0-9-]*="[^"]*")*) *>')
_PLAIN_ATTR = re.compile(r' +([a-zA-Z][a-zA-Z0-9-]*)="([^"]*)"')
_MARKUP = re.compile(r'(<[^<>"]*(?:"[^"]*"[^<>"]*)*>)')


@lru_cache(maxsize=10_000)
def _plain_tag(source: str) -> tuple | None:
    """(whether it is an end tag, name, attributes, classes) of a plain tag; None for other markup."""
    m = _PLAIN_TAG.fullmatch(source)
    if m is None:
        return None
    slash, tag, attrs = m.groups()
    tag = tag.lower()
    if tag in _RAW_TEXT or slash and attrs:
        return None
    own = {k.lower(): unescape(v) for k, v in _PLAIN_ATTR.findall(attrs)}
    return bool(slash), tag, own, _classes(own)


def _plain_tree(html: str) -> _Node | None:
    """The tree of a page of plain tags and text only, as ``_Dom`` builds it; None for any other page."""
    root = cur = _Node("#root", {}, None, frozenset())
    markup = False
    for piece in _MARKUP.split(html):
        if markup:
            known = _plain_tag(piece)
            if known is None:
                return None
            end, tag, attrs, classes = known
            if not end:
                node = _Node(tag, attrs, cur, classes)
                if tag not in _VOID:
                    cur = node
            elif cur.tag == tag:
                cur = cur.parent
            else:
                cur = _closed(cur, tag)
        elif piece:
            if "<" in piece:
                return None
            cur.children.append(unescape(piece) if "&" in piece else piece)
        markup = not markup
    return root


def _tree(html: str | None) -> _Node:
    root = _plain_tree(html) if html else None
    return root if root is not None else _Dom(html).root


_SIMPLE = re.compile(r"^([a-zA-Z0-9]*)((?:\.[\w-]+)*)((?:\[[\w-]+\])*)$")


@lru_cache(maxsize=256)
def _compiled(selector: str) -> tuple:
    """Comma-separated alternatives; each a chain of (tag, classes, attributes), last part first."""
    alternatives = []
    for alternative in selector.split(","):
        chain = []
        for simple in reversed(alternative.split()):
            m = _SIMPLE.match(simple)
            if not m:
                raise ValueError(f"selector not understood: {selector!r}")
            tag, classes, attrs = m.groups()
            chain.append((tag.lower(), frozenset(classes.split(".")[1:]), tuple(re.findall(r"\[([\w-]+)\]", attrs))))
        alternatives.append(tuple(chain))
    return tuple(alternatives)


def _fits(node: _Node, part: tuple) -> bool:
    tag, classes, attrs = part
    return (not tag or node.tag == tag) and classes <= node.classes and all(a in node.attrs for a in attrs)


def _above(node: _Node, chain: tuple) -> bool:
    """Whether ancestors match the rest of a chain (descendant combinator), from the element up."""
    anc = node.parent
    for part in chain[1:]:
        while anc is not None and not _fits(anc, part):
            anc = anc.parent
        if anc is None:
            return False
        anc = anc.parent
    return True


def _found(root: _Node, selector: str) -> Iterator[_Node]:
    chains = _compiled(selector)
    depth = root.depth
    for node in islice(root.page, root.at + 1, None):
        if node.depth <= depth:
            return
        for chain in chains:
            tag, classes, attrs = chain[0]
            if tag and node.tag != tag or not classes <= node.classes or attrs and not all(a in node.attrs for a in attrs):
                continue
            if len(chain) == 1 or _above(node, chain):
                yield node
                break


def select(root: _Node, selector: str) -> list[_Node]:
    """Elements matching any of the comma-separated selectors, in document order."""
    return list(_found(root, selector))


def select_one(root: _Node, selector: str) -> _Node | None:
    return next(_found(root, selector), None)


def _strip_text(node: _Node | None) -> str:
    """Text of an element with whitespace stripped per text piece, joined."""
    if node is None:
        return ""
    if len(node.children) == 1 and isinstance(node.children[0], str) and node.tag not in _RAW_TEXT:
        return node.children[0].strip()
    pieces = []
    stack = [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            s = n.strip()
            if s:
                pieces.append(s)
        elif n.tag not in _RAW_TEXT:
            stack.extend(reversed(n.children))
    return "".join(pieces)


CARD_SCHEMA = ("page_id long, page_url string, product_id string, title string, href string, "
               "price_text string, area_text string, location_text string, error string")
CARD_TYPES = pa.schema([("page_id", pa.int64()), *[(c, pa.string()) for c in (
    "page_url", "product_id", "title", "href", "price_text", "area_text", "location_text", "error")]])


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, types)], schema=types)


def _card(card: _Node, sel: dict[str, str]) -> tuple | None:
    title_el = select_one(card, sel["title"])
    if title_el is None:
        return None
    return (
        card.attrs.get("data-product-id") or "", _strip_text(title_el), title_el.attrs.get("href", ""),
        _strip_text(select_one(card, sel["price"])), _strip_text(select_one(card, sel["area"])),
        _strip_text(select_one(card, sel["location"])), None,
    )


def _cards_of(page_id, page_url, html, sel) -> list[tuple]:
    """Rows of one page; what fails is a row with its error, a page that fails as a whole is one such row."""
    failed = lambda e: (page_id, page_url, *[None] * 6, f"{type(e).__name__}: {e}"[:500])
    try:
        cards = select(_tree(html), sel["card"])
    except Exception as e:  # noqa: BLE001 - reported in the row
        return [failed(e)]
    rows = []
    for card in cards:
        try:
            found = _card(card, sel)
        except Exception as e:  # noqa: BLE001 - reported in the row
            rows.append(failed(e))
            continue
        if found is not None:
            rows.append((page_id, page_url, *found))
    return rows


def card_text(pages: DataFrame, selectors: dict[str, str] = CARD_SELECTORS) -> DataFrame:
    """pages(page_id, url, html) -> one row of raw card text per listing card.

    A card without a title element is skipped.  An error stays inside its card
    (or its page, if that cannot be parsed at all) and is a row with ``error``
    set, so nothing is lost unseen.
    """
    sel = dict(selectors)
    for selector in sel.values():
        _compiled(selector)  # a bad selector fails here, not in every card

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page in zip(*[c.to_pylist() for c in batch.columns]):
                rows.extend(_cards_of(*page, sel))
            yield _batch(rows, CARD_TYPES)

    return _pages(pages).mapInArrow(run, CARD_SCHEMA)


def extract_listings(pages: DataFrame, selectors: dict[str, str] = CARD_SELECTORS,
                     base_url: str = "", base_from_url: bool = False, category: str | None = None,
                     scraped_at: Column | None = None, with_errors: bool = False) -> DataFrame:
    """Cards -> the 20 raw listing columns (and page_id) with parsed price, area, location, type, id and url.

    What only a detail page tells is NULL (see ``join_details``).  ``scraped_at`` is the reading
    time unless given.  Failed cards are left out, or with ``with_errors`` are rows whose last
    column ``error`` tells what failed (NULL in good rows).

    ``base_from_url`` resolves links against each page's own origin; otherwise
    against ``base_url``.  The category slug is given, or taken from the first
    path segment of the page url.
    """
    cards = card_text(pages, selectors)
    if not with_errors:
        cards = cards.where(F.col("error").isNull())
    if base_from_url:
        origin = F.regexp_extract("page_url", r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
        url = (F.when(F.col("href") == "", F.lit(""))
               .when(F.col("href").rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.col("href"))
               .when(F.col("href").startswith("/"), F.concat(origin, F.col("href")))
               .otherwise(F.concat(origin, F.lit("/"), F.col("href"))))
    else:
        url = abs_url("href", base_url)
    slug = F.lit(category) if category is not None else F.regexp_extract(
        "page_url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+/([^/?#]+)", 1)
    price = parse_price("price_text")
    area = parse_area("area_text")
    loc = parse_location("location_text")
    df = cards.withColumns({"url": url, "loc": loc, "price_billion": price, "area_m2": area})
    return df.select(
        "page_id",
        derive_id("product_id", "url").alias("listing_id"),
        "title",
        parse_category(slug).alias("property_type"),
        F.col("price_text").alias("price_raw"),
        "price_billion", "area_m2",
        F.when((F.col("price_billion") > 0) & (F.col("area_m2") > 0),
               F.round(F.col("price_billion") * 1000 / F.col("area_m2"), 2)).alias("price_per_m2_million"),
        F.col("loc.city").alias("city"), F.col("loc.district").alias("district"), F.col("loc.ward").alias("ward"),
        F.col("location_text").alias("address"),
        *[F.lit(None).cast("int").alias(c) for c in ("bedrooms", "bathrooms", "floors")],
        *[F.lit(None).cast("string").alias(c) for c in ("direction", "legal_status", "posted_date", "contact")],
        "url",
        (scraped_at if scraped_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).alias("scraped_at"),
        *(["error"] if with_errors else []),
    )


DETAIL_SCHEMA = ("page_id long, url string, specs array<struct<title:string,value:string>>, "
                 "posted_date string, contact string, error string")
DETAIL_TYPES = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("specs", pa.list_(pa.struct([("title", pa.string()), ("value", pa.string())]))),
    ("posted_date", pa.string()), ("contact", pa.string()), ("error", pa.string())])


def _details_of(page_id, url, html, sel) -> tuple:
    dom = _tree(html)
    specs = []
    for row in select(dom, sel["spec_row"]):
        t = select_one(row, sel["spec_title"])
        if t is None:
            continue
        v = select_one(row, sel["spec_value"])
        specs.append({"title": _strip_text(t), "value": _strip_text(v) if v is not None else None})
    posted = select_one(dom, sel["posted"])
    posted_date = None
    if posted is not None:
        sib = posted.next_element_sibling()
        posted_date = _strip_text(sib) if sib is not None else None
    contact_el = select_one(dom, sel["contact"])
    return (page_id, url, specs, posted_date, _strip_text(contact_el) if contact_el is not None else None, None)


def detail_specs(pages: DataFrame, selectors: dict[str, str] = DETAIL_SELECTORS) -> DataFrame:
    """pages -> (page_id, url, specs[title, value], posted_date, contact, error), one row per page."""
    sel = dict(selectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for pid, url, html in zip(*[c.to_pylist() for c in batch.columns]):
                try:
                    rows.append(_details_of(pid, url, html, sel))
                except Exception as e:  # noqa: BLE001 - reported in the row
                    rows.append((pid, url, [], None, None, f"{type(e).__name__}: {e}"[:500]))
            yield _batch(rows, DETAIL_TYPES)

    return _pages(pages).mapInArrow(run, DETAIL_SCHEMA)


def _spec(label: str):
    return F.try_element_at(
        F.filter("specs", lambda s: F.lower(s["title"]).contains(label.lower())), F.lit(1))["value"]


def extract_details(pages: DataFrame, selectors: dict[str, str] = DETAIL_SELECTORS,
                    labels: dict[str, list[str]] = DETAIL_LABELS, with_errors: bool = False) -> DataFrame:
    """Detail fields by label containment with fallback labels (first match wins).

    A page that could not be read has no fields; ``with_errors`` adds the column that tells why.
    """
    specs = detail_specs(pages, selectors)
    def first_label(labels: list[str]):
        # an empty value falls through to the next label, like a Python `or` chain
        tried = [_spec(lbl) for lbl in labels]
        return F.coalesce(*[F.nullif(t, F.lit("")) for t in tried[:-1]], tried[-1])

    fields = {name: first_label(tried) for name, tried in labels.items()}
    return specs.select("page_id", "url", *[v.alias(k) for k, v in fields.items()], "posted_date", "contact",
                        *(["error"] if with_errors else []))


def join_details(listings: DataFrame, details: DataFrame) -> DataFrame:
    """Attach detail fields to listings by url: a field the detail page tells replaces the listing's,
    listings without a detail page keep theirs.  Numbers are cast to the listing's type.  Of several
    detail pages of one url the least by its fields counts, so the result is repeatable."""
    fields = [c for c in details.columns if c in listings.columns and c not in ("url", "page_id")]
    one = F.min(F.struct(*[F.col(c).alias(f"_detail_{c}") for c in fields])).alias("d")
    d = details.groupBy(F.col("url").alias("_detail_url")).agg(one).select("_detail_url", "d.*")
    both = listings.join(d, F.col("url") == F.col("_detail_url"), "left")
    return both.select(*[
        F.coalesce(F.col(f"_detail_{c}").try_cast(listings.schema[c].dataType), F.col(c)).alias(c) if c in fields else F.col(c)
        for c in listings.columns])
