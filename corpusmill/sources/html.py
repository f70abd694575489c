"""Text of the elements a CSS selector matches, from stored pages.

Spark has no HTML expression, so a page is parsed in a Python function; each page
is independent and the job has no shuffle. A worker holds a hundred pages, as Spark sends
rows to plain functions, and not a batch of thousands with all of their texts.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import blank_to_null
from corpusmill.schema import UNIFIED_COLUMNS

# HTML elements by how they show up in a page's visible text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title".split())
BLOCK = frozenset(("address article aside blockquote body dd div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tr "
                   "ul").split())

# Elements whose end tag may be left out, and what they can't reach across.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html article section div td th".split())


def parse_selector(selector: str) -> list[list[dict]]:
    """Comma list of descendant chains of ``tag``, ``.class`` and ``#id`` parts."""
    chains = []
    for chain in selector.split(","):
        parts = []
        for token in chain.split():
            if not re.fullmatch(r"(\*|[\w-]+)?([.#][\w-]+)*", token):
                raise ValueError(f"unsupported selector {token!r}")
            parts.append({
                "tag": re.match(r"[\w-]*", token)[0].lower(),
                "classes": set(re.findall(r"\.([\w-]+)", token)),
                "id": (re.findall(r"#([\w-]+)", token) or [None])[0]})
        if parts:
            chains.append(parts)
    return chains


class _Element:
    __slots__ = ("tag", "classes", "id", "out")

    def __init__(self, tag, attrs, out):
        a = dict(attrs)
        self.tag, self.id, self.out = tag, a.get("id"), out
        self.classes = set((a.get("class") or "").split())

    def fits(self, part) -> bool:
        return (part["tag"] in ("", self.tag) and part["classes"] <= self.classes
                and part["id"] in (None, self.id))


class _Extractor(HTMLParser):
    def __init__(self, chains):
        super().__init__(convert_charrefs=True)
        self.chains, self.open, self.found = chains, [], []

    def _matches(self, element) -> bool:
        for *ancestors, last in self.chains:
            if not element.fits(last):
                continue
            above = iter(reversed(self.open))
            if all(any(e.fits(part) for e in above) for part in reversed(ancestors)):
                return True
        return False

    def _write(self, piece):
        for e in self.open:
            if e.out is not None:
                e.out.append(piece)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._close({"p"}, SCOPES)            # a block element closes an open paragraph
        if tag in CLOSES:
            self._close(CLOSES[tag], SCOPES - CLOSES[tag])
        if tag == "br" or tag in BLOCK:
            self._write("\n")
        element = _Element(tag, attrs, None)
        if self._matches(element):
            element.out = []
            self.found.append(element.out)
        if tag not in VOID:
            self.open.append(element)

    def _close(self, tags, scopes):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in scopes:
                return

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                if tag in BLOCK:
                    self._write("\n")
                del self.open[i:]
                return

    def handle_data(self, data):
        if not any(e.tag in HIDDEN for e in self.open):
            self._write(re.sub(r"\s+", " ", data))


def select_text(html: str | None, chains) -> list[str]:
    """Visible, trimmed, non-empty text of every matching element in page order."""
    extractor = _Extractor(chains)
    extractor.feed(html or "")
    extractor.close()
    texts = (re.sub(r" *\n[ \n]*", "\n", re.sub(r" +", " ", "".join(f))).strip()
             for f in extractor.found)
    return [t for t in texts if t]


def _texts(html: str, selector: str) -> Column:
    """An array with the text of every matching element."""
    chains = parse_selector(selector)
    return F.udf(lambda page: select_text(page, chains), "array<string>", useArrow=False)(F.col(html))


def extract_elements(pages: DataFrame, selector: str = "body", key: str = "page_id",
                     html: str = "html") -> DataFrame:
    """``(key, pos, text)``: one row per matching element."""
    return pages.select(key, F.posexplode(_texts(html, selector)).alias("pos", "text"))


def scrape(pages: DataFrame, selector: str = "body", collected_at: str = "", key: str = "page_id",
           keep_key: bool = False) -> DataFrame:
    """Stored ``(key, url, html)`` pages -> unified records labelled ``unknown``."""
    found = pages.select(key, "url", F.explode(_texts("html", selector)).alias("text"))
    none = F.lit(None).cast("string")
    host = F.split_part("url", F.lit("/"), F.lit(3))       # keeps a port, unlike parse_url
    return found.select(
        *([key] if keep_key else []), blank_to_null(F.col("text")).alias("text"),
        none.alias("audio"), none.alias("image"), F.lit("unknown").alias("label"),
        F.concat(F.lit("scrape:"), host).alias("source"),
        F.lit(collected_at).alias("collected_at")).select(
            *([key] if keep_key else []), *UNIFIED_COLUMNS)
