"""Main text of web pages, by deducing the template that pages of one host share.

Tokens of a page are its elements, named by their path, and its runs of text. Tokens of a host that
occur equally often on every page share an occurrence vector and form an equivalence class; its
digest is a sum over the pages, so it combines before the shuffle and a host with a third of
all pages is no hot spot. The class of the page's own root, large and frequent, is the
template: elements that stand once on (nearly) every page, nested by their paths. What varies
between two of its elements is a slot. The article is the template element that holds the slot
with most text. Text is constant if it is in the root's class, or in another large and frequent
class and below an element of it; text that most pages share in a slot is in no such class.

Menus, adverts, notices, comments and the like vary as well, so elements that say what they are
by tag or role are never part of the article. Words of a class or id say so as well, but not on
an article or main element, on what holds one, or, where they would leave next to nothing of a host's text, on
elements that hold most of it: a wrapper named ``has-sidebar`` is no sidebar.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.keys import small_side
from corpusmill.llm.tables import Scratch, fresh

SUPPORT = 0.8                  # share of a host's pages that have a template token
LEAST_PAGES = 5                # of a host, for a template
LEAST_CLASS = 3                # tokens of a class that isn't the root's
LEAST_LEFT = 0.1               # of the text, for words of classes and ids to hold on all elements
DEPTH = 24                     # elements of a path that count
MOST_HOSTS = 20_000            # templates that are broadcast; more are joined

# HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "svg", "template", "math")
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
                   "ol p pre search section summary table tbody td tfoot th thead tr ul").split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html article section div".split())
OUTSIDE = frozenset(("head nav header footer aside form menu dialog script style noscript template iframe svg math "
                     "textarea title button select option object canvas audio video search").split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
LABELS = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar "
                    "side menu nav navbar navigation breadcrumb breadcrumbs header masthead footer cookie cookies "
                    "consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription "
                    "share sharing social related recommended recommendations comment comments commentlist disqus "
                    "reply replies respond discussion widget login signup signin toolbar pagination pager alert "
                    "skip").split())
SINGLE = frozenset("p li h1 h2 h3 h4 h5 h6 td dd dt pre blockquote".split())
CONTENT = frozenset("article articlebody content main post story entry body text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class _Open:
    tag: str
    path: str
    outside: bool
    labelled: tuple = ()
    names: Counter = field(default_factory=Counter)      # of its children in paths


@dataclass(slots=True)
class Block:
    """A block of visible text: the path of its element, its text, and its text within links."""

    path: str
    text: str
    linked: int
    outside: bool
    labelled: tuple = ()         # paths of elements around it whose class or id has a word of LABELS


@dataclass
class Page:
    paths: Counter = field(default_factory=Counter)
    holders: set = field(default_factory=set)      # paths of elements that hold an article or main element
    blocks: list = field(default_factory=list)


def _element(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """The element's name in paths, and whether it says that it isn't part of an article: at all, and by words."""
    found = {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "")
             for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    words = [w for name in ("class", "id") for w in re.split(r"[^a-z]+", found.get(name, "").lower()) if w]
    name = tag + ("." + ".".join(words) if words else "")
    outside = (tag in OUTSIDE or "hidden" in found or found.get("aria-hidden") == "true"
               or found.get("role", "").lower() in ROLES
               or "display:none" in found.get("style", "").replace(" ", "").lower())
    by_words = not LABELS.isdisjoint(words) and tag not in ("html", "body", "article", "main")
    return name, outside and tag not in ("html", "body"), by_words


def parsed(source: str) -> Page:
    """Elements and blocks of text of a page, in page order; markup may be broken."""
    page, stack, held = Page(), [_Open("", "", False)], []
    linked, links = 0, 0

    def flush():
        nonlocal linked
        if held:
            text = _SPACE.sub(" ", "".join(held)).strip()
            held.clear()
            if text:
                page.blocks.append(Block(stack[-1].path, text, min(linked, len(text)), stack[-1].outside, stack[-1].labelled))
        linked = 0

    def close(tags, scope=()):
        nonlocal links
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                flush()
                links -= sum(e.tag == "a" for e in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    at = 0
    while at < len(source):
        match = _TOKEN.match(source, at)
        at = match.end()
        tag = match[2]
        if tag is None:
            raw = match[0]
            if raw[0] != "<" or raw == "<":
                text = entities.unescape(raw)
                held.append(text)
                linked += len(text) * (links > 0)
            continue
        tag = tag.lower()
        if match[1]:
            if tag in BLOCK:
                flush()
            close({tag})
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s>/]", re.I).search(source, at)
            at = len(source) if end is None else source.find(">", end.start()) + 1 or len(source)
            continue
        if tag == "br":
            held.append(" ")
        if tag in BLOCK:
            flush()
            close({"p"}, SCOPES)
            if tag in CLOSES:
                close(CLOSES[tag], SCOPES - CLOSES[tag])
        if tag in VOID or match[3].endswith("/") and tag not in BLOCK:
            continue
        name, outside, by_words = _element(tag, match[3])
        above = stack[-1]
        path = above.path
        if tag in BLOCK and path.count("/") < DEPTH:
            above.names[name] += 1
            if above.names[name] > 1 and tag not in SINGLE:    # columns and cards of one name stand apart
                name = f"{name}#{above.names[name]}"
            path = f"{path}/{name}"
            page.paths[path] += 1
            if tag in ("article", "main") and not above.outside and not outside:
                page.holders.update(e.path for e in stack)
        else:
            outside = outside or by_words
            by_words = False
            if outside and not above.outside:
                flush()
        labelled = above.labelled + (path,) if by_words else above.labelled
        stack.append(_Open(tag, path, above.outside or outside, labelled))
        links += tag == "a"
    flush()
    return page


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _labelled_out(page: Page, least_left: float = LEAST_LEFT, share: float | None = None) -> list[Block]:
    """Blocks that may be part of an article, as far as words of classes and ids tell.

    ``share`` is the share of the host's text that the words leave, if known; else the page's counts.
    """
    blocks = [b for b in page.blocks if not b.outside]
    chosen = [b for b in blocks if not b.labelled]
    size = sum(len(b.text) - b.linked for b in blocks)
    left = sum(len(b.text) - b.linked for b in chosen) / size if size else 1.0
    if (left if share is None else share) >= least_left:
        return chosen
    held: Counter = Counter()
    for b in blocks:
        for path in set(b.labelled):
            held[path] += len(b.text) - b.linked
    spared = {p for p in held if p in page.holders or 2 * held[p] > size}
    return [b for b in blocks if spared.issuperset(b.labelled)]


def _text_below(blocks: list[Block]) -> dict[str, int]:
    """For every element the length of the text in it, without links."""
    whole: Counter = Counter()
    for b in blocks:
        path = b.path
        while path:
            whole[path] += len(b.text) - b.linked
            path = path.rpartition("/")[0]
    return whole


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of every page: how often, and how much text outside links."""
    for batch in batches:
        rows = []
        for host, html, number in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "page"))):
            page = parsed(html)
            inside = [b for b in page.blocks if not b.outside]
            chars = _text_below([b for b in inside if not b.labelled])
            held = _text_below(inside)
            for path, n in page.paths.items():
                rows.append((host, path, 0, n, chars.get(path, 0), held.get(path, 0), number))
            for digest in {_digest(b.text) for b in page.blocks if not b.outside}:
                rows.append((host, None, digest, 1, 0, 0, number))
        columns = list(zip(*rows)) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), *[pa.int64()] * 5))],
            ["host", "path", "text", "n", "chars", "held", "page"])


def templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, paths, texts): template elements with the text below them, and texts of template classes.

    ``paths`` has elements that stand at most once on a page, and on ``SUPPORT`` of the host's pages;
    ``texts`` are runs of text whose class (equal occurrence vectors) has such an element and is the
    root's, or has ``LEAST_CLASS`` tokens. Texts come with the elements of their class, one of
    which they must be below. Both are bounded by what a page holds.
    """
    tokens = pages.mapInArrow(_tokens, "host string, path string, text long, n long, chars long, held long, page long")
    vector = F.sum(F.xxhash64("page", "n").bitwiseAND(F.lit((1 << 40) - 1)))
    stats = tokens.groupBy("host", "path", "text").agg(
        F.count("*").alias("pages"), F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("held").alias("held"), vector.alias("vector"))
    # Two branches read the counts: without a table every page would be parsed for each of them.
    stats = scratch.write(stats.where("pages > 1 or path is not null"), "tokens")
    total = F.max(F.when(F.size(F.split("path", "/")) == 2, F.col("pages")))
    sizes = stats.where("path is not null").groupBy("host").agg(total.alias("total"))
    frequent = stats.where("pages > 1").join(sizes.where(F.col("total") >= LEAST_PAGES), "host").where(
        F.col("pages") >= F.col("total") * SUPPORT)
    once = (F.col("n") == F.col("pages")) & F.col("path").isNotNull()
    item = F.struct(F.col("path"), F.col("chars"), F.col("held"), F.col("pages"), F.col("vector"))
    classes = frequent.groupBy("host", "vector").agg(
        F.max("pages").alias("pages"), F.max("total").alias("total"),
        F.count(F.when(once | F.col("path").isNull(), 1)).alias("tokens"),
        F.array_sort(F.collect_list(F.when(once, item))).alias("paths"),
        F.array_sort(F.collect_list(F.when(F.col("path").isNull(), F.col("text")))).alias("texts"))
    elements = F.transform("paths", lambda p: p["path"])
    root = F.exists(elements, lambda p: (F.size(F.split(p, "/")) == 2) & (F.col("pages") == F.col("total")))
    template = root | (F.size("paths") > 0) & (F.col("tokens") >= LEAST_CLASS)
    below = F.transform("texts", lambda t: F.struct(t.alias("text"), elements.alias("below")))
    named = classes.select("host", F.col("paths").alias("_paths"), F.when(template, below).alias("_texts"))
    return named.groupBy("host").agg(
        F.array_sort(F.flatten(F.collect_list("_paths"))).alias("paths"),
        F.array_sort(F.flatten(F.collect_list("_texts"))).alias("texts"))


def _below(path: str, root: str) -> bool:
    return path == root or path.startswith(root + "/")


def _root(whole: dict[str, int]) -> str | None:
    """The element that the article is in, given the text below each element.

    An element that is named as one wins; else it is the deepest that holds most of the text.
    """
    total = max(whole.values(), default=0)
    if not total:
        return None
    named = [p for p in whole if _named(p)]
    if named:
        best = max(named, key=lambda p: (whole[p], -len(p), p))
        if 3 * whole[best] >= total or _tag(best) in ("article", "main"):
            return best
    held = [p for p in whole if 3 * whole[p] >= 2 * total and _tag(p) not in SINGLE]
    return max(held, key=lambda p: (p.count("/"), p), default=None)


def _tag(path: str) -> str:
    return path.rpartition("/")[2].partition("#")[0].partition(".")[0]


def _named(path: str) -> bool:
    tag, *words = path.rsplit("/", 1)[1].partition("#")[0].split(".")
    return tag in ("article", "main") or (tag in ("div", "section", "td") and not CONTENT.isdisjoint(words))


def article(source: str | None, paths: list | None = None, texts: list | None = None) -> str:
    """The article's blocks of text, one to a line, given the host's template (none for a host of few pages)."""
    if not source:
        return ""
    page = parsed(source)
    whole = max(paths or [], key=lambda p: p["held"], default=None)
    share = whole["chars"] / whole["held"] if whole and whole["held"] else None
    blocks = _labelled_out(page, share=share)
    if not blocks:
        return ""
    root = _root({p["path"]: p["chars" if share is None or share >= LEAST_LEFT else "held"] for p in paths}) if paths else None
    if root is None or not any(_below(b.path, root) for b in blocks):
        root = _root(_text_below(blocks))
    chosen = [b for b in blocks if _below(b.path, root)] if root else blocks
    if texts:
        constant = {t["text"]: t["below"] for t in texts}
        slots = [b for b in chosen if not any(_below(b.path, p) for p in constant.get(_digest(b.text), ()))]
        if 2 * sum(len(b.text) for b in slots) > sum(len(b.text) for b in chosen):
            chosen = slots
    return "\n".join(b.text for b in chosen)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def extracted(pages: DataFrame, url: str = "url", html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with ``text``, the main text of every page.

    Character references are decoded and white space within a block is one space. A null or empty
    page has an empty text. Pages without a host share none: each is read by its own structure, as
    are those of hosts with fewer than ``LEAST_PAGES`` pages. Repeated pages are pages of their own
    and count as such; an existing column ``text`` is replaced.
    """
    source = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    keep = [c for c in pages.columns if c != text]
    host, own_paths, own_texts = fresh(pages, "_host", "_paths", "_texts")
    pages = pages.select(*[f"`{c}`" for c in keep], host_of(F.col(f"`{url}`")).alias(host))
    known = pages.where(F.col(host) != "").select(
        F.col(host).alias("host"), source.alias("html"),
        F.xxhash64(F.col(f"`{url}`"), F.col(f"`{html}`")).alias("page"))
    scratch = Scratch(pages.sparkSession, "pages")
    found = small_side(templates(known, scratch), MOST_HOSTS).select(
        F.col("host").alias(host), F.col("paths").alias(own_paths), F.col("texts").alias(own_texts))

    @F.arrow_udf("string")
    def main_text(html: pa.Array, paths: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([article(h.as_py(), p.as_py(), t.as_py()) for h, p, t in zip(html, paths, texts)], pa.string())

    return pages.join(found, host, "left").select(
        *[f"`{c}`" for c in keep], main_text(source, own_paths, own_texts).alias(text))
