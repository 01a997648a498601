"""Operator 10: HTML extraction with removal of site templates.

One pass over a page's tags keeps a stack of its open blocks.  The first Spark pass hashes the
subtree of every block and counts, per host, the different pages that hold it; the second
deletes the subtrees that recur across many pages of the host, and the parts that are no
article by their tag or class, and returns the text of the rest.  What lies in an ``article`` or ``main`` is
never template: passages and headings that articles share stay.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.llm.common import materialize, slices, spare_name

#: A subtree is template if it stands on this share of a host's different pages, and on so many at least.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.5, 10
#: Up to this size the table of templates goes to every executor; a larger one is joined in a shuffle.
BROADCAST_BYTES = 8 << 20

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z0-9]+")

# Fixed values of HTML: inline elements, elements without an end, elements with raw text, implied ends.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded menclose "
                   "msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp svg template annotation annotation-xml".split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
#: Elements that are never part of an article, those that are none outside of one, and words of a class, id or role that say so.
OUTSIDE = frozenset("nav footer aside form head select dialog menu canvas audio video".split())
OUTSIDE_ARTICLE = frozenset("header button object fieldset".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer form menu modal nav navbar navigation newsletter notice notices notification popup "
    "promo promotion related replies search share sharing sidebar social sponsor sponsored subscribe subscription toolbar "
    "widget".split())
#: These say so only outside an article.
HEADER_NAMES = frozenset("header masthead topbar".split())
#: A hyphenated name says so if all its other words are of these (``ad-box``, ``site-footer``, but not ``no-sidebar``).
NEUTRAL_NAMES = frozenset(
    "area bar block bottom box buttons column container content group inner item items left links list main outer page panel primary "
    "right row secondary section site slot top unit wrap wrapper".split())
#: A hyphenated name that begins or ends with one of these says so whatever its other words (``reader-comments``,
#: ``gdpr-banner``, ``newsletter-signup``), unless one of them tells of a state (``comments-open``, ``no-comments``).
TELLING_NAMES = frozenset("advert advertisement advertising comment comments commentlist consent cookie cookies disqus gdpr "
                          "newsletter replies sponsored".split())
#: In an id, which may be made from a heading, only these, and in at most three words.
TELLING_IDS = frozenset("comment comments commentlist disqus gdpr".split())
STATES = frozenset("allowed closed count disabled enabled for free has hide no none off on open with without".split())
#: ``related`` with one of these is a list of other pages (but ``related-work`` is a part of an article).
OTHER_PAGES = frozenset("articles content entries items links list news pages posts reading stories topics videos".split())
#: These drop a part of an article only where it is no prose, that is under so many words.
UNSURE_NAMES = frozenset("banner form menu nav notice notices promo promotion search share sharing social toolbar widget".split())
PROSE_WORDS = 40
#: No name drops these, and no id a heading, whose id is made from its text.
PAGE_PARTS = frozenset("html body main article".split())
_HEADINGS = frozenset(f"h{i}" for i in range(1, 7))


class _Open:
    __slots__ = ("tag", "start", "parts", "drop", "article", "chain", "unsure")

    def __init__(self, tag, start, drop, article, chain, unsure=False):
        self.tag, self.start, self.parts, self.drop, self.article, self.chain = tag, start, [], drop, article, chain
        self.unsure = unsure


def _named(value: str, names: frozenset, telling: frozenset = TELLING_NAMES, most: int = 99) -> str | None:
    """The word of ``names`` that a class, id or role of ``value`` is, alone or with words that change nothing, or of
    ``telling`` at the start or end of up to ``most`` words."""
    for token in value.split():
        words = _NAME.findall(token)
        if not words:
            continue
        if found := next((w for w in words if w in names), None):
            if all(w in names or w in NEUTRAL_NAMES for w in words):
                return next((w for w in words if w in names and w not in UNSURE_NAMES), found)
            if found == "related" and all(w in names or w in OTHER_PAGES for w in words):
                return found
        ends = [w for w in (words[0], words[-1]) if w in telling]
        if ends and len(words) <= most and STATES.isdisjoint(words):
            return ends[0]
    return None


def _hidden(attributes: str) -> bool:
    if "hidden" not in attributes.lower() and "=" not in attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def _outside(tag: str, attributes: str, in_article: bool) -> str | None:
    """What says that an element is no part of the text: its tag, or a word of its names."""
    if tag in OUTSIDE or tag in OUTSIDE_ARTICLE and not in_article:
        return tag
    if tag in PAGE_PARTS or "=" not in attributes:
        return None
    names = OUTSIDE_NAMES if in_article else OUTSIDE_NAMES | HEADER_NAMES
    unsure = None
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name in ("class", "role") or name == "id" and tag not in _HEADINGS:
            value = (m[2] or m[3] or m[4] or "").lower()
            if found := _named(value, names, TELLING_IDS, 3) if name == "id" else _named(value, names):
                if found not in UNSURE_NAMES:
                    return found
                unsure = found
    return unsure


def _prose(blocks: list[str], start: int) -> bool:
    words = 0
    for i in range(start, len(blocks)):
        words += len(blocks[i].split())
        if words >= PROSE_WORDS:
            return True
    return False


def read_page(html: str, templates=frozenset(), holders=frozenset()) -> tuple[list[str], list[int], bool]:
    """Text blocks of a page without ``templates``; the hashes of its block subtrees; whether an article was found.

    An element that holds the ``article`` or ``main`` with most of the page's text is kept whatever its tag or
    name (``holders``: the places of its tag and those around it, once they are known).
    """
    blocks: list[str] = []
    marks: list[int] = []  # for each block the sum of 1 inside main, 2 inside an article, 4 for a first-level heading
    hashes: list[int] = []
    stack = [_Open("", 0, False, 0, ())]
    held: dict[tuple, int] = {}  # letters of articles in elements that are dropped, by the places of these
    buffer: list[str] = []
    opened: dict[str, list[int]] = {}  # places of the open elements of a tag in the stack, so that nothing is searched
    nearest = lambda tags: max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def flush() -> None:
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                blocks.append(text)
                marks.append(stack[-1].article + 4 * (stack[-1].tag == "h1"))
                stack[-1].parts.append(text)

    def close() -> None:
        flush()
        top = stack.pop()
        opened[top.tag].pop()
        if top.unsure and not _prose(blocks, top.start):
            del blocks[top.start:], marks[top.start:]
            return
        if top.drop or not top.parts:
            return
        h = xxhash.xxh3_64_intdigest(f"{top.tag}\x00{chr(1).join(top.parts)}".encode("utf-8", "surrogatepass")) - (1 << 63)
        if h in templates and not top.article:
            del blocks[top.start:], marks[top.start:]
            return
        hashes.append(h)
        stack[-1].parts.append(str(h))

    at, n, search = 0, len(html), _TAG.search
    while at < n:
        m = search(html, at)
        end = m.start() if m else n
        if end > at:
            if not stack[-1].drop:
                buffer.append(html[at:end])
            elif stack[-1].article and stack[-1].chain:
                held[stack[-1].chain] = held.get(stack[-1].chain, 0) + len(html[at:end].strip())
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if not opened.get(tag):
                continue
            while stack[-1].tag != tag:
                close()
            close()
            continue
        if tag in RAW:
            found = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
            at = found.end() if found else n
            continue
        if tag == "br":
            if buffer:
                buffer.append(" ")
            continue
        if tag in INLINE or tag in VOID and tag != "hr":
            continue
        flush()
        if tag == "hr":
            continue
        if stack[-1].tag == "p" or stack[-1].tag in _HEADINGS and tag in _HEADINGS:
            close()
        if tag in ENDS:
            ended, border = ENDS[tag]
            if (depth := nearest(ended)) > nearest(border):
                while len(stack) > depth:
                    close()
        top = stack[-1]
        attributes = m[3] or m[6] or ""
        own = 2 if tag == "article" else int(tag == "main")
        inside, drop, chain, unsure = top.article | own, top.drop, top.chain, False
        if drop and not chain:
            pass  # nothing in it can be the page's article
        elif _hidden(attributes):
            drop, chain = True, ()
        elif m.start() not in holders and (said := _outside(tag, attributes, top.article > 0)):
            if top.article and said != tag and said in UNSURE_NAMES and not drop:
                unsure = True
            else:
                drop = True
                if top.article & 2 or tag in OUTSIDE and tag != "form":
                    chain = ()
                else:
                    inside, chain = own, (*chain, m.start())
        stack.append(_Open(tag, len(blocks), drop, inside, chain, unsure))
        opened.setdefault(tag, []).append(len(stack) - 1)
    while len(stack) > 1:
        close()
    flush()
    found = any(k & 3 for k in marks)
    if held and not found and not holders:
        chain = max(held, key=held.get)
        if held[chain] > sum(map(len, blocks)):
            return read_page(html, templates, frozenset(chain))
    return _region(blocks, marks), hashes, found


def _region(blocks: list[str], marks: list[int]) -> list[str]:
    """The blocks of the part that holds most of the text, by their ``marks``.

    A ``main`` is kept with all it contains; articles outside of it join it only if they are larger.  Without a
    ``main`` the articles are the text if they hold half of it, with a title and lead before them where they
    have no title of their own; or else all blocks are.
    """
    size = lambda of: sum(len(b) for b, k in zip(blocks, marks) if k & 3 in of)
    main, articles = size((1, 3)), size((2,))
    if main >= articles > 0 or main and not articles:
        return [b for b, k in zip(blocks, marks) if k & 1]
    if not articles or not main and size((0,)) > articles:
        return blocks
    first = next(i for i, k in enumerate(marks) if k & 2)
    titles = [i for i, k in enumerate(marks[:first]) if k == 4]
    start = titles[-1] if titles and not any(k > 4 for k in marks) else first
    return [b for i, (b, k) in enumerate(zip(blocks, marks)) if k & 3 or start <= i < first]


def page_hashes(html: str | None) -> list[int]:
    """Distinct subtree hashes of a page."""
    return sorted(set(read_page(html or "")[1]))


def host_of(url):
    """Host of a URL in lower case, without user and port; empty for null or where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def templates_of(pages: DataFrame, url: str = "url", html: str = "html", share: float = TEMPLATE_SHARE,
                 least: int = TEMPLATE_PAGES) -> DataFrame:
    """``host`` and ``templates``: the hashes of subtrees that recur across the host's different pages.

    Copies of a page (the same set of subtrees) count once, so that an article that is
    published many times is no template.  A host has at most 1/``share`` times as many templates as its mean
    page has subtrees, so the lists stay short at any size.
    """
    def run(batches):
        for batch in batches:
            for piece in slices(batch, 1):
                found = [page_hashes(t) for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([xxhash.xxh3_64_intdigest(np.array(x, np.int64).tobytes()) - (1 << 63) for x in found], pa.int64()),
                     pa.array(found, pa.list_(pa.int64()))], names=["host", "page", "hashes"])

    seen = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`")).mapInArrow(
        run, "host string, page long, hashes array<long>")
    one = materialize(seen.groupBy("host", "page").agg(F.first("hashes").alias("hashes")), "page_hashes")
    total = one.groupBy("host").agg(F.count("*").alias("pages"))
    counts = one.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("n"))
    often = counts.where(F.col("n") >= least).join(total, "host").where(F.col("n") >= share * F.col("pages"))
    return often.groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("templates"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", share: float = TEMPLATE_SHARE,
            least: int = TEMPLATE_PAGES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Adds ``text`` (blocks joined by a newline; empty if none) to every page.

    The table of templates is measured: a small one is broadcast, a larger one is joined by
    host in a shuffle, whose hot hosts Spark splits.  Null and empty pages give an empty text; pages without a host
    count together; repeated rows are extracted alike; cut-off pages are read to their end;
    an empty table gives no rows.  Clashing column names get an underscore appended.
    """
    table = materialize(templates_of(pages, url, html, share, least), "templates")
    size = table.agg(F.sum(F.size("templates") * 8 + F.octet_length("host") + 32).alias("b")).first()["b"] or 0
    columns = pages.columns
    host, found, text = (spare_name(columns, c) for c in ("host", "templates", "text"))
    table = table.select(F.col("host").alias(host), F.col("templates").alias(found))
    joined = pages.withColumn(host, host_of(F.col(f"`{url}`"))).join(
        F.broadcast(table) if size <= broadcast_bytes else table, host, "left")
    at = columns.index(html)
    joined = joined.select(*(F.col(f"`{c}`") for c in columns), found)
    out = T.StructType(list(pages.schema.fields) + [T.StructField(text, T.StringType())])

    def run(batches):
        known: dict[bytes, frozenset] = {}

        def set_of(hashes) -> frozenset:
            key = np.array(hashes or [], np.int64).tobytes()
            if key not in known:
                if len(known) > 1000:
                    known.clear()
                known[key] = frozenset(hashes or [])
            return known[key]

        for batch in batches:
            for piece in slices(batch, at):
                texts = ["\n".join(read_page(h or "", set_of(t))[0])
                         for h, t in zip(piece.column(at).to_pylist(), piece.column(len(columns)).to_pylist())]
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(texts, pa.string())], names=[*columns, text])

    return joined.mapInArrow(run, out)
