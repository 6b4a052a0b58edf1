"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks in one pass over its markup. Each block is described
by its words and link density, those of its neighbours, the kind of element it
stands in, what its surroundings call themselves and the stock phrases it
holds. A small decision tree, trained on the labelled blocks below when the job
starts, tells the article's blocks from menus, headers, footers, notices,
adverts, forms and comments. A name that says nothing but an aside makes a
region; one that only contains such a word (``side-effects``) is a hint whose
weight the tree learns.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelearn.llm.common import by_batch, narrow

#: Elements whose content is no text of the page.
_RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea", "title", "head", "select")
_OPAQUE = frozenset(_RAW) - {"head"}
#: Open elements that are kept track of, as in browsers; deeper ones lie in the region of the deepest.
DEEPEST = 512
#: Elements that stand inside a line of text; all others end a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and names that say what a region is.
_ARTICLE_TAGS = frozenset(("article", "main"))
_ASIDE_TAGS = frozenset(("nav", "header", "footer", "aside", "form", "menu", "button", "dialog", "fieldset", "address"))
_ASIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion nav navbar navigation menu submenu breadcrumb breadcrumbs "
    "header masthead footer foot sidebar side aside related recommended widget cookie cookies consent notice gdpr alert popup modal newsletter subscribe signup login "
    "share sharing social comment comments respond reply replies discussion disqus pagination pager toolbar tags copyright legal search form skip".split()
)
#: Of these, what never holds the article: adverts, comments, other articles, notices laid over the page.
_SHUT_TAGS = _ASIDE_TAGS - {"header", "form", "fieldset"}
_SHUT_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion related recommended comment comments respond reply replies discussion "
    "disqus cookie cookies consent gdpr popup modal".split()
)
#: Of these, what is an aside whatever word stands beside it.
_ALWAYS_NAMES = _SHUT_NAMES - {"related", "recommended", "cookie", "cookies", "reply"}
_ARTICLE_NAMES = frozenset("article content main post story entry body text maincontent articlebody".split())
#: Words that name the layout; beside an aside's word they leave it one.
_LAYOUT_NAMES = _ARTICLE_NAMES | frozenset(
    "site page posts top bottom left right inner outer wrap wrapper container box block area section bar list item items link links button buttons "
    "widgets group row col column panel primary secondary global fixed sticky mobile desktop contact user author icon icons logo overlay policy".split()
)
#: Phrases of notices and footers.
_STOCK = re.compile(
    r"\b(copyright|all rights reserved|cookies?|accept all|privacy policy|terms of (?:use|service)|sign (?:up|in)|log ?in|subscribe|newsletter|"
    r"share (?:this|on)|follow us|advertisement|sponsored)\b|\u00a9",
    re.IGNORECASE,
)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WHITE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    kind: int  # 0 paragraph, 1 heading, 2 list item, 3 table cell, 4 other
    region: int  # 1 article, -1 aside, 0 unnamed
    words: int = 0
    density: float = 0.0
    hint: float = 0.0  # share of aside words in the name of an element around it
    stock: int = 0  # different stock phrases
    wrappers: tuple[int, ...] = ()  # places of the asides around it that could be wrappers
    shut: bool = False


@dataclass
class _Open:
    tag: str
    region: int
    linked: bool
    kind: int = field(default=4)
    shut: bool = False  # nothing inside is the article
    form: bool = False  # an aside only by form elements
    wrappers: tuple[int, ...] = ()
    hint: float = 0.0


def _names(attributes: str) -> tuple[set[str], set[str], float]:
    """Words that name an article, words of names that say nothing but an aside, and the largest share of aside words in another name."""
    article, aside, hint = set(), set(), 0.0
    for key, value in _ATTRIBUTE.findall(attributes):
        if key.lower() not in ("class", "id", "role", "itemprop"):
            continue
        for name in value.strip("\"'").split():
            words = [w.lower() for w in _NAME_WORDS.findall(name)]
            found = _ASIDE_NAMES.intersection(words)
            if not found:
                article.update(_ARTICLE_NAMES.intersection(words))
            elif found & _ALWAYS_NAMES or all(w in _ASIDE_NAMES or w in _LAYOUT_NAMES for w in words):
                aside |= found
            else:
                hint = max(hint, len(found) / len(words))
    return article, aside, hint


def _opened(tag: str, attributes: str, top: _Open, at: int, ignored: frozenset[int], linked: bool, kind: int) -> _Open:
    """The element that a tag at place ``at`` opens inside ``top``, with its region.

    An aside inside an article is an aside. An article stays one inside what can
    be a wrapper: a form, or for ``main`` any element that is no advert, comment
    or the like. Asides at the ``ignored`` places have turned out to be wrappers.
    """
    new = _Open(tag, top.region, linked, kind, top.shut, top.form, top.wrappers, top.hint)
    if top.shut or at in ignored:
        return new
    article, aside, hint = _names(attributes) if tag not in ("body", "html") else (set(), set(), 0.0)
    if tag in _ARTICLE_TAGS:
        aside, hint = set(), 0.0
    new.hint = max(top.hint, hint)
    if tag in _SHUT_TAGS or aside & _SHUT_NAMES:
        new.region, new.shut = -1, True
    elif tag in _ASIDE_TAGS or aside:
        # a header inside an article holds its title
        if top.region == 1 and tag not in ("form", "fieldset") and aside <= {"header"}:
            return new
        new.form = not aside and tag in ("form", "fieldset") and (top.region >= 0 or top.form)
        new.region, new.wrappers = -1, (*top.wrappers, at)
    elif tag == "main" or (top.region == 0 or top.form) and (tag in _ARTICLE_TAGS or article):
        new.region, new.form, new.hint = 1, False, 0.0
    return new


def _wrappers(found: list[Block]) -> frozenset[int]:
    """Places of asides that hold the page: more than half of its unlinked text, and no article is named outside them."""
    total, inside, article = 0, Counter(), Counter()
    for b in found:
        if not b.shut:
            free = len(b.text) - b.linked
            total += free
            for at in b.wrappers:
                inside[at] += free
                article[at] += b.region == 1
    named = sum(b.region == 1 for b in found)
    return frozenset(at for at, free in inside.items() if 2 * free > total and article[at] == named)


_KINDS = {"p": 0, "blockquote": 0, "pre": 0, "li": 2, "dt": 2, "dd": 2, "td": 3, "th": 3} | {f"h{k}": 1 for k in range(1, 7)}
#: What an opening tag closes when it is still open, as browsers do.
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",)}


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; references decoded, white space one blank, empty ones left out."""
    found = _blocks(page)
    ignored = _wrappers(found)
    return _blocks(page, ignored) if ignored else found


def _blocks(page: str, ignored: frozenset[int] = frozenset()) -> list[Block]:
    found: list[Block] = []
    stack: list[_Open] = [_Open("", 0, False)]
    deeper: Counter = Counter()  # open elements that are not kept track of; all lie inside the deepest one
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _WHITE.sub(" ", "".join(parts)).strip()
            if text:
                top = next((o for o in reversed(stack) if o.tag not in _INLINE), stack[0])
                found.append(Block(text, min(linked, len(text)), top.kind, stack[-1].region, hint=stack[-1].hint, wrappers=stack[-1].wrappers, shut=stack[-1].shut))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            parts.append(text)
            if stack[-1].linked:
                linked += len(_WHITE.sub(" ", text).strip())

    def close(tags: tuple[str, ...], within: frozenset[str] = frozenset()) -> None:
        """Take the innermost open element of these tags, and what is open inside it, off the stack."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                deeper.clear()
                return
            if stack[k].tag in within:
                return

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        after = page[lt + 1 : lt + 2]
        if not (after.isalpha() or after in ("/", "!", "?")) or not after:
            add(page[at : lt + 1])  # a bare sign
            at = lt + 1
            continue
        add(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if after in "!?":
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        end = _tag_end(page, lt)
        inside = page[lt + 1 : end]
        at = end + 1
        closing = inside.startswith("/")
        name = re.match(r"[A-Za-z][^\s/>]*", inside[1:] if closing else inside)
        if not name:
            continue
        tag = name[0].lower()
        if closing:
            if tag not in _INLINE:
                flush()
                if tag == "p" and not deeper[tag] and not any(o.tag == "p" for o in stack):
                    continue
            if deeper[tag] > 0:
                deeper[tag] -= 1
                continue
            close((tag,), frozenset(("table", "ul", "ol", "dl")) if tag in ("li", "dt", "dd", "td", "th") else frozenset())
            continue
        attributes = inside[len(tag) :]
        if tag in _OPAQUE:
            flush() if tag not in ("svg", "math", "canvas", "select", "textarea") else None
            if not attributes.rstrip().endswith("/"):
                at = _raw_end(page, at, tag)
            parts.append(" ")
            continue
        if tag in _INLINE:
            if tag == "br":
                parts.append(" ")
            elif tag not in _VOID and len(stack) < DEEPEST:
                top = stack[-1]
                stack.append(_opened(tag, attributes, top, lt, ignored, top.linked or tag == "a", top.kind))
            elif tag not in _VOID:
                deeper[tag] += 1
            continue
        flush()
        # a block ends an open paragraph and its formatting
        if any(o.tag == "p" for o in stack):
            close(("p",), frozenset(("table", "button")))
        if tag in _CLOSED_BY:
            close(_CLOSED_BY[tag], frozenset(("ul", "ol", "dl", "table", "select")))
        if tag not in _VOID and len(stack) < DEEPEST:
            top = stack[-1]
            stack.append(_opened(tag, attributes, top, lt, ignored, top.linked, _KINDS.get(tag, 4)))
        elif tag not in _VOID:
            deeper[tag] += 1
    flush()
    for b in found:
        b.words = b.text.count(" ") + 1
        b.density = b.linked / len(b.text)
        b.stock = len({found[0].lower() for found in _STOCK.finditer(b.text)})
    return found


def _tag_end(page: str, at: int) -> int:
    """The place of the sign that ends the tag at ``at``; quoted values may hold such signs."""
    k, n = at + 1, len(page)
    while k < n:
        stop = page.find(">", k)
        if stop < 0:
            return n
        quote = min((q for q in (page.find('"', k, stop), page.find("'", k, stop)) if q >= 0), default=-1)
        # a quote opens a value only behind an equals sign
        if quote < 0:
            return stop
        if not page[k:quote].rstrip().endswith("="):
            k = quote + 1
            continue
        close = page.find(page[quote], quote + 1)
        if close < 0:
            return stop
        k = close + 1
    return n


def _raw_end(page: str, at: int, tag: str) -> int:
    """Behind the closing tag of an element whose content is not markup; the page's end when it is missing."""
    found = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(page, at)
    if not found:
        return len(page)
    end = page.find(">", found.end() - 1)
    return len(page) if end < 0 else end + 1


# --- the tree --------------------------------------------------------------

FEATURES = ("words", "density", "kind", "region", "words_before", "density_before", "words_after", "density_after", "place_left", "hint", "stock")


def features(page: list[Block]) -> np.ndarray:
    """A row for each block; a missing neighbour has no words and the density -1."""
    words = np.array([0, *[b.words for b in page], 0], dtype=float)
    density = np.array([-1.0, *[b.density for b in page], -1.0])
    n = len(page)
    return np.column_stack(
        [
            words[1:-1],
            density[1:-1],
            [b.kind for b in page],
            [b.region for b in page],
            words[:-2],
            density[:-2],
            words[2:],
            density[2:],
            np.arange(n, 0, -1),
            [b.hint for b in page],
            [b.stock for b in page],
        ]
    ).reshape(n, len(FEATURES))


#: Labelled training blocks: (words, link density, kind, region, label[, hint, stock]), page by page in order; 1 is article text.
#: Kinds: 0 paragraph, 1 heading, 2 list item, 3 table cell, 4 other. Regions: 1 article, -1 aside, 0 unnamed.
LABELLED_PAGES = [
    # a menu of links, an advert, an article with short and long paragraphs, a footer
    [(1, 1, 2, -1, 0), (1, 1, 2, -1, 0), (2, 1, 2, -1, 0), (9, 0, 4, -1, 0), (8, 0, 1, 1, 1), (60, 0, 0, 1, 1), (5, 0, 0, 1, 1), (140, 0.02, 0, 1, 1), (3, 0, 0, 1, 1), (14, 0, 4, -1, 0)],
    [(1, 1, 2, -1, 0), (1, 1, 2, -1, 0), (14, 0, 4, -1, 0), (1, 0, 1, 1, 1), (1, 0, 0, 1, 1), (2, 0, 0, 1, 1), (9, 0, 4, -1, 0)],
    [(3, 1, 2, -1, 0), (30, 0, 4, -1, 0), (12, 0, 1, 1, 1), (400, 0, 0, 1, 1), (25, 0.5, 0, 1, 1), (40, 0, 4, -1, 0)],
    # comments and forms below an article; a notice above it
    [(22, 0.1, 0, -1, 0), (7, 0, 1, 1, 1), (80, 0, 0, 1, 1), (6, 0, 2, 1, 1), (4, 0, 2, 1, 1), (50, 0, 0, -1, 0), (90, 0, 0, -1, 0), (4, 0, 4, -1, 0), (3, 0, 4, -1, 0)],
    [(5, 0, 1, 1, 1), (12, 1, 0, 1, 1), (3, 0, 3, 1, 1), (2, 0, 3, 1, 1), (70, 0, 0, 1, 1), (35, 0, 0, -1, 0), (6, 1, 2, -1, 0), (6, 1, 2, -1, 0)],
    # pages that name no region: the text is where words are many and links are few
    [(2, 1, 2, 0, 0), (2, 1, 2, 0, 0), (3, 1, 2, 0, 0), (9, 0, 1, 0, 1), (75, 0.02, 0, 0, 1), (55, 0, 0, 0, 1), (90, 0.05, 0, 0, 1), (2, 1, 2, 0, 0), (4, 1, 4, 0, 0)],
    [(1, 1, 4, 0, 0), (1, 1, 4, 0, 0), (7, 0, 1, 0, 1), (30, 0, 0, 0, 1), (12, 0, 0, 0, 1), (45, 0.1, 0, 0, 1), (5, 0.8, 4, 0, 0), (3, 1, 4, 0, 0)],
    [(4, 0.9, 4, 0, 0), (120, 0, 0, 0, 1), (8, 0, 0, 0, 1), (60, 0, 0, 0, 1), (3, 0.7, 4, 0, 0), (2, 1, 4, 0, 0)],
    [(6, 0, 1, 0, 1), (40, 0, 0, 0, 1), (20, 0, 2, 0, 1), (18, 0, 2, 0, 1), (50, 0, 0, 0, 1)],
    [(3, 0, 0, 0, 1)],
    [(12, 0, 0, 0, 1), (7, 0, 0, 0, 1)],
    [(5, 1, 4, 0, 0), (6, 0.9, 4, 0, 0), (25, 0, 4, 0, 1), (33, 0, 4, 0, 1), (4, 1, 4, 0, 0)],
    # no regions: short items and cells between text, menus in any element
    [(1, 1, 2, 0, 0), (1, 1, 2, 0, 0), (2, 1, 2, 0, 0), (6, 0, 1, 0, 1), (45, 0, 0, 0, 1), (3, 0, 2, 0, 1), (2, 0, 2, 0, 1), (4, 0, 2, 0, 1), (1, 0, 2, 0, 1), (38, 0.05, 0, 0, 1), (6, 0.2, 0, 0, 0, 0, 1)],
    [(1, 1, 4, 0, 0), (2, 1, 4, 0, 0), (5, 0, 1, 0, 1), (28, 0, 0, 0, 1), (1, 0, 3, 0, 1), (2, 0, 3, 0, 1), (1, 0, 3, 0, 1), (3, 0, 3, 0, 1), (1, 0, 3, 0, 1), (1, 0, 3, 0, 1), (33, 0, 0, 0, 1), (1, 1, 4, 0, 0)],
    [(1, 1, 4, 0, 0), (2, 1, 4, 0, 0), (1, 1, 4, 0, 0), (5, 0, 1, 0, 1), (30, 0, 4, 0, 1), (2, 0, 4, 0, 1), (18, 0, 4, 0, 1), (3, 0, 4, 0, 1), (40, 0, 4, 0, 1), (2, 1, 4, 0, 0), (2, 1, 4, 0, 0)],
    [(1, 1, 0, 0, 0), (1, 1, 0, 0, 0), (2, 1, 0, 0, 0), (60, 0, 0, 0, 1), (34, 0, 0, 0, 1), (5, 0, 0, 0, 1), (27, 0.1, 0, 0, 1), (1, 1, 0, 0, 0), (2, 1, 0, 0, 0)],
    [(1, 1, 3, 0, 0), (1, 1, 3, 0, 0), (1, 1, 3, 0, 0), (80, 0, 3, 0, 1), (26, 0, 3, 0, 1), (4, 0, 3, 0, 1), (2, 1, 3, 0, 0), (7, 0, 3, 0, 0, 0, 2)],
    [(2, 1, 0, 0, 0), (7, 0, 1, 0, 1), (3, 0, 2, 0, 1), (3, 0, 2, 0, 1), (5, 0, 2, 0, 1), (9, 0.3, 2, 0, 1), (2, 0, 2, 0, 1), (44, 0, 0, 0, 1)],
    [(4, 0, 4, 0, 1), (5, 0, 4, 0, 1), (2, 0, 4, 0, 1), (8, 0, 4, 0, 1), (3, 0, 4, 0, 1), (12, 0, 4, 0, 1)],
    [(4, 0.7, 4, 0, 0), (9, 0, 1, 0, 1), (3, 0, 4, 0, 1), (52, 0, 0, 0, 1), (2, 0, 4, 0, 1), (31, 0, 0, 0, 1)],
    [(3, 0, 4, 0, 1)],
    [(1, 0, 4, 0, 1)],
    [(2, 0, 4, 0, 1), (1, 0, 4, 0, 1)],
    [(30, 0, 0, 0, 1), (24, 0.2, 0, 0, 1)],
    [(1, 1, 4, 0, 0), (52, 0.2, 0, 0, 1), (36, 0.3, 0, 0, 1), (41, 0.25, 0, 0, 1)],
    [(1, 0, 2, 0, 1), (2, 0, 2, 0, 1), (1, 0, 2, 0, 1)],
    # a site's title before its menu; link lists below their headings; words among links
    [(3, 0, 1, 0, 0), (1, 1, 2, 0, 0), (1, 1, 2, 0, 0), (2, 1, 2, 0, 0), (8, 0, 1, 0, 1), (50, 0, 0, 0, 1), (22, 0, 0, 0, 1), (2, 0, 1, 0, 0), (7, 1, 2, 0, 0), (6, 1, 2, 0, 0), (8, 1, 2, 0, 0)],
    [(2, 0, 4, 0, 0), (1, 1, 4, 0, 0), (1, 1, 4, 0, 0), (1, 0, 4, 0, 0), (1, 1, 4, 0, 0), (6, 0, 1, 0, 1), (64, 0, 0, 0, 1), (1, 0, 4, 0, 0), (1, 1, 4, 0, 0), (1, 1, 4, 0, 0)],
    [(1, 1, 2, 0, 0), (4, 0, 1, 0, 1), (36, 0.03, 0, 0, 1), (48, 0, 0, 0, 1), (3, 0, 1, 0, 0), (5, 1, 0, 0, 0), (9, 1, 0, 0, 0), (12, 1, 0, 0, 0), (1, 1, 4, 0, 0), (2, 0, 4, 0, 0)],
    [(2, 1, 2, 0, 0), (3, 1, 2, 0, 0), (2, 1, 2, 0, 0), (1, 1, 2, 0, 0)],
    # a linked paragraph inside the text is text
    [(40, 0, 0, 0, 1), (8, 1, 0, 0, 1), (50, 0, 0, 0, 1), (30, 0, 0, 0, 1)],
    [(1, 1, 4, 0, 0), (33, 0, 0, 0, 1), (6, 1, 0, 0, 1), (41, 0, 0, 0, 1), (1, 1, 4, 0, 0)],
    # notices by their phrases; an article about cookies
    [(14, 0, 0, 0, 0, 0, 2), (1, 1, 4, 0, 0), (6, 0, 1, 0, 1), (47, 0, 0, 0, 1), (39, 0, 0, 0, 1), (7, 0, 0, 0, 0, 0, 2)],
    [(11, 0, 4, 0, 0, 0, 2), (5, 0, 1, 0, 1), (58, 0, 0, 0, 1), (4, 0, 0, 0, 0, 0, 1)],
    [(21, 0.1, 0, 0, 0, 0, 2), (9, 0, 1, 0, 1), (29, 0, 0, 0, 1), (36, 0, 0, 0, 1), (3, 0, 4, 0, 0, 0, 1)],
    [(7, 0, 1, 0, 1, 0, 1), (70, 0, 0, 0, 1, 0, 1), (52, 0, 0, 0, 1, 0, 1), (61, 0, 0, 0, 1), (6, 0, 4, 0, 0, 0, 2)],
    # an article whose sections have telling names; inside it, link lists with such names
    [(6, 0, 1, 1, 1), (50, 0, 0, 1, 1), (2, 0, 1, 1, 1, 0.5), (41, 0, 0, 1, 1, 0.5), (2, 0, 2, 1, 1, 0.5), (1, 0, 2, 1, 1, 0.5), (33, 0, 0, 1, 1)],
    [(6, 0, 1, 1, 1), (30, 0, 0, 1, 1, 0, 1), (12, 0, 0, 1, 1, 0, 2), (7, 1, 2, 1, 0, 0.5), (6, 1, 2, 1, 0, 0.5), (25, 0, 0, 1, 1), (1, 1, 4, 1, 0, 0.3), (1, 1, 4, 1, 0, 0.3)],
    [(2, 0, 1, 1, 1, 0.3), (24, 0.1, 0, 1, 1, 0.3), (3, 0, 2, 1, 1, 0.3), (5, 1, 2, 1, 1), (4, 1, 2, 1, 1), (3, 1, 0, 1, 1), (1, 1, 3, 1, 1)],
    # whatever stands in a named article is its text: phrases, links, short ends, with and without something behind
    [(1, 1, 2, -1, 0), (4, 0, 1, 1, 1, 0, 1), (30, 0, 0, 1, 1, 0, 2), (3, 1, 0, 1, 1), (12, 0, 0, 1, 1, 0, 2), (4, 0, 0, -1, 0, 0, 1)],
    [(3, 1, 0, 1, 1), (6, 0, 0, 1, 1, 0, 3), (2, 1, 2, 1, 1), (1, 0, 2, 1, 1)],
    [(2, 0, 1, 1, 1), (1, 1, 3, 1, 1), (2, 0, 3, 1, 1, 0, 1), (1, 1, 2, -1, 0), (14, 0, 4, -1, 0, 0, 2)],
    [(5, 0, 0, 1, 1, 0, 1), (9, 0, 4, -1, 0), (1, 1, 2, -1, 0)],
    [(1, 0, 4, 1, 1), (1, 1, 4, 1, 1), (2, 0, 4, 1, 1), (5, 1, 4, 1, 1), (3, 0, 4, 1, 1)],
    [(90, 0, 0, 1, 1, 0, 1), (4, 0, 0, 1, 1), (2, 0.6, 0, 1, 1), (3, 0, 4, -1, 0)],
    # long text stays one between links and at the end; with a phrase too
    [(1, 1, 2, 0, 0), (2, 1, 2, 0, 0), (80, 0, 0, 0, 1)],
    [(1, 1, 4, 0, 0), (4, 0, 1, 0, 1), (45, 0, 0, 0, 1), (9, 1, 0, 0, 1), (60, 0, 0, 0, 1)],
    [(1, 1, 4, 0, 0), (1, 1, 4, 0, 0), (38, 0, 4, 0, 1), (2, 1, 4, 0, 0), (2, 0, 4, 0, 0)],
    [(50, 0, 0, 0, 1), (75, 0, 0, 0, 1, 0, 1), (4, 0, 0, 0, 0, 0, 1)],
    [(90, 0, 0, 0, 1, 0, 2), (1, 1, 4, 0, 0)],
    [(33, 0, 0, 0, 1), (47, 0, 0, 0, 1), (2, 1, 2, 0, 0), (1, 1, 2, 0, 0), (3, 1, 2, 0, 0), (1, 1, 2, 0, 0), (2, 1, 2, 0, 0), (5, 0, 0, 0, 0, 0, 2)],
    [(2, 1, 2, 0, 0), (8, 0, 1, 0, 1), (27, 0, 4, 0, 1), (2, 1, 4, 0, 0), (1, 1, 4, 0, 0), (3, 1, 4, 0, 0), (1, 1, 4, 0, 0), (2, 1, 4, 0, 0), (1, 1, 4, 0, 0)],
    [(26, 0, 0, 1, 1), (5, 0, 0, 1, 1, 0, 1)],
    [(20, 0.3, 0, 1, 1, 0, 1), (60, 0.4, 0, 1, 1, 0, 1), (9, 0.5, 2, 1, 1, 0, 1), (31, 0.2, 0, 1, 1, 0, 2), (8, 0.4, 4, 1, 1, 0, 1)],
    [(1, 1, 2, 0, 0), (55, 0.2, 0, 0, 1, 0, 1), (70, 0.3, 0, 0, 1, 0, 1), (46, 0, 0, 0, 1), (9, 0.3, 0, 0, 0, 0, 2)],
    [(1, 1, 4, 0, 0), (66, 0, 0, 0, 1, 0, 1)],
    [(2, 1, 2, 0, 0, 0.5), (3, 1, 2, 0, 0, 0.5), (2, 0, 1, 0, 1, 0.5), (28, 0, 0, 0, 1, 0.5), (2, 0, 2, 0, 1, 0.5), (3, 0, 2, 0, 1, 0.5), (31, 0, 0, 0, 1)],
]


def _training_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in LABELLED_PAGES:
        whole = [row + (0, 0)[len(row) - 5 :] for row in page]
        # the same page with longer lists of links, without its named asides, inside a named article (where all is
        # text that no name around it speaks against), and with texts of other lengths
        longer = [row for row in whole for _ in range(4 if row[1] == 1 and row[4] == 0 else 1)]
        bare = [row for row in whole if row[3] >= 0]
        named = [(*row[:3], 1, 1, *row[5:]) for row in bare if not row[5]]
        for variant in (whole, longer, bare, named):
            for scale in (1.0, 0.6, 1.6):
                made = []
                for words, density, kind, region, label, hint, stock in variant:
                    made.append(Block("", 0, kind, region, max(1, round(words * scale)), float(density), hint, stock))
                    labels.append(label)
                rows.append(features(made))
    return np.concatenate(rows), np.array(labels)


@dataclass
class Node:
    label: int
    feature: int = -1
    at: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10, least: int = 8) -> Node:
    """A binary tree by Gini impurity; of equal cuts the first feature and lowest threshold, of equal labels 1."""
    node = Node(int(2 * y.sum() >= len(y)))
    if depth == 0 or len(y) < 2 * least or y.min() == y.max():
        return node
    best = (1e-12, -1, 0.0)
    share = y.mean()
    whole = 2 * share * (1 - share) * len(y)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, s = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y) + 1)
        cut = np.flatnonzero((v[:-1] < v[1:]) & (n[:-1] >= least) & (len(y) - n[:-1] >= least))
        if not len(cut):
            continue
        a, na = s[cut] / n[cut], n[cut]
        b, nb = (s[-1] - s[cut]) / (len(y) - n[cut]), len(y) - n[cut]
        gain = whole - 2 * a * (1 - a) * na - 2 * b * (1 - b) * nb
        k = int(np.argmax(gain))
        if gain[k] > best[0] + 1e-12:
            best = (gain[k], f, (v[cut[k]] + v[cut[k] + 1]) / 2)
    if best[1] < 0:
        return node
    _, node.feature, node.at = best
    low = x[:, node.feature] <= node.at
    node.low, node.high = grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)
    return node


def decide(tree: Node, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=int)

    def walk(node: Node, rows: np.ndarray) -> None:
        if node.feature < 0:
            out[rows] = node.label
            return
        low = x[rows, node.feature] <= node.at
        walk(node.low, rows[low])
        walk(node.high, rows[~low])

    walk(tree, np.arange(len(x)))
    return out


def train() -> Node:
    return grow(*_training_table())


def main_text(page: str | None, tree: Node) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    kept = decide(tree, features(found))
    return "\n".join(b.text for b, k in zip(found, kept) if k)


EXTRACTED = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages(page_id, url, html)``.

    The article's blocks in page order, one line feed between them; inside a
    block references are decoded and white space is one blank. NULL and empty
    pages, and pages without article text, have an empty text. Broken markup
    (tags left open or never opened, bare signs, cut-off pages) is read as far as
    it goes. Repeated rows stay; an empty table gives an empty one; other columns
    are not read. Each page is one row's work: nothing is shuffled.
    """
    tree = train()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page.as_py(), tree) for page in batch.column(2)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=EXTRACTED.names
        )

    rows = narrow(pages, page_id="page_id", url="url", html="html").withColumn("page_id", F.col("page_id").cast("long"))
    return rows.mapInArrow(by_batch(run), EXTRACTED)
