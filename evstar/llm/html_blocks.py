"""Blocks of text of a web page, each with the zone its markup puts it in."""

from __future__ import annotations

import html
import re
from collections import Counter

ARTICLE, OTHER, NEUTRAL = 0, 1, 2
_MAYBE = 3  # in an article element that a class or id puts beside the text

#: What an element opens: a part beside the text, by its tag or attributes or
#: by a word of its class or id; an article element, also with such a word;
#: the header of an article; the page's main part; the body of an article.
_BESIDE, _ELEMENT, _HEADER, _CLASSED, _CLASSED_ELEMENT, _MAIN, _BODY = range(1, 8)

_MARK = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)""",
    re.DOTALL,
)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)

# Fixed values of HTML: elements by the way they are read.
RAW = {"script", "style", "template", "noscript", "iframe", "textarea", "title", "xmp", "noembed", "noframes", "svg", "math", "object", "select"}
#: Those whose content is text, read up to their end tag.
RAW_TEXT = {"script", "style", "noscript", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
#: Those that end, if nothing closes them, at the next block.
ENDED_BY_BLOCK = {"svg", "math", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
    "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
    "tfoot", "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
OTHER_TAGS = {"nav", "footer", "aside", "form", "dialog", "menu", "head", "button"}
OTHER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar"}
#: Words of a class or id that mark a part beside the main text.
OTHER_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion",
    "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "subscription", "signup", "login", "sidebar", "aside", "widget", "menu", "nav", "navbar",
    "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "footer", "masthead", "comment", "comments",
    "reply", "replies", "disqus", "respond", "share", "sharing", "social", "related", "recommended", "recommendations", "teaser",
    "search", "skip", "copyright",
}


#: Words that make a class or id speak of a state of the page.
STATE_FIRST = {"has", "no", "with", "without", "not", "non", "hide"}
STATE_LAST = {"open", "closed", "enabled", "disabled", "allowed"}

_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})(?![^\s/>])", re.IGNORECASE)


def _words(names: str) -> set[str]:
    """The words of a class and an id, without those that tell a state."""
    words: set[str] = set()
    for name in names.lower().split():
        parts = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        if len(parts) < 2 or not (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST):
            words.update(parts)
    return words


def _marks(tag: str, attrs: str, in_article: bool) -> int:
    """What an element opens; 0 for nothing."""
    if tag in OTHER_TAGS or (tag == "header" and not in_article):
        return _BESIDE
    if attrs.strip():
        if _HIDDEN.search(attrs):
            return _BESIDE
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
        role = values.get("role", "").lower()
        if role in OTHER_ROLES:
            return _BESIDE
        if "articleBody" in values.get("itemprop", ""):
            return _BODY
        if role == "main":
            return _MAIN
        if tag not in ("html", "body", "main"):
            words = _words(f"{values.get('class', '')} {values.get('id', '')}")
            if words & OTHER_WORDS or (not in_article and words & {"header", "head", "topbar"}):
                return _CLASSED_ELEMENT if tag == "article" else _CLASSED
    return _ELEMENT if tag == "article" else _MAIN if tag == "main" else 0


def _raw_ends(page: str) -> dict[int, int]:
    """Where reading goes on after the start tag of each raw element, by the
    end of that tag: after its own end tag, or else where its parent ends (or
    at the next block, if that parent is the page itself)."""
    ends: dict[int, int] = {}
    stack: list[list] = []  # tag, end of the start tag, first block within
    depth: Counter[str] = Counter()
    waiting: list[list] = []  # raw elements without a block yet
    unclosed: set[str] = set()
    at = 0

    def end(k: int, stop: int) -> None:
        tag, start, block = stack[k]
        if tag in RAW:
            to_block = tag in ENDED_BY_BLOCK or not k or stack[k - 1][0] in ("html", "body")
            ends[start] = block if to_block and block is not None else stop

    while m := _MARK.search(page, at):
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag or tag in VOID:
            continue
        if m["close"] or m["close2"]:
            if not depth[tag]:
                continue
            while True:
                k = len(stack) - 1
                closed = stack[k][0] == tag
                if closed and tag in RAW:
                    ends[stack[k][1]] = m.end()
                else:
                    end(k, m.start())
                depth[stack.pop()[0]] -= 1
                if closed:
                    break
            continue
        if (m["attrs"] or m["attrs2"] or "").endswith("/"):
            continue
        if tag in RAW_TEXT and tag not in unclosed:
            if close := re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at):
                ends[at] = at = close.end()
                continue
            unclosed.add(tag)
        if tag in ("script", "style"):
            ends[at] = at = len(page)
            continue
        if tag in BLOCK:
            for held in waiting:
                held[2] = m.start()
            waiting.clear()
        stack.append([tag, at, None])
        depth[tag] += 1
        if tag in RAW:
            waiting.append(stack[-1])
    for k in range(len(stack)):
        end(k, len(page))
    return ends


#: Marks of elements that hold an article's text.
_ARTICLES = (_ELEMENT, _CLASSED_ELEMENT, _MAIN, _BODY)
#: Elements within an article that may be a box of their own.
BOX_TAGS = {"div", "section"}


def _label(tag: str, attrs: str) -> str:
    """An element's tag with the words of its class and id."""
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    return " ".join([tag, *sorted(_words(f"{values.get('class', '')} {values.get('id', '')}"))])


def _box(stack: list[tuple[str, int, int, str]], closed: int) -> str:
    """Where in an article a block stands: empty, if in no element that may
    be a box; ``box N`` in the ``N``-th such element of the page; or ``after``
    with the label of an element that opened after the (``closed``-th) end of
    the page's article and holds one more article."""
    last = max((k for k, e in enumerate(stack) if e[1] in _ARTICLES), default=-1)
    if last < 0:
        return ""
    if closed and stack[last][1] in (_ELEMENT, _CLASSED_ELEMENT):
        around = next((e for e in stack[:last] if e[2] > closed and e[3]), None)
        if around:
            return f"after {around[3]}"
    inner = [e[2] for e in stack[last + 1 :] if e[0] in BOX_TAGS]
    return f"box {inner[-1]}" if inner else ""


def blocks(page: str) -> list[tuple[int, str]]:
    """``(zone, text)`` of every block with text, in page order: character
    references decoded, white space single, ends trimmed."""
    return [(zone, text) for zone, text, _ in boxed_blocks(page)]


def boxed_blocks(page: str) -> list[tuple[int, str, str]]:
    """The blocks with, for those of an article, the box they stand in."""
    out: list[tuple[int, str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int, int, str]] = []  # open elements, what they mark, number, label
    opened = closed = 0  # elements so far, and at the end of the page's article
    box = ""
    raw_ends: dict[int, int] | None = None
    at = 0
    inside = element = in_element = False
    zone = NEUTRAL

    def flush() -> None:
        nonlocal element
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((zone, text, box if zone in (ARTICLE, _MAYBE) else ""))
                element |= in_element and zone == ARTICLE
            held.clear()

    while True:
        m = _MARK.search(page, at)
        if m is None:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if m["cdata"]:
                held.append(html.escape(m["cdata"]))
            continue
        closing = bool(m["close"] or m["close2"])
        attrs = m["attrs"] or m["attrs2"] or ""
        if tag in RAW:
            if not closing and not attrs.endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at) if raw_ends is None else None
                if end and (tag in RAW_TEXT or not (_BLOCK_TAG.search(page, at, end.start()) or re.compile(rf"<{tag}(?![^\s/>])", re.IGNORECASE).search(page, at, end.start()))):
                    at = end.end()
                else:
                    raw_ends = _raw_ends(page) if raw_ends is None else raw_ends
                    at = max(at, raw_ends.get(at, at))
            continue
        if tag == "br" or tag in ("td", "th"):
            held.append(" ")
            if tag == "br":
                continue
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        if not closing:
            if tag in BLOCK and stack and stack[-1][0] == "p":
                stack.pop()  # an open paragraph ends at the next block
            marks = _marks(tag, attrs, inside)
            if tag == "header" and inside and not marks:
                marks = _HEADER  # of an article: only its headings belong to the text
            if tag not in ("p", "li") or marks:
                opened += 1
                stack.append((tag, marks, opened, _label(tag, attrs) if tag in BLOCK and marks not in _ARTICLES and tag not in ("html", "body") else ""))
        else:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    ended = any(e[1] in (_ELEMENT, _CLASSED_ELEMENT) for e in stack[k:])
                    del stack[k:]
                    if ended and element and not closed and not any(e[1] in (_ELEMENT, _CLASSED_ELEMENT) for e in stack):
                        closed = opened
                    break
        beside = classed = inside = maybe = in_element = False
        for _, marks, _, _ in stack:
            if marks == _BESIDE:
                beside = True
            elif marks == _CLASSED:
                classed = True
            elif marks in (_MAIN, _BODY):  # wins over a class around it
                inside, classed, maybe = True, False, False
                in_element |= marks == _BODY
            elif marks in (_ELEMENT, _CLASSED_ELEMENT):
                maybe |= classed or marks == _CLASSED_ELEMENT
                inside, in_element, classed = True, True, False
        limited = any(e[1] == _HEADER for e in stack) and not any(e[0] in HEADINGS for e in stack)
        zone = OTHER if beside or classed or limited else _MAYBE if maybe else ARTICLE if inside else NEUTRAL
        box = _box(stack, closed) if inside else ""
    flush()
    # such an article element is the article of a page that has no other one
    return [(z if z != _MAYBE else OTHER if element else ARTICLE, t, b) for z, t, b in out]
