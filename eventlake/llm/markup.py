"""HTML to blocks of text, each marked as chrome, article or neither."""

from __future__ import annotations

import re
from html import unescape

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not markup: it ends at their own end tag only.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Never part of the text.
DROPPED = RAW | frozenset("head nav header footer aside form button select option dialog menu svg math canvas audio video object template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element that a start tag of the same group ends, unless one of the scope is in between.
ENDED_BY_SAME = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
}
NAMED = frozenset("div section ul ol dl li p span a table td tr article form figure details center".split())
#: Words of class or id names that mark an element as chrome.
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header "
    "masthead topbar toolbar comment comments reply replies disqus discussion share sharing social related recommended widget pagination "
    "pager login signup search skip".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
COMMENT_NAMES = frozenset("comment comments reply replies disqus discussion".split())

CHROME, PLAIN, ARTICLE = 0, 1, 2


def names_of(value: str) -> set[str]:
    """The words of class or id names; has-x, with-x and no-x say nothing of the element itself."""
    out: set[str] = set()
    for name in value.split():
        words = re.findall(r"[a-z]+|[A-Z][a-z]*", name)
        if words and words[0].lower() not in ("has", "with", "no", "without"):
            out.update(w.lower() for w in words)
    return out


def marked_names(tag: str, attributes: str) -> set[str]:
    """What marks an element as chrome: names of its class, id or role, or that it is hidden."""
    if not attributes or attributes.isspace():
        return set()
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in reversed(list(ATTRIBUTE.finditer(attributes)))}
    out: set[str] = set()
    if tag in NAMED:
        out |= (names_of(found.get("class", "")) | names_of(found.get("id", ""))) & CHROME_NAMES
    out |= {found.get("role", "").lower()} & CHROME_ROLES
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        out.add("hidden")
    return out


class Page:
    """Reads a page's tags in order. ``blocks`` are [text, kind, article number]."""

    def __init__(self, html: str):
        self.blocks: list[tuple[str, int, int]] = []
        self.stack: list[tuple[str, bool, int]] = [("", False, 0)]  # tag, chrome, article number (0: none)
        #: Places of the open elements by name, and how many open elements up to
        #: each are blocks, so that no tag walks the stack.
        self.open: dict[str, list[int]] = {}
        self.blocks_open = [0]
        self.pieces: list[str] = []
        self.noise: list[str] = []  # of inline chrome inside the open block
        self.articles = 0
        self.read(html)

    def read(self, html: str) -> None:
        at = 0
        for_raw = None
        tag = TAG.search(html, 0)
        while tag:
            if at < tag.start():
                self.add(html[at : tag.start()])
            at = tag.end()
            name = tag[2] and tag[2].lower()
            if name:
                if tag[1]:
                    self.end(name)
                else:
                    self.start(name, tag[3])
                    if name in RAW and not tag[0].endswith("/>"):
                        for_raw = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.I).search(html, at)
                        at = for_raw.start() if for_raw else len(html)
            tag = TAG.search(html, at)
        if at < len(html):
            self.add(html[at:])
        self.flush()

    def add(self, text: str) -> None:
        (self.noise if self.stack[-1][1] else self.pieces).append(text)

    def flush(self) -> None:
        """Close the block that is open."""
        article = self.stack[-1][2]
        for pieces, kind in ((self.pieces, ARTICLE if article else PLAIN), (self.noise, CHROME)):
            if pieces:
                text = "".join(pieces)
                text = " ".join((unescape(text) if "&" in text else text).split())
                pieces.clear()
                if text:
                    self.blocks.append((text, kind, article))

    def push(self, name: str, chrome: bool, article: int) -> None:
        self.open.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, chrome, article))
        self.blocks_open.append(self.blocks_open[-1] + (name in BLOCK))

    def cut(self, at: int) -> None:
        """End the open elements from the ``at``-th on."""
        for name, _, _ in self.stack[at:]:
            self.open[name].pop()
        del self.stack[at:], self.blocks_open[at:]

    def innermost(self, names: str) -> int:
        """The place of the innermost open element of some names (0: none)."""
        return max((self.open[n][-1] for n in names.split() if self.open.get(n)), default=0)

    def drop_to(self, names: str, scope: str) -> None:
        """End the innermost open element of ``names`` unless one of ``scope`` is inside it."""
        at = self.innermost(names)
        if at > self.innermost(scope):
            self.cut(at)

    def start(self, name: str, attributes: str) -> None:
        if name in VOID:
            if name in BLOCK:
                self.flush()
            elif name == "br":
                self.add(" ")
            return
        if name in BLOCK:
            self.flush()
            self.drop_to("p", "button table td th caption article section div li blockquote body html")
        if name in ENDED_BY_SAME:
            self.drop_to(*ENDED_BY_SAME[name])
        _, chrome, article = self.stack[-1]
        marks = marked_names(name, attributes)
        if name in ("article", "main") and not marks & COMMENT_NAMES:
            if not self.articles:  # an unclosed menu, or a frame named after its sidebar, around the first one
                chrome = False
            chrome = chrome or bool(marks)
            if not article and not chrome:
                self.articles += 1
                article = self.articles
        elif name == "header" and article:
            chrome = chrome or bool(marks)
        else:
            inside_header = article and bool(self.open.get("header"))
            chrome = chrome or name in DROPPED or bool(marks) or bool(inside_header and name in BLOCK and name not in HEADING | {"div", "hgroup"})
        self.push(name, chrome, article)

    def end(self, name: str) -> None:
        at = self.innermost(name)
        if at:
            if self.blocks_open[-1] > self.blocks_open[at - 1]:
                self.flush()
            self.cut(at)
        elif name == "p":
            self.flush()


def read_parts(html: str | None) -> list[tuple[str, int, bool]]:
    """(text, kind, beside) of the blocks of a page in page order. Where the
    page has articles, the one with the most text is the article and what
    stands in others is plain and ``beside`` it."""
    blocks = Page(html or "").blocks
    sizes: dict[int, int] = {}
    for text, kind, article in blocks:
        if kind == ARTICLE:
            sizes[article] = sizes.get(article, 0) + len(text)
    best = max(sizes, key=lambda a: (sizes[a], -a)) if sizes else 0
    other = [kind == ARTICLE and article != best for _, kind, article in blocks]
    return [(text, PLAIN if beside else kind, beside) for (text, kind, _), beside in zip(blocks, other)]


def read_blocks(html: str | None) -> list[tuple[str, int]]:
    """(text, kind) of ``read_parts``."""
    return [(text, kind) for text, kind, _ in read_parts(html)]
