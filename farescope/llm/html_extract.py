"""Main text of web pages by containers that the pages of a host agree on.

Each page scores its containers by the paragraphs they hold and names the best, as a path of tags
and classes in which numbers are blanked out. The pages of a host vote; the text is then taken
from the containers at the winning path, or from a page's own best where that yields no text.
What names say about an element is evidence, not a verdict: a page whose only text stands under
such a name, or in no container at all, still gives that text.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farescope.session import broadcast_if_small

from .url_filter import host_of

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?a-zA-Z/][^>]*>", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b|aria-hidden\s*=\s*[\"']?(true)", re.I)
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "select")}

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Tags that aren't the article, whatever they hold, and one that is part of it inside an article.
DROPPED = frozenset("nav footer aside menu dialog button fieldset head".split())
FORM, HEADER = "form", "header"
# What a new tag closes if it is still open, without its end tag.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
ENCLOSES = frozenset("div article section main body ul ol dl table blockquote td th li aside nav footer header form".split())
CONTAINERS = frozenset("article section main body div td blockquote".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Parts of class and id names that speak against an element: strongly, so that it counts only if
# the page has no other text; or weakly, so that it counts in an article, as a paragraph, or with
# most of the page's text in it.
STRONG = frozenset(
    "ad ads advert advertisement adverts breadcrumb breadcrumbs comment comments commentlist consent cookie cookies discussion "
    "disqus gdpr login masthead menu menubar modal nav navbar navigation newsletter pagination pager popup promo promoted promotion "
    "related recommended replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription".split()
)
WEAK = frozenset("banner footer form header hidden notice notices overlay search tags toolbar warning widget".split())
# The share of text that speaks for more than the best container: in its neighbours.
NEIGHBOURS = 0.2
TITLE_WEIGHT = 5
# A further container at the winning path is a teaser if it is smaller and so much of it is links.
TEASER_LINKS = 0.2
_PART = re.compile(r"[A-Za-z][a-z]*")


class Element:
    __slots__ = ("tag", "path", "parent", "strong", "weak", "in_main", "plain", "linked", "side", "score")

    def __init__(self, tag: str, path: str, parent: Element | None, strong: bool = False, weak: bool = False):
        self.tag, self.path, self.parent, self.strong, self.weak = tag, path, parent, strong, weak
        self.in_main = tag in MAIN or (parent is not None and parent.in_main)
        self.plain = self.linked = 0
        self.side = False
        self.score = 0.0


def _names(attributes: str) -> tuple[str, bool, bool]:
    """(classes with numbers blanked out, whether names speak strongly, weakly against the element)."""
    classes, strong, weak = "", False, False
    for m in _NAMES.finditer(attributes):
        if m[5] or m[6]:
            strong = True
            continue
        value = m[2] or m[3] or m[4] or ""
        for part in _PART.findall(value):
            part = part.lower()
            strong |= part in STRONG
            weak |= part in WEAK
        if m[1].lower() == "class":
            classes = ".".join(sorted(re.sub(r"\d+", "#", value).split()))
    return classes, strong, weak


class Page:
    """The stretches of text of a page, in order, and the elements they are in.

    A page has a body whether it says so or not, so text outside any other container counts.
    """

    def __init__(self, page: str):
        self.root = Element("body", ">body", None)
        self.elements: list[Element] = [self.root]
        self.pieces = list(self._pieces(page))  # (element, text, is link, starts a block)
        for e, text, link, _ in self.pieces:
            size = len(text) - text.count(" ")
            if size and not text.isspace():
                box: Element | None = e
                while box is not None:
                    if link:
                        box.linked += size
                    else:
                        box.plain += size
                    box = box.parent
        # Names count first; if they leave no text they don't, and at last forms don't either.
        for names, forms in ((True, True), (False, True), (False, False)):
            self._decide(names, forms)
            if any(not e.side and not link and not text.isspace() for e, text, link, _ in self.pieces):
                break

    def _decide(self, names: bool, forms: bool) -> None:
        for e in self.elements[1:]:  # parents come before children
            by_name = names and e.strong and e.tag not in MAIN
            e.side = e.parent.side or e.tag in DROPPED or (forms and e.tag == FORM) or by_name
        if not names:
            return
        # Plain text that nothing speaks strongly against.
        most = (self.root.plain - sum(e.plain for e in self.elements[1:] if e.side and not e.parent.side)) / 2
        for e in self.elements[1:]:
            weak = e.tag == HEADER or (e.weak and e.tag not in MAIN and e.tag in ENCLOSES)
            e.side |= e.parent.side or (weak and not e.in_main and e.plain <= most)

    def _pieces(self, page: str):
        root = here = self.root
        at, block, links = 0, True, 0
        n = len(page)
        while at < n:
            m = _TAG.search(page, at)
            end = m.start() if m else n
            if end > at:
                yield here, page[at:end], links > 0, block
                block = False
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if tag in BLOCKS:
                block = True
            if tag in ("html", "body"):
                continue
            if m[1]:
                e = here
                while e is not root and e.tag != tag:
                    # an inline end tag doesn't reach beyond the block that it is in
                    e = root if tag not in BLOCKS and e.tag in BLOCKS else e.parent
                if e is not root:
                    while here is not e:
                        links -= here.tag == "a"
                        here = here.parent
                    links -= here.tag == "a"
                    here = here.parent
                continue
            if tag in _RAW:
                close = _RAW[tag].search(page, at)
                at = close.end() if close else n
                continue
            if tag in VOID or m[3].endswith("/"):
                continue
            if tag in BLOCKS:
                closed = CLOSES.get(tag, ())
                e, last = here, None
                while e is not root and (e.tag not in ENCLOSES or e.tag in closed):
                    if e.tag == "p" or e.tag in closed:
                        last = e
                    e = e.parent
                if last is not None:
                    while here is not last.parent:
                        links -= here.tag == "a"
                        here = here.parent
            classes, strong, weak = _names(m[3]) if m[3] else ("", False, False)
            path = here.path
            if tag in CONTAINERS:
                path = f"{path}>{tag}.{classes}" if classes else f"{path}>{tag}"
            here = Element(tag, path, here, strong, weak)
            self.elements.append(here)
            links += tag == "a"

    def best(self) -> tuple[str, float]:
        """(path, score) of the container with most paragraph text that isn't links; "" if none.

        A paragraph counts for the container around it, and half for the next one. The article
        or main element around the best container is taken in its place; failing that, the
        container around it, as long as its other parts hold a fair share of the text.
        """
        scored: dict[int, Element] = {}
        own: dict[int, int] = {}
        for e, text, link, _ in self.pieces:
            size = len(text) - text.count(" ")
            if e.side or link or not size or text.isspace():
                continue
            box: Element | None = e
            share, weight = 1.0, size
            while box is not None:
                if box.tag in HEADINGS:
                    weight = size * TITLE_WEIGHT
                if box.tag in CONTAINERS:
                    own[id(box)] = own.get(id(box), 0) + weight
                    if share > 0.3:
                        box.score += share * size
                        scored[id(box)] = box
                        share /= 2
                box = box.parent
        if not scored:
            return "", 0.0
        best = max(scored.values(), key=lambda e: e.score)
        score = best.score
        box = best
        while box is not None and box.tag not in MAIN:
            box = box.parent
        if box is not None:
            return box.path, score
        box = best.parent
        while box is not None:
            if box.tag in CONTAINERS:
                if own[id(box)] - own[id(best)] < NEIGHBOURS * own[id(best)]:
                    break
                best = box
            box = box.parent
        return best.path, score

    def text(self, path: str) -> str:
        """The text of the containers at ``path``, without side matter and teasers; "" if there is none."""
        found: dict[int, Element] = {}

        def container(e: Element) -> Element | None:
            top = None
            while e is not None and e.path.startswith(path):
                if e.path == path and e.tag in CONTAINERS:
                    top = e
                e = e.parent
            return top

        kept = []
        for e, text, _, block in self.pieces:
            box = container(e)
            if box is not None:
                found[id(box)] = box
            kept.append((box, e, text, block))
        most = max((b.plain for b in found.values()), default=0)
        teasers = {
            k for k, b in found.items() if b.plain < most / 2 and b.linked > TEASER_LINKS * (b.plain + b.linked)
        }
        blocks, current = [], []
        for box, e, text, block in kept:
            if block and current:
                blocks.append("".join(current))
                current = []
            if box is not None and not e.side and id(box) not in teasers:
                current.append(text)
        blocks.append("".join(current))
        blocks = (" ".join(html.unescape(b).split()) for b in blocks)
        return " ".join(b for b in blocks if b)


def best_path(page: str) -> tuple[str, float]:
    """(path, score) of a page's best container, see ``Page.best``."""
    return Page(page).best()


def text_at(page: str, path: str | None) -> str:
    """The text at ``path``, or of the page's own best container if it has none there."""
    parsed = Page(page)
    text = parsed.text(path) if path else ""
    return text or parsed.text(parsed.best()[0] or ">body")


def _votes(batches):
    for batch in batches:
        found = [best_path(x or "") for x in batch.column("html").to_pylist()]
        paths, scores = [p for p, _ in found], [s for _, s in found]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string()), pa.array(scores, pa.float64())], ["host", "path", "score"])


def _extract(batches):
    for batch in batches:
        out = [
            text_at(page or "", path)
            for page, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)
        ]
        texts = pa.array(out, pa.string())
        sizes = pa.array(map(len, out), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts, sizes, batch.column("path")], ["page_id", "url", "text", "n_chars", "path"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path that most pages of a host vote for; by score, then text, on ties."""
    votes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_votes, "host string, path string, score double")
    tally = votes.where("path <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.round(F.sum("score")).alias("score"))
    best = F.max(F.struct("votes", "score", "path")).alias("best")
    return tally.groupBy("host").agg(best).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, path) for every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space within a block is one space, and blocks are
    joined by one. Menus, headers, footers, sidebars, forms, adverts, notices, comments, scripts
    and styles are left out by tag and by class; a header in the article, and what only its class
    speaks against weakly there, is part of it. A null or empty html, or one without text, gives
    an empty text. Pages with a null url, or one without a host, vote together. Repeated rows are
    extracted alike; other columns are ignored; an empty table gives no rows.
    """
    pages = pages.select("page_id", "url", "html")
    paths = broadcast_if_small(host_paths(pages).withColumnRenamed("host", "__host"))
    joined = pages.join(paths, host_of(F.col("url")) == F.col("__host"), "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint, path string")
