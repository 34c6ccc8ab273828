"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Elements that are no content by their tag,
role or class (menus, forms, adverts, notices, comments ...) are left out.
Every paragraph then passes points to its ancestors: some for being there, one
for each comma, some for its length; the parent gets all, the grandparent half,
those above less. An element's points are discounted by its link density. The
best container is the main text, with those of its siblings that score well or
read like prose. Its blocks, in page order, are the result.

Pages are parsed one by one inside Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: Elements whose content is never text, and those that are never main text.
RAW = frozenset("script style noscript template iframe svg math object canvas audio video textarea title".split())
DROPPED = frozenset("nav footer aside form button select option input label fieldset dialog menu head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary
    table tbody td tfoot th thead tr ul""".split())
#: A paragraph ends where one of these begins.
ENDS_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body"}
#: Begins of these end an open element of the same kind (up to the limits).
SELF_ENDING = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
               "th": {"tr", "table"}, "option": {"select"}}
#: Words of a class or id that mark what is no main text.
NOT_CONTENT = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
    sidebar aside menu nav navbar navigation topbar toolbar footer header masthead comment comments reply replies
    respond discussion disqus social share sharing related recommended recommendations cookie cookies consent gdpr
    notice notices alert popup modal overlay newsletter subscribe subscription signup login breadcrumb breadcrumbs
    pagination pager widget widgets skip copyright outbrain taboola""".split())
NOT_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Elements nested deeper than this are siblings.
DEEPEST = 300
CONTENT = frozenset("article main content post entry story body text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


#: Words that an id may hold beside these and still mark a container.
FILLERS = frozenset("area block box bar buttons container form inner links list outer panel section thread wrap wrapper".split())
#: Elements that are left out by their class or id; inside an article only
#: these, and there an id must consist of such words.
CONTAINERS = frozenset("div section ul ol dl table header center details figure".split())
_REPLY = re.compile(r"(comment|reply)(?![a-z])(?!s?[-_](open|closed|count))")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Node:
    __slots__ = ("tag", "parent", "children", "marks", "named", "reply", "role", "hidden", "points", "chars", "linked", "links", "depth")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.marks, self.named, self.reply, self.role, self.hidden = frozenset(), frozenset(), False, "", False
        self.points, self.chars, self.linked, self.links = 0.0, 0, 0, 0
        self.depth = parent.depth + 1 if parent else 0
        if attributes:
            a = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            self.marks, self.named = (frozenset(w.lower() for w in _WORD.findall(a.get(k, ""))) for k in ("class", "id"))
            self.reply = any(_REPLY.match(c) for c in a.get("class", "").lower().split())
            self.role = a.get("role", "").lower()
            self.hidden = ("hidden" in a or a.get("aria-hidden", "").lower() == "true"
                           or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "").lower()) is not None)


def parse(page: str) -> Node:
    """The page's tree. Children are nodes and decoded texts; what is not
    closed ends with its parent or the page."""
    root = Node("#root", None)
    at, pos = root, 0

    def close(tag: str, limits=frozenset()) -> None:
        nonlocal at
        n = at
        while n is not root and n.tag != tag and n.tag not in limits:
            n = n.parent
        if n is not root and n.tag == tag:
            at = n.parent

    while (m := _TOKEN.search(page, pos)) is not None:
        if m.start() > pos:
            at.children.append(html.unescape(page[pos:m.start()]))
        pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            close(tag)
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
            pos = end.end() if end else len(page)
        else:
            if tag in ENDS_P:
                close("p", frozenset(("td", "th", "table", "article", "section", "div", "body")))
            if tag in SELF_ENDING:
                close(tag, SELF_ENDING[tag])
            node = Node(tag, at, m[3])
            at.children.append(node)
            if tag not in VOID and not m[3].rstrip().endswith("/") and node.depth < DEEPEST:
                at = node                         # deeper elements lose their nesting, not their text
    if pos < len(page):
        at.children.append(html.unescape(page[pos:]))
    return root


def _inside(n: Node, tags: frozenset) -> bool:
    while n := n.parent:
        if n.tag in tags:
            return True
    return False


def _has(n: Node, tags: frozenset) -> bool:
    return any(isinstance(c, Node) and (c.tag in tags or _has(c, tags)) for c in n.children)


_MAIN, _ARTICLE = frozenset(("article", "main")), frozenset(("article",))


def dropped(n: Node) -> bool:
    """Whether an element is no main text by tag, role, class, id or style.
    Words of a class or id speak about containers, never about headings,
    paragraphs and what stands in a line. Inside an article a section may be
    called by its subject, so there an id must say nothing else."""
    if n.tag in ("html", "body", "#root"):
        return False
    if n.hidden:
        return True
    if n.tag in _MAIN:
        return n.reply                            # a reader's comment is an article of its own
    if n.tag in DROPPED or n.role in NOT_CONTENT_ROLES:
        return True
    inside = _inside(n, _MAIN)
    if inside and (n.tag == "header" or "header" in n.marks | n.named) and _has(n, _HEADINGS):
        return False                              # the article's own heading
    if n.tag == "header":
        return True
    if n.tag not in CONTAINERS:
        return not inside and n.tag not in _HEADINGS and n.tag in BLOCKS and bool((n.marks | n.named) & NOT_CONTENT)
    if not inside:
        return bool((n.marks | n.named) & NOT_CONTENT)
    told = n.named & NOT_CONTENT and n.named <= NOT_CONTENT | FILLERS and n.named != {"discussion"}
    return bool(n.marks & NOT_CONTENT or told)


def prune(n: Node) -> None:
    """Drops what is no main text, and counts characters and links."""
    kept = []
    for c in n.children:
        if isinstance(c, str):
            n.chars += len("".join(c.split()))
            kept.append(c)
        elif not dropped(c):
            prune(c)
            if (c.tag in ("ul", "ol", "div", "section", "table") and c.links >= 3 and c.linked > 0.6 * c.chars
                    and not _inside(c, _ARTICLE)):
                continue                          # a list of links; an article's own stay
            kept.append(c)
            n.chars, n.linked, n.links = n.chars + c.chars, n.linked + c.linked, n.links + c.links
    n.children = kept
    if n.tag == "a":
        n.linked, n.links = n.chars, n.links + 1


def blocks(n: Node) -> list[tuple[Node, str]]:
    """(element that holds it, text) of every block of text below ``n``."""
    out, parts = [], []

    def flush(holder: Node) -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append((holder, text))

    def walk(e: Node, holder: Node) -> None:
        for c in e.children:
            if isinstance(c, str):
                parts.append(c)
            elif c.tag == "br":
                parts.append(" ")
            elif c.tag in BLOCKS:
                flush(holder)
                walk(c, c)
                flush(c)
            else:
                walk(c, holder)

    walk(n, n)
    flush(n)
    return out


def density(n: Node) -> float:
    return n.linked / n.chars if n.chars else 0.0


def score(root: Node) -> list[Node]:
    """Passes every paragraph's points up; the containers that got some."""
    found: dict[int, Node] = {}
    for holder, text in blocks(root):
        if holder.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "figcaption"):
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3.0)
        # text straight in a container counts for that container
        n, level = (holder, 0) if holder.tag in ("div", "article", "section", "main", "body") else (holder.parent, 0)
        while n is not None and n.tag != "#root":
            n.points += points if level == 0 else points / 2 if level == 1 else points / (3 * level)
            found[id(n)] = n
            n, level = n.parent, level + 1
    for n in found.values():
        prior = 1.5 if n.tag in _MAIN else 1.2 if (n.marks | n.named) & CONTENT else 1.0
        n.points *= prior * (1 - density(n))
    return list(found.values())


def _whole(n: Node) -> Node:
    """The outermost article around ``n``, else the nearest main, else the
    containers around it that have a heading of their own beside it."""
    around = [n]
    while around[-1].parent:
        around.append(around[-1].parent)
    articles = [e for e in around if e.tag == "article"]
    if articles:
        return articles[-1]
    if main := next((e for e in around if e.tag == "main"), None):
        return main
    for e in around[1:]:
        if e.tag in ("body", "html", "#root") or not any(isinstance(c, Node) and c.tag in _HEADINGS for c in e.children):
            break
        n = e
    return n


def _beside(s: Node, after: bool, least: float) -> bool:
    """Whether a sibling of the best container belongs to it: it scores well,
    or it is text by its kind and not made of links. Headings other than the
    title count only behind the container."""
    if s.points >= least and s.tag != "body" or s.tag == "h1":
        return True
    if s.tag == "p":
        return not s.links or density(s) < 0.25
    if s.tag in _HEADINGS:
        return after
    return s.tag in ("ul", "ol", "dl", "blockquote", "pre", "table", "figure") and density(s) < 0.25


def main_blocks(page: str) -> list[str]:
    """The main text's blocks."""
    root = parse(page)
    prune(root)
    found = score(root)
    if not found:
        return [t for _, t in blocks(root)]
    best = max(found, key=lambda n: n.points)     # of equal ones the first found
    least = max(10.0, 0.2 * best.points)
    best = _whole(best)                           # an article is kept whole; points only judge what is beside it
    if best.tag in ("body", "html"):
        return [t for _, t in blocks(best)]
    out, after = [], False
    for s in best.parent.children:
        if not isinstance(s, str) and (s is best or _beside(s, after, least)):
            out += blocks(s)
        after = after or s is best
    return [t for _, t in out]


def main_text(page: str | None) -> str:
    return "\n\n".join(main_blocks(page)) if page else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """Every page with ``page_id, url, text, n_chars, n_blocks``.

    NULL or empty html, and html without text, give an empty text. Whole pages
    are read; broken markup (unclosed or cut tags) is read as far as it goes.
    Repeated rows get equal texts; of containers that score alike the first
    found is the best. Extra columns are not read; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_blocks(h) if (h := x.as_py()) else [] for x in batch.column(2)]
            texts = ["\n\n".join(b) for b in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
                 pa.array(map(len, found), pa.int64())], names=["page_id", "url", "text", "n_chars", "n_blocks"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long, n_blocks long")


def op4(spark, sf_dir):
    return extract_pages(table(spark, sf_dir, "pages"))
