"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.llm.common import arrow_map, batches, sliced

_ROWS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

# A tag with its quoted attributes, a comment, a declaration; "<" before anything
# else is text. What is not closed reaches to the end.
_MARK = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.S)
_SPACE = re.compile(r"\s+")

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - {"body", "html", "option", "legend", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
CLOSES = {
    "li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
    "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}),
    "tbody": ("tbody thead tfoot tr td th", {"table"}), "thead": ("tbody thead tfoot tr td th", {"table"}),
    "tfoot": ("tbody thead tfoot tr td th", {"table"}), "option": ("option", {"select"}),
}
# Elements without text of the page, and its menus.
DROPPED = frozenset(
    "head nav script style noscript template iframe object embed svg canvas button select input textarea audio video map math".split()
)
# What is said about a part by its tag, its role or its names: evidence, which
# ``_spare`` weighs. These parts stand beside the article, or may be wrapped around it.
BESIDE, AROUND = 2, 1
TAGS = {"header": BESIDE, "footer": BESIDE, "menu": BESIDE, "dialog": BESIDE, "aside": AROUND, "form": AROUND}
LEAST_ARTICLE = 140  # characters
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# Names of what is never an article: reader comments, adverts, notices about the site, menus.
NEVER = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promoted promotion"
    " nav navbar navigation menubar breadcrumb breadcrumbs pagination pager footnav copyright"
    " comment comments commentlist reply replies respond responses disqus discussion cookie cookies consent gdpr"
    " newsletter subscribe subscription share sharing social related recommended recommendations trending".split()
)
# Names of parts of a page's frame.
FRAME = frozenset(
    "banner promo menu sidebar aside rail widget widgets header masthead topbar footer foot notice notices notification alert popup"
    " modal overlay signup login paywall skip toolbar search".split()
)
# Words that say where a part is or what kind of box, and nothing of what it holds.
AFFIXES = frozenset(
    "area list box container wrapper wrap section bar block button buttons panel inner outer form thread item items links group holder"
    " slot unit top bottom left right side user post page site global row col column card strip line zone region title head count".split()
)
# Elements further down do not nest, as in browsers; their text stays.
DEEPEST = 512
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\W\d_a-zA-Z]+")


class Node:
    __slots__ = (
        "name", "parent", "depth", "children", "dropped", "evidence", "chars", "tags", "link_chars", "link_tags", "density", "sum", "peak", "keep",
    )

    def __init__(self, name: str, parent: "Node | None", dropped: bool, evidence: int = 0) -> None:
        self.name, self.parent, self.dropped = name, parent, dropped
        self.evidence = evidence  # that it is no part of the article; _spare() decides
        self.depth: int = parent.depth + 1 if parent else 0
        self.children: list["Node | str"] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.peak = self  # the node at or below this one with the largest sum
        self.keep = False


def _named(token: str) -> int:
    """What a name of class or id says. It counts if it consists of such words alone,
    with what they may be composed with ("ad-2", "cookieNotice", "user-comments",
    "share-buttons"); "has-sidebar" and "comments-open" say something else."""
    words = [w.lower() for w in _WORD.findall(token)]
    if not all(w in NEVER or w in FRAME or w in AFFIXES for w in words):
        return 0
    return BESIDE if any(w in NEVER for w in words) else AROUND if any(w in FRAME for w in words) else 0


def _evidence(name: str, rest: str) -> tuple[bool, int]:
    """Whether an element is dropped by its tag, and what else speaks against it."""
    if name in DROPPED:
        return True, 0
    found = TAGS.get(name, 0)
    if not rest or name in ("html", "body", "main", "article"):
        return False, found
    for m in _ATTRIBUTE.finditer(rest):
        key = m.group(1).lower()
        value = m.group(2) or m.group(3) or m.group(4) or ""
        if key == "role" and value.lower() in ROLES or key == "aria-hidden" and value.lower() == "true":
            found = max(found, AROUND)
        elif key in ("class", "id"):
            found = max([found, *map(_named, value.split())])
    if re.search(r"(?:^|\s)hidden(?=[\s=/]|$)", _ATTRIBUTE.sub(" ", rest)):
        found = max(found, AROUND)
    return False, found


def _spare(root: Node) -> None:
    """Drop what there is evidence against, with a second look.

    A header in an article, section or main element that has a headline is the
    article's own. What stands beside the article (comments, adverts, page headers)
    goes however long it is, if the page says anything without it; if it holds an
    article or main element, only if there is another one outside. What may be
    wrapped around the article stays if it holds an article or main element; it goes
    if there is one elsewhere; and on a page without, it stays only with two thirds
    of the text, outside links, that does not stand beside, and a paragraph at least.
    """
    order = _walk(root)
    if not any(x.evidence for x in order):
        return
    beside: set[int] = set()  # nodes in parts that stand beside
    inside: set[int] = set()  # nodes in an article
    for node in order:
        x = node.parent
        if x is not None and (x.name in ("article", "section", "main") or id(x) in inside and x.name != "body"):
            inside.add(id(node))
        if node.evidence and id(node) in inside and node.name in ("header", "div", "hgroup", "section") and _headline(node):
            words = node.evidence == AROUND or node.name == "header"
            node.evidence = 0 if words else node.evidence
        if node.evidence == BESIDE or x is not None and id(x) in beside:
            beside.add(id(node))
    plain: dict[int, int] = {}  # characters outside links and outside what stands beside
    any_: dict[int, int] = {}  # the same with links
    holds: dict[int, bool] = {}
    for node in reversed(order):
        own, linked, has = 0, 0, False
        for c in node.children:
            if type(c) is str:
                n = 0 if id(node) in beside else len("".join(c.split()))
                own, linked = own + n, linked + n
            elif not c.dropped:
                own, linked = own + plain[id(c)], linked + any_[id(c)]
                has = has or holds[id(c)] or c.name in ("article", "main")
        plain[id(node)], any_[id(node)], holds[id(node)] = 0 if node.name == "a" else own, linked, has
    elsewhere = any(x.name in ("article", "main") and id(x) not in beside and any_[id(x)] for x in order)
    total, said = plain[id(root)], any_[id(root)]
    for node in order:
        if node.evidence == BESIDE:
            node.dropped = elsewhere if holds[id(node)] else said > 0
        elif node.evidence == AROUND and not (holds[id(node)] and id(node) not in inside):
            n = plain[id(node)]
            node.dropped = elsewhere or 3 * n < 2 * total or n < LEAST_ARTICLE and n < total


def _headline(node: Node) -> bool:
    """Whether a heading of the first two levels is in it."""
    return any(x.name in ("h1", "h2") for x in _walk(node))


def parse(html: str) -> Node:
    """The tree of a page, as browsers repair it in the common cases: optional end
    tags, end tags that fit nothing, elements left open."""
    root = Node("html", None, False)
    here, at, n = root, 0, len(html)
    open_p: list[Node] = []  # open paragraphs, so that looking for one costs nothing
    flat: dict[str, int] = {}  # elements that were not nested, by name

    def leave(node: Node) -> Node:
        """Close up to and with this one."""
        while open_p and _inside(open_p[-1], node):
            open_p.pop()
        return node.parent or root

    def _inside(p: Node, node: Node) -> bool:
        x = here
        while x is not None:
            if x is p:
                return True
            if x is node:
                return False
            x = x.parent
        return True  # already left

    while at < n:
        m = _MARK.search(html, at)
        if m is None:
            here.children.append(html[at:])
            break
        if m.start() > at:
            here.children.append(html[at:m.start()])
        at = m.end()
        name = m.group("name")
        if name is None:
            continue
        name = name.lower()
        if m.group("close"):
            if flat.get(name):
                flat[name] -= 1
                continue
            x = here
            while x is not None and x.name != name:
                # An inline element's end tag does not reach out of a table cell.
                x = None if x.name in ("td", "th", "table") and name not in BLOCK else x.parent
            if x is not None and x is not root:
                here = leave(x)
            continue
        rest = m.group("rest") or ""
        if name in RAW:
            end = _END[name].search(html, at)
            if end or name in ("script", "style", "title", "textarea", "xmp"):
                at = end.end() if end else n
            continue  # none of these holds text of the page; one of the others without an end is taken for a stray tag
        if name in ("html", "body"):
            if name == "body" and here.name in ("html", "head"):
                body = Node("body", root, False)
                root.children.append(body)
                here = body
            continue
        if name in ENDS_P and open_p:
            p = open_p[-1]
            x = here
            while x is not None and x is not p and x.name not in ("td", "th", "table", "button"):
                x = x.parent
            if x is p:
                here = leave(p)
        if name in CLOSES:
            same, stop = CLOSES[name]
            x, found = here, None
            while x is not None and x.name not in stop:
                if x.name in same.split():
                    found = x
                x = x.parent
            if found is not None:
                here = leave(found)
        if name != "head" and here.name == "head" and name not in ("meta", "link", "base"):
            here = here.parent or root
        node = Node(name, here, *_evidence(name, rest))
        here.children.append(node)
        if name not in VOID and not rest.rstrip().endswith("/" if name in ("svg", "path") else "\0"):
            if here.depth >= DEEPEST:
                flat[name] = flat.get(name, 0) + 1
                continue
            here = node
            if name == "p":
                open_p.append(node)
    return root


def _walk(root: Node) -> list[Node]:
    """Nodes that are not dropped, parents first."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.dropped:
            continue
        found.append(node)
        todo += [c for c in reversed(node.children) if type(c) is not str]
    return found


def _measure(nodes: list[Node]) -> None:
    """Characters, tags, link characters and link tags below each node; then its
    composite density and the sum of its children's densities."""
    for node in reversed(nodes):
        for c in node.children:
            if type(c) is str:
                node.chars += len("".join(c.split()))
            elif not c.dropped:
                node.chars += c.chars
                node.tags += c.tags + 1
                node.link_chars += c.link_chars
                node.link_tags += c.link_tags
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
    body = nodes[0]
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        c, lc = node.chars, node.link_chars
        if not c:
            continue
        t, lt = max(node.tags, 1), max(node.link_tags, 1)
        plain = max(c - lc, 1)
        base = math.log(c / plain * lc + share * c + math.e)
        ratio = c / max(lc, 1) * t / lt
        node.density = c / t * (math.log(ratio) / math.log(base) if ratio > 1 and base > 1 else 0.0)
    for node in reversed(nodes):
        node.sum = sum(c.density for c in node.children if type(c) is not str and not c.dropped)
        for c in node.children:
            if type(c) is not str and not c.dropped and c.peak.sum > node.peak.sum:
                node.peak = c.peak


def _select(nodes: list[Node]) -> None:
    """Mark the subtrees of the article.

    The node with the largest sum of child densities is taken; the smallest density on
    its path to the body is the threshold, and below every node that reaches it the
    subtree with the largest sum is taken too. A subtree inside an article or main
    element stands for that element.
    """
    body = nodes[0]
    top = max(nodes, key=lambda x: x.sum)
    threshold, x = top.density, top
    while x is not None:
        threshold = min(threshold, x.density)
        x = x.parent if x is not body else None
    for node in nodes:
        if not node.chars or node.density < threshold:
            continue
        x = node.peak
        while x is not None and x.name not in ("article", "main"):
            x = x.parent
        (x or node.peak).keep = True


def main_text(html: str) -> str:
    root = parse(html)
    _spare(root)
    nodes = _walk(root)
    body = next((x for x in nodes if x.name == "body"), root)
    if body is not root:
        # What browsers would move into the body.
        body.children += [c for c in root.children if c is not body and (type(c) is str or c.name != "head")]
        for c in body.children:
            if type(c) is not str:
                c.parent = body
        nodes = _walk(body)
    _measure(nodes)
    if not nodes or not nodes[0].chars:
        return ""
    _select(nodes)
    blocks: list[str] = []
    inline: list[str] = []

    def close() -> None:
        if inline:
            text = _SPACE.sub(" ", "".join(inline)).strip()
            if text:
                blocks.append(text)
            inline.clear()

    # (node, position among its children, inside a kept subtree)
    todo: list[tuple[Node | str, bool, bool]] = [(nodes[0], nodes[0].keep, False)]
    while todo:
        node, kept, ended = todo.pop()
        if type(node) is str:
            if kept:
                inline.append(unescape(node))  # by itself: no reference reaches over a tag
        elif ended:
            close()
        elif node.dropped:
            if node.name in BLOCK or node.name in DROPPED:
                close()
        elif node.name == "br":
            inline.append(" ")
        else:
            kept = kept or node.keep
            if node.name in BLOCK:
                close()
                todo.append((node, kept, True))
            todo += [(c, kept, False) for c in reversed(node.children)]
    close()
    return "\n".join(blocks)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``, a row per row.

    Blocks of the main text in page order, joined by one line feed; in a block white
    space is one space and a line break is white space. A null or empty page, and a
    page without text, has an empty text and zero characters. Repeated rows, and rows
    without page_id or url, get a row each; an empty table gives none. Other
    columns are ignored.
    """
    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in sliced(batch):
                done = [main_text(h) for h in part.column("text").to_pylist()]
                yield batches({
                    "page_id": part.column("page_id"), "url": part.column("url"), "text": done, "n_chars": [len(t) for t in done],
                }, _ROWS)

    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("text"),
    )
    return arrow_map(rows, task, "page_id long, url string, text string, n_chars long")
