"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by how they are handled, and words in class, id or role that tell what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form head iframe input label link menu meta nav noscript object "
    "option script select style svg template textarea title video".split()
)
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p "
    "pre section summary table tbody tfoot thead tr ul aside footer form nav fieldset dialog menu".split()
)
CLOSES_P = BLOCKS - {"body", "html", "caption", "dd", "dt", "li", "tbody", "tfoot", "thead", "tr"} | {"dd", "dt", "li"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies disclaimer footer gdpr masthead menu "
    "modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related share "
    "sharing sidebar social sponsor sponsored subscribe subscription toolbar widget".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies responses".split())
PLACE_WORDS = frozenset(
    "area bar block bottom box btn button buttons container content form global group header icons inner item items left links list main outer page panel primary "
    "right secondary section sidebar site sticky text title top unit wrap wrapper".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
CONTENT = ("article", "main")


class Node:
    __slots__ = ("aside", "chars", "density", "kids", "link_chars", "link_tags", "parent", "sum", "tag", "tags")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.kids = tag, parent, []
        self.aside = ""  # what its class, id or role says it is, if not of the article


class Tree(HTMLParser):
    """The elements that may belong to an article; what never does is left out while parsing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("html", None)
        self.skip: list[str] = []  # open elements from the first that is left out

    def handle_starttag(self, tag, attrs):
        if len(self.skip) == 1 and (self.skip[0] == "p" and tag in CLOSES_P or tag in SAME.get(self.skip[0], ())):
            self.skip.clear()  # what is left out ends where its end tag may be left out
        if self.skip:
            if tag not in VOID:
                self.skip.append(tag)
            return
        if tag == "br":
            self.here.kids.append(" ")
        if tag in VOID or tag == "html":
            return
        if tag in CLOSES_P:
            self._close({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "body", "button"} - {tag} | ({"li"} if tag == "li" else set()))
        if tag in SAME:
            self._close(SAME[tag], FENCES[tag])
        if tag == "body" and any(isinstance(k, Node) and k.tag == "body" for k in self.root.kids):
            return
        named = {k: (v or "") for k, v in attrs}
        if self._left_out(tag, named):
            self.skip.append(tag)
            return
        node = Node(tag, self.here)
        node.aside = self._aside(tag, named)
        self.here.kids.append(node)
        self.here = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "iframe", "script"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:
                at = len(self.skip) - 1 - self.skip[::-1].index(tag)
                del self.skip[at:]
            elif tag in ("body", "html") or tag in CONTENT:
                self.skip.clear()
                self._close({tag}, set())
            return
        if tag not in VOID and tag not in ("html", "body"):
            self._close({tag}, set() if tag in BLOCKS or tag in ("td", "th") else BLOCKS | {"td", "th"})

    def handle_data(self, data):
        if not self.skip:
            self.here.kids.append(data)

    def _close(self, tags: set, fences: set) -> None:
        """Leaves the nearest open element of ``tags``, unless one of ``fences`` stands before it."""
        node = self.here
        while node is not self.root:
            if node.tag in tags:
                self.here = node.parent
                return
            if node.tag in fences:
                return
            node = node.parent

    def _inside(self) -> bool:
        node = self.here
        while node is not None and node.tag not in CONTENT:
            node = node.parent
        return node is not None

    def _left_out(self, tag: str, attrs: dict) -> bool:
        if tag in NEVER or tag == "header" and not self._inside():
            return True
        hides = "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", ""))
        return bool(hides) and tag not in ("body", "main")

    def _aside(self, tag: str, attrs: dict) -> str:
        """"comments" or "aside" where a name in class or id says so with all its words, or the role does.

        A name such as has-sidebar or share-price has a word of its own and says nothing.
        """
        if tag in ("body", "main"):
            return ""
        spelled = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", f"{attrs.get('class', '')} {attrs.get('id', '')}")
        names = [words for name in spelled.lower().split() if (words := set(re.findall(r"[a-z]+", name)))]
        if any(words & COMMENT_WORDS and words <= COMMENT_WORDS | PLACE_WORDS for words in names):
            return "comments"
        if tag == "article":
            return ""
        plain_header = {"header"} in names and not self._inside() and tag in ("div", "section")
        named = any(words & ASIDE_WORDS and words <= ASIDE_WORDS | PLACE_WORDS for words in names)
        return "aside" if named or plain_header or attrs.get("role", "").lower() in ROLES else ""


def _prune(root: Node) -> None:
    """Takes out what names itself as no part of the article.

    What holds an article or main element that does not is a wrapper and stays. Where the page has no such element,
    what holds most of its text in several paragraphs stays too, unless it is comments.
    """
    nodes = _order(root)
    chars: dict[int, int] = {}
    holds: dict[int, bool] = {}
    paragraphs: dict[int, int] = {}
    for node in reversed(nodes):
        kids = [k for k in node.kids if isinstance(k, Node)]
        chars[id(node)] = sum(len("".join(k.split())) for k in node.kids if isinstance(k, str)) + sum(chars[id(k)] for k in kids)
        paragraphs[id(node)] = (node.tag == "p") + sum(paragraphs[id(k)] for k in kids)
        holds[id(node)] = any(holds[id(k)] or k.tag in CONTENT and not k.aside for k in kids)

    def goes(node: Node) -> bool:
        story = node.aside == "aside" and not holds[id(root)] and paragraphs[id(node)] > 2 and 2 * chars[id(node)] > chars[id(root)]
        return bool(node.aside) and not holds[id(node)] and not story

    for node in nodes:
        node.kids = [k for k in node.kids if isinstance(k, str) or not goes(k)]


def _order(root: Node) -> list[Node]:
    """Elements, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [k for k in node.kids if isinstance(k, Node)]
    return out


def _measure(nodes: list[Node]) -> None:
    """Link-adjusted characters per tag of every node, and the sum of it over the node's children."""
    for node in reversed(nodes):
        own = sum(len("".join(k.split())) for k in node.kids if isinstance(k, str))
        kids = [k for k in node.kids if isinstance(k, Node)]
        node.chars = own + sum(k.chars for k in kids)
        node.tags = len(kids) + sum(k.tags for k in kids)
        is_link = node.tag == "a"
        node.link_chars = node.chars if is_link else sum(k.link_chars for k in kids)
        node.link_tags = 1 + node.tags if is_link else sum(k.link_tags for k in kids)
    body = nodes[0]
    share = body.link_chars / max(1, body.chars)
    for node in reversed(nodes):
        c, links, tags, link_tags = node.chars, max(1, node.link_chars), max(1, node.tags), max(1, node.link_tags)
        base = math.log(c / max(1, c - node.link_chars) * node.link_chars + share * c + math.e)
        spread = math.log(c / links * tags / link_tags) if c else 0.0
        node.density = max(0.0, c / tags * spread / max(math.log(base), 0.05))
        node.sum = sum(k.density for k in node.kids if isinstance(k, Node))


def _choose(root: Node) -> Node:
    """The subtree of the largest density sum, widened while its path to the body stays as dense as its threshold.

    The threshold is the least density between that subtree and the body. An ancestor that holds more text of
    at least that density takes over, and an article or main element on the path ends the climb. Where the
    sum picks a node that contains such an element with most of its text, that element is taken.
    """
    nodes = _order(root)
    _measure(nodes)
    best = max(nodes, key=lambda n: (n.sum, n.chars))
    path, node = [], best
    while node is not None and node.tag not in ("html", "body"):
        path.append(node)
        node = node.parent
    threshold = min((n.density for n in path), default=0.0)
    for node in path:
        held = sum(k.chars for k in node.kids if isinstance(k, Node) and k.density >= threshold)
        if node.tag in CONTENT or held > best.chars and node.link_chars < node.chars / 3:
            best = node
        if node.tag in CONTENT:
            return best
    inner = max((n for n in _order(best) if n.tag in CONTENT), key=lambda n: (n.sum, n.chars), default=None)
    if inner is not None:
        return inner if 2 * inner.chars > best.chars else best
    beside = max((n for n in nodes if n.tag in CONTENT), key=lambda n: (n.sum, n.chars), default=best)
    return beside if 4 * beside.chars >= best.chars else best


def main_text(html: str) -> str:
    """The article of a page, its blocks joined by an empty line; "" where there is none."""
    tree = Tree()
    tree.feed(re.sub(r"<[A-Za-z/!][^>]*\Z", "", html))
    tree.close()
    _prune(tree.root)
    blocks: list[list[str]] = [[]]
    todo: list = [_choose(tree.root)]
    while todo:
        item = todo.pop()
        if item is None:
            blocks.append([])
        elif isinstance(item, str):
            blocks[-1].append(item)
        else:
            inner = [k for k in reversed(item.kids)]
            if item.tag in BLOCKS:
                todo += [None, *inner, None]
            elif item.tag in ("td", "th"):
                todo += [" ", *inner, " "]
            else:
                todo += inner
    return "\n\n".join(t for b in blocks if (t := " ".join("".join(b).split())))


def page_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``.

    Null and empty pages, and pages without an article, have an empty text. Pages that stop in the middle of
    a tag lose that tag only. Repeated rows stay; other columns are ignored; no page is cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) if h else "" for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
