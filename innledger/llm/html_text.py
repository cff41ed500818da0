"""Main text of web pages by composite text density.

A page becomes a tree of its elements. For every node the density is its characters per
tag, adjusted by how many of both belong to links. The container whose children's densities
add up to the most is the core of the page, or the article or main part it lies in; the
least density on the path from it to the body is the threshold. Every node that reaches it
counts: a text block is kept, an article whole, and any other container with its own text
and text blocks and its densest container, so that an article in several parts is found
whole. Menus, adverts, forms and the like are not part of the tree if their element, role or
class says so. A class that has such a word among others (``related-work``) is evidence only:
it halves the density of its node, which stays if that still reaches the threshold.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Elements of HTML by how they are read, and words of class names.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template".split())
HEAD = frozenset("base link meta script style title noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of running text; never a container.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre li dt dd ul ol dl tr blockquote figure".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search "
    "section summary table ul".split()
)
#: An element that ends an open one of the second set, unless one of the third is between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
NOISE = frozenset(
    "head script style noscript template svg math canvas iframe object embed applet audio "
    "video nav aside footer form button select input textarea fieldset dialog menu search "
    "title".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar toolbar status tablist".split()
)
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored "
    "promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar sidenav footer "
    "masthead topbar comment comments commentlist respond replies disqus cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations widget widgets pagination "
    "pager toolbar skip".split()
)
#: Of these, the ones that also name parts of an article; on a text block they are evidence.
DOUBTFUL_WORDS = frozenset(
    "notice notices related recommended recommendations share sharing social widget widgets "
    "banner promotion login modal skip toolbar comment masthead".split()
)
#: Words that say where or how something stands, and not what it is.
PLACE_WORDS = frozenset(
    "a all and area bar block body bottom box btn button buttons by center col column container "
    "content entry for form global group head header icon icons in inner input item items label "
    "law left link links list main message more msg new of on our outer page panel policy "
    "popular post posts reader region right row section site slot story stories text the thread "
    "title to top unit user users view wrap wrapper your zone article articles".split()
)

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<([/!?]?)([a-zA-Z][^\s/>]*+)?((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
#: The same where a quote is not closed.
LOOSE_TAG = re.compile(r"<([/!?]?)([a-zA-Z][^\s/>]*+)?([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class _Node:
    __slots__ = ("tag", "parent", "content", "chars", "tags", "link_chars", "link_tags", "density", "sum", "doubt")

    def __init__(self, tag: str, parent: _Node | None):
        self.tag, self.parent = tag, parent
        self.content: list[_Node | str] = []
        self.doubt = False  # whether a class is evidence against it


def _class_says(tag: str, value: str) -> bool | None:
    """Whether a class or id names noise; None if it might."""
    says: bool | None = False
    for name in value.split():
        words = [x.lower() for x in WORDS.findall(name)]
        noise = NOISE_WORDS.intersection(words)
        if noise:
            others = (x for x in words if x not in NOISE_WORDS and len(x) > 1 and not x.isdigit())
            doubtful = tag in TEXT_BLOCKS and noise <= DOUBTFUL_WORDS
            if not doubtful and PLACE_WORDS.issuperset(others):
                return True
            says = None
    return says


def _is_noise(tag: str, attributes: str, parent: _Node) -> bool | None:
    """Whether an element is no part of the main text; None if a class is evidence for it."""
    doubt: bool | None = False
    if tag in NOISE:
        return True
    if tag == "header":
        above = parent
        while above is not None and above.tag != "article":
            above = above.parent
        return above is None
    if not attributes.strip(" /") or tag in ("html", "body", "main"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, text = name.lower(), "".join(values)
        value = text.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value.strip() in NOISE_ROLES:
            return True
        if name in ("class", "id"):
            says = _class_says(tag, text)
            if says:
                return True
            doubt = None if says is None else doubt
    return doubt


def parsed(page: str) -> _Node:
    """The body of a page as a tree, without noise.

    End tags may be missing or wrong: an element also ends where it must, and an end tag
    that nothing is open for is passed over.
    """
    body = _Node("body", None)
    stack = [(body, False)]  # nodes that are open, and whether they are dropped
    at = 0

    def close(number: int) -> None:
        del stack[number:]

    def add(text: str) -> None:
        if text and not stack[-1][1]:
            stack[-1][0].content.append(html.unescape(text))

    while at < len(page):
        start = page.find("<", at)
        if start < 0 or page.find(">", start) < 0:
            break
        match = TAG.match(page, start) or LOOSE_TAG.match(page, start)
        if not match or (match[2] is None and not match[1] and not match[0].startswith("<!--")):
            add(page[at : start + 1])  # no tag
            at = start + 1
            continue
        add(page[at:start])
        at = match.end()
        kind, tag, attributes = match[1], (match[2] or "").lower(), match[3] or ""
        if not tag or kind in ("!", "?") or tag in ("html", "body"):
            continue
        if kind == "/":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0].tag == tag:
                    close(k)
                    break
            continue
        if stack[-1][0].tag == "head" and tag not in HEAD:
            close(len(stack) - 1)
        if tag in CLOSES_P:
            _end_open(stack, {"p"}, {"table", "td", "th", "button", "object"})
        if tag in ENDS:
            _end_open(stack, *ENDS[tag])
        node, dropped = _Node(tag, stack[-1][0]), stack[-1][1]
        noise = _is_noise(tag, attributes, stack[-1][0])
        dropped, node.doubt = dropped or bool(noise), noise is None
        if not dropped:
            stack[-1][0].content.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if not dropped:
                stack.append((node, False))
                add(page[at : end.start() if end else len(page)])
                stack.pop()
            at = end.start() if end else len(page)
        elif tag not in VOID:
            stack.append((node, dropped))
    add(page[at:])
    for node in _in_order(body):  # of headers in an article, only its own have a heading
        node.content = [x for x in node.content if isinstance(x, str) or not _is_banner(x)]
    return body


def _is_banner(node: _Node) -> bool:
    return node.tag == "header" and HEADINGS.isdisjoint(x.tag for x in _in_order(node))


def _end_open(stack: list, ended: set[str], barrier: set[str]) -> None:
    last = None
    for k in range(len(stack) - 1, 0, -1):
        tag = stack[k][0].tag
        if tag in barrier:
            break
        if tag in ended:
            last = k
    if last is not None:
        del stack[last:]


def _in_order(body: _Node) -> list[_Node]:
    """All nodes, parents before their children."""
    nodes = [body]
    for node in nodes:
        nodes += [x for x in node.content if isinstance(x, _Node)]
    return nodes


def measure(body: _Node) -> list[_Node]:
    """Fill in characters, tags, composite density and the sum of the children's."""
    nodes = _in_order(body)
    for node in reversed(nodes):
        children = [x for x in node.content if isinstance(x, _Node)]
        own = sum(len("".join(x.split())) for x in node.content if isinstance(x, str))
        node.chars = own + sum(x.chars for x in children)
        node.tags = sum(x.tags + 1 for x in children)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
        else:
            node.link_chars = sum(x.link_chars for x in children)
            node.link_tags = sum(x.link_tags + (x.tag == "a") for x in children)
    ratio = body.link_chars / max(1, body.chars)
    for node in nodes:
        c, t = node.chars, max(1, node.tags)
        lc, lt = max(1, node.link_chars), max(1, node.link_tags)
        if c:
            base = math.log(c * lc / max(1, c - node.link_chars) + ratio * c + math.e)
            node.density = c / t * max(0.0, math.log(c / lc * t / lt + 1e-9) / math.log(base + 1e-9))
        else:
            node.density = 0.0
    for node in nodes:
        node.sum = sum(x.density for x in node.content if isinstance(x, _Node))
    return nodes


def _is_container(node: _Node) -> bool:
    return node.tag not in INLINE and node.tag not in TEXT_BLOCKS


def _densest(node: _Node) -> _Node:
    """The container below or at ``node`` with the largest sum; the first of equal ones."""
    inside = [x for x in _in_order(node) if _is_container(x)] or [node]
    best = max(inside, key=lambda x: x.sum)
    return best if best.sum > 0 else node


def _article_around(node: _Node) -> _Node:
    """The article, or else the main part, that ``node`` belongs to; else itself."""
    around = node
    above: _Node | None = node
    while above is not None:
        if above.tag == "article":
            return above
        if above.tag == "main":
            around = above
        above = above.parent
    return around


def content(body: _Node) -> _Node:
    """The tree with only the nodes that make up the main text."""
    measure(body)
    found = _Node("body", None)
    if not body.chars:
        return found
    core = _article_around(_densest(body))
    threshold, above = core.density, core.parent
    while above is not None:
        threshold = min(threshold, above.density)
        above = above.parent
    path = set()
    above = core
    while above is not None:
        path.add(id(above))
        above = above.parent
    for node in _in_order(body):
        node.content = [
            x for x in node.content
            if isinstance(x, str) or not x.doubt or id(x) in path
            or (x.density / 2 >= threshold and 2 * x.link_chars < x.chars)
        ]
    whole = {id(core)}
    for node in _in_order(body):
        if node is not body and _is_container(node) and node.density >= threshold:
            whole.add(id(node if node.tag in ("article", "main") else _densest(node)))
    todo = [(body, found)]
    while todo:
        node, copy = todo.pop()
        if id(node) in whole:
            copy.content = node.content
            continue
        dense = node.density >= threshold
        # A link within a container's own text belongs to it.
        running = dense and any(
            x.strip() if isinstance(x, str) else x.tag in INLINE and _of_text(x) for x in node.content
        )
        for x in node.content:
            if isinstance(x, str):
                if dense:
                    copy.content.append(x)
            elif running and x.tag in INLINE:
                copy.content.append(x)
            elif _is_container(x) or not (_of_text(x) if dense else x.density >= threshold):
                copy.content.append(_Node(x.tag, copy))
                todo.append((x, copy.content[-1]))
            else:
                copy.content.append(x)
    return found


def _of_text(node: _Node) -> bool:
    """Whether there is text in ``node`` that is no link."""
    return node.chars > node.link_chars


def blocks(node: _Node) -> list[str]:
    """The text of each block below ``node``, white space made single spaces."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    todo: list = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            run.append(item)
        elif item is None:
            end()
        elif item.tag == "br":
            run.append(" ")
        elif item.tag in INLINE:
            todo += reversed(item.content)
        else:
            end()
            todo += [None, *reversed(item.content)]
    end()
    return out


def main_text(page: str) -> str:
    """The article of a page: blocks joined by line feeds; empty if there is no text."""
    return "\n".join(blocks(content(parsed(page))))


def extracted(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of ``html``.

    Null and empty pages have an empty text. A page without tags is one block. Other columns
    are carried along untouched; those named ``text`` and ``n_chars`` are replaced.
    """
    pages = pages.drop("text", "n_chars")
    place = pages.columns.index("html")
    kept = [i for i in range(len(pages.columns)) if i != place]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x or "") for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())],
                names=[*(batch.schema.names[i] for i in kept), "text", "n_chars"],
            )

    added = [StructField("text", StringType()), StructField("n_chars", LongType())]
    return pages.mapInArrow(extract, StructType([*(pages.schema.fields[i] for i in kept), *added]))
