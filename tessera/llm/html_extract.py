"""Main-text extraction from HTML by tree scoring.

A page is parsed into a tree of its elements. Every paragraph of text passes points for its length
and its commas to its parent and, halved, to its grandparent and so on; a container's points are
discounted by its link density. Every element that received points can be the best container; from
it the choice climbs to the common ancestor while a neighbour holds text, up to the body. It is kept
with those of its siblings that score near it or read like text (headings, articles, paragraphs, and
whatever is not mostly links), and their blocks of text, with character references decoded, are joined in page order.
Elements that are never part of an article (scripts, menus, headers of the page, forms, adverts,
comments, ...) are left out before the scoring, by tag, or by a class or id all of whose words are of
that kind (``sidebar``, ``post-comments``) or say nothing (``box``, ``left``). One with such a word
beside others (``share-price``, ``login-guide``) is a suspect: outside an article element its place
agrees and it goes, inside one it goes only if it is mostly links.

Defined cases: a null or empty page, or one without text outside such elements, gives the empty
text. Unclosed and misnested elements are closed as browsers close paragraphs, list items and table
cells. A quote that is left open in a tag ends with the tag, and a tag without an end ends before the
next one. The work grows with the length of the page, however deep or broken it is. Every row is extracted by itself, so repeated rows and null ids stay. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without content, whose content is raw text, and that start a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes template xmp svg math".split())
BLOCK = set("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
            "summary table tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCK - {"br", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
# Elements that an equal (or named) open sibling ends.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}}
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup header".split())
LIST_ENDS = {"ul", "ol", "dl", "table", "select", "menu"}

# Elements left out: by tag, by ARIA role, and by a word of class or id.
OUT_TAGS = set("nav footer aside form button input select option dialog menu iframe object embed canvas audio video "
               "map label fieldset head".split()) | RAW
OUT_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
OUT_WORDS = set("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo nav navbar navigation "
                "breadcrumb breadcrumbs sidebar footer masthead topbar toolbar cookie cookies consent gdpr popup modal "
                "newsletter subscribe subscription signup login share sharing disqus comment comments commentlist "
                "pagination pager skip".split())
# Words that leave an element out unless another one says that it holds the article.
WEAK_WORDS = set("banner menu aside header notice overlay social related recommended recommendations widget replies "
                 "reply respond tags copyright legal disclaimer hidden promotion".split())
KEEP_WORDS = set("article body content main post story entry text".split())
# Words of a class or id that say nothing about what an element holds.
PLAIN_WORDS = set("bar block bottom box btn button buttons col column container form global group icon icons inner item items "
                  "js left links list module outer page panel post primary right row secondary section site slot sticky sub "
                  "the thread title top unit web wrap wrapper area".split())

# A quoted value that holds < or > counts as one only if its end looks like one (no = before it, a space
# or the tag's end after it); any other quote in a tag is a plain character.
_QUOTED = r"""{0}[^{0}<>]*+{0}|{0}[^{0}]*+(?<!=){0}(?=[\s/>])"""
SUSPECT_LINKS = 0.3
#: Points are halved from parent to parent; beyond some forty they no longer count.
LEAST_SHARE = 2.0**-40

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/><]*)(?P<attrs>(?>[^>\"'<]+|"
    + _QUOTED.format('"') + "|" + _QUOTED.format("'") + r"|[\"'])*+)(?:>|(?=<)|\Z)|<[!?/][^>]*>?", re.S)
_ATTR = re.compile(r"(?:^|[\s/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|$)", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element: whether it is left out or a suspect, stands in an article or a link, its nearest
    block element, and what it holds."""

    __slots__ = ("tag", "parent", "out", "suspect", "inside", "link", "block", "points", "chars", "linked", "order")

    def __init__(self, tag: str, parent: "Node | None", out: bool, suspect: bool, order: int):
        self.tag, self.parent, self.out, self.suspect, self.order = tag, parent, out, suspect, order
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.link = tag == "a" or parent is not None and parent.link
        self.block = self if tag in BLOCK or parent is None else parent.block
        self.points, self.chars, self.linked = 0.0, 0, 0


def _left_out(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """(left out, suspect)."""
    if tag in OUT_TAGS or tag == "header" and not in_article:
        return True, False
    if not attrs or tag in ("html", "body", "article", "main"):
        return False, False
    names: list[set[str]] = []
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value) \
                or name == "role" and value.lower() in OUT_ROLES:
            return True, False
        if name in ("class", "id"):
            names += [{w.lower() for w in _WORD.findall(one)} for one in value.split()]
    weak = set() if any(n & KEEP_WORDS for n in names) else WEAK_WORDS
    said = [n for n in names if n & OUT_WORDS or n & weak]
    if not said:
        return False, False
    sure = any(n <= OUT_WORDS | WEAK_WORDS | PLAIN_WORDS for n in said)
    return sure or not in_article, not sure


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """The elements in page order, and the blocks of text as (element, text)."""
    root = Node("#root", None, False, False, 0)
    nodes, blocks, stack = [root], [], [root]
    is_open: Counter[str] = Counter()  # by tag, how many elements on the stack
    run: list[str] = []  # text of the block being read
    owner, linked = root, 0

    def flush() -> None:
        nonlocal run, linked
        if run:
            text = _SPACE.sub(" ", "".join(run)).strip()
            if text and not owner.out:
                blocks.append((owner, text))
                owner.chars += len(text)
                owner.linked += min(linked, len(text))
        run, linked = [], 0

    def add(text: str) -> None:
        nonlocal owner, linked
        at = stack[-1]
        if at.out or not text:
            return
        if not run:
            owner = at.block
        text = html.unescape(text)
        run.append(text)
        if at.link:
            linked += len(text.strip())

    def depth_of(tag: str) -> int:
        """The place of the innermost open element of a tag, or 0: all above it is about to be closed."""
        return next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag) if is_open[tag] else 0

    def close(upto: int) -> None:
        if any(n.tag in BLOCK for n in stack[upto:]):
            flush()
        is_open.subtract(n.tag for n in stack[upto:])
        del stack[upto:]

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        add(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            depth = depth_of(tag)
            if depth:
                close(depth)
            elif tag in ("p", "br"):
                flush()
            continue
        attrs = m["attrs"] or ""
        if tag in CLOSES_P:
            depth = depth_of("p")
            if depth:
                close(depth)
        if any(is_open[t] for t in ENDED_BY.get(tag, ())):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ENDED_BY[tag]:
                    close(i)
                    break
                if stack[i].tag in LIST_ENDS:
                    break
        if tag in BLOCK:
            flush()
        if tag in VOID or attrs.endswith("/") and tag in ("svg", "path"):
            continue
        parent = stack[-1]
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        out, suspect = (True, False) if parent.out else _left_out(tag, attrs, parent.inside)
        node = Node(tag, parent, out, suspect, len(nodes))
        nodes.append(node)
        stack.append(node)
        is_open[tag] += 1
    flush()
    return nodes, blocks


def _gather(nodes: list[Node]) -> None:
    """Add what elements hold up to their parents; children come after their parents."""
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked


def _drop_suspects(nodes: list[Node], blocks: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """The blocks without those of suspects that are mostly links."""
    own = [(n.chars, n.linked) for n in nodes]
    _gather(nodes)
    for node in nodes:
        node.out = node.out or node.parent is not None and node.parent.out or \
            node.suspect and node.chars > 0 and node.linked >= SUSPECT_LINKS * node.chars
    for node, (chars, linked) in zip(nodes, own):
        node.chars, node.linked = (0, 0) if node.out else (chars, linked)
    return [(node, text) for node, text in blocks if not node.out]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    nodes, blocks = parse(page)
    if any(n.suspect and not n.out for n in nodes):
        blocks = _drop_suspects(nodes, blocks)
    if not blocks:
        return ""
    for node, text in blocks:
        points = 1 + text.count(",") + min(3.0, len(text) / 100)
        up, share = node, 1.0
        while up is not None and share > LEAST_SHARE:
            up.points += points * share
            share /= 2
            up = up.parent
    _gather(nodes)

    def density(n: Node) -> float:
        return n.linked / n.chars if n.chars else 0.0

    def score(n: Node) -> float:
        return n.points * (1 - density(n))
    holders = [n for n in nodes if not n.out and n.chars and n.tag in ("article", "main")]
    if not holders:
        owners = {id(n) for n, _ in blocks}  # the page or its body only if it holds text itself
        holders = [n for n in nodes if not n.out and n.chars and (n.tag in BLOCK - {"body"} or id(n) in owners)]
    best = max(holders, key=lambda n: (score(n), -n.order))
    children: dict[int, list[Node]] = {}
    for n in nodes:
        if n.parent is not None and not n.out and n.chars:
            children.setdefault(id(n.parent), []).append(n)

    def beside(at: Node) -> list[Node]:
        """Siblings that belong to the text."""
        return [n for n in children.get(id(at.parent), []) if n is not at and density(n) < 0.5
                and (n.tag in HEADINGS or n.tag in BLOCK and density(n) < 0.25 or score(n) >= 0.2 * score(best))]

    at = best
    while at.parent is not None and at.tag != "body" and at.parent.tag not in ("body", "html", "#root"):
        at = at.parent
        if any(n is not at for n in children[id(at)]) and density(at) < 0.25:
            best = at
    keep = {id(best)} | {id(n) for n in beside(best)}
    for n in nodes:  # parents first: all that is inside a kept element is kept
        if n.parent is not None and id(n.parent) in keep:
            keep.add(id(n))
    return " ".join(text for node, text in blocks if id(node) in keep)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars`` (code points)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
