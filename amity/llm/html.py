"""Main text of web pages with a site style tree.

Pages of one host are merged into one tree: a node is the path of containers
(tag, class and id) from the root. For each node and host two entropies are
taken over the different pages: of its presentation, the order of its children's
tags, and of its contents, the texts directly in it. With ``m`` pages, a
presentation shared by ``n`` of them counts ``n/m``; a text on ``n`` pages has
the entropy ``log(n) / log(m)`` and the importance 1 less that. A node's importance is

    (1 - GAMMA**l) * presentation + GAMMA**l * contents

for ``l`` children. A prior of ``PRIOR`` pages of importance 1 stands beside the host's own, so that
few pages move it little; hosts of any size are treated alike. Texts of nodes below ``LOW`` are
dropped from every page, but the article itself never is.

What every page says about itself goes first: menus, headers, footers, asides,
scripts and the like by tag or role, and hidden elements, with all they hold; forms and
elements named as noise by class or id, unless the page has its article in one of them
only. A name that says what an element has or lacks (``has-sidebar``) is none of the element.
The text is that of the article elements, or of the main element where that has more text
outside of articles than all articles together; without either, of an element named as content;
without one, of the whole body, where lists and containers of mostly links go as well.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.llm.tables import shared_table

GAMMA = 0.9
LOW = 0.2
PRIOR = 0.5
LINKED = 0.6  # share of a container's characters in links that makes it a menu

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
RAW = {tag: re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I) for tag in (
    "script", "style", "title", "textarea", "template", "noscript", "iframe", "xmp", "noembed", "noframes"
)}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section"
    " summary table caption tbody td tfoot th thead tr ul head".split()
)
CONTAINERS = frozenset(
    "article aside blockquote body center details div dl fieldset figure footer form header main menu nav ol section"
    " table ul".split()
)
NOISE_TAGS = frozenset(
    "nav footer aside menu button select dialog head svg canvas audio video object map search datalist label".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation"
    " menu sidebar sidenav widget widgets footer masthead breadcrumb breadcrumbs comment comments disqus reply replies"
    " share sharing social related recommended recommendations newsletter subscribe subscription signup cookie cookies"
    " consent notice notices gdpr popup modal overlay login search pagination pager copyright disclaimer skip toolbar"
    " topbar".split()
)
# Words before a name that make it a property: "has-sidebar", "no-comments".
PROPERTY_WORDS = frozenset("has have no not with without hide hidden show enable disable".split())
CONTENT_NAMES = frozenset("content article post entry story maincontent articlebody main".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
# An opening tag that ends an open one of these, up to the nearest of the stops.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
}


@dataclass
class Node:
    """A container of one page."""

    key: int  # a hash of the path from the root, by the parent's
    tag: str
    children: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    chars: int = 0
    linked: int = 0

    def child(self, name: str) -> int:
        return xxhash.xxh64_intdigest(name, self.key + (1 << 63)) - (1 << 63)


@dataclass
class Open:
    tag: str
    noise: int  # 0: none, 1: by name or form, 2: by tag or role, or hidden
    regions: int  # bits: 1 in an article, 2 in main, 4 in an element named as content
    node: Node


@dataclass
class Block:
    text: str
    noise: int
    regions: int
    node: Node


def _names(value: str) -> set[str]:
    """The words of class names and ids, without those of properties."""
    split = ([w.lower() for w in WORDS.findall(name)] for name in value.split())
    return {w for words in split if words and not (words[0] in PROPERTY_WORDS and len(words) > 1) for w in words}


def parse(page: str) -> tuple[list[Block], dict[int, Node]]:
    """The blocks of text that a page does not itself mark as noise for certain, and all its containers."""
    root = Node(0, "")
    nodes: dict[int, Node] = {0: root}
    stack = [Open("", 0, 0, root)]
    blocks: list[Block] = []
    buffer: list[str] = []
    link = linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                top = stack[-1]
                top.node.texts.append(text)
                top.node.chars += len(text)
                top.node.linked += min(linked, len(text))
                if top.noise < 2:
                    blocks.append(Block(text, top.noise, top.regions, top.node))
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = entities.unescape(raw) if "&" in raw else raw
            buffer.append(text)
            if link:
                linked += len(text)

    def end(tags: tuple[str, ...], stops: tuple[str, ...]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                flush()
                del stack[i:]
                return
            if stack[i].tag in stops:
                return

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        m = MARKUP.match(page, lt)
        if m is None:  # a sign, not markup
            add(page[at : lt + 1])
            at = lt + 1
            continue
        add(page[at:lt])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end tag
            if tag == "a":
                link = max(0, link - 1)
            if any(x.tag == tag for x in stack):
                end((tag,), ("article",) if tag == "p" else ())
            continue
        rest = m[3] or m[6] or ""
        if tag in RAW:
            close = RAW[tag].search(page, at)
            at = close.end() if close else n
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                buffer.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if stack[-1].tag == "p":
                stack.pop()
            if tag in ENDS:
                end(*ENDS[tag])
        top = stack[-1]
        attributes = {a.lower(): v.strip("\"'") for a, v in ATTRIBUTE.findall(rest)} if rest.strip(" /") else {}
        if tag == "a":
            link += 1
        names = _names(attributes.get("class", "") + " " + attributes.get("id", "")) if attributes else set()
        noise = 0
        if tag not in ("body", "html"):
            if (
                tag in NOISE_TAGS
                or (tag == "header" and not top.regions & 3)
                or attributes.get("role", "").lower() in NOISE_ROLES
                or "hidden" in attributes
                or attributes.get("aria-hidden", "").lower() == "true"
                or "display:none" in attributes.get("style", "").replace(" ", "").lower()
            ):
                noise = 2
            elif tag == "form" or names & NOISE_NAMES or names == {"header"}:
                noise = 2 if top.regions & 3 else 1  # inside an article it can hold none
        if tag not in BLOCKS and not noise:
            continue
        node = top.node
        node.children.append(tag)
        if tag in CONTAINERS:
            style = "".join(f".{v}" for k, v in sorted(attributes.items()) if k in ("class", "id"))
            key = node.child(f"{tag}{style}")
            node = nodes.setdefault(key, Node(key, tag))
        regions = top.regions
        if noise < 2:
            regions |= 1 if tag == "article" else 2 if tag == "main" or attributes.get("role") == "main" else 0
            if names & CONTENT_NAMES and tag in CONTAINERS:
                regions |= 4
        if tag not in BLOCKS:
            flush()
        stack.append(Open(tag, max(top.noise, noise), regions, node))
    flush()
    return blocks, nodes


def main_blocks(blocks: list[Block], low: frozenset[int] = frozenset()) -> list[str]:
    """The texts of the article among ``blocks``, without nodes of low importance."""
    clean = [b for b in blocks if not b.noise]
    for some in (clean, blocks):  # what stands in a doubtful element counts only where nothing else is an article
        article = [b for b in some if b.regions & 1]
        main = [b for b in some if b.regions & 2]
        beside = sum(len(b.text) for b in main if not b.regions & 1)
        if chosen := main if beside > sum(len(b.text) for b in article) else article:
            break
    else:
        chosen = [b for b in clean if b.regions & 4] or [
            b for b in clean if b.node.tag == "article" or b.node.linked < LINKED * max(1, b.node.chars)
        ]
    if low:
        chosen = [b for b in chosen if not _removable(b.node) or b.node.key not in low]
    return [b.text for b in chosen]


def _removable(node: Node) -> bool:
    return node.tag not in ("", "article", "main", "body", "html")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def style_tree(pages: DataFrame) -> DataFrame:
    """``host, node, pages, importance`` from pages (``host, html``).

    Copies of a page count once. All counts are merged before each shuffle, so a
    host with a third of all pages is spread by node and text.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = _hash(html)
                for node in parse(html)[1].values():
                    if node.texts:
                        rows.append((host, node.key, page, False, _hash(" ".join(node.children)), len(node.children)))
                        rows += [(host, node.key, page, True, h, 0) for h in {_hash(t) for t in node.texts}]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["host", "node", "page", "is_text", "feature", "children"],
            )

    features = pages.select("host", "html").mapInArrow(
        look, "host string, node long, page long, is_text boolean, feature long, children long"
    )
    shared = (
        features.distinct()
        .groupBy("host", "node", "is_text", "feature")
        .agg(F.count("*").alias("n"), F.sum("children").alias("children"))
    )
    weight = F.col("n") * F.log("n")
    nodes = shared.groupBy("host", "node").agg(
        F.sum(F.when(~F.col("is_text"), F.col("n"))).alias("pages"),
        F.sum(F.when(~F.col("is_text"), weight)).alias("shown"),
        F.sum("children").alias("children"),
        F.sum(F.when(F.col("is_text"), F.col("n"))).alias("texts"),
        F.sum(F.when(F.col("is_text"), weight)).alias("told"),
    )
    log_m = F.log("pages")
    presentation = 1 - F.col("shown") / (F.col("pages") * log_m)
    contents = 1 - F.col("told") / (F.col("texts") * log_m)
    own = F.col("pages") / (F.col("pages") + PRIOR)
    share = F.pow(F.lit(GAMMA), F.col("children") / F.col("pages"))
    return nodes.select(
        "host",
        "node",
        "pages",
        F.when(F.col("pages") > 1, ((1 - share) * presentation + share * contents) * own + 1 - own)
        .otherwise(1.0)
        .alias("importance"),
    )


def extract(pages: DataFrame, html: str = "html", url: str = "url", out: str = "main_blocks") -> DataFrame:
    """``pages`` with the main text's blocks, an array of strings in page order, in place of the html.

    Character references are decoded and white space in a block is one space.
    NULL, empty and unreadable html has no blocks; a page without host belongs to
    the host of no name; equal rows stay. Pages are parsed twice, once for the
    style trees of all hosts and once for the text. Only nodes of low importance
    go to the second pass, as one row for each host; Spark joins them by their
    size, which it knows, as they are written to the shared folder.
    """
    others = [c for c in pages.columns if c not in (html, out)]
    rows = pages.select(
        F.struct(*others).alias("row"),
        F.lower(F.coalesce(F.try_parse_url(F.col(url), F.lit("HOST")), F.lit(""))).alias("host"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )
    low = style_tree(rows).where(F.col("importance") < LOW)
    low = shared_table(low.groupBy("host").agg(F.collect_set("node").alias("low")))
    # A page can only lose nodes that it has, so its host's list is all it needs.
    joined = rows.join(low, "host", "left").select("row", "html", "low")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_blocks(parse(page)[0], frozenset(nodes or ()))
                for page, nodes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.list_(pa.string()))], ["row", out])

    schema = T.StructType([joined.schema["row"], T.StructField(out, T.ArrayType(T.StringType()))])
    return joined.mapInArrow(read, schema).select("row.*", out)
