"""Main text of web pages by site style trees (Yi, Liu and Li 2003).

The pages of a host are merged into one tree: a node is a place in the pages, given by the tags and presentation (class, id, role) from
the body down. On each page that has the node, it shows a style (the row of its children's tags) and contents (the texts under it).

- A node's presentation is important if pages differ in its style: the entropy of the styles, to the base of the pages.
- A content is unimportant if it is on all pages of the node: its entropy over them is ln(pages with it) / ln(pages). A node's content
  is as important as one less the mean of that over its contents.
- The importance of a node is (1 - g^l) * presentation + g^l * content, g = 0.9 and l its styles.
- A paragraph, heading or other block of text is judged by its own content, if that is on most pages of its place.
- All importance is smoothed by a page of full importance: few pages must agree more than many.

Branches of low importance are removed from each page, and so are paragraphs and headings outside an article; inside it a line that pages
share is the article's. So are branches whose tag, class, id or role says what they are: a name counts if its first or last word says so
("cookie-bar", "user-comments") and none of its words makes it a state ("has-sidebar", "comments-open"). A branch with half of a page's text or more stays, whatever it is called, as
does one around a page's only article; of the tree's branches one with half of the remaining text: hosts may hold little but copies.

Counts are made per task and added up in Spark; a page meets its host's list of unimportant nodes in a join.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clicklake.llm.common import written

DAMPING = 0.9
LEAST_IMPORTANCE = 0.3
DEEPEST = 256  # branches around a place that the tree judges; what is deeper goes or stays with the last of them

# HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object select".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
# Elements and names of parts that are not the article.
ASIDE_TAGS = frozenset("nav footer aside form header menu dialog button head".split())
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies dialog "
    "disqus footer form header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promotion "
    "recommended related replies reply search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# Words that make a name a state of what bears it, and words that make a header the site's.
STATES = frozenset("has no not with without is open opened closed enabled disabled".split())
SITE = frozenset("site global masthead top".split())
MAIN = frozenset(("article", "main"))
# Branches that a style tree may remove; of the flow of paragraphs and headings it judges each text.
CONTAINERS = frozenset("center dl div fieldset figure ol section span table ul".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>", re.S
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    place: int
    parent: Node | None
    named: bool  # its tag or a name says that it is no part of the article
    header: bool  # likewise, unless it stands in an article
    children: list[str]
    above: tuple[int, ...]
    aside: bool = False
    main: bool = False


@dataclass
class Block:
    """A run of text between block boundaries, where it stands, and the removable branches around it."""

    text: str
    node: Node


def _names(attributes: str) -> list[list[str]]:
    """The words of each name."""
    found = [name for _, *values in _NAMES.findall(attributes) for name in next((v for v in values if v), "").lower().split()]
    return [words for words in map(_TOKEN.findall, found) if words]


def _hint(words: list[str]) -> str | None:
    """What a name says: "aside", "header" (one that an article may have) or nothing."""
    said = {words[0], words[-1]} & ASIDE_NAMES
    if not said or STATES.intersection(words):
        return None
    return "header" if said == {"header"} and not SITE.intersection(words) else "aside"


def _judge(blocks: list[Block], nodes: list[Node]) -> None:
    """Set what is aside and what is in an article. A name is a hint: it does not remove half of the text or the only article."""
    sizes, articles = Counter(), set()
    for b in blocks:
        sizes[id(b.node)] += len(b.text)
    total = sum(sizes.values())
    for n in reversed(nodes[1:]):  # parents come before their children
        sizes[id(n.parent)] += sizes[id(n)]
        if n.tag in MAIN and sizes[id(n)] or id(n) in articles:
            articles.update((id(n), id(n.parent)))
    for spared in (set(), articles):
        for n in nodes[1:]:
            hinted = n.named or n.header and not n.parent.main
            n.aside = n.parent.aside or hinted and id(n) not in spared and 2 * sizes[id(n)] < total
            n.main = n.parent.main or n.tag in MAIN and not n.aside
        if any(b.node.main for b in blocks if not b.node.aside):
            break


def parse(html: str | None) -> tuple[list[Block], list[Node]]:
    """The blocks of a page in page order, and its elements. Unclosed and stray tags are taken as browsers take them, roughly."""
    html = html or ""
    root = Node("", 0, None, False, False, [], ())
    stack, nodes, blocks, text = [root], [root], [], []
    at, size, opened = 0, len(html), Counter()

    def flush() -> None:
        if text:
            words = "".join(text).split()
            text.clear()
            if words:
                blocks.append(Block(" ".join(words), stack[-1]))

    def pop(depth: int) -> None:
        if any(n.tag in BLOCK for n in stack[depth:]):
            flush()
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    while at < size:
        found = _MARKUP.search(html, at)
        if not found:
            text.append(unescape(html[at:]))
            break
        if found.start() > at:
            text.append(unescape(html[at : found.start()]))
        at = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        tag, closes, attributes = name.lower(), found[1] or found[4], found[3] or found[6] or ""
        if closes:
            depth = 0
            if opened[tag] > 0:  # other than a block's, a tag closes nothing outside the block that it stands in
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag or tag not in BLOCK and stack[i].tag in BLOCK), 0)
            if depth and stack[depth].tag == tag:
                pop(depth)
            elif tag in BLOCK:
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop(i)
                    break
                if stack[i].tag in BLOCK:
                    break
            if tag in CLOSED_BY_SAME and any(opened[t] > 0 for t in ("dt", "dd", "td", "th", tag)):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag or {stack[i].tag, tag} in ({"dt", "dd"}, {"td", "th"}):
                        pop(i)
                        break
                    if stack[i].tag in CLOSED_BY_SAME[tag]:
                        break
        parent = stack[-1]
        parent.children.append(tag)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        names = [] if tag in ("html", "body", "main") else _names(attributes)
        hints = [_hint(words) for words in names]
        header = tag == "header" or "header" in hints
        named = tag in ASIDE_TAGS and tag != "header" or "aside" in hints
        names = [word for words in names for word in words]
        place = parent.place
        if tag in BLOCK or names:
            place = xxhash.xxh64_intdigest(f"{parent.place}>{tag}" + "".join(f".{n}" for n in sorted(set(names))))
        judged = tag in CONTAINERS and place != parent.place and len(parent.above) < DEEPEST
        above = (*parent.above, place) if judged else parent.above
        node = Node(tag, place, parent, named, header, [], above)
        nodes.append(node)
        stack.append(node)
        opened[tag] += 1
    flush()
    _judge(blocks, nodes)
    return blocks, nodes


def main_text(html: str | None, unimportant: frozenset[int] = frozenset(), host: str = "") -> str:
    """The page's article: the blocks left of it, joined by blank lines."""
    blocks, _ = parse(html)
    kept = [b for b in blocks if not b.node.aside]
    if any(b.node.main for b in kept):
        kept = [b for b in kept if b.node.main]
    if unimportant:
        low = Counter()
        for b in kept:
            for place in b.node.above:
                if node_key(host, place) in unimportant:
                    low[place] += len(b.text)
        total = sum(len(b.text) for b in kept)
        removed = {place for place, size in low.items() if 2 * size < total}
        kept = [b for b in kept if not removed.intersection(b.node.above)]
        own = [b for b in kept if b.node.main or node_key(host, b.node.place) ^ _content(b) not in unimportant]
        if 2 * sum(len(b.text) for b in own) > sum(len(b.text) for b in kept):
            kept = own
    return "\n\n".join(b.text for b in kept)


def node_key(host: str, place: int) -> int:
    return xxhash.xxh64_intdigest(f"{host}\0{place}") >> 1


def _content(block: Block) -> int:
    return xxhash.xxh64_intdigest(block.text.encode("utf-8", "replace")) >> 1


def shown(html: str | None, host: str) -> set[tuple[int, int, int]]:
    """What a page shows of its host's tree: (node, kind, what); kind 0: the page has the node, 1: a style of it, 2: a content under it."""
    blocks, nodes = parse(html)
    wanted = {place: node_key(host, place) for n in nodes if n.above for place in n.above}
    wanted.update((b.node.place, node_key(host, b.node.place)) for b in blocks)
    out = {(key, 0, 0) for key in wanted.values()}
    for n in nodes:
        if n.place in wanted:
            out.add((wanted[n.place], 1, xxhash.xxh64_intdigest(">".join(n.children)) >> 1))
    for b in blocks:
        what = _content(b)
        out.update((wanted[place], 2, what) for place in (*b.node.above, b.node.place))
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _smoothed(importance: Column) -> Column:
    return (F.col("pages") * importance + 1) / (F.col("pages") + 1)


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, pages, importance) of every node of the hosts' trees, and of the contents that are on most pages of their place."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = Counter()
            for host, html in zip(batch["host"], batch["html"], strict=True):
                seen.update((host, *s) for s in shown(html, host))
            rows = [(*key, n) for key, n in seen.items()]
            yield pd.DataFrame(rows, columns=["host", "node", "kind", "what", "n"])

    schema = "host string, node long, kind int, what long, n long"
    counted = pages.select(host_of(F.col("url")).alias("host"), "html").mapInPandas(count, schema)
    counted = written(counted.groupBy("host", "node", "kind", "what").agg(F.sum("n").alias("n")), "style-counts")
    of = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value))
    n = F.col("n").cast("double")
    sums = counted.groupBy("host", "node").agg(
        of(0, F.col("n")).alias("pages"),
        of(1, n).alias("style_pages"),
        of(1, n * F.log(n)).alias("style_logs"),
        of(1, F.lit(1)).alias("styles"),
        of(2, F.log(n)).alias("content_logs"),
        of(2, F.lit(1)).alias("contents"),
    )
    base = F.log(F.greatest("pages", F.lit(2)).cast("double"))
    presentation = F.coalesce((F.log("style_pages") - F.col("style_logs") / F.col("style_pages")) / base, F.lit(0.0))
    content = F.coalesce(1 - F.col("content_logs") / F.col("contents") / base, F.lit(0.0))
    damped = F.pow(F.lit(DAMPING), F.coalesce("styles", F.lit(0)).cast("double"))
    branches = sums.select("host", "node", "pages", _smoothed((1 - damped) * presentation + damped * content).alias("importance"))
    places = counted.where("kind = 0").select("host", "node", F.col("n").alias("pages"))
    common = counted.where("kind = 2 and n > 1").join(places, ["host", "node"]).where("2 * n > pages")
    alone = 1 - F.log(n) / base
    contents = common.select("host", F.col("node").bitwiseXOR(F.col("what")).alias("node"), "pages", _smoothed(alone).alias("importance"))
    return branches.unionByName(contents)


def extract(pages: DataFrame, least_importance: float = LEAST_IMPORTANCE) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html; other columns are not used).

    Null and empty html has an empty text; a null url or one without a host belongs to the host of no name; repeated rows
    are rows (and pages of the tree); a host of one or two pages loses only what its tags and names say, as two that agree are not
    enough against the page of full importance; an empty table gives no rows.
    """
    low = style_tree(pages).where((F.col("pages") >= 2) & (F.col("importance") < least_importance))
    low = written(low.groupBy(F.col("host").alias("low_host")).agg(F.collect_set("node").alias("nodes")), "unimportant")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    rows = rows.join(low, F.col("host") == F.col("low_host"), "left")

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        sets: dict[str, frozenset[int]] = {}
        for html, host, nodes in batches:
            out = []
            for page, name, listed in zip(html, host, nodes, strict=True):
                if name not in sets:
                    sets[name] = frozenset() if listed is None else frozenset(int(x) for x in listed)
                out.append(main_text(page, sets[name], name))
            yield pd.Series(out, dtype=object)

    return rows.select("page_id", "url", text("html", "host", "nodes").alias("text"))
