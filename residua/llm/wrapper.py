"""Main text of web pages by wrapper induction.

Pages of one host share a template.  A host's pages are told apart by their kind, the set of sectioning elements they use
(at most 2 ** 7 kinds a host); in each kind one page is the reference, and every page of the kind is aligned with it by
simple tree matching (``tree_match``).  A block of the reference whose text is the same on at least ``CONSTANT`` of all
different pages of the kind (and on 3 or more) is part of the template.  On each page what matches a template block
by place and text is template, the rest are slots, and the node in the place of the template's content is the
content.  A kind of fewer than 3 pages takes the reference and template of the host's largest kind.  A page is parsed and aligned
once; its blocks are written out with the numbers of the reference's blocks.

A template says where the content is, not what the slots mean, so blocks that HTML itself marks as no content
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments, by element or by
class, id or role: a whole name, all of whose words say so or name a plain container) go first; an article's own
``header`` goes, too.  A ``form`` around an ``article`` or ``main`` is a plain container.  Of what is left the ``article``
elements are the content, all of them; else ``main``; else the smallest container that holds nine tenths of the slots' text,
where no paragraph, heading or bare text stands beside it.  Mostly linked text counts as content in paragraphs and
headings alone.  Inside an ``article`` or ``main`` a block is template if it is the same on enough pages with other
articles: equal articles count once, and those of which more than half equals the reference's are its near copies and do not count.

Text: character references decoded, white space in a block one space, blocks joined by an empty line.

Null or empty html gives an empty text; html without any mark-up is one block.  A url without a host counts as host ''.
Repeated rows give repeated results; pages that are copies of one another count once.  Other columns do not matter.
What is counted are numbers of reference blocks, summed before they are shuffled; no page of a host moves for it, so a host
with most pages is no larger group than any other.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.llm.tree_match import matched
from residua.session import stored

CONSTANT = 0.8
LEAST_PAGES = 3
#: Elements that tell the kinds of pages of a host apart.
SECTIONING = "article|main|section|aside|nav|header|footer"
#: Fixed values of the HTML standard: elements without an end tag, with raw text, and inside a line.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "xmp", "noembed"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
}
#: Elements that never hold content, and words of a class, id or role that say so.
NOT_CONTENT = {
    "nav", "header", "footer", "aside", "form", "button", "select", "input", "label", "menu", "dialog", "head", "script",
    "style", "textarea", "title", "noscript", "template", "svg", "iframe", "xmp", "noembed", "object", "canvas", "option",
}
MARKED = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "complementary", "header",
    "masthead", "footer", "contentinfo", "comment", "comments", "respond", "reply", "replies", "disqus", "notice", "notices",
    "cookie", "cookies", "consent", "gdpr", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
    "signup", "login", "search", "share", "sharing", "social", "related", "recommended", "widget", "pagination", "pager",
    "copyright", "legal", "disclaimer", "skip", "toolbar", "dialog",
}
#: Words that say nothing by themselves: "site-footer" and "ad-box" are marked, "legal-text" and "social-enabled" are not.
PLAIN = {
    "area", "articles", "bar", "block", "bottom", "box", "buttons", "container", "inner", "item", "items", "left", "links",
    "list", "outer", "panel", "posts", "right", "section", "site", "slot", "top", "unit", "wrap", "wrapper",
}
#: Their ids are places to link to inside an ``article`` or ``main``.
ANCHORS = INLINE | {"h1", "h2", "h3", "h4", "h5", "h6", "p"}
#: Their text counts for content even if most of it is a link.
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dd", "figcaption", "caption"}
CLOSES = {  # an element that begins one of these ends an open one of those
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
HOLDS = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select", "div", "article", "section", "main", "body"}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s>/]*)[^>]*(?:>|\Z)"
    r"""|<([a-zA-Z][^\s>/]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)|<([a-zA-Z][^\s>/]*)([^>]*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A block element, or (tag '') a run of text inside one."""

    tag: str
    text: str = ""
    linked: int = 0
    dropped: bool = False
    constant: bool = False
    slot: bool = False
    children: list[Block] = field(default_factory=list)

    def leaves(self) -> Iterator[Block]:
        pending = [self]
        while pending:
            node = pending.pop()
            if not node.dropped:
                if not node.tag:
                    yield node
                pending += reversed(node.children)


def marks(name: str) -> bool:
    """Whether a class name, id or role is made of words for no content."""
    words = WORD.findall(name)
    return not MARKED.isdisjoint(words) and MARKED.union(PLAIN).issuperset(words)


def names(attributes: str, tag: str, inside: bool) -> bool:
    """Whether the attributes say that the element is no content; inside: of an ``article`` or ``main``."""
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id") and tag in ("article", "main") or name == "id" and inside and tag in ANCHORS:
            continue
        if name in ("class", "id", "role") and any(map(marks, value.split())):
            return True
    return False


def parse(html: str) -> Block:
    """The tree of block elements; text runs are leaves, inline elements are part of their run."""
    root = Block("#")
    stack: list[tuple[str, Block | None]] = [("#", root)]  # None: an inline element
    opened: Counter[str] = Counter()  # elements of the stack, so that it is not walked for what it does not hold
    run: list[str] = []
    linked = 0
    dropped_inline = 0

    def off(attributes: str, tag: str) -> bool:
        return bool(attributes) and names(attributes, tag, opened["article"] + opened["main"] > 0)

    def here() -> Block:
        return next(b for _, b in reversed(stack) if b is not None)

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(run)).split())
        if text:
            block = here()
            block.children.append(Block("", text, 0 if block.tag in PROSE else linked))
        run.clear()
        linked = 0

    def close(k: int) -> None:
        """Close the stack from place k on."""
        nonlocal dropped_inline
        opened.subtract(tag for tag, _ in stack[k:])
        for tag, block in reversed(stack[k:]):
            if block is None and tag.startswith("!"):
                dropped_inline -= 1
        if any(block is not None for _, block in stack[k:]):
            flush()
        del stack[k:]

    at = 0
    while True:
        match = TOKEN.search(html, at)
        end = match.start() if match else len(html)
        if end > at and not dropped_inline:
            piece = html[at:end]
            run.append(piece)
            if opened["a"]:
                linked += len(piece)
        if not match:
            break
        at = match.end()
        if tag := match[1]:
            tag = tag.lower()
            if tag == "br":
                run.append(" ")
                continue
            if tag == "p" and not opened["p"]:
                flush()
                continue
            inline = tag in INLINE
            for k in range(len(stack) - 1, 0, -1) if opened[tag] + opened[f"!{tag}"] else ():
                open_tag, block = stack[k]
                if open_tag.lstrip("!") == tag:
                    close(k)
                    break
                if inline and block is not None:  # an inline end tag does not end a block
                    break
            continue
        tag, attributes = (match[2], match[3]) if match[2] else (match[4], match[5])
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW:
            finish = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = finish.end() if finish else len(html)
            continue
        if tag in INLINE:
            if tag in VOID:
                if tag == "br":
                    run.append(" ")
            elif not attributes.rstrip().endswith("/"):
                gone = off(attributes, tag)
                stack.append((f"!{tag}" if gone else tag, None))
                opened[stack[-1][0]] += 1
                dropped_inline += gone
            continue
        # a block begins: it ends an open paragraph, and open items of its kind
        ends = CLOSES.get(tag, set())
        for k in range(len(stack) - 1, 0, -1) if any(opened[t] for t in ("p", *ends)) else ():
            open_tag, block = stack[k]
            if block is None:
                continue
            if open_tag == "p" or open_tag in ends:
                close(k)
            elif open_tag in HOLDS:
                break
        while stack[-1][1] is None:
            close(len(stack) - 1)
        flush()
        if tag in VOID:
            continue
        block = Block(tag, dropped=tag in NOT_CONTENT or tag not in ("body", "html") and off(attributes, tag))
        here().children.append(block)
        stack.append((tag, block))
        opened[tag] += 1
    close(1)
    flush()
    return root


def below_first(tree: Block) -> list[Block]:
    """The nodes, each after all that are below it."""
    order, pending = [], [tree]
    while pending:
        order.append(pending.pop())
        pending += order[-1].children
    return order[::-1]


def pruned(tree: Block) -> Block:
    """Without what is no content, and without empty blocks."""
    holders: set[int] = set()  # nodes with an article or main below
    for block in below_first(tree):
        if any(id(c) in holders or c.tag in ("article", "main") and not c.dropped for c in block.children):
            holders.add(id(block))
            block.dropped = block.dropped and block.tag != "form"
        if block.dropped:
            holders.discard(id(block))
        block.children = [c for c in block.children if not c.dropped and (c.text or c.children)]
    return tree


def parts(tree: Block) -> Iterator[tuple[Block, bool]]:
    """The nodes, each with whether it is inside an ``article`` or ``main``."""
    pending = [(tree, False)]
    while pending:
        node, inside = pending.pop()
        yield node, inside
        inside = inside or node.tag in ("article", "main")
        pending += [(child, inside) for child in reversed(node.children)]


def story(tree: Block) -> tuple[str, ...]:
    """The text runs inside ``article`` and ``main``."""
    return tuple(node.text for node, inside in parts(tree) if inside and not node.tag)


def own_text(leaf: Block) -> int:
    """Characters that count for content: those of a run that is no template and not mostly links."""
    return 0 if leaf.constant or 2 * leaf.linked > len(leaf.text) else len(leaf.text)


def weight(block: Block) -> int:
    return sum(map(own_text, block.leaves()))


def every(tree: Block, tag: str) -> Iterator[Block]:
    """The elements below the tree that are not inside one of their kind."""
    pending = tree.children[::-1]
    while pending:
        node = pending.pop()
        if node.tag == tag:
            yield node
        else:
            pending += reversed(node.children)


def chosen(tree: Block) -> list[Block]:
    """The elements that hold the content: articles, main, or the smallest container with most of the slots' text."""
    for tag in ("article", "main"):
        if found := list(every(tree, tag)):
            return found
    weights: dict[int, int] = {}
    for node in below_first(tree):
        own = 0 if node.tag else own_text(node)
        weights[id(node)] = own + sum(weights[id(c)] for c in node.children)
    at = tree
    while whole := weights[id(at)]:
        heavy = max(at.children, key=lambda x: weights[id(x)], default=at)
        beside = any(weights[id(c)] and (not c.tag or c.tag in PROSE) for c in at.children if c is not heavy)
        if not heavy.children or beside or 10 * weights[id(heavy)] < 9 * whole:
            break
        at = heavy
    return [at]


@lru_cache(maxsize=64)
def reference(html: str) -> tuple[Block, dict[int, tuple[int, bool]]]:
    """A page's tree, and for each node its number in page order and whether it is inside an ``article`` or ``main``."""
    tree = pruned(parse(html))
    return tree, {id(node): (k, inside) for k, (node, inside) in enumerate(parts(tree))}


def agreement(first: str, html: str) -> tuple[int, list[int], list[int], str]:
    """What a page has in common with the reference.

    (article, outside, inside, blocks): a hash of the page's article; the numbers of the reference's text runs that the
    page has in the same places, outside and inside of its article; the page's nodes as JSON.  Article 0 is none, or
    one of which more than half equals the reference's; it has no runs inside.
    """
    tree, numbers = reference(first)
    other = pruned(parse(html))
    outside, inside, equal = [], [], 0
    place: dict[int, int] = {}
    for a, b in matched(tree, other):
        number, within = numbers[id(a)]
        same = not a.tag and a.text == b.text
        place[id(b)] = 2 * number + same
        if same:
            (inside if within else outside).append(number)
            equal += within * len(a.text)
    texts = story(other)
    # in page order, each with the number of its children, and twice the reference's number, plus 1 if the texts are equal
    blocks = json.dumps([[n.tag, n.text, n.linked, len(n.children), place.get(id(n), -1)] for n, _ in parts(other)])
    if 2 * equal >= sum(map(len, texts)):
        return 0, sorted(outside), [], blocks
    article = xxhash.xxh64_intdigest("\n".join(texts).encode("utf-8", "surrogatepass")) >> 1 | 1
    return article, sorted(outside), sorted(inside), blocks


def slots_of(first: str, constant: set[int]) -> list[int]:
    """The numbers of the nodes that hold the reference's content, given its constant text runs."""
    nodes = [n for n, _ in parts(pruned(parse(first)))]
    for k in constant:
        nodes[k].constant = True
    slots = {id(n) for n in chosen(nodes[0])}
    return [k for k, n in enumerate(nodes) if id(n) in slots]


def rebuilt(blocks: str, constant: set[int], slots: set[int]) -> Block:
    """The tree of a page's nodes, with constant text runs and slots marked."""
    holder = Block("#")
    pending = [[holder, 1]]  # nodes that lack children, and how many
    for tag, text, linked, n, place in json.loads(blocks):
        number = place >> 1
        block = Block(tag, text, linked, constant=place & 1 == 1 and number in constant, slot=number in slots)
        if place < 0:
            block.constant = block.slot = False
        last = pending[-1]
        last[0].children.append(block)
        last[1] -= 1
        if not last[1]:
            pending.pop()
        if n:
            pending.append([block, n])
    return holder.children[0]


def induce(pages: list[str]) -> str:
    """The template of a few pages, the first of which is the reference; ``page_texts`` makes those of whole tables."""
    found = [agreement(pages[0], page) for page in dict.fromkeys(pages)]
    outside = Counter(k for _, runs, _, _ in found for k in runs)
    articles = {article: runs for article, _, runs, _ in found if article}
    inside = Counter(k for runs in articles.values() for k in runs)
    constant = {k for k, n in outside.items() if n >= max(LEAST_PAGES, CONSTANT * len(found))}
    constant |= {k for k, n in inside.items() if n + 1 >= max(LEAST_PAGES, CONSTANT * (len(articles) + 1))}
    return json.dumps([pages[0], sorted(constant), slots_of(pages[0], constant)])


def content(tree: Block) -> list[str]:
    """Texts of the content's blocks in page order.

    The content is the page's articles or main; without any, the node that stands in the template's slot, with the
    page's own container of most text if the slot holds less than half as much (a page of another make).
    """
    best = chosen(tree)
    if best[0].tag in ("article", "main"):
        return [leaf.text for node in best for leaf in node.leaves() if not leaf.constant]
    slots = [n for n, _ in parts(tree) if n.slot and n.tag not in ("article", "main")]
    slot = slots[-1] if slots else best[0]
    wanted = {id(slot)} if 2 * weight(slot) >= weight(best[0]) else {id(slot), id(best[0])}
    texts, pending = [], [(tree, False)]
    while pending:
        node, within = pending.pop()
        within = within or id(node) in wanted
        if within and not node.tag and own_text(node):
            texts.append(node.text)
        pending += [(child, within) for child in reversed(node.children)]
    return texts


def main_text(html: str | None, saved: str | None = None) -> str:
    if not html:
        return ""
    if not saved:
        return "\n\n".join(content(pruned(parse(html))))
    first, constant, slots = json.loads(saved)
    return "\n\n".join(content(rebuilt(agreement(first, html)[3], set(constant), set(slots))))


def references(pages: DataFrame) -> DataFrame:
    """(host, kind, use, first): for each kind of a host the kind whose template it takes, and that one's reference."""
    key = ["host", "kind"]
    # the least hash first, so that no aggregate sorts whole pages; written out, so that its size is known
    sizes = pages.groupBy(*key).agg(F.min("h").alias("h"), F.count_distinct("h").alias("pages"))
    sizes = stored(sizes, "wrapper-kinds")
    first = pages.join(sizes.drop("pages"), [*key, "h"]).groupBy(*key).agg(F.min("html").alias("first"))
    largest = sizes.groupBy("host").agg(F.max(F.struct("pages", (-F.col("kind")).alias("kind"))).alias("top"))
    use = F.when(F.col("pages") < LEAST_PAGES, -F.col("top.kind")).otherwise(F.col("kind"))
    use = sizes.join(largest, "host").select(*key, use.alias("use"))
    return stored(use.join(first.withColumnRenamed("kind", "use"), ["host", "use"]), "wrapper-references")


def wrappers(seen: DataFrame, first: DataFrame) -> DataFrame:
    """(host, kind, constant, slots) from all pages' agreements with their references: the template of each kind."""
    key = ["host", "kind"]
    own = seen.where("kind = use")
    each = own.groupBy(*key, "h").agg(F.min(F.struct("article", "outside", "inside")).alias("s")).select(*key, "s.*")
    articles = each.where("article <> 0").groupBy(*key, "article").agg(F.min("inside").alias("inside"))
    # -1 and -2 stand on each page and each other article, and so count them; the reference is one more article
    outside = each.select(*key, F.explode(F.concat("outside", F.array(F.lit(-1)))).alias("node"), F.lit(0).alias("more"))
    inside = articles.select(*key, F.explode(F.concat("inside", F.array(F.lit(-2)))).alias("node"), F.lit(1).alias("more"))
    counts = outside.union(inside).groupBy(*key, "node", "more").agg(F.count("*").alias("n"))
    counts = stored(counts.withColumn("n", F.col("n") + F.col("more")), "wrapper-counts")
    totals = counts.where("node < 0").select(*key, "more", F.col("n").alias("all"))
    least = F.greatest(F.lit(float(LEAST_PAGES)), CONSTANT * F.col("all"))
    constant = counts.where("node >= 0").join(totals, [*key, "more"]).where(F.col("n") >= least)
    constant = constant.groupBy(*key).agg(F.collect_list("node").alias("constant"))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[] if c is None else list(c) for c in batch["constant"]]
            slots = [slots_of(f, set(c)) for f, c in zip(batch["first"], found)]
            yield batch[key].assign(constant=found, slots=slots)

    both = first.where("kind = use").join(constant, key, "left").select(*key, "first", "constant")
    made = both.mapInPandas(of, "host string, kind long, constant array<int>, slots array<int>")
    return stored(made, "wrappers")


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, host) of every page."""
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))
    elements = F.regexp_extract_all("html", F.lit(rf"(?i)<({SECTIONING})\b"), 1)
    kind = F.xxhash64(F.array_sort(F.array_distinct(F.transform(elements, F.lower)))).bitwiseAND(F.lit((1 << 62) - 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"), kind.alias("kind"), F.xxhash64("html").alias("h"))
    page_type = rows.schema["page_id"].dataType.simpleString()
    first = references(rows.where("html IS NOT NULL"))

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [agreement(a, b) if b else (0, [], [], None) for a, b in zip(batch["first"], batch["html"])]
            columns = dict(zip(("article", "outside", "inside", "blocks"), map(list, zip(*found))))
            if columns:
                yield batch[["page_id", "url", "host", "kind", "use", "h"]].assign(**columns)

    schema = f"page_id {page_type}, url string, host string, kind long, use long, h long, article long"
    schema += ", outside array<int>, inside array<int>, blocks string"
    # kind and use are numbers that pandas must not turn to floats
    both = rows.join(first, ["host", "kind"], "left").withColumn("use", F.coalesce("use", "kind"))
    seen = stored(both.mapInPandas(aligned, schema), "wrapper-blocks")
    templates = wrappers(seen, first).withColumnRenamed("kind", "use")

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                "\n\n".join(content(rebuilt(b, *[set() if x is None else set(x) for x in (c, s)]))) if b else ""
                for b, c, s in zip(batch["blocks"], batch["constant"], batch["slots"])
            ]
            yield batch[["page_id", "url", "host"]].assign(text=texts, n_chars=[len(t) for t in texts])

    columns = seen.select("page_id", "url", "host", "use", "blocks").join(templates, ["host", "use"], "left")
    found = columns.mapInPandas(told, f"page_id {page_type}, url string, host string, text string, n_chars long")
    return found.select("page_id", "url", "text", "n_chars", "host")
