"""Main text of web pages by a site style tree.

All pages of a host, whole, are merged into one style tree: a node is a path
of elements with their presentation (tag, class, role), and every text block
is content under a node. Over the ``m`` pages of the host that have a node,

* the *content importance* of a block found there on ``n`` pages is
  ``1 - log n / log m``: the entropy of its spread over the pages, as a share
  of the greatest (0: it stands on all of them, 1: on one),
* the *presentation importance* of the node is the entropy of its child
  elements' sequences (runs of equal ones count once), scaled in the same way, and
* the importance of the node's branch is nine tenths the mean content
  importance of its blocks, weighted by their characters, and one tenth its
  presentation importance.

A branch of low importance goes from each page with all its blocks, those
that vary too (a page number, the day's links); in a branch that stays, a
block goes if most of the node's pages repeat it. A branch is noise only when
all content below it is, so judging the nodes that hold text judges every
branch. Pages with equal blocks count once, so copies of one page do not make
its article look like furniture, and a node needs ``MIN_PAGES`` pages before
it is judged. The tree is built before any list is asked and sees menus and
adverts as it sees the article.

What repetition cannot tell (an advert or a reader's comment found once) is
left to a prior: branches that HTML itself names as furniture (navigation,
headers and footers of the page, asides, forms, adverts, comment sections),
and blocks outside the article where there is one. Scripts, styles and hidden
elements are no text at all. The statistics are gathered by Spark per host,
node and block; no host is collected anywhere.
"""

from __future__ import annotations

import html as htmllib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import Stages, ready
from ledgerlens.operators.joins import join_per_key

#: distinct pages of a host that must have a node before it is judged
MIN_PAGES = 4
#: share of a node's pages on which one block must stand to be furniture
MAX_SHARE = 0.5
#: the same for a block inside an article
MIN_ARTICLE_PAGES, MAX_ARTICLE_SHARE = 10, 0.9
#: repeated blocks go only from nodes whose blocks have less entropy than this share of the greatest
MAX_SPREAD = 0.7
#: a branch of less importance goes whole
MIN_IMPORTANCE = 0.2
#: share of the content in a branch's importance
CONTENT_WEIGHT = 0.9

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "xmp", "noembed"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
          "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
          "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: elements that end an open paragraph
_ENDS_P = _BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "dd", "dt", "li", "legend"}
#: elements that end an open element of the same kind: kind -> what bounds the search
_ENDS_SELF = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
              "th": {"table", "tr"}, "option": {"select"}, "p": set()}
_FURNITURE_TAGS = {"nav", "aside", "form", "button", "select", "dialog", "head", "menu", "fieldset", "label", "input"}
_FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert",
                    "alertdialog", "menu", "menubar", "toolbar"}
#: words of a class or id that name furniture
_FURNITURE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
                    "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "menu", "modal",
                    "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "pager", "popup",
                    "promo", "related", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
                    "subscribe", "toolbar", "widget", "masthead", "topbar", "login", "search", "recommended", "replies",
                    "respond", "alert", "toc", "responses", "discussion", "adsbygoogle", "sponsors"}
_WORD = re.compile(r"[a-z]+")
#: words that make a class a statement about the layout, not the element
_ABOUT = {"with", "without", "has", "no", "is"}
_HEAD_ONLY = {"base", "link", "meta", "title", "style", "script", "noscript", "template"}
#: an article element of such a class is a card or a reader's comment
_CARD_WORDS = {"comment", "comments", "reply", "replies", "ad", "ads", "sponsored", "related", "promo", "teaser", "card"}


def _classes(attrs: dict[str, str]):
    """The words of each class and of the id: ``siteHeader-nav_2`` -> site header nav."""
    for name in (attrs.get("class", "") + " " + attrs.get("id", "")).split():
        yield set(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))


def _is_hidden(attrs: dict[str, str]) -> bool:
    return ("hidden" in attrs or attrs.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none", attrs.get("style", "")) is not None)


def _is_furniture(tag: str, attrs: dict[str, str], level: int) -> bool:
    if tag in _FURNITURE_TAGS or tag == "footer" or (tag == "header" and not level):
        return True
    if not attrs:
        return False
    if attrs.get("role", "").lower() in _FURNITURE_ROLES:
        return True
    if tag in ("body", "html", "main"):
        return False
    named = _CARD_WORDS if tag == "article" else _FURNITURE_WORDS
    return any((words & named or ("header" in words and not level and tag != "article")) and not words & _ABOUT
               for words in _classes(attrs))


class _Open:
    __slots__ = ("tag", "node", "drop", "level", "named")

    def __init__(self, tag, node, drop, level, named):
        self.tag, self.node, self.drop, self.level, self.named = tag, node, drop, level, named


def parse(page: str | None) -> tuple[list[tuple[int, int, bool, str]], dict[int, int]]:
    """Text blocks of a page in order, and the presentation of its nodes.

    A block: hash of the node (path of elements with their presentation), 2
    inside an article, 1 inside the main element, else 0, whether the markup
    names it as furniture, and the text with references decoded and white
    space runs as one blank. Hidden elements, and furniture inside a line of
    text, are no blocks. Presentation: a hash of the node's child elements in
    order. Unclosed and stray tags are tolerated."""
    if not page:
        return [], {}
    out: list[tuple[int, int, bool, str]] = []
    shown: dict[int, int] = {}
    last: dict[int, int] = {}
    stack = [_Open("", 0, False, 0, False)]
    text: list[str] = []
    at, size = 0, len(page)

    def flush(top):
        if text:
            if not top.drop:
                t = " ".join(htmllib.unescape("".join(text)).split())
                if t:
                    out.append((top.node, top.level, top.named, t))
            text.clear()

    def block_of():
        for e in reversed(stack):
            if e.tag in _BLOCK or not e.tag:
                return e
        return stack[0]

    def close_to(depth):
        flush(block_of())
        del stack[depth:]

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            if not stack[-1].drop:
                text.append(page[at:])
            break
        if m.start() > at and not stack[-1].drop:
            text.append(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:  # an end tag
            if tag == "br":
                text.append(" ")
                continue
            if tag == "p" and not any(e.tag == "p" for e in stack):
                flush(block_of())
                continue
            for depth in range(len(stack) - 1, 0, -1):
                e = stack[depth]
                if e.tag == tag:
                    if tag in _BLOCK:
                        close_to(depth)
                    else:
                        del stack[depth]
                    break
                if tag not in _BLOCK and e.tag in _BLOCK:
                    break  # an inline end tag does not close blocks
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            if m[0].endswith("/>") and tag in ("svg", "math", "object", "iframe") and end is None:
                continue
            at = end.end() if end else (at if tag in ("svg", "math", "object", "noscript") else size)
            text.append(" ") if tag not in ("script", "style", "template") else None
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush(block_of())
            continue
        if stack[-1].tag == "head" and tag not in _HEAD_ONLY:
            close_to(len(stack) - 1)
        if tag in _ENDS_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close_to(depth)
                    break
                if stack[depth].tag in _BLOCK:
                    break
        if tag in _ENDS_SELF and tag != "p":
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag or (tag in ("td", "th") and stack[depth].tag in ("td", "th")) or \
                        (tag in ("dt", "dd") and stack[depth].tag in ("dt", "dd")):
                    close_to(depth)
                    break
                if stack[depth].tag in _ENDS_SELF[tag]:
                    break
        attrs = {k.lower(): htmllib.unescape(a or b or c) for k, a, b, c in _ATTR.findall(m[3])} if m[3] and m[3] != "/" else {}
        parent = stack[-1]
        furniture = _is_furniture(tag, attrs, parent.level)
        drop = parent.drop or _is_hidden(attrs) or (furniture and tag not in _BLOCK)
        level = 2 if tag == "article" else max(parent.level, tag == "main")
        node = parent.node
        if tag in _BLOCK:
            flush(block_of())
            style = f"{tag}.{attrs.get('class', '')}@{attrs.get('role', '')}"
            node = xxhash.xxh3_64_intdigest(f"{parent.node}/{style}".encode("utf-8", "replace"))
            if not drop and last.get(parent.node) != node:
                last[parent.node] = node
                shown[parent.node] = (shown.get(parent.node, 0) * 1_000_003 ^ node) & _MASK
        stack.append(_Open(tag, node, drop, level, parent.named or furniture))
    flush(block_of())
    return out, shown


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)"
_MASK = (1 << 64) - 1


def with_host(pages: DataFrame) -> DataFrame:
    """``pages`` and the lower-case ``host`` of their ``url``, '' without one."""
    return pages.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)))


def _signed(text: str) -> int:
    x = xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))
    return x - (1 << 64) if x >> 63 else x


def _node_hash(host: str, node: int) -> int:
    return _signed(f"{host}\n{node}")


def _block_hash(host: str, node: int, text: str) -> int:
    return _signed(f"{host}\n{node}\n{text}")


#: kinds of the tree's rows: text outside articles, text inside, presentation
_TEXT, _ARTICLE, _STYLE = 0, 1, 2


def style_tree(pages: DataFrame, stages: Stages) -> DataFrame:
    """``host, low`` of the furniture of ``pages`` (``host, html``): hashes of
    the nodes whose branch has little importance, and of the blocks that most
    pages of their node repeat."""
    def content(batches):
        """The distinct blocks and the presentation of each page's nodes;
        ``body`` is the same for pages of a host with equal blocks (those that
        the markup does not name as furniture, if there are any)."""
        for b in batches:
            rows = []
            for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found, shown = parse(page)
                body = _signed("\n".join([t for _, _, named, t in found if not named] or [t for *_, t in found]))
                at = {n: _node_hash(host, n) for n, *_ in found}
                rows += {(host, at[n], _block_hash(host, n, t), body, _ARTICLE if level == 2 else _TEXT, len(t))
                         for n, level, _, t in found}
                rows += [(host, at[n], _signed(str(shown.get(n, 0))), body, _STYLE, 0) for n in at]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), *[pa.int64()] * 3, pa.int32(), pa.int64()))],
                    ["host", "node", "block", "body", "kind", "chars"])

    rows = stages.write(pages.select("host", "html").mapInArrow(
        content, "host string, node long, block long, body long, kind int, chars long").distinct(), "content")
    n, text = F.col("pages"), F.col("kind") != _STYLE
    per_block = rows.groupBy("host", "node", "block", "kind", "chars").agg(F.count("*").alias("pages"))
    of_node = (rows.where(text).select("node", "body").distinct()
               .groupBy(F.col("node").alias("n_node")).agg(F.count("*").alias("of")))
    plogp = n * F.log2(n.cast("double"))
    sums = per_block.groupBy(F.col("node").alias("s_node")).agg(
        F.sum(F.when(text, n)).alias("all"), F.sum(F.when(text, plogp)).alias("plogp"),
        F.sum(F.when(text, n * F.col("chars"))).alias("c_all"), F.sum(F.when(text, plogp * F.col("chars"))).alias("c_plogp"),
        F.sum(F.when(~text, n)).alias("s_all"), F.sum(F.when(~text, plogp)).alias("s_plogp"))
    log_all, log_s, log_of = (F.log2(F.col(c).cast("double")) for c in ("all", "s_all", "of"))
    spread = F.when(F.col("all") > 1, (log_all - F.col("plogp") / F.col("all")) / log_all).otherwise(1.0)
    of_content = 1 - F.col("c_plogp") / F.col("c_all") / log_of
    of_style = F.when(F.col("s_all") > 1, (log_s - F.col("s_plogp") / F.col("s_all")) / log_s).otherwise(1.0)
    importance = CONTENT_WEIGHT * of_content + (1 - CONTENT_WEIGHT) * of_style
    branch, varied = importance < MIN_IMPORTANCE, spread >= MAX_SPREAD
    nodes = (of_node.join(sums, F.col("n_node") == F.col("s_node")).where(F.col("of") >= MIN_PAGES)
             .select(F.col("n_node").alias("node"), "of", branch.alias("branch"), varied.alias("varied"))
             .where("branch OR NOT varied"))
    judged = join_per_key(per_block.where(text), nodes, "node")
    article, of = F.col("kind") == _ARTICLE, F.col("of")
    repeated = (~article & (n >= MIN_PAGES) & (n >= MAX_SHARE * of)
                | article & (n >= MIN_ARTICLE_PAGES) & (n >= MAX_ARTICLE_SHARE * of)) & ~F.col("varied")
    low = F.when(F.col("branch") & ~article, F.col("node")).when(repeated, F.col("block"))
    return judged.select("host", low.alias("low")).where("low IS NOT NULL").distinct()


def main_text(page: str | None, host: str, low) -> str:
    """The blocks of a page that stay, one per line. The tree speaks first
    (``low``: hashes of low nodes and blocks), then the prior: no furniture
    that the markup names, and the blocks of the articles, else of the main
    element, else all."""
    found, _ = parse(page)
    if low:
        out = {n for n in {n for n, *_ in found} if _node_hash(host, n) in low}
        found = [x for x in found if x[0] not in out and _block_hash(host, x[0], x[3]) not in low]
    kept = [(level, t) for _, level, named, t in found if not named]
    top = max((level for level, _ in kept), default=0)
    return "\n".join(t for level, t in kept if level == top)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``, one row per input row.

    A null html gives an empty text; pages without a host in the URL (null
    too) form one host of their own; ids and rows may repeat; other columns
    are ignored. Each page meets its host's furniture in a join with a written
    table, one row per host: a node has at most 1 / ``MAX_SHARE`` repeated
    blocks for each block that a page has there. Spark broadcasts that table
    while its bytes allow it, else the pages are dealt by host and a hot host
    is split.
    """
    spark = pages.sparkSession
    ready(spark)
    rows = with_host(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")))
    st = Stages(spark, "style-tree")
    by_host = style_tree(rows, st).groupBy(F.col("host").alias("f_host")).agg(F.collect_list("low").alias("low"))
    by_host = st.write(by_host, "furniture")
    st.drop(st.live[0])
    out = T.StructType([T.StructField("page_id", rows.schema["page_id"].dataType), T.StructField("url", T.StringType()),
                        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def extract(batches):
        for b in batches:
            low = [frozenset(x or ()) for x in b.column(4).to_pylist()]
            texts = [main_text(page, host, x) for page, host, x in
                     zip(b.column(2).to_pylist(), b.column(3).to_pylist(), low)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (rows.join(by_host, F.col("host") == F.col("f_host"), "left")
            .select("page_id", "url", "html", "host", "low").mapInArrow(extract, out))
