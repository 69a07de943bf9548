"""Main text of web pages by a site style tree.

The pages of a host are laid over each other: elements with the same path of tags and classes are
one node of the host's tree. A node's children come in styles (the sequence of child elements);
the entropy of the styles over the pages is its presentation importance. A text block's content
importance falls with the share of pages that have the same text there. At a node whose composite
importance is low, a text is template if ``LEAST_PAGES`` pages have it there beside texts of their
own, of ``OWN_WORDS`` words or ``OWN_SHARE`` of the page; it is removed from each page of the host, and so is a branch all
of whose blocks are removed. Other texts of the node stay: those of one page, and what only near
copies have (a copy that differs in a date or in a menu has hardly a text of its own). Pages of a
host whose blocks of text are equal count once. With two pages no text is template: what both have
may as well be an article in two places.

Elements that name their role (menus, headers, footers, side bars, notices, adverts, forms,
reader comments, scripts, styles) are never part of the text. A class or id names a role if all its
parts do, or tell where or in what form it stands (``top-menu``, ``comment-list``, but not
``social-science``); on a page without an article such an element stays all the same if most of the text is
in it, unless it names reader comments, which can be longer than what they comment on. The text is what stands in ``article`` or ``main`` elements if that is half of the page's text or more,
otherwise all of it.

Handling of odd input: a NULL or empty page gives an empty text; a NULL or unreadable url counts
as a host of its own name (the empty one); rows that repeat are each returned; unclosed elements
end with what holds them; very long and deep pages are read whole; ties don't arise; an empty table
gives no rows; other columns are passed on, whatever their names, an existing output column is
replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.session import written

LEAST_PAGES = 3
LOW = 0.15
CONTENT_SHARE = 0.9  # of the content importance in the composite one
OWN_WORDS = 8
OWN_SHARE = 0.2
SMALL_SET = 200_000  # template texts that are sent to the workers; more are joined

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
# an opening tag that ends an open element of these names
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDS = frozenset("article aside body div dl fieldset footer form header html main nav ol section table td th ul".split())
_NEVER = frozenset(
    "aside button canvas dialog footer form head iframe menu nav noscript object script select style svg template textarea title".split()
)
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# fixed values: words that name a role, and words that may stand beside them in a class or id
_ROLE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promos promotion cookie cookies consent gdpr "
    "notice notices alert alerts sidebar menu menus nav navbar navigation breadcrumb breadcrumbs comment comments commentlist "
    "reply replies footer share sharing social related newsletter subscribe subscription popup modal widget widgets masthead "
    "toolbar pagination skiplink".split()
)
_COMMENT_WORDS = frozenset("comment comments commentlist reply replies".split())
_PLACE_WORDS = frozenset(
    "top bottom left right main site page global inner outer upper lower primary secondary mobile desktop sticky fixed header "
    "wrapper wrap container box block bar area section list item items group row column col panel holder slot unit inline links "
    "link buttons button icons icon posts post articles stories media form signup bottom text content overlay dialog dropdown "
    "side skip to user reader the js".split()
)
_SPLIT_NAME = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NAME_PARTS = re.compile(r"[-_]+|\d+")
_FOREIGN = frozenset(("svg", "math"))  # "/>" ends these and what is in them; elsewhere it means nothing
_DIGITS = re.compile(r"\d+")
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def names_role(name: str) -> bool:
    """Whether a class or id tells that its element is no part of the text."""
    parts = [p for p in _NAME_PARTS.split(_SPLIT_NAME.sub("-", name).lower()) if p]
    joined = "".join(parts)  # side-bar, nav-bar
    if joined in _ROLE_WORDS:
        return True
    return any(p in _ROLE_WORDS for p in parts) and all(p in _ROLE_WORDS or p in _PLACE_WORDS for p in parts)


class Page(HTMLParser):
    """Text blocks of a page, each with the path of its element, and the style of each element."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str]] = []  # (tag, path)
        self.dropped = 0  # place on the stack, from 1, of the element below which nothing is text
        self.inside = 0  # open article or main elements
        self.foreign = 0  # place on the stack, from 1, of the outermost svg or math element
        self.named: list[tuple[int, int]] = []  # open elements that only a class or id names: (place, number)
        self.names = 0
        self.parts: list[tuple[str, tuple[int, ...]]] = []  # (text, named elements around it)
        self.blocks: list[tuple[str, list, bool]] = []  # (path, parts, inside an article)
        self.children: dict[str, list[str]] = {}
        self.feed(html)
        self.close()
        self._end_block()

    def _path(self) -> str:
        return self.open[-1][1] if self.open else ""

    def _end_block(self) -> None:
        if any(part.strip() for part, _ in self.parts):
            self.blocks.append((self._block_path(), self.parts, self.inside > 0))
        self.parts = []

    def _block_path(self) -> str:
        for tag, path in reversed(self.open):
            if tag in _BLOCK:
                return path
        return ""

    def _pop(self) -> None:
        tag, _ = self.open.pop()
        if tag in ("article", "main"):
            self.inside -= 1
        if self.dropped > len(self.open):
            self.dropped = 0
        if self.foreign > len(self.open):
            self.foreign = 0
        while self.named and self.named[-1][0] > len(self.open):
            self.named.pop()

    def _close(self, names: tuple[str, ...]) -> None:
        """End the innermost open element of these names, unless a container stands between."""
        for k in range(len(self.open) - 1, -1, -1):
            tag = self.open[k][0]
            if tag in names:
                while len(self.open) > k:
                    self._pop()
                return
            if tag in _HOLDS:
                return

    def _unwanted(self, tag: str, attrs: dict) -> bool:
        if tag in _NEVER or "hidden" in attrs or (attrs.get("role") or "").lower() in _ROLES:
            return True
        return tag == "header" and not self.inside

    def _named(self, tag: str, attrs: dict) -> bool:
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
        return tag not in ("html", "body", "main") and any(names_role(n) or (n.lower() == "header" and not self.inside) for n in names)

    def _may_stay(self, attrs: dict) -> bool:
        names = _NAME_PARTS.split(_SPLIT_NAME.sub("-", f"{attrs.get('class') or ''}-{attrs.get('id') or ''}").lower().replace(" ", "-"))
        return not self.inside and _COMMENT_WORDS.isdisjoint(names)

    def handle_starttag(self, tag: str, attributes: list) -> None:
        attrs = dict(attributes)
        if tag == "br":
            self.handle_data(" ")
        if tag in _BLOCK:
            if not self.dropped:
                self._end_block()
            self._close(("p",))
            self._close(_ENDS.get(tag, ()))
        if tag in _VOID:
            return
        style = tag + "".join("." + c for c in sorted(_DIGITS.sub("0", attrs.get("class") or "").split()))
        parent = self._path()
        if tag in _BLOCK and not self.dropped:
            self.children.setdefault(parent, []).append(style)
        self.open.append((tag, f"{parent}/{style}"))
        if tag in _FOREIGN and not self.foreign:
            self.foreign = len(self.open)
        named = not self.dropped and self._named(tag, attrs)
        if not self.dropped and (self._unwanted(tag, attrs) or (named and not self._may_stay(attrs))):
            self.dropped = len(self.open)
        elif named:
            self.names += 1
            self.named.append((len(self.open), self.names))
        if tag in ("article", "main"):
            self.inside += 1

    def handle_startendtag(self, tag: str, attributes: list) -> None:
        self.handle_starttag(tag, attributes)
        if self.foreign and tag not in _VOID:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCK and not self.dropped:
            self._end_block()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                while len(self.open) > k:
                    self._pop()
                return
            if tag not in _BLOCK and self.open[k][0] in _BLOCK:
                return  # an inline end tag doesn't end a block

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.parts.append((data, tuple(n for _, n in self.named)))

    def main_blocks(self) -> list[tuple[str, str]]:
        """(path, text) of the blocks that are the page's own text."""
        sizes, total = Counter(), 0
        for _, parts, _ in self.blocks:
            for part, names in parts:
                size = sum(map(len, part.split()))
                total += size
                sizes.update(dict.fromkeys(names, size))
        article = any(inside and not names for _, parts, inside in self.blocks for part, names in parts if part.strip())
        stays = {n for n, size in sizes.items() if 2 * size > total and not article}
        found = []
        for path, parts, inside in self.blocks:
            text = " ".join("".join(part for part, names in parts if stays.issuperset(names)).split())
            if text:
                found.append((path, text, inside))
        own = [(p, t) for p, t, inside in found if inside]
        if 2 * sum(len(t) for _, t in own) >= sum(len(t) for _, t, _ in found):
            return own
        return [(p, t) for p, t, _ in found]


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - 2**63


def _text_item(site: str, path: str, text: str) -> int:
    return _hash(site, "text", path, text)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, parent, item, page) of the trees: a node's contents and styles on each page.

    A NULL item stands for the page itself, so its count is the number of pages with the node. A
    content has its words and those of all contents of the page.
    """
    for batch in batches:
        rows = set()
        for url, html in zip(batch["url"], batch["html"]):
            html = html.as_py()
            if not html:
                continue
            site, parsed = host(url.as_py()), Page(html)
            blocks = parsed.main_blocks()
            page = _hash(site, *(part for block in blocks for part in block))
            styled = _hash(str(page), *(part for path, styles in parsed.children.items() for part in (path, *styles)))
            total = sum(len(text.split()) for _, text in set(blocks))
            for path, text in blocks:
                node, parent = _hash(site, "text", path), _hash(site, "style", path.rpartition("/")[0])
                rows.add((node, parent, _text_item(site, path, text), page, len(text.split()), total))
                rows.add((node, parent, None, page, 0, total))
            for path, styles in parsed.children.items():
                node = _hash(site, "style", path)
                rows.add((node, None, _hash(*styles), styled, 0, 0))
                rows.add((node, None, None, styled, 0, 0))
        columns = list(zip(*rows)) if rows else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "parent", "item", "page", "size", "total"])


def template_texts(pages: DataFrame) -> DataFrame:
    """Texts (item) that are template at nodes of low composite importance."""
    rows = pages.select("url", "html").mapInArrow(_nodes, "node long, parent long, item long, page long, size long, total long")
    rows = written(rows.dropDuplicates(["node", "parent", "item", "page"]), "tree_rows")
    k, item = F.col("k"), F.col("item")
    counts = rows.groupBy("node", "parent", "item").agg(F.count("*").alias("k"))
    stats = counts.groupBy("node", "parent").agg(
        F.max(F.when(item.isNull(), k)).alias("pages"),
        F.sum(F.when(item.isNotNull(), k)).alias("items"),
        F.sum(F.when(item.isNotNull(), k * F.log(k))).alias("spread"),
    )
    stats = written(stats, "style_tree")
    same = F.col("spread") / F.col("items") / F.log("pages")
    text = stats.where(F.col("parent").isNotNull() & (F.col("pages") >= LEAST_PAGES)).select("node", "parent", (1 - same).alias("content"))
    style = stats.where(F.col("parent").isNull()).select(
        F.col("node").alias("parent"),
        F.when(F.col("pages") > 1, F.log("items") / F.log("pages") - same).otherwise(1.0).alias("presentation"),
    )
    importance = CONTENT_SHARE * F.col("content") + (1 - CONTENT_SHARE) * F.coalesce("presentation", F.lit(0.0))
    low = written(text.join(style, "parent", "left").where(importance < LOW).select("node"), "low_nodes")
    # the blocks at these nodes whose text several pages have
    at_low = rows.where(F.col("parent").isNotNull() & item.isNotNull()).join(low, "node").select("item", "page", "size", "total")
    at_low = written(at_low, "low_blocks")
    often = at_low.groupBy("item").agg(F.count("*").alias("k")).where(k >= LEAST_PAGES).select("item")
    shared = written(at_low.join(often, "item"), "shared_blocks")
    own = shared.groupBy("page").agg(F.sum("size").alias("size"), F.max("total").alias("total"))
    alone = F.col("total") - F.col("size")
    own = own.where((alone >= OWN_WORDS) | (alone >= OWN_SHARE * F.col("total"))).select("page")
    return shared.join(own, "page").groupBy("item").agg(F.count("*").alias("k")).where(k >= LEAST_PAGES).select("item")


def _text_of(url: str | None, html: str | None, template: set[int]) -> str:
    if not html:
        return ""
    site, blocks = host(url), Page(html).main_blocks()
    return "\n".join(text for path, text in blocks if not template or _text_item(site, path, text) not in template)


def extract(pages: DataFrame, small_set: int = SMALL_SET) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``; the html itself is left out."""
    template = written(template_texts(pages), "template")
    kept = [c for c in pages.columns if c not in ("html", "text")]
    if template.count() <= small_set:
        items = pages.sparkSession.sparkContext.broadcast({r["item"] for r in template.collect()})

        @F.arrow_udf("string")
        def text_of(urls: pa.Array, htmls: pa.Array) -> pa.Array:
            return pa.array([_text_of(u.as_py(), h.as_py(), items.value) for u, h in zip(urls, htmls)], pa.string())

        return pages.withColumn("text", text_of("url", "html")).select(*kept, "text")

    def own_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for url, html in zip(batch["url"], batch["html"]):
                site, html = host(url.as_py()), html.as_py() or ""
                rows.update((_hash(html), _text_item(site, p, t)) for p, t in Page(html).main_blocks())
            columns = list(zip(*rows)) if rows else [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["page", "item"])

    @F.arrow_udf("long")
    def page_key(htmls: pa.Array) -> pa.Array:
        return pa.array([_hash(h.as_py() or "") for h in htmls], pa.int64())

    @F.arrow_udf("string")
    def text_without(urls: pa.Array, htmls: pa.Array, items: pa.Array) -> pa.Array:
        return pa.array([_text_of(u.as_py(), h.as_py(), set(i.as_py() or ())) for u, h, i in zip(urls, htmls, items)], pa.string())

    # per distinct page its template texts: as many as the page has blocks at most
    of_page = pages.select("url", "html").mapInArrow(own_items, "page long, item long").distinct().join(template, "item")
    of_page = of_page.groupBy("page").agg(F.collect_set("item").alias("__items"))
    joined = pages.withColumn("__page", page_key("html")).join(of_page.withColumnRenamed("page", "__page"), "__page", "left")
    return joined.withColumn("text", text_without("url", "html", "__items")).select(*kept, "text")
