"""Main text of web pages, by a site style tree per host.

Pages of one host are merged into one tree: nodes with the same path of block tags and classes
are one style node. For each node the table counts in how many different pages every content (a hash of a
block's text) and every presentation (the sequence of child tags) occurs. Pages of a host with the same blocks
count once, so that copies take no text away. From these follow, with m pages that have the node:

* content importance, ``1 - mean(log c / log m)`` over its blocks, with c pages per content: 0 for a text that
  is the same on every page, 1 for texts that no two pages share;
* presentation importance, the entropy of child sequences to base m.

The importance of a branch is their weighted sum, with what its role says added: an article or
main element adds (``ARTICLE``), a heading in it adds more (``TITLE``), menus, headers, footers, sidebars, notices, adverts,
forms and comments (by tag, role, class or id) and, where a page has an article, what stands outside subtract (``NOISE``);
the classes and ids of html, body, main and article do not. Branches below the threshold are removed, in articles too:
a style that says the same in a host's different articles is a notice, whatever its class.

As pages may carry the same article, styles in articles are counted over different articles, not pages. Near copies are
no notices either: where the article branch as a whole (the mean over its blocks) is below the threshold, or fewer than
``ARTICLES`` different articles have a style, its importance there counts as 1.

Copies are dropped and counts are combined before each shuffle, so a host with a third of all pages is one row
per style and task where counts are summed; its list of unimportant styles is joined to the pages, and adaptive execution splits
that join where it is skewed.

Defined cases: null or empty html gives an empty text. A null url is host ``''``. Text outside tags is a
block. Unclosed and stray tags are tolerated: a closing tag without an opening one is ignored, a
block start ends an open paragraph. Repeated rows each give a row and count as one page. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stash

# fixed values: HTML tag names by their use, and usual names of page parts
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math object select canvas audio video".split())
CUT_TAGS = set("head nav footer aside form button dialog menu fieldset".split())
CUT_NAMES = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs footer sidebar aside widget notice notices cookie cookies consent popup modal overlay subscribe "
    "newsletter signup login share sharing social related recommended comment comments respond disqus pagination pager "
    "toolbar skip".split()
)
CUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
#: Their classes describe the layout or the kind of page, and cut nothing.
WHOLE = {"html", "body", "main", "article"}
#: Cut outside an article only; an article's own header holds its title.
HEADERS = {"header", "masthead", "topbar"}

THRESHOLD = 0.3
CONTENT, PRESENTATION = 0.8, 0.2
#: What roles add to importance, which is 0 to 1.
ARTICLE, TITLE, NOISE = 0.2, 0.3, -1.0
#: A style in articles is judged by so many different ones at least.
ARTICLES = 10
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Marks in a path what is an article by its role, not by its tag.
BY_ROLE = "@article"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
_ATTR = re.compile(r"\b(class|id|role|itemprop|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split()
)
_CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Style:
    """One node on the way from the root to the text."""

    __slots__ = ("tag", "path", "cut", "article", "title", "children")

    def __init__(self, tag: str, path: str, cut: bool, article: bool, title: bool):
        self.tag, self.path, self.cut, self.article, self.title, self.children = tag, path, cut, article, title, []

    @property
    def inside(self) -> bool:
        return self.article and not self.cut

    def role(self, has_article: bool) -> float:
        """What is added to the importance on a page that has an article, or has none."""
        if self.cut or (has_article and not self.article):
            return NOISE
        return ARTICLE * self.article + TITLE * self.title


def _open(tag: str, attrs: str, above: Style) -> Style:
    names, role, prop = "", "", ""
    cut = above.cut or tag in CUT_TAGS
    if attrs.strip():
        for m in _ATTR.finditer(attrs):
            value = (m[2] or m[3] or m[4] or "").lower()
            kind = m[1].lower()
            if kind in ("class", "id"):
                names += " " + value
            elif kind == "role":
                role = value
            elif kind == "itemprop":
                prop = value
            elif m[2] is None and m[3] is None and m[4] is None:
                cut = True  # hidden
    words = set(_WORDS.findall(names))
    by_role = not above.article and tag not in ("article", "main") and (role in ("main", "article") or prop == "articlebody")
    article = above.article or tag in ("article", "main") or by_role
    named = tag not in WHOLE and bool(words & CUT_NAMES)
    cut = cut or named or role in CUT_ROLES or (not article and (tag == "header" or (tag not in WHOLE and bool(words & HEADERS))))
    mark = tag + ("." + ".".join(sorted(set(names.split()))) if names else "")
    above.children.append(mark)
    return Style(tag, above.path + "/" + mark + BY_ROLE * by_role, cut, article, above.title or (article and tag in HEADINGS))


def parse(page: str) -> tuple[list[tuple[str, Style]], list[Style]]:
    """The text blocks of a page in order, each with its style node, and all nodes."""
    root = Style("", "", False, False, False)
    stack, blocks, nodes, run, at = [root], [], [root], [], 0

    def flush() -> None:
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            run.clear()
            if text:
                blocks.append((text, stack[-1]))

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            run.append(page[at:])
            break
        if m.start() > at:
            run.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                run.append(m[0][9:-3])
            continue
        closing, attrs = m[1] or m[4], m[3] or m[6] or ""
        if tag in RAW:
            if not closing and not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
                run.append(" ")
            continue
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                run.append(" " if tag == "br" else "")
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in _CLOSES_P and stack[-1].tag == "p":
            stack.pop()
        same = _CLOSES_SAME.get(tag)
        if same:
            while stack[-1].tag in same or (stack[-1].tag == "p" and len(stack) > 1 and stack[-2].tag in same):
                stack.pop()
        node = _open(tag, attrs, stack[-1])
        nodes.append(node)
        if tag not in VOID and not attrs.endswith("/"):
            stack.append(node)
    flush()
    return blocks, nodes


ITEMS = "array<struct<kind: int, path: long, item: long>>"
#: Kinds of items: a block's content, a sequence of child tags; the same in articles.
SAID, SHOWN, SAID_INSIDE, SHOWN_INSIDE = 0, 1, 2, 3
BOTH = [SAID, SAID_INSIDE], [SHOWN, SHOWN_INSIDE]


def _styles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What style nodes hold, for each page and each article that the batch does not have already. ``page`` is a hash of
    its blocks, ``tree`` one of its nodes."""
    for batch in batches:
        pages: dict[tuple[str, int, int], set] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            blocks, nodes = parse(page)
            article = [(text, s) for text, s in blocks if s.inside], [n for n in nodes if n.inside]
            for of, (b, n) in (("", (blocks, nodes)), ("article", article)):
                if of and not n:
                    continue
                key = host, _hash(of + repr([(s.path, text) for text, s in b])), _hash(repr([(x.path, x.children) for x in n]))
                if key not in pages:
                    said, shown = (SAID_INSIDE, SHOWN_INSIDE) if of else (SAID, SHOWN)
                    pages[key] = {(said, _hash(s.path), _hash(text)) for text, s in b if of or not s.inside} | {
                        (shown, _hash(x.path), _hash(" ".join(x.children))) for x in n if of or not x.inside
                    }
        hosts, texts, trees = zip(*pages, strict=True) if pages else ((), (), ())
        columns = zip(*(x for held in pages.values() for x in held), strict=True) if pages else ((), (), ())
        items = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["kind", "path", "item"])
        offsets = np.cumsum([0, *map(len, pages.values())]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array(hosts, pa.string()), pa.array(texts, pa.int64()), pa.array(trees, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), items),
        ], ["host", "page", "tree", "items"])


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))


def style_importance(pages: DataFrame) -> DataFrame:
    """``host``, ``path`` and ``importance`` of every style node with text, before roles are added; whether it is in articles
    (``inside``), and how many blocks and how many pages or articles it was counted on."""
    held = with_host(pages).select("host", "html").mapInArrow(_styles, f"host string, page long, tree long, items {ITEMS}")
    different = held.groupBy("host", "page").agg(F.min_by("items", "tree").alias("items"))
    items = different.select("host", F.inline("items")).groupBy("kind", "host", "path", "item").agg(F.count("*").alias("n"))
    by_path = items.groupBy("host", "path").agg(
        *[F.sum(F.when(F.col("kind").isin(k), F.col("n"))).alias(f"n{i}") for i, k in enumerate(BOTH)],
        *[F.sum(F.when(F.col("kind").isin(k), F.col("n") * F.log("n"))).alias(f"s{i}") for i, k in enumerate(BOTH)],
        (F.max("kind") >= SAID_INSIDE).alias("inside"),
    )
    m = F.log(F.greatest("n1", F.lit(2)))  # every page with the node has one sequence of children
    content = F.greatest(F.lit(0.0), 1 - F.col("s0") / (F.col("n0") * m))
    shown = F.when(F.col("n1") > 1, (F.log("n1") - F.col("s1") / F.col("n1")) / F.log("n1")).otherwise(1.0)
    importance = (CONTENT * content + PRESENTATION * shown).alias("importance")
    return by_path.filter("n0 is not null").select("host", "path", importance, "inside", F.col("n0").alias("blocks"), F.col("n1").alias("pages"))


def low_importance(styles: DataFrame, threshold: float) -> DataFrame:
    """``host`` and the importance of its styles that are judged and below the threshold (``low``)."""
    judged = (F.col("importance") < threshold) & (~F.col("inside") | (F.col("pages") >= ARTICLES))
    by_host = styles.groupBy("host").agg(
        *[F.collect_list(F.when(judged & (F.col("inside") == k), F.struct("path", "importance"))).alias(f"low{int(k)}") for k in (False, True)],
        (F.sum(F.when(F.col("inside"), F.col("importance") * F.col("blocks"))) / F.sum(F.when(F.col("inside"), F.col("blocks")))).alias("article"),
    )
    low = F.when(F.col("article") >= threshold, F.concat("low0", "low1")).otherwise(F.col("low0"))
    return by_host.select("host", F.map_from_entries(low).alias("low")).filter(F.size("low") > 0)


def _extract(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, low in zip(batch.column("html").to_pylist(), batch.column("low"), strict=True):
                blocks, nodes = parse(page)
                has_article = any(n.inside for n in nodes)
                importance = dict(low.as_py() or ())
                known: dict[tuple[str, float], bool] = {}
                kept = []
                for text, style in blocks:
                    node = style.path, style.role(has_article)
                    if node not in known:
                        known[node] = importance.get(_hash(style.path), 1.0) + node[1] >= threshold
                    if known[node]:
                        kept.append(text)
                texts.append("\n\n".join(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))],
                ["page_id", "url", "text", "n_chars"],
            )

    return run


def extract_text(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    by_host = stash(low_importance(style_importance(pages), threshold), "styles")
    joined = with_host(pages).join(by_host, "host", "left").select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "low")
    return joined.mapInArrow(_extract(threshold), "page_id long, url string, text string, n_chars long")


def op7_html(spark, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
