"""Main text of web pages, without the site's templates.

1. Every page is parsed into blocks of text and structural elements; each
   element outside the running text has a hash of its subtree.
2. Spark counts, per host, beside how many different bodies of text a subtree
   occurs. A page's body is its paragraphs, so all copies of a story count once.
3. Subtrees that recur beside MIN_BODIES bodies of their host are deleted, inside
   an article or not, together with what its element or class says is no article
   (menus, footers, adverts).

Running paragraphs of an article, and elements that hold half of the page's text
or more, are never taken for a template. Rows of a table and items of a list go
with their whole table or list only.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import replace_columns, shielded, stage
from ledgerlake.llm.url_filter import split_url

#: A subtree is template if it stands beside this many different bodies of the host.
MIN_BODIES = 5

# Element and class names.
DROP = {"nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "svg", "canvas", "button", "select", "input", "textarea", "menu",
        "dialog", "object", "head", "title", "header"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small",
          "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img"}
PARAGRAPHS = {"p", "blockquote", "pre"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = PARAGRAPHS | HEADINGS
#: Parts of lists and tables, never a template by themselves.
ITEMS = {"li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption"}
#: Never dropped for a class or role, and never a template.
ROOTS = {"html", "body", "main", "article"}
CLOSED_BY_NEXT = {"p": PROSE | {"div", "ul", "ol", "dl", "table", "section", "article", "nav", "header", "footer", "aside", "form", "main", "figure", "hr", "address", "fieldset"},
                  "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
#: Whole class names or ids; a longer name that begins with one (notice-board) says nothing.
DROP_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent", "notice", "popup", "modal",
              "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "comment", "comments", "disqus", "newsletter", "subscribe", "footer",
              "share", "social", "related", "ad-banner", "ad-box", "ad-container", "ad-slot", "cookie-banner", "cookie-consent", "cookie-notice",
              "comment-list", "comments-area", "main-menu", "main-nav", "page-footer", "page-header", "related-articles", "related-posts",
              "share-buttons", "site-footer", "site-header", "site-nav", "social-share"}
DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)


@dataclass
class Element:
    tag: str
    number: int
    dropped: bool
    sum: xxhash.xxh64 = field(default_factory=xxhash.xxh64)
    chars: int = 0


@dataclass
class Page:
    """Blocks outside dropped elements (text, countable elements around it), subtree hashes of these by number, and the body's hash."""

    blocks: list[tuple[str, tuple[int, ...]]]
    hashes: dict[int, int]
    body: int


def _says_drop(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ROOTS:
        return False
    if tag in DROP and not (tag == "header" and in_article):
        return True
    for name, *values in NAMED.findall(attributes):
        words = "".join(values).lower().split()
        if name.lower() == "role":
            if DROP_ROLES.intersection(words):
                return True
        elif DROP_WORDS.intersection(words):
            return True
    return False


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _body(blocks: list[tuple[str, tuple[int, ...]]], tags: dict[int, str]) -> int:
    """Hash of the paragraphs inside articles, or of what else comes next to them: headings, lists, all text; then of the whole page."""
    inside = [(t, {tags[n] for n in around}) for t, around in blocks]
    for part in ([b for b in inside if b[1] & {"article", "main"}], inside):
        for kinds in (PARAGRAPHS, HEADINGS, ITEMS, None):
            if text := "\n".join(t for t, names in part if kinds is None or names & kinds):
                return _signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")))
    return 0


def parse(source: str | None) -> Page:
    """One pass over the page; unclosed, crossing and cut-off tags are taken as browsers roughly do."""
    source = source or ""
    stack: list[Element] = []
    blocks: list[tuple[str, tuple[int, ...]]] = []
    hashes: dict[int, int] = {}
    tags: dict[int, str] = {}
    buffer: list[str] = []
    depth = {"article": 0, "dropped": 0}
    made = at = 0

    def flush() -> None:
        text = " ".join(html_lib.unescape("".join(buffer)).split()) if buffer and not depth["dropped"] else ""
        buffer.clear()
        if text:
            if stack:
                stack[-1].sum.update(text.encode("utf-8", "surrogatepass"))
                stack[-1].chars += len(text)
            blocks.append((text, tuple(e.number for e in stack)))

    def close() -> None:
        e = stack.pop()
        depth["article"] -= e.tag == "article"
        depth["dropped"] -= e.dropped
        if e.chars:
            digest = e.sum.intdigest()
            hashes[e.number] = _signed(digest)
            if stack:
                stack[-1].sum.update(f"<{e.tag} {digest}>".encode())
                stack[-1].chars += e.chars

    while at < len(source):
        m = TOKEN.search(source, at)
        piece = source[at:m.start() if m else len(source)]
        if piece:
            buffer.append(piece)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in INLINE:
            if tag == "br":
                buffer.append(" ")
            continue
        flush()
        if m[1]:
            if any(e.tag == tag for e in stack):
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        while stack and tag in CLOSED_BY_NEXT.get(stack[-1].tag, ()):
            close()
        if tag in VOID:
            continue
        e = Element(tag, made, _says_drop(tag, m[3], depth["article"] > 0))
        made += 1
        tags[e.number] = tag
        stack.append(e)
        depth["dropped"] += e.dropped
        depth["article"] += tag == "article"
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            at = end.start() if end else len(source)
    flush()
    while stack:
        close()

    total, held = sum(len(t) for t, _ in blocks), Counter()
    for text, around in blocks:
        held.update(dict.fromkeys(around, len(text)))
    kept = {n for n in held if tags[n] in ROOTS or (len(blocks) > 1 and 2 * held[n] >= total)}
    for _, around in blocks:  # running text of an article
        first = next((i for i, n in enumerate(around) if tags[n] == "article"), len(around))
        kept.update(n for n in around[first:] if tags[n] in PROSE)
    hashed = {n: h for n, h in hashes.items() if n not in kept and tags[n] not in ITEMS}
    return Page([(t, tuple(n for n in around if n in hashed)) for t, around in blocks], hashed, _body(blocks, tags))


def text_without(page: Page, templates: set[int]) -> str:
    return "\n".join(t for t, around in page.blocks if not any(page.hashes[n] in templates for n in around))


def subtrees(keyed: DataFrame, html: str) -> DataFrame:
    """(host, page, body, subtree): the hashes of each page, once each. Equal pages of a host are one page."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = {(h, p, page.body, x) for h, p, page in zip(b["host"], b["page"], map(parse, b["source"])) for x in page.hashes.values()}
            yield pd.DataFrame(sorted(rows), columns=["host", "page", "body", "subtree"])

    return keyed.select("host", "page", F.col(html).alias("source")).mapInPandas(each, "host string, page long, body long, subtree long").distinct()


def extract(pages: DataFrame, *, html: str = "html", url: str = "url", min_bodies: int = MIN_BODIES) -> DataFrame:
    """``pages`` with the main text (``text``); every other column stays, an input column ``text`` is replaced.

    A null or empty page has an empty text. Pages without a host share the
    empty host. Repeated pages get equal texts and count as one page of their
    host. Character references are decoded, white space inside a block becomes
    one blank, blocks are joined by a line feed. A very long page is read whole,
    in one task's memory. An empty table gives no rows.
    """
    pages, back = shielded(pages)
    keyed = replace_columns(pages, ["text"]).withColumns({"_host": split_url(F.col(url))[0], "_page": F.xxhash64(F.coalesce(F.col(html), F.lit("")))})
    own = keyed.select(F.col("_host").alias("host"), F.col("_page").alias("page"), html)
    nodes = stage(subtrees(own, html), "html-subtrees")
    counted = nodes.select("host", "subtree", "body").distinct().groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= min_bodies)
    templates = stage(counted.select("host", "subtree"), "html-templates")

    free, bound = T.StructField("text", T.StringType()), T.StructField("open", T.BooleanType())

    @F.pandas_udf(T.StructType([free, bound]))
    def first_look(sources: pd.Series) -> pd.DataFrame:
        out = []
        for s in sources:
            page = parse(s)
            out.append((None, True) if page.hashes else (text_without(page, set()), False))
        return pd.DataFrame(out, columns=["text", "open"])

    @F.pandas_udf(T.StringType())
    def second_look(sources: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([text_without(parse(s), set() if f is None else set(f)) for s, f in zip(sources, found)])

    # Pages that hold no countable subtree are done; only the others need their host's templates.
    looked = keyed.withColumn("_look", first_look(F.col(html)))
    done = looked.where(~F.col("_look.open")).withColumn("text", F.col("_look.text"))
    waiting = looked.where(F.col("_look.open")).drop("_look")
    of_page = (nodes.join(templates, ["host", "subtree"]).groupBy("host", "page").agg(F.collect_list("subtree").alias("_found"))
               .withColumnsRenamed({"host": "_host", "page": "_page"}))
    rest = waiting.join(of_page, ["_host", "_page"], "left").withColumn("text", second_look(F.col(html), F.col("_found")))
    names = [c for c in keyed.columns if c not in ("_host", "_page")]
    return done.select(*[F.col(f"`{c}`") for c in names], "text").unionByName(rest.select(*[F.col(f"`{c}`") for c in names], "text")).withColumnsRenamed(back)
