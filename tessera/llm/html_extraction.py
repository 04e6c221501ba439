"""Main text of web pages by site template removal: element subtrees are hashed and counted per
host, and subtrees that recur across many pages of a host are deleted."""

from __future__ import annotations

import html
import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, only

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPACE = re.compile(r"\s+")

# Element names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_NEVER = frozenset("head script style noscript template iframe object svg canvas nav footer aside form button select option textarea input dialog menu audio video map xmp noembed noframes title".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_CLOSES_SAME = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "tbody": "tr td th thead tbody", "thead": "tr td th", "tfoot": "tr td th tbody"}
_SCOPE = frozenset("article section div main body html nav footer aside header form table ul ol dl td th blockquote figure".split())
_PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr figcaption".split())
# Words in class, id and role that name page furniture. A whole word must match, so that
# has-sidebar or comments-open don't.
_FURNITURE = re.compile(r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|breadcrumbs?|nav|navbar|navigation|menu|sidebar|side-bar|footer|masthead|cookies?|consent|gdpr|notice|alert|newsletter|subscribe|signup|sign-up|login|share|sharing|social|related|recommended|comments?|comment-list|disqus|respond|popup|modal|overlay|paywall|widget|toolbar|pagination|skip-link|contentinfo|complementary|search)", re.I)
_ROOTED = frozenset("html body main article".split())
_BREAK = None


def _furniture(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is furniture whatever it holds, and whether class words name it so."""
    if tag in _NEVER or tag == "header" and not in_article:
        return True, False
    if not attrs.strip():
        return False, False
    worded = False
    for name, value in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role") and tag not in _ROOTED:
            worded |= any(_FURNITURE.fullmatch(w) for w in value.split())
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True, worded
    return False, worded


class _Open:
    __slots__ = ("tag", "attrs", "start", "parts", "drop", "holds_root", "in_root", "in_paragraph", "worded")

    def __init__(self, tag, attrs, start, drop, in_root, in_paragraph, worded):
        self.tag, self.attrs, self.start, self.drop, self.in_root, self.in_paragraph, self.worded = tag, attrs, start, drop, in_root, in_paragraph, worded
        self.parts, self.holds_root = [], False


def read_page(page: str, templates=frozenset()) -> tuple[str, set[int]]:
    """The main text of a page without the `templates`, and the hashes of its subtrees that may be
    templates: blocks that neither hold, are nor lie in an article or main element, and don't lie in a
    paragraph."""
    out: list[str | None] = []
    hashes: set[int] = set()
    roots: dict[str, list[tuple[int, int]]] = {"article": [], "main": []}
    others: dict[str, list[tuple[int, int]]] = {"article": [], "main": []}
    stack = [_Open("", "", 0, False, False, False, False)]

    def close() -> None:
        node = stack.pop()
        parent = stack[-1]
        digest = blake2b("\x1f".join([node.tag, node.attrs, *node.parts]).encode("utf-8", "surrogatepass"), digest_size=8).digest()
        key = int.from_bytes(digest, "little", signed=True)
        parent.parts.append(f"{key:x}")
        is_root = node.tag in roots and not node.drop
        block = node.tag not in _INLINE and not node.in_paragraph and node.tag not in ("html", "body", "head")
        if block and not (is_root or node.holds_root or node.in_root):
            hashes.add(key)
            node.drop |= key in templates
        if node.worded and not node.drop:
            if node.holds_root and not any(x.tag == "article" and not x.drop for x in stack):
                for k, spans in roots.items():
                    others[k] += [x for x in spans if x[0] >= node.start]
                    spans[:] = [x for x in spans if x[0] < node.start]
            else:
                node.drop = True
        if node.drop:
            for spans in (*roots.values(), *others.values()):
                spans[:] = [x for x in spans if x[0] < node.start]
            del out[node.start :]
        elif is_root:
            roots[node.tag].append((node.start, len(out)))
        parent.holds_root |= node.holds_root or is_root
        if node.tag not in _INLINE:
            out.append(_BREAK)

    def close_to(k: int) -> None:
        while len(stack) > k:
            close()

    def text(raw: str) -> None:
        if raw:
            decoded = html.unescape(raw)
            out.append(decoded)
            stack[-1].parts.append(_SPACE.sub(" ", decoded))

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag, attrs, closing = tag.lower(), found[3] or found[6] or "", bool(found[1] or found[4])
        if closing:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag or tag in _INLINE and stack[k].tag in _SCOPE), 0)
            if k and stack[k].tag == tag:
                close_to(k)
            continue
        ends = ("p",) if tag in _CLOSES_P else _CLOSES_SAME.get(tag, "").split()
        if ends:
            barrier = _SCOPE if "p" in ends else frozenset(("ul", "ol", "dl", "table", "article", "body", "select"))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close_to(k)
                    break
                if stack[k].tag in barrier:
                    break
        if tag not in _INLINE:
            out.append(_BREAK)
        elif tag in ("br", "wbr", "img"):
            out.append(" " if tag == "br" else "")
        in_root = stack[-1].in_root or stack[-1].tag in roots and not stack[-1].drop
        if tag in _VOID or attrs.endswith("/"):
            stack[-1].parts.append(tag)
            if tag in _VOID:
                continue
        in_paragraph = stack[-1].tag in _PARAGRAPH or stack[-1].tag in _INLINE and stack[-1].in_paragraph
        drop, worded = _furniture(tag, attrs, in_root)
        stack.append(_Open(tag, attrs.strip(), len(out), drop, in_root, in_paragraph, worded))
        if tag in _RAW:
            over = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            stack[-1].parts.append(page[at : over.start() if over else end])
            if tag == "textarea":
                stack[-1].drop = True
            at = over.end() if over else end
            close_to(len(stack) - 1)
    close_to(1)
    spans = roots["article"] or roots["main"] or others["article"] or others["main"] or [(0, len(out))]
    blocks, held, reached = [], [], -1
    for start, stop in sorted(spans, key=lambda s: (s[0], -s[1])):
        if stop <= reached:  # nested
            continue
        reached = stop
        for x in [*out[start:stop], _BREAK]:
            if x is _BREAK:
                if held and (block := _SPACE.sub(" ", "".join(held)).strip()):
                    blocks.append(block)
                held = []
            else:
                held.append(x)
    return "\n".join(blocks), hashes


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _hash_pages(batches):
    for batch in batches:
        hosts, keys = [], []
        for host, page in zip(batch["host"].to_pylist(), batch["html"], strict=True):
            found = read_page(page.as_py() or "")[1]
            hosts += [host] * len(found)
            keys += found
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64())], ["host", "subtree"])


def site_templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = 5, min_share: float = 0.01) -> DataFrame:
    """host, subtree, n_pages: subtrees on at least `min_pages` pages of a host and `min_share` of
    them. Counts are combined before the shuffle, so a host with most pages weighs no more."""
    rows = only(pages, url=url_col, html=html_col).withColumn("host", _host(F.col("url")))
    sizes = rows.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = rows.select("host", "html").mapInArrow(_hash_pages, "host string, subtree long").groupBy("host", "subtree").agg(F.count("*").alias("n_pages"))
    often = counts.filter(F.col("n_pages") >= min_pages).join(sizes, "host")
    return often.filter(F.col("n_pages") >= min_share * F.col("host_pages")).select("host", "subtree", "n_pages")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = 5, min_share: float = 0.01) -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars.

    The text is that of the article elements (else of main, else of the page) without furniture
    (elements, roles and class words that name menus, headers, footers, sidebars, notices, adverts,
    forms, comments, hidden parts) and without the templates of its host: blocks outside article and
    main elements that recur, such as menus and notices that no name gives away. What lies in an
    article, and inline elements, stay however often they recur. Class words count as whole words and never on
    html, body, main and article. An element they name is kept if it holds articles outside any other
    article; these are taken when a page has no other article or main. A null or empty page has the text ''. Pages without a host in the
    url share the host ''. Repeated rows count as pages. Other columns are ignored.

    Templates are broadcast when a count proves them few; else each page's row is joined to the list
    of its own templates, found by a narrow join.
    """
    spark = pages.sparkSession
    rows = only(pages, page_id=id_col, url=url_col, html=html_col)
    with Scratch(spark) as scratch:
        found = scratch.table(site_templates(pages, url_col, html_col, min_pages, min_share), "templates")
        rows = rows.withColumn("host", _host(F.col("url")))
        few = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        if few:
            by_host: dict[str, set[int]] = {}
            for r in found.collect():
                by_host.setdefault(r.host, set()).add(r.subtree)
            shared = spark.sparkContext.broadcast(by_host)
            rows = rows.withColumn("templates", F.lit(None).cast("array<long>"))
        else:
            shared = spark.sparkContext.broadcast({})
            keyed = rows.withColumn("key", F.sha2(F.coalesce("html", F.lit("")), 256))
            each = keyed.select("host", "key", "html").dropDuplicates(["host", "key"])
            own = each.mapInArrow(_hash_rows, "host string, key string, subtree long").join(found, ["host", "subtree"])
            own = own.groupBy("host", "key").agg(F.collect_list("subtree").alias("templates")).checkpoint()  # read after this returns
            rows = keyed.join(own, ["host", "key"], "left").drop("key")

        def extract(batches):
            for batch in batches:
                texts = []
                for host, page, listed in zip(batch["host"].to_pylist(), batch["html"], batch["templates"].to_pylist(), strict=True):
                    texts.append(read_page(page.as_py() or "", shared.value.get(host, frozenset()) if listed is None else set(listed))[0])
                yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"])

        kind = rows.schema["page_id"].dataType.simpleString()
        texts = rows.select("page_id", "url", "host", "html", "templates").mapInArrow(extract, f"page_id {kind}, url string, text string")
        return texts.withColumn("n_chars", F.length("text").cast("long"))


def _hash_rows(batches):
    for batch in batches:
        out = [(h, k, x) for h, k, p in zip(batch["host"].to_pylist(), batch["key"].to_pylist(), batch["html"], strict=True) for x in read_page(p.as_py() or "")[1]]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["host", "key", "subtree"])
