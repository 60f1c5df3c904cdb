"""Main text of web pages: site templates found by recurring subtrees, page furniture by its markup."""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkline.session import stage_table

LEAST_PAGES = 10
SHARE = 0.5
#: Fixed values of the markup language and of customary names, in natural order.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their end tag, and elements that show no text of the page.
RAW = frozenset("iframe script style textarea title".split())
SILENT = RAW | frozenset("button canvas datalist noscript object select template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr "
    "ul".split())
CELLS = frozenset(("td", "th", "br"))
#: Elements that templates are made of; other inline elements go with the block they are in.
COUNTED = (BLOCKS | frozenset(("a", "span"))) - frozenset("article body head html main".split())
FURNITURE = frozenset("nav aside footer form menu dialog head".split())
#: Never part of the main text, whatever they hold.
INLINE = frozenset(("svg", "annotation", "annotation-xml")) | SILENT
NEVER = FURNITURE - {"form"} | INLINE
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner billboard breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies disclaimer discussion disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion "
    "related respond replies search share sharing sidebar signup skyscraper social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split())
PAGE_ONLY = frozenset("header head masthead".split())
#: Names that are furniture as a whole class only, and words that may stand beside a name in a compound class.
WHOLE = frozenset("hidden responses reviews".split())
BESIDE = frozenset(
    "area bar block box button buttons container content form icons inner item items link links list post posts section "
    "signup title wrap wrapper".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>", re.S | re.I)
_CLOSES = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_PART = re.compile(r"[^a-z0-9]+")
_ABOUT = re.compile(r"(?:no|not|has|with|without)[-_]")


def tokens(page: str) -> Iterator[re.Match]:
    """Tags and comments in page order. A raw element is passed over up to its end tag; one that has none is an
    ordinary element, which ends with its parent."""
    at, open_ended = 0, set()
    while token := _TOKEN.search(page, at):
        yield token
        at, tag = token.end(), (token["tag"] or "").lower()
        if tag in RAW and not token["end"] and tag not in open_ended:
            close = _CLOSES[tag].search(page, at)
            if close:
                at = close.start()
            else:
                open_ended.add(tag)


def _is_name(word: str, in_article: bool) -> bool:
    """Whether a class or id names furniture: by any part of it, but inside an article by all of them."""
    if _ABOUT.match(word):
        return False
    parts = {p for p in _PART.split(word) if p}
    if in_article:
        return word in WHOLE or bool(parts & NAMES) and parts <= NAMES | BESIDE
    return word in WHOLE or bool(parts & (NAMES | PAGE_ONLY))


def is_furniture(tag: str, rest: str, in_article: bool) -> bool:
    """Whether an element is no part of the main text, by its tag, role, class, id or being hidden."""
    if tag in FURNITURE or tag == "header" and not in_article:
        return True
    if tag in ("body", "html", "main", "article") or not rest:
        return False
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            if any(_is_name(word, in_article) for word in value.split()):
                return True
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def is_wrapper(tag: str, rest: str) -> bool:
    """Whether furniture may hold the page's article: forms, and elements that only a class or id tells."""
    plain = _ATTRIBUTE.sub(lambda m: "" if m[1].lower() in ("class", "id") else m[0], rest)
    return tag not in NEVER and (tag == "form" or not is_furniture(tag, plain, True))


def blocks(page: str) -> list[tuple[str, str]]:
    """The text blocks of a page's main part in page order, as (tag, text).

    The main part is what lies in article elements, else in main elements, else anywhere; furniture and what
    is below it is left out. Unclosed elements end with their parents, a new block ends an open paragraph.

    If no article or main lies outside furniture, wrappers (a form, or an element whose class or id looks like
    furniture) are kept that hold the page's main, or an article longer than all text outside furniture.
    """
    found, level, wrappers = _walk(page, frozenset())
    if wrappers and not level:
        spared, _, _ = _walk(page, frozenset(wrappers))
        sizes: dict[int, int] = {}
        chains: dict[int, tuple[tuple[int, ...], bool]] = {}
        for _, _, text, chain, item, main in spared:
            if item >= 0 and chain:
                sizes[item] = sizes.get(item, 0) + len(text)
                known = chains.get(item, (chain, main))
                chains[item] = min(known[0], chain, key=len), main or known[1]
        outside = sum(len(b[2]) for b in found)
        fit = [i for i in sizes if chains[i][1] or sizes[i] > outside]
        if fit:
            best = max(fit, key=lambda i: (chains[i][1], -len(chains[i][0]), sizes[i]))
            chain = set(chains[best][0])
            found = [b for b in spared if chain.issuperset(b[3])]
            level = max(b[0] for b in found)
    return [(tag, text) for where, tag, text, *_ in found if where >= level]


def _walk(page: str, spare: frozenset[int]) -> tuple[list[tuple], int, set[int]]:
    """One pass over a page, in which furniture that opens at places in ``spare`` is kept.

    Gives the blocks (2 in an article or 1 in a main, tag, text, spared elements around it, place of the outermost
    article or main, whether that is a main), the highest level opened, and the wrappers that hold an article or main.
    """
    stack: list[tuple[str, bool, bool, bool]] = []
    found: list[tuple] = []
    words: list[str] = []
    chain: list[int] = []
    closed: list[int] = []
    wrappers: set[int] = set()
    dropped = articles = mains = firm = 0
    level = at = svg = 0
    item, item_main = -1, False
    block = "body"

    def flush() -> None:
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                found.append((2 if articles else 1 if mains else 0, block, text, tuple(chain), item, item_main))
            words.clear()

    def pop() -> None:
        nonlocal dropped, articles, mains, firm, item, svg
        name, drop, wrapper, kept = stack.pop()
        dropped -= drop
        firm -= drop and not wrapper
        if kept:
            chain.pop()
        elif drop and wrapper:
            closed.pop()
        articles -= name == "article"
        mains -= name == "main"
        svg -= name == "svg"
        if not articles and not mains:
            item = -1

    for token in tokens(page):
        if not dropped and token.start() > at:
            words.append(page[at:token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if token["end"]:
            if tag in BLOCKS:
                flush()
            elif tag in CELLS:
                words.append(" ")
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    while len(stack) > depth:
                        pop()
                    break
            continue
        if tag in BLOCKS:
            flush()
            block = tag
            while svg:  # a block ends an svg that was never closed
                inside = next(d for d in range(len(stack) - 1, -1, -1) if stack[d][0] in ("svg", "foreignobject"))
                if stack[inside][0] != "svg":
                    break
                while len(stack) > inside:
                    pop()
            for depth in range(len(stack) - 1, -1, -1):
                name = stack[depth][0]
                if name == "p" or name == tag == "li":
                    while len(stack) > depth:
                        pop()
                    break
                if name in BLOCKS:
                    break
        elif tag in CELLS and not dropped:
            words.append(" ")
        if tag in VOID or token["rest"].endswith("/"):
            continue
        furniture = tag in INLINE or is_furniture(tag, token["rest"], articles > 0 or mains > 0)
        kept = furniture and token.start() in spare
        drop = furniture and not kept
        wrapper = drop and is_wrapper(tag, token["rest"])
        if furniture and not dropped and tag not in INLINE:
            flush()
        stack.append((tag, drop, wrapper, kept))
        dropped += drop
        firm += drop and not wrapper
        svg += tag == "svg"
        if kept:
            chain.append(token.start())
        elif wrapper:
            closed.append(token.start())
        if tag in ("article", "main"):
            if item < 0:
                item, item_main = token.start(), tag == "main"
            if not firm:
                wrappers.update(closed)
        articles += tag == "article"
        mains += tag == "main"
        if not dropped:
            level = max(level, 2 if tag == "article" else 1 if tag == "main" else 0)
    if not dropped and at < len(page):
        words.append(page[at:])
    flush()
    return found, level, wrappers


def _digest(*parts: str | bytes) -> bytes:
    own = hashlib.blake2b(digest_size=8)
    for part in parts:
        own.update(part if isinstance(part, bytes) else part.encode("utf-8", "surrogatepass"))
        own.update(b"\0")
    return own.digest()


def subtrees(page: str) -> list[tuple[int, int, int]]:
    """Every element that holds text as (start, end, hash), before anything is judged.

    The hash covers the tag, its attributes, and texts and children in order, blanks aside. Void elements belong to
    their parents' texts; a block ends an open paragraph, and any other element that is not closed ends where its
    parent does.
    """
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[str, str, int, list[bytes], list[bool]]] = [("", "", 0, [], [False])]

    def text(low: int, high: int) -> None:
        value = " ".join(page[low:high].split())
        if value:
            stack[-1][3].append(value.encode("utf-8", "surrogatepass"))
            stack[-1][4][0] = True

    def pop(end: int) -> None:
        tag, rest, start, parts, filled = stack.pop()
        digest = _digest(tag, rest, *parts)
        stack[-1][3].append(digest)
        stack[-1][4][0] |= filled[0]
        if filled[0] and tag in COUNTED:
            found.append((start, end, int.from_bytes(digest, "little", signed=True)))

    at = 0
    for token in tokens(page):
        text(at, token.start())
        at, tag = token.end(), (token["tag"] or "").lower()
        if not tag:
            continue
        rest = " ".join(token["rest"].split())
        if not token["end"]:
            if tag in BLOCKS:
                inner = next((d for d in range(len(stack) - 1, 0, -1) if stack[d][0] in BLOCKS), 0)
                if inner and (stack[inner][0] == "p" or stack[inner][0] == tag == "li"):
                    while len(stack) > inner:
                        pop(token.start())
            if tag in VOID or rest.endswith("/"):
                stack[-1][3].append(_digest(tag, rest))
            else:
                stack.append((tag, rest, token.start(), [], [False]))
        elif any(entry[0] == tag for entry in stack):
            while stack[-1][0] != tag:
                pop(token.start())
            pop(at)
    text(at, len(page))
    while len(stack) > 1:
        pop(len(page))
    return found


def without_template(page: str, gone: set[int]) -> str:
    """The page without the elements whose hashes are ``gone``."""
    left, at = [], 0
    for start, end, name in sorted(subtrees(page)):
        if name in gone and start >= at:
            left.append(page[at:start])
            at = end
    return "".join([*left, page[at:]])


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the elements of each page, and one of all of them for telling pages apart, for each of its sites."""
    for batch in batches:
        names, pages, own = [], [], []
        for sites, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            hashes = sorted({h for _, _, h in subtrees(page.as_py() or "")})
            if hashes:
                whole = int.from_bytes(_digest(",".join(map(str, hashes))), "little", signed=True)
                names += sites
                own += [hashes] * len(sites)
                pages += [whole] * len(sites)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(pages, pa.int64()), pa.array(own, pa.list_(pa.int64()))],
            names=["site", "page", "subtrees"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            part = batch.slice(low, 512)
            texts = []
            for page, gone in zip(part.column(2), part.column(3).to_pylist(), strict=True):
                page = page.as_py() or ""
                kept = blocks(without_template(page, set(gone)) if gone else page)
                texts.append("\n".join(text for _, text in kept))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def host_of(url: Column) -> Column:
    """The host of an address, lower-case; null if it has none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.when(host != "", host)


def section_of(url: Column) -> Column:
    """The first folder of an address's path, after its host; null if the page lies in none."""
    folder = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)/", 1)
    return F.when(folder != "", F.concat(host_of(url), F.lit("/"), folder))


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """The main text of each page (page_id, url, html): (page_id, url, text, n_chars), one row each.

    A site is a host, and each first folder of its paths. Every element subtree is hashed with its tag, attributes and
    children, before anything is judged, and counted per site over pages that differ in their elements; those on at least
    ``least_pages`` such pages and on more than ``share`` of the site's are its template and are deleted from the
    pages. So the notice of a section goes though it is on few of a host's pages. Copies of a page count
    once, so an article that was copied isn't taken for a template. What is left of a page is split into blocks;
    furniture that differs from page to page is told by tag, role, class and id. Blocks are joined by a line
    feed, white space in a block becomes one blank, character references are decoded.

    Counts are pre-aggregated, so a host of any size is fine; at most a few subtrees per site can recur on half
    of its pages, and only these are joined to the pages. Null and empty pages have empty text; pages without
    host form a group; repeated rows are extracted each and alike. An empty table gives an empty result; other
    columns are ignored.
    """
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html")).withColumns({
            "host": F.coalesce(host_of(F.col("url")), F.lit("")), "section": section_of(F.col("url"))})
    seen = stage_table(base.select(F.array_compact(F.array("host", "section")), "html").mapInArrow(
        _subtrees, "site string, page long, subtrees array<long>").distinct(), "subtrees")
    sizes = seen.groupBy("site").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages)
    counts = (
        seen.select("site", F.explode("subtrees").alias("subtree")).groupBy("site", "subtree")
        .agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages))
    template = stage_table(
        counts.join(sizes, "site").filter(F.col("n") > share * F.col("pages"))
        .groupBy("site").agg(F.collect_list("subtree").alias("gone")), "templates")
    of_host = template.select(F.col("site").alias("host"), F.col("gone").alias("everywhere"))
    of_section = template.select(F.col("site").alias("section"), F.col("gone").alias("here"))
    none = F.array().cast("array<bigint>")
    return (
        base.join(of_host, "host", "left").join(of_section, "section", "left")
        .select("page_id", "url", "html", F.array_union(
            F.coalesce("everywhere", none), F.coalesce("here", none)).alias("gone"))
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
