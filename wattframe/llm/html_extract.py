"""Main text of web pages by markup zones and a suffix array of each host.

A page's scan follows HTML's rules for open elements (optional end tags, elements that end with their parent, stray end
tags) and gives blocks of text, each in a zone: MAIN (the longest article or main), SIDE (other articles beside it),
CHROME (menus, headers, footers, sidebars, notices, adverts, forms, comments) or OPEN (anything else). Scripts, styles
and markup give none.

The pages of a host, in shards of bounded size, are one token stream with page numbers. Its suffixes are sorted
to a depth of REPEAT tokens by prefix doubling; neighbours of equal rank are a substring of REPEAT tokens that repeats,
and where it does so on distinct pages its tokens count as covered. Of side and, on pages without an article, of open blocks the
covered runs go and the unique runs stay: a teaser whose text stands on its own page too is boilerplate, a second part of
an article is not. The article that the markup names is main text however often its passages repeat (pages quote and share
passages), so it loses nothing, and on such a page open blocks are not main text. Chrome blocks always go, but they stand in the
stream, so that a menu without markup on one page is recognised by its marked twin on another. Pages with the same
stream count as one page. On a host of one page nothing repeats, so all its open text stays.

Repeats count over the whole host, whatever its shards. Where a host has several shards and a page that can lose text
(open blocks without an article, or side blocks), each shard's distinct substrings of REPEAT tokens are hashed, with
the least and largest stream that holds each. An aggregate with partial sums finds the hashes of two streams or more,
and these go back to the shards whose own such pages hold them.

Null html gives an empty text, a null or malformed url belongs to the host "". Very long pages are a shard of their own
and are never cut. Every row gives one row; repeated rows and ids give a row each. Extra columns are not read.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import as_int64, factors, hash_words, map_batches, mix, settle, text_steps, words_of

#: Tokens of the shortest repeat that counts; a power of two for the doubling.
REPEAT = 16
#: Characters of html in one shard of a host.
SHARD_CHARS = 250_000
#: Most hosts of several shards that are broadcast (name and number, some 50 bytes each).
MOST_LARGE_HOSTS = 500_000

MAIN, SIDE, CHROME, OPEN = "m", "s", "c", "o"

_PLACE = np.random.default_rng(16).integers(0, 2**63, REPEAT, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Fixed names of the HTML standard and usual class names.
SILENT = {"script", "style", "template", "svg", "iframe", "object", "canvas", "select", "textarea", "title"}
CHROME_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
MAIN_TAGS = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
BOXES = {"aside", "dd", "div", "dl", "li", "ol", "p", "section", "span", "table", "td", "ul", "article"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Optional end tags of the HTML standard: what ends an open paragraph and where that search stops, what an item or a part of a table ends.
ENDS_P = BLOCK - {"body", "caption", "head", "html", "legend", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
P_SCOPE = {"button", "caption", "table", "td", "th"}
ITEMS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}
_BODIES = {"tbody", "thead", "tfoot"}
TABLE_PARTS = {"td": {"tr", *_BODIES, "table"}, "th": {"tr", *_BODIES, "table"}, "tr": {*_BODIES, "table"}} | dict.fromkeys([*_BODIES, "caption"], {"table"})
TABLE_ENDS = {*TABLE_PARTS, "table"}
#: Whole class, id and role names; a name that only contains one of them says nothing.
CHROME_NAMES = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "related", "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "widget"}
#: Names of two parts, made by rule: a place and a kind, or a kind and a form.
PLACES, PLACED = ["site", "page", "main", "top", "bottom", "left", "right", "global"], ["nav", "navigation", "navbar", "menu", "header", "footer", "sidebar"]
KINDS, FORMS = ["ad", "advert", "cookie", "consent", "newsletter", "share", "social", "related", "comment", "comments", "sponsored", "promo"], ["banner", "bar", "box", "list", "links", "area", "section", "form", "signup", "posts", "buttons", "slot", "container", "notice", "widget", "thread"]
CHROME_NAMES |= {f"{a}-{b}" for many, more in ((PLACES, PLACED), (KINDS, FORMS)) for a in many for b in more}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'">]++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.DOTALL)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true)|display\s*:\s*none""", re.IGNORECASE)


def _is_chrome(tag: str, attributes: str) -> bool:
    if tag in CHROME_TAGS:
        return True
    if tag not in BOXES or not attributes.strip():
        return False
    return bool(HIDDEN.search(attributes)) or any(CHROME_NAMES.intersection((m[0] or m[1] or m[2]).lower().replace("_", "-").split()) for m in NAMED.findall(attributes))


class Element:
    """An element of the tree: its name, whether it is chrome by itself, and whether its own end tag closed it."""

    __slots__ = ("chrome", "closed", "name", "wraps")

    def __init__(self, name: str, chrome: bool) -> None:
        self.name, self.chrome, self.closed, self.wraps = name, chrome, False, False


def _implied(stack: list[Element], opened: Counter, name: str) -> int:
    """How many elements stay open when `name` starts: the optional end tags of HTML."""
    keep = len(stack)
    if name in ENDS_P:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name == "p":
                keep = k
                break
            if stack[k].name in P_SCOPE or stack[k].name in BLOCK:
                break
    if name in ITEMS:
        same = ITEMS[name]
        for k in range(keep - 1, -1, -1):
            if stack[k].name in same:
                return k
            if stack[k].name in BLOCK and stack[k].name not in ("address", "div", "p"):
                break
    elif name in TABLE_PARTS and opened["table"]:
        stop = TABLE_PARTS[name]
        for k in range(keep - 1, -1, -1):
            if stack[k].name in stop:
                return k + 1
    elif name in HEADINGS and keep and stack[keep - 1].name in HEADINGS:
        return keep - 1
    return keep


def _ended(stack: list[Element], opened: Counter, name: str) -> int:
    """The place of the open element that the end tag of `name` closes, or -1: end tags don't reach out of a table cell or a block."""
    if not opened[name] and name not in HEADINGS:
        return -1
    for k in range(len(stack) - 1, -1, -1):
        here = stack[k].name
        if here == name or (name in HEADINGS and here in HEADINGS):
            return k
        if (here in ("td", "th", "caption", "table") and name not in TABLE_ENDS) or (here in BLOCK and name not in BLOCK):
            return -1
    return -1


def _events(page: str) -> list[tuple[str, str | Element | None]]:
    """The page as a stream: ("text", string), ("open", element), ("close", element), ("break", None).

    Only elements that can be blocks, chrome or main text are tracked. Every element that opens closes: by its end tag, by
    another tag that implies its end, with its parent, or at the end of the page.
    """
    out: list[tuple[str, str | Element | None]] = []
    stack: list[Element] = []
    #: How many elements of each name are open.
    opened: Counter = Counter()
    #: Of each article or main: the chrome elements around it.
    around: list[list[Element]] = []
    at, end = 0, len(page)

    def cut(keep: int) -> None:
        while len(stack) > keep:
            shut(len(stack) - 1)

    def shut(k: int) -> None:
        opened[stack[k].name] -= 1
        out.append(("close", stack.pop(k)))

    while at < end:
        m = TAG.search(page, at)
        if m is None:
            out.append(("text", page[at:]))
            break
        if m.start() > at:
            out.append(("text", page[at : m.start()]))
        at = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in SILENT:
            if not closing and not attributes.endswith("/"):
                stop = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else end
        elif name in VOID:
            if name == "hr":
                cut(_implied(stack, opened, name))
                out.append(("break", None))
            elif name == "br":
                out.append(("text", " "))
        elif closing:
            k = _ended(stack, opened, name)
            if k >= 0:
                stack[k].closed = True
                if name == "form":  # a form ends by itself: what it opened stays open
                    shut(k)
                else:
                    cut(k)
            elif name in BLOCK:
                out.append(("break", None))
        elif name in BLOCK or name in CHROME_TAGS or name in BOXES:
            if name == "form" and opened[name]:
                continue
            cut(_implied(stack, opened, name))
            element = Element(name, _is_chrome(name, attributes))
            if name in MAIN_TAGS:
                around.append([e for e in stack if e.chrome])
            stack.append(element)
            opened[name] += 1
            out.append(("open", element))
    cut(0)
    for chrome in around:  # a form around main text is the page's frame
        if all(e.name == "form" or not e.closed for e in chrome):
            for e in chrome:
                e.wraps |= e.name == "form"
    return out


def blocks_of(page: str | None) -> list[tuple[str, str]]:
    """(zone, text) of each block that has text, in page order; white space inside is one space.

    Chrome ends where its element ends by the rules of HTML. A form around an article or main is no chrome. Chrome that
    no end tag closes ends where the page's first article or main begins.
    """
    if not page:
        return []
    out: list[tuple[str, str]] = []
    here: list[str] = []
    #: The article (by number) of each block in one.
    regions: list[int] = []
    chrome: list[Element] = []
    main: list[Element] = []
    region = 0

    def flush() -> None:
        text = "".join(here)
        here.clear()
        text = " ".join((entities.unescape(text) if "&" in text else text).split())
        if text:
            out.append((CHROME if chrome else MAIN if main else OPEN, text))
            regions.append(region if main and not chrome else 0)

    for kind, e in _events(page):
        if kind == "text":
            here.append(e)
            continue
        if kind == "break":
            flush()
            continue
        if e.name in BLOCK or e.chrome:
            flush()
        if kind == "open":
            if e.name in MAIN_TAGS and chrome and not region and not any(c.closed for c in chrome):
                chrome.clear()
            if e.chrome and not e.wraps:
                chrome.append(e)
            elif e.name in MAIN_TAGS and not chrome:
                region += not main
                main.append(e)
        elif e in chrome:
            chrome.remove(e)
        elif e in main:
            main.remove(e)
    flush()
    if region > 1:
        sizes: dict[int, int] = {}
        for n, (_, text) in zip(regions, out, strict=True):
            if n:
                sizes[n] = sizes.get(n, 0) + len(text)
        longest = max(sizes, key=lambda n: (sizes[n], -n), default=0)
        out = [(SIDE if n and n != longest else zone, text) for n, (zone, text) in zip(regions, out, strict=True)]
    return out


def covered(tokens: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Tokens that lie in a substring of REPEAT tokens which also stands on another page; substrings stay inside a page."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while width < REPEAT:
        key = rank * (rank.max() + 1)
        key[:-width] += np.where(page[width:] == page[:-width], rank[width:], 0)
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
        width *= 2
    order = np.argsort(rank, kind="stable")  # the suffix array to that depth
    whole = np.zeros(n, dtype=bool)
    whole[: n - REPEAT + 1] = page[REPEAT - 1 :] == page[: n - REPEAT + 1]
    order = order[whole[order]]
    same = rank[order][1:] == rank[order][:-1]
    other = page[order][1:] != page[order][:-1]
    group = np.r_[0, np.cumsum(~same)] if len(order) else np.zeros(0, np.int64)
    spread = np.bincount(group[1:], weights=same & other, minlength=int(group.max(initial=-1)) + 1) > 0
    found = order[spread[group]]
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, np.minimum(found + REPEAT, n), -1)
    return np.cumsum(cover)[:-1] > 0


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, joined, and the number of words of each."""
    plain = np.ones(256, dtype=bool)
    plain[32] = False
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, data, offsets in text_steps(pa.array(texts, pa.large_string())):
        starts, ends, many = words_of(data, offsets, plain)
        hashes.append(hash_words(data, starts, ends))
        counts.append(many)
    return np.concatenate(hashes), np.concatenate(counts)


def is_loose(blocks: list[tuple[str, str]]) -> bool:
    """Whether repeats can take text from a page: it has side blocks, or open ones and no named main text."""
    zones = {zone for zone, _ in blocks}
    return SIDE in zones or (OPEN in zones and MAIN not in zones)


def _windows(hashes: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First tokens and hashes of all substrings of REPEAT tokens inside pages of `many` tokens."""
    page = np.repeat(np.arange(len(many)), many)
    at = np.flatnonzero(page[REPEAT - 1 :] == page[: len(page) - REPEAT + 1]) if len(page) >= REPEAT else np.zeros(0, np.int64)
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(REPEAT):
        out += hashes[at + k] * _PLACE[k]
    return at, mix(out)


def substrings(pages: list[list[tuple[str, str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of the pages' substrings, sorted, with the least and the largest stream that holds each."""
    hashes, counts = _tokens([text for page in pages for _, text in page])
    total = np.r_[0, np.cumsum(counts)]
    many = np.diff(total[np.r_[0, np.cumsum([len(p) for p in pages])].astype(np.int64)])
    at, found = _windows(hashes, many)
    begin = np.cumsum(many) - many
    codes = mix(hashes) * factors(int(many.max(initial=0)) + 1)[np.arange(len(hashes)) - np.repeat(begin, many)]
    stream = np.zeros(len(many), dtype=np.uint64)
    stream[many > 0] = mix(np.add.reduceat(codes, begin[many > 0]) + many[many > 0].astype(np.uint64)) if len(codes) else 0
    stream = as_int64(stream)[np.repeat(np.arange(len(many)), many)[at]]
    order = np.lexsort((stream, found))
    found, stream = found[order], stream[order]
    new = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, np.int64)
    return found[new], stream[new], stream[np.r_[new[1:], len(found)].astype(np.int64) - 1] if len(found) else stream


def extract_shard(pages: list[list[tuple[str, str]]], repeats: np.ndarray | None = None) -> list[str]:
    """Texts of the pages of one host shard; repeats: hashes of substrings that repeat in the host."""
    flat = [text for page in pages for _, text in page]
    hashes, counts = _tokens(flat)
    in_page = np.array([len(p) for p in pages], dtype=np.int64)
    last = np.cumsum(in_page)
    total = np.r_[0, np.cumsum(counts)]
    page_at = total[np.r_[0, last]]
    # Pages of one stream are one page: copies are no evidence.
    number, seen = np.zeros(len(pages), np.int64), {}
    skip = np.zeros(len(pages), dtype=bool)
    for i in range(len(pages)):
        number[i] = seen.setdefault(hashes[page_at[i] : page_at[i + 1]].tobytes(), i)
        skip[i] = number[i] != i
    page = np.repeat(number, np.diff(page_at))
    use = ~np.repeat(skip, np.diff(page_at))
    hit = np.zeros(len(hashes), dtype=bool)
    if use.sum() >= 2 * REPEAT:
        hit[use] = covered(mix(hashes[use]), page[use])
    for i in np.flatnonzero(skip):
        hit[page_at[i] : page_at[i + 1]] = hit[page_at[number[i]] : page_at[number[i] + 1]]
    if repeats is not None and len(repeats):
        at, found = _windows(hashes, np.diff(page_at))
        at = at[np.isin(found, repeats)]
        cover = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + REPEAT, -1)
        hit |= np.cumsum(cover)[:-1] > 0
    out, block = [], 0
    for blocks in pages:
        marked = any(zone == MAIN for zone, _ in blocks)
        kept = []
        for zone, text in blocks:
            if zone == MAIN and marked:
                kept.append(text)
            elif zone == SIDE or (zone == OPEN and not marked):
                gone = hit[total[block] : total[block + 1]]
                if gone.any():
                    text = " ".join(w for w, g in zip(text.split(" "), gone, strict=True) if not g)
                if text:
                    kept.append(text)
            block += 1
        out.append("\n".join(kept))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id_col, url_col, text, n_chars for each row of pages."""
    host = F.coalesce(F.regexp_extract(F.lower(url_col), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    rows = rows.withColumn("size", F.coalesce(F.length("html"), F.lit(0)).cast("long"))
    kind = pages.schema[id_col].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            loose = pa.array([is_loose(blocks_of(page.as_py())) for page in batch.column(2)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), loose], names=["host", "size", "loose"])

    seen = map_batches(rows.select("host", "size", "html"), look, "host string, size long, loose boolean")
    large = settle(seen.groupBy("host").agg(F.ceil(F.sum("size") / SHARD_CHARS).alias("shards"), F.max("loose").alias("loose")).filter("shards > 1"), "hosts")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [zlib.compress("\0".join(zone + text.replace("\0", "�") for zone, text in blocks_of(page.as_py())).encode("utf-8", "replace"), 1) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(packed, pa.binary())], names=["id", "url", "host", "blocks"])

    # Joined by a shuffle, pages would already lie by host, a large one's in one task: then they are dealt out anew.
    few = large.count() <= MOST_LARGE_HOSTS
    hosts = F.broadcast(large) if few else large

    def deal(rows: DataFrame) -> DataFrame:
        scanned = map_batches(rows.select("id", "url", "html", "host"), scan, f"id {kind}, url string, host string, blocks binary")
        dealt = scanned.join(hosts.select("host", "shards"), "host", "left").withColumn("shard", F.pmod(F.xxhash64("id", "blocks"), F.coalesce("shards", F.lit(1))))
        return dealt.select("id", "url", "blocks", "host", "shard")

    def unpack(packed: list[bytes]) -> list[list[tuple[str, str]]]:
        return [[(b[0], b[1:]) for b in zlib.decompress(x).decode("utf-8").split("\0") if b] for x in packed]

    def texts_of(pages: pa.Table, repeats: np.ndarray | None) -> pa.Table:
        texts = extract_shard(unpack(pages["blocks"].to_pylist()), repeats)
        return pa.table({"id": pages["id"], "url": pages["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    def shard(key: tuple, pages: pa.Table) -> pa.Table:
        return texts_of(pages, None)

    def shard_of_host(pages: pa.Table, repeats: pa.Table) -> pa.Table:
        return texts_of(pages, repeats["hash"].to_numpy().view(np.uint64))

    def evidence(loose_only: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                groups: dict[tuple, list[list[tuple[str, str]]]] = {}
                for host, shard, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), unpack(batch.column(2).to_pylist()), strict=True):
                    if not loose_only or is_loose(blocks):
                        groups.setdefault((host, shard), []).append(blocks)
                for (host, shard), held in groups.items():
                    found, low, high = substrings(held)
                    n = len(found)
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(host, pa.string()), n), pa.repeat(pa.scalar(shard, pa.int64()), n), pa.array(as_int64(found)), pa.array(low), pa.array(high)], names=["host", "shard", "hash", "low", "high"])

        return run

    def texts(dealt: DataFrame, repeats: DataFrame | None) -> DataFrame:
        dealt = dealt if few else dealt.repartition("host", "shard")
        schema = f"id {kind}, url string, text string, n_chars long"
        if repeats is None:
            return dealt.groupBy("host", "shard").applyInArrow(shard, schema)
        return dealt.groupBy("host", "shard").cogroup(repeats.groupBy("host", "shard")).applyInArrow(shard_of_host, schema)

    if large.filter("loose").isEmpty():
        out = texts(deal(rows), None)
    else:
        spread = deal(rows.join(hosts.filter("loose"), "host", "left_semi")).select("host", "shard", "blocks")
        schema = "host string, shard long, hash long, low long, high long"
        both = map_batches(spread, evidence(False), schema).groupBy("host", "hash").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        repeating = settle(both.filter("low < high").select("host", "hash"), "repeating")
        own = map_batches(spread, evidence(True), schema).select("host", "shard", "hash")
        repeats = settle(own.join(repeating, ["host", "hash"], "left_semi").distinct(), "repeats")
        out = texts(deal(rows), repeats)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
