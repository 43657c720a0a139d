"""Main text of web pages: page structure and a suffix array per host.

A page becomes blocks of text, each inside the article, inside page furniture
(menus, adverts, footers, forms, comments ...) or in neither. The token streams
of a host's pages are put together and their suffixes sorted by the first
``Settings.run`` tokens: equal neighbours from distinct pages are long repeated
substrings. A page with an article keeps the article's blocks whole, whatever other
pages show: furniture quotes headings and closing paragraphs, and two pages can show
one article. On a page without one, text that furniture shows anywhere on the host or
that differing pages of the host repeat is boilerplate, and the parts of blocks that
it covers are removed.

A host with many pages is cut into shards by the page's hash, so no task holds
more than about ``Settings.shard`` pages. Each shard sorts its suffixes and tells
what it saw of each run; that is put together per run over the whole host, and the
runs found go back to the shards that hold them. So shards do not change a text.
That is left out for a host where every page with text has an article: no run counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, prepare

#: Elements whose text is furniture, and words of class, id or role that say so. Fixed values.
FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select"}
FURNITURE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "disclaimer", "disqus", "footer", "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "pagination", "popup", "promo", "promoted", "related", "replies", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
    "subscribe", "toolbar", "widget", "alert", "contentinfo", "complementary", "search",
}
#: Elements without readable text. Fixed values.
RAW = "script|style|noscript|template|svg|iframe|title|textarea"
#: Elements that do not end a block. Fixed values.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
INLINE |= set("audio canvas iframe object param source svg track video math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts mpadded mphantom mstyle menclose mfenced merror maction semantics annotation annotation-xml".split())
#: Elements of a formula that hold its signs; a blank stands between two of them.
SIGNS = {"mi", "mn", "mo", "ms", "mtext", "annotation"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.S | re.I,
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW.split("|")}
#: Where a raw element without an end tag ends; elsewhere it is empty.
_OPEN_END = {
    "script": re.compile(r"(?=</head\b|<body\b|</body\b|</html\b)|\Z", re.I),
    "style": re.compile(r"(?=</head\b|<body\b|</body\b|</html\b)|\Z", re.I),
    "title": re.compile(r"(?=<)|\Z"),
}
#: A slash at the end of the attributes, but not of a value without quotes.
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z|(?:^|\s)[^\s\"'=]+/\Z")
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
OTHER, MAIN, SITE = 0, 1, 2


def _is_furniture(tag: str, attrs: str) -> bool:
    if tag in FURNITURE:
        return True
    if not attrs or tag in ("html", "head", "body", "article", "main"):
        return False
    if _HIDDEN.search(attrs):
        return True
    return any(not FURNITURE_WORDS.isdisjoint(re.split(r"[\s_-]+", "".join(m).lower())) for m in _NAMES.findall(attrs))


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(place, text) of the blocks of a page, in page order; white space is one blank."""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the place before them
    place = OTHER

    def close() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((place, text))
        parts.clear()

    at, html = 0, html or ""
    unclosed: set[str] = set()  # raw elements without an end tag from here on
    sign = False  # in this formula, one was seen
    while m := _TOKEN.search(html, at):
        if m.start() > at:
            parts.append(html[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in _RAW_END:
            if not m["end"] and not _SELF_CLOSED.search(m["attrs"]):
                end = None if tag in unclosed else _RAW_END[tag].search(html, at)
                if not end:
                    unclosed.add(tag)
                    end = _OPEN_END[tag].search(html, at) if tag in _OPEN_END else None
                at = end.end() if end else at
            continue
        if tag == "math":
            sign = False
        elif tag in SIGNS and not m["end"]:
            parts.append(" " if sign else "")
            sign = True
        if tag in VOID:
            if tag in INLINE:
                parts.append(" " if tag == "br" else "")
            else:
                close()
            continue
        if m["end"]:
            if tag not in INLINE:
                close()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close_place = stack[k][1]
                    if close_place != place:
                        close()
                    place = close_place
                    del stack[k:]
                    break
            continue
        if tag == "p" and stack and stack[-1][0] == "p":
            close()
            place = stack.pop()[1]
        new = place
        if tag in ("article", "main"):
            # comments are often articles of their own; an unclosed menu ends here
            shut = next((k for k, (t, _) in enumerate(stack) if t in ("nav", "header", "form")), None)
            if place == SITE and shut is not None and stack[shut][1] == OTHER:
                close()
                del stack[shut:]
                place = OTHER
            new = MAIN if place != SITE else SITE
        elif _is_furniture(tag, m["attrs"]):
            new = SITE
        elif re.search(r"role\s*=\s*[\"']?main\b", m["attrs"], re.I) and place != SITE:
            new = MAIN
        if tag not in INLINE or new != place:
            close()
        if not (m["attrs"] or "").endswith("/"):
            stack.append((tag, place))
            place = new
    parts.append(html[at:])
    close()
    return out


@dataclass(frozen=True)
class Settings:
    #: Tokens of a repeated substring.
    run: int = 8
    #: About so many pages of a host make one suffix array.
    shard: int = 500
    #: Hosts above that size that are sent to all tasks; more are joined by shuffle.
    broadcast_hosts: int = 100_000


def suffix_ranks(ids: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix by its first ``depth`` ids, by prefix doubling; equal ones rank alike."""
    rank, have = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while have < depth:
        step = min(have, depth - have)
        after = np.full(len(rank), -1, np.int64)
        after[: max(0, len(rank) - step)] = rank[step:]
        rank = np.unique(rank * (len(rank) + 2) + after + 1, return_inverse=True)[1].astype(np.int64)
        have += step
    return rank


#: What is seen of a run: on several pages, on differing pages, in furniture.
MANY, DIFFER, SHOWN = 1, 2, 4


class Stream:
    """The tokens of some pages of one host, with an end behind each block."""

    def __init__(self, pages: list[list[tuple[int, str]]], run: int) -> None:
        self.pages, self.run = pages, run
        self.articles = [any(place == MAIN for place, _ in p) for p in pages]
        self.number: dict[str, int] = {}
        ids: list[int] = []
        self.spans: list[tuple[int, int, int, int]] = []  # page, block, first token, place
        for k, page in enumerate(pages):
            for j, (place, text) in enumerate(page):
                self.spans.append((k, j, len(ids), place))
                ids += [self.number.setdefault(w, len(self.number)) for w in text.split()]
                ids.append(-len(self.spans))  # ends differ, so no substring crosses one
        self.ids = np.array(ids, np.int64)
        starts = np.array([s[2] for s in self.spans], np.int64)
        length = np.diff(np.append(starts, len(ids)))
        self.page_of, self.place_of = (np.repeat(np.array([s[c] for s in self.spans], np.int64), length) for c in (0, 3))
        self.free = np.repeat(np.array([not self.articles[s[0]] for s in self.spans], bool), length)
        #: Where a run begins that ends inside its block.
        self.whole = np.flatnonzero(np.arange(len(ids)) + run < np.repeat(starts + length, length))

    def evidence(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A place, the least digest of the pages and what is seen of each run; and the run at each of ``whole``."""
        rank = suffix_ranks(self.ids, self.run)[self.whole]
        _, first, kind = np.unique(rank, return_index=True, return_inverse=True)
        page, size = self.page_of[self.whole], len(first)
        low, high = np.full(size, len(self.pages)), np.full(size, -1)
        np.minimum.at(low, kind, page)
        np.maximum.at(high, kind, page)
        least, most = digests[page[first]], digests[page[first]]
        np.minimum.at(least, kind, digests[page])
        np.maximum.at(most, kind, digests[page])
        shown = np.bincount(kind, weights=self.place_of[self.whole] == SITE, minlength=size) > 0
        return self.whole[first], least, (MANY * (low < high) + DIFFER * (least < most) + SHOWN * shown).astype(np.uint8), kind

    def hashes(self) -> np.ndarray:
        """64 bits of the run at each of ``whole``, the same in every shard."""
        of_word = np.array([_hash64(w) for w in self.number], np.uint64)
        out = np.zeros(len(self.whole), np.uint64)
        for k in range(self.run):
            out = out * np.uint64(0x9E3779B97F4A7C15) + of_word[self.ids[self.whole + k]]
        return out

    def texts(self, seen: np.ndarray) -> list[str]:
        """The main text of each page, given what is seen of the run at each of ``whole``."""
        bad = self.free[self.whole] & ((seen & MANY) > 0) & ((seen & (SHOWN | DIFFER)) > 0) & (self.place_of[self.whole] != SITE)
        covered = np.zeros(len(self.ids) + 1, np.int64)
        at = self.whole[bad]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + self.run, -1)
        covered = np.cumsum(covered) > 0
        out: list[list[str]] = [[] for _ in self.pages]
        for k, j, start, place in self.spans:
            if place == SITE or (self.articles[k] and place != MAIN):
                continue
            words = self.pages[k][j][1].split(" ")
            gone = covered[start : start + len(words)]
            text = " ".join(w for w, g in zip(words, gone) if not g) if gone.any() else self.pages[k][j][1]
            if text:
                out[k].append(text)
        return ["\n".join(x) for x in out]


def _hash64(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def is_open(page: list[tuple[int, str]], run: int) -> bool:
    """Whether a run that other pages show can take text from this page."""
    return all(place != MAIN for place, _ in page) and any(place != SITE and len(text.split()) >= run for place, text in page)


def main_texts(pages: list[list[tuple[int, str]]], run: int) -> list[str]:
    """The main text of each page of one host."""
    stream = Stream(pages, run)
    if not len(stream.whole):
        return stream.texts(np.zeros(0, np.uint8))
    texts: dict[tuple, int] = {}
    _, _, seen, kind = stream.evidence(np.array([texts.setdefault(tuple(p), k) for k, p in enumerate(pages)]))
    return stream.texts(seen[kind])


def shard_evidence(pages: list[list[tuple[int, str]]], run: int, buckets: int) -> list[tuple[int, bytes, bytes, bytes]]:
    """(bucket, hashes, least digests, what is seen) of the runs of one shard, a row for each bucket of hashes."""
    stream = Stream(pages, run)
    if not len(stream.whole):
        return []
    places, least, seen, _ = stream.evidence(np.array([_hash64(repr(p)) for p in pages], np.uint64))
    runs = stream.hashes()[np.searchsorted(stream.whole, places)]
    bucket = (runs % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((runs, least, bucket))  # equal digests side by side compress well
    runs, least, seen, bucket = runs[order], least[order], seen[order], bucket[order]
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    return [(int(bucket[a]), runs[a:b].tobytes(), least[a:b].tobytes(), seen[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]


def merge_evidence(rows: list[tuple[bytes, bytes, bytes]]) -> list[tuple[bytes, bytes]]:
    """For each shard's row of one bucket: (hashes, what is seen on the host) of its runs that can be boilerplate."""
    runs, least, seen = (np.frombuffer(b"".join(r[c] for r in rows), t) for c, t in enumerate((np.uint64, np.uint64, np.uint8)))
    found, first, kind, times = np.unique(runs, return_index=True, return_inverse=True, return_counts=True)
    low, high, all_seen = least[first], least[first], np.zeros(len(found), np.uint8)
    np.minimum.at(low, kind, least)
    np.maximum.at(high, kind, least)
    np.bitwise_or.at(all_seen, kind, seen)
    all_seen |= (MANY * (times > 1) + DIFFER * (low < high)).astype(np.uint8)
    all_seen[((all_seen & MANY) == 0) | (all_seen == MANY)] = 0
    out, at = [], 0
    for r in rows:
        mine = kind[at : at + len(r[2])]
        at += len(r[2])
        mine = np.sort(mine[all_seen[mine] > 0])
        out.append((found[mine].tobytes(), all_seen[mine].tobytes()))
    return out


def shard_texts(pages: list[list[tuple[int, str]]], run: int, found: list[tuple[bytes, bytes]]) -> list[str]:
    """The main text of each page of a shard, given what ``merge_evidence`` found of its runs."""
    stream = Stream(pages, run)
    known, seen = (np.frombuffer(b"".join(f[c] for f in found), t) for c, t in enumerate((np.uint64, np.uint8)))
    if not len(stream.whole) or not len(known):
        return stream.texts(np.zeros(len(stream.whole), np.uint8))
    order = np.argsort(known)
    known, seen, runs = known[order], seen[order], stream.hashes()
    at = np.minimum(np.searchsorted(known, runs), len(known) - 1)
    return stream.texts(np.where(known[at] == runs, seen[at], 0).astype(np.uint8))


def extract(pages: DataFrame, settings: Settings = Settings(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) of every row of ``pages``.

    * Null or empty html, and a page without main text: empty text, no characters.
    * Null urls: their pages count as one host without a name.
    * Repeated rows: one result row each; equal pages are no evidence of boilerplate
      unless their furniture shows the text too.
    * An empty table gives no rows; other columns are not read.
    """
    prepare(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("place", pa.int32()), ("text", pa.string())]))
        for b in batches:
            found = [[{"place": p, "text": t} for p, t in blocks(h)] for h in b.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(found, kinds)], names=["host", "shard", "shards", "id", "url", "blocks"])

    def parsed(routed: DataFrame) -> DataFrame:
        routed = routed.select("host", "shard", "shards", "id", "url", "html")
        return routed.mapInArrow(parse, f"host string, shard bigint, shards bigint, id {kind}, url string, blocks array<struct<place:int,text:string>>")

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    sizes = rows.groupBy(host.alias("host")).agg(F.count("*").alias("n")).where(F.col("n") > settings.shard)
    sizes = materialize(sizes.select("host", F.ceil(F.col("n") / settings.shard).alias("shards")))
    large = sizes.count()
    small = large <= settings.broadcast_hosts

    def open_hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {x for x, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if is_open(blocks(h), settings.run)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], names=["host"])

    rows = rows.withColumn("host", host)
    if large:
        asked = rows.join(F.broadcast(sizes) if small else sizes, "host").select("host", "html").mapInArrow(open_hosts, "host string").distinct()
        sizes = materialize(sizes.join(asked.withColumn("open", F.lit(True)), "host", "left"))
        large = sizes.where("open").count()
    else:
        sizes = sizes.withColumn("open", F.lit(False))
    routed = rows.join(F.broadcast(sizes) if small else sizes, "host", "left")
    routed = routed.withColumn("shard", F.pmod(F.xxhash64("id", "url"), F.coalesce("shards", F.lit(1)))).withColumn("open", F.coalesce("open", F.lit(False)))

    def read(part: pa.Table) -> tuple[pa.Table, list[list[tuple[int, str]]]]:
        part = part.sort_by([("id", "ascending"), ("url", "ascending")])
        return part, [[(x["place"], x["text"]) for x in p] for p in part.column("blocks").to_pylist()]

    def result(part: pa.Table, texts: list[str]) -> pa.Table:
        return pa.table(
            {id_col: part.column("id"), url_col: part.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}
        )

    def clean(part: pa.Table) -> pa.Table:
        part, found = read(part)
        return result(part, main_texts(found, settings.run))

    schema = f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars bigint"
    whole = parsed(routed.where("not open"))
    if not small:  # else the join's shuffle by host alone would serve for the groups too
        whole = whole.repartition("host", "shard")
    whole = whole.groupBy("host", "shard").applyInArrow(clean, schema)
    if not large:
        return whole

    def tell(part: pa.Table) -> pa.Table:
        host, shard, shards = (part.column(c)[0].as_py() for c in ("host", "shard", "shards"))
        told = list(zip(*shard_evidence(read(part)[1], settings.run, shards))) or [()] * 4
        n = len(told[0])
        columns = [pa.array([host] * n, pa.string()), pa.array([shard] * n, pa.int64()), pa.array(told[0], pa.int64())]
        return pa.table([*columns, *(pa.array(x, pa.binary()) for x in told[1:])], names=["host", "shard", "bucket", "runs", "least", "seen"])

    def merge(part: pa.Table) -> pa.Table:
        found = merge_evidence(list(zip(*(part.column(c).to_pylist() for c in ("runs", "least", "seen")))))
        runs, seen = (pa.array([f[c] for f in found], pa.binary()) for c in (0, 1))
        return pa.table([part.column("host"), part.column("shard"), runs, seen], names=["host", "shard", "runs", "seen"])

    def clean_shard(part: pa.Table, told: pa.Table) -> pa.Table:
        part, found = read(part)
        return result(part, shard_texts(found, settings.run, list(zip(*(told.column(c).to_pylist() for c in ("runs", "seen"))))))

    # the shuffle of the parsed pages serves both
    dealt = parsed(routed.where("open")).repartition("host", "shard")
    told = dealt.groupBy("host", "shard").applyInArrow(tell, "host string, shard bigint, bucket bigint, runs binary, least binary, seen binary")
    found = told.groupBy("host", "bucket").applyInArrow(merge, "host string, shard bigint, runs binary, seen binary")
    cut = dealt.groupBy("host", "shard").cogroup(found.groupBy("host", "shard")).applyInArrow(clean_shard, schema)
    return whole.unionByName(cut)
