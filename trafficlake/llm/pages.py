"""Main text of web pages by tags and by repeats over each host's pages.

A page is cut into blocks at block elements, outside scripts, styles, menus, headers, footers, sidebars, forms, adverts,
notices and reader comments, known by element, role, class or id, which every element with text but headings may carry (end
tags may be left out; inside pre and code the classes of inline elements are not read). A class or id counts if all of its
words are about such a thing and where it stands; an article inside an element that only hints is kept, inside a nav, aside,
footer or comment list it is not. If the page marks an article (``article``, ``main``),
only blocks inside it are candidates; else all others are. Character references are decoded, white space inside a block
becomes one space, empty blocks go.

Every ``RUN`` words in a row of a page are then a window. A window that stands on enough distinct pages of the whole
host is boilerplate, and the words it covers are removed; the unique runs stay, in order. Enough are ``LOOSE_PAGES``
pages, on a host of any size, where no article is marked, and more than ``MARKED_SHARE`` of at least ``MARKED_PAGES``
pages inside a marked article, where passages that a few articles share belong to them. Pages with the same words are
one page here. ``boilerplate`` states the same for pages in memory, by a suffix array.

Windows go as hashes. On hosts with pages that mark no article all are counted by a shuffle, and the repeated ones are
joined back to their pages. Inside articles two passes over all pages of the host spare that shuffle: a host has as many
slots as ``PAGES`` of its mean pages have windows, each window falls in one of them by its hash, and the pages of each
slot are counted. A window is on no more pages than its slot, so only windows in slots on more than half of the pages are
then counted themselves. The parsed pages are staged once in the shared folder; no task holds a host.

A NULL or empty html gives an empty text, a NULL or odd url the host ''. Repeated rows each get their text. An empty table
gives an empty result, pages of any length are read whole, and other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import pick, shared_folder
from trafficlake.llm.shingles import byte_hashes, mix, runs_of

RUN = 8
LOOSE_PAGES, MARKED_SHARE, MARKED_PAGES = 2, 0.5, 8
PAGES = 4
HELD = 1 << 21
ROWS_PER_BATCH = 128

RAW = frozenset("script style noscript template textarea title iframe svg math object select option canvas".split())
CHROME = frozenset("nav header footer aside form button menu dialog head".split())
MARKED = frozenset("article main".split())
CONTAINERS = CHROME | MARKED | frozenset("html body div section ul ol dl table blockquote figure details center fieldset".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption pre hr address figcaption summary legend".split()
)
# Words that make a class or id a hint, if all its other words are only about where or how a thing is shown
MENU = frozenset("nav navbar navigation menu breadcrumb breadcrumbs pagination".split())
COMMENT = frozenset("comment comments disqus replies".split())
HINTS = MENU | COMMENT | frozenset(
    "header masthead footer sidebar ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored "
    "cookie cookies consent notice notices alert newsletter subscribe signup".split()
)
SHOWN = frozenset(
    "site global main page post article reader user top bottom left right upper lower primary secondary mobile desktop sticky fixed "
    "box block bar row col column list lists item items link links container wrapper wrap section area inner outer body content "
    "unit slot panel strip text x".split()
)
STATES = frozenset("no non not has with without open closed enabled disabled".split())  # of a page, not what a thing is
ROLES = frozenset("navigation banner complementary contentinfo search menu menubar".split())
ARTICLE_OWN = frozenset(("header", "banner"))  # an article's own header holds its title
FIRM = frozenset("nav aside footer".split())  # an article inside is none of the page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VERBATIM = frozenset("pre code".split())  # inside, classes tell kinds of code
# Where the end tag of an element is left out, the start of which others ends it
ENDED_BY = {
    "p": BLOCKS,
    "li": frozenset(("li",)),
    **dict.fromkeys(("dt", "dd"), frozenset(("dt", "dd"))),
    **dict.fromkeys(("td", "th"), frozenset("td th tr thead tbody tfoot".split())),
    "tr": frozenset("tr thead tbody tfoot".split()),
    **dict.fromkeys(("thead", "tbody", "tfoot", "caption"), frozenset("thead tbody tfoot".split())),
    **dict.fromkeys(HEADINGS, HEADINGS),
}
ITEMS = frozenset("li dt dd td th tr thead tbody tfoot".split())

_tag = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<[a-zA-Z/][^>]*(?:>|\Z)",
    re.DOTALL,
)
_attribute = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_named = re.compile(r"class|id|role", re.IGNORECASE)
_words = re.compile(r"[a-z]+|[A-Z][a-z]*")
_link = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)[^>]*>")


def _hints(name: str, attributes: str, inside: bool) -> frozenset[str]:
    """The hints that an element's classes, id and role give: of tokens that are wholly about such a thing.

    Headings give none. A token that tells a state of the page (``no-ads``, ``with-sidebar``, ``comments-open``) or names anything
    else too (``social-science``, ``ad-hoc``) is no hint.
    """
    if name in HEADINGS or "=" not in attributes or not _named.search(attributes):
        return frozenset()
    found: set[str] = set()
    for attribute, *value in _attribute.findall(attributes):
        kind, text = attribute.lower(), "".join(value)
        if kind == "role":
            found |= ROLES.intersection(text.lower().split())
        elif kind in ("class", "id"):
            for token in text.split():
                words = {w.lower() for w in _words.findall(token)}
                if words and words <= HINTS | SHOWN and not words & STATES:
                    found |= words & HINTS
    return frozenset(found - ARTICLE_OWN if inside else found)


def _prose(html: str, at: int, name: str) -> bool:
    """Whether most of the text of an element that opened before ``at`` stands outside links."""
    depth, linked, plain, total, last = 1, 0, 0, 0, at
    for m in _link.finditer(html, at):
        size = len(html[last : m.start()].split())
        total += size
        plain += 0 if linked else size
        last = m.end()
        tag, step = m.group(2).lower(), -1 if m.group(1) else 1
        linked = max(0, linked + step) if tag == "a" else linked
        depth += step if tag == name else 0
        if not depth:
            break
    return plain * 2 > total


def _left_out(name: str, attributes: str, inside: bool, html: str, at: int) -> frozenset[str]:
    """Hints that count: a menu is one only if most of its text is links."""
    found = _hints(name, attributes, inside)
    return frozenset() if found and found <= MENU and _prose(html, at, name) else found


@dataclass
class Muted:
    """A text element that is left out: how many of its name are open, at which depth, and the blocks open inside it."""

    name: str
    depth: int
    open: int = 1
    inner: Counter = field(default_factory=Counter)

    def ends(self, name: str, closing: bool, paragraph: bool) -> bool:
        """Whether this tag, at the element's own depth, ends it; ``paragraph``: the element stands in an open p."""
        if name == self.name:
            if not closing and name not in ENDED_BY:
                self.open += 1
                return False
            self.open -= 1
            return closing and self.open <= 0 or not closing
        if name not in BLOCKS:
            return False
        if closing:
            if name in CONTAINERS:
                return False
            self.inner[name] -= 1
            return self.inner[name] < 0
        if name in ENDED_BY.get(self.name, ()) or (self.name not in BLOCKS and (paragraph or name in ITEMS and not self.inner[name])):
            return True
        self.inner[name] += name not in CONTAINERS and name not in VOID
        return False


def blocks(html: str | None) -> tuple[list[str], bool]:
    """Candidate blocks of a page, in order, and whether they are from a marked article."""
    html = html or ""
    marked: list[str] = []
    loose: list[str] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # element, leave out, inside an article, articles too
    skip = inside = firm = paragraph = False
    muted: Muted | None = None
    verbatim = 0
    at = 0

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                (marked if inside else loose).append(text)
            held.clear()

    n = len(html)
    while at < n:
        m = _tag.search(html, at)
        if m is None:
            if not skip and not muted:
                held.append(html[at:])
            break
        if not skip and not muted and m.start() > at:
            held.append(html[at : m.start()])
        at = m.end()
        if not m.group(2):
            continue
        closing, name, attributes = m.group(1), m.group(2).lower(), m.group(3)
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(html, at)
                # an element that never ends hides the rest only where a browser would
                at = end.end() if end else (n if name in ("script", "style", "title", "textarea") else at)
            continue
        if name == "br":
            held.append(" ")
        if muted and len(stack) == muted.depth and muted.ends(name, bool(closing), paragraph):
            muted = None
        if name in VERBATIM:
            verbatim = max(0, verbatim + (-1 if closing else 1))
        if name in BLOCKS:
            flush()
            paragraph = name == "p" and not closing if not muted else paragraph
        if name not in CONTAINERS:
            text_element = not closing and name not in VOID and not attributes.endswith("/")
            if text_element and not (skip or muted) and (name in BLOCKS or not verbatim) and _left_out(name, attributes, inside, html, at):
                muted = Muted(name, len(stack))
            continue
        verbatim = 0
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            _, skip, inside, firm = stack[-1] if stack else ("", False, False, False)
            muted = None if muted and len(stack) < muted.depth else muted
        elif not attributes.endswith("/"):
            if name in MARKED:
                # what only hints at being left out does not cover a whole article
                firm = firm or bool(COMMENT & _hints(name, attributes, inside))
                skip, inside = firm, True
            elif name not in ("html", "body"):
                found = frozenset() if skip and firm else _left_out(name, attributes, inside, html, at)
                chrome = name in CHROME and not (name == "header" and inside)
                firm = firm or name in FIRM or bool(COMMENT & found)
                skip = skip or chrome or bool(found)
            stack.append((name, skip, inside, firm))
    flush()
    return (marked, True) if marked else (loose, False)


def boilerplate(pages: list[np.ndarray], marked: list[bool]) -> list[np.ndarray]:
    """For each page's word hashes, which words a repeat across enough of these pages covers."""
    sizes = [len(p) for p in pages]
    bare = [np.zeros(n, bool) for n in sizes]
    if len(pages) < 2 or not sum(sizes):
        return bare
    same = {}
    identity = np.array([same.setdefault(p.tobytes(), len(same)) for p in pages])
    total = len(same)
    owner = np.repeat(np.arange(len(pages)), [n + 1 for n in sizes])
    ends = np.cumsum([n + 1 for n in sizes]) - 1
    words = np.zeros(len(owner), np.int64)
    inner = np.ones(len(owner), bool)
    inner[ends] = False
    words[inner] = np.unique(np.concatenate(pages), return_inverse=True)[1]
    words[ends] = len(owner) + np.arange(len(pages))  # an end of its own for each page, so no repeat spans two
    rank = np.unique(words, return_inverse=True)[1]
    width = 1
    while width < RUN:
        after = np.concatenate((rank[width:] + 1, np.zeros(min(width, len(rank)), np.int64)))[: len(rank)]
        rank = np.unique(rank * (rank.max() + 2) + after, return_inverse=True)[1]
        width *= 2
    # distinct pages of each rank
    pairs = np.unique(rank * np.int64(total) + identity[owner])
    count = np.bincount(pairs // total, minlength=int(rank.max()) + 1)[rank]
    least = np.where(
        np.array(marked)[owner],
        np.inf if total < MARKED_PAGES else np.floor(MARKED_SHARE * total) + 1,
        LOOSE_PAGES,
    )
    room = ends[owner] - np.arange(len(owner)) >= RUN
    starts = np.flatnonzero(room & (count >= least))
    cover = np.zeros(len(owner) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + RUN, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return [covered[end - n : end] for end, n in zip(ends, sizes, strict=True)]


def unique_runs(lines: list[str], covered: np.ndarray) -> str:
    """Blocks without the covered words; a block that loses none is as it was."""
    if not covered.any():
        return "\n".join(lines)
    kept, at = [], 0
    for line in lines:
        words = line.encode("utf-8", "surrogatepass").split()
        gone = covered[at : at + len(words)]
        at += len(words)
        if not gone.any():
            kept.append(line)
        elif not gone.all():
            left = b" ".join([w for w, g in zip(words, gone, strict=True) if not g])
            kept.append(left.decode("utf-8", "surrogatepass"))
    return "\n".join(kept)


def _number(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _page_words(lines: list[str]) -> np.ndarray:
    return byte_hashes("\n".join(lines).encode("utf-8", "surrogatepass"))


def _windows(lines: list[str], host: str) -> np.ndarray:
    """Hashes of each ``RUN`` words in a row, by position, that no other host has."""
    words = _page_words(lines)
    if len(words) < RUN:
        return np.empty(0, np.int64)
    own = np.array([_number(host.encode("utf-8", "surrogatepass"))], np.int64).view(np.uint64)
    return mix(runs_of(words, RUN) + own).view(np.int64)


def _slots(windows: np.ndarray, slots: int) -> np.ndarray:
    return (windows.view(np.uint64) % np.uint64(slots)).view(np.int64)


def _page_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, slot, n): on how many pages a window in that slot of the host stands.

    A page may be counted more than once, never less: its copies are one page only where they are held together. Pages are
    held until they fill about ``HELD`` slots.
    """
    held: dict[int, tuple[str, np.ndarray]] = {}
    size = 0

    def counts() -> pa.RecordBatch:
        hosts: dict[str, list[np.ndarray]] = {}
        for host, found in held.values():
            hosts.setdefault(host, []).append(found)
        made = [np.unique(np.concatenate(x), return_counts=True) for x in hosts.values()]
        at = pa.array(np.repeat(np.arange(len(made)), [len(s) for s, _ in made]), pa.int64())
        slot = pa.array(np.concatenate([np.empty(0, np.int64), *[s for s, _ in made]]), pa.int64())
        n = pa.array(np.concatenate([np.empty(0, np.int64), *[c for _, c in made]]), pa.int64())
        return pa.record_batch([pa.array(list(hosts), pa.string()).take(at), slot, n], ["host", "slot", "n"])

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("host", "page", "lines", "slots")]
        for host, page, lines, slots in zip(*columns, strict=True):
            if page in held:
                continue
            held[page] = host, np.unique(_slots(_windows(lines, host), slots))
            size += len(held[page][1]) + 32  # a page without windows takes room too
            if size > HELD:
                yield counts()
                held, size = {}, 0
    yield counts()


def _page_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page, win) of each page's distinct windows; only of those in ``wanted`` slots where there is such a column."""
    for batch in batches:
        hosts, lines = batch["host"].to_pylist(), batch["lines"].to_pylist()
        some = "wanted" in batch.schema.names
        found = []
        for k, (host, x) in enumerate(zip(hosts, lines, strict=True)):
            w = np.unique(_windows(x, host))
            found.append(w[np.isin(_slots(w, batch["slots"][k].as_py()), batch["wanted"][k].values.to_numpy())] if some else w)
        at = pa.array(np.repeat(np.arange(len(found)), [len(w) for w in found]), pa.int64())
        wins = pa.array(np.concatenate([np.empty(0, np.int64), *found]), pa.int64())
        yield pa.record_batch([batch["host"].take(at), batch["page"].take(at), wins], ["host", "page", "win"])


PAGE_WINDOWS = "host string, page long, win long"


def _covering(lines: list[str], host: str, gone: pa.Scalar) -> np.ndarray:
    """Which words of a page the windows in ``gone`` cover."""
    windows = _windows(lines, host)
    starts = np.flatnonzero(np.isin(windows, gone.values.to_numpy())) if gone.is_valid else np.empty(0, np.int64)
    cover = np.zeros(len(windows) + RUN + 1 if len(windows) else 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + RUN, -1)
    return np.cumsum(cover)[: len(windows) + RUN - 1] > 0


def main_text(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of each page."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    address = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    pages = pick(df, key=key, url=url, html=html).withColumn("host", address)
    kind = pages.schema["key"].dataType.simpleString()

    def staged(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [blocks(h.as_py()) for h in batch["html"]]
            hosts = [h.encode("utf-8", "surrogatepass") for h in batch["host"].to_pylist()]
            words = [_page_words(x) for x, _ in made]
            page = pa.array([_number(h + b"\n" + w.tobytes()) for h, w in zip(hosts, words, strict=True)], pa.int64())
            size = pa.array([len(w) for w in words], pa.int64())
            lines = pa.array([x for x, _ in made], pa.list_(pa.string()))
            columns = [batch["key"], batch["url"], batch["host"], page, size, pa.array([m for _, m in made], pa.bool_()), lines]
            yield pa.record_batch(columns, ["key", "url", "host", "page", "size", "marked", "lines"])

    parsed = staged(pages.mapInArrow(parse, f"key {kind}, url string, host string, page long, size long, marked boolean, lines array<string>"), "parsed")
    each = parsed.groupBy("host", "page").agg(F.max("size").alias("size"), F.max("marked").alias("marked"), F.max(~F.col("marked")).alias("loose"))
    slots = F.ceil(PAGES * F.sum("size") / F.count(F.lit(1))) + 1
    totals = F.count(F.lit(1)).alias("total"), slots.alias("slots"), F.max("marked").alias("marked"), F.max("loose").alias("loose")
    hosts = staged(each.groupBy("host").agg(*totals), "hosts")

    # inside articles: windows of more than half of the host's pages
    known = hosts.where(F.col("marked") & (F.col("total") >= MARKED_PAGES)).select("host", "total", "slots")
    most = F.col("n") > MARKED_SHARE * F.col("total")
    listed = parsed.select("host", "page", "lines").join(known, "host").select("host", "page", "lines", "slots")
    filled = listed.mapInArrow(_page_slots, "host string, slot long, n long").groupBy("host", "slot").agg(F.sum("n").alias("n"))
    full = filled.join(known, "host").where(most)
    wanted = staged(full.groupBy("host", "slots").agg(F.collect_list("slot").alias("wanted")), "wanted")
    met = parsed.select("host", "page", "lines").join(wanted, "host").select("host", "page", "lines", "slots", "wanted")
    count = met.mapInArrow(_page_windows, PAGE_WINDOWS).distinct().groupBy("host", "win").agg(F.count(F.lit(1)).alias("n"))
    often = count.join(known, "host").where(most)
    common = staged(often.groupBy("host").agg(F.collect_list("win").alias("common")), "common")

    # elsewhere: windows of LOOSE_PAGES pages of the host
    open_pages = parsed.select("host", "page", "lines").join(hosts.where("loose").select("host"), "host", "left_semi")
    stood = open_pages.mapInArrow(_page_windows, PAGE_WINDOWS).select("win", "page").distinct()
    again = stood.groupBy("win").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LOOSE_PAGES).select("win")
    repeated = staged(stood.join(again, "win").groupBy("page").agg(F.collect_list("win").alias("repeated")), "repeated")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            rows = zip(batch["lines"].to_pylist(), batch["host"].to_pylist(), batch["marked"].to_pylist(), strict=True)
            for k, (lines, host, marked) in enumerate(rows):
                texts.append(unique_runs(lines, _covering(lines, host, batch["common" if marked else "repeated"][k])))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.record_batch([batch["key"], batch["url"], pa.array(texts, pa.string()), sizes], ["key", "url", "text", "n_chars"])

    found = parsed.join(common, "host", "left").join(repeated, "page", "left")
    found = found.select("key", "url", "host", "marked", "lines", "common", "repeated")
    out = found.mapInArrow(clean, f"key {kind}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"key": key, "url": url} if key != "url" else {})
