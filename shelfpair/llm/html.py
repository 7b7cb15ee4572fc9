"""Main text of web pages: suffix arrays over the pages of each host, then the structure of the page."""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpair.session import stored

#: Elements whose content is no text of the page.
SILENT = {"script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "select", "datalist", "textarea", "title"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
#: Elements that hold what is around an article.
AROUND = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head"}
CONTENT = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements without a break before and after them.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
#: Words of class and id names, and roles, that mark what is around an article.
MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice notices alert popup modal "
    "newsletter subscribe subscription sidebar nav navbar navigation menu breadcrumb breadcrumbs header masthead footer comment comments "
    "disqus replies share sharing social related recommended widget toolbar pagination".split()
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|</?[A-Za-z][^>]*+>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|\Z)", re.IGNORECASE)
CLOSE = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}

#: Marks that tell an article element apart from the article of the page, and that hold also inside an article.
MINOR = set("ad ads advert adverts advertisement sponsored promo comment comments replies disqus related teaser".split())
FOREIGN = MINOR - {"related", "teaser", "promo"}
#: Elements that are text whatever they are called, and beginnings of names that tell of a page and not of an element.
TEXTUAL = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "table", "html", "body"}
ABOUT = ("has-", "with-", "no-", "is-", "without-", "has_", "with_", "no_", "is_")

#: Zones of a block: in an article element, around the article by its elements or as an advert or comment, around it by
#: names only, in a main element beside or without an article, by names around it but inside it, or open.
MAIN, CHROME, NAMED, PLAIN, DOUBT, UNSURE = range(6)
INSIDE = (MAIN, PLAIN, DOUBT)


def _marked(attributes: str, marks: set[str] = MARKS) -> bool:
    """Whether the attributes of a container say that it holds no part of the article.

    Of a class or id, the whole name counts or its last word: site-comments, but not share-price or has-comments.
    """
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id") and any(not part.startswith(ABOUT) and (part in marks or re.split("[_-]", part)[-1] in marks) for part in value.split()):
            return True
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _foreign(attributes: str) -> bool:
    """Whether an element is hidden or is an advert or a comment, which no article holds."""
    return _marked(attributes, FOREIGN)


class _Open:
    """Open containers with the zone inside; an end tag costs a constant beside the elements it closes."""

    def __init__(self):
        self.stack: list[tuple[str, int, bool]] = []
        self.total: dict[str, int] = {}  # by name
        self.levels: list[dict[str, int]] = [{}]  # by name since each open element that stray end tags do not pass

    def push(self, name: str, zone: int) -> None:
        bar = name in CONTENT or name in AROUND
        self.stack.append((name, zone, bar))
        self.total[name] = self.total.get(name, 0) + 1
        if bar:
            self.levels.append({})
        else:
            self.levels[-1][name] = self.levels[-1].get(name, 0) + 1

    def pop(self) -> str:
        name, _, bar = self.stack.pop()
        self.total[name] -= 1
        if bar:
            self.levels.pop()
        else:
            self.levels[-1][name] -= 1
        return name

    def close(self, name: str) -> None:
        passes = name in ("html", "body") or name in CONTENT or name in AROUND
        if self.total.get(name) if passes else self.levels[-1].get(name):
            while self.pop() != name:
                pass

    def zone(self) -> int:
        return self.stack[-1][1] if self.stack else UNSURE


def blocks(html: str) -> list[tuple[str, int]]:
    """(text, zone) of the blocks of a page in order, without empty ones.

    References are decoded, white space within a block becomes one space. Unclosed elements end with their container. Time
    grows with the length of the page, however malformed it is.
    """
    out: list[tuple[str, int]] = []
    text: list[str] = []
    open_ = _Open()
    unclosed: set[str] = set()  # inline names of which no further end was found
    zone, at, seen = UNSURE, 0, False

    def flush() -> None:
        nonlocal seen
        if text:
            words = unescape("".join(text)).split()
            text.clear()
            if words:
                out.append((" ".join(words), zone))
                seen |= zone in (MAIN, PLAIN)

    while True:
        match = TOKEN.search(html, at)
        if match is None:
            text.append(html[at:])
            break
        text.append(html[at : match.start()])
        at = match.end()
        closing, name, attributes = match.groups()
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "br":
                text.append(" ")
            elif name in ("span", "a", "label") and not closing and name not in unclosed and (_foreign if zone in INSIDE else _marked)(attributes):
                end = _end_of(html, name, at)
                if end is None:
                    unclosed.add(name)
                else:
                    at = end
            continue
        flush()
        if name in RAW and not closing and not attributes.endswith("/"):
            end = CLOSE[name].search(html, at)
            at = end.start() if end else len(html)
            continue
        if name in VOID:
            continue
        if closing:
            open_.close(name)
            zone = open_.zone()
            continue
        if name == "body":  # also where the head was not closed
            open_ = _Open()
            zone = UNSURE
        inside = zone
        if name in CONTENT:
            within = zone in INSIDE or zone == NAMED and (seen or any(map(open_.total.get, CONTENT)))
            if zone == CHROME or zone == NAMED and within:
                pass
            elif _marked(attributes, MINOR):
                inside = CHROME if within else NAMED
            elif zone != DOUBT:
                inside = MAIN if name == "article" or zone == MAIN else PLAIN
        elif zone in (MAIN, PLAIN, UNSURE, DOUBT):
            if name in SILENT or name in AROUND and not (name == "header" and zone in INSIDE):
                inside = CHROME
            elif name not in TEXTUAL:
                if zone == UNSURE:
                    inside = NAMED if _marked(attributes) else zone
                elif _foreign(attributes):
                    inside = CHROME
                elif _marked(attributes):
                    inside = DOUBT
        if not attributes.endswith("/"):
            if name == "p":  # paragraphs do not nest
                while open_.stack and open_.stack[-1][0] == "p":
                    open_.pop()
            open_.push(name, inside)
            zone = inside
    flush()
    return out


def _end_of(html: str, name: str, at: int) -> int | None:
    """Where the end tag of an inline element begins, past nested elements of its name; None if it has none."""
    depth = 1
    for match in NESTED[name].finditer(html, at):
        depth += -1 if match[1] else 1
        if depth == 0:
            return match.start()
    return None


NESTED = {name: re.compile(rf"<(/?){name}(?=[\s/>])", re.IGNORECASE) for name in ("span", "a", "label")}


#: Levels of prefix doubling: prefixes are compared up to 2 ** LEVELS - 1 tokens.
LEVELS = 7
#: Words of a short and of a long block; pages that tell boilerplate, for long blocks and for all others.
SHORT, LONG = 8, 50
MANY, FEW = 10, 2
END = ""


def suffix_array(tokens: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of ``tokens``, exact to 2 ** levels tokens, and the rank of each suffix by its first 1, 2, 4, ... tokens.

    Prefix doubling: ranks by 2k tokens come from the ranks by k tokens of a suffix and of the one k further on.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    ranks = [rank]
    for level in range(levels):
        k = 1 << level
        later = np.concatenate([rank[k:], np.zeros(min(k, len(rank)), np.int64)])[: len(rank)]
        rank = np.unique(rank * (len(rank) + 2) + later, return_inverse=True)[1].astype(np.int64) + 1
        ranks.append(rank)
    return np.argsort(rank, kind="stable"), ranks


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Common prefix of each suffix of ``order`` with the one before it, in tokens, up to 2 ** levels - 1; 0 for the first."""
    if not len(order):
        return np.empty(0, np.int64)
    i, j, size = order[:-1].copy(), order[1:].copy(), len(ranks[0])
    length = np.zeros(len(order) - 1, np.int64)
    for level in range(len(ranks) - 2, -1, -1):
        fits = (i < size) & (j < size)
        same = np.zeros(len(i), bool)
        same[fits] = ranks[level][i[fits]] == ranks[level][j[fits]]
        step = same.astype(np.int64) << level
        i, j, length = i + step, j + step, length + step
    return np.concatenate([[0], length])


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
    return value - (1 << 64) if value >> 63 else value


def _key(host: str, words: list[str]) -> int:
    return _hash(" ".join([host, *words]))


#: A page as seen by its host: hashes of its content, its longest and its second longest block; and blocks as lists of words.
Stream = tuple[int, int, int, list[list[str]]]


def host_repeats(host: str, pages: list[Stream], depth: int) -> list[tuple[int, int, int | None]]:
    """(key, content, anchor) of what recurs or may recur: whole blocks, and runs of ``depth`` words inside blocks.

    The blocks of some pages of a host are one sequence of tokens with an end after each block. Whole blocks that are
    equal, and runs of ``depth`` words that are, are neighbours in the suffix array with a common prefix of that length, so each
    group is one key. Given are at most MANY pages a key with different anchors: more would not change any decision.
    The anchor of a page is a hash of its longest other block, and None if the block itself is the longest and not short.
    """
    number: dict[str, int] = {END: 0}
    ids: list[int] = []
    place: list[tuple[int, int, int]] = []  # page, block, word
    for p, (_, _, _, parts) in enumerate(pages):
        for b, words in enumerate(parts):
            ids += [number.setdefault(w, len(number)) for w in words] + [0]
            place += [(p, b, k) for k in range(len(words) + 1)]
    order, ranks = suffix_array(np.array(ids, np.int64))
    size = np.array([len(pages[p][3][b]) for p, b, _ in place], np.int64)
    word = np.array([k for _, _, k in place], np.int64)
    out: list[tuple[int, int, int | None]] = []

    most = (1 << (len(ranks) - 1)) - 1

    def groups(chosen: np.ndarray, length: np.ndarray) -> None:
        """Each run of chosen suffixes that agree in their first ``length`` tokens."""
        here = order[chosen[order]]
        common = common_prefixes(here, ranks)
        first = np.flatnonzero(common < np.minimum(length[here], most))
        for start, stop in zip(first, [*first[1:], len(here)]):
            members: dict[int, list[tuple[int, int]]] = {}
            key = None
            for at in here[start:stop].tolist():
                p, b, k = place[at]
                if key is None or length[at] > most:  # beyond the levels, blocks are told apart by all their words
                    key = _key(host, pages[p][3][b][k : k + int(length[at])])
                members.setdefault(key, []).append((p, b))
            for key, found in members.items():
                anchors: dict[int | None, int] = {}
                for p, b in found:
                    content, longest, second, parts = pages[p]
                    itself = _hash(" ".join(parts[b])) == longest
                    anchors.setdefault((None if len(parts[b]) > SHORT else second) if itself else longest, content)
                    if len(anchors) > MANY:
                        break
                contents = sorted({pages[p][0] for p, _ in found})[:FEW]
                out.extend((key, content, anchor) for anchor, content in anchors.items())
                out.extend((key, content, None) for content in contents)

    groups(word == 0, np.where(size > 0, size, 1))
    groups((word + depth <= size) & (size > depth), np.full(len(ids), depth, np.int64))
    return out


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(row, page_id, url, host, texts, zones, content, longest, second) of every page: its blocks, and what tells pages apart."""
    schema = "page_id long, url string, host string, texts array<string>, zones array<int>, content long, longest long, second long"

    def host_of(url: str | None) -> str:
        try:
            return (urlsplit(url or "").hostname or "").lower()
        except ValueError:
            return ""

    def run(batches):
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*[column.to_pylist() for column in batch.columns]):
                found = blocks(html or "")
                if any(z in (MAIN, PLAIN) for _, z in found):  # what no article holds is around it
                    found = [(t, CHROME if z == UNSURE else z) for t, z in found]
                texts = [t for t, _ in found]
                size = lambda t: (t.count(" "), t)
                longest = max(texts, key=size, default="")
                second = max((t for t in texts if t != longest), key=size, default="")
                rows.append((page_id, url, host_of(url), texts, [z for _, z in found], _hash("\n".join(texts)), _hash(longest), _hash(second)))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64()]
            names = ["page_id", "url", "host", "texts", "zones", "content", "longest", "second"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def repeated_keys(parsed: DataFrame, depth: int) -> DataFrame:
    """(key, contents, anchors): on how many different pages, and beside how many different longest blocks, something recurs.

    Both counts are exact up to MANY and never too high. Each task builds suffix arrays over the pages it has, one a host,
    and passes on a bounded number of pages a key; these are counted over all tasks, so a host may have any number of
    pages. Blocks of articles are no evidence.
    """

    def run(batches):
        for batch in batches:
            hosts: dict[str, list[Stream]] = {}
            for host, texts, zones, content, longest, second in zip(*[column.to_pylist() for column in batch.columns]):
                parts = [t.split(" ") for t, z in zip(texts, zones) if z != MAIN]
                if parts:
                    hosts.setdefault(host, []).append((content, longest, second, parts))
            rows = list(dict.fromkeys(r for host, streams in hosts.items() for r in host_repeats(host, streams, depth)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["key", "content", "anchor"])

    columns = ["host", "texts", "zones", "content", "longest", "second"]
    seen = parsed.where("page_id is not null").select(*columns).mapInArrow(run, "key long, content long, anchor long")
    counted = seen.groupBy("key").agg(F.count_distinct("content").alias("contents"), F.count_distinct("anchor").alias("anchors"))
    return counted.where(F.col("contents") >= FEW)


def wanted_keys(parsed: DataFrame, depth: int) -> DataFrame:
    """(row, block, at, key): whole blocks (at -1) and their runs of ``depth`` words, of all blocks that other pages decide on."""

    def run(batches):
        for batch in batches:
            found = []
            for row, host, texts, zones in zip(*[column.to_pylist() for column in batch.columns]):
                for block, (text, zone) in enumerate(zip(texts, zones)):
                    if zone in (PLAIN, DOUBT, UNSURE):
                        words = text.split(" ")
                        found.append((row, block, -1, _key(host, words)))
                        if len(words) > depth:
                            found += [(row, block, at, _key(host, words[at : at + depth])) for at in range(len(words) - depth + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in range(4)], ["row", "block", "at", "key"])

    return parsed.select("row", "host", "texts", "zones").mapInArrow(run, "row long, block long, at long, key long")


def boilerplate(words: int, at: dict[int, tuple[int, int]], depth: int) -> bool:
    """Whether a block of so many words goes; ``at``: (contents, anchors) of what recurs of it, the whole block at -1.

    A short block goes if it recurs on two different pages; a longer one beside two different longest blocks, so that copies
    of a page with another heading keep their paragraphs; a long one only beside MANY, and where it is not the longest itself.
    Runs that recur like that make a block go if they cover four fifths of it.
    """
    contents, anchors = at.get(-1, (0, 0))
    enough = MANY if words > LONG else FEW
    if words <= SHORT and contents >= FEW or anchors >= enough:
        return True
    covered = {k for place, (_, n) in at.items() if place >= 0 and n >= enough for k in range(place, place + depth)}
    return 5 * len(covered) >= 4 * words


def main_text(pages: DataFrame, depth: int = 16) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    text: the blocks of the article in page order, joined by a space; empty if there are none. What the suffix arrays of a host
    find to recur over its pages goes, block by block (see ``boilerplate``), unless it is inside an article element: copies of
    an article and its stock phrases stay. That decides on pages without article or main element, on what a main element
    holds beside an article, and on containers inside an article whose names say that they are no part of it. Then goes
    what the page itself marks as surroundings: menus, headers, footers, sidebars, forms, scripts, styles, adverts, hidden
    elements and comments of readers; notices and the like outside an article by their names.

    A null html has no text; a null url is a host of its own name; rows without page_id are no evidence for others. Repeated
    rows each come back and count as one page. Further columns are ignored.
    """
    parsed = stored(parsed_pages(pages))
    repeats = stored(repeated_keys(parsed, depth))
    hits = wanted_keys(parsed, depth).join(repeats, "key").groupBy("row", "block").agg(F.collect_list(F.struct("at", "contents", "anchors")).alias("hits"))
    hits = hits.groupBy("row").agg(F.collect_list(F.struct("block", "hits")).alias("blocks"))  # no more than the page itself holds

    def run(batches):
        for batch in batches:
            texts = []
            for blocks_, zones, found in zip(*[column.to_pylist() for column in batch.columns[2:5]]):
                known = {b["block"]: {h["at"]: (h["contents"], h["anchors"]) for h in b["hits"]} for b in found or []}
                keep = [t for k, (t, z) in enumerate(zip(blocks_, zones)) if z not in (CHROME, NAMED) and not (k in known and boilerplate(t.count(" ") + 1, known[k], depth))]
                texts.append(" ".join(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    # only pages with such blocks are joined; the others are settled by their articles
    doubtful = F.exists("zones", lambda z: z.isin(PLAIN, DOUBT, UNSURE))
    columns = ["page_id", "url", "texts", "zones"]
    decided = parsed.where(doubtful).join(hits, "row", "left").select(*columns, "blocks")
    settled = parsed.where(~doubtful).select(*columns, F.lit(None).cast(hits.schema["blocks"].dataType).alias("blocks"))
    text = decided.unionByName(settled).mapInArrow(run, "page_id long, url string, text string")
    return text.withColumn("n_chars", F.length("text").cast("long"))
