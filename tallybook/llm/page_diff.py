"""Main text of web pages by differencing each with the page of nearest address.

A page is cut into lines (its blocks of text) in page order. Markup that only ever holds furniture (scripts, menus, headers, footers,
sidebars, forms, and elements whose class, id or role says advert, notice, comments and the like) gives no lines. The others are aligned
with those of the nearest page: pages are sorted by path within each host, and of the two neighbours the one with the longer
common beginning is taken (the earlier one on a tie). Lines of the longest common subsequence are shared by both pages, so they are
furniture and go, except in the main region: the article element with the most unshared text if that is at least half of all, or else
what a main element holds outside of articles. Lines outside of a main element go too, unless the main region is an article there.
A page all of whose lines are shared and that has no such region is a copy of its neighbour and keeps them.

Pages are dealt out by ranges of (host, path, page_id, url) whose first places come from a sample, so a host with most of the pages spreads over tasks.
The page before a range and the one after it go there too, so that all neighbours meet in one shuffle of the lines. Null and empty pages give an empty text, null addresses the host "". Pages that
share an id or an address get one row each. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import os
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import partitions

SAMPLE = 64  # pages looked at for each range
PLACE = ["host", "path", "id_key", "address"]

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
                   r"|<(script|style|noscript|template|textarea|title|iframe|noframes|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WHITE = re.compile(r"\s+")
#: Elements without an end tag, elements that begin a new line, and elements that hold furniture (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre "
                  "section summary table tbody td tfoot th thead tr ul".split())
FURNITURE = frozenset("head nav footer aside form menu dialog fieldset audio video canvas map svg select button object".split())
#: Furniture that stands inside a line, and elements that a paragraph or another block ends.
INLINE = frozenset("audio video canvas map svg select button object".split())
ENDED = frozenset("p svg select".split())
CELLS = 1 << 26  # pairs of lines, a bit each
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
                  "subscription signup comment comments disqus replies menu nav navbar navigation breadcrumb breadcrumbs footer masthead share sharing social related recommended widget toolbar "
                  "login search skip".split())

#: Words that with one of ``NAMES`` still name furniture in a main region, where other words don't (fixed values).
PARTS = frozenset("area bar block blocks body bottom box button buttons container content feed footer form frame group header icon icons inner item items left link links list panel policy post posts "
                  "right row section slot stories thread title top unit wrap wrapper".split())


def _names_furniture(value: str, tag: str, inside: bool) -> bool:
    """Outside of main regions one word of a class or id is enough; inside, all words of a class must say it, and headings are text."""
    if not inside:
        return not NAMES.isdisjoint(re.split(r"[^a-z]+", value))
    if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        return False
    for name in value.split():
        words = set(filter(None, re.split(r"[^a-z]+", name)))
        if words & NAMES and words <= NAMES | PARTS and not (tag == "p" and words <= {"search", "login", "related", "social", "skip"}):
            return True
    return False


def _furniture(tag: str, attributes: str, inside: bool) -> bool:
    if tag in FURNITURE or tag == "header" and not inside:
        return True
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value in ROLES or name in ("class", "id") and _names_furniture(value, tag, inside):
            return True
    return False


def lines_of(page: str) -> tuple[list[str], list[int]]:
    """The lines that may be the main text, and where each is: 2 x the number of its outermost article (0 if in none), + 1 in a main element."""
    lines, places = [], []
    inside = {"article": 0, "main": 0}
    articles, text, skip, depth, at = 0, [], "", 0, 0

    def end():
        line = WHITE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if line:
            lines.append(line)
            places.append(2 * articles * bool(inside["article"]) + bool(inside["main"]))
    for m in TOKEN.finditer(page):
        if not skip:
            text.append(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if skip:  # until the element ends, or one around it, or for a paragraph the next block begins
            if tag == skip and tag not in VOID:
                depth += -1 if m[2] else 1
            if depth and not (m[2] and (tag in ("body", "html") or inside.get(tag))) and not (skip in ENDED and not m[2] and tag in BLOCK) and not (skip == "head" and tag == "body"):
                continue
            skip = ""
            if m[2] and tag not in inside:
                continue
        if tag in BLOCK:
            end()
        if m[2]:
            if tag in inside:
                inside[tag] = max(0, inside[tag] - 1)
        elif _furniture(tag, m[4], any(inside.values())):
            if tag not in VOID and not (tag == "svg" and m[4].endswith("/")):
                if tag not in INLINE:
                    end()
                skip, depth = tag, 1
        elif tag in inside:
            articles += tag == "article" and not inside[tag]
            inside[tag] += 1
    if not skip:
        text.append(page[at:])
    end()
    return lines, places


def _ends(lines: list[str], where: dict[str, int], width: int) -> Iterator[int]:
    """After each of ``lines``: bits of the places of the other page (``where`` has the places of each line), 0 where the longest common subsequence gets longer."""
    row = full = (1 << width) - 1
    for x in lines:
        same = row & where.get(x, 0)
        row = (row + same | row - same) & full
        yield row


def _where(lines: list[str]) -> dict[str, int]:
    places = defaultdict(list)
    for k, x in enumerate(lines):
        places[x].append(k)
    out = {}
    for x, ks in places.items():
        bits = bytearray(ks[-1] // 8 + 1)
        for k in ks:
            bits[k >> 3] |= 1 << (k & 7)
        out[x] = int.from_bytes(bits, "little")
    return out


def _lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and the first 0, 1, ... lines of ``b``."""
    row = 0
    for row in _ends(a, _where(b), len(b)):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little", count=len(b))
    return np.concatenate(([0], np.cumsum(bits == 0)))


def shared(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` are in the longest common subsequence with ``b``: rows of bits, kept for up to ``CELLS`` pairs of lines;
    beyond, ``a`` is halved and ``b`` cut where the lengths from both ends are greatest. Repeated lines cost no more than others."""
    out = [False] * len(a)
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, n, j, m = todo.pop()
        while i < n and j < m and a[i] == b[j]:
            out[i] = True
            i, j = i + 1, j + 1
        while i < n and j < m and a[n - 1] == b[m - 1]:
            out[n - 1] = True
            n, m = n - 1, m - 1
        if i == n or j == m:
            continue
        if n - i > 1 and (n - i) * (m - j) > CELLS:
            half = (i + n) // 2
            cut = j + int(np.argmax(_lengths(a[i:half], b[j:m]) + _lengths(a[half:n][::-1], b[j:m][::-1])[::-1]))
            todo += [(i, half, j, cut), (half, n, cut, m)]
            continue
        rows = list(_ends(a[i:n], _where(b[j:m]), m - j))
        y, x = len(rows), m - j
        while y and x:
            if rows[y - 1] >> (x - 1) & 1:
                x -= 1
            else:
                y -= 1
                if not y or rows[y - 1] >> (x - 1) & 1:
                    out[i + y] = True
                    x -= 1
    return out


def own_lines(lines: list[str], places: list[int], both: list[bool]) -> list[str]:
    """The text of a page from its lines, where they are and which are shared."""
    if not lines:
        return []
    weight = [0 if s else len(x) for x, s in zip(lines, both)]
    if not any(weight):  # a copy
        weight = [len(x) for x in lines]
    by_article: dict[int, int] = defaultdict(int)
    for p, w in zip(places, weight):
        by_article[p >> 1] += w
    in_main = any(p & 1 for p in places)
    largest = max((a for a in by_article if a), key=by_article.__getitem__, default=0)
    outer = sum(w for p, w in zip(places, weight) if p & 1) if in_main else sum(weight)
    if largest and 2 * by_article[largest] >= outer:
        kept = [p >> 1 == largest for p in places]
        if in_main and not any(k and p & 1 for k, p in zip(kept, places)):
            in_main = False  # the main region is an article outside of it
    else:
        kept = [p == 1 for p in places]
    out = [x for x, p, s, k in zip(lines, places, both, kept) if k or not s and (p & 1 or not in_main)]
    return out or lines


def _address(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path
    except ValueError:
        return "", url or ""


def _place(url: str | None, id_key: str) -> tuple[str, str, str, str]:
    return (*_address(url), id_key, url or "")


def _ranges(pages: DataFrame, n: int) -> tuple[list[tuple], dict[int, tuple[list[int], list[int]]]]:
    """How pages are dealt out: first places of ranges 1, 2, ... (at most ``n`` ranges, from about SAMPLE * n evenly hashed pages), and for the
    first and last pages' places the ranges to which they go as neighbours too. Both are bounded by the number of ranges."""
    keys = pages.select("url", "id_key")
    step = max(1, pages.count() // (SAMPLE * n))
    sample = sorted({_place(r["url"], r["id_key"]) for r in keys.where(F.pmod(F.xxhash64("id_key", "url"), F.lit(step)) == 0).collect()})
    starts = [sample[len(sample) * k // n] for k in range(1, n)] if len(sample) >= n else sample

    def run(batches):
        for b in batches:
            places = [_place(*x) for x in zip(b.column("url").to_pylist(), b.column("id_key").to_pylist())]
            cols = [pa.array(x, pa.string()) for x in zip(*places)] or [pa.array([], pa.string())] * 4
            yield pa.record_batch([pa.array([bisect_right(starts, p) for p in places], pa.int32()), *cols], ["part", *PLACE])
    place = F.struct(*PLACE)
    ends = keys.mapInArrow(run, "part int, " + ", ".join(f"{c} string" for c in PLACE)).groupBy("part").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    ends = sorted((r["part"], tuple(r["first"]), tuple(r["last"])) for r in ends.collect())  # at most n
    also: dict[tuple, set[int]] = defaultdict(set)
    for (part, _, last), (after, first, _) in pairwise(ends):
        also[last].add(after)
        also[first].add(part)
    return starts, {k: sorted(v) for k, v in also.items()}


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    spark = pages.sparkSession
    n = partitions(spark)
    kind = pages.schema["page_id"].dataType.simpleString()
    id_key = F.coalesce(F.lpad(F.col("page_id").cast("string"), 20, "0"), F.lit(""))
    pages = pages.select("page_id", "url", "html", id_key.alias("id_key"))
    starts, also = _ranges(pages, n)
    shared_ranges = spark.sparkContext.broadcast((starts, also))
    schema = f"part int, own boolean, page_id {kind}, url string, host string, path string, id_key string, lines array<string>, places array<int>"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, also = shared_ranges.value
        for b in batches:
            for at in range(0, b.num_rows, 500):
                out, rows = [], []
                for k, (url, key, page) in enumerate(zip(*(b.column(c).slice(at, 500).to_pylist() for c in ("url", "id_key", "html")))):
                    place = _place(url, key)
                    lines, places = lines_of(page or "")
                    for part, own in [(bisect_right(starts, place), True), *((p, False) for p in also.get(place, ()))]:
                        rows.append(at + k)
                        out.append((part, own, *place[:3], lines, places))
                part, own, host, path, key, lines, places = zip(*out)
                ids = b.select(["page_id", "url"]).take(pa.array(rows))
                yield pa.record_batch([pa.array(part, pa.int32()), pa.array(own), ids.column(0), ids.column(1), pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(key, pa.string()),
                                       pa.array(lines, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32()))], ["part", "own", "page_id", "url", *PLACE[:3], "lines", "places"])

    def align(batches):
        before = row = None

        def text(after):
            best, long = [], -1
            for x in (before, after):
                if x and x[0] == row[0] and x[4] == row[4] and (n := len(os.path.commonprefix([x[5], row[5]]))) > long:
                    best, long = x[6], n
            return row[2], row[3], own_lines(row[6], row[7], shared(row[6], best))

        def batch(out):
            ids, urls, lines = zip(*out)
            return pa.record_batch([pa.array(ids, of_ids), pa.array(urls, pa.string()), pa.array(lines, pa.list_(pa.string()))], ["page_id", "url", "lines"])
        for b in batches:
            of_ids, out = b.schema.field("page_id").type, []
            for after in zip(*(b.column(c).to_pylist() for c in ("part", "own", "page_id", "url", "host", "path", "lines", "places"))):
                if row and row[1]:
                    out.append(text(after))
                before, row = row, after
            if out:
                yield batch(out)
        if row and row[1]:
            yield batch([text(None)])
    # a range's pages are in one task, with the last page before and the first one after it
    dealt = pages.mapInArrow(parse, schema).repartitionById(n, F.col("part")).sortWithinPartitions("part", *PLACE[:3], F.coalesce("url", F.lit("")))
    return _texts(dealt.select("part", "own", "page_id", "url", "host", "path", "lines", "places").mapInArrow(align, f"page_id {kind}, url string, lines array<string>"))


def _texts(pages: DataFrame) -> DataFrame:
    text = F.array_join("lines", " ")
    return pages.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
