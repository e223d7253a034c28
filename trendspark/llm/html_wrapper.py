"""Main-text extraction with wrappers inferred per host (union-free expressions).

*Page tokens.* A page is cut into tags, comments, raw elements and text; end tags that
are left out are implied. Structural elements form nested sequences, inline markup
belongs to the text. Neighbouring elements of one kind are a repeated group.

*Wrapper.* The sequences of a host's pages are aligned one after another, level by level:
equal elements are merged, an element on one side only becomes optional, repeated groups
absorb their repetitions, and text becomes a slot. The result is one expression without
unions per host. Equal page structures are merged before (an aggregate), and a host's
structures are folded in salted groups first and then together, so a host with any share
of the pages is spread over tasks.

*Matching.* Each page is matched against its host's wrapper, so every block of text belongs to
a slot of it. A slot is constant if nearly all distinct pages of the host (``NEARLY_ALL``,
counted by what their slots say, so copies count once) fill it, all with one text.

*Slots.* On the wrapper, the main region is the outermost ``article`` elements, else
``main``, else the body. Slots inside menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments (by element, role or a whole class) do not
belong to it; inside it, a class that may also name a part of an article counts only if all
slots of the element are constant, or mostly link text, over the host's pages. Constant slots of a host with at least ``CONSTANT_PAGES``
distinct pages are template text and do not belong to it either; with ``keep_constant``, as in the
query, only where the region is the whole body: text inside ``article`` and ``main`` then stays, so
that it does not depend on how many pages its host has.

*Text.* Slots of the region are read from the page: character references are decoded,
white space inside a block is one space, blocks are trimmed and joined by a newline.

Defined cases: null and empty pages give an empty text; a null or odd url forms a host of
its own name or the empty one; broken markup is repaired and never dropped; elements
nested deeper than ``DEPTH`` belong to the element at that depth; very long pages are aligned and
matched with one bit per pair of blocks; repeated rows repeat their result; a page without the host's region falls back to its own ``main`` or body.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.llm.common import Scratch, fresh, table
from trendspark.operators.joins import broadcast_if_small

DEPTH = 100
CONSTANT_PAGES = 5
NEARLY_ALL = 0.9
PAGES = -2         # in place of a slot: the count of distinct pages
SALTS = 32

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
             "ruby s samp small span strike strong sub sup time tt u var wbr center o:p".split())
RAW = set("script style textarea title noscript iframe template svg math noembed noframes xmp".split())
BOILERPLATE_TAGS = set("nav aside form footer button select option input menu dialog head fieldset legend".split()) | RAW
BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
# Classes that hold no article text wherever they stand, and those that may: inside the main
# region the latter need evidence from the host's pages.
SURE_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising sponsored promo cookie cookies gdpr popup modal "
    "newsletter sidebar navbar breadcrumb breadcrumbs masthead comment comments pagination pager".split())
BOILERPLATE_WORDS = SURE_WORDS | set(
    "sponsor promotion banner consent notice notices alert overlay subscribe subscription signup login menu nav "
    "navigation footer respond reply replies discussion share sharing social related recommended widget toolbar "
    "search".split())
# A class of such words beside a word of the above counts as that word.
HOLDERS = set("area bar block box button buttons container content form inner item items links list outer panel section "
              "slot unit wrap wrapper main page site global primary secondary left right top bottom desktop mobile message "
              "post posts article articles blog entry story stories user reader readers".split())
FRAMES = {"header", "footer"}                       # of the whole site, beside one of the next
SITE = set("site page global main top".split())
LAYOUT = set("has with without no hide show layout col cols column columns grid row".split())   # a holder's looks
MARKS = "!~"           # behind a tag: boilerplate by its attributes, for sure or given evidence
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
          "th": {"table", "tr"}, "option": {"select"}, "p": set()}
NO_P_CLOSE = INLINE | VOID - {"hr"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|iframe|template|svg|math|noembed|noframes|xmp)(?=[\s/>])[^>]*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def class_mark(token: str) -> str:
    """``!`` for a sure word of boilerplate beside holders only, ``~`` (needs evidence) for other words
    beside holders, for a site's header, and for a sure word beside words of another kind."""
    whole = {token.lower()}
    parts = whole if whole & BOILERPLATE_WORDS else {w.lower() for w in _PART.findall(token)}
    words = parts & BOILERPLATE_WORDS
    if parts & FRAMES and parts & SITE and not parts - FRAMES - SITE - HOLDERS:
        return "~"
    if not words or parts - words - HOLDERS:
        return "~" if words & SURE_WORDS and not parts & LAYOUT else ""
    return "!" if words & SURE_WORDS else "~"


def element_key(tag: str, attrs: str) -> str:
    """Name of an element kind: the tag, with ``!`` or ``~`` if its attributes mark boilerplate."""
    mark, classes = "", []
    for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), a or b or c
        if name == "role" and value.lower().strip() in BOILERPLATE_ROLES:
            mark = "!"
        elif name == "class":
            classes = value.split()
            marks = set(map(class_mark, classes))
            mark = "!" if mark == "!" or "!" in marks else "~" if "~" in marks else ""
    if tag == "article":
        return "article!" if {"comment", "comments", "reply", "replies", "respond"} & {c.lower() for c in classes} else tag
    return tag if tag in ("html", "body", "main") else tag + mark


def bare(key: str) -> str:
    return key.rstrip(MARKS)


def page_events(page: str) -> Iterator[tuple[str, str]]:
    """("open", key), ("close", key), ("text", raw), ("break", "") and ("link", "on" or "") of a repaired page.

    Inline elements but links give no events unless they are marked as boilerplate.
    """
    stack: list[str] = []
    for m in _TOKEN.finditer(page):
        text = m.group("text")
        if text is not None:
            yield "text", text
            continue
        if m.group("raw"):
            continue
        if not m.group("tag"):
            if m.group().startswith("<![CDATA["):
                yield "text", html.escape(m.group()[9:].removesuffix("]]>"))
            continue
        tag = m.group("tag").lower()
        if tag == "a":
            yield "link", "" if m.group("end") else "on"
        if m.group("end"):
            names = [bare(s) for s in stack]
            if tag in names:
                while True:
                    key = stack.pop()
                    yield "close", key
                    if bare(key) == tag:
                        break
            elif tag == "p":
                yield "break", ""
            continue
        key = element_key(tag, m.group("attrs") or "")
        if tag == "br":
            yield "text", " "
        if tag == "hr":
            yield "break", ""
        if tag in VOID:
            continue
        inline = tag in INLINE
        if inline and key == tag:
            continue
        for closing in ([] if inline or tag in NO_P_CLOSE else [{"p"}]) + ([CLOSES[tag]] if tag in CLOSES else []):
            scope = SCOPES.get(tag, set())
            for at in range(len(stack) - 1, -1, -1):
                name = bare(stack[at])
                if name in closing:
                    while len(stack) > at:
                        yield "close", stack.pop()
                    break
                if name in scope or name not in closing and name not in INLINE and closing == {"p"}:
                    break
        if (m.group("attrs") or "").endswith("/") and tag not in ("p", "div", "li"):
            continue
        stack.append(key)
        yield "open", key
    while stack:
        yield "close", stack.pop()


# A sequence is a list of nodes [key, flag, children]; "#" is a text slot without children.
# Flags: "" once, "?" optional, "+" repeated, "*" both.

def _flag(a: str, b: str, repeated: bool = False) -> str:
    many = repeated or a in "+*" and a != "" or b in "+*" and b != ""
    none = a in "?*" and a != "" or b in "?*" and b != ""
    return "*" if many and none else "+" if many else "?" if none else ""


def collapse(nodes: list) -> list:
    """Merge neighbours of one kind into repeated groups."""
    out: list = []
    for key, flag, children in nodes:
        if out and out[-1][0] == key:
            last = out[-1]
            repeated = key != "#"
            last[1] = _flag(last[1], flag, repeated) if repeated else ""
            last[2] = align(last[2], children)
        else:
            out.append([key, flag, children])
    return out


def common_lengths(a: list, b: list, since: int) -> list[int]:
    """Bit rows of the longest common subsequences of the ends of two sequences.

    Bit ``len(a) - 1 - i`` of row ``j - since`` is set if ``a[i:]`` and ``b[j:]`` have no more in common than
    ``a[i + 1:]`` and ``b[j:]`` (bit-parallel recurrence: one row per element, one bit per pair).
    """
    n = len(a)
    every, kinds = (1 << n) - 1, {}
    for i, node in enumerate(a):
        kinds.setdefault(node[0], bytearray(n // 8 + 1))[(n - 1 - i) >> 3] |= 1 << ((n - 1 - i) & 7)
    bits = {key: int.from_bytes(made, "little") for key, made in kinds.items()}
    row, rows = every, []
    for node in reversed(b[since:]):
        hit = row & bits.get(node[0], 0)
        row = ((row + hit) | (row - hit)) & every
        rows.append(row)
    return rows[::-1]


def align(a: list, b: list) -> list:
    """The expression of two sequences: longest common subsequence of kinds, rest optional."""
    if a == b:
        return a
    n, m = len(a), len(b)
    out: list = []
    i = j = since = 0
    rows: list[int] = []
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append([a[i][0], _flag(a[i][1], b[j][1]), align(a[i][2], b[j][2])])
            i, j = i + 1, j + 1
            continue
        if i < n and j < m and not rows:        # equal beginnings need no rows
            rows, since = common_lengths(a, b, j), j
        if j >= m or i < n and rows[j - since] >> (n - 1 - i) & 1:
            out.append([a[i][0], _flag(a[i][1], "?"), a[i][2]])
            i += 1
        else:
            out.append([b[j][0], _flag(b[j][1], "?"), b[j][2]])
            j += 1
    return collapse(out)


def page_structure(page: str) -> list:
    """The page's own expression, repeated neighbours collapsed."""
    root: list = []
    open_lists = [root]
    skipped = 0
    for kind, value in page_events(page):
        if kind == "open":
            if len(open_lists) > DEPTH:
                skipped += 1
                continue
            node = [value, "", []]
            open_lists[-1].append(node)
            open_lists.append(node[2])
        elif kind == "close":
            if skipped:
                skipped -= 1
                continue
            done = open_lists.pop()
            done[:] = collapse(done)
            parent = open_lists[-1]
            if len(parent) > 1 and parent[-2][0] == parent[-1][0]:
                parent[:] = parent[:-2] + collapse(parent[-2:])
        elif kind == "text" and value.strip():
            if not (open_lists[-1] and open_lists[-1][-1][0] == "#"):
                open_lists[-1].append(["#", "", []])
    return collapse(root)


def merge_structures(structures: list[str]) -> str:
    """One expression for several (as JSON); the order does not matter much, so it is fixed."""
    return json.dumps(reduce(align, map(json.loads, sorted(set(structures)))))


def boilerplate(key: str, in_region: bool, in_body: bool = False) -> bool:
    """Whether an element kind is outside the main text; a page header is, an article's is not.

    Kinds marked ``~`` are so outside the region; inside, or if it is the body, the host's pages decide.
    """
    tag = bare(key)
    return (key.endswith("!") or tag in BOILERPLATE_TAGS
            or not in_region and (tag == "header" or key.endswith("~") and not in_body))


def wrapper_region(wrapper: list) -> str:
    """Element kind of the main region: article, main, or the empty name for the body."""
    found = set()

    def walk(nodes: list) -> None:
        for key, _, children in nodes:
            if not boilerplate(key, False):
                found.add(key)
                walk(children)
    walk(wrapper)
    return "article" if "article" in found else "main" if "main" in found else ""


def page_tree(events: list[tuple[str, str]]) -> tuple[list, list]:
    """(the page's sequence with repetitions, the node of each event); nodes are [key, children, slot]."""
    root: list = []
    open_lists, places = [root], []
    skipped = 0
    for kind, value in events:
        node = None
        if kind == "open":
            if len(open_lists) > DEPTH:
                skipped += 1
            else:
                node = [value, [], -1]
                open_lists[-1].append(node)
                open_lists.append(node[1])
        elif kind == "close":
            if skipped:
                skipped -= 1
            else:
                open_lists.pop()
        elif kind == "text" and value.strip():
            if not (open_lists[-1] and open_lists[-1][-1][0] == "#"):
                open_lists[-1].append(["#", [], -1])
            node = open_lists[-1][-1]
        places.append(node)
    return root, places


def number_nodes(wrapper: list) -> list:
    """The wrapper with nodes [key, flag, children, number, end]: numbered in order, descendants up to ``end``."""
    at = 0

    def walk(nodes: list) -> list:
        nonlocal at
        out = []
        for key, flag, children in nodes:
            node, at = [key, flag, None, at, 0], at + 1
            node[2] = walk(children)
            node[4] = at
            out.append(node)
        return out
    return walk(wrapper)


def match_page(nodes: list, wrapper: list) -> bool:
    """Match a page's sequence against a numbered wrapper and put the number into each node.

    Elements that are not optional must occur, only repeated groups may repeat, order
    holds; of several ways the leftmost is taken. A page that went into the wrapper
    always matches; nodes of any other keep -1 where it does not.
    """
    shapes: dict[tuple, int] = {}               # sequences of equal shape match alike, so each is tried once
    groups_of: dict[int, tuple[int, list, list]] = {}
    known: dict[tuple[int, int], list[int] | None] = {}

    def shape(page: list) -> tuple[int, list, list]:
        """(number of the shape, runs of one kind, kind of each run: its key, whether single, its shapes)."""
        if id(page) not in groups_of:
            runs = [list(g) for _, g in groupby(page, key=lambda node: node[0])]
            kinds = [(run[0][0], len(run) == 1, tuple(sorted({shape(one[1])[0] for one in run}))) for run in runs]
            groups_of[id(page)] = shapes.setdefault(tuple(kinds), len(shapes)), runs, kinds
            members.setdefault(groups_of[id(page)][0], kinds)
        return groups_of[id(page)]

    members: dict[int, list] = {}
    fitting: dict[tuple, bool] = {}

    def fits(kind: tuple, node: list) -> bool:
        key, flag, children, number = node[:4]
        if kind[0] != key or not (kind[1] or flag in ("+", "*")):
            return False
        if (kind, number) not in fitting:
            fitting[kind, number] = all(table_of(one, number, children) is not None for one in kind[2])
        return fitting[kind, number]

    def table_of(which: int, owner: int, expected: list) -> list[int] | None:
        """Bit i of entry j: runs i and on match the expected nodes j and on; None if the whole does not."""
        if (which, owner) in known:
            return known[which, owner]
        kinds, m = members[which], len(expected)
        n = len(kinds)
        ok = None
        if n <= m:
            at: dict[tuple, bytearray] = {}
            for i, kind in enumerate(kinds):
                at.setdefault(kind, bytearray(n // 8 + 1))[i >> 3] |= 1 << (i & 7)
            bits: dict[str, list] = {}
            for kind, made in at.items():
                bits.setdefault(kind[0], []).append((kind, int.from_bytes(made, "little")))
            ok = [0] * m + [1 << n]
            for j in range(m - 1, -1, -1):
                after = ok[j + 1] >> 1
                if expected[j][1] in ("?", "*") or expected[j][0] == "#":
                    ok[j] = ok[j + 1]
                for kind, places in bits.get(expected[j][0], ()):
                    if after & places & ~ok[j] and fits(kind, expected[j]):
                        ok[j] |= after & places
        known[which, owner] = ok if ok and ok[0] & 1 else None
        return known[which, owner]

    def assign(page: list, owner: int, expected: list) -> None:
        which, runs, kinds = shape(page)
        ok = table_of(which, owner, expected)
        if ok is None:
            return
        i = j = 0
        while i < len(runs):
            if ok[j + 1] >> (i + 1) & 1 and fits(kinds[i], expected[j]):
                for one in runs[i]:
                    one[2] = expected[j][3]
                    assign(one[1], expected[j][3], expected[j][2])
                i += 1
            j += 1
    whole = shape(nodes)[0]
    assign(nodes, -1, wrapper)
    return table_of(whole, -1, wrapper) is not None


def event_blocks(events: list, places: list, region: str, unwanted: set[int] | frozenset = frozenset()
                 ) -> Iterator[tuple[int, str, int]]:
    """(slot of the wrapper, block text, characters in links) for each block of the main region, in page order.

    ``unwanted`` are nodes of the wrapper that hold no main text, by evidence of the host.
    """
    blocked = depth_in = depth = 0          # boilerplate elements open; region elements open; elements open
    link = 0                                # depth of the open link, plus one
    linked = 0
    parts: list[str] = []
    where = -1

    def block() -> Iterator[tuple[int, str, int]]:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            yield where, text, min(linked, len(text))
        linked = 0
    for (kind, value), node in zip(events, places):
        if kind == "text":
            if not blocked and (depth_in or not region):
                if node is not None and not any(p.strip() for p in parts):
                    where = node[2]
                parts.append(value)
                if link:
                    linked += len(" ".join(html.unescape(value).split()))
            continue
        if kind == "link":
            link = depth + 1 if value else 0
            continue
        # a marked inline element is left out of its block without ending it
        if bare(value) not in INLINE:
            yield from block()
        if kind == "open":
            depth += 1
            if blocked or boilerplate(value, bool(depth_in), not region) or node is not None and node[2] in unwanted:
                blocked += 1
            elif value == region:
                depth_in += 1
        elif kind == "close":
            depth -= 1
            if link > depth + 1:
                link = 0        # the link was never closed
            if blocked:
                blocked -= 1
            elif value == region:
                depth_in -= 1
    yield from block()


def page_blocks(page: str, region: str) -> list[tuple[int, str]]:
    """(slot, text) of the blocks of a page by itself."""
    return [b[:2] for b in region_blocks(page, region)[1]]


def region_blocks(page: str, region: str, wrapper: list | None = None, unwanted: dict[str, set[int]] = {}
                  ) -> tuple[str, list[tuple[int, str, int]]]:
    """The host's region, or the page's own ``main`` or body if it has none, and its blocks."""
    events = list(page_events(page))
    root, places = page_tree(events)
    match_page(root, wrapper or [])
    for choice in dict.fromkeys((region, "main", "")):
        if not choice or re.search(rf"<{choice}\b", page, re.I):
            blocks = list(event_blocks(events, places, choice, unwanted.get(choice, frozenset())))
            if blocks or not choice:
                return choice, blocks
    return "", []


class Wrappers:
    """Numbered wrappers by their JSON, parsed once per task and run of pages."""

    def __init__(self) -> None:
        self.known: dict[str, list] = {}

    def __getitem__(self, text: str | None) -> list:
        if text not in self.known:
            if len(self.known) >= 1000:
                self.known.clear()
            self.known[text] = number_nodes(json.loads(text or "[]"))
        return self.known[text]


def _host(url: str) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame, host: str, page: str, scratch: Scratch) -> DataFrame:
    """(host, wrapper, region): one expression per host, folded in two levels."""
    def structures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, set] = {}
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(name, set()).add(json.dumps(page_structure(body or "")))
            rows = [(h, s) for h, group in seen.items() for s in group]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.string())], names=["host", "s"])

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        wrapper = merge_structures(frame["s"].tolist())
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "s": [wrapper],
                             "region": [wrapper_region(json.loads(wrapper))]})

    found = scratch.keep(pages.select(F.col(host).alias("host"), F.col(page).cast("string").alias("p"))
                         .mapInArrow(structures, "host string, s string").distinct(), "structures")
    kind = "host string, s string, region string"
    salted = found.groupBy("host", F.pmod(F.xxhash64("s"), F.lit(SALTS)).alias("salt")).applyInPandas(fold, kind)
    return scratch.keep(salted.groupBy("host").applyInPandas(fold, kind)
                        .select("host", F.col("s").alias("wrapper"), "region"), "wrappers")


def with_wrappers(pages: DataFrame, host: str, page: str, wrappers: DataFrame) -> DataFrame:
    """(h, p, wrapper, region) of each page."""
    return (pages.select(F.col(host).alias("h"), F.col(page).cast("string").alias("p"))
            .join(broadcast_if_small(wrappers.withColumnRenamed("host", "h")), "h"))


def unwanted_nodes(wrapper: list, slots: dict[int, tuple[int, bool, int, int]], pages: int, constant: bool) -> list[int]:
    """Elements marked ``~`` whose slots are all constant or mostly link text; with ``constant`` also constant slots.

    ``slots`` holds the pages that fill a slot, whether all say the same, its characters and those in links.
    """
    fixed = {slot for slot, (n, same, _, _) in slots.items()
             if slot >= 0 and same and pages >= CONSTANT_PAGES and n >= NEARLY_ALL * pages}
    out = sorted(fixed) if constant else []

    def walk(nodes: list) -> None:
        for key, _, children, number, end in nodes:
            if key.endswith("~"):
                inside = [slot for slot in range(number, end) if slot in slots]
                size, linked = (sum(slots[slot][k] for slot in inside) for k in (2, 3))
                if inside and (fixed.issuperset(inside) or 2 * linked >= size):
                    out.append(number)
            walk(children)
    walk(wrapper)
    return out


def template_slots(pages: DataFrame, host: str, page: str, wrappers: DataFrame, keep_constant: bool = False) -> DataFrame:
    """(host, skipped): nodes of the wrapper that hold no main text, by the host's distinct pages.

    A page is what its slots say, so copies count once and pages that differ vary in some
    slot. Pages are compared with those whose text is of the same region.
    """
    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed = Wrappers()
        for batch in batches:
            seen: dict[tuple, None] = {}
            for name, text, wrapper, region in zip(*(c.to_pylist() for c in batch.columns)):
                at: dict[int, list] = {}
                choice, blocks = region_blocks(text or "", region, parsed[wrapper])
                for slot, block, linked in blocks:
                    at.setdefault(slot, []).append((block, linked))
                if at:
                    said = [(slot, xxhash.xxh64_intdigest("\n".join(b for b, _ in some)) >> 1,
                             sum(len(b) for b, _ in some), sum(n for _, n in some)) for slot, some in sorted(at.items())]
                    seen[name, choice, np.array(said, np.int64).tobytes()] = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*seen) if seen else ((),) * 3, (pa.string(), pa.string(), pa.binary()))],
                names=["host", "choice", "said"])

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, list] = {}
            for name, choice, said in zip(*(c.to_pylist() for c in batch.columns)):
                for slot, code, size, links in [(PAGES, 0, 0, 0), *np.frombuffer(said, np.int64).reshape(-1, 4).tolist()]:
                    low, high, n, chars, linked = seen.get((name, choice, slot), (code, code, 0, 0, 0))
                    seen[name, choice, slot] = [min(low, code), max(high, code), n + 1, chars + size, linked + links]
            rows = [(*k, *v) for k, v in seen.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((),) * 8,
                                                (pa.string(), pa.string(), *[pa.int64()] * 6))],
                names=["host", "choice", "slot", "low", "high", "n", "chars", "linked"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for wrapper, found in zip(*(c.to_pylist() for c in batch.columns[1:])):
                numbered, by_choice = number_nodes(json.loads(wrapper)), {}
                for f in found:
                    by_choice.setdefault(f["choice"], {})[f["slot"]] = (f["n"], f["same"], f["chars"], f["linked"])
                made.append([{"choice": choice, "node": node} for choice, at in by_choice.items()
                             for node in unwanted_nodes(numbered, at, at[PAGES][0], not (keep_constant and choice))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.list_(pa.struct([("choice", pa.string()), ("node", pa.int64())])))],
                names=["host", "skipped"])
    sums = (with_wrappers(pages, host, page, wrappers)
            .mapInArrow(contents, "host string, choice string, said binary").distinct()
            .mapInArrow(slots, "host string, choice string, slot long, low long, high long, n long, chars long, linked long")
            .groupBy("host", "choice", "slot")
            .agg((F.min("low") == F.max("high")).alias("same"), *[F.sum(c).alias(c) for c in ("n", "chars", "linked")])
            .groupBy("host").agg(F.collect_list(F.struct("choice", "slot", "n", "same", "chars", "linked")).alias("found")))
    return (sums.join(wrappers.select("host", "wrapper"), "host").select("host", "wrapper", "found")
            .mapInArrow(decide, "host string, skipped array<struct<choice: string, node: bigint>>"))


def extract_text(pages: DataFrame, url: str, page: str, out: str = "main", keep_constant: bool = False) -> DataFrame:
    """``pages`` with a string column ``out``, the main text of each page.

    ``keep_constant`` keeps text inside ``article`` and ``main`` that all pages of the host share.
    """
    scratch = Scratch(pages.sparkSession, "wrappers")
    names, column = pages.columns, pages.columns.index(page)
    host, wrap, region, fixed = fresh("host"), fresh("wrapper"), fresh("region"), fresh("fixed")
    hosted = pages.withColumn(host, _host(url))
    wrappers = infer_wrappers(hosted, host, page, scratch)
    skipped = scratch.keep(template_slots(hosted, host, page, wrappers, keep_constant), "skipped")
    slots = (wrappers.join(skipped, "host", "left")
             .select(F.col("host").alias(host), F.col("wrapper").alias(wrap), F.col("region").alias(region),
                     F.col("skipped").alias(fixed)))
    joined = hosted.join(broadcast_if_small(scratch.keep(slots, "slots")), host, "left") \
        .select(*names, wrap, region, fixed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed = Wrappers()
        for batch in batches:
            made = []
            for body, wrapper, where, nodes in zip(batch.column(column).to_pylist(),
                                                   *(c.to_pylist() for c in batch.columns[-3:])):
                unwanted: dict[str, set[int]] = {}
                for n in nodes or ():
                    unwanted.setdefault(n["choice"], set()).add(n["node"])
                choice, blocks = region_blocks(body or "", where or "", parsed[wrapper], unwanted)
                skip = unwanted.get(choice, ())
                made.append("\n".join(t for p, t, _ in blocks if p not in skip))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(made, pa.string())], names=[*names, out])
    return joined.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())]))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every whole page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_text(pages, "url", "html", keep_constant=True)
    return found.select("page_id", "url", F.col("main").alias("text"),
                        F.char_length("main").cast("long").alias("n_chars"))
