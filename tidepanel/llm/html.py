"""Main text of web pages by wrappers inferred per host.

A page is read as a tree of block elements (inline markup is transparent, end tags may be missing) whose leaves are text
slots. Its skeleton is a union-free regular expression: children in order, neighbours that align folded into one repeated
group, text into slots. Skeletons of one host are aligned with each other one after the other: elements met on both sides
merge, an element met on one side only becomes optional, a further neighbour of the same kind makes its group repeated.
The result is the host's wrapper; its slots are then judged: those below boilerplate elements (by tag, class, id or role)
are dropped, an article or main region wins where the wrapper has one, else the regions whose words are mostly outside
links. A page's text is what its blocks hold at the wrapper's content slots.

All pages take part, but only distinct skeletons with word counts travel, added up before and after the shuffle; hosts
with many are merged in salted parts first. Nulls count as empty pages, pages without a host form one group by that name,
repeated rows are extracted alike, an empty table gives none.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel.llm.common import pieces, read, stored

SALTS = 16

# Elements of HTML.
SWALLOWING = {"script", "style", "textarea"}  # these reach to the end of a page that doesn't close them; others end with their tag
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math textarea select button title head".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr br img".split()
)
CLOSED_BY = {  # an open element on the left ends when one of those on the right begins
    "p": set(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
        "h5 h6 header hr main menu nav ol p pre section table ul".split()
    ),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option", "optgroup"},
}
BOILERPLATE_TAGS = set("nav header footer aside form dialog menu".split()) | RAW
BOILERPLATE_NAMES = set(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion nav navigation navbar menu breadcrumb "
    "breadcrumbs header footer masthead sidebar aside widget comment comments disqus reply replies respond cookie cookies "
    "consent notice notices alert popup modal overlay newsletter subscribe signup login share sharing social related "
    "recommended pagination pager toolbar copyright legal disclaimer search".split()
)
BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

STATE_WORDS = set("no not non has have is with without hide hidden show open opened closed enabled disabled on off none".split())
CONTENT_TAGS = {"article", "main", "html", "body"}  # what their classes say is about the page
DEPTH = 100  # deeper elements are one level; texts and marks are kept

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|([^<]+|<)", re.S
)  # quotes hold a value only behind an equals sign
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _kind(tag: str, attributes: str) -> str:
    """Name of an element in skeletons: its tag, and a mark when its class, id or role says boilerplate or content."""
    if tag in BOILERPLATE_TAGS:
        return tag + "!"
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if name.lower() == "role":
            if value in BOILERPLATE_ROLES:
                return tag + "!"
            if value == "main":
                return "main"
        elif tag not in CONTENT_TAGS and any(map(_says_boilerplate, value.split())):
            return tag + "!"
    return tag


def _says_boilerplate(name: str) -> bool:
    """Whether a class or id names boilerplate; one that says what there is not, or how it is set, doesn't."""
    words = set(re.split(r"[^a-z]+", name))
    return bool(words & BOILERPLATE_NAMES) and not words & STATE_WORDS


def _squeezed(path: tuple[str, ...]) -> tuple[str, ...]:
    """At most ``DEPTH`` levels and one for all below; regions and marks met below are kept."""
    if len(path) <= DEPTH:
        return path
    below = path[DEPTH:]
    mark = "div!" if any(k.endswith("!") for k in below) else next((k for k in ("article", "main") if k in below), "div")
    return (*path[:DEPTH], mark)


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int, int]]:
    """Text blocks in page order: path of element kinds, text, words, and words inside links."""
    out: list[tuple[tuple[str, ...], str, int, int]] = []
    stack: list[tuple[str, str]] = []  # (tag, kind) of open block elements
    held: list[str] = []
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            words = text.count(" ") + 1
            out.append((_squeezed(tuple(k for _, k in stack)), text, words, min(linked, words)))
        held.clear()
        linked = 0

    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        if m is None:
            at += 1
            continue
        at = m.end()
        closing, tag, attributes, text = m.groups()
        if text is not None:
            held.append(text)
            if in_link:
                linked += len(text.split())
        elif tag is None:
            continue  # comment, doctype
        else:
            tag = tag.lower()
            if tag in RAW and not closing:
                if tag not in VOID and not m[0].endswith("/>"):
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                    if end:
                        at = end.end()
                    elif tag in SWALLOWING:
                        at = len(page)
                    elif tag == "title":  # without an end it is the text up to the next element
                        at = max(page.find("<", at), at) if "<" in page[at:] else len(page)
                if tag not in ("button", "select"):
                    continue
                held.append(" ")
            elif tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                held.append(" ")
            elif tag in INLINE or tag in VOID and tag != "hr":
                if (name := _kind(tag, attributes or "")).endswith("!") and not closing and tag not in VOID:
                    flush()
                    stack.append((tag, name))
                elif closing and any(t == tag for t, _ in stack):
                    flush()
                    while stack and stack.pop()[0] != tag:
                        pass
            else:
                flush()
                in_link = 0 if tag not in ("p", "li", "div") else in_link
                if closing:
                    if any(t == tag for t, _ in stack):
                        while stack and stack.pop()[0] != tag:
                            pass
                elif tag != "hr":
                    while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                        stack.pop()
                    stack.append((tag, _kind(tag, attributes or "")))
    flush()
    return out


# A wrapper node: {"k": kind, "o": optional, "r": repeated, "w": words, "l": linked words, "c": children}. Kind "#" is a slot.
Node = dict[str, Any]


def _node(kind: str) -> Node:
    return {"k": kind, "o": False, "r": False, "w": 0, "l": 0, "c": []}


def tree(found: list[tuple[tuple[str, ...], str, int, int]]) -> Node:
    """The page as a tree of its blocks, neighbours of one kind still apart."""
    root = _node("/")
    previous: tuple[str, ...] = ()
    open_ = [root]
    for path, _, words, linked in found:
        shared = 0
        while shared < min(len(path), len(previous)) and path[shared] == previous[shared]:
            shared += 1
        if shared == len(path) and shared:
            shared -= 1  # a further element of the same kind
        del open_[shared + 1 :]
        for kind in path[shared:]:
            child = _node(kind)
            open_[-1]["c"].append(child)
            open_.append(child)
        slot = _node("#") | {"w": words, "l": linked}
        open_[-1]["c"].append(slot)
        previous = path
    return root


def folded(node: Node) -> Node:
    """Neighbours of one kind merged into a repeated group, from the leaves up."""
    out: list[Node] = []
    for child in map(folded, node["c"]):
        if out and out[-1]["k"] == child["k"]:
            out[-1] = aligned(out[-1], child) | {"r": True, "o": False}
        else:
            out.append(child)
    return node | {"c": _groups(out)}


def _groups(children: list[Node]) -> list[Node]:
    """Alternations such as h2 p h2 p become one repeated group of each kind: order is taken from the page anyway."""
    first: dict[str, Node] = {}
    for c in children:
        first[c["k"]] = aligned(first[c["k"]], c) | {"r": True} if c["k"] in first else c
    return list(first.values())


def aligned(a: Node, b: Node) -> Node:
    """Union-free expression that covers both: common kinds merge in order, others become optional."""
    rest = {c["k"]: c for c in b["c"]}
    children: list[Node] = []
    waiting = list(b["c"])
    for c in a["c"]:
        if c["k"] in rest:
            while waiting and waiting[0]["k"] != c["k"] and waiting[0]["k"] not in {x["k"] for x in a["c"]}:
                children.append(waiting.pop(0) | {"o": True})
            waiting = [x for x in waiting if x["k"] != c["k"]]
            children.append(aligned(c, rest[c["k"]]))
        else:
            children.append(c | {"o": True})
    children += [x | {"o": True} for x in waiting if x["k"] not in {c["k"] for c in children}]
    return {
        "k": a["k"], "o": a["o"] or b["o"], "r": a["r"] or b["r"], "w": a["w"] + b["w"], "l": a["l"] + b["l"], "c": children,
    }


def _shape(node: Node) -> str:
    """A skeleton without its counts."""
    inner = " ".join(map(_shape, node["c"]))
    return node["k"] + "?" * node["o"] + "+" * node["r"] + (f"({inner})" if inner else "")


def _skeletons(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct skeletons of each host in the task, counts added up."""
    seen: dict[tuple[str, str], Node] = {}

    def passed() -> pa.RecordBatch:
        keys = list(seen)
        return pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in keys]), pa.array([s for _, s in keys]), pa.array([json.dumps(seen[k]) for k in keys])],
            names=["host", "shape", "skeleton"],
        )

    for batch in pieces(batches, "html"):
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            node = folded(tree(blocks(page or "")))
            key = (host, _shape(node))
            seen[key] = aligned(seen[key], node) if key in seen else node
        if len(seen) > 2000:
            yield passed()
            seen.clear()
    if seen:
        yield passed()


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    whole: Node | None = None
    for text in pdf.sort_values("shape").skeleton:
        node = json.loads(text)
        whole = node if whole is None else aligned(whole, node)
    return pd.DataFrame({"host": [pdf.host.iloc[0]], "shape": [_shape(whole)], "skeleton": [json.dumps(whole)]})


def content_paths(wrapper: Node) -> list[str]:
    """Paths of the wrapper's content slots."""
    slots: list[tuple[tuple[str, ...], int, int]] = []

    def walk(node: Node, path: tuple[str, ...]) -> None:
        for c in node["c"]:
            if c["k"] == "#":
                slots.append((path, c["w"], c["l"]))
            elif not c["k"].endswith("!"):
                walk(c, path + (c["k"],))

    walk(wrapper, ())
    for region in ("article", "main"):
        inside = [s for s in slots if region in s[0]]
        if sum(w - l for _, w, l in inside) > 0:
            return [">".join(p) for p, _, _ in inside]
    return [">".join(p) for p, w, l in slots if 2 * l < w]


def _content(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        texts = []
        for page, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist()):
            good = set(paths or [])
            texts.append("\n".join(t for p, t, _, _ in blocks(page or "") if ">".join(p) in good))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def _paths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [content_paths(json.loads(s)) for s in batch.column("skeleton").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(found, pa.list_(pa.string()))], names=["host", "paths"])


def wrappers(pages: DataFrame) -> DataFrame:
    """host, shape and skeleton (JSON) of each host's wrapper, from rows with host and html."""
    schema = "host string, shape string, skeleton string"
    every = pages.select("host", "html").mapInArrow(_skeletons, schema)
    parts = every.groupBy("host", (F.xxhash64("shape") % SALTS).alias("salt")).applyInPandas(lambda pdf: _merged(pdf), schema)
    return stored(parts.groupBy("host").applyInPandas(lambda pdf: _merged(pdf), schema))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row: page_id, url, text, n_chars."""
    host = F.lower(F.coalesce(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    paths = wrappers(rows).select("host", "skeleton").mapInArrow(_paths, "host string, paths array<string>")
    kind = pages.schema["page_id"].dataType.simpleString()
    joined = rows.join(stored(paths), "host").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(_content, f"page_id {kind}, url string, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
