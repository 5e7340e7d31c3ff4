"""HTML extraction (operator 1): site style trees.

Pages of a host are merged into one tree. A node of it is a path of tags with their
class and id; for each the tree counts the pages that have it and, over these, the
distinct contents and the distinct child sequences. A node's importance is the
entropy of these (presentation and content), scaled to 0..1 by the number of pages:
navigation that is the same on every page has 0, prose of its own on each page 1; so has a node of a single page.
Branches below ``min_importance`` are removed from each page of the host.

The tree judges first: every block outside the article is one of its nodes, also those that
their markup names. What it does not find unimportant is then judged by that markup: tags,
roles and class names that say menu, header, footer, sidebar, notice, advert, form, script or
comments (``DROPPED`` and the lists below it). A class or id counts as a whole, or by its last
word if no word of it speaks of a layout ("with-sidebar" is no sidebar). Inside ``article``
or ``main`` nothing is removed but scripts, forms, menus, asides, footers, adverts, notices
and comments; and neither tree nor class names remove an element that holds one of these.
A branch counts as shared only if it stands on ``min_pages`` pages and on ``min_share`` of
its host's, so a host has at most (nodes of a page) / ``min_share`` such branches, however
many pages it has.

Pass one sends the nodes of each page, once for all its copies by a digest of the html,
and counts them with map-side combine on (host, node, content); no page leaves its task. Pass two reads the pages again next to their host's branches: a broadcast while
these are measured to be few, a skew-tolerant join beyond.

Defined cases: null or empty html gives an empty text; a page without url is of the
host ""; markup may be unclosed or nested wrongly, and a "<" that starts no tag is text;
repeated rows are extracted alike and count as one page of their host, as do equal pages of
other urls; a page's markup is read once from front to end, so long pages take time in
proportion; an empty table gives an empty result; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, map_rows, pieces, stored, word_hash


@dataclass(frozen=True)
class Settings:
    min_importance: float = 0.3
    min_pages: int = 2
    min_share: float = 0.3
    broadcast_bytes: int = 32 * 1024 * 1024


#: Elements without content, those that start a block, those whose
#: content is not text of the page, and those that are not part of an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul caption".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
SILENT = frozenset("script style head title template noscript iframe object svg canvas audio video xmp noembed noframes textarea select".split())
DROPPED = SILENT | frozenset("nav header footer aside form button input label fieldset menu dialog search".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
#: Names of what may stand inside an article and is no part of it. Other people's
#: words are among them; an article element inside these is not the article.
OTHERS = frozenset("comment comments commentlist respond disqus reply replies related recommended recommendations".split())
INSERTED = OTHERS | frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted nav navbar navigation menu menus "
    "breadcrumb breadcrumbs sidebar sidebars aside cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing pagination pager".split()
)
#: Further names outside an article.
DROPPED_NAMES = INSERTED | frozenset("banner header masthead topbar footer bottom colophon register social widget widgets skip search form copyright legal disclaimer".split())
#: Words that make a name speak of a layout, or of something's absence.
LAYOUT = frozenset("with without has have no not is layout wrap wrapper container main content page body article post entry site grid row column col section".split())
#: Start tags that end an open element of the same group.
ENDS = {
    **{t: frozenset({t}) for t in ("li", "option", "tr", "thead", "tbody", "tfoot")},
    **{t: frozenset({"dd", "dt"}) for t in ("dd", "dt")},
    **{t: frozenset({"td", "th"}) for t in ("td", "th")},
}
#: What stops the search for an element to end.
SCOPES = frozenset("table ul ol dl select html body article main section div td th".split())

#: A comment or declaration, or a tag whose attributes are well formed.
TAG = re.compile(
    r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*+(?:>|\Z)"""
    r"""|/?[a-zA-Z][^\s/<>]*+(?:\s++[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>=`]++))?+)*+\s*+/?>)""",
    re.S,
)
START = re.compile(r"</?[a-zA-Z]|<[!?]")
#: Where another tag ends: quoted values are stepped over; a new "<" says that it was none.
STOP = re.compile(r"""=\s*+(?:"[^"]*+"|'[^']*+')|[<>]""")
PARTS = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(.*)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
USED = frozenset("class id role hidden aria-hidden style".split())
NAME = re.compile(r"[a-zA-Z]+")
SPACE = re.compile(r"[\s\x00]+")


class Node:
    """An open element: its tag, its node of the style tree, and what is known of it."""

    __slots__ = ("tag", "path", "kept", "final", "safe", "holds", "text", "children")

    def __init__(self, tag: str, path: int, kept: bool, final: bool, safe: bool):
        self.tag, self.path, self.kept, self.final, self.safe = tag, path, kept, final, safe
        self.holds = safe or tag in ("html", "body")  # itself or something in it is always kept
        self.text, self.children = 0, 0


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        name = name.lower()
        if name in USED and name not in out:
            out[name] = entities.unescape(value[1:-1] if value[:1] in ("'", '"') else value)
    return out


def _named(found: dict[str, str], names: frozenset[str]) -> bool:
    """Whether a class or the id is one of ``names``, or ends in one and speaks of no layout."""
    for token in SPACE.split(f"{found.get('class', '')} {found.get('id', '')}"):
        words = [w.lower() for w in NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token))]
        if token.lower() in names or words and words[-1] in names and LAYOUT.isdisjoint(words):
            return True
    return False


#: How an element is judged by its markup: not part of the page's text, not the article's
#: whatever it holds, no part of an article it stands in, none if it stands outside.
NONE, OUTSIDE, INSIDE, FINAL, SILENCED = range(5)


def _judged(tag: str, found: dict[str, str]) -> int:
    role = found.get("role", "").lower()
    if tag in SILENT or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return SILENCED
    if tag in ("html", "body", "main"):
        return NONE
    if _named(found, OTHERS):
        return FINAL
    if tag == "article":
        return NONE
    if tag in DROPPED or role in DROPPED_ROLES:
        return OUTSIDE if tag == "header" or role == "banner" else FINAL  # an article has a header of its own
    if _named(found, INSERTED):
        return INSIDE
    return OUTSIDE if _named(found, DROPPED_NAMES) else NONE


class Tags(dict):
    """What a piece of markup says: whether it ends, its tag, label, kind; remembered."""

    def __missing__(self, markup: str) -> tuple:
        if len(self) > 50_000:
            self.clear()
        found = PARTS.fullmatch(markup)
        if not found:
            value = (False, "", 0, False, NONE, False)
        else:
            tag, marks = found[2].lower(), _attributes(found[3])
            label = word_hash(f"{tag} {marks.get('class', '')} {marks.get('id', '')}" if marks else tag)
            main = tag in ("article", "main") or marks.get("role", "").lower() in ("main", "article")
            value = (bool(found[1]), tag, label, main, _judged(tag, marks), found[3].endswith("/"))
        self[markup] = value
        return value


TAGS = Tags()


def next_tag(source: str, at: int) -> tuple[int, int]:
    """Where the next tag, comment or declaration begins and ends; the end of the text if there is none."""
    while found := START.search(source, at):
        start = found.start()
        if whole := TAG.match(source, start):
            return start, whole.end()
        at = found.end()
        while stop := STOP.search(source, at):
            at = stop.end()
            if stop[0] == ">":
                return start, at
            if stop[0] == "<":
                at -= 1
                break
        else:
            break
    return len(source), len(source)


def walk(page: str | None, branches: frozenset[int] = frozenset(), judge: bool = False) -> tuple[list[str], dict[int, list[int]], list[int]]:
    """Text blocks of a page; for each node outside an article its path, content and children; removals.

    ``branches`` are nodes of the style tree whose subtrees are left out. To ``judge`` is to
    gather nodes for the tree: then nothing is left out for its name, and no blocks are made.
    Removals are how many branches the tree took, and how many the markup's names took.
    """
    source = page or ""
    blocks: list[str] = []
    open_text: list[str] = []
    nodes: dict[int, list[int]] = {}
    removed = [0, 0]
    stack = [Node("", 0, True, False, False)]

    def flush() -> None:
        if open_text:
            text = " ".join(entities.unescape("".join(open_text)).split())
            open_text.clear()
            if text:
                blocks.append(text)

    def close() -> None:
        node = stack.pop()
        if node.tag in BLOCK:
            flush()
        parent = stack[-1]
        parent.text = (parent.text * 31 + node.text) & 0x7FFFFFFFFFFFFFFF
        parent.children = (parent.children * 31 + node.path) & 0x7FFFFFFFFFFFFFFF
        if node.holds and node.kept:
            parent.holds = True
        elif node.kept and node.tag in BLOCK:
            seen = nodes.setdefault(node.path, [0, 0])
            seen[0] = (seen[0] * 31 + node.text) & 0x7FFFFFFFFFFFFFFF
            seen[1] = (seen[1] * 31 + node.children) & 0x7FFFFFFFFFFFFFFF

    def say(text: str) -> None:
        node = stack[-1]
        if text and node.kept:
            if not judge:
                open_text.append(text)
            if not node.safe and not text.isspace():
                node.text = (node.text * 31 + (word_hash(text) >> 1)) & 0x7FFFFFFFFFFFFFFF

    at, size = 0, len(source)
    while at < size:
        start, end = next_tag(source, at)
        say(source[at:start])
        at = end
        if start == end:
            break
        ends_here, tag, label, main, judged, empty = TAGS[source[start:end]]
        if not tag:
            continue
        if ends_here:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    while len(stack) > depth:
                        close()
                    break
                if stack[depth].tag in SCOPES and tag not in SCOPES:
                    break
            continue
        if tag == "br" or tag == "wbr":
            say(" " if tag == "br" else "")
            continue
        if tag in BLOCK:
            ends = ENDS.get(tag, frozenset()) | {"p"}
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends:
                    while len(stack) > depth:
                        close()
                    break
                if stack[depth].tag in SCOPES:
                    break
            flush()
        if tag in VOID:
            continue
        if tag == "head" and any(n.tag == "body" for n in stack):
            continue
        if tag in ("body", "article", "main") and stack[-1].tag != "" and any(n.tag == "head" for n in stack):
            while any(n.tag == "head" for n in stack):  # a head that was never closed
                close()
        parent = stack[-1]
        path = (parent.path * 1000003 ^ label) & 0x7FFFFFFFFFFFFFFF
        final = parent.final or judged == SILENCED or judged == FINAL and not judge
        main = main and not final
        safe = parent.safe or main
        named = judged >= (INSIDE if safe else OUTSIDE) and not judge
        low = not safe and path in branches
        kept = not final and (main or parent.kept and not (named or low))
        if parent.kept and not kept and judged != SILENCED:
            removed[0 if low else 1] += 1
        stack.append(Node(tag, path, kept, final, safe and not final))
        if tag in RAW and not empty:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            say(source[at : end.start()] if end else source[at:])
            at = end.start() if end else size
    while len(stack) > 1:
        close()
    flush()
    return blocks, nodes, removed


def extract(page: str | None, branches: frozenset[int] = frozenset()) -> str:
    return "\n".join(walk(page, branches)[0])


def _host(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


NODES = "host string, page binary, nodes array<struct<path: long, content: long, children: long>>"


def style_nodes(pages: DataFrame) -> DataFrame:
    """``host, path, content, children, n``: how many distinct pages of a host show a node so."""
    fields = pa.list_(pa.struct([(name, pa.int64()) for name in ("path", "content", "children")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found: dict[tuple[str, bytes], list[tuple[int, int, int]]] = {}
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key = _host(url), hashlib.md5((page or "").encode()).digest()
                if key not in found:
                    found[key] = [(0, 0, 0), *((path, *seen) for path, seen in walk(page, judge=True)[1].items())]
            hosts, digests = zip(*found, strict=True)
            nodes = [[dict(zip(("path", "content", "children"), n, strict=True)) for n in own] for own in found.values()]
            yield pa.record_batch(
                [pa.array(hosts, pa.string()), pa.array(digests, pa.binary()), pa.array(nodes, fields)], ["host", "page", "nodes"]
            )

    distinct = map_batches(pages.select("url", "html"), run, NODES).groupBy("host", "page").agg(F.first("nodes").alias("nodes"))
    shown = distinct.select("host", F.inline("nodes"))
    return shown.groupBy("host", "path", "content", "children").agg(F.count("*").alias("n"))


def site_branches(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``host, branches``: nodes of each host's style tree that are of low importance.

    Importance is ``1 - (1 - C) * (1 - P)``: C and P are the entropies of contents and
    of child sequences over the pages with the node, divided by the log of their number.
    """
    seen = stored(pages.sparkSession, style_nodes(pages), "nodes")
    by_content = seen.groupBy("host", "path", "content").agg(F.sum("n").alias("n"))
    by_children = seen.groupBy("host", "path", "children").agg(F.sum("n").alias("n"))

    def entropy(df: DataFrame, name: str) -> DataFrame:
        total, spread = F.sum("n"), F.sum(F.col("n") * F.log2("n"))
        return df.groupBy("host", "path").agg(total.alias("pages"), F.coalesce(1 - F.try_divide(spread, total * F.log2(total)), F.lit(1.0)).alias(name))

    nodes = entropy(by_content, "c").join(entropy(by_children, "p").drop("pages"), ["host", "path"])
    sites = nodes.where("path = 0").select("host", F.col("pages").alias("site"))
    shared = nodes.where(F.col("path") != 0).where(F.col("pages") >= s.min_pages).join(sites, "host")
    low = shared.where((F.col("pages") >= s.min_share * F.col("site")) & (1 - (1 - F.col("c")) * (1 - F.col("p")) < s.min_importance))
    return low.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("branches"))


def main_text(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, and the branches that the tree and the names removed."""
    spark = pages.sparkSession
    branches = stored(spark, site_branches(pages, s), "branches")
    size = branches.agg(F.sum(F.size("branches") * 8 + F.length("host") + 64)).first()[0] or 0
    side = F.broadcast(branches) if size <= s.broadcast_bytes else branches
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[a-zA-Z][\w+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    joined = pages.select(F.col("page_id").cast("long"), "url", "html", host.alias("host")).join(side, "host", "left")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        html, low = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        walked = [walk(page, frozenset(paths or ())) for page, paths in zip(html, low, strict=True)]
        texts = ["\n".join(blocks) for blocks, _, _ in walked]
        counts = [np.fromiter(map(len, texts), np.int64, len(texts)), *(np.array([w[2][k] for w in walked], np.int64) for k in (0, 1))]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), *map(pa.array, counts)]
        return pa.record_batch(columns, ["page_id", "url", "text", "n_chars", "n_by_tree", "n_by_name"])

    schema = "page_id long, url string, text string, n_chars long, n_by_tree long, n_by_name long"
    return map_rows(joined.select("page_id", "url", "html", "branches"), run, schema)
