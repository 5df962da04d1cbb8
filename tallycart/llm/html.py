"""Main text of web pages by consensus host paths.

First pass: every page's containers are scored by the words they hold outside links and page furniture; the best
container's path (tags with their classes, digits generalised) is the page's vote. Votes are summed per host in Spark and
each host keeps the ``paths`` with the most votes, if they have a quarter of the first one's (ties to the smaller path).
Second pass: a page is extracted from all its containers with a winning path, or from its own best one if it has none, and
from any other container with notable text off these - unless the container's path is part of the host's template: found
on half of its pages or more, and no winner, as a long teaser beside short texts is. A container beside which notable text
stands gives way to the one around both.

Blocks are cut where block-level tags open or close. Menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, hidden parts and reader comments are left out by tag, role, class or id, but what holds most of a page's words or
of its article's isn't furniture: a form around the whole page, a hidden body, a header that is an article's own. Pages are read whole; null counts as
empty and gives an empty text. A null or odd url counts as a host of its own name. Repeated pages are extracted alike;
extra columns are left aside; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycart.llm.common import texts_of
from tallycart.session import staged

# A tag, comment, declaration or the raw content of script-like elements; what isn't one is text.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)", re.DOTALL
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*+)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>\"']++))?")
RAW = frozenset(("script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object"))
RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE) for name in RAW}
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are no part of the main text, and those that are none unless they hold most of it.
FURNITURE = frozenset(("head", "nav", "footer", "aside", "menu", "button", "select", "label", "search", *RAW))
MOSTLY = frozenset(("header", "form", "dialog", "fieldset"))
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"))
#: Words of classes and ids that mark page furniture.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "footer header login masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related "
    "replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
CLOSES_P = BLOCK - {"body", "html", "head"}
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = frozenset(("ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "aside", "nav", "footer", "header", "form", "blockquote"))
SPACE = re.compile(r"\s+")
NAME = re.compile(r"[A-Za-z]+|[0-9]+")


@dataclass
class Node:
    tag: str
    path: str
    parent: int
    out: bool
    linked: bool
    marked: str = ""


@dataclass
class Page:
    """Elements in page order, and runs of text with their element; None stands for a block's edge."""

    nodes: list[Node] = field(default_factory=list)
    runs: list[tuple[int, str] | None] = field(default_factory=list)


#: What may follow a mark at the start of a name, as in sidebar-left.
TAILS = frozenset("list area box bar block wrap wrapper container inner section posts links items left right top bottom slot unit buttons form".split())
SPARING = frozenset(("with", "has", "no", "without"))
#: Marks of what others wrote: left out however long it is.
OTHERS = frozenset("comment comments commentlist disqus related replies reply respond".split())


def mark(tag: str, attributes: dict[str, str], inside: bool) -> str:
    """The mark of page furniture: an element's own kind, its role, that it is hidden, or in a class or id a whole name, its
    last part, or its first before mere position words. The header of an article (``inside`` one) is its own."""
    if tag in MOSTLY and not (tag == "header" and inside):
        return tag
    if attributes.get("role", "").lower() in ROLES:
        return "role"
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return "hidden"
    if tag in ("body", "html", "article", "main"):
        return ""
    found = ""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = [w.lower() for w in NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name)) if not w.isdigit()]
        if not parts or SPARING & set(parts):
            continue
        here = parts[-1] if parts[-1] in MARKS else parts[0] if parts[0] in MARKS and TAILS.issuperset(parts[1:]) else ""
        found = here if here in OTHERS else found or here
    return found


def settle(page: Page) -> None:
    """Marked elements go out, but one that holds most of the page's words outside links, or of its articles'; no mark
    counts if no text would be left."""
    nodes = page.nodes
    if not any(n.marked for n in nodes):
        return
    words, article, within = [0] * len(nodes), [0] * len(nodes), [False] * len(nodes)
    for k, n in enumerate(nodes):
        within[k] = n.tag in ("article", "main") or k > 0 and within[n.parent]
    for run in page.runs:
        if run and not nodes[run[0]].out and not nodes[run[0]].linked:
            words[run[0]] += len(run[1].split())
    for k in range(len(nodes) - 1, -1, -1):
        if within[k]:
            article[k] = words[k]
    for k in range(len(nodes) - 1, 0, -1):
        words[nodes[k].parent] += words[k]
        article[nodes[k].parent] += article[k]
    out = [False] * len(nodes)
    for k, n in enumerate(nodes):
        if not k:
            continue
        most = words[k] * 2 > words[0] or article[k] * 2 > article[0]
        out[k] = n.out or out[n.parent] or bool(n.marked) and (n.marked in OTHERS or not most)
    if any(run and not out[run[0]] and run[1].strip() for run in page.runs):
        for n, gone in zip(nodes, out, strict=True):
            n.out = gone


def step(tag: str, attributes: dict[str, str]) -> str:
    """One part of a path: the tag and its classes in order, runs of digits as one mark."""
    classes = sorted({re.sub(r"[0-9]+", "#", c) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes])


def parse(html: str) -> Page:
    page = Page()
    nodes, runs = page.nodes, page.runs
    nodes.append(Node("", "", -1, False, False))
    stack = [0]
    at, end = 0, len(html)
    while at < end:
        m = TAG.search(html, at)
        until = m.start() if m else end
        if until > at:
            runs.append((stack[-1], html[at:until]))
        if not m:
            break
        at = m.end()
        closing, tag = m.group(1), m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag in BLOCK:
                runs.append(None)
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    del stack[depth:]
                    break
                if tag not in LIMITS and nodes[stack[depth]].tag in LIMITS:
                    break  # a stray end tag doesn't close its container
            continue
        if tag in BLOCK:
            runs.append(None)
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == "p":
                    del stack[depth:]
                    break
                if nodes[stack[depth]].tag in LIMITS:
                    break
        for name in IMPLIED.get(tag, ()):
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == name:
                    del stack[depth:]
                    break
                if nodes[stack[depth]].tag in LIMITS:
                    break
        raw = m.group(3) or ""
        if tag in VOID:
            if tag == "br":
                runs.append((stack[-1], " "))
            continue
        if tag in RAW:
            if not raw.rstrip().endswith("/"):
                close = RAW_END[tag].search(html, at)
                at = close.end() if close else end
            continue
        attributes = {}
        if raw and not raw.isspace():
            for a in ATTRIBUTE.finditer(raw):
                attributes.setdefault(a.group(1).lower(), unescape((a.group(2) or "").strip("\"'")))
        above = nodes[stack[-1]]
        out = above.out or tag in FURNITURE
        inside = any(nodes[k].tag in ("article", "main") for k in stack)
        path = f"{above.path}/{step(tag, attributes)}" if tag in BLOCK else above.path
        nodes.append(Node(tag, path, stack[-1], out, above.linked or tag == "a", mark(tag, attributes, inside)))
        stack.append(len(nodes) - 1)
    settle(page)
    return page


CONTAINERS = frozenset(("article", "main", "section", "div", "body", "td", "blockquote", "center", "details"))
#: What share of the words in inner containers counts for an outer one.
WHOLE = {"article": 1.0, "main": 0.9}


#: Words outside links beside the best container, and their share of its own, from which its parent is taken.
NOTABLE, NOTABLE_SHARE = 10, 0.05

def containers(page: Page) -> tuple[list[int], list[float], list[float]]:
    """The nearest container of each node; per container its words outside links and furniture less those in links, with
    all inner ones, and with a share of the inner ones that halves with each level."""
    nodes = page.nodes
    box = [0] * len(nodes)
    for k, n in enumerate(nodes):
        box[k] = k if n.tag in CONTAINERS else box[n.parent] if k else 0
    full = [0.0] * len(nodes)
    for run in page.runs:
        if run and not nodes[run[0]].out:
            words = len(run[1].split())
            full[box[run[0]]] += -words if nodes[run[0]].linked else words
    fading = list(full)
    for k in range(len(nodes) - 1, 0, -1):
        if box[k] == k:
            up = box[nodes[k].parent]
            full[up] += full[k]
            fading[up] += fading[k] / 2
    return box, full, fading


def best_box(page: Page, box: list[int], full: list[float], fading: list[float]) -> int | None:
    """The container with the highest score (article and main count nearly all inner words), or the one around it as long
    as notable text stands beside it."""
    nodes = page.nodes
    scores = [(full[k] * WHOLE[n.tag] if n.tag in WHOLE else fading[k], k) for k, n in enumerate(nodes) if k and box[k] == k]
    score, k = max(scores, default=(0.0, 0))
    if score <= 0:
        return None
    best, up = k, box[nodes[k].parent]
    while up:
        if full[up] - full[best] >= max(NOTABLE, NOTABLE_SHARE * full[best]):
            best = up
        up = box[nodes[up].parent]
    return best


def voted(page: Page) -> tuple[str | None, set[str]]:
    """The path of the best container, and those of all containers with text."""
    box, full, fading = containers(page)
    best = best_box(page, box, full, fading)
    held = {n.path for k, n in enumerate(page.nodes) if k and box[k] == k and full[k] > 0}
    return None if best is None else page.nodes[best].path, held


def extract(page: Page, paths: list[str], template: list[str] = []) -> tuple[str, str | None]:  # noqa: B006
    """The text under all of the host's paths that the page has (or under its own best container), and under other containers
    with notable text off them whose path isn't one of the host's ``template``; and these paths."""
    nodes = page.nodes
    own = {n.path for n in nodes}
    used = [p for p in paths if p in own]
    box, full, fading = containers(page)

    def under(chosen: set[str], without: set[str] = frozenset()) -> list[bool]:
        within = [False] * len(nodes)
        for k, n in enumerate(nodes):
            within[k] = not n.out and (not chosen or n.path in chosen or (n.parent >= 0 and within[n.parent] and n.path not in without))
        return within

    if used:
        within, shared = under(set(used)), set(template) - set(used)
        off = [0] * len(nodes)
        for run in page.runs:
            if run and not within[run[0]] and not nodes[run[0]].out:
                off[run[0]] += -len(run[1].split()) if nodes[run[0]].linked else len(run[1].split())
        for k in range(len(nodes) - 1, 0, -1):
            if nodes[k].path not in shared:
                off[nodes[k].parent] += off[k]
        more = {n.path for k, n in enumerate(nodes) if k and box[k] == k and not n.out and off[k] >= NOTABLE and n.path not in shared} - set(used)
        if more:
            beside = under(more, shared)
            within = [a or b for a, b in zip(within, beside, strict=True)]
            used += sorted(more)
    else:
        best = best_box(page, box, full, fading)
        used = [] if best is None else [nodes[best].path]
        within = under(set(used))
    blocks, current = [], []
    for run in [*page.runs, None]:
        if run is None:
            if current:
                text = SPACE.sub(" ", "".join(current)).strip()
                if text:
                    blocks.append(text)
                current = []
        elif within[run[0]]:
            current.append(unescape(run[1]))
    return "\n".join(blocks), " ".join(dict.fromkeys(used)) or None


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", paths: int = 3) -> DataFrame:
    """Per page: id, url, text and its length in code points, and the path it came from."""
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    slim = slim.withColumn("host", F.coalesce(F.nullif(F.lower(F.regexp_extract("url", HOST, 1)), F.lit("")), F.lit("")))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            won, seen, pages = Counter(), Counter(), Counter()
            for host, html in zip(batch.column("host").to_pylist(), texts_of(batch.column("html")), strict=True):
                path, held = voted(parse(html))
                pages[host] += 1
                won.update([(host, path)] if path else [])
                seen.update((host, p) for p in held)
            keys = [*seen, *(k for k in won if k not in seen), *((host, None) for host in pages)]
            columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string())]
            columns += [pa.array([won[k] for k in keys], pa.int64()), pa.array([pages[k[0]] if k[1] is None else seen[k] for k in keys], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["host", "path", "n", "seen"])

    counts = slim.select("host", "html").mapInArrow(vote, "host string, path string, n long, seen long")
    counts = staged(counts.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")), "votes")
    votes = counts.where("path is not null and n > 0")
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "path"))
    most = F.max("n").over(Window.partitionBy("host"))
    top = votes.withColumn("rank", rank).withColumn("most", most).where((F.col("rank") <= paths) & (F.col("n") * 4 >= F.col("most")))
    winners = top.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"]).alias("paths"))
    pages_of = counts.where("path is null").select("host", F.col("seen").alias("pages"))
    rest = counts.where("path is not null").join(pages_of, "host").where("seen * 2 >= pages").join(top.select("host", "path"), ["host", "path"], "left_anti")
    template = rest.groupBy("host").agg(F.array_sort(F.collect_set("path")).alias("template"))  # what half of the pages have: a page's worth or two
    winners = staged(winners.join(template, "host", "left"), "winning-paths")  # of known size: Spark broadcasts it if small, else both sides are shuffled
    joined = slim.join(winners, "host", "left").select("page_id", "url", "html", "paths", "template")
    kind = dict(slim.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = (texts_of(batch.column("html")), batch.column("paths").to_pylist(), batch.column("template").to_pylist())
            found = [extract(parse(h), p or [], t or []) for h, p, t in zip(*given, strict=True)]
            texts = [x[0] for x in found]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[1] for x in found], pa.string())], ["page_id", "url", "text", "n_chars", "path"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, path string")
