"""Main text of pages by equivalence-class template deduction.

A page is read into elements and text blocks. An element's token is its path of tags with their class and id names; an
unnamed container also has its place among its like. A token's occurrence vector says how often it occurs in each page
of the host. Vectors are compared by the sums of two random numbers of each page times the count, which is linear, so a
host's pages meet only in aggregates, and repeated pages count as often as they are there.

1. Unnamed containers whose tokens by place all have one vector are told apart by place; others are one token.
2. Tokens with one vector are an equivalence class. A class is valid if its outermost tokens nest in one other class;
   tokens that have its vector but nest elsewhere have it by chance. Valid classes make the template.
3. The content root is sought downwards from the outermost class: to a container of the same class, or of one nested
   directly in it, that holds nearly all text (not in links) of its like. A host with little text leans on the shares
   that all pages together have: these count as `prior` characters. The search ends at an `article` or `main`, which is
   the content by HTML's own definition, and where text stands directly beside the next container. If no container
   holds nearly all, an `article` or `main` is the tie-break.
4. The rest are slots. Those in template elements beside the root are dropped. Below the root, text stays but for
   elements that HTML defines as menus, footers, asides, forms and the like, and, as the last tie-break, elements whose
   whole name says advert, notice, comments or another of the words below; and, where the root is no article or
   main, for lists of links and for template elements whose text is the same on `least_pages` pages or more, if their
   pages differ.

A page without its host's root uses the root of all pages, or its own article, or all of itself.

Nulls and ties: null, empty and textless html give an empty text; a null url is a host of its own; repeated rows
are pages of their own; very long and broken pages are read whole, open elements ending with the page; no rows give no
rows. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, scratch
from .url_reputation import url_parts

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|[^<]+|<", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=\d)")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"[0-9]{3,}")

VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
SILENT = frozenset("script style noscript template iframe svg canvas object textarea select title audio video".split())
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr li main nav ol p pre section summary table caption thead tbody tfoot tr td th ul menu".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CONTAINERS = frozenset("html body div section center table tbody tr td main article".split())
#: Containers that are told apart by place if they have no name.
PLACED = frozenset("div section center table td".split())
#: An open element of the second set ends when one of the first starts, up to the third.
CLOSES = [(BLOCK, {"p"}, BLOCK - {"p"}), ({"li"}, {"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dt", "dd"}, {"dl"}), ({"td", "th"}, {"td", "th"}, {"tr", "table"}), ({"tr"}, {"tr", "td", "th"}, {"table"}), ({"tbody", "tfoot", "thead"}, {"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), ({"option"}, {"option"}, {"select"})]
#: What HTML defines as no main content.
FOREIGN_TAGS = frozenset("nav footer aside form button dialog menu head header".split())
#: Words that say so in a name, and words that may stand beside them in it.
FOREIGN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner notice notices notification cookie cookies consent gdpr popup "
    "overlay modal nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar toolbar comment comments commentlist disqus "
    "social share sharing newsletter subscribe pagination pager widget".split()
)
PLAIN_WORDS = frozenset("box bar list area wrapper wrap container section block slot unit top bottom left right inner outer links buttons site global sticky fixed header signup".split())


def _key(tag: str, attributes: str) -> str:
    """Tag, class, id and role names with long numbers as 0, so that a page's own number makes no path of its own. Ids
    are marked by a number sign. An article or main has no names: they are often the page's own."""
    if not attributes or "=" not in attributes or tag in ("article", "main"):
        return tag
    names = sorted({"#" * (m[1].lower() == "id") + _DIGITS.sub("0", x) for m in _NAMES.finditer(attributes) for x in (m[2] or m[3] or m[4] or "").lower().split()})
    return ".".join([tag, *(n.replace("/", "_").replace("~", "_") for n in names)])


def tag_of(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0].partition("~")[0]


def boilerplate_name(key: str) -> bool:
    """Whether a class, id or role consists of words of boilerplate, and of plain words beside them. Headings aren't:
    their names are often made from their words."""
    tag, *names = key.partition("~")[0].split(".")
    if tag in HEADINGS:
        return False
    for n in names:
        words = [w for w in _PARTS.split(n) if w and not w.isdigit()]
        if any(w in FOREIGN_WORDS for w in words) and all(w in FOREIGN_WORDS or w in PLAIN_WORDS for w in words):
            return True
    return False


class Page:
    """elements: how often each path occurs; blocks: (path, text, characters in links) in page order. An unnamed
    container's path has its place among the containers of its parent with the same tag, after a tilde."""

    def __init__(self, source: str):
        self.elements: Counter[str] = Counter()
        self.blocks: list[tuple[str, str, int]] = []
        self._stack: list[tuple[str, str, Counter[str]]] = []  # tag, path, unnamed containers in it
        self._outer: Counter[str] = Counter()
        self._text: list[str] = []
        self._link = self._links = 0
        at, end = 0, len(source)
        while at < end:
            m = _TOKEN.match(source, at)
            at, token = m.end(), m.group()
            if token[0] != "<" or token == "<":
                self._add(token)
            elif m[2]:
                tag = m[2].lower()
                if m[1]:
                    self._end(tag)
                elif tag in SILENT and not m[3].endswith("/"):
                    close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                    at = close.end() if close else end
                else:
                    self._start(tag, m[3])
            elif token.startswith("<![CDATA["):
                self._add(token[9:-3])
        self._flush()

    def _add(self, text: str) -> None:
        self._text.append(text)
        if self._link:
            self._links += len(text)

    def _flush(self) -> None:
        if self._text:
            text = _SPACE.sub(" ", entities.unescape("".join(self._text))).strip()
            if text:
                path = next((p for tag, p, _ in reversed(self._stack) if tag in BLOCK), "")
                self.blocks.append((path, text, min(self._links, len(text))))
            self._text, self._links = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text.append(" ")
        if tag in BLOCK:
            self._flush()
        for opens, ends, limit in CLOSES:
            if tag in opens:
                for i in range(len(self._stack) - 1, -1, -1):
                    if self._stack[i][0] in ends:
                        self._pop(i)
                    elif self._stack[i][0] in limit:
                        break
        key = _key(tag, attributes)
        if tag in PLACED and key == tag:
            places = self._stack[-1][2] if self._stack else self._outer
            places[tag] += 1
            key = f"{tag}~{places[tag]}"
        path = f"{self._stack[-1][1]}/{key}" if self._stack else key
        self.elements[path] += 1
        if tag not in VOID and not attributes.endswith("/"):
            self._stack.append((tag, path, Counter()))
            self._link += tag == "a"

    def _pop(self, i: int) -> None:
        self._link -= sum(t == "a" for t, _, _ in self._stack[i:])
        del self._stack[i:]

    def _end(self, tag: str) -> None:
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] == tag:
                if any(t in BLOCK for t, _, _ in self._stack[i:]):
                    self._flush()
                self._pop(i)
                return


# ---------------------------------------------------------------- occurrence vectors

_STATS = "host string, path string, pages long, times long, v1 long, v2 long, chars long, links long, low long, high long, below long"
_SUMS = ("pages", "times", "v1", "v2", "chars", "links", "below")


def page_numbers(tie: int) -> tuple[int, int]:
    """Two random numbers of 24 bits for a page: sums of counts times these stand for occurrence vectors."""
    h = xxhash.xxh64_intdigest(str(tie))
    return h & 0xFFFFFF, (h >> 24) & 0xFFFFFF


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed per batch: for each host and path the pages that have it, how often, the vector's two sums, characters,
    characters in links, the least and greatest hash of its texts, and the characters that are in no link of it and all
    below it, outside what HTML defines as no main content. The path '' counts the pages."""
    names = [x.split()[0] for x in _STATS.split(", ")]
    for batch in batches:
        sums: dict[tuple[str, str], list[int]] = {}
        for hosts, ids, sources in pieces(batch, "host", "tie", "html"):
            for host, i, source in zip(hosts, ids, sources, strict=True):
                page = Page(source or "")
                texts: dict[str, list] = defaultdict(list)
                under: Counter[str] = Counter()
                for path, text, links in page.blocks:
                    texts[path].append((text, links))
                    if links < len(text) and not any(tag_of(k) in FOREIGN_TAGS for k in path.split("/")):
                        up = path
                        while up:
                            under[up] += len(text) - links
                            up = up.rpartition("/")[0]
                        under[""] += len(text) - links
                r1, r2 = page_numbers(i)
                for path, n in [("", 1), *page.elements.items()]:
                    own = texts.get(path, ())
                    told = xxhash.xxh64_intdigest("\n".join(t for t, _ in own)) >> 1
                    new = [1, n, n * r1, n * r2, sum(len(t) for t, _ in own), sum(k for _, k in own), told, told, under[path]]
                    if (old := sums.get((host, path))) is None:
                        sums[host, path] = new
                    else:
                        sums[host, path] = [*(a + b for a, b in zip(old[:6], new[:6], strict=True)), min(old[6], told), max(old[7], told), old[8] + new[8]]
        if sums:
            columns = [[h for h, _ in sums], [p for _, p in sums], *(list(c) for c in zip(*sums.values(), strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k < 2 else pa.int64()) for k, c in enumerate(columns)], names=names)


def _merged(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(*(F.sum(c).alias(c) for c in _SUMS), F.min("low").alias("low"), F.max("high").alias("high"))


# ---------------------------------------------------------------- templates

ALL = "\0all"


@dataclass
class Token:
    """What is known of a path over the pages of a host."""

    pages: int = 0
    times: int = 0
    v1: int = 0
    v2: int = 0
    chars: int = 0
    links: int = 0
    low: int = 1 << 63
    high: int = -1
    below: int = 0

    def add(self, r) -> None:
        self.pages = max(self.pages, r.pages)
        for c in _SUMS[1:]:
            setattr(self, c, getattr(self, c) + getattr(r, c))
        self.low, self.high = min(self.low, r.low), max(self.high, r.high)

    @property
    def vector(self) -> tuple[int, int, int, int]:
        return self.pages, self.times, self.v1, self.v2


def canonical(path: str, split: set[str], known: dict[str, str]) -> str:
    """The path with the places of those containers alone that the template tells apart by place."""
    if not path:
        return ""
    if (found := known.get(path)) is None:
        above, _, key = path.rpartition("/")
        base = canonical(above, split, known)
        bare, _, place = key.partition("~")
        found = f"{base}/{bare}" if base else bare
        if place and found in split:
            found += f"~{place}"
        known[path] = found
    return found


def differentiated(rows: list) -> tuple[dict[str, Token], set[str]]:
    """(tokens by path, containers told apart by place): of the unnamed containers of a parent those are told apart
    whose tokens by place, two or more, have one vector, which means that every page with the parent has as many."""
    split: set[str] = set()
    known: dict[str, str] = {}
    levels: dict[int, list] = defaultdict(list)
    for r in rows:
        levels[r.path.count("/")].append(r)
    out: dict[str, Token] = {}
    for depth in sorted(levels):
        by_key: dict[str, dict[str, Token]] = defaultdict(lambda: defaultdict(Token))
        for r in levels[depth]:
            above, _, key = r.path.rpartition("/")
            base = canonical(above, split, known)
            bare, _, place = key.partition("~")
            by_key[f"{base}/{bare}" if base else bare][place].add(r)
        for path, places in by_key.items():
            if len(places) > 1 and len({t.vector for t in places.values()}) == 1:
                split.add(path)
                out.update((f"{path}~{place}", t) for place, t in places.items())
            else:
                for t in places.values():
                    out.setdefault(path, Token()).add(t)
    return out, split


def classes_of(tokens: dict[str, Token]) -> dict[str, int]:
    """Path to number of its equivalence class, valid classes only. A class nests in one other: that above its outermost
    tokens. Tokens with its vector that nest elsewhere share it by chance and aren't the template's; if the outermost
    ones nest in several classes, the class is invalid."""
    groups: dict[tuple, list[str]] = defaultdict(list)
    for path, t in tokens.items():
        groups[t.vector].append(path)
    where: dict[str, int] = {}
    for k, members in enumerate(sorted(groups.values(), key=lambda g: (min(p.count("/") for p in g), min(g)))):
        inside = set(members)
        above = {p: _above(p, tokens) for p in members}
        outer = {p: tokens[above[p]].vector if above[p] else None for p in members if above[p] not in inside}
        depth = min(p.count("/") for p in outer)
        parents = {v for p, v in outer.items() if p.count("/") == depth}
        if len(parents) > 1:
            continue
        for path in sorted(members, key=lambda p: p.count("/")):
            if where.get(above[path]) == k or path in outer and outer[path] in parents:
                where[path] = k
    return where


def _above(path: str, known) -> str:
    """The nearest known element above a path, or ''."""
    path = path.rpartition("/")[0]
    while path and path not in known:
        path = path.rpartition("/")[0]
    return path


@dataclass
class Template:
    """root: the content root; split: containers told apart by place; beside: outermost template elements beside the
    root; dropped: elements inside it whose own text is the template's or a menu."""

    root: str = ""
    split: set[str] = field(default_factory=set)
    beside: set[str] = field(default_factory=set)
    dropped: set[str] = field(default_factory=set)


#: A container that holds this share of the text of its like is the next content root.
NEARLY_ALL = 0.8
#: Text that is the same wherever it stands, on this share of the pages, is the template's.
FIXED_SHARE = 0.9


def deduce(rows: pd.DataFrame, shares: dict[str, float] | None = None, prior: float = 20_000.0, least_pages: int = 3) -> Template:
    """The template of the pages whose tokens these are. shares: of all pages' text the share below each path."""
    tokens, split = differentiated([r for r in rows.itertuples() if r.path])
    n_pages = int(rows.loc[rows["path"] == "", "pages"].sum())
    where = classes_of(tokens)
    shares = shares or {}
    inside: dict[str, list[str]] = defaultdict(list)  # template elements by the template element above
    for path in where:
        inside[_above(path, where)].append(path)
    fixed = lambda p: tokens[p].low == tokens[p].high and tokens[p].pages >= max(least_pages, FIXED_SHARE * n_pages)
    mass = lambda p: tokens[p].below + prior * shares.get(p, 0.0)

    def other(at: str) -> int:
        """Characters below an element that are in no template element below it."""
        whole = tokens[at].below if at else int(rows.loc[rows["path"] == "", "below"].sum())
        return whole - sum(tokens[p].below for p in inside[at])

    def direct(at: str) -> int:
        """Characters that stand in an element, or in its elements that are no containers, and vary."""
        return sum(tokens[p].below for p in inside[at] if tag_of(p) not in CONTAINERS | FOREIGN_TAGS and not fixed(p)) + (tokens[at].chars - tokens[at].links if at and not fixed(at) else 0)

    root = ""
    while tag_of(root) not in ("article", "main"):
        near = [p for p in inside[root] if tag_of(p) in CONTAINERS]  # of the root's class or of one nested in it
        best = max(near, key=lambda p: (mass(p), p), default=None)
        if best is None or tokens[best].below == 0 or direct(root) > 0.02 * mass(best):
            break
        held = sum(tokens[p].below for p in near)
        if mass(best) * held < NEARLY_ALL * sum(map(mass, near)) * (held + other(root)):
            best = max((p for p in near if tag_of(p) in ("article", "main")), key=lambda p: (mass(p), p), default=None)
            if best is None:
                break
        root = best
    over = lambda p: root.startswith(p + "/")
    beside = {p for p in where if root and p != root and not p.startswith(root + "/") and not over(p) and (not (up := _above(p, where)) or over(up))}
    own = tag_of(root) in ("article", "main")
    slots = [] if own else [p for p in where if tokens[p].chars and (not root or p.startswith(root + "/"))]
    varies = other(root) > 0 or not all(map(fixed, slots))  # copies of one page tell nothing
    dropped = set()
    for path in slots:
        t, key = tokens[path], path.rpartition("/")[2]
        if varies and fixed(path) and ("." in key or tag_of(root) in ("", "html", "body")) and tag_of(path) not in HEADINGS:
            dropped.add(path)  # a part of the template
        elif t.links > 0.8 * t.chars and tag_of(path) == "li":
            dropped.add(path)  # a menu
    return Template(root, split, beside, dropped)


_TEMPLATE = "host string, n_pages long, root string, split array<string>, beside array<string>, dropped array<string>"


def templates(pages: DataFrame, least_share: float = 0.1, prior: float = 20_000.0, least_pages: int = 3) -> DataFrame:
    """pages(host, tie, html): the template of every host, and of all pages under the name ALL. A group has the tokens
    that a tenth of its pages have, and of ten pages or more two, so it is bounded by the pages' own size; text of other
    tokens is in the sums of those above them, and `extract` keeps it unless a template element beside the root holds it.
    The shares of all pages, as bounded, are one row's worth for the driver."""
    rows = pages.select("host", "tie", "html").mapInArrow(_vectors, _STATS)
    by_host = scratch(_merged(rows, "host", "path"), "template-tokens")

    def frequent(tokens: DataFrame, count: DataFrame) -> DataFrame:
        return tokens.join(count, "host").where((F.col("pages") >= F.col("n_pages") * least_share) & ((F.col("pages") > 1) | (F.col("n_pages") * least_share < 1))).drop("n_pages")

    counts = by_host.where("path = ''").select("host", F.col("pages").alias("n_pages"))
    n_pages = counts.agg(F.coalesce(F.sum("n_pages"), F.lit(0)).alias("n")).first().n
    least = max(1.0, n_pages * least_share)
    whole = _merged(by_host, "path").where(F.col("pages") >= least).withColumn("host", F.lit(ALL)).select(*by_host.columns).toPandas()
    total = float(whole.loc[whole["path"] == "", "below"].sum())
    # of the text of all pages, by path and by path without places
    shares: Counter[str] = Counter()
    for r in whole.itertuples():
        if total and r.path:
            shares[r.path] += r.below / total
            if "~" in r.path:
                shares[canonical(r.path, set(), {})] += r.below / total

    def group(g: pd.DataFrame) -> pd.DataFrame:
        t = deduce(g, shares, prior, least_pages)
        return pd.DataFrame({"host": [g["host"].iloc[0]], "n_pages": [int(g.loc[g["path"] == "", "pages"].sum())], "root": [t.root], "split": [sorted(t.split)], "beside": [sorted(t.beside)], "dropped": [sorted(t.dropped)]})

    spark = pages.sparkSession
    everyone = spark.createDataFrame(group(whole), _TEMPLATE) if len(whole) else spark.createDataFrame([], _TEMPLATE)
    own = frequent(by_host, counts).groupBy("host").applyInPandas(group, _TEMPLATE)
    return scratch(own.unionByName(everyone), "templates")


# ---------------------------------------------------------------- extraction


def extract(page: Page, template: Template, everyone: Template) -> str:
    """The text of the page's slots that the template keeps. Outside a root that is no article or main, text goes if it
    is in an element of the template; in an element that the template doesn't have it stays, being another layout's."""
    known: dict[str, str] = {}
    there = {canonical(p, template.split, known) for p in page.elements}
    if template.root and template.root not in there:  # another layout: that of all pages, its own article, or all
        known, there = {}, {canonical(p, everyone.split, {}) for p in page.elements}
        if everyone.root and everyone.root in there:
            template = everyone
        else:
            named = [p for p in {canonical(p, set(), {}) for p in page.elements} if tag_of(p) in ("article", "main")]
            template = Template(min(named, key=lambda p: (tag_of(p) != "article", len(p), p), default=""))
    root, out = template.root, []
    own = tag_of(root) in ("article", "main")
    for raw, text, _ in page.blocks:
        path = canonical(raw, template.split, known)
        if not root or path == root or path.startswith(root + "/"):
            keys = path[len(root) :].strip("/").split("/") if path != root else []
        elif own or root.startswith(path + "/") or path in template.beside or _above(path, template.beside):
            continue
        else:
            keys = path.split("/")
        tags = [tag_of(k) for k in keys]
        foreign = [t for t in tags if t in FOREIGN_TAGS]
        if foreign and own and tags[-1] in HEADINGS and set(foreign) == {"header"}:
            foreign = []  # an article's own title
        if not foreign and path not in template.dropped and not any(map(boilerplate_name, keys)):
            out.append(text)
    return "\n".join(out)


def _template(root, split, beside, dropped) -> Template:
    return Template(root, set(split or ()), set(beside or ()), set(dropped or ()))


def _extracted(everyone: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, urls, roots, splits, besides, drops, sources in pieces(batch, "page_id", "url", "root", "split", "beside", "dropped", "html"):
                found = [_template(*t) for t in zip(roots, splits, besides, drops, strict=True)]
                texts = [extract(Page(s or ""), t, everyone) for t, s in zip(found, sources, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return run


def main_text(pages: DataFrame, least_share: float = 0.1, prior: float = 20_000.0, least_pages: int = 3) -> DataFrame:
    """pages(page_id, url, html): page_id, url, text, n_chars. Templates are joined by host: the planner broadcasts
    them where their table is small, else AQE splits a hot host."""
    host, _ = url_parts(F.col("url"))
    keyed = pages.select("page_id", "url", host.alias("host"), F.xxhash64("page_id", "url").alias("tie"), "html")
    found = templates(keyed, least_share, prior, least_pages)
    row = found.where(F.col("host") == ALL).first()
    joined = keyed.join(found.where(F.col("host") != ALL).select("host", "root", "split", "beside", "dropped"), "host").select("page_id", "url", "root", "split", "beside", "dropped", "html")
    run = _extracted(_template(row["root"], row["split"], row["beside"], row["dropped"]) if row else Template())
    return joined.mapInArrow(run, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
