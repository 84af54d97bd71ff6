"""Main text of web pages by union-free wrapper inference.

The pages of a host come from a few templates.  A page is read as a tree of
blocks whose inline content is text.  Pages of one host are aligned one after
the other: matching blocks are merged, a block that one side lacks becomes
optional, runs of alike blocks become a repeated group, and texts that differ
become a slot while equal ones stay fixed.  The result is one expression
without alternatives, the host's wrapper; it says which texts belong to the
template and which blocks hold the article on the pages that have them.  Every
page is then matched with the wrapper of its host and takes the blocks that it
has of these; a block that holds most of the page's own text is taken too, so a
page of a rare template, or without a host, is not empty.

Wrappers merge in any grouping, so each task merges its own pages first and only
small wrappers are shuffled, in two rounds; a host with most pages is no hot
group.  All pages take part and all are extracted whole.
"""
from __future__ import annotations

import hashlib
import html
import itertools
import json
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Second-round groups of a host; items of one level of a wrapper beyond which their order is given up (none is lost);
# cells of an alignment table, larger ones are halved first.
SALTS, WIDEST, TABLE = 32, 4096, 1 << 16
SHARED = 4  # different pages that share a text of the template

# HTML's kinds of elements, and names that sites give to what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
RAW = frozenset("script style title textarea noscript template svg math iframe object".split())
JUNK_TAGS = frozenset("nav footer aside form button select menu dialog fieldset head header address".split())
HOLDERS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
JUNK_NAMES = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                       "consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation "
                       "newsletter notice notification overlay pagination popup promo recommended related reply replies "
                       "respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar "
                       "topbar warning widget".split())
#: Of these, names that an article's own blocks have too, in longer names (share-price): inside an article a block of
#: such a name is junk only if it is mostly links.  Names that only add one of the plain words are no longer names.
SOFT_NAMES = frozenset("share sharing search social tags skip warning recommended related".split())
PLAIN_WORDS = frozenset("area bar block box button buttons container group icon icons inner link links list post posts row "
                        "section top bottom left right wrap wrapper".split())
HOLDER_NAMES = frozenset("article content main post story entry body text".split())
CLOSED_BY = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html article main section div nav footer aside header td th".split())

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
                    r"|</?[a-zA-Z][^<>]*\Z", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORD = re.compile(r"[a-z]+")


# ------------------------------------------------------------------ pages
class Block:
    """A block element of a page; ``kids`` holds blocks and ``Text``."""

    __slots__ = ("label", "tag", "junk", "soft", "holder", "within", "kids")

    def __init__(self, tag: str, attributes: str, within: bool = False):
        """``within``: inside an element made for an article."""
        given = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
        named = [given[k].lower() for k in ("class", "id", "role") if given.get(k)]
        words = {w for name in named for w in WORD.findall(name)}
        self.tag, self.kids = tag, []
        self.holder = tag in HOLDERS or given.get("role") == "main"
        self.within = within or self.holder
        bad = words & JUNK_NAMES if tag not in ("body", "html") else set()
        self.soft = within and bool(bad) and bad <= SOFT_NAMES and all(
            one - JUNK_NAMES - PLAIN_WORDS for one in (set(WORD.findall(n)) for name in named for n in name.split())
            if one & JUNK_NAMES)
        # a header inside an article is its headline
        by_tag = tag in JUNK_TAGS and not (within and tag == "header")
        self.junk = not self.holder and (by_tag or bool(bad) and not self.soft)
        first = (given.get("class") or "").split()
        self.label = tag + ("." + re.sub(r"\d+", "0", first[0].lower()) if first else "")
        if words & HOLDER_NAMES and not self.junk and not words & JUNK_NAMES and tag not in ("body", "html", "p"):
            self.label += "+"

    @property
    def made(self) -> bool:
        """Is the block made for an article, by its tag, role or name?"""
        return self.holder or self.label.endswith("+")


class Text:
    __slots__ = ("text", "linked")
    label = "#"

    def __init__(self, text: str, linked: int):
        self.text, self.linked = text, linked


def blocks_of(page: str) -> Block:
    """The page as a tree of blocks; unclosed and misnested elements are closed
    by the next element that cannot be inside them."""
    root = Block("#root", "")
    stack, opened, run, linked, links = [root], Counter(), [], 0, 0

    def close() -> str:
        """The last open block ends; a softly named one that is mostly links is junk."""
        block = stack.pop()
        opened[block.tag] -= 1
        if block.soft:
            said = list(texts_below(block))
            block.junk = 2 * sum(t.linked for t in said) > sum(len(t.text) for t in said)
        return block.tag

    def flush() -> None:
        nonlocal linked
        if run:
            if text := " ".join(html.unescape("".join(run)).split()):
                stack[-1].kids.append(Text(text, min(linked, len(text))))
            run.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text:
            run.append(text)
            linked += len(text) if links else 0

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() < at:
            continue
        say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in RAW:
            if not m[1]:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if end or tag in ("script", "style"):
                    at = end.end() if end else len(page)
        elif tag in INLINE:
            links = max(0, links + (0 if tag != "a" else -1 if m[1] else 1))
        elif tag in VOID:
            if tag in ("br", "hr"):
                say(" ")
        elif m[1]:
            if opened[tag]:
                flush()
                links = 0
                while close() != tag:
                    pass
        else:
            flush()
            links = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSED_BY.get(tag, ()):
                    while len(stack) > i:
                        close()
                    break
                if stack[i].tag in SCOPES:
                    break
            if stack[-1].tag == "p" and tag not in ("p",):
                close()
            block = Block(tag, m[3], stack[-1].within)
            stack[-1].kids.append(block)
            stack.append(block)
            opened[tag] += 1
    say(page[at:])
    flush()
    while len(stack) > 1:
        close()
    return root


def texts_below(node) -> Iterator[Text]:
    """All texts of a page's node in order, known junk left out."""
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, Text):
            yield x
        elif not x.junk:
            stack.extend(reversed(x.kids))


# --------------------------------------------------------------- wrappers
# An item of a wrapper: {"l": label, "n": pages, "opt": bool, "rep": bool, "kids": items} for a block or, with the
# label "(...)", a repeated group; {"l": "#", "n", "opt", "rep", "fixed": hash of the text or None, "chars", "linked",
# "seen": hashes of some pages with it} for a text.  Blocks made for an article have "own", the own characters of the pages that have them.
def _runs(labels: list[str]) -> Iterator[tuple[int, int, int]]:
    """``(first, period, times)``: labels in turn, repeated stretches of one to three taken together."""
    i = 0
    while i < len(labels):
        for period in (1, 2, 3):
            times = 1
            while labels[i : i + period] == labels[i + times * period : i + (times + 1) * period] and (
                    i + (times + 1) * period <= len(labels)):
                times += 1
            if times > 1:
                break
        else:
            period, times = 1, 1
        yield i, period, times
        i += period * times


def fold(kids: list) -> list[tuple[str, list[list]]]:
    """Labels of a level with the page's nodes behind each: repeated blocks are one
    entry, repeated stretches are one entry labelled by all of theirs."""
    out = []
    for first, period, times in _runs([k.label for k in kids]):
        parts = [kids[first + t * period : first + (t + 1) * period] for t in range(times)]
        label = parts[0][0].label if period == 1 else "(" + " ".join(k.label for k in parts[0]) + ")"
        out.append((label, parts))
    return out


def own_chars(node) -> int:
    """Characters of a page's node outside links and known junk."""
    return sum(len(t.text) - t.linked for t in texts_below(node) if 2 * t.linked <= len(t.text))


def own_texts(node) -> Iterator[str]:
    """A page's texts outside links and known junk."""
    return (t.text for t in texts_below(node) if 2 * t.linked <= len(t.text))


def any_depth() -> None:
    """Blocks may be nested to any depth; the functions that follow them call
    themselves, which takes heap and not stack."""
    sys.setrecursionlimit(1 << 30)


def dump(items: list[dict]) -> str:
    """A wrapper as JSON without nesting: items in order, each with its depth."""
    out, stack = [], [(0, x) for x in reversed(items)]
    while stack:
        depth, x = stack.pop()
        out.append([depth, "kids" in x, {k: v for k, v in x.items() if k != "kids"}])
        stack.extend((depth + 1, k) for k in reversed(x.get("kids", ())))
    return json.dumps(out)


def load(text: str) -> list[dict]:
    levels: list[list[dict]] = [[]]
    for depth, has_kids, x in json.loads(text):
        del levels[depth + 1 :]
        levels[depth].append(x)
        levels.append([])
        if has_kids:
            x["kids"] = levels[-1]
    return levels[0]


def page_items(page: str) -> list[dict]:
    """A page as a wrapper: one item for its root."""
    any_depth()
    root = blocks_of(page)
    return items_of([root], own_chars(root), hash_of("\n".join(own_texts(root)))[:16])


def hash_of(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def items_of(kids: list, own: int = 0, page: str = "") -> list[dict]:
    """A level of a page with ``own`` characters and texts of hash ``page`` as wrapper items."""
    out = []
    for label, parts in fold(kids):
        made = None
        for part in parts:
            if label[0] == "(":
                item = {"l": label, "n": 1, "opt": False, "kids": items_of(part, own, page)}
            elif isinstance(part[0], Text):
                item = {"l": "#", "n": 1, "opt": False, "fixed": hash_of(part[0].text), "chars": len(part[0].text),
                        "linked": part[0].linked, "seen": [page]}
            else:
                b = part[0]
                item = {"l": label, "n": 1, "opt": False, "junk": b.junk, "holder": b.holder, "kids": items_of(b.kids, own, page)}
                if b.made:
                    item["own"] = own
            made = item if made is None else merged(made, item)
        made.update(n=1, rep=len(parts) > 1)
        if "own" in made:
            made["own"] = own
        out.append(made)
    return out


def lengths(a: list[str], b: list[str]) -> list[int]:
    """Lengths of the longest common subsequences of ``a`` and every prefix of ``b``,
    all cells of a row at once in the bits of one number."""
    masks: dict[str, int] = {}
    for j, label in enumerate(b):
        masks[label] = masks.get(label, 0) | 1 << j
    whole = (1 << len(b)) - 1
    row = whole
    for label in a:
        met = row & masks.get(label, 0)
        row = ((row + met) | (row - met)) & whole
    return [0, *itertools.accumulate(c == "0" for c in f"{row:0{len(b)}b}"[::-1])] if b else [0]


def pairs_of(a: list[str], b: list[str]) -> list[tuple[int | None, int | None]]:
    """A longest common subsequence of two levels, with what is on one side only.
    Wide levels are halved where the halves' common subsequences are longest, so
    the memory is that of a small table."""
    if min(len(a), len(b)) > 1 and len(a) * len(b) > TABLE:
        half = len(a) // 2
        left, right = lengths(a[:half], b), lengths(a[half:][::-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: left[j] + right[len(b) - j])
        return pairs_of(a[:half], b[:cut]) + [
            (None if i is None else i + half, None if j is None else j + cut) for i, j in pairs_of(a[half:], b[cut:])]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


def merged(a: dict, b: dict) -> dict:
    """Two items of one label as one: differing texts become a slot."""
    out = {**a, "n": a["n"] + b["n"], "opt": a["opt"] or b["opt"], "rep": a.get("rep", False) or b.get("rep", False)}
    if a["l"] == "#":
        out.update(fixed=a["fixed"] if a["fixed"] == b["fixed"] else None, chars=a["chars"] + b["chars"],
                   linked=a["linked"] + b["linked"])
        out["seen"] = [] if out["fixed"] is None else sorted({*a["seen"], *b["seen"]})[:SHARED]
    else:
        out["kids"] = aligned(a["kids"], b["kids"])
        if "own" in a:
            out["own"] = a["own"] + b["own"]
    return out


def aligned(a: list[dict], b: list[dict]) -> list[dict]:
    """Two levels as one: what only one side has becomes optional.  A level that
    grows beyond ``WIDEST`` items is held as a bag: one repeated, optional item
    for each label."""
    out = []
    for i, j in pairs_of([x["l"] for x in a], [x["l"] for x in b]):
        out.append(merged(a[i], b[j]) if i is not None and j is not None else
                   {**(a[i] if j is None else b[j]), "opt": True})
    if len(out) > WIDEST:
        bag: dict[str, dict] = {}
        for item in out:
            bag[item["l"]] = merged(bag[item["l"]], item) if item["l"] in bag else item
        out = [{**x, "opt": True, "rep": True} for x in bag.values()]
    return out


def mass(item: dict) -> int:
    """Characters outside links and known junk, fixed texts left out."""
    total, stack = 0, [item]
    while stack:
        x = stack.pop()
        if x["l"] == "#":
            total += 0 if fixed(x) or 2 * x["linked"] > x["chars"] else x["chars"] - x["linked"]
        elif not x.get("junk"):
            stack.extend(x["kids"])
    return total


def fixed(item: dict) -> bool:
    """A text that several pages share at its place belongs to the template;
    copies of a page count once."""
    return len(item["seen"]) >= SHARED and item["fixed"] is not None and not item.get("rep")


def mark(root: list[dict]) -> list[dict]:
    """The wrapper with ``main`` on every block made for an article that holds at
    least half of the own text of the pages that have it, and ``fixed`` only on
    texts of the template."""
    any_depth()
    pages = root[0]["n"]
    shared: list[tuple[int, float]] = []

    def template(items: list[dict]) -> None:
        for x in items:
            if x["l"] == "#":
                if fixed(x):
                    shared.append((x["n"], (x["chars"] - x["linked"]) / x["n"]))
            elif not x.get("junk"):
                template(x["kids"])

    def walk(items: list[dict]) -> None:
        for x in items:
            if x["l"] == "#":
                x["fixed"] = x["fixed"] if fixed(x) else None
                x["notice"] = x["fixed"] is not None and 2 * x["n"] > pages
                x["linked"] = 2 * x["linked"] > x["chars"]
                x.pop("chars"), x.pop("seen")
            else:
                if "own" in x:
                    # template texts count as far as they must be on these pages
                    own = x.pop("own") - sum(max(0, x["n"] + n - pages) * chars for n, chars in shared)
                    x["main"] = 0 < own <= 2 * mass(x)
                walk(x["kids"])

    template(root)
    walk(root)
    return root


def extract(page: str, wrapper: list[dict]) -> str:
    """The texts of a page's article.  It is in the blocks made for an article
    that the wrapper knows as main or that hold half of the page's own text,
    ``<article>`` before others around or inside it, else the outermost one, or
    what in it holds all its own text if it has no more than a name; else in the
    lowest block that holds all of the page's own text, without its template and link
    texts (linked headings stay), or in all texts if that leaves none.  Known junk is
    left out."""
    any_depth()
    texts: list[tuple[str, bool, bool, bool]] = []  # with: of the template, linked, a notice
    spans: list[tuple[int, int]] = []  # of the texts of every block, outer blocks behind inner ones
    named: list[tuple[int, int, Block, bool]] = []

    def walk(kids: list, items: list[dict] | None, tag: str = "") -> None:
        level = fold(kids)
        found: dict[int, dict] = {}
        if items is not None:
            for i, j in pairs_of([x[0] for x in level], [x["l"] for x in items]):
                if i is not None and j is not None:
                    found[i] = items[j]
            by_label = {x["l"]: x for x in items}
            for i, (label, _) in enumerate(level):
                if i not in found and label in by_label:
                    found[i] = by_label[label]
        for i, (label, parts) in enumerate(level):
            item = found.get(i)
            for part in parts:
                node = part[0]
                if label[0] == "(":
                    walk(part, item["kids"] if item else items, tag)
                elif label == "#":
                    known = bool(item and item["fixed"]) and item["fixed"] == hash_of(node.text)
                    linked = item["linked"] if item else 2 * node.linked > len(node.text)
                    texts.append((node.text, known, linked and tag not in HEADINGS,
                                  known and bool(item.get("notice")) and tag not in HEADINGS))
                    weights.append(0 if known or linked else len(node.text) - node.linked)
                elif not node.junk:
                    first = len(texts)
                    walk(node.kids, item["kids"] if item else None, node.tag)
                    if len(texts) > first:
                        spans.append((first, len(texts)))
                        if node.made:
                            named.append((first, len(texts), node, bool(item and item["main"])))

    weights: list[int] = []
    walk([blocks_of(page)], wrapper)
    sums = [0, *itertools.accumulate(weights)]
    total = sums[-1]
    weight = lambda span: sums[span[1]] - sums[span[0]]
    held = [x for x in named if x[3] or 2 * weight(x) >= total]
    strong = [x for x in held if x[2].tag == "article"]
    apart = [x for x in held if not any(x[0] < y[1] and y[0] < x[1] for y in strong)]
    for x in [x for x in apart if not any(y is not x and y[0] <= x[0] and x[1] <= y[1] and (
            (y[0], y[1]) != (x[0], x[1]) or apart.index(y) > apart.index(x)) for y in apart)]:
        # inner blocks come first
        strong.append(x if x[2].holder or not weight(x) else next(y for y in apart if x[0] <= y[0] and y[1] <= x[1] and weight(y) == weight(x)))
    if chosen := strong:
        # notices that all pages share are no part of the article; its headings are
        keep = {i for x in chosen for i in range(x[0], x[1]) if not texts[i][3]}
    else:
        first, end = next((x for x in spans if weight(x) == total > 0), (0, len(texts)))
        keep = {i for i in range(first, end) if not texts[i][1] and not texts[i][2]}
    # a page that has any text gives some
    keep = keep or {i for i, x in enumerate(texts) if not x[2]} or set(range(len(texts)))
    return " ".join(texts[i][0] for i in sorted(keep))


# ------------------------------------------------------------------ Spark
def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, wrapper)``: one wrapper for each host, as JSON."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[dict]] = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                items = page_items(page.as_py())
                held[host] = aligned(held[host], items) if host in held else items
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([dump(w) for w in held.values()], pa.string())],
                ["host", "wrapper"])

    def merge(frame):
        import pandas as pd

        any_depth()
        whole = None
        for one in sorted(frame["wrapper"]):
            whole = load(one) if whole is None else aligned(whole, load(one))
        return pd.DataFrame({"host": frame["host"].iloc[:1], "wrapper": [dump(whole)]})

    schema = "host string, wrapper string"
    parts = rows.mapInArrow(own, schema).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    once = parts.groupBy("host", "salt").applyInPandas(merge, schema)
    return once.groupBy("host").applyInPandas(lambda f: merge(f).assign(
        wrapper=lambda g: [dump(mark(load(w))) for w in g["wrapper"]]), schema)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, url, text, n_chars)`` for every page: its article, blocks joined
    by one space, white space inside a block made one space, character references
    decoded; ``n_chars`` in code points.

    Texts of any length and blocks of any depth and number are read whole.  Where more
    than half of a host's pages hold the same text at the same place of the article,
    and at least ``SHARED`` different ones do, it is a notice of the template and goes;
    headings stay.

    Null html is an empty page and gives the empty text; null urls and urls
    without a host are one host; repeated rows each get a row; ids may be null.
    Other columns are ignored.  An empty table gives an empty result.
    """
    known = materialize(wrappers(pages, url_col, html_col), "wrappers")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    met = rows.join(known, "host").select("id", "url", "html", "wrapper")

    def pull(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, list[dict]] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch.column("html"), batch.column("wrapper").to_pylist(), strict=True):
                if wrapper not in read:
                    if len(read) > 1000:
                        read.clear()
                    read[wrapper] = load(wrapper)
                texts.append(extract(page.as_py(), read[wrapper]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kind = met.schema["id"].dataType.simpleString()
    return met.mapInArrow(pull, f"id {kind}, url string, text string, n_chars bigint").withColumnRenamed("id", id_col)
