"""Main text of web pages by wrapper inference: a union-free regular expression for the pages of a host.

A page is a stream of tags and texts. Its children streams, element by element, are aligned with those of the pages seen
before. What one side lacks becomes optional. A token met again after others turns the stretch between into a repeated
group, and so do tokens that two streams have in different order. Texts become slots. The result has sequences, optional
and repeated groups only, no alternatives; its size is bounded by the different tags (with their class words) that an
element of the host ever holds, not by the number of pages or of paragraphs.

Alignment is associative, so each partition folds its own pages, and the wrappers of a host are aligned in two levels over
many tasks; the pages of a large host never meet. A wrapper then tells which of its slots belong to the article, and each
page's texts are taken from those slots.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inciscope.llm.common import slices
from inciscope.session import materialise

#: Elements nested deeper than this are part of the one above them; their texts are kept.
DEPTH = 64
#: Tags opened inside so many open ones are left out, their texts kept.
OPEN = 256
#: Wrappers a partition holds before it hands them on, and partitions whose wrappers are aligned in one task.
HELD_WRAPPERS, FAN = 2000, 256
#: Class words of an element's key; further ones do not tell elements apart.
KEY_WORDS = 6
#: A child holding this share of its parent's text takes over the search for the main text.
MAIN_SHARE = 0.6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr".split()
)
UNSEEN = frozenset("script style template noscript".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: An opening tag ends an open one of these, unless one of the second kind stands between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
BOUNDARY = frozenset("article aside main section body table td th nav footer header form button".split())

ASIDE_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe button select option textarea input svg canvas object"
    " dialog menu title map audio video".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay"
    " newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments"
    " reply replies disqus widget widgets toolbar pagination pager search hidden copyright skip form".split()
)
HEAD_WORDS = frozenset("header".split())
NOT_ASIDE = frozenset("has no not with without is".split())
TEXT = "#"

ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Node:
    """An element: its key and its children, in page order; a text child is (text, block number)."""

    key: str
    children: list = field(default_factory=list)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): kind is ``open``, ``close`` or ``text``. Comments, scripts and the like are left
    out. Linear in the length of the page, however broken."""
    at, low, n = 0, None, len(page)
    last_quote = {q: page.rfind(q) for q in "\"'"}
    last_end = page.rfind(">")
    while at < n:
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:], ""
            return
        mark = page[start + 1 : start + 2]
        named = mark.isascii() and mark.isalpha()
        closing = mark == "/" and page[start + 2 : start + 3].isascii() and page[start + 2 : start + 3].isalpha()
        if not (named or closing or mark in ("!", "?", "/")) or mark == "":
            yield "text", page[at : start + 1], ""
            at = start + 1
            continue
        if start > at:
            yield "text", page[at:start], ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        if start > last_end:  # a tag that never ends
            return
        end = page.find(">", start)
        if not (named or closing):
            at = end + 1
            continue
        head = page[start + 1 : end]
        if '"' in head or "'" in head:
            end = _tag_end(page, start + 1, last_quote, last_end)
            head = page[start + 1 : end]
        at = end + 1
        parts = head.lstrip("/").split(None, 1)
        name = parts[0].split("/", 1)[0].lower()
        if closing:
            yield "close", name, ""
            continue
        yield "open", name, parts[1] if len(parts) > 1 else ""
        if name in RAW:
            low = page.lower() if low is None else low
            if len(low) != n:  # lower case changed the length: search the page itself
                found = re.compile(f"</{name}", re.I).search(page, at)
                close = found.start() if found else -1
            else:
                close = low.find(f"</{name}", at)
            at = n if close < 0 else close


def _tag_end(page: str, at: int, last_quote: dict[str, int], last_end: int) -> int:
    """The ``>`` of a tag, those within quoted values left out; a quote that is never closed is an ordinary letter."""
    first = end = page.find(">", at)
    while True:
        quotes = [q for q in (page.find('"', at, end), page.find("'", at, end)) if q >= 0]
        if not quotes:
            return end
        q = min(quotes)
        if last_quote[page[q]] <= q:
            return end
        at = page.find(page[q], q + 1) + 1
        if at > end:
            if at > last_end:
                return first
            end = page.find(">", at)


@lru_cache(maxsize=4096)
def class_words(attributes: str) -> tuple[str, ...]:
    """Words of an element's classes, id and role, class by class joined by ``-``; names with digits are left out."""
    names: list[str] = []
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and INVISIBLE.search(value)):
            names.append("hidden")
        elif name in ("class", "id", "role"):
            for own in value.lower().split():
                words = [w for w in re.split(r"[\W_]+", own) if w and not any(c.isdigit() for c in w)]
                if words:
                    names.append("-".join(words))
    return tuple(sorted(set(names))[:KEY_WORDS])


def parse(page: str | None) -> Node:
    """The tree of a page, whatever is missing or left open in it."""
    root = Node("")
    names, nodes = [""], [root]
    left_out: Counter[str] = Counter()
    block = 0

    def pop_to(k: int) -> None:
        del names[k:], nodes[k:]

    for kind, name, attributes in tokens(page or ""):
        if kind == "text":
            nodes[-1].children.append((name, block))
            continue
        inline = name in INLINE
        if not inline and name not in UNSEEN:
            block += 1
        if kind == "close":
            if left_out[name]:
                left_out[name] -= 1
                continue
            for k in range(len(names) - 1, 0, -1):
                if names[k] == name:
                    pop_to(k)
                    break
                if inline and names[k] not in INLINE:
                    break
            continue
        if name == "br":
            nodes[-1].children.append((" ", block))
            continue
        if name in VOID:
            continue
        if name in CLOSES_P:
            k = len(names) - 1
            while names[k] in INLINE:
                k -= 1
            if names[k] == "p":
                pop_to(k)
        if name in ENDS:
            ended, kept = ENDS[name]
            for k in range(len(names) - 1, 0, -1):
                if names[k] in ended:
                    pop_to(k)
                    if names[k - 1] not in ended:
                        break
                elif names[k] in kept or names[k] in BOUNDARY:
                    break
        if len(names) > OPEN:
            left_out[name] += 1
            continue
        words = class_words(attributes) if attributes else ()
        if inline and name != "a":
            words = tuple(w for w in words if is_aside(w))
        if (inline and name != "a" and not words) or len(names) > DEPTH:
            names.append(name)  # no element of its own: its texts belong to the one around it
            nodes.append(nodes[-1])
            continue
        node = Node(".".join((name, *words)))
        nodes[-1].children.append(node)
        names.append(name)
        nodes.append(node)
    return root


def is_aside(name: str, head: bool = False) -> bool:
    """Whether a class name speaks of menus, adverts and the like: by its first or last word."""
    words = name.split("-")
    wanted = ASIDE_WORDS | HEAD_WORDS if head else ASIDE_WORDS
    return words[0] in wanted or (words[-1] in wanted and not NOT_ASIDE & set(words[:-1]))


# --- wrappers -----------------------------------------------------------------------------------------------------------


@dataclass
class Wrapper:
    """An element's expression: children keys in ``groups``, in order. A group of several keys is repeated, each of its
    keys optional; a group of one is that key alone, repeated if it is among ``many``, optional if it was in fewer than
    ``n`` of the elements."""

    n: int = 0
    groups: list[list[str]] = field(default_factory=list)
    many: set[str] = field(default_factory=set)
    within: dict[str, int] = field(default_factory=dict)
    children: dict[str, Wrapper] = field(default_factory=dict)
    chars: int = 0
    #: A checksum of the element's own text, 0 for none; -1 once it has differed.
    same: int = 0

    def packed(self) -> list:
        kids = {k: v.packed() for k, v in self.children.items()}
        return [self.n, self.groups, sorted(self.many), self.within, kids, self.chars, self.same]

    @classmethod
    def unpacked(cls, data: list) -> Wrapper:
        n, groups, many, within, kids, chars, same = data
        return cls(n, groups, set(many), within, {k: cls.unpacked(v) for k, v in kids.items()}, chars, same)

    def merge(self, other: Wrapper) -> None:
        """Align another expression of the same element with this one."""
        if other.groups != self.groups:
            self.groups = aligned(self.groups, other.groups)
        self.many |= other.many
        for key, count in other.within.items():
            self.within[key] = self.within.get(key, 0) + count
        for key, child in other.children.items():
            if key in self.children:
                self.children[key].merge(child)
            else:
                self.children[key] = child
        self.same = self.same if self.same == other.same or not self.n else -1
        if not self.n:
            self.same = other.same
        self.n += other.n
        self.chars += other.chars

    def expression(self, key: str = "") -> str:
        """The element as a regular expression over tags and ``#`` for texts."""
        inner = []
        for group in self.groups:
            parts = []
            for k in group:
                own = TEXT if k == TEXT else self.children[k].expression(k)
                repeated, optional = k in self.many, len(group) > 1 or self.within[k] < self.n
                mark = "*" if repeated and optional else "+" if repeated else "?" if optional else ""
                parts.append(f"(?:{own}){mark}" if mark else own)
            inner.append(f"(?:{''.join(parts)})+" if len(group) > 1 else parts[0])
        body = "".join(inner)
        return f"<{re.escape(key)}>{body}</{re.escape(key)}>" if key else body


def aligned(a: list[list[str]], b: list[list[str]]) -> list[list[str]]:
    """Groups that hold both sequences: groups sharing a key, and groups that the two have in different order, are one."""
    rank: dict[str, int] = {}
    for group in (*a, *b):
        for key in group:
            rank.setdefault(key, len(rank))
    after: dict[str, set[str]] = {k: set() for k in rank}
    for side in (a, b):
        for group in side:
            for x, y in zip(group, group[1:] + group[:1]):
                if x != y:
                    after[x].add(y)  # a ring: keys of a group stay together
        for x, y in zip(side, side[1:]):
            after[x[-1]].add(y[0])
    return [sorted(c, key=rank.__getitem__) for c in components(after, rank)]


def components(after: dict[str, set[str]], rank: dict[str, int]) -> list[list[str]]:
    """Strongly connected components in an order that follows the edges (Tarjan, without recursion)."""
    index: dict[str, int] = {}
    low: dict[str, int] = {}
    open_, on, out = [], set(), []
    for start in sorted(rank, key=rank.__getitem__, reverse=True):
        if start in index:
            continue
        work = [(start, iter(sorted(after[start], key=rank.__getitem__, reverse=True)))]
        index[start] = low[start] = len(index)
        open_.append(start)
        on.add(start)
        while work:
            node, rest = work[-1]
            for nxt in rest:
                if nxt not in index:
                    index[nxt] = low[nxt] = len(index)
                    open_.append(nxt)
                    on.add(nxt)
                    work.append((nxt, iter(sorted(after[nxt], key=rank.__getitem__, reverse=True))))
                    break
                if nxt in on:
                    low[node] = min(low[node], index[nxt])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == index[node]:
                    found = []
                    while True:
                        top = open_.pop()
                        on.discard(top)
                        found.append(top)
                        if top == node:
                            break
                    out.append(found)
    return out[::-1]


def infer(node: Node) -> Wrapper:
    """The expression of one element: equal keys beside each other are a repetition, a key met again after others makes
    the stretch between a repeated group."""
    out = Wrapper(n=1)
    stretches: list[list[str]] = []
    place: dict[str, int] = {}
    text = []
    for child in node.children:
        if isinstance(child, Node):
            key = child.key
            found = infer(child)
            if key in out.children:
                out.children[key].merge(found)
            else:
                out.children[key] = found
        else:
            if not child[0] or child[0].isspace():
                continue
            key = TEXT
            text.append(child[0])
            if stretches and stretches[-1] == [TEXT]:
                continue  # texts beside each other are one
        if key not in place:
            place[key] = len(stretches)
            stretches.append([key])
            out.within[key] = 1
            continue
        at = place[key]
        if at == len(stretches) - 1:
            if len(stretches[at]) == 1:
                out.many.add(key)
            continue
        joined = [k for s in stretches[at:] for k in s]
        stretches[at:] = [joined]
        for k in joined:
            place[k] = at
    out.groups = stretches
    if text:
        own = "".join(text)
        out.chars = len(own) - own.count(" ")
        out.same = zlib.crc32(own.encode("utf-8", "surrogatepass")) or 1
    return out


def kind_of(root: Node) -> str:
    """Pages of one host are of several kinds: with an article, with a main part, with neither."""
    kinds, work = set(), [root]
    while work:
        for child in work.pop().children:
            if isinstance(child, Node):
                kinds.add(child.key.split(".", 1)[0])
                work.append(child)
    return next((k for k in ("article", "main") if k in kinds), "page")


# --- what a wrapper's slots are -----------------------------------------------------------------------------------------


def content_slots(wrapper: Wrapper, kind: str) -> list[str]:
    """Paths of the elements whose texts are the article's."""
    chars: dict[str, int] = {}
    links: dict[str, int] = {}
    holds: dict[str, set[str]] = {}

    def measure(w: Wrapper, path: str, key: str, in_link: bool) -> None:
        tag = key.split(".", 1)[0]
        in_link = in_link or tag == "a"
        holds[path] = {tag}
        chars[path], links[path] = w.chars, w.chars if in_link else 0
        for k, child in w.children.items():
            measure(child, f"{path}>{k}", k, in_link)
            holds[path] |= holds[f"{path}>{k}"]
            chars[path] += chars[f"{path}>{k}"]
            links[path] += links[f"{path}>{k}"]

    def aside(path: str, key: str, in_region: bool) -> bool:
        tag, *names = key.split(".")
        if tag in ASIDE_TAGS or (tag == "header" and not in_region and not holds[path] & {"article", "main"}):
            return True
        if tag in ("html", "body") or (tag != "article" and not in_region and holds[path] & {"article", "main"}):
            return False
        return any(is_aside(name, head=not in_region) for name in names)

    measure(wrapper, "", "", False)
    regions: list[tuple[Wrapper, str]] = []

    def seek(w: Wrapper, path: str) -> None:
        for k, child in w.children.items():
            own = f"{path}>{k}"
            if aside(own, k, False):
                continue
            if k.split(".", 1)[0] == kind:
                regions.append((child, own))
            else:
                seek(child, own)

    if kind != "page":
        seek(wrapper, "")
        dense = [r for r in regions if 2 * links[r[1]] <= chars[r[1]]]
        regions = dense or regions
    if not regions:
        regions = [_main_part(wrapper, chars, links, aside)]
    out: list[str] = []

    def keep(w: Wrapper, path: str) -> None:
        if w.chars:
            out.append(path)
        for k, child in w.children.items():
            own = f"{path}>{k}"
            if aside(own, k, True):
                continue
            block = k.split(".", 1)[0] not in INLINE
            if kind == "page" and block and chars[own] and 2 * links[own] > chars[own]:
                continue  # a list of links
            keep(child, own)

    for w, path in regions:
        keep(w, path)
    if kind == "page" and wrapper.n > 1:
        varied = [p for p in out if _at(wrapper, p).same == -1]
        out = varied or out  # texts that never change are not the article, unless none does
    return out


def _main_part(w: Wrapper, chars: dict[str, int], links: dict[str, int], aside) -> tuple[Wrapper, str]:
    """From the root down, the element that holds most of its parent's text outside links, as long as there is one."""
    path = ""
    while True:
        own = {
            k: chars[f"{path}>{k}"] - links[f"{path}>{k}"]
            for k, child in w.children.items()
            if k.split(".", 1)[0] not in INLINE and not aside(f"{path}>{k}", k, False)
        }
        best = max(own, key=own.get, default=None)
        total = sum(own.values()) + w.chars
        if best is None or best in w.many or own[best] < MAIN_SHARE * total or best.split(".", 1)[0] == "p" or not own[best]:
            return w, path
        w, path = w.children[best], f"{path}>{best}"


def _at(w: Wrapper, path: str) -> Wrapper:
    for key in path.split(">")[1:]:
        w = w.children[key]
    return w


def main_text(root: Node, slots: frozenset[str]) -> str:
    """Texts of the given slots in page order: references decoded, white space made one space, blocks joined by line ends."""
    blocks: list[list[str]] = []
    at = -1
    work: list[tuple[Iterator, str, bool]] = [(iter(root.children), "", "" in slots)]
    while work:
        children, path, wanted = work[-1]
        for child in children:
            if isinstance(child, Node):
                own = f"{path}>{child.key}"
                work.append((iter(child.children), own, own in slots))
                break
            if wanted:
                if child[1] != at:
                    at = child[1]
                    blocks.append([])
                blocks[-1].append(child[0])
        else:
            work.pop()
    lines = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


# --- on Spark -----------------------------------------------------------------------------------------------------------


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z made small; empty without one."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _sources(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    url = pages[url_col].cast("string")
    return pages.select(
        pages[id_col].cast("long").alias("page_id"), url.alias("url"), host(url).alias("host"),
        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"),
    )


Key = tuple[str, str]


def _rows(held: dict[Key, Wrapper]) -> pa.RecordBatch:
    columns = [
        pa.array([k[0] for k in held], pa.string()),
        pa.array([k[1] for k in held], pa.string()),
        pa.array([json.dumps(w.packed()) for w in held.values()], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["host", "kind", "wrapper"])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to one wrapper for each host and kind of page, in parts if there are very many."""
    held: dict[Key, Wrapper] = {}
    for batch in slices(batches):
        for name, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            root = parse(page)
            held.setdefault((name, kind_of(root)), Wrapper()).merge(infer(root))
        if len(held) > HELD_WRAPPERS:
            yield _rows(held)
            held = {}
    if held:
        yield _rows(held)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first columns to one row for each (host, kind)."""
    key, total = None, Wrapper()
    for batch in slices(batches):
        for name, kind, packed in zip(*(batch.column(c).to_pylist() for c in ("host", "kind", "wrapper"))):
            if key is not None and key != (name, kind):
                yield _rows({key: total})
                total = Wrapper()
            key = name, kind
            total.merge(Wrapper.unpacked(json.loads(packed)))
    if key is not None:
        yield _rows({key: total})


SCHEMA = "host string, kind string, wrapper string"


def wrappers(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, kind, wrapper): the aligned expression of all pages of each host and kind, as ``Wrapper.packed`` in JSON."""
    found = _sources(pages, id_col, url_col, html_col).select("host", "html").mapInArrow(_folded, SCHEMA)
    found = found.withColumn("place", F.floor(F.spark_partition_id() / FAN))
    found = found.repartition("host", "kind", "place").sortWithinPartitions("host", "kind", "place")
    found = found.mapInArrow(_aligned, SCHEMA)
    return found.repartition("host", "kind").sortWithinPartitions("host", "kind").mapInArrow(_aligned, SCHEMA)


def slots(found: DataFrame) -> DataFrame:
    """(host, slots): for each host the paths of its content, by kind of page, in JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "wrapper")))
            paths = [json.dumps(content_slots(Wrapper.unpacked(json.loads(w)), kind)) for kind, w in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(paths)], ["host", "kind", "slots"])

    each = found.mapInArrow(run, "host string, kind string, slots string")
    return each.groupBy("host").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("kind", "slots")))).alias("slots"))


@lru_cache(maxsize=1024)
def _parsed_slots(packed: str) -> dict[str, frozenset[str]]:
    return {kind: frozenset(json.loads(paths)) for kind, paths in json.loads(packed).items()}


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = []
        for page, packed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            root = parse(page)
            texts.append(main_text(root, _parsed_slots(packed)[kind_of(root)]))
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of each row of ``pages``.

    A null or empty page has empty text, as has one without an article. Pages without a host share one wrapper. Repeated
    rows and null ids stay; tags left open, cut off or nested out of order are taken as browsers roughly do. Only the id,
    url and html columns are read.
    """
    per_host = materialise(slots(wrappers(pages, id_col, url_col, html_col)), "slots")
    sources = _sources(pages, id_col, url_col, html_col)
    # Spark broadcasts the slots by their size or, beyond it, joins by host and splits hot hosts
    joined = sources.join(per_host, "host", "left").select("page_id", "url", "html", "slots")
    return joined.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
