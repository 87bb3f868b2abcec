"""Main text of web pages by consensus host paths.

Every page scores its containers by the running text they hold; its best ones vote for their
generalised tag and class paths within the page's host. The path with the most votes, and paths beside it
with half as many or more (an article in several parts), are then used to extract all pages of that host
again. A page without a container there uses its own best one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import escape, unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewright.llm.scratch import Scratch
from pacewright.llm.url_filter import parts

#: Containers of a page that vote; the share of the winner's votes with which a path beside it wins too.
VOTES, BESIDE = 3, 0.5
#: Bytes of hosts and paths up to which they are broadcast; elements within elements up to which a tree grows deeper.
BROADCAST_BYTES, DEEPEST = 32 << 20, 2_000

_MARKUP = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:_-]*))")
_EDGE = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
_DROPPED = _RAW | {"head", "nav", "footer", "aside", "form", "button", "select", "svg", "canvas", "dialog", "object", "video", "audio", "menu", "map", "math"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rb", "rt", "rp"}
#: An opening tag ends an open element of these kinds, up to the nearest one of the second set.
_IMPLIED = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_CONTAINERS = {"body", "div", "article", "main", "section", "td", "blockquote", "center"}
_ASIDE = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|sidebar|side-bar|footer|masthead|topbar|ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|cookie|cookies|consent|gdpr|notice|notices|alert"
    r"|comment|comments|commentlist|adsbygoogle|disqus|replies|respond|promo|promotion|share|sharing|social|related|recommended|popup|modal|overlay|newsletter|subscribe|signup|breadcrumb|breadcrumbs|pagination|pager|widget|toolbar|skip|hidden)(?:$|[\s_-])",
    re.I,
)
_HEADER = re.compile(r"(?:^|\s)(?:(?:site|page|main|global|top)[_-])?header(?:$|\s)", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Elements whose class and id say nothing about their part of the page.
_NAMED_FREELY = {"html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar"}


class Node:
    __slots__ = ("tag", "step", "parent", "children", "dropped", "container", "article")

    def __init__(self, tag: str, step: str, parent: Node | None, dropped: bool):
        self.tag, self.step, self.parent, self.dropped = tag, step, parent, dropped
        self.children: list[Node | str] = []
        #: The nearest container and the nearest article, itself included.
        self.container: Node | None = self if tag in _CONTAINERS else parent and parent.container
        self.article: Node | None = self if tag == "article" else parent and parent.article

    @property
    def path(self) -> str:
        steps, node = [], self
        while node is not None:
            steps.append(node.step)
            node = node.parent
        return "/".join(reversed(steps))


def _node(tag: str, attributes: str, parent: Node) -> Node:
    in_article = parent.article is not None
    own = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    names = own.get("class", "")
    step = ".".join([tag, *sorted({re.sub(r"\d+", "#", x.lower()) for x in names.split()})]).replace("/", "|")
    dropped = tag in _DROPPED or tag == "header" and not in_article or "hidden" in own or own.get("aria-hidden", "") == "true" or own.get("role", "").lower() in _ROLES
    if tag not in _NAMED_FREELY:
        marks = _CAMEL.sub("-", f"{names} {own.get('id', '')}")
        dropped = dropped or bool(_ASIDE.search(marks)) or not in_article and bool(_HEADER.search(marks))
    return Node(tag, step, parent, dropped or bool(re.search(r"display\s*:\s*none", own.get("style", ""))))


class _Markup:
    """Tokens of a page: (text before, tag, whether it closes, attributes). Each byte is read a fixed number of times, however the markup is broken."""

    def __init__(self, page: str):
        self.page, self.lost = page, set()  # what isn't in the rest of the page

    def _find(self, what: str, at: int) -> int:
        if what in self.lost:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.lost.add(what)
        return found

    def _past(self, what: str, at: int) -> int:
        found = self._find(what, at)
        return len(self.page) if found < 0 else found + len(what)

    def _tag_end(self, at: int) -> int:
        """The ``>`` of a tag, or -1; values in quotes, which follow an equals sign, may hold others."""
        while m := _EDGE.search(self.page, at):
            at = m.end()
            if m[0] == ">":
                return m.start()
            back = m.start() - 1
            while self.page[back].isspace():
                back -= 1
            if self.page[back] == "=" and (end := self._find(m[0], at)) >= 0:
                at = end + 1
        return -1

    def tokens(self) -> Iterator[tuple[str, str, bool, str]]:
        page, at = self.page, 0
        while m := _MARKUP.search(page, at):
            text, tag = page[at : m.start()], (m[2] or "").lower()
            if tag:
                end = -1 if ">" in self.lost else self._tag_end(m.end())
                if end < 0:  # a tag without an end takes the rest of the page with it
                    self.lost.add(">")
                    yield text, "", False, ""
                    return
                yield text, tag, bool(m[1]), page[m.end() : end]
                at = end + 1
                if tag in _RAW and not m[1]:
                    close = re.compile(rf"</{tag}\b", re.I).search(page, at)
                    at = self._past(">", close.end()) if close else len(page)
            elif m[0] == "<![CDATA[":
                at = self._past("]]>", m.end())
                yield text, "", False, ""
                yield escape(page[m.end() : at].removesuffix("]]>"), quote=False), "", False, ""
            else:
                at = self._past("-->" if m[0] == "<!--" else ">", m.end())
                yield text, "", False, ""
        yield page[at:], "", False, ""


def parse(page: str) -> Node:
    """The element tree; unclosed and stray tags are tolerated, texts are decoded. Time grows with the page's length and not faster."""
    root = Node("", "", None, False)
    stack, open_ = [root], Counter()

    def close(depth: int) -> None:
        open_.subtract(x.tag for x in stack[depth:])
        del stack[depth:]

    for text, tag, closes, attributes in _Markup(page).tokens():
        if text:
            stack[-1].children.append(unescape(text))
        if closes:
            if open_[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
        elif tag:
            if tag not in _INLINE and tag not in _VOID:
                # a block ends an open paragraph, and some elements their own kind
                kinds, bounds = _IMPLIED.get(tag, (set(), set()))
                i = len(stack) - 1 if open_["p"] > 0 or any(open_[x] > 0 for x in kinds) else 0
                while i > 0:
                    if stack[i].tag == "p" or stack[i].tag in kinds:
                        close(i)
                    elif stack[i].tag in bounds or stack[i].tag not in _INLINE and not kinds:
                        break
                    i -= 1
            node = _node(tag, attributes, stack[-1])
            stack[-1].children.append(node)
            if tag not in _RAW and tag not in _VOID and not attributes.endswith("/") and len(stack) <= DEEPEST:
                stack.append(node)
                open_[tag] += 1
    return root


def blocks(node: Node) -> list[tuple[Node, str, int]]:
    """(block element, text, characters in links) of the text blocks below a node in page order, dropped parts left out."""
    found: list[tuple[Node, str, int]] = []
    texts: list[str] = []
    linked = 0
    owner = node

    def flush() -> None:
        nonlocal linked
        if text := " ".join("".join(texts).split()):
            found.append((owner, text, min(linked, len(text))))
        texts.clear()
        linked = 0

    work: list[tuple[Node, Iterator[Node | str], Node, bool]] = [(node, iter(node.children), node, False)]
    while work:
        here, rest, own, link = work[-1]
        child = next(rest, None)
        if child is None:
            work.pop()
            if here.tag not in _INLINE:
                flush()
                owner = work[-1][2] if work else node
        elif isinstance(child, str):
            texts.append(child)
            linked += len(child.strip()) if link else 0
        elif not child.dropped:
            if child.tag in _INLINE:
                work.append((child, iter(child.children), own, link or child.tag == "a"))
            else:
                flush()
                owner = child
                work.append((child, iter(child.children), child, link))
    flush()
    return found


def candidates(root: Node) -> list[tuple[float, Node]]:
    """The containers of a page by falling score: running text counts wholly for the nearest one, half for the next."""
    score: dict[int, float] = {}
    nodes: dict[int, Node] = {}
    for owner, text, linked in blocks(root):
        weight = (len(text) - linked) * (1 - linked / len(text))
        if len(text) < 25:
            weight /= 4
        node, share = owner.container, 1.0
        while node is not None and share >= 0.5:
            score[id(node)] = score.get(id(node), 0.0) + weight * share
            nodes[id(node)] = node
            share /= 2
            node = node.parent and node.parent.container
    merged: dict[int, float] = {}
    for key, value in score.items():
        node = nodes[key].article or nodes[key]
        nodes[id(node)] = node
        merged[id(node)] = max(merged.get(id(node), 0.0), value)
    return sorted(((v, nodes[k]) for k, v in merged.items()), key=lambda x: -x[0])


def _headline(root: Node, found: list[Node]) -> list[Node]:
    """The page's first h1 where none stands in the containers: one before them, whose parent holds them all."""
    if any(isinstance(x, Node) and x.tag in ("h1", "h2") for node in found for x in node.children):
        return []
    around, node = [], found[0].parent
    while node is not None:
        around.append(node)
        node = node.parent
    below = {id(x) for x in [found[0], *around]}
    for node in around:
        for child in node.children:
            if id(child) in below:
                break
            if isinstance(child, Node) and child.tag == "h1" and not child.dropped:
                return [child]
    return []


def text_at(root: Node, paths: list[str] | None) -> str:
    """The text of the outermost containers at some paths, in page order; of the page's best one if there is none."""
    steps = [p.split("/") for p in paths or []]
    found, work = [], [(root, 0, steps)] if steps else []
    while work:
        node, depth, left = work.pop()
        left = [x for x in left if x[depth] == node.step]
        if any(len(x) == depth + 1 for x in left):
            found.append(node)
        elif left:
            work += [(x, depth + 1, left) for x in reversed(node.children) if isinstance(x, Node) and not x.dropped]
    texts = lambda nodes: "\n".join(t for node in nodes for _, t, _ in blocks(node))
    if not found or not texts(found):
        found = [node for _, node in candidates(root)[:1]]
    return (texts(_headline(root, found) + found) if found else "") or texts([root])


def votes(pages: DataFrame) -> DataFrame:
    """host, path, votes: the best containers' paths, weighed in thousandths of the page's best score and summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                best = candidates(parse(page or ""))[:VOTES]
                rows += [(host, node.path, round(1000 * (value / best[0][0]) ** 2)) for value, node in best if value > 0]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["host", "path", "votes"])

    return pages.select("host", "html").mapInArrow(run, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, path (the consensus of the page's host) of every page.

    Text blocks are joined by line ends, white space in them is one space. Null html gives the empty
    text; pages without a host (a null url too) have no consensus and use their own best container;
    repeated rows are each extracted; an empty table gives an empty result; other columns are ignored. Of
    paths with equal votes the last in order of text wins. Whole pages are read in time that grows with
    their length; elements nested deeper than ``DEEPEST`` hang side by side from the last level.
    """
    scratch = Scratch(pages.sparkSession)
    pages = pages.select("page_id", "url", "html").withColumn("host", parts(F.col("url"))[0])
    ballot = scratch.save(votes(pages.where("host <> ''")))
    best = ballot.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("best"))
    nested = F.startswith(F.concat("path", F.lit("/")), F.concat("best.path", F.lit("/"))) | F.startswith(F.concat("best.path", F.lit("/")), F.concat("path", F.lit("/")))
    beside = ballot.join(best, "host").where(~nested & (F.col("votes") >= BESIDE * F.col("best.votes"))).groupBy("host").agg(F.collect_set("path").alias("more"))
    winners = best.join(beside, "host", "left").select("host", F.col("best.path").alias("path"), F.concat(F.array("best.path"), F.array_sort(F.coalesce("more", F.array().cast("array<string>")))).alias("paths"))
    winners = scratch.save(winners)
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length(F.array_join("paths", "")) + F.octet_length("path") + 64).alias("n")).first().n or 0
    placed = pages.join(F.broadcast(winners) if size <= BROADCAST_BYTES else winners, "host", "left").select("page_id", "url", "html", "path", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_at(parse(page or ""), paths) for page, paths in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), batch.column(3)], ["page_id", "url", "text", "n_chars", "path"])

    return placed.mapInArrow(run, "page_id long, url string, text string, n_chars long, path string")
