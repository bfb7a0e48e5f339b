"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Every paragraph passes points for its length and its commas to its parent and, at
half, to its grandparent; a container's points are discounted by the share of its text that stands in links. The best
container is taken with those of its siblings that score well or read like prose. Parts that are never article text
(menus, headers, footers, sidebars, forms, scripts, notices, adverts, reader comments, by element or by class and id words) do not
take part; parts that may be either (related links, sharing, tags) go only where at least half their text stands in links.

Parsing takes time linear in the page: every tag is scanned once, end tags of elements that are not open are
skipped by a count, and elements below ``MAX_DEPTH`` levels hang on the deepest level, with all their text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_TAG = re.compile(r"<!--|<!\[CDATA\[|<[!?]|</?[A-Za-z]")
_STOP = re.compile("[>\"']")
_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.I)
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "title", "svg", "object", "noframes"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_DROP = _RAW | set("nav header footer aside form button select option input label fieldset dialog menu head audio video canvas".split())
_BLOCK = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
_UNLIKELY = set("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner banners
comment comments disqus replies reply respond sidebar side rail widget widgets nav navbar navigation menu menus breadcrumb
breadcrumbs pagination pager footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal
overlay subscribe subscription newsletter signup login outbrain taboola""".split())
#: Words of parts that go only if they are mostly links.
_LINKS = set("share sharing social related recommended recommendations tags".split())
_LIKELY = {"article", "main", "content", "post", "entry", "story", "body", "text"}
_CLOSES_P = _BLOCK - {"html", "body"}
_SAME = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
         "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_COMMAS = ",،、，"
MAX_DEPTH = 512


class Node:
    __slots__ = ("tag", "words", "parent", "items", "points", "drop", "depth")

    def __init__(self, tag: str, parent: Node | None = None, words: frozenset[str] = frozenset(), drop: bool = False) -> None:
        self.tag, self.parent, self.words, self.drop = tag, parent, words, drop
        self.items: list[Node | str] = []
        self.points = 0.0
        self.depth: int = parent.depth + 1 if parent is not None else 0


def _attributes(token: str) -> tuple[frozenset[str], bool]:
    """Words of class, id and role; whether the element is hidden."""
    words: set[str] = set()
    hidden = False
    for name, *values in _ATTR.findall(token, _NAME.match(token).end()):
        value, name = next((v for v in values if v), "").lower(), name.lower()
        if name in ("class", "id", "role"):
            words.update(re.split(r"[\s_-]+", value))
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    return frozenset(words), hidden


class _Tags:
    """Ends of tags, each page position looked at once: a ``>`` outside quotes, where a quote that never closes is none."""

    def __init__(self, page: str) -> None:
        self.page, self.last = page, page.rfind(">")
        self.closing = {q: page.rfind(q) for q in "\"'"}
        self.plain = False  # a scan came to the end of the page: from now on the next ">" ends a tag

    def end(self, at: int) -> int:
        """Position after the tag that starts at ``at``; -1 if nothing closes it."""
        if at > self.last:
            return -1
        if not self.plain:
            here = at + 1
            while m := _STOP.search(self.page, here):
                if m.group() == ">":
                    return m.end()
                quote = m.group()
                here = self.page.index(quote, m.end()) + 1 if m.start() < self.closing[quote] else m.end()
            self.plain = True
        return self.page.index(">", at) + 1


def parse(page: str) -> Node:
    """A forgiving tree: unclosed paragraphs, items and cells end where the next begins, stray end tags are ignored."""
    root = Node("#root")
    tags, size = _Tags(page), len(page)
    node, at = root, 0
    opened: dict[str, int] = {}  # elements on the way from the root to the node, by tag
    beyond: dict[str, int] = {}  # started below MAX_DEPTH, and not opened

    def close(until: Node) -> None:
        """Makes the parent of ``until`` the current node."""
        nonlocal node
        while node is not until.parent:
            opened[node.tag] -= 1
            node = node.parent

    while at < size:
        start = _TAG.search(page, at)
        if start is None:
            node.items.append(page[at:])
            break
        lt, mark = start.start(), start.group()
        if mark == "<!--":
            end = page.find("-->", lt + 4)
            end = size if end < 0 else end + 3
        elif mark == "<![CDATA[":
            end = page.find("]]>", lt)
            end = size if end < 0 else end + 3
        elif mark in ("<!", "<?"):
            end = page.find(">", lt)
            end = size if end < 0 else end + 1
        else:
            end = tags.end(lt)
        if end < 0:  # no tag ends from here on: all is text but the tag that the end of the page cuts off
            cut = page.rfind("<", lt)
            node.items.append(page[at:cut] if _TAG.match(page, cut) else page[at:])
            break
        if lt > at:
            node.items.append(page[at:lt])
        token, at = page[lt:end], end
        if token[1] in "!?":
            continue
        tag = _NAME.match(token).group(1).lower()
        if token[1] == "/":
            if beyond.get(tag):
                beyond[tag] -= 1
            elif opened.get(tag):
                up = node
                while up is not root and up.tag != tag and not (up.tag in ("article", "table", "td") and tag not in _BLOCK):
                    up = up.parent
                if up.tag == tag:
                    close(up)
            continue
        if tag in _VOID:
            node.items.append(Node(tag, node))
            continue
        if tag in _CLOSES_P and opened.get("p"):
            up = node
            while up is not root and up.tag != "p" and (up.tag not in _BLOCK):
                up = up.parent
            if up.tag == "p":
                close(up)
        if tag in _SAME and opened.get(tag):
            up = node
            while up is not root and up.tag not in _SAME[tag] and up.tag != tag:
                up = up.parent
            if up.tag == tag:
                close(up)
        words, hidden = _attributes(token)
        drop = tag in _DROP or hidden or bool(words & _UNLIKELY) and not words & _LIKELY and tag not in ("html", "body", "article", "main")
        if tag == "header" and any(n.tag in ("article", "main") for n in _above(node)):
            drop = True
        child = Node(tag, node, words, drop)
        node.items.append(child)
        if tag in _RAW:
            close_tag = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = close_tag.end() if close_tag else size
        elif not token.endswith("/>"):
            if child.depth < MAX_DEPTH:
                node = child
                opened[tag] = opened.get(tag, 0) + 1
            else:
                beyond[tag] = beyond.get(tag, 0) + 1
    return root


def _above(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _live(node: Node) -> Iterator[tuple[Node, bool]]:
    """Nodes that are not dropped, in page order, each once before and once after its children (flag True)."""
    stack = [(node, False)]
    while stack:
        n, after = stack.pop()
        yield n, after
        if not after:
            stack.append((n, True))
            stack += [(c, False) for c in reversed(n.items) if isinstance(c, Node) and not c.drop]


def _clean(text: str) -> str:
    return " ".join((html.unescape(text) if "&" in text else text).split())


def _measure(root: Node) -> dict[int, tuple[int, int, int]]:
    """Characters, characters in links, and commas below each live node."""
    out: dict[int, tuple[int, int, int]] = {}
    for n, after in _live(root):
        if after:
            chars = linked = commas = 0
            for c in n.items:
                if isinstance(c, str):
                    chars, commas = chars + len(c.strip()), commas + sum(map(c.count, _COMMAS))
                elif id(c) in out:
                    a, b, d = out[id(c)]
                    chars, linked, commas = chars + a, linked + b, commas + d
            out[id(n)] = (chars, chars if n.tag == "a" else linked, commas)
    return out


def _blocks(nodes: Iterable[Node]) -> list[str]:
    blocks: list[str] = []
    part: list[str] = []

    def end() -> None:
        if text := _clean("".join(part)):
            blocks.append(text)
        part.clear()

    for node in nodes:
        stack: list[Node | str | None] = [node]
        while stack:
            x = stack.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                part.append(x)
            elif x.tag == "br":
                part.append("\n")
            elif not x.drop or x is node:
                if x.tag in _BLOCK:
                    end()
                    stack.append(None)
                stack += reversed(x.items)
        end()
    return blocks


def main_text(page: str | None) -> str:
    """Main text of a page; empty for null, empty and textless pages."""
    if not page:
        return ""
    root = parse(page)
    size = _measure(root)
    mixed = [n for n, after in _live(root) if not after and n.words & _LINKS and not n.words & _LIKELY and 2 * size[id(n)][1] >= size[id(n)][0] > 0]
    if mixed:
        for n in mixed:
            n.drop = n.tag not in ("html", "body", "article", "main")
        size = _measure(root)
    candidates: dict[int, Node] = {}
    for n, after in _live(root):
        own = after and any(isinstance(c, str) and c.strip() or isinstance(c, Node) and c.tag not in _BLOCK and size.get(id(c), (0,))[0] for c in n.items)
        if not own or n.tag not in _BLOCK and n.tag != "#root":
            continue
        chars, linked, commas = size[id(n)] if n.tag in ("p", "pre", "td", "blockquote", "li") or n.tag[0] == "h" else (
            sum(len(c.strip()) if isinstance(c, str) else size.get(id(c), (0,))[0] if c.tag not in _BLOCK else 0 for c in n.items), 0, 0)
        points = (1 + commas + min(chars / 100, 10)) * (1 - linked / chars if chars else 0)
        paragraph = n.tag in ("p", "pre", "td", "blockquote", "li", "dd") or n.tag[0] == "h"
        up, share = (n.parent if paragraph else n), 1.0
        for _ in range(2):
            if up is None:
                break
            up.points += points * share
            candidates[id(up)] = up
            up, share = up.parent, 0.5
    if not candidates:
        return ""
    def final(n: Node) -> float:
        chars, linked, _ = size.get(id(n), (0, 0, 0))
        bonus = 25 if n.tag in ("article", "main") else 10 if n.words & _LIKELY else 0
        return (n.points + bonus) * (1 - linked / chars if chars else 0)
    best = max(candidates.values(), key=final)  # the first in page order where two are equal
    while best.parent is not None and best.parent.tag in ("article", "main") and best.tag not in ("article", "main"):
        best = best.parent  # a part of an article never stands for the whole
    bar = max(10.0, 0.2 * final(best))
    kept = []
    for s in best.parent.items if best.parent is not None else [best]:
        if not isinstance(s, Node) or s.drop:
            continue
        chars, linked, _ = size.get(id(s), (0, 0, 0))
        dense = linked / chars if chars else 1.0
        prose = s.tag == "p" and (chars > 80 and dense < 0.25 or 0 < chars <= 80 and dense == 0 and re.search(r"[.!?](?:\s|$)", _clean(_inner(s))))
        if s is best or id(s) in candidates and final(s) >= bar or prose:
            kept.append(s)
    return " ".join(_blocks(kept))


def _inner(node: Node) -> str:
    """Text of a paragraph without its nested blocks."""
    parts: list[str] = []
    stack: list[Node | str] = list(reversed(node.items))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            parts.append(x)
        elif not x.drop and x.tag not in _BLOCK:
            stack += reversed(x.items)
    return "".join(parts)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row, one for one.

    Nulls in id and url stay null; null and empty pages have an empty text. Repeated rows come back repeated, an empty table
    gives an empty result, further columns are ignored. One page is parsed at a time, in time and memory linear in its length.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = [main_text(p) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
