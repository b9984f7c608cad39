"""Main text of web pages by wrappers inferred per host (union-free regular expressions).

1. A page becomes a tree of block elements (tag with class and id) and text slots; inline tags belong to the text. Neighbours of
   one label are one repeated group, and so is a sequence of labels that follows itself (a heading and its paragraphs, say).
   A page's tree written with its slots numbered is its skeleton; pages of one template share one or a few.
2. Per skeleton and slot, sums over its pages say how much text there is, how much of it is linked and, by the smallest and
   the largest text hash, whether the text is the same on all pages.
3. A host's skeletons are aligned one after the other into its wrapper: what two have at the same place is merged, what only one has
   becomes optional, what one repeats is repeated, and where texts meet that differ there is a text slot, where they
   are equal a constant. Skeletons are dealt to groups of a bounded number, and the groups' wrappers to groups again, until there is
   one wrapper per host: no task gets all pages or all skeletons of a host.
4. A page is read through its host's wrapper: each of its slots is matched to one of the wrapper's, which tells constants
   (template text) from data, menus (mostly linked text) from prose, and how much text a container holds over the host's pages.
   The article or main element is the main text; without one it is the container with the most unlinked data.

What decides: elements that the standard defines as no part of the text (nav, header, footer, aside, form, hidden ones, inline ones too, articles
in an article that has text of its own, which are comments); constants on three or more pages, headings of the article apart; linked text outside
an article. Class and id names are no more than a second witness: an element in the main text that is named like an advert
or a comment section goes only if the wrapper has it short, mostly linked or made of a repeated group.

Children of one element that are more than 48 after grouping are a repeated group of optional labels (of optional tags if
there are more than 48 labels), and elements nested deeper than 200 belong to the 200th: so alignment needs bounded memory whatever a page looks
like, and no text is lost by either.

Defined results: null or empty html gives the empty text; a null or malformed url is the host ""; a page whose text is the same as
all others' of its skeleton, or over 80 % of it, is counted once where constants are counted, so that copies make no template; where
constants are over 80 % of the main text, they are text; a broken page is read as far as its tags can be matched.
Text outside any tag counts as a block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan as ts
from tessera.llm.common import discard, fresh, small_batches, written

#: Element names.
_RAW = "script|style|noscript|template|textarea|title|iframe|svg|object|select|button|canvas|audio|video|annotation|annotation-xml"
_BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
              "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
_AUTO_CLOSED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPES = {"ul", "ol", "dl", "table", "menu", "body", "article", "section", "div"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
_DROP_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "search", "fieldset"}
_DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "alertdialog"}
#: Whole class or id names; witnesses only, see above.
_NAMED = re.compile(r"(?:ads?|adsby\w*|advert\w*|sponsor\w*|cookies?|consent|newsletter|breadcrumbs?|sidebar|comments?|disqus\w*|related|recommended|share|sharing|social|menu|nav|navbar|"
                    r"footer|pagination|reader-comments)(?:[-_](?:left|right|top|bottom|box|banner|notice|container|wrapper|wrap|list|section|area|posts|articles|links|buttons|widget|0+))*", re.I)
#: A tag ends before the next ``<`` outside quotes, closed or not, so that every character is looked at a bounded number of times however broken a page is.
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({_RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)>|<[!?][^<>]*>|<[a-zA-Z/][^<>]*(?=<|\Z)", re.S | re.I)
_ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_RESERVED = re.compile(r"[\s/#,:()]")
_VOID = {"area", "embed", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_WIDE = 48
_DEEP = 200
#: Distinct pages that must agree before a text counts as template.
_ENOUGH = 3
#: Pages with more than this share of their text in common are copies, not pages of one template.
_ALIKE = 0.8


class Node:
    """An element (kids) or a text slot (kids is None) of a page or wrapper.

    many: repeated. opt: optional. bag: 1 if the kids are a repeated group of optional labels, 2 of tags. n: pages with it. lo, hi: smallest
    and largest hash of a block's text; first, last: of all a page's blocks in the slot. chars, linked: sums over pages. at: numbers of the page's blocks in a slot."""

    __slots__ = ("label", "many", "opt", "bag", "kids", "n", "lo", "hi", "first", "last", "chars", "linked", "at")

    def __init__(self, label: str, kids: list | None = None):
        self.label, self.kids = label, kids
        self.many = self.opt = False
        self.bag, self.n, self.lo, self.hi, self.first, self.last, self.chars, self.linked = 0, 1, 0, 0, 0, 0, 0, 0
        self.at: list[int] = []


def _hidden(attrs: str) -> bool:
    """Whether an inline element is not shown."""
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    return "hidden" in got or bool(_HIDING.search(got.get("style", "")))


def _label(tag: str, attrs: str) -> str:
    """Tag with class, id and role, digits masked; a leading ``!`` marks hidden elements."""
    if not attrs or attrs.isspace():
        return tag
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    if not got:
        return tag
    names = _DIGITS.sub("0", " ".join(got[k] for k in ("class", "id") if got.get(k))).split()
    hidden = "hidden" in got or got.get("aria-hidden", "").lower() == "true" or _HIDING.search(got.get("style", ""))
    role = got.get("role", "").strip().lower()
    return ("!" if hidden else "") + _RESERVED.sub("_", tag + "".join("." + x.replace("@", "_") for x in names) + (f"@{role}" if role else ""))


def _parts(label: str) -> tuple[str, list[str], str]:
    rest, _, role = label.lstrip("!").partition("@")
    tag, *names = rest.split(".")
    return tag, names, role


def read_page(page: str, folded: bool = True) -> tuple[Node, list[str], list[int]]:
    """The page's tree (elements without text left out), and text and linked characters of each block in page order.
    Text has its references decoded and white space made single."""
    root = Node("")
    root.kids = []
    stack, tags = [root], [""]
    buried: dict[str, int] = {}
    texts: list[str] = []
    links: list[int] = []
    parts: list[str] = []
    linked, in_link, link_from, at = 0, False, 0, 0

    hidden, deep, hidden_from = "", 0, 0  # the hidden inline element that is open, how often its tag is, and where its text begins

    def unhide() -> None:
        nonlocal hidden, link_from
        del parts[hidden_from:]
        hidden, link_from = "", min(link_from, len(parts))

    def flush() -> None:
        nonlocal linked, link_from
        if hidden:  # it ends with its block
            unhide()
        if in_link:
            linked += sum(map(len, parts[link_from:]))
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            leaf = Node("#")
            leaf.at.append(len(texts))
            stack[-1].kids.append(leaf)
            texts.append(text)
            links.append(min(linked, len(text)))
        parts.clear()
        linked, link_from = 0, 0

    def close(upto: int) -> None:
        while len(stack) > upto:
            node = stack.pop()
            tags.pop()
            if node.kids:
                if folded and len(node.kids) > 1:
                    fold(node)
                stack[-1].kids.append(node)

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            if m[1]:
                parts.append(" ")
            continue
        if tag not in _BLOCKS:
            if tag == "br":
                parts.append(" ")
            elif tag == hidden:
                deep += -1 if m[2] else 1
                if not deep:
                    unhide()
            elif not hidden and not m[2] and m[4] and tag not in _VOID and _hidden(m[4]):
                hidden, deep, hidden_from = tag, 1, len(parts)
            elif tag == "a":
                if in_link:
                    linked += sum(map(len, parts[link_from:]))
                in_link, link_from = not m[2], len(parts)
            continue
        if parts or hidden:
            flush()
        if m[2]:
            if buried.get(tag):
                buried[tag] -= 1
            elif tag in tags:
                close(len(tags) - 1 - tags[::-1].index(tag))
            continue
        if tags[-1] == "p":
            close(len(stack) - 1)
        if tag in _AUTO_CLOSED:
            for k in range(len(tags) - 1, 0, -1):
                if tags[k] in _AUTO_CLOSED[tag]:
                    close(k)
                    break
                if tags[k] in _SCOPES:
                    break
        if tag == "hr":
            continue
        if len(stack) > _DEEP:
            buried[tag] = buried.get(tag, 0) + 1
            continue
        node = Node(_label(tag, m[4]))
        node.kids = []
        stack.append(node)
        tags.append(tag)
    if at < len(page):
        parts.append(page[at:])
    if parts or hidden:
        flush()
    close(1)
    if folded:
        fold(root)
    return root, texts, links


def _merge(a: Node, b: Node, pages: bool) -> None:
    """Merge ``b`` into ``a``: from other pages, or (not ``pages``) a neighbour of the same pages."""
    a.many |= b.many
    a.opt |= b.opt
    a.n = a.n + b.n if pages else max(a.n, b.n)
    if a.kids is None:
        a.lo, a.hi = min(a.lo, b.lo), max(a.hi, b.hi)
        a.first, a.last = min(a.first, b.first), max(a.last, b.last)
        a.chars += b.chars
        a.linked += b.linked
        a.at += b.at
        return
    x, y = a.kids, b.kids
    if a.bag or b.bag:
        _into_bag(a, [*x, *y], max(a.bag, b.bag), pages)
        return
    if len(x) == len(y) and all(p.label == q.label for p, q in zip(x, y, strict=True)):
        for p, q in zip(x, y, strict=True):
            _merge(p, q, pages)
        return
    groups = {k.label: k for k in [*x, *y] if k.label[0] == "("}
    if groups:
        x, y = _with_groups(x, groups), _with_groups(y, groups)
    out: list[Node] = []
    for p, q in _aligned(x, y):
        if p is not None and q is not None:
            _merge(p, q, pages)
        else:
            p = p or q
            p.opt = True
        out.append(p)
    a.kids = out
    fold(a)


def _joined(out: list[Node], k: Node) -> None:
    """Add ``k`` to ``out``, as a repetition of the last item if that has its label."""
    if not out or out[-1].label != k.label:
        out.append(k)
        return
    opt = out[-1].opt and k.opt
    _merge(out[-1], k, False)
    out[-1].many, out[-1].opt = True, opt


def _into_bag(node: Node, kids: list[Node], level: int, pages: bool) -> None:
    have: dict[str, Node] = {}
    todo = kids[::-1]
    while todo:
        k = todo.pop()
        if k.label[0] == "(":
            todo += k.kids[::-1]
            continue
        if level == 2 and k.kids is not None:
            k.label = ("!" if k.label[0] == "!" else "") + _parts(k.label)[0]
        if k.label in have:
            _merge(have[k.label], k, pages)
        else:
            have[k.label] = k
    node.kids, node.bag = list(have.values()), level
    for k in node.kids:
        k.opt = True
    if level == 1 and len(have) > _WIDE:
        _into_bag(node, node.kids, 2, pages)


def fold(node: Node) -> None:
    """Neighbours of one label become one repeated item, then sequences that follow themselves one repeated group."""
    if node.bag:
        return
    out: list[Node] = []
    for k in node.kids:
        _joined(out, k)
    width = 2
    while 2 * width <= len(out) and width <= 6:
        labels = [k.label for k in out]
        i, made = 0, []
        while i < len(out):
            unit = labels[i:i + width]
            if labels[i + width:i + 2 * width] != unit:
                made.append(out[i])
                i += 1
                continue
            group = Node("(" + ",".join(unit), out[i:i + width])
            group.many, group.n = True, max(k.n for k in group.kids)
            i += width
            while labels[i:i + width] == unit:
                for p, q in zip(group.kids, out[i:i + width], strict=True):
                    _merge(p, q, False)
                i += width
            made.append(group)
        out = made
        width += 1
    node.kids = out
    if len(out) > _WIDE:
        _into_bag(node, out, 1, False)


def _with_groups(items: list[Node], groups: dict[str, Node]) -> list[Node]:
    """Where ``items`` have a sequence once that is a repeated group elsewhere, make it that group."""
    for label in sorted(groups, key=lambda g: (-len(groups[g].kids), g)):
        unit = [k.label for k in groups[label].kids]
        out, i = [], 0
        while i < len(items):
            k = items[i]
            if k.label != label and len(unit) <= len(items) - i and all(u == p.label for u, p in zip(unit, items[i:i + len(unit)], strict=True)):
                k = Node(label, items[i:i + len(unit)])
                k.n, k.opt = max(x.n for x in k.kids), all(x.opt for x in k.kids)
                i += len(unit)
            else:
                i += 1
            _joined(out, k)
        items = out
    return items


def _worth(p: Node, q: Node) -> int:
    if p.label != q.label:
        return 0
    if p.kids is None:
        return 1
    return 4 if len(p.kids) == len(q.kids) and all(c.label == d.label for c, d in zip(p.kids, q.kids, strict=True)) else 3


def _aligned(x: list[Node], y: list[Node]) -> list[tuple[Node | None, Node | None]]:
    """Items of both lists in order, those of equal label paired so that the pairs weigh most: elements more than text, and
    elements with the same content more than others."""
    lo = 0
    while lo < len(x) and lo < len(y) and x[lo].label == y[lo].label:
        lo += 1
    hi = 0
    while hi < len(x) - lo and hi < len(y) - lo and x[-1 - hi].label == y[-1 - hi].label:
        hi += 1
    a, b = x[lo:len(x) - hi], y[lo:len(y) - hi]
    like = [[_worth(p, q) for q in b] for p in a]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = max(below[j], row[j + 1], below[j + 1] + like[i][j])
    out: list = list(zip(x[:lo], y[:lo], strict=True))
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and like[i][j] and best[i][j] == best[i + 1][j + 1] + like[i][j]:
            out.append((a[i], b[j]))
            i, j = i + 1, j + 1
        elif j >= len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append((a[i], None))
            i += 1
        else:
            out.append((None, b[j]))
            j += 1
    return out + list(zip(x[len(x) - hi:], y[len(y) - hi:], strict=True))


def align(a: Node, b: Node) -> Node:
    """The wrapper of two wrappers of other pages each; both are used up."""
    _merge(a, b, True)
    return a


def pattern(node: Node) -> str:
    """The wrapper as a regular expression over tokens: labels, text slots (#) and close tags; no unions."""
    def items(kids: list[Node]) -> str:
        return " ".join(one(k) for k in kids)

    def one(k: Node) -> str:
        if k.kids is None:
            body = "#"
        elif k.label[0] == "(":
            body = inner(k)
        else:
            body = f"{k.label} {inner(k)} /{_parts(k.label)[0]}"
        mark = "*" if k.many and k.opt else "+" if k.many else "?" if k.opt else ""
        return f"( {body} ){mark}" if mark else body

    def inner(k: Node) -> str:
        return f"( {items(k.kids)} )+" if k.bag else items(k.kids)

    return inner(node)


def dump(node: Node, stats: bool) -> str:
    """The tree as text, with the slots' numbers over pages or without."""
    out: list[str] = []

    def walk(k: Node) -> None:
        flags = ("+" if k.many else "") + ("?" if k.opt else "")
        if k.kids is None:
            out.append(f"{flags}#{k.n},{k.lo},{k.hi},{k.first},{k.last},{k.chars},{k.linked}" if stats else flags + "#")
            return
        out.append(f"{flags}{('', 'b', 'B')[k.bag]}:{k.label.replace('(', '[')}" + (f":{k.n}" if stats else ""))
        for c in k.kids:
            walk(c)
        out.append("/")

    walk(node)
    return " ".join(out)


def parsed(text: str) -> tuple[Node, list[Node]]:
    """The inverse of :func:`dump`, and the tree's slots in its order."""
    stack = [Node("", [])]
    slots: list[Node] = []
    for t in text.split(" "):
        if t == "/":
            stack.pop()
            continue
        at = t.find(":")
        if at < 0:
            flags, _, rest = t.partition("#")
            k = Node("#")
            k.at.append(len(slots))
            if rest:
                k.n, k.lo, k.hi, k.first, k.last, k.chars, k.linked = map(int, rest.split(","))
            slots.append(k)
        else:
            flags = t[:at]
            label, _, n = t[at + 1:].partition(":")
            k = Node(label.replace("[", "("), [])
            k.n = int(n) if n else 1
            k.bag = 1 if "b" in flags else 2 if "B" in flags else 0
        k.many, k.opt = "+" in flags, "?" in flags
        stack[-1].kids.append(k)
        if at >= 0:
            stack.append(k)
    return stack[0].kids[0], slots


def _matched(page: Node, wrapper: Node, out: dict[int, Node]) -> None:
    """Which slot of the wrapper each slot (by number) of a page's tree is read through. Regroups the page's tree."""
    if page.kids is None:
        out.update((i, wrapper) for i in page.at)
        return
    x, y = page.kids, wrapper.kids
    pairs: list = []
    if not wrapper.bag and not page.bag:
        groups = {k.label: k for k in y if k.label[0] == "("}
        pairs = _aligned(_with_groups(x, groups) if groups else x, y)
        if all(p is None or q is not None for p, q in pairs):
            for p, q in pairs:
                if p is not None:
                    _matched(p, q, out)
            return
    have: dict[str, list[Node]] = {}
    todo = y[::-1]
    while todo:
        k = todo.pop()
        todo += k.kids[::-1] if k.label[0] == "(" else []
        have.setdefault(k.label, []).append(k)
        if k.kids is not None:
            have.setdefault(("!" if k.label[0] == "!" else "") + _parts(k.label)[0], []).append(k)
    todo = [p for p, q in pairs if p is not None and q is None] if pairs else list(x)
    for p, q in pairs:
        if p is not None and q is not None:
            _matched(p, q, out)
    while todo:
        k = todo.pop()
        tag = k.label if k.kids is None else ("!" if k.label[0] == "!" else "") + _parts(k.label)[0]
        near = [q for q in have.get(k.label) or have.get(tag) or () if (q.kids is None) == (k.kids is None)]
        if near:
            inner = {c.label for c in k.kids or ()}
            _matched(k, max(near, key=lambda q: len(inner & {c.label for c in q.kids or ()})), out)
        elif k.label[0] == "(":
            todo += k.kids


#: A slot that the wrapper has at no like place: data.
_UNSEEN = Node("#")
_UNSEEN.hi = _UNSEEN.last = _UNSEEN.chars = 1


def kept_slots(wrapper: str, skeleton: str) -> tuple[bool, ...]:
    """Whether each slot of a skeleton is main text, by the slots of the host's wrapper it is read through."""
    page, slots = parsed(skeleton)
    through: dict[int, Node] = {}
    if wrapper:
        _matched(parsed(skeleton)[0], parsed(wrapper)[0], through)
    place: dict[int, tuple] = {}  # slot -> (elements above it, in an article or main element, a heading)

    def walk(k: Node, above: tuple, article: int) -> None:
        if k.kids is None:
            place[id(k)] = (above, article, any(_parts(a.label)[0] in _HEADINGS for a in above[-2:]))
            return
        tag, _, role = _parts(k.label)
        if k.label[:1] == "!" or tag in _DROP_TAGS or role in _DROP_ROLES:
            return
        if tag == "article" or role == "article":
            if article == 2:
                return  # an article in an article is a comment on it
            article = 2 if _own_text(k) else article  # without text of its own it only holds articles
        elif tag == "main" or role == "main":
            article = max(article, 1)
        for c in k.kids:
            walk(c, (*above, k) if k.label[:1] != "(" else above, article)

    walk(page, (), 0)
    usable = [s for s in slots if wrapper and id(s) in place]
    stat = {id(s): through.get(s.at[0], _UNSEEN) for s in usable}
    prose = lambda s: stat[id(s)].chars - stat[id(s)].linked
    fixed = {i for i, k in stat.items() if (k.lo == k.hi or k.first == k.last) and k.n >= _ENOUGH}
    main = [s for s in usable if place[id(s)][1]]
    if not main or not sum(prose(s) for s in main):
        free = [s for s in usable if stat[id(s)].linked <= 0.5 * stat[id(s)].chars]
        data = [s for s in free if id(s) not in fixed]
        free = data if sum(map(prose, data)) or len(data) == len(free) else free
        weight: dict[int, float] = {}
        depth: dict[int, int] = {}
        for s in free:
            above = place[id(s)][0]
            for k, e in enumerate(reversed(above)):
                if any(_NAMED.fullmatch(x) for x in _parts(e.label)[1]):
                    break  # what is named so vouches for nothing above it
                if k:  # the block itself is no container
                    weight[id(e)] = weight.get(id(e), 0.0) + prose(s) * 0.8 ** k
                    depth[id(e)] = len(above) - k
        if weight:
            best = max(weight, key=lambda e: (weight[e], depth[e]))
            main = [s for s in usable if s in free and any(id(e) == best for e in place[id(s)][0])]
        else:
            main = free
    total = sum(map(prose, main))

    def witnessed(s: Node) -> bool:
        for e in place[id(s)][0]:
            tag, names, _ = _parts(e.label)
            if tag not in ("html", "body", "article", "main") and any(_NAMED.fullmatch(x) for x in names):
                inside = [x for x in main if e in place[id(x)][0]]
                if sum(map(prose, inside)) <= 0.25 * total or 2 * sum(stat[id(x)].linked for x in inside) > sum(stat[id(x)].chars for x in inside) or _repeats(e):
                    return True
        return False

    main = [s for s in main if not witnessed(s)]
    same = [s for s in main if id(s) in fixed and not place[id(s)][2]]
    if sum(stat[id(s)].chars for s in same) <= _ALIKE * sum(stat[id(s)].chars for s in main):
        gone = set(map(id, same))
        main = [s for s in main if id(s) not in gone]
    taken = set(map(id, main))
    return tuple(id(s) in taken for s in slots)


def _repeats(e: Node) -> bool:
    return bool(e.kids) and (bool(e.bag) or any((k.many and k.label != "#" and _parts(k.label)[0] != "p") or _repeats(k) for k in e.kids))


def _own_text(article: Node) -> bool:
    """Whether an article has text outside the articles in it and what is no part of it."""
    todo = list(article.kids or ())
    while todo:
        k = todo.pop()
        if k.kids is None:
            return True
        tag, _, role = _parts(k.label)
        if not (k.label[:1] == "!" or tag in _DROP_TAGS or role in _DROP_ROLES or tag == "article" or role == "article"):
            todo += k.kids
    return False


_kept = lru_cache(maxsize=4096)(kept_slots)


def _slots(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        k = todo.pop()
        if k.kids is None:
            out.append(k)
        else:
            todo += k.kids[::-1]
    return out


def main_text(page: str, wrapper: str) -> str:
    """Text of the blocks in the slots of main text, in page order."""
    root, texts, _ = read_page(page)
    if not texts:
        return ""
    flags = _kept(wrapper, dump(root, False))
    blocks = sorted(i for s, keep in zip(_slots(root), flags, strict=True) if keep for i in s.at)
    return "\n\n".join(texts[i] for i in blocks)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


_SEEN = "host string, skeleton string, key string, slot int, n long, lo long, hi long, first long, last long, chars long, linked long"


_SLOT = ("slot", "lo", "hi", "first", "last", "chars", "linked")


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, skeleton, key, slot, n, lo, hi, first, last, chars, linked): per skeleton and slot, and per skeleton with slot -1
    and hashes of whole pages' texts. Pages of a batch are summed."""
    kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    names = [x.split()[0] for x in _SEEN.split(", ")]
    for batch in batches:
        seen: dict[tuple[str, str], list[list[int]]] = {}
        for host, page in zip(batch.column(0), batch.column(1), strict=True):
            root, texts, links = read_page(page.as_py() or "")
            if not texts:
                continue
            hashes = [_hash(t) for t in texts]
            slots = _slots(root)
            sums = seen.setdefault((host.as_py(), dump(root, False)), [])
            whole = _hash(repr(hashes))
            mine = [[1, whole, whole, whole, whole, 0, 0]]
            for s in slots:
                got = [hashes[i] for i in s.at]
                both = got[0] if len(got) == 1 else _hash(repr(got))
                mine.append([1, min(got), max(got), both, both, sum(len(texts[i]) for i in s.at), sum(links[i] for i in s.at)])
            if not sums:
                sums += mine
            else:
                for old, new in zip(sums, mine, strict=True):
                    old[0] += 1
                    old[1], old[2], old[3], old[4] = min(old[1], new[1]), max(old[2], new[2]), min(old[3], new[3]), max(old[4], new[4])
                    old[5] += new[5]
                    old[6] += new[6]
        rows = []
        for (host, skeleton), sums in seen.items():
            key = blake2b(skeleton.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
            rows += [(host, None if i else skeleton, key, i - 1, *x) for i, x in enumerate(sums)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def annotated(skeleton: str, slots: list[tuple[int, ...]], pages: int, alike: bool) -> str:
    """A skeleton with its slots' numbers (slot, lo, hi, first, last, chars, linked). Pages that are all alike, or in most of their text,
    count as one."""
    root, leaves = parsed(skeleton)
    fixed = sum(s[5] for s in slots if s[1] == s[2] or s[3] == s[4])
    n = 1 if alike or fixed > _ALIKE * sum(s[5] for s in slots) else pages
    for leaf, s in zip(leaves, slots, strict=True):
        leaf.n, leaf.lo, leaf.hi, leaf.first, leaf.last, leaf.chars, leaf.linked = n, *s[1:]

    def count(k: Node) -> None:
        k.n = n
        for c in k.kids or ():
            count(c)

    count(root)
    return dump(root, True)


def wrapper_of(trees: list[str]) -> str:
    whole: Node | None = None
    for text in sorted(trees, key=lambda s: (len(s), s)):
        one, _ = parsed(text)
        whole = one if whole is None else align(whole, one)
    return dump(whole, True) if whole else ""


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", group: int = 128) -> DataFrame:
    """One row per host: host, n_pages, wrapper (as :func:`dump` writes it). ``group``: skeletons or wrappers aligned in one task
    on average."""
    seen = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).mapInArrow(ts.tidy(_skeletons), _SEEN)
    seen = seen.groupBy("host", "key", "slot").agg(F.max("skeleton").alias("skeleton"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                                   F.min("first").alias("first"), F.max("last").alias("last"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    seen = written(seen, "slots")
    one = seen.groupBy("host", "key").agg(F.max("skeleton").alias("skeleton"), F.max(F.when(F.col("slot") < 0, F.col("n"))).alias("n_pages"),
                                          F.max(F.when(F.col("slot") < 0, F.col("lo") == F.col("hi"))).alias("alike"),
                                          F.array_sort(F.collect_list(F.when(F.col("slot") >= 0, F.struct(*_SLOT)))).alias("slots"))

    @F.pandas_udf("string")
    def tree(skeleton: pd.Series, slots: pd.Series, pages: pd.Series, alike: pd.Series) -> pd.Series:
        rows = zip(skeleton, slots, pages, alike, strict=True)
        return pd.Series([annotated(s, [tuple(x[c] for c in _SLOT) for x in xs], int(n), bool(a)) for s, xs, n, a in rows])

    level = written(one.select("host", "key", "n_pages", tree("skeleton", "slots", "n_pages", "alike").alias("wrapper")), "skeletons")
    discard(seen)
    while True:
        # Hosts with several trees left; each round leaves about 1/group of them.
        counts = written(level.groupBy("host").agg(F.count(F.lit(1)).alias("c")), "counts")
        most = counts.agg(F.max("c")).first()[0] or 1
        if most == 1:
            discard(counts)
            return level.select("host", "n_pages", "wrapper")
        dealt = level.join(counts, "host").withColumn("bucket", F.pmod(F.xxhash64("key"), F.ceil(F.col("c") / group)).cast("int"))
        made = dealt.groupBy("host", "bucket").applyInPandas(
            lambda f: pd.DataFrame({"host": [f["host"].iloc[0]], "key": [min(f["key"])], "n_pages": [int(f["n_pages"].sum())], "wrapper": [wrapper_of(list(f["wrapper"]))]}),
            "host string, key string, n_pages long, wrapper string")
        last, level = level, written(made, "wrappers")
        discard(last, counts)


def _texts(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [main_text(page.as_py() or "", wrapper.as_py() or "") for page, wrapper in zip(batch.column(keep), batch.column(keep + 1), strict=True)]
        cols = [batch.column(i) for i in range(keep)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(made, pa.string())], [*batch.schema.names[:keep], "text"])


def main_texts(pages: DataFrame, broadcast_bytes: int = 8_000_000) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``; extra columns are passed over."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host, wrapper = fresh(rows, "_host", "_wrapper")
    made = wrappers(rows).select(F.col("host").alias(host), F.col("wrapper").alias(wrapper))
    size = made.agg(F.sum(F.octet_length(host) + F.octet_length(wrapper))).first()[0] or 0
    rows = rows.join(F.broadcast(made) if size <= broadcast_bytes else made, host_of(F.col("url")) == F.col(host), "left")
    rows = rows.select("page_id", "url", "html", wrapper).mapInArrow(ts.tidy(lambda it: _texts(it, 2)), "page_id long, url string, text string")
    return rows.withColumn("n_chars", F.length("text").cast("long"))
