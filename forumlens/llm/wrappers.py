"""Wrappers of a host's pages by union-free regular-expression inference.

A page is a stream of tags and text slots. A wrapper is a regular expression
without alternatives over such streams: tags, text slots, repeated groups ``( )+``
and optional groups ``( )?``. Aligning a page with a wrapper resolves each
mismatch: different strings become a text slot, neighbouring equal runs a repeated
group, and what only one side has an optional group.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from html import unescape

#: The longest run of tokens looked for as the body of a repeated group.
LONGEST_GROUP = 24
#: From so many pages on, text that is the same on all of them belongs to the template, unless it stands in content elements.
TEMPLATE_PAGES = 3
#: A page with more different symbols has its runs found by folding alone.
LETTERS = 1_000_000

# Elements by their role in HTML
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of the right closes an open element of the left.
CLOSED_BY = {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog button select option label legend fieldset iframe object head".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs"
    " sidebar aside footer masthead cookie cookies consent notice notices alert popup modal newsletter subscribe signup share sharing social"
    " related recommended comment comments disqus reply replies respond login toolbar pagination pager widget skip".split()
)
#: A class such as no-sidebar or has-banner tells of the page, not of what the element is.
QUALIFIERS = frozenset("no not has have with without is hide show".split())
CONTENT_WORDS = frozenset("article content entry main post story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)(?:\s[^>]*)?/>"
    r"|<(script|style|noscript|template|textarea|title|svg|math|iframe|select)\b.*?(?:</\1\s*>|\Z)"
    # Quotes count only where a value begins
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+|=)*+)>"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)"
    r"|[^<]+|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|[^\s/>=]+")
_NAMING = frozenset("class id role itemprop".split())


@dataclass
class Page:
    """A page's stream: ``symbols`` has ``#`` for a text slot, whose text is in ``texts`` in order."""

    symbols: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    #: Characters of a text that stand in links.
    linked: list[int] = field(default_factory=list)


def read_page(html: str | None) -> Page:
    """The stream of a page. Inline elements are part of the text around them.

    Comments, scripts, styles and unfinished tags are left out, character
    references decoded, white space runs made one space, and ends that HTML lets
    authors omit put in. A symbol is a tag with the names in its class, id, role
    and itemprop, digits left out.
    """
    page, parts, links, depth = Page(), [], 0, 0
    open_: list[str] = []

    def end_text() -> None:
        nonlocal parts, links
        text = " ".join(unescape("".join(parts)).split()) if parts else ""
        if text:
            page.symbols.append("#")
            page.texts.append(text)
            page.linked.append(links)
        parts, links = [], 0

    for m in _TOKEN.finditer(html or ""):
        name = m[3]
        if name is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                parts.append(token)
                if depth:
                    links += len(token)
            elif m[1]:
                parts.append(" ")
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                depth = 0 if m[2] else 1
            elif name in ("br", "img", "wbr"):
                parts.append(" ")
            continue
        end_text()
        if m[2]:
            page.symbols.append(f"/{name}")
            if name in open_:
                while open_.pop() != name:
                    pass
            continue
        # Ends that HTML leaves out
        while open_ and name in CLOSED_BY.get(open_[-1], ()):
            page.symbols.append(f"/{open_.pop()}")
        if name not in VOID:
            open_.append(name)
        named = []
        if m[4]:
            for a in _ATTRIBUTE.finditer(m[4]):
                if a[1] and a[1].lower() in _NAMING:
                    for token in (a[2] or a[3] or a[4] or "").lower().split():
                        words = re.findall(r"[a-z]+", token)
                        named += ["-".join(words)] if words and words[0] in QUALIFIERS else words
        page.symbols.append(" ".join([name, *sorted(set(named))]))
    end_text()
    return page


class Node:
    """A part of an expression: a tag, a slot, or a group of nodes that repeats or may be missing.

    A slot has the places of its texts in the page, or the hash of its text if it is
    the same everywhere (else None), and ``seen``, the number of pages known to have it.
    """

    __slots__ = ("key", "kind", "nodes", "optional", "places", "same", "seen")

    def __init__(self, kind: str, key: str, nodes: list[Node] | None = None, places: list[int] | None = None, same: int | None = None) -> None:
        self.kind, self.key, self.nodes = kind, key, nodes or []
        self.places, self.same, self.optional, self.seen = places or [], same, False, 1


def _group(kind: str, nodes: list[Node]) -> Node:
    return Node(kind, "(" + ",".join(n.key for n in nodes) + ")", nodes)


def slots(nodes: list[Node]) -> list[Node]:
    """The text slots in order."""
    found = []
    for n in nodes:
        if n.kind == "#":
            found.append(n)
        elif n.nodes:
            found += slots(n.nodes)
    return found


def _join(a: Node, b: Node, other_pages: bool = False) -> Node:
    """One node for two with equal keys: different strings become an open slot."""
    for x, y in zip(slots([a]), slots([b]), strict=True):
        x.places = x.places + y.places
        if x.same != y.same:
            x.same = None
        x.seen = x.seen + y.seen if other_pages else max(x.seen, y.seen)
    a.optional = a.optional or b.optional
    return a


def fold(nodes: list[Node]) -> list[Node]:
    """Neighbouring equal runs become repeated groups, short runs first."""
    changed = True
    while changed:
        changed = False
        for length in range(1, LONGEST_GROUP + 1):
            keys = [n.key for n in nodes]
            i, out = 0, []
            while i < len(nodes):
                j = i + length
                if j + length <= len(nodes) and keys[i] == keys[j] and keys[i:j] == keys[j : j + length]:
                    body = nodes[i:j]
                    while keys[i : i + length] == keys[j : j + length]:
                        body = [_join(a, b) for a, b in zip(body, nodes[j : j + length], strict=True)]
                        j += length
                    if length == 1 and body[0].kind == "+":
                        out.append(body[0])
                    else:
                        out.append(_group("+", body))
                    changed = True
                    i = j
                else:
                    out.append(nodes[i])
                    i += 1
            nodes = out
    return nodes


_RUN = re.compile(r"(.{1,%d}?)\1+" % LONGEST_GROUP, re.S)


def page_nodes(page: Page) -> list[Node]:
    """A page as an expression of its own."""
    letters: dict[str, str] = {}
    stream = "".join([letters.setdefault(s, chr(0x10000 + len(letters) % LETTERS)) for s in page.symbols])
    hashes = [zlib.crc32(t.encode("utf-8", "replace")) for t in page.texts]
    nodes: list[Node] = []
    done = place = 0

    def add(symbols: list[str], times: int, out: list[Node]) -> None:
        """Nodes of ``symbols``, which stand ``times`` times from here on."""
        nonlocal place
        width = symbols.count("#")
        for symbol in symbols:
            if symbol == "#":
                places = list(range(place, place + width * times, width))
                first = hashes[places[0]]
                out.append(Node("#", "#", places=places, same=first if all(hashes[p] == first for p in places) else None))
                place += 1
            else:
                out.append(Node("t", symbol))
        place += width * (times - 1)

    for run in _RUN.finditer(stream) if len(letters) <= LETTERS else ():
        add(page.symbols[done : run.start()], 1, nodes)
        body: list[Node] = []
        length = len(run[1])
        add(page.symbols[run.start() : run.start() + length], len(run[0]) // length, body)
        nodes.append(_group("+", body))
        done = run.end()
    add(page.symbols[done:], 1, nodes)
    return fold(nodes)


def _wrap(nodes: list[Node], groups: dict[str, int]) -> list[Node]:
    """Single runs that are the body of a repeated group elsewhere count as the group."""
    bodies = sorted(groups.items(), key=lambda x: -x[1])
    out, i = [], 0
    while i < len(nodes):
        for body, length in bodies:
            run = nodes[i : i + length]
            if len(run) == length and "(" + ",".join(n.key for n in run) + ")" == body:
                out.append(_group("+", run))
                i += length
                break
        else:
            out.append(nodes[i])
            i += 1
    return out


def _groups(nodes: list[Node]) -> dict[str, int]:
    return {n.key: len(n.nodes) for n in nodes if n.kind == "+"}


def _aligned(a: list[Node], b: list[Node]) -> tuple[list[Node], list[Node], list[tuple[str, int, int, int, int]]]:
    ga, gb = _groups(a), _groups(b)
    a, b = fold(_wrap(a, {k: v for k, v in gb.items() if k not in ga})) if gb else a, fold(_wrap(b, {k: v for k, v in ga.items() if k not in gb})) if ga else b
    return a, b, SequenceMatcher(None, [n.key for n in a], [n.key for n in b], autojunk=False).get_opcodes()


def merge(a: list[Node], b: list[Node]) -> list[Node]:
    """The wrapper of what ``a`` and ``b`` describe; both are used up."""
    a, b, steps = _aligned(a, b)
    out = []
    for kind, a0, a1, b0, b1 in steps:
        if kind == "equal":
            out += [_join(x, y, True) for x, y in zip(a[a0:a1], b[b0:b1], strict=True)]
        else:
            for n in [*a[a0:a1], *b[b0:b1]]:
                n.optional = True
                out.append(n)
    return fold(out)


def flags_of(page: list[Node], wrapper: list[Node], content: list[bool], own: list[bool]) -> list[tuple[Node, bool]]:
    """The slots of a page and whether they are content: as in the wrapper where they align, else by their own flag."""
    by_node = dict(zip(map(id, slots(wrapper)), content, strict=True))
    flags = dict(zip(map(id, slots(page)), own, strict=True))
    p, w, steps = _aligned(page, wrapper)
    for kind, a0, a1, b0, b1 in steps:
        if kind == "equal":
            for x, y in zip(p[a0:a1], w[b0:b1], strict=True):
                for s, t in zip(slots([x]), slots([y]), strict=True):
                    flags[id(s)] = by_node.get(id(t), flags.get(id(s), False))
    return [(s, flags.get(id(s), False)) for s in slots(p)]


def levels(nodes: list[Node], lengths: list[int] | None = None) -> list[tuple[Node, int]]:
    """The text slots and where they stand.

    0 is boilerplate by tag or name of an element around it (headers only outside
    articles and main elements), 1 the body, 2 an element named as content, 3 one
    named as the main one, 4 the main element, or an article of a page without one.
    The names of html, body and of the outermost main elements and articles tell
    of the page, not of boilerplate. A form with over half of the text, by the
    ``lengths`` of the texts, is the page and no form.
    """
    found: list[tuple[Node, int]] = []
    has_main = False
    sizes: dict[int, int] = {}
    total = sum(lengths or ())

    def survey(parts: list[Node], open_forms: list[int]) -> None:
        nonlocal has_main
        for n in parts:
            if n.kind == "#":
                for form in open_forms:
                    sizes[form] += sum(lengths[p] for p in n.places) if lengths else 0
            elif n.nodes:
                survey(n.nodes, open_forms)
            elif n.key == "/form":
                del open_forms[-1:]
            elif n.key.startswith(("form", "main")):
                name = n.key.split(" ", 1)[0]
                has_main = has_main or name == "main"
                if name == "form":
                    sizes[id(n)] = 0
                    open_forms.append(id(n))

    survey(nodes, [])
    stack: list[tuple[str, frozenset[str]]] = []

    def level() -> int:
        best, inside = 1, False
        for name, words in stack:
            outer = name in ("html", "body") or (best < 3 and name in ("main", "article"))
            if name in BOILERPLATE_TAGS or (words & BOILERPLATE_WORDS and not outer):
                return 0
            if best < 3 and (name == "header" or ("header" in words and not outer)):
                return 0
            inside = inside or name == "main"
            if name == "main" or ((name == "article" or "articlebody" in words) and (inside or not has_main)):
                best = 4
            elif "main" in words and name != "body" and not has_main:
                best = max(best, 3)
            elif (words & CONTENT_WORDS or name == "article") and name not in ("body", "html"):
                best = max(best, 2)
        return best

    def walk(parts: list[Node]) -> None:
        for n in parts:
            if n.kind == "#":
                found.append((n, level()))
            elif n.nodes:
                walk(n.nodes)
            elif n.key[0] == "/":
                name = n.key[1:]
                if name in [s[0].strip() for s in stack]:
                    while stack.pop()[0].strip() != name:
                        pass
            else:
                name, *words = n.key.split(" ")
                while stack and name in CLOSED_BY.get(stack[-1][0], ()):
                    stack.pop()
                if name not in VOID:
                    page = name == "form" and 2 * sizes.get(id(n), 0) > total > 0
                    stack.append((f"{name} " if page else name, frozenset() if page else frozenset(words)))

    walk(nodes)
    return found


def template_slots(nodes: list[Node]) -> list[bool]:
    """Per slot of a wrapper whether its text is the template's: the same on all pages that have it, outside content elements.

    Equal text inside them, such as a heading that recurs, is the pages' own.
    """
    return [n.same is not None and n.seen >= TEMPLATE_PAGES and level < 2 for n, level in levels(nodes)]


def dump(nodes: list[Node]) -> str:
    """An expression as text."""

    def plain(n: Node) -> list:
        return [n.kind, int(n.optional), [n.same, n.seen] if n.kind == "#" else n.key if n.kind == "t" else [plain(x) for x in n.nodes]]

    return json.dumps([plain(n) for n in nodes], separators=(",", ":"), ensure_ascii=False)


def load(text: str) -> list[Node]:
    def build(x: list) -> Node:
        kind, optional, rest = x
        if kind == "#":
            node = Node("#", "#", same=rest[0])
            node.seen = rest[1]
        elif kind == "t":
            node = Node("t", rest)
        else:
            node = _group("+", [build(y) for y in rest])
        node.optional = bool(optional)
        return node

    return [build(x) for x in json.loads(text)]


def show(nodes: list[Node]) -> str:
    """An expression in the usual notation, for people."""
    out = []
    for n in nodes:
        body = "#text" if n.kind == "#" else f"<{n.key}>" if n.kind == "t" else f"({show(n.nodes)})+"
        out.append(f"({body})?" if n.optional else body)
    return "".join(out)
