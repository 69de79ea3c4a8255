"""A small document tree over the standard parser, with a CSS subset. Pure Python, used inside Arrow functions.

Void tags hold nothing; an end tag closes the nearest open tag of its name, and everything inside; an end tag without
one is ignored; no end tags are implied, so an unclosed tag keeps what follows.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
SKIP = frozenset(("script", "style", "template"))
_CHARSET = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?\s*([\w-]+)|^<\?xml\b[^>]*encoding=[\"']([\w-]+)", re.IGNORECASE)


#: Where a page's head ends, up to which its charset is looked for.
_HEAD_END = re.compile(rb"</head\b|<body\b", re.IGNORECASE)


def decode(data: bytes | None) -> str:
    """Text of a page by its own charset; UTF-8 where it names none or an unknown one."""
    if not data:
        return ""
    end = _HEAD_END.search(data)
    m = end and _CHARSET.search(data, 0, end.start()) or _CHARSET.search(data)
    name = (m[1] or m[2]).decode("ascii") if m else "utf-8"
    if data[:3] == b"\xef\xbb\xbf":
        name, data = "utf-8", data[3:]
    try:
        return data.decode(name, "replace")
    except (LookupError, UnicodeError):  # some codecs know no replacement
        return data.decode("utf-8", "replace")


class Node:
    """An element; children are Nodes and texts in order."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs or {}, parent, []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self) -> Iterator[Node]:
        """This node and all below, in document order."""
        todo = [self]
        while todo:
            x = todo.pop()
            yield x
            todo.extend(c for c in reversed(x.children) if isinstance(c, Node))

    def above(self) -> Iterator[Node]:
        x = self.parent
        while x is not None:
            yield x
            x = x.parent

    def get(self, *names: str) -> str:
        """First of several attributes that isn't empty."""
        return next((v for n in names if (v := self.attrs.get(n))), "")

    def all(self, selector: str) -> list[Node]:
        test = compiled(selector)
        return [x for x in self.walk() if x is not self and test(x)]

    def first(self, selector: str) -> Node | None:
        test = compiled(selector)
        return next((x for x in self.walk() if x is not self and test(x)), None)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("#document")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.now)
        self.now.children.append(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.now.children.append(Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.now))

    def handle_endtag(self, tag: str) -> None:
        x = self.now
        while x is not None and x.tag != tag:
            x = x.parent
        if x is not None and x.parent is not None:
            self.now = x.parent

    def handle_data(self, data: str) -> None:
        self.now.children.append(data)


def parse(text: str) -> Node:
    b = _Builder()
    b.feed(text.replace("\x00", " "))
    b.close()
    return b.root


# --- selectors: tag, #id, .class, [attr], [attr=v], [attr*=v], [attr^=v], [attr$=v], descendant, child, comma

_SIMPLE = re.compile(r"([\w-]+|\*)|#([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:([*^$~]?=)[\"']?([^\"'\]]*)[\"']?)?\]")
_COMPILED: dict[str, object] = {}


def _simple(part: str):
    tests = []
    for tag, ident, cls, attr, op, value in _SIMPLE.findall(part):
        if tag and tag != "*":
            tests.append(lambda n, t=tag: n.tag == t)
        elif ident:
            tests.append(lambda n, i=ident: n.attrs.get("id") == i)
        elif cls:
            tests.append(lambda n, c=cls: c in n.classes)
        elif attr:
            compare = {"": lambda a, v: True, "=": str.__eq__, "*=": str.__contains__, "^=": str.startswith, "$=": str.endswith, "~=": lambda a, v: v in a.split()}[op]
            tests.append(lambda n, a=attr, c=compare, v=value: a in n.attrs and c(n.attrs[a], v))
    return lambda n: all(t(n) for t in tests)


def compiled(selector: str):
    """A test of nodes for a selector."""
    if (found := _COMPILED.get(selector)) is None:
        chains = []
        for one in selector.split(","):
            steps = re.sub(r"\s*>\s*", " > ", one.strip()).split()
            chain, child = [], False
            for s in steps:
                if s == ">":
                    child = True
                else:
                    chain.append((child, _simple(s)))
                    child = False
            chains.append(chain)

        def matches(node: Node, chain: list) -> bool:
            def up(n: Node, i: int) -> bool:
                child, test = chain[i]
                if not test(n):
                    return False
                if i == 0:
                    return True
                if child:
                    return n.parent is not None and up(n.parent, i - 1)
                return any(up(a, i - 1) for a in n.above())

            return up(node, len(chain) - 1)

        found = _COMPILED[selector] = lambda n: any(matches(n, c) for c in chains)
    return found


# --- text and markup of a subtree


def flat_text(node: Node | None) -> str:
    """All text with single spaces, scripts and styles included only where asked for by node."""
    if node is None:
        return ""
    out: list[str] = []
    todo: list[Node | str] = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is node or x.tag not in SKIP:
            todo.extend(reversed(x.children))
    return " ".join(" ".join(out).split())


def block_text(node: Node | None, skip_class: str = "") -> str:
    """Text with a line for every block: br breaks a line, images give their alt text, spaces collapse in a line, empty lines go."""
    if node is None:
        return ""
    out: list[str] = []
    todo: list[Node | str] = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x if x == "\n" else " ".join(re.split(r"[^\S\n]+", x.replace("\xa0", " "))))
        elif x.tag in SKIP or (skip_class and skip_class in x.classes):
            continue
        elif x.tag == "br":
            out.append("\n")
        elif x.tag == "img":
            out.append(x.get("alt"))
        else:
            edge = ["\n"] if x.tag in BLOCK else []
            todo.extend([*edge, *reversed(x.children), *edge])
    lines = (" ".join(line.split()) for line in "".join(out).split("\n"))
    return "\n".join(line for line in lines if line)


def markup(node: Node | None) -> str:
    """The markup inside a node, attributes and texts escaped anew."""
    out: list[str] = []

    def one(x: Node | str) -> None:
        if isinstance(x, str):
            out.append(html.escape(x, quote=False))
            return
        out.append(f"<{x.tag}" + "".join(f' {k}="{html.escape(v)}"' for k, v in x.attrs.items()) + ">")
        if x.tag not in VOID:
            for c in x.children:
                one(c)
            out.append(f"</{x.tag}>")

    for c in node.children if node is not None else ():
        one(c)
    return "".join(out)


# --- features of a page


def metas(root: Node) -> list[tuple[str, str, str]]:
    """(kind of key, key, content) of every meta: property before name before itemprop before http-equiv."""
    out = []
    for m in root.all("meta"):
        kind = next((k for k in ("property", "name", "itemprop", "http-equiv") if m.attrs.get(k)), None)
        if kind:
            out.append((kind, m.attrs[kind], " ".join(m.get("content").split())))
    return out


def direct_meta(scope: Node | None, itemprop: str) -> str:
    """Content of a meta that is a child of the scope itself."""
    return next((c.get("content") for c in scope.children if isinstance(c, Node) and c.tag == "meta" and c.attrs.get("itemprop") == itemprop), "") if scope is not None else ""


def absolute(base: str, url: str) -> str:
    if not url:
        return ""
    try:
        return urljoin(base, html.unescape(url))
    except ValueError:
        return url


def links(root: Node, base: str = "") -> list[dict[str, str]]:
    """Links with an address: href, url, text, title, rel."""
    return [{"href": a.get("href"), "url": absolute(base, a.get("href")), "text": flat_text(a), "title": a.get("title"), "rel": a.get("rel")} for a in root.all("a") if a.get("href")]


def images(root: Node, base: str = "") -> list[dict[str, str]]:
    """Images, those without an address too: src, url, srcset, alt, title, width, height."""
    return [{"src": i.get("src", "data-src"), "url": absolute(base, i.get("src", "data-src")), **{k: i.get(k) for k in ("srcset", "alt", "title", "width", "height")}} for i in root.all("img")]


def head_links(root: Node) -> tuple[str, list[tuple[str, str]]]:
    """Canonical address (the first), and (language, address) of the alternates."""
    found = root.all("link")
    canonical = next((x.get("href") for x in found if "canonical" in x.get("rel").split()), "")
    return canonical, [(x.get("hreflang"), x.get("href")) for x in found if "alternate" in x.get("rel").split() and x.get("hreflang")]


def json_ld(root: Node) -> tuple[list[str], list[str]]:
    """JSON-LD scripts as JSON text, and warnings; one that can't be read is kept as an object with raw and parse_error."""
    out, warnings = [], []
    for s in root.all("script"):
        if s.attrs.get("type", "").strip().lower() != "application/ld+json":
            continue
        raw = "".join(c for c in s.children if isinstance(c, str)).strip()
        try:
            out.append(json.dumps(json.loads(raw), ensure_ascii=False))
        except ValueError as e:
            warnings.append("invalid_json_ld")
            out.append(json.dumps({"raw": raw, "parse_error": str(e)}, ensure_ascii=False))
    return out, warnings


def of_type(records: list[str], kind: str) -> str | None:
    """First JSON-LD object of a type, lists looked into."""
    todo = [json.loads(r) for r in records]
    while todo:
        x = todo.pop(0)
        if isinstance(x, list):
            todo[:0] = x
        elif isinstance(x, dict) and (x.get("@type") == kind or isinstance(x.get("@type"), list) and kind in x["@type"]):
            return json.dumps(x, ensure_ascii=False)
    return None


def payload(root: Node, ident: str = "__NUXT_DATA__") -> str | None:
    """Text of the script that holds the embedded application payload."""
    s = root.first(f"script#{ident}")
    return None if s is None else "".join(c for c in s.children if isinstance(c, str))


def info_lines(root: Node, line: str = ".line", key: str = ".key", value: str = ".value") -> list[dict[str, str]]:
    """Labelled lines of a page: label without its colon, text of the value."""
    out = []
    for x in root.all(line):
        k, v = x.first(key), x.first(value)
        if k is not None and (label := flat_text(k).rstrip(":").strip()):
            out.append({"key": label, "value": flat_text(v) if v is not None else flat_text(x)[len(flat_text(k)) :].strip()})
    return out


def comment_parents(root: Node, selector: str, ident: str = "id") -> list[tuple[str, str]]:
    """(id, id of the nearest comment around it, or empty) of every comment node."""
    test = compiled(selector)
    return [(x.get(ident), next((a.get(ident) for a in x.above() if test(a)), "")) for x in root.all(selector)]


def outermost(root: Node, selector: str) -> list[Node]:
    """Nodes of a selector that stand in no other of them."""
    test = compiled(selector)
    return [x for x in root.all(selector) if not any(test(a) for a in x.above())]
