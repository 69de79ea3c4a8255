"""Main body of saved web pages.

A page's bytes are decoded by its own charset, and a tree is built with the end tags that HTML implies. Text under tags
or attributes that keep it from the screen is left out; the rest is laid out as blocks, the visible text between two
tags that break a line, with list items and table cells as blocks of their own. The page is cut into sections (children
of the body, of a wrapper, or cells of a layout table); navigation, notices, side columns, visitors' comments and
footers are told by their tags, links, labels and place, and the remaining sections are the body. Its blocks are laid out as
paragraphs, lists and aligned tables; block rows and rendered texts both come from that layout.

Defined results: null or empty bytes, and pages with chrome only, have no blocks; bytes that don't fit the charset become
replacement characters; a charset that isn't known is read as UTF-8; equal pages under several urls count for each.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmill.operators.htmldom import decode
from driftmill.session import spread

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_SPACE = re.compile(r"\s+")
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?(?:false|until))|display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*[\"']?true|type\s*=\s*[\"']?hidden", re.IGNORECASE)
_NAMED = re.compile(r"\b(?:id|class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|(\S+))", re.IGNORECASE)

#: Tags that don't break a line, tags whose text isn't shown, tags without content.
INLINE = frozenset("a b i em strong span sup sub code u small mark".split())
UNSEEN = frozenset("script style noscript template head title svg iframe object select textarea canvas audio video datalist".split())
RAW = frozenset("script style noscript template title iframe textarea".split())
_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK_STARTS = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: A start tag closes these open tags, looking up no further than the second set.
_CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})), "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "tr": (frozenset({"tr"}), frozenset({"table"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot"}), frozenset({"table"})), "tfoot": (frozenset({"tbody", "thead", "tfoot"}), frozenset({"table"})), "option": (frozenset({"option"}), frozenset({"select"})),
}
_P = (frozenset({"p"}), frozenset("td th div section article aside main li blockquote body table".split()))


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "hidden", "first", "last")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node] = []
        self.hidden = (parent is not None and parent.hidden) or tag in UNSEEN or ("hidden" in attrs or "none" in attrs or "aria" in attrs) and bool(_HIDDEN.search(attrs))
        self.first = self.last = 0  # its blocks


class Block:
    __slots__ = ("text", "links", "node")

    def __init__(self, text: str, links: int, node: Node):
        self.text, self.links, self.node = text, links, node


def parse(text: str) -> tuple[Node, list[Block], str]:
    """Root of the tree, the visible blocks in order, and the page's title. A node's blocks are those from first up to last."""
    root = Node("#root", "", None)
    now, blocks, title = root, [], ""
    parts: list[str] = []
    links, in_link, home = 0, 0, root

    def flush() -> None:
        nonlocal links
        if parts:
            seen = "".join(parts)
            if "&" in seen:
                seen = entities.unescape(seen)
            if seen := " ".join(seen.split()):
                blocks.append(Block(seen, min(links, len(seen)), home))
            parts.clear()
        links = 0

    def shut(node: Node) -> None:
        nonlocal now
        while True:
            now.last = len(blocks)
            done = now is node
            now = now.parent
            if done:
                return

    def close(which: frozenset[str], limit: frozenset[str]) -> None:
        x = now
        while x is not root and x.tag not in limit:
            if x.tag in which:
                shut(x)
                return
            x = x.parent

    at, end = 0, len(text)
    while at < end:
        m = _TOKEN.search(text, at)
        start = m.start() if m else end
        if start > at and not now.hidden:
            piece = text[at:start]
            if not parts:
                home = now
                while home.tag in INLINE:
                    home = home.parent
            parts.append(piece)
            if in_link:
                links += len(piece.strip())
        if m is None:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if not inline:
            flush()
        if m[1]:
            if tag == "a" and in_link:
                in_link -= 1
            x = now
            while x is not root and x.tag != tag:
                if inline and x.tag in ("td", "th", "table"):
                    x = root
                    break
                x = x.parent
            if x is not root:
                shut(x)
            continue
        if tag in VOID:
            continue
        if (rule := _CLOSES.get(tag)) is not None:
            close(*rule)
        elif tag in _BLOCK_STARTS:
            close(*_P)
        node = Node(tag, m[3], now)
        node.first = len(blocks)
        now.children.append(node)
        if tag in RAW:
            stop = _ENDS[tag].search(text, at)
            if tag == "title" and not title:
                title = _SPACE.sub(" ", entities.unescape(text[at : stop.start() if stop else end])).strip()
            at = stop.end() if stop else end
            node.last = node.first
            continue
        if m[3].rstrip().endswith("/") and tag in ("svg", "path"):
            continue
        now = node
        if tag == "a":
            in_link += 1
    flush()
    while now is not None:
        now.last = len(blocks)
        now = now.parent
    return root, blocks, title


# --- sections

#: Labels of chrome inside and beside the body (fixed values), and the wording of legal lines and notices.
LABELS = re.compile(
    r"(?:популярное(?: за неделю)?|читайте также|реклама|поделиться|распечатать|наверх|скачайте приложение .*|подпи(?:шитесь|сывайтесь) .*"
    r"|(?:смотрите|читайте) (?:ещё|также|по теме)|(?:ещё )?по теме|похожие (?:новости|статьи|материалы)|рекомендуем(?: прочитать)?|вам (?:может|также) понравит\w+"
    r"|follow us|share(?: this page)?|print|back to top|advertisement|(?:read|see) (?:also|more)|(?:more|other|related|similar|recommended)(?: (?:articles?|stories|posts?|news|links?|content|reading|pages?))|related|recommended|you (?:may|might) also like|most read|trending|subscribe.*|sign up for .*|download (?:the|our) app.*|ok|accept(?: all)?|принять|закрыть|close)[.!:]?",
    re.IGNORECASE,
)
COMMENTS = re.compile(r"(?:\d+ )?(?:комментари(?:и|й|ев)(?: закрыты для гостей)?|обсуждение|отзывы(?: гостей| читателей)?|оставить комментарий|comments?(?: are closed.*)?|discussion|leave a (?:comment|reply)|guest reviews)(?: ?\(?\d+\)?)?[.:]?", re.IGNORECASE)
LEGAL = re.compile(r"©|\(c\) ?\d{4}|copyright|all rights reserved|trademarks|все права|копирование материалов|возрастное ограничение определяется|не размещает видео|ознакомительный характер|мнени[ея] (?:редакции|авторов)|editors are not liable|пользовательское соглашение|privacy policy|terms of (?:use|service)", re.IGNORECASE)
NOTICE = re.compile(r"cookie|куки|нажимая «|we value your privacy|запоминать настройки|соглашаетесь с правилами|accept all", re.IGNORECASE)
_CHROME_NAME = re.compile(r"(?:^|[\s_-])(?:foot(?:er)?|nav(?:bar|igation)?|menu|side(?:bar)?|comments?|cookies?|banner|breadcrumbs?|promo|related|share|social|advert|popup|contentinfo|complementary)(?:$|[\s_\d-])", re.IGNORECASE)
_BODY_NAME = re.compile(r"(?:^|[\s_-])(?:content|main|article|post|entry|body|story|text)(?:$|[\s_\d-])", re.IGNORECASE)
_HEADINGS = frozenset(("h1", "h2"))
#: Tags that are parts of one text where they stand side by side; #text is text without a tag of its own.
_FLOW = frozenset("#text p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote figure table hr br details address".split())


def _names(node: Node) -> str:
    return " ".join(a or b or c for a, b, c in _NAMED.findall(node.attrs)) if node.attrs else ""


def _first_tag(block: Block, node: Node) -> str:
    """Tag of the block's line within the section."""
    return block.node.tag if block.node is not node else ""


def chrome(node: Node, blocks: list[Block], last: bool) -> bool:
    """Whether a section is something other than the page's body."""
    own = blocks[node.first : node.last]
    if not own or node.tag in ("nav", "footer", "aside", "button", "form") or _CHROME_NAME.search(_names(node)):
        return True
    size = sum(len(b.text) for b in own)
    linked = sum(b.links for b in own)
    if linked >= 0.75 * size:
        return True
    if len(own) <= 4 and any(NOTICE.search(b.text) for b in own) and (len(own) > 1 or size < 200) and not any(b.node.tag in _HEADINGS for b in own):
        return True
    lead = own[0]
    if lead.node.tag in ("h4", "h5", "h6") and node.tag not in ("main", "article"):
        return True
    if len(lead.text) < 80 and lead.node.tag not in _HEADINGS and (COMMENTS.fullmatch(lead.text) or LABELS.fullmatch(lead.text)):
        return True
    if LEGAL.search(lead.text) and (last or len(own) <= 4) and lead.node.tag not in _HEADINGS:
        return True
    return last and any(LABELS.fullmatch(b.text) or COMMENTS.fullmatch(b.text) for b in own[-2:]) and not any(b.node.tag in _HEADINGS for b in own) and node.tag not in ("main", "article") and size < 600


def sections(root: Node, blocks: list[Block]) -> list[Node]:
    """Sections of a page in order."""
    node = root
    while True:
        shown = [c for c in node.children if not c.hidden and c.last > c.first]
        if len(shown) == 1 and (shown[0].first, shown[0].last) == (node.first, node.last) and shown[0].tag not in ("main", "article", "p", "li", "td") and shown[0].children:
            inner = [c for c in shown[0].children if not c.hidden and c.last > c.first]
            if len(inner) > 1 and not any(c.tag in ("main", "article", "nav", "footer", "aside", "header", "section", "div", "table", "td", "tr", "ul", "body", "tbody") for c in inner):
                return shown
            node = shown[0]
            continue
        break
    out: list[Node] = []

    def open_up(node: Node, depth: int) -> None:
        for c in _flowed(node, blocks):
            inner = [x for x in c.children if not x.hidden and x.last > x.first]
            if _layout(c) or c.tag in ("tbody", "tr") and any(x.tag in ("p", "div", "h1", "h2", "h3", "ul") for cell in _cells(c) for x in cell.children):
                open_up(c, depth)
            elif c.tag in ("div", "section") and depth < 6 and len(inner) > 1 and any(x.tag in ("main", "article", "nav", "footer", "aside") for x in inner):
                open_up(c, depth + 1)
            else:
                out.append(c)

    open_up(node, 0)
    return out


def _span(parts: list[Node], parent: Node, tag: str) -> Node:
    """A section that holds several in a row."""
    out = Node(tag, "", None)
    out.parent, out.children, out.first, out.last = parent, parts, parts[0].first, parts[-1].last
    return out


def _flowed(node: Node, blocks: list[Block]) -> list[Node]:
    """Shown children of a node in order, with its bare text, and each run of parts of one text as one section.

    A label over comments starts a run of them, up to the next heading; at both ends of a run what is chrome by itself
    stands alone, and so does what is named as chrome.
    """
    parts: list[Node] = []
    at = node.first
    for c in [*(c for c in node.children if not c.hidden and c.last > c.first), None]:
        upto = node.last if c is None else c.first
        if upto > at:
            bare = Node("#text", "", None)
            bare.parent, bare.first, bare.last = node, at, upto
            parts.append(bare)
        if c is not None:
            parts.append(c)
            at = c.last
    out: list[Node] = []
    run: list[Node] = []

    def close() -> None:
        alone = lambda n: n.tag not in ("h4", "h5", "h6") and chrome(n, blocks, True)
        lo, hi = 0, len(run)
        if not _label(run[0], blocks):
            while lo < hi and alone(run[lo]):
                lo += 1
            while hi > lo and alone(run[hi - 1]):
                hi -= 1
        out.extend(run[:lo])
        if hi - lo > 1:
            out.append(_span(run[lo:hi], node, "#run"))
        else:
            out.extend(run[lo:hi])
        out.extend(run[hi:])
        run.clear()

    for c in parts:
        flow = c.tag in _FLOW and not _layout(c) and not _CHROME_NAME.search(_names(c))
        if run and (not flow or _label(c, blocks) or c.tag in _HEADINGS and _label(run[0], blocks)):
            close()
        if flow:
            run.append(c)
        else:
            out.append(c)
    if run:
        close()
    return out


def _label(node: Node, blocks: list[Block]) -> bool:
    """Whether a part begins with a label over visitors' comments."""
    lead = blocks[node.first]
    return len(lead.text) < 80 and lead.node.tag not in _HEADINGS and bool(COMMENTS.fullmatch(lead.text))


def _layout(node: Node) -> bool:
    """Whether a table holds sections rather than values."""
    return node.tag == "table" and any(x.tag in ("p", "div", "h1", "h2", "h3", "ul") for cell in _cells(node) for x in cell.children)


def _cells(table: Node) -> Iterator[Node]:
    """Cells of a table, not of tables inside them."""
    for c in table.children:
        if c.tag in ("td", "th"):
            yield c
        elif c.tag in ("tr", "tbody", "thead", "tfoot"):
            yield from _cells(c)


def body(root: Node, blocks: list[Block]) -> tuple[Node | None, list[Block]]:
    """The best section of the page's body, and the blocks of the whole body without the labels that stand among them."""
    if not blocks:
        return None, []
    parts = sections(root, blocks)
    kept, guests = [], False  # guests: below a label over comments that is a section of its own
    for i, n in enumerate(parts):
        guests = (guests or n.last - n.first == 1 and _label(n, blocks)) and n.tag not in ("main", "article") and not any(b.node.tag in _HEADINGS for b in blocks[n.first : n.last])
        if not guests and not chrome(n, blocks, i == len(parts) - 1 and len(parts) > 1):
            kept.append(n)
    if not kept:
        return None, []
    best, score = None, -1.0
    for node in kept:
        own = blocks[node.first : node.last]
        value = float(sum(len(b.text) - b.links for b in own))
        value += 2000 if node.tag in ("main", "article") else 0
        value += 1000 if any(b.node.tag in _HEADINGS for b in own) else 0
        value += 500 if _BODY_NAME.search(_names(node)) else 0
        if value > score:
            best, score = node, value
    if best.tag == "main":
        text = [n for n in kept if n.tag == "main"]
    else:
        text = [n for n in kept if n.tag != "header"] or [best]
    own = [b for n in text for b in blocks[n.first : n.last]]
    if not any(b.node.tag == "h1" for b in own):  # the heading just before
        for n in reversed([n for n in kept if n.last <= text[0].first]):
            head = blocks[n.first : n.last]
            if (at := next((i for i, b in enumerate(head) if b.node.tag in _HEADINGS), None)) is not None:
                own = head[at:] + own if n.tag == "header" else [b for b in head[at:] if b.node.tag in _HEADINGS] + own
                break
    return best, [b for b in own if not (len(b.text) < 120 and b.node.tag not in ("h1", "h2", "td", "th", "li") and (LABELS.fullmatch(b.text) or COMMENTS.fullmatch(b.text)))]


def layout(blocks: list[Block]) -> list[tuple[str, list[list[Block]]]]:
    """How blocks stand on the page: groups of lines, each line a list of blocks.

    A group is a paragraph or heading, a list with an item on each line, or a table with the cells of a row on each line.
    """
    out: list[tuple[str, list[list[Block]]]] = []
    row: Node | None = None
    for b in blocks:
        tag = b.node.tag
        kind = "table" if tag in ("td", "th") else "list" if tag == "li" else "head" if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() else "text"
        if kind == "table" and out and out[-1][0] == kind:
            if b.node.parent is row:
                out[-1][1][-1].append(b)
            else:
                out[-1][1].append([b])
        elif kind == "list" and out and out[-1][0] == kind:
            out[-1][1].append([b])
        else:
            out.append((kind, [[b]]))
        row = b.node.parent if kind == "table" else None
    return out


def rendered(blocks: list[Block]) -> str:
    """Blocks as text: paragraphs apart, items of a list on adjacent lines, cells of a table aligned in columns."""
    out: list[str] = []
    for kind, lines in layout(blocks):
        if kind == "table":
            widths = [max(len(r[i].text) for r in lines if i < len(r)) for i in range(max(map(len, lines)))]
            out.append("\n".join("  ".join(c.text.ljust(w) for c, w in zip(r, widths, strict=False)).rstrip() for r in lines))
        elif kind == "list":
            out.append("\n".join(f"- {r[0].text}" for r in lines))
        else:
            b = lines[0][0]
            out.append(f"{'#' * int(b.node.tag[1])} {b.text}" if kind == "head" else b.text)
    return "\n\n".join(out)


def page_bodies(df: DataFrame, url: str = "url", data: str = "html") -> DataFrame:
    """A row for every page: url, title, blocks (array of tag and text, empty where the page has no body)."""
    kind = pa.list_(pa.struct([("tag", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                titles, ends, tags, texts = [], [0], [], []
                for raw in part.column(1).to_pylist():
                    root, blocks, title = parse(decode(raw))
                    titles.append(title)
                    own = [b for _, lines in layout(body(root, blocks)[1]) for line in lines for b in line]
                    tags += [b.node.tag for b in own]
                    texts += [b.text for b in own]
                    ends.append(len(texts))
                rows = pa.StructArray.from_arrays([pa.array(tags, pa.string()), pa.array(texts, pa.string())], fields=list(kind.value_type))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(titles, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)], names=[url, "title", "blocks"])

    return spread(df.select(url, data)).mapInArrow(run, f"`{url}` string, title string, blocks array<struct<tag: string, text: string>>")


def body_texts(df: DataFrame, url: str = "url", data: str = "html") -> DataFrame:
    """Every page's url and its rendered body; null where it has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for raw in batch.column(1).to_pylist():
                root, blocks, _ = parse(decode(raw))
                texts.append(rendered(body(root, blocks)[1]) or None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[url, "body_text"])

    return spread(df.select(url, data)).mapInArrow(run, f"`{url}` string, body_text string")
