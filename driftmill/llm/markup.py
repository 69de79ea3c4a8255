"""Mixed markup to clean text that keeps headings, lists, code blocks and formulas.

A text may mix HTML, BBCode, Markdown, wiki and LaTeX markup. Code and formulas are set aside first, from left to right,
so nothing inside them is read as markup. All other marks are turned into one line grammar, and its lines become blocks:
heading, list_item, code_block, formula and paragraph, each with the container it stands in.

Which blocks are content is decided for all blocks of a document together, as a minimum cut. A linear classifier's costs of
the two labels are the capacities to source and sink. It is fitted on blocks of the tables themselves that are labelled
by their class or by their repetition, starting from PRIOR, from which few labels move it little and none not at all.
Neighbours, and blocks next to each other in one container, are joined by smoothness edges that weaken with the distance
of their containers in the document tree, and a maximum flow separates content from boilerplate: a short line of no clear
kind goes with what surrounds it. If every block prefers the same label by itself, that labelling is the minimum cut, and
no flow has to be computed.

Defined results: a null or empty text has no blocks; marks that are never closed count as text; a heading, item, code
block or formula without text is none; a dollar sign before a price is no formula; inline code is text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmill.session import spread

_ASIDE = re.compile(
    r"<pre\b[^>]*>(?:\s*<code\b[^>]*>)?(?P<pre>.*?)(?:</code>\s*)?</pre>"
    r"|<(?P<tag>syntaxhighlight|source)\b[^>]*>(?P<wiki>.*?)</(?P=tag)>"
    r"|\[code(?:=[^\]\n]*)?\](?P<bb>.*?)\[/code\]"
    r"|(?:^|(?<=\n))[ \t]*(?P<fence>```+|~~~+)[^\n`]*\n(?P<md>.*?)(?:^|(?<=\n))[ \t]*(?P=fence)[ \t]*(?=\n|$|<)"
    r"|\\begin\{(?P<verb>verbatim\*?|lstlisting|minted)\}(?:\[[^\]\n]*\])?(?P<tex>.*?)\\end\{(?P=verb)\}"
    r"|<math\b[^>]*>(?P<math>.*?)</math>"
    r"|\[math\](?P<bbmath>.*?)\[/math\]"
    r"|\\begin\{(?P<env>(?:equation|align|gather|multline|displaymath|math|eqnarray)\*?)\}(?P<eq>.*?)\\end\{(?P=env)\}"
    r"|\$\$(?P<dd>[^$]+?)\$\$"
    r"|(?<!\\)\\\[(?P<brackets>.+?)\\\]|(?<!\\)\\\((?P<parens>.+?)\\\)"
    r"|(?<![\\$\w])\$(?P<d>[^\s$](?:[^$\n]*[^\s$\\])?)\$(?![\d$])",
    re.DOTALL | re.IGNORECASE,
)
_CODE = ("pre", "wiki", "bb", "md", "tex")
_FORMULA = ("math", "bbmath", "eq", "dd", "brackets", "parens", "d")
_ASIDE_HINT = re.compile(r"<(?:pre|math|syntax|source)|\[code|\[math|```|~~~|\\[\[(b]|\$", re.IGNORECASE)

HEAD, ITEM, OPEN, SHUT, MARK = "\x01", "\x02", "\x03", "\x04", "\x05"
_SET_ASIDE = re.compile(f"{MARK}(\\d+){MARK}")
_JUNK = re.compile(r"<!--.*?-->|<(script|style|template|noscript)\b.*?</\1>|[\x00-\x05]", re.DOTALL | re.IGNORECASE)
_MARKER = re.compile(r"<span\b[^>]*\bclass=[\"'][^\"']*\bmarker\b[^\"']*[\"'][^>]*>(.*?)</span>", re.DOTALL | re.IGNORECASE)
_IMG = re.compile(r"<img\b[^>]*?\balt=[\"']([^\"']*)[\"'][^>]*>", re.IGNORECASE)
#: An HTML heading or item runs over line ends up to the next of these.
_WRAPPED = re.compile(r"(<(?:h[1-6]|li)\b[^>]*>)(.*?)(?=</?(?:h[1-6]|li|ul|ol|p|div|table|blockquote)\b|\Z)", re.DOTALL | re.IGNORECASE)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)\b[^<>]*>")
_INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark nobr q s samp small span strike strong sub sup tt u var wbr".split())
_CONTAINERS = frozenset("article aside blockquote body div dl details figure footer form header main nav ol section table tbody td tr ul".split())
_BB = re.compile(r"\[(/?)(h[1-6]|list|\*|b|i|u|s|quote|spoiler|center|right|size|color|url|img|character|anime|manga|person|entry|div|span|p|br|hr)(?:=[^\]\n]*)?\]", re.IGNORECASE)
_TEX_HEAD = re.compile(r"\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph|title)\*?\{((?:[^{}]|\{[^{}]*\})*)\}")
_TEX_INLINE = re.compile(r"\\(?:text(?:bf|it|tt|sc|sf|rm|up|sl)|emph|underline|mbox|textnormal)\{((?:[^{}]|\{[^{}]*\})*)\}")
_TEX_OTHER = re.compile(r"\\(?:begin|end)\{[a-zA-Z*]+\}(?:\[[^\]\n]*\])?|\\(?:maketitle|tableofcontents|centering|noindent|newpage|par)\b")
_TEX_ITEM = re.compile(r"\\item\b(?:\[[^\]\n]*\])?[ \t]*")
_MD_HEAD = re.compile(r"(#{1,6})[ \t]+(.*?)(?:[ \t]+#+)?$")
_WIKI_HEAD = re.compile(r"(={1,6})[ \t]*([^=].*?)[ \t]*\1$")
_UNDER = re.compile(r"(?:-{3,}|={3,})$")
_BULLET = re.compile(r"(?:[-+•–]|\*+|#+|\d{1,3}[.)])[ \t]+(.*)$")
_HASH = re.compile(r"#+[ \t]+\S")
_RULE = re.compile(r"(?:[-*_=] ?){3,}$|\|?[-:| ]{3,}$")
_STRONG = re.compile(r"(?<![\w*])(\*{1,3})(?=\S)([^*\n]+?)(?<=\S)\1(?![\w*])|(?<!\w)(_{1,3})(?=\S)([^_\n]+?)(?<=\S)\3(?!\w)")
_WIKI_INLINE = re.compile(r"'{2,5}")
_LINK = re.compile(r"!?\[([^\[\]\n]*)\]\((?:[^()\s]|\([^()]*\))*(?:\s+\"[^\"\n]*\")?\)")
_WIKI_LINK = re.compile(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]*)\]\]")
_TICK = re.compile(r"(?<!`)(`+)(?!`)([^`\n]+?)\1(?!`)")
_SPACE = re.compile(r"\s+")


@dataclass(frozen=True)
class Block:
    kind: str
    text: str
    container: int
    level: int = 0
    path: tuple[int, ...] = ()  # containers from the outermost to its own


def _bare(text: str, aside: list[tuple[str, str]]) -> str:
    """Text of a line without inner markup."""
    if "\\" in text:
        text = _TEX_INLINE.sub(r"\1", _TEX_INLINE.sub(r"\1", text))
    if "[" in text:
        text = _WIKI_LINK.sub(r"\1", _LINK.sub(r"\1", text))
    if "`" in text:
        text = _TICK.sub(r"\2", text)
    if "*" in text or "_" in text:
        text = _STRONG.sub(lambda m: m[2] or m[4], _STRONG.sub(lambda m: m[2] or m[4], text))
    if "''" in text:
        text = _WIKI_INLINE.sub("", text)
    text = html.unescape(text)
    if MARK in text:
        text = _SET_ASIDE.sub(lambda m: f" {aside[int(m[1])][1]} ", text)
    return _SPACE.sub(" ", text).strip()


def _tag(m: re.Match) -> str:
    closing, name = m[1], m[2].lower()
    if name in _INLINE:
        return ""
    if name == "li":
        return "\n" if closing else f"\n{ITEM}"
    if len(name) == 2 and name[0] == "h" and name[1] in "123456":
        return "\n\n" if closing else f"\n\n{HEAD}{name[1]}"
    if name in _CONTAINERS:
        return f"\n{SHUT if closing else OPEN}\n"
    return "\n\n" if name in ("p", "dt", "dd", "hr") else "\n"


def _bb(m: re.Match) -> str:
    closing, name = m[1], m[2].lower()
    if name == "*":
        return f"\n{ITEM}"
    if name[0] == "h" and name[1:].isdigit():
        return "\n\n" if closing else f"\n\n{HEAD}{name[1]}"
    if name in ("list", "quote", "spoiler", "div"):
        return f"\n{SHUT if closing else OPEN}\n"
    return "\n" if name in ("p", "br", "hr", "center", "right") else ""


def blocks(text: str | None) -> list[Block]:
    """Blocks of a text in order, before any of them is judged."""
    if not text:
        return []
    aside: list[tuple[str, str]] = []
    text = _JUNK.sub("", text.replace("\r\n", "\n").replace("\r", "\n").replace("\xa0", " "))
    if _ASIDE_HINT.search(text):

        def put(m: re.Match) -> str:
            name = next(k for k in (*_CODE, *_FORMULA) if m[k] is not None)
            body = html.unescape(m[name]) if name in ("pre", "wiki", "bb", "math", "bbmath", "brackets", "parens", "d", "dd") else m[name]
            if name == "pre":
                body = re.sub(r"</?(?:span|b|i|code|em|a)\b[^>]*>", "", m[name])
                body = html.unescape(re.sub(r"<br\s*/?>", "\n", body))
            aside.append(("code_block" if name in _CODE else "formula", body.strip("\n")))
            mark = f"{MARK}{len(aside) - 1}{MARK}"
            return f"\n{mark}\n" if name in _CODE else mark

        text = _ASIDE.sub(put, text)
    if "<" in text:
        text = _MARKER.sub(f"\n{OPEN}marker\\1{SHUT}\n", text)
        text = _IMG.sub(r" \1 ", text)
        text = _WRAPPED.sub(lambda m: m[1] + m[2].replace("\n", " "), text)
        text = _TAG.sub(_tag, text)
    if "[" in text:
        text = _BB.sub(_bb, text)
    if "\\" in text:
        text = _TEX_HEAD.sub(lambda m: f"\n\n{HEAD}2{m[1]}\n\n", text)
        text = _TEX_OTHER.sub("\n", _TEX_ITEM.sub(f"\n{ITEM}", text))
    out: list[Block] = []
    stack, containers = [0], 0
    lines = text.split("\n")
    stripped = [line.strip() for line in lines]
    n = len(stripped)

    def add(kind: str, raw: str, level: int = 0) -> None:
        for m in _SET_ASIDE.finditer(raw) if MARK in raw else ():
            what, body = aside[int(m[1])]
            if body.strip():
                out.append(Block(what, body if what == "code_block" else body.strip(), stack[-1], 0, tuple(stack)))
        alone = _SET_ASIDE.sub("", raw) if MARK in raw else raw
        if alone.strip() and (bare := _bare(raw, aside)):
            out.append(Block(kind, bare, stack[-1], level, tuple(stack)))

    i = 0
    while i < n:
        line = stripped[i]
        i += 1
        if not line:
            continue
        if line[0] == OPEN:
            containers += 1
            if line.startswith(f"{OPEN}marker"):
                if bare := _bare(line[7:].rstrip(SHUT), aside):
                    out.append(Block("marker", bare, containers, 0, (*stack, containers)))
                continue
            stack.append(containers)
            continue
        if line[0] == SHUT:
            if len(stack) > 1:
                stack.pop()
            continue
        if line[0] == HEAD:
            add("heading", line[2:], int(line[1]))
            continue
        if line[0] == ITEM:
            add("list_item", line[1:])
            continue
        after = stripped[i] if i < n else ""
        if _UNDER.match(after) and not _RULE.match(line):
            add("heading", line, 1 if after[0] == "=" else 2)
            i += 1
            continue
        if _RULE.match(line):
            continue
        if line[0] == "#" and (m := _MD_HEAD.match(line)):
            before = stripped[i - 2] if i > 1 else ""
            if _HASH.match(after) or _HASH.match(before):  # wiki's numbered list: a run of such lines
                add("list_item", line.lstrip("#"))
            else:
                add("heading", m[2], len(m[1]))
            continue
        if line[0] == "=" and (m := _WIKI_HEAD.match(line)):
            add("heading", m[2], len(m[1]))
            continue
        if m := _BULLET.match(line):
            add("list_item", m[1])
            continue
        add("paragraph", line)
    return out


# --- labelling

#: Words that mark chrome rather than content (fixed values).
_CHROME = re.compile(r"^(?:spoiler|спойлер|share|поделиться|реклама|advertisement|read (?:also|more)|читайте также|follow us|подпи(?:сывайтесь|шитесь).*|подробнее|наверх|распечатать|комментарии|comments|log ?in|войти|©.*|all rights reserved.*|все права .*)$", re.IGNORECASE)
STRUCTURE = frozenset(("heading", "list_item", "code_block", "formula"))
#: Weights from which fitting starts, for the label content: bias, structure, words (up to WORDS), wording of chrome, marker class, end of a sentence.
PRIOR, WORDS = (1.0, 3.0, 0.15, -4.0, -6.0, 0.5), 20
#: The weight of the prior; texts that hold a line, and its length at most, from which it counts as boilerplate.
PRIOR_WEIGHT, REPEATED, SHORT = 20, 20, 60
#: Capacity of the edge between neighbours of one container, and between blocks next to each other in one container.
NEXT, SAME = 0.8, 0.4


def features(block: Block) -> tuple[float, ...]:
    short = block.kind == "paragraph" and len(block.text) < 120
    return (1.0, float(block.kind in STRUCTURE), float(min(WORDS, block.text.count(" ") + 1)), float(short and bool(_CHROME.match(block.text))), float(block.kind == "marker"), float(block.kind == "paragraph" and block.text[-1:] in ".!?…:;»”)"))


def fit(rows: dict[tuple[tuple[float, ...], bool], int], steps: int = 25) -> tuple[float, ...]:
    """Weights of a logistic classifier of content, from counts of (features, is content): the likeliest under a normal prior around PRIOR.

    Newton's method. Both labels weigh the same as a whole; without rows of both the weights are PRIOR.
    """
    if len({y for _, y in rows}) < 2:
        return PRIOR
    told = sorted(rows)
    x, y, n = np.array([f for f, _ in told]), np.array([float(k) for _, k in told]), np.array([rows[t] for t in told], float)
    total, ones = n.sum(), (n * y).sum()
    # as many rows as PRIOR_WEIGHT is meant against, whatever their number
    weight = n * np.where(y > 0, 0.5 / ones, 0.5 / (total - ones)) * min(total, 10_000)
    w = prior = np.array(PRIOR)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + PRIOR_WEIGHT * (w - prior)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + PRIOR_WEIGHT * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w - step
        if abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def labelled(text: str) -> list[tuple[int | None, tuple[float, ...], bool]]:
    """Blocks of a text with labels: (hash of a short line, features, whether its class lets it be content). Lines stand once."""
    out: list[tuple[int | None, tuple[float, ...], bool]] = []
    seen: set[int] = set()
    for b in blocks(text):
        line = xxhash.xxh64_intdigest(b.text) >> 1 if b.kind == "paragraph" and len(b.text) < SHORT else None
        if line is None or line not in seen:
            out.append((line, features(b), b.kind != "marker"))
            seen.add(line or -1)
    return out


def counted(rows: list[tuple[int | None, tuple[float, ...], bool]]) -> dict[tuple[tuple[float, ...], bool], int]:
    """Counts of (features, is content): short lines that stand in REPEATED texts are no content."""
    lines, out = Counter(line for line, _, _ in rows if line is not None), Counter()
    for line, f, content_ in rows:
        out[f, content_ and lines.get(line, 0) < REPEATED] += 1
    return out


def costs(block: Block, weights: tuple[float, ...] = PRIOR) -> tuple[float, float]:
    """Cost of the labels content and boilerplate: their negative log-likelihood."""
    f = sum(w * x for w, x in zip(weights, features(block), strict=True))
    small = math.log1p(math.exp(-abs(f)))
    return (small, f + small) if f >= 0 else (small - f, small)


def distance(a: Block, b: Block) -> int:
    """Steps between the containers of two blocks in the document tree."""
    same = 0
    for x, y in zip(a.path, b.path, strict=False):
        if x != y:
            break
        same += 1
    return len(a.path) + len(b.path) - 2 * same


def min_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source side of a minimum cut. source and sink: capacities to the terminals; edges run both ways.

    Augments along shortest paths with level graphs. Ties go to the source side as far as the flow leaves it reachable.
    """
    n = len(source)
    s, t = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def join(a: int, b: int, ab: float, ba: float) -> None:
        graph[a].append(len(to))
        to.append(b)
        cap.append(ab)
        graph[b].append(len(to))
        to.append(a)
        cap.append(ba)

    for i in range(n):
        shared = min(source[i], sink[i])  # flows straight through
        join(s, i, source[i] - shared, 0.0)
        join(i, t, sink[i] - shared, 0.0)
    for a, b, c in edges:
        join(a, b, c, c)
    eps = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if cap[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            # what can still reach the sink is cut off from the source; the rest stays with it
            reach, queue = {t}, deque([t])
            while queue:
                b = queue.popleft()
                for e in graph[b]:
                    if cap[e ^ 1] > eps and to[e] not in reach:
                        reach.add(to[e])
                        queue.append(to[e])
            return [i not in reach for i in range(n)]
        nth = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                path, a = [], s
                continue
            while nth[a] < len(graph[a]):
                e = graph[a][nth[a]]
                if cap[e] > eps and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                nth[a] += 1
            else:
                if a == s:
                    break
                a = to[path.pop() ^ 1]
                nth[a] += 1


def content(found: list[Block], weights: tuple[float, ...] = PRIOR, smooth: bool = True) -> list[Block]:
    """The blocks that the minimum cut labels content. smooth: with edges between blocks."""
    pairs = [costs(b, weights) for b in found]
    prefer = [keep >= drop for drop, keep in pairs]
    if all(prefer):
        return found
    if not any(prefer):
        return []
    edges: list[tuple[int, int, float]] = []
    if smooth:
        edges = [(i, i + 1, NEXT / (1 + distance(found[i], found[i + 1]))) for i in range(len(found) - 1)]
        last: dict[int, int] = {}
        for i, b in enumerate(found):
            if b.container in last:
                edges.append((last[b.container], i, SAME))
            last[b.container] = i
    labels = min_cut([keep for _, keep in pairs], [drop for drop, _ in pairs], edges)
    return [b for b, keep in zip(found, labels, strict=True) if keep]


def clean(text: str | None, weights: tuple[float, ...] = PRIOR) -> str | None:
    """Clean text: Markdown for the structure that stays, one block a paragraph, items of a list on adjacent lines."""
    if text is None:
        return None
    out: list[str] = []
    before = ""
    for b in content(blocks(text), weights):
        if b.kind == "heading":
            line = f"{'#' * max(1, b.level)} {b.text}"
        elif b.kind == "list_item":
            line = f"- {b.text}"
        elif b.kind == "code_block":
            line = f"```\n{b.text}\n```"
        elif b.kind == "formula":
            line = f"$${b.text}$$"
        else:
            line = b.text
        out.append(("" if not out else "\n" if b.kind == before == "list_item" else "\n\n") + line)
        before = b.kind
    return "".join(out)


def elements(text: str | None, weights: tuple[float, ...] = PRIOR) -> list[tuple[str, str]]:
    """(kind, bare text) of every heading, list item, code block and formula among the content."""
    if not text:
        return []
    return [(b.kind, b.text) for b in content(blocks(text), weights) if b.kind in STRUCTURE]


def learned(df: DataFrame, text: str) -> tuple[float, ...]:
    """Weights fitted on all labelled texts of a table, those with a marker class; only counts of feature rows come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = Counter(x for t in batch.column(0).to_pylist() for x in labelled(t))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in told], pa.int64()), pa.array([list(x[1]) for x in told], pa.list_(pa.float64())), pa.array([x[2] for x in told], pa.bool_()), pa.array(list(told.values()), pa.int64())], names=["line", "f", "content", "n"])

    rows = df.where(F.contains(text, F.lit("marker"))).select(F.col(text).alias("t")).mapInArrow(run, "line bigint, f array<double>, content boolean, n bigint")
    lines = rows.groupBy("line", "f", "content").agg(F.sum("n").alias("n"))
    kept = F.col("content") & (F.col("line").isNull() | (F.col("n") < REPEATED))
    told = lines.select("f", kept.alias("content"), "n").groupBy("f", "content").agg(F.sum("n").alias("n")).collect()  # features take some hundred values
    return fit({(tuple(r["f"]), r["content"]): r["n"] for r in told})


def markup_elements(df: DataFrame, keys: list[str], text: str, weights: tuple[float, ...] = PRIOR) -> DataFrame:
    """A row for every element: the keys, ordinal from 0, element_kind, element_text. Extra columns aren't read."""
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, n, kind, body) for i, t in enumerate(batch.column(len(keys)).to_pylist()) for n, (kind, body) in enumerate(elements(t, weights))]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            take = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(i).take(take) for i in range(len(keys))] + [pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())], names=[*keys, "ordinal", "element_kind", "element_text"])

    return df.where(F.length(text) > 0).select(*keys, F.col(text).alias("__text")).mapInArrow(run, f"{fields}, ordinal int, element_kind string, element_text string")


def clean_texts(df: DataFrame, keys: list[str], text: str, weights: tuple[float, ...] = PRIOR) -> DataFrame:
    """Every row's keys and its clean text."""
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), pa.array([clean(t, weights) for t in batch.column(len(keys)).to_pylist()], pa.string())], names=[*keys, "clean_text"])

    return df.select(*keys, F.col(text).alias("__text")).mapInArrow(run, f"{fields}, clean_text string")


def text_md5(column: str):
    """MD5 of a text after every run of white space is made one space and the ends are trimmed."""
    return F.md5(F.trim(F.regexp_replace(F.col(column), r"(?U)[\s\x1c-\x1f]+", " ")))


#: Tables, their key and the column with markup.
SOURCES = (("reviews", "review_id", "body_html"), ("news", "source_id", "content_html"), ("animes", "record_id", "descriptionhtml"))


def _tables(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, key, column in SOURCES:
        one = spread(tables[name].select(F.lit(name).alias("source_table"), F.col(key).cast("string").alias("record_key"), F.col(column).alias("body")))
        out = one if out is None else out.unionByName(one)
    return out


def found(tables: dict[str, DataFrame]) -> DataFrame:
    rows = _tables(tables)
    told = markup_elements(rows, ["source_table", "record_key"], "body", learned(rows, "body"))
    return told.select("source_table", "record_key", "element_kind", text_md5("element_text").alias("element_md5")).distinct()


def cleaned(tables: dict[str, DataFrame]) -> DataFrame:
    rows = _tables(tables)
    return clean_texts(rows, ["source_table", "record_key"], "body", learned(rows, "body"))
