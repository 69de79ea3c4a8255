"""Deeply nested records to related flat tables.

Each record is read by a token scanner, never as a whole tree, into path-value-ordinal triples. Paths are grouped by
their nearest repeated ancestor (the longest prefix that ends in ``[]``), and each group is pivoted into one table whose
rows know the ordinals and the keys of all their ancestors. All of this happens inside the record, so the operator adds
no shuffle; a record's memory is that of its own triples.

Defined results: a null, empty or unreadable (cut off) text gives no rows; a text that is itself a JSON string is read
again, up to three times; an object where the layout expects a list counts as a list of one; nulls inside a list hold
their ordinal but give no row; repeated object keys keep the last value; extra columns pass unread.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|"((?:[^"\\\x00-\x1f]|\\.)*)"|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?)|(true|false|null))')
_BLANK = re.compile(r"[ \t\n\r]*")
#: Times that a text which is one JSON string is read again.
REREADS = 3


class Unreadable(ValueError):
    """The text is not one complete JSON value."""


@dataclass(frozen=True)
class Layout:
    """How one JSON column is laid out.

    repeated: canonical paths, without a trailing ``[]``, of nodes that hold rows ("" is the root); an object found there
    counts as a list of one. wrappers: keys that may wrap the whole value. keys: the leaf that names a row, by table.
    leaves: the leaves to keep as attributes, by table; None keeps all.
    """

    repeated: frozenset[str] = frozenset()
    wrappers: frozenset[str] = frozenset()
    keys: dict[str, str] = field(default_factory=dict)
    leaves: dict[str, frozenset[str]] | None = None


def scan(text: str, rereads: int = REREADS) -> Iterator[tuple[tuple[str, ...], tuple[int, ...], str | None, str]]:
    """Triples (path, ordinals, value) and the value's kind, in document order; path has a ``[]`` for every ordinal.

    Raises Unreadable at the point where the text stops being JSON; what was yielded before must then be dropped.
    """
    path: list[str] = []
    ordinals: list[int] = []
    stack: list[str] = []
    state, at, end = "value", 0, len(text)
    match = _TOKEN.match
    while True:
        m = match(text, at)
        if m is None:
            raise Unreadable(f"at {at}")
        at = m.end()
        mark, string, number, word = m.groups()
        if state == "value" or (state == "first" and mark != "]"):
            if state == "first":
                ordinals.append(0)
            if mark == "{":
                stack.append("{")
                state = "key or end"
                continue
            if mark == "[":
                stack.append("[")
                path.append("[]")
                state = "first"
                continue
            if mark is not None:
                raise Unreadable(f"{mark} at {at}")
            if string is not None:
                if "\\" in string:
                    try:
                        string = json.loads(f'"{string}"')
                    except ValueError as e:
                        raise Unreadable(str(e)) from e
                if not stack and rereads:
                    if _BLANK.match(text, at).end() != end:
                        raise Unreadable(f"more after the value at {at}")
                    yield from scan(string, rereads - 1)
                    return
                yield tuple(path), tuple(ordinals), string, "string"
            elif number is not None:
                yield tuple(path), tuple(ordinals), number, "number"
            else:
                yield tuple(path), tuple(ordinals), None if word == "null" else word, "null" if word == "null" else "boolean"
        elif state == "first":
            stack.pop()
            path.pop()
        elif state in ("key", "key or end"):
            if mark == "}" and state == "key or end":
                stack.pop()
            elif string is not None:
                path.append(json.loads(f'"{string}"') if "\\" in string else string)
                state = "colon"
                continue
            else:
                raise Unreadable(f"no key at {at}")
        elif state == "colon":
            if mark != ":":
                raise Unreadable(f"no colon at {at}")
            state = "value"
            continue
        elif state == "next":
            if mark == ",":
                if stack[-1] == "[":
                    ordinals[-1] += 1
                    state = "value"
                else:
                    path.pop()
                    state = "key"
                continue
            if mark == "]" and stack[-1] == "[":
                ordinals.pop()
            elif mark == "}" and stack[-1] == "{":
                path.pop()
            else:
                raise Unreadable(f"no comma at {at}")
            if mark == "]":
                path.pop()
            stack.pop()
        if not stack:
            if _BLANK.match(text, at).end() != end:
                raise Unreadable(f"more after the value at {at}")
            return
        state = "next"


def canonical(path: tuple[str, ...], layout: Layout) -> tuple[str, str, tuple[int, ...]]:
    """Table, leaf, and for each of the table's ordinals the index of the path's ordinal (-1: an object that stands for a list of one)."""
    steps = list(path)
    if len(steps) > 1 and steps[0] in layout.wrappers:
        steps = steps[1:]
    out, source, seen, table, leaf = "", [], 0, "", []
    for step in [*steps, None]:
        if out in layout.repeated and step != "[]":
            out, table, leaf = out + "[]", out + "[]", []
            source.append(-1)
        if step is None:
            break
        if step == "[]":
            out, table, leaf = out + "[]", out + "[]", []
            source.append(seen)
            seen += 1
        else:
            out += ("." if out and not out.endswith("[]") else "") + (("." + step) if out.endswith("[]") else step)
            leaf.append(step)
    return table, ".".join(leaf), tuple(source)


class Shredder:
    """Pivots one record's triples, and keeps what it learned about paths for the next record."""

    def __init__(self, layout: Layout):
        self.layout, self.known = layout, {}

    def rows(self, text: str | None) -> list[tuple[str, tuple[int, ...], list[str | None], dict[str, str | None]]]:
        """(table, ordinals, keys of the row and its ancestors from the outermost, attributes); [] if the text can't be read."""
        if not text:
            return []
        keys, leaves, known = self.layout.keys, self.layout.leaves, self.known
        groups: dict[tuple[str, tuple[int, ...]], dict[str, str | None]] = {}
        try:
            for path, ordinals, value, _ in scan(text):
                if (where := known.get(path)) is None:
                    where = known[path] = canonical(path, self.layout)
                table, leaf, source = where
                if value is None and not leaf:
                    continue  # a null in a list
                at = tuple(ordinals[i] if i >= 0 else 0 for i in source)
                if (row := groups.get((table, at))) is None:
                    row = groups[table, at] = {}
                if leaves is None or leaf in leaves.get(table, ()) or keys.get(table) == leaf:
                    row[leaf] = value
        except Unreadable:
            return []
        if len(known) > 50_000:  # paths whose names are data
            known.clear()
        out = []
        for (table, at), row in groups.items():
            parts, chain = table.split("[]")[:-1], []
            for n in range(1, len(parts) + 1):
                name = "[]".join(parts[:n]) + "[]"
                chain.append(groups.get((name, at[:n]), {}).get(keys.get(name, "")))
            out.append((table, at, chain, row))
        return out


#: Records whose rows make one batch.
RECORDS = 512


def nested_rows(df: DataFrame, layouts: dict[str, Layout], *keep: str) -> DataFrame:
    """All flat rows of all tables: the kept columns, then source, table, ordinals, keys, attributes.

    source is the JSON column; table the path of the repeated ancestor ("" holds the record's own fields); ordinals and
    keys those of the row and its ancestors, so ``slice(ordinals, 1, size(ordinals) - 1)`` is the parent's.
    """
    columns = [*keep, *layouts]
    kept = df.select(*keep).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = f"{fields}, source string, `table` string, ordinals array<int>, `keys` array<string>, attributes map<string,string>"

    def shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shredders = {c: Shredder(layout) for c, layout in layouts.items()}
        names = [*keep, "source", "table", "ordinals", "keys", "attributes"]
        for whole in batches:
            for lo in range(0, whole.num_rows, RECORDS):  # a record may give a hundred rows and more
                batch = whole.slice(lo, RECORDS)
                index, source, tables, ordinals, chains, attributes = [], [], [], [], [], []
                for name, shredder in shredders.items():
                    for i, text in enumerate(batch.column(columns.index(name)).to_pylist()):
                        for table, at, chain, row in shredder.rows(text):
                            index.append(i)
                            source.append(name)
                            tables.append(table)
                            ordinals.append(at)
                            chains.append(chain)
                            attributes.append(list(row.items()))
                take = pa.array(index, pa.int32())
                made = [pa.array(source, pa.string()), pa.array(tables, pa.string()), pa.array(ordinals, pa.list_(pa.int32())), pa.array(chains, pa.list_(pa.string())), pa.array(attributes, pa.map_(pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column(i).take(take) for i in range(len(keep))] + made, names=names)

    return df.select(*(F.col(c) for c in keep), *(F.col(c).cast("string").alias(c) for c in layouts)).mapInArrow(shred, schema)


def flat_table(rows: DataFrame, source: str, table: str, keep: list[str], leaves: dict[str, str]) -> DataFrame:
    """One table of nested_rows: the kept columns, parent_ordinals, ordinal, parent_keys, and a column for each leaf."""
    n = F.size("ordinals")
    return rows.where((F.col("source") == source) & (F.col("table") == table)).select(
        *keep, F.slice("ordinals", F.lit(1), F.greatest(n - 1, F.lit(0))).alias("parent_ordinals"), F.try_element_at("ordinals", F.lit(-1)).alias("ordinal"), F.slice("keys", F.lit(1), F.greatest(F.size("keys") - 1, F.lit(0))).alias("parent_keys"),
        *(F.try_element_at("attributes", F.lit(leaf)).alias(name) for leaf, name in leaves.items()),
    )


def triples(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """The path-value-ordinal triples themselves: kept columns, path, ordinals, value, kind; none for an unreadable text."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, out = [], ([], [], [], [])
            for i, text in enumerate(batch.column(len(keep)).to_pylist()):
                if not text:
                    continue
                try:
                    found = list(scan(text))
                except Unreadable:
                    continue
                for path, ordinals, value, kind in found:
                    index.append(i)
                    for to, x in zip(out, ("".join(p if p == "[]" else f".{p}" for p in path), ordinals, value, kind), strict=True):
                        to.append(x)
            take = pa.array(index, pa.int32())
            kinds = (pa.string(), pa.list_(pa.int32()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(i).take(take) for i in range(len(keep))] + [pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=[*keep, "path", "ordinals", "value", "kind"])

    return df.select(*(F.col(c) for c in keep), F.col(column).cast("string").alias("__json")).mapInArrow(run, f"{kept}, path string, ordinals array<int>, value string, kind string")


#: Layouts of the entity rows and of the news payload.
ENTITY_LAYOUTS = {
    name: Layout(frozenset({""}), frozenset({"items", "nodes", wrapper}), {"[]": "id"}, {"[]": frozenset(leaves)})
    for name, wrapper, leaves in (("related", "related", ("anime.id", "manga.id")), ("characterroles", "characterRoles", ("character.id",)), ("personroles", "personRoles", ("person.id",)))
}
NEWS_LAYOUT = {
    "nuxt_news": Layout(
        frozenset({"tags", "shows", "shows[].seasons", "shows[].seasons[].episodes"}), frozenset({"news"}),
        {"tags[]": "alias", "shows[]": "id", "shows[].seasons[]": "number", "shows[].seasons[].episodes[]": "id"}, {"": frozenset({"category.alias"})},
    )
}


def _link(parent_kind: Column | str, parent_key: Column, child_kind: str, child_key: Column) -> Column:
    return F.struct((F.lit(parent_kind) if isinstance(parent_kind, str) else parent_kind).alias("parent_kind"), F.nullif(F.trim(parent_key), F.lit("")).alias("parent_key"), F.lit(child_kind).alias("child_kind"), F.nullif(F.trim(child_key), F.lit("")).alias("child_key"))


def entity_links(animes: DataFrame, news: DataFrame) -> DataFrame:
    """Every parent-child link in the nested columns of the entity and news tables, once each.

    Columns root_kind, root_id, parent_kind, parent_key, child_kind, child_key. A link with no readable key on either
    end gives no row, nor does a record without a key.
    """
    root = F.col("root_id").cast("string")
    key = lambda i: F.try_element_at("keys", F.lit(i))
    leaf = lambda name: F.try_element_at("attributes", F.lit(name))
    of = lambda source, table: (F.col("source") == source) & (F.col("table") == table)

    a = nested_rows(animes.select(F.col("record_id").cast("bigint").alias("root_id"), *ENTITY_LAYOUTS), ENTITY_LAYOUTS, "root_id").where("`table` = '[]'")
    role = F.when(F.col("source") == "characterroles", "character_role").otherwise("person_role")
    anime_links = F.when(F.col("source") == "related", F.array(_link("anime", root, "related", key(1)), _link("related", key(1), "related_anime", leaf("anime.id")), _link("related", key(1), "related_manga", leaf("manga.id")))).when(
        F.col("source") == "characterroles", F.array(_link("anime", root, "character_role", key(1)), _link(role, key(1), "character", leaf("character.id")))
    ).otherwise(F.array(_link("anime", root, "person_role", key(1)), _link(role, key(1), "person", leaf("person.id"))))

    n = nested_rows(news.select(F.col("source_id").cast("bigint").alias("root_id"), "nuxt_news"), NEWS_LAYOUT, "root_id")
    season = F.concat(key(1), F.lit(":"), key(2))
    src = "nuxt_news"
    news_links = (
        F.when(of(src, ""), F.array(_link("news", root, "category", leaf("category.alias"))))
        .when(of(src, "tags[]"), F.array(_link("news", root, "tag", key(1))))
        .when(of(src, "shows[]"), F.array(_link("news", root, "show", key(1))))
        .when(of(src, "shows[].seasons[]"), F.array(_link("show", key(1), "season", season)))
        .when(of(src, "shows[].seasons[].episodes[]"), F.array(_link("season", season, "episode", key(3))))
    )
    out = a.select(F.lit("anime").alias("root_kind"), "root_id", F.explode(anime_links).alias("x")).unionByName(n.select(F.lit("news").alias("root_kind"), "root_id", F.explode(news_links).alias("x")))
    return out.select("root_kind", "root_id", "x.*").where("root_id IS NOT NULL AND parent_key IS NOT NULL AND child_key IS NOT NULL").distinct()
