"""Landed pages of a paged API: the text that asked for them, its digest as cache key, and what makes a cached page valid.

Fetching is left out on purpose; pages are files that something else put down.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Wording of the service for a field that must not be null but was (fixed value).
NULL_CONTRACT = r"Cannot return null for non-nullable field ([A-Za-z_]\w*)\.([A-Za-z_]\w*)"


def query_text(field: str, selection: str, *, page: int | None = None, size: int | None = None, ids: list[str] | None = None, extra: dict[str, str] | None = None) -> str:
    """Query of one page, or of records by id, with a selection of fields."""
    arguments = {"page": page, "limit": size, "ids": None if ids is None else json.dumps(",".join(ids)), **(extra or {})}
    told = ", ".join(f"{k}: {v}" for k, v in arguments.items() if v is not None)
    return f"{{ {field}({told}) {{ {' '.join(selection.split())} }} }}"


def selection_without(selection: str, fields: set[str]) -> str:
    """A selection without some of its own fields, with whatever stands in their braces; fields further in stay."""
    tokens, out, i = re.findall(r"[{}]|[^\s{}]+", selection), [], 0
    depth = 0
    while i < len(tokens):
        t = tokens[i]
        if depth == 0 and t in fields:
            i += 1
            if i < len(tokens) and tokens[i] == "{":
                inside = 0
                while True:
                    inside += (tokens[i] == "{") - (tokens[i] == "}")
                    i += 1
                    if not inside:
                        break
            continue
        depth += (t == "{") - (t == "}")
        out.append(t)
        i += 1
    return " ".join(out)


def query_digest(*queries: str, context: str = "") -> str:
    """Key of a cached page: its queries in order, and anything else that shaped it."""
    return hashlib.sha256("\0".join((context, *queries)).encode()).hexdigest()


def broken_contracts(message: str | Column) -> Column:
    """Fields (type, field) that error messages name as null against their contract; null unless every message does."""
    m = F.col(message) if isinstance(message, str) else message
    return F.when(
        (F.size(m) > 0) & F.forall(m, lambda x: x.rlike(NULL_CONTRACT)),
        F.array_distinct(F.transform(m, lambda x: F.struct(F.regexp_extract(x, NULL_CONTRACT, 1).alias("type"), F.regexp_extract(x, NULL_CONTRACT, 2).alias("field")))),
    )


def valid_pages(pages: DataFrame, digests: dict[int, str]) -> tuple[DataFrame, DataFrame]:
    """Cached pages (page, digest, ids) that may be used, and those that must be fetched again: page, reason.

    A page is valid if its digest is that of the query and its records have ids, each once.
    """
    wanted = F.create_map(*(x for k, v in digests.items() for x in (F.lit(k), F.lit(v)))) if digests else F.create_map().cast("map<int,string>")
    reason = (
        F.when(~F.col("digest").eqNullSafe(F.try_element_at(wanted, F.col("page").cast("int"))), "other_query")
        .when(F.col("ids").isNull() | F.exists("ids", lambda x: x.isNull() | (x == "")), "record_without_id")
        .when(F.size(F.array_distinct("ids")) < F.size("ids"), "repeated_id")
    )
    told = pages.withColumn("reason", reason)
    return told.where("reason IS NULL").drop("reason"), told.where("reason IS NOT NULL").select("page", "reason")


def repeated_across_pages(records: DataFrame, key: str = "id", page: str = "page") -> DataFrame:
    """Ids that stand on more than one page, with those pages."""
    return records.groupBy(key).agg(F.array_sort(F.collect_set(page)).alias("pages")).where(F.size("pages") > 1)
