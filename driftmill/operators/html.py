"""Arrow functions over the document tree: one parse a page, all features of it in one struct."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmill.operators import htmldom


@F.pandas_udf(T.StringType())
def html_text(x: pd.Series) -> pd.Series:
    """Text of a fragment with a line for every block; null stays null."""
    return x.map(lambda t: None if t is None else htmldom.block_text(htmldom.parse(t)))


@F.pandas_udf(T.StringType())
def html_text_flat(x: pd.Series) -> pd.Series:
    """Text of a fragment with single spaces; null stays null."""
    return x.map(lambda t: None if t is None else htmldom.flat_text(htmldom.parse(t)))


_LINK = pa.struct([(k, pa.string()) for k in ("href", "url", "text", "title", "rel")])
_IMAGE = pa.struct([(k, pa.string()) for k in ("src", "url", "srcset", "alt", "title", "width", "height")])
_META = pa.struct([(k, pa.string()) for k in ("key_type", "key", "content")])
_LINE = pa.struct([(k, pa.string()) for k in ("key", "value")])
FEATURES = pa.schema(
    [("title", pa.string()), ("h1", pa.string()), ("body_classes", pa.list_(pa.string())), ("canonical", pa.string()), ("alternates", pa.list_(pa.struct([("lang", pa.string()), ("href", pa.string())]))), ("metas", pa.list_(_META)),
     ("links", pa.list_(_LINK)), ("images", pa.list_(_IMAGE)), ("json_ld", pa.list_(pa.string())), ("info", pa.list_(_LINE)), ("payload", pa.string()), ("text", pa.string()), ("warnings", pa.list_(pa.string())), ("parse_error", pa.string())]
)
_DDL = (
    "title string, h1 string, body_classes array<string>, canonical string, alternates array<struct<lang: string, href: string>>, metas array<struct<key_type: string, key: string, content: string>>, links array<struct<href: string, url: string, text: string, title: string, rel: string>>, "
    "images array<struct<src: string, url: string, srcset: string, alt: string, title: string, width: string, height: string>>, json_ld array<string>, info array<struct<key: string, value: string>>, payload string, text string, warnings array<string>, parse_error string"
)


def features(text: str | bytes | None, base: str) -> dict:
    """All features of one page; an error becomes parse_error, never a lost row. Bytes are read by the page's own charset."""
    try:
        root = htmldom.parse(htmldom.decode(text) if isinstance(text, bytes) else text or "")
        canonical, alternates = htmldom.head_links(root)
        records, warnings = htmldom.json_ld(root)
        body = root.first("body")
        return {
            "title": htmldom.flat_text(root.first("title")), "h1": " ".join(htmldom.flat_text(x) for x in root.all("h1")), "body_classes": body.classes if body is not None else [], "canonical": canonical,
            "alternates": [{"lang": a, "href": b} for a, b in alternates], "metas": [dict(zip(("key_type", "key", "content"), m, strict=True)) for m in htmldom.metas(root)], "links": htmldom.links(root, base), "images": htmldom.images(root, base),
            "json_ld": records, "info": htmldom.info_lines(root), "payload": htmldom.payload(root), "text": htmldom.flat_text(body if body is not None else root), "warnings": warnings, "parse_error": "",
        }
    except Exception as e:  # a page that breaks the parser is a row of its own
        return {k: None for k in FEATURES.names} | {"parse_error": f"{type(e).__name__}: {e}"}


def html_features(df: DataFrame, keys: list[str], text: str, base: str | None = None) -> DataFrame:
    """The keys and the features of every page, parsed once. text: its text, or its bytes. base: the column with the page's address, for relative links."""
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = [features(t, b or "") for t, b in zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(n)), *(pa.array([r[f.name] for r in rows], f.type) for f in FEATURES)], names=[*keys, *FEATURES.names])

    told = F.col(text) if isinstance(df.schema[text].dataType, T.BinaryType) else F.col(text).cast("string")
    return df.select(*keys, told.alias("__text"), (F.col(base) if base else F.lit("")).alias("__base")).mapInArrow(run, f"{fields}, {_DDL}")


def page_status(features_row: DataFrame) -> DataFrame:
    """Features with page_status, the first that fits: age_restricted, ok, redirect, not_found, retry_later, incomplete, unknown."""
    has = lambda c: F.array_contains("body_classes", c)
    headline = F.exists("metas", lambda m: (m["key_type"] == "itemprop") & (m["key"] == "headline"))
    status = (
        F.when(has("p-age_restricted") | F.contains("text", F.lit("ограничен 18+")), "age_restricted")
        .when(headline & has("p-animes-show"), "ok")
        .when(F.contains("h1", F.lit("Страница переехала")) | (F.col("h1") == "302"), "redirect")
        .when(F.contains("h1", F.lit("Страница не найдена")) | (F.col("title") == "404") | (F.col("h1") == "404"), "not_found")
        .when(F.col("text") == "Retry later", "retry_later")
        .when(has("p-animes-show"), "incomplete")
        .otherwise("unknown")
    )
    return features_row.withColumn("page_status", F.coalesce(status, F.lit("unknown")))
