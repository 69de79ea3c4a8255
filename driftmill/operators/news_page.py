"""News pages to rows of 66 columns: the embedded payload and the document tree read once a page, everything else in SQL.

The payload wins over structured metadata, and that over visible text; an empty text counts as missing. A page that can't
be read is a row with status parse_error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmill import schemas
from driftmill.functions.text import error_detail, first_nonempty, json_integer, sanitize
from driftmill.operators import devalue, htmldom
from driftmill.operators.htmldom import block_text
from driftmill.operators.stats import REACTIONS

# Class names, payload fields and metadata names below are those of the saved pages (fixed values).

#: Address that relative links are joined to where a page names none.
BASE = "https://news.invalid"
_TEXTS = ("page_title", "canonical", "og_url", "og_title", "og_image", "dom_title", "dom_foreword", "dom_author", "dom_author_href", "dom_author_note", "dom_image_alt", "dom_caption", "content_html", "content_text", "route", "page", "error", "errors", "article", "seo_meta", "hreflang_links", "json_ld", "content_links", "content_images", "failure")


def pick(data: object, news_id: int, path: str, warnings: list[str]) -> tuple[str, dict]:
    """Route and page data: the payload's own path, else the entry of the wanted news, else any with news, else the first."""
    entries = [(k, v) for k, v in data.items() if isinstance(v, dict)] if isinstance(data, dict) else []
    number = lambda v: str((v.get("news") or {}).get("id")) if isinstance(v.get("news"), dict) else None
    for found, warning in ((next((e for e in entries if e[0] == path), None), ""), (next((e for e in entries if number(e[1]) == str(news_id)), None), ""), (next((e for e in entries if e[1].get("news")), None), "another_route"), (entries[0] if entries else None, "")):
        if found is not None:
            warnings += [warning] if warning else []
            return found
    return "", {}


def read(raw: bytes, news_id: int, base: str) -> tuple[dict[str, str | None], list[str], list[int]]:
    """Texts of one page (objects as JSON text), warnings, and the ids of its comments."""
    warnings: list[str] = []
    root = htmldom.parse(raw.decode("utf-8", "replace"))
    script = htmldom.payload(root)
    if script is None:
        raise ValueError("no embedded payload")
    flat, refs = devalue.read(script)
    at = lambda name: devalue.values(flat, [refs.get(name)])[0]
    route, page = pick(at("data"), news_id, str(at("path") or ""), warnings)
    records, bad = htmldom.json_ld(root)
    warnings += bad
    meta: dict[str, str] = {}
    for _, k, v in htmldom.metas(root):
        meta.setdefault(k.lower(), v)
    canonical, alternates = htmldom.head_links(root)
    news = page.get("news") if isinstance(page.get("news"), dict) else {}
    content = news.get("content") or htmldom.markup(root.first(".NewsDetails__content"))
    tree = htmldom.parse(str(content))
    url = meta.get("og:url") or canonical or f"{base}/news/{news_id}/"
    if news and not content:
        warnings.append("empty_content")
    if (told := news.get("id")) is not None and str(told) != str(news_id):
        warnings.append("other_news_id")
    dump = lambda x: json.dumps(devalue._plain(x), ensure_ascii=False, sort_keys=True)
    author, note, image = root.first(".NewsDetails__author-link"), root.first(".NewsDetails__author-description"), root.first("article img, .NewsPoster img")
    ids, todo = set(), [page.get("comments")]
    seen: set[int] = set()
    while todo:
        x = todo.pop()
        if not isinstance(x, (list, dict)) or id(x) in seen:
            continue
        seen.add(id(x))
        if isinstance(x, dict):
            c = x.get("comment")
            if isinstance(c, dict) and not isinstance(c.get("id"), bool) and re.fullmatch(r"\d+", str(c.get("id", ""))):
                ids.add(int(c["id"]))
            todo += [v for k, v in x.items() if k != "comment"]
        else:
            todo += x
    texts = {
        "page_title": block_text(root.first("title")), "canonical": canonical, "og_url": meta.get("og:url"), "og_title": meta.get("og:title"), "og_image": meta.get("og:image"), "dom_title": block_text(root.first(".NewsDetails__title")), "dom_foreword": block_text(root.first(".NewsDetails__foreword")),
        "dom_author": block_text(author), "dom_author_href": author.get("href") if author is not None else "", "dom_author_note": block_text(note), "dom_image_alt": image.get("alt") if image is not None else "", "dom_caption": block_text(root.first(".NewsPoster__caption")),
        "content_html": str(content), "content_text": block_text(tree), "route": route, "page": dump(page), "error": dump(at("error")), "errors": dump(at("_errors") or {}), "article": htmldom.of_type(records, "Article") or "{}",
        "seo_meta": dump([{"key_type": a, "key": b, "content": c} for a, b, c in htmldom.metas(root)]), "hreflang_links": dump([{"lang": a, "href": b} for a, b in alternates]), "json_ld": "[" + ",".join(records) + "]", "content_links": dump(htmldom.links(tree, url)), "content_images": dump(htmldom.images(tree, url)), "failure": None,
    }
    return texts, warnings, sorted(ids)


def raw_columns(files: DataFrame, base: str = BASE) -> DataFrame:
    """Files (source_id, source_file, length, sha256, content) with what was read of each: its texts, warnings, comment_ids."""
    keep = ("source_id", "source_file", "length", "sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), strict=True):
                try:
                    out.append(read(bytes(raw or b""), n, base))
                except Exception as e:  # the page is a row of its own
                    out.append(({"failure": f"{type(e).__name__}: {e}"}, ["unreadable_page"], []))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *(pa.array([t.get(k) for t, _, _ in out], pa.string()) for k in _TEXTS), pa.array([w for _, w, _ in out], pa.list_(pa.string())), pa.array([i for _, _, i in out], pa.list_(pa.int64()))], names=[*keep, *_TEXTS, "warnings", "comment_ids"])

    told = files.select(F.col("source_id").cast("bigint"), F.col("source_file").cast("string"), F.col("length").cast("bigint"), F.col("sha256").cast("string"), F.col("content").cast("binary"))
    return told.mapInArrow(run, "source_id bigint, source_file string, length bigint, sha256 string, " + ", ".join(f"{k} string" for k in _TEXTS) + ", warnings array<string>, comment_ids array<bigint>")


def project(raw: DataFrame, base: str = BASE) -> DataFrame:
    """Rows of the news table from what was read."""
    p = lambda path: F.get_json_object("page", f"$.{path}")
    a = lambda path: F.get_json_object("article", f"$.{path}")
    whole = lambda path: json_integer("page", f"$.{path}")
    detail = error_detail("error")
    broken = F.col("failure").isNotNull()
    has_news = F.coalesce(p("news"), F.lit("{}")).isin("{}", "null") == F.lit(False)
    status = F.when(broken, "parse_error").when(detail["status"] == 404, "not_found").when(~F.coalesce(F.col("error"), F.lit("null")).isin("null", "{}", '""', "false", "0"), "nuxt_error").when(has_news, "ok").otherwise("missing_news")
    canonical = first_nonempty("canonical", "og_url", a("mainEntityOfPage.@id"), a("mainEntityOfPage"))
    url = first_nonempty("og_url", canonical, F.concat(F.lit(f"{base}/news/"), F.col("source_id").cast("string"), F.lit("/")))
    absolute = lambda c: F.when(c.rlike("^//"), F.concat(F.lit("https:"), c)).when(c.rlike("^/"), F.concat(F.lit(base), c)).otherwise(c)
    listed = lambda path: F.coalesce(F.when(p(path).startswith("["), p(path)), F.lit("[]"))
    object_ = lambda path: F.coalesce(F.when(p(path).startswith("{"), p(path)), F.lit("{}"))
    loaded, declared = F.size("comment_ids").cast("bigint"), whole("commentsMeta.count")
    emotions = F.from_json(listed("emotions"), "array<struct<emotionId: string, count: string>>")

    def reaction(i: int) -> Column:
        last = F.try_element_at(F.filter(emotions, lambda x: (x["emotionId"].try_cast("bigint") == i) & x["count"].try_cast("bigint").isNotNull()), F.lit(-1))
        return F.coalesce(last["count"].try_cast("bigint"), F.lit(0))

    image = absolute(first_nonempty(p("news.image"), a("image.url"), F.when(~a("image").rlike(r"^[{\[]"), a("image")), "og_image"))
    author_count = F.coalesce(whole("authorNewsCounter"), F.replace(F.regexp_extract("dom_author_note", r"([\d\s]+)\s+стат", 1), F.lit(" "), F.lit("")).try_cast("bigint"))
    made: dict[str, Column] = {
        "source_id": F.col("source_id"), "news_id": whole("news.id"), "status": status, "error_status_code": detail["status"], "error_message": first_nonempty("failure", detail["message"]),
        "slug": first_nonempty(p("news.alias"), F.regexp_extract(canonical, r"/news/\d+-([^/?#]+)", 1)), "url": url, "canonical_url": canonical, "page_title": F.col("page_title"),
        "title": F.when((status != "ok") & ~has_news & (F.coalesce("dom_title", F.lit("")) == ""), "").otherwise(first_nonempty(p("news.title"), "dom_title", a("headline"), a("name"), "og_title")), "foreword": first_nonempty(p("news.foreword"), "dom_foreword"),
        "content_text": F.col("content_text"), "content_html": F.col("content_html"), "published_at": first_nonempty(p("news.publishedAt"), a("datePublished")), "modified_at": a("dateModified"), "source_site": p("news.source"),
        "image_url": image, "image_width": whole("news.imageInfo.width"), "image_height": whole("news.imageInfo.height"), "image_alt": first_nonempty(p("news.alt"), "dom_image_alt"), "media_source": first_nonempty(p("news.mediaSource"), "dom_caption"), "video_html": p("news.video"),
        "author_id": whole("author.id"), "author_name": first_nonempty(p("author.user.login"), p("news.author.anchor"), a("author.name"), "dom_author"), "author_url": absolute(first_nonempty(p("news.author.href"), a("author.url"), "dom_author_href")), "author_description": first_nonempty(a("author.description"), "dom_author_note"), "author_articles_count": author_count,
        "category_title": p("news.category.title"), "category_slug": p("news.category.alias"), "comments_total": F.coalesce(whole("news.commentsTotal"), declared), "comments_new": F.coalesce(whole("news.commentsNew"), whole("commentsMeta.newCount")), "comments_loaded_count": loaded, "comments_meta_count": declared,
        "comments_complete": F.coalesce((status == "ok") & (loaded == declared), F.lit(False)), "has_spoilers": F.coalesce(p("commentsMeta.hasSpoilers") == "true", F.lit(False)),
        **{f"reaction_{name}_count": reaction(i) for i, name in REACTIONS.items()}, "reaction_total": sum((reaction(i) for i in REACTIONS), F.lit(0)).cast("bigint"),
        "images": listed("news.images"), "tags": listed("news.tags"), "similar_news": listed("similarNews"), "categories": listed("categories"), "comments": listed("comments"), "comments_meta": object_("commentsMeta"), "comments_with_images": listed("commentsWithImages"), "read_also_aside": listed("readAlsoAside"), "read_also_main": listed("readAlsoMain"),
        "emotions": listed("emotions"), "author": object_("author"), "catalog_links": listed("catalogLinks"), "nuxt_news": object_("news"), "nuxt_route": F.col("route"), "nuxt_errors": F.concat(F.lit('{"error":'), F.coalesce("error", F.lit("null")), F.lit(',"_errors":'), F.coalesce("errors", F.lit("{}")), F.lit("}")),
        "parse_warnings": F.col("warnings"), "source_bytes": F.col("length"), "source_sha256": F.col("sha256"),
        **{c: F.coalesce(c, F.lit("[]")) for c in ("content_links", "content_images", "seo_meta", "hreflang_links", "json_ld")},
    }
    default = lambda f, c: sanitize(c) if f.dataType.typeName() == "string" else c
    return raw.select(*(default(f, made.get(f.name, F.col(f.name) if f.name in raw.columns else F.lit(None))).cast(f.dataType).alias(f.name) for f in schemas.NEWS))


def news_pages(files: DataFrame, base: str = BASE) -> DataFrame:
    """Rows of the news table, one a file, in no order."""
    return project(raw_columns(files, base), base)
