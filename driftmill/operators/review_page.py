"""Review pages to review rows: page status, articles in order, one struct a review; what breaks the contract has an error.

A page is the literal ``age_restricted``, an HTML document, or a JSON object with the markup in content. The strict
policy of the review pipeline is strict(); the rows with errors can also be set aside.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmill import schemas
from driftmill.operators import htmldom
from driftmill.operators.htmldom import Node, block_text, direct_meta

# Class names, attributes and wording below are those of the saved pages (fixed values).

ARTICLE = "article.b-review-topic"
OPINIONS = ("positive", "neutral", "negative")
LIST_STATUSES = ("planned", "watching", "rewatching", "completed", "on_hold", "dropped")
TRANSIENT = "временно недоступен"
_PATH = re.compile(r"^/animes/([^/]+)/reviews/(\d+)/?$")


class Broken(ValueError):
    """An article that breaks the contract."""


def _need(value: str, what: str) -> str:
    if not value:
        raise Broken(f"no {what}")
    return value


def _whole(node: Node | None, what: str) -> int:
    m = re.search(r"-?\d+", block_text(node).replace(" ", "").replace("\n", ""))
    if m is None or int(m[0]) < 0:
        raise Broken(f"{what} is no count")
    return int(m[0])


def _one_of(node: Node | None, allowed: tuple[str, ...]) -> list[str]:
    return [c for c in (node.classes if node is not None else []) if c in allowed]


def review(a: Node, anime_id: int) -> dict:
    """Fields of one article, without its place and its rank."""
    url = _need(a.get("data-url"), "data-url")
    parts = urlsplit(url)
    m = _PATH.match(parts.path)
    slug_id = re.match(r"(?i)[a-z]?(\d+)-", m[1]) if m else None
    if m is None or slug_id is None or int(slug_id[1]) != anime_id:
        raise Broken(f"address of another anime: {url}")
    topic = _need(a.get("data-track_topic"), "topic")
    for name, want in (("topic", a.get("id") == topic), ("url", direct_meta(a, "url") in ("", url)), ("author", direct_meta(a, "author") in ("", a.get("data-user_nickname")))):
        if not want:
            raise Broken(f"two values of {name}")
    head, details = a.first(".review-info"), a.first(".review-details")
    name = details.first("a.name") if details is not None else None
    body = a.first('div.body[itemprop="text"]')
    if head is None or body is None or name is None:
        raise Broken("no head, body or author")
    opinion = _one_of(head.first(".opinion"), OPINIONS)
    listed = _one_of(head.first(".b-add_to_list"), LIST_STATUSES)
    if len(opinion) != 1 or len(listed) > 1:
        raise Broken("opinion or list status isn't one")
    score = next((int(s[1]) for x in head.all(".score") for c in x.classes if (s := re.fullmatch(r"score-(\d+)", c))), None)
    plus, minus = _whole(a.first(".votes-for"), "votes_for"), _whole(a.first(".votes-against"), "votes_against")
    avatar = link.first("img") if (link := a.first("a.author-link")) is not None else None
    inside = set(map(id, body.walk()))
    classes = [set(x.classes) for x in body.walk()]
    return {
        "anime_id": anime_id, "review_id": int(m[2]), "topic_id": int(topic), "anime_slug": m[1], "anime_title": _need(direct_meta(a, "name") or direct_meta(a, "headline"), "title"), "anime_url": f"{parts.scheme}://{parts.netloc}/animes/{m[1]}", "review_url": url,
        "author_id": int(_need(a.get("data-user_id"), "author id")), "author_nickname": _need(block_text(name), "author name"), "author_nickname_snapshot": _need(a.get("data-user_nickname"), "author"), "author_url": htmldom.absolute(url, name.get("href")),
        "author_avatar_url": htmldom.absolute(url, avatar.get("src")) if avatar is not None else "", "author_avatar_srcset": avatar.get("srcset") if avatar is not None else "", "opinion": opinion[0], "user_score": score, "user_list_status": listed[0] if listed else None,
        "votes_for": plus, "votes_against": minus, "votes_total": plus + minus, "usefulness_score": plus - minus, "usefulness_ratio": plus / (plus + minus) if plus + minus else None, "comments_count": _whole(a.first(".comments"), "comments"),
        "created_at": _need(direct_meta(a, "dateCreated"), "time"), "published_at": _need(direct_meta(a, "datePublished"), "time"), "updated_at": _need(direct_meta(a, "dateModified"), "time"),
        "is_written_before_release": any("is_written_before_release" in x.classes and id(x) not in inside for x in a.walk()), "body_text": block_text(body, "marker"), "body_html": htmldom.markup(body), "body_links": htmldom.links(body, url),
        "body_images": [i | {"data_width": x.get("data-width"), "data_height": x.get("data-height"), "classes": sorted(x.classes)} for i, x in zip(htmldom.images(body, url), body.all("img"), strict=True)],
        "inline_spoilers_count": sum("b-spoiler_inline" in c for c in classes), "block_spoilers_count": sum(bool(c & {"b-spoiler", "b-spoiler_block"}) for c in classes),
    }


def page(raw: bytes | None, anime_id: int) -> tuple[str, list[Node], int | None, bool]:
    """Status of a page, its outermost articles, the declared number of reviews, and whether another page follows."""
    text = (raw or b"").decode("utf-8", "replace")
    if text.strip() == "age_restricted":
        return "age_restricted", [], None, False
    if text.lstrip().startswith("<"):
        root = htmldom.parse(text)
        found = htmldom.outermost(root, ARTICLE)
        count = root.first(".navigation-node-all .count")
        declared = int(m[0]) if count is not None and (m := re.search(r"\d+", block_text(count).replace(" ", ""))) else None
        body = root.first("body")
        own = any(re.match(rf"(?i)/animes/[a-z]?{anime_id}(?:-|$)", urlsplit(x.get("content")).path) for x in root.all("meta[itemprop=url]"))
        terminal = body is not None and {"p-animes", "p-animes-show"} <= set(body.classes) and own
        return ("html_with_reviews" if found else "html_terminal" if terminal else "html_unknown"), found, declared, False
    try:
        told = json.loads(text)
    except ValueError:
        return "malformed_json", [], None, False
    if not isinstance(told, dict):
        return "json_non_object", [], None, False
    if not isinstance(told.get("content"), str):
        return (f"api_error_{told['status']}" if told.get("status") is not None else "api_error"), [], None, False
    root, more = htmldom.parse(told["content"]), "postloader" in told
    if found := htmldom.outermost(root, ARTICLE):
        return "reviews_json", found, None, more
    return ("transient_unavailable" if TRANSIENT in block_text(root) else "json_no_reviews"), [], None, more


_FIELDS = [f for f in schemas.REVIEWS if f.name not in ("usefulness_rank", "source_file", "source_page", "source_position")]
_ROW = "struct<" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in _FIELDS) + ", source_position: bigint, error: string>"


def review_pages(files: DataFrame, anime_id: str = "anime_id", number: str = "source_page", source: str = "source_file", content: str = "content") -> DataFrame:
    """A row a page: anime_id, source_page, source_file, page_status, declared, has_next, reviews (array of structs, each with error)."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_type(_parse_datatype_string(f"array<{_ROW}>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for anime, raw in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                status, found, declared, more = page(raw, anime)
                rows = []
                for i, a in enumerate(found, 1):
                    try:
                        rows.append(review(a, anime) | {"source_position": i, "error": None})
                    except ValueError as e:
                        rows.append({"source_position": i, "error": str(e)})
                out.append((status, declared, more, rows))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.bool_()), pa.array([r[3] for r in out], kind)], names=["anime_id", "source_page", "source_file", "page_status", "declared", "has_next", "reviews"])

    told = files.select(F.col(anime_id).cast("bigint"), F.col(number).cast("bigint"), F.col(source).cast("string"), F.col(content).cast("binary"))
    return told.mapInArrow(run, f"anime_id bigint, source_page bigint, source_file string, page_status string, declared bigint, has_next boolean, reviews array<{_ROW}>")


def reviews(pages: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of the review table: the last of repeated reviews, ranked within their anime; a broken article is an error, or left out if not strict."""
    from driftmill.operators import rank

    rows = pages.select("source_file", "source_page", F.explode("reviews").alias("r")).select("source_file", "source_page", "r.*")
    if strict:
        where = F.concat_ws(" ", F.col("source_file"), F.lit("article"), F.col("source_position").cast("string"), F.col("error"))
        rows = rows.where(F.when(F.col("error").isNotNull(), F.raise_error(where)).otherwise(F.lit(True)).cast("boolean"))
    rows = rows.where("error IS NULL").drop("error")
    last = rank.last_wins(rows, ["review_id"], ["source_page", "source_position"])
    ranked = rank.ranked(last, ["anime_id"], [F.desc("usefulness_score"), F.desc("votes_for"), F.desc("review_id")], "usefulness_rank")
    return ranked.select(*(F.col(f.name) for f in schemas.REVIEWS))


def next_page_expected(pages: DataFrame) -> DataFrame:
    """Animes whose last page still points to another: anime_id, last_page, declared (the last that is known)."""
    return pages.groupBy("anime_id").agg(F.max("source_page").alias("last_page"), F.max_by("has_next", "source_page").alias("more"), F.max_by("declared", F.when(F.col("declared").isNotNull(), F.col("source_page"))).alias("declared")).where("more").drop("more")
