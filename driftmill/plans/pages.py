"""Queries of the page tables over pages that are written from the tables' own columns, so SQL knows what must come out.

Each query renders every row of a table as a page of its kind (markup or payload, with its values escaped), reads the
page back with the extraction operators, and gives columns that the table itself holds.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmill.session import spread, table


def _e(c: str | Column) -> Column:
    """A value inside markup; null is empty."""
    out = F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def _html(template: str, **more: Column) -> Column:
    """A template with {column} for escaped columns and {*name} for columns of markup."""
    parts, rest = [], template
    while rest:
        text, _, rest = rest.partition("{")
        parts.append(F.lit(text))
        if rest:
            name, _, rest = rest.partition("}")
            parts.append(more[name[1:]] if name.startswith("*") else _e(name))
    return F.concat(*parts)


_ENTITY = """<html><head><title>{html_title}</title><link rel="canonical" href="{canonical_url}?locale=ru"><meta property="video:duration" content="{duration_seconds}"></head>
<body class="p-animes p-animes-show" data-locale="{locale}" data-server_time="{server_time}"><div class="l-content"><div class="block"><meta itemprop="headline" content="{title}"><meta itemprop="alternativeHeadline" content="{title_russian}"><meta itemprop="dateCreated" content="{aired_on}"><h1>{title_heading}</h1></div></div>
<div class="b-user_rate" data-entry='{*entry}'></div><div class="b-entry-info"><div class="line"><div class="key">Тип:</div><div class="value">{anime_type}</div></div><div class="line"><div class="key">Рейтинг:</div><div class="value">{age_rating}</div></div><div class="line"><div class="key">Жанры:</div><div class="value">{*genres}</div></div></div>
<div class="c-info-right"><a href="/animes/studio/5-S" title="Аниме студии {studios}">x</a></div><div itemprop="aggregateRating"><meta itemprop="ratingValue" content="{score}"><meta itemprop="ratingCount" content="{rating_count}"></div>
<div class="b-db_entry-poster"><meta itemprop="image" content="{poster_url}"></div><div><div class="subheadline">Комментарии <span class="count">{comments_count}</span></div></div></body></html>"""

_WHOLE = "canonical_id", "canonical_url", "title", "title_russian", "anime_type", "aired_on", "age_rating", "genres_ru", "studios", "poster_url"


def entity_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Entity pages written from anime_pages, and read back."""
    from driftmill.operators.entity_page import entity_pages

    a = spread(table(spark, sf, "anime_pages"))
    genre = F.transform(F.filter(F.split("genres_ru", r" \| "), lambda g: g != ""), lambda g: F.concat(F.lit('<a href="/genre/1-x"><span class="genre-ru">'), _e(g), F.lit("</span></a>")))
    entry = F.concat(F.lit('{"id":'), F.coalesce(F.col("entry_id").cast("string"), F.lit("null")), F.lit(',"episodes":'), F.coalesce(F.col("episodes").cast("string"), F.lit("null")), F.lit("}"))
    page = F.encode(_html(_ENTITY, entry=entry, genres=F.array_join(genre, "")), "UTF-8")
    files = a.select("source_file", page.alias("content")).withColumn("length", F.octet_length("content").cast("bigint"))
    return entity_pages(files).select("source_file", "page_status", *_WHOLE, F.col("entry_id").cast("bigint").alias("entry_id"), "episodes", "duration_seconds", "score", "rating_count", "comments_count", "locale", "server_time")


_ARTICLE = """<article class="b-review-topic" id="{topic_id}" data-track_topic="{topic_id}" data-url="{review_url}" data-user_id="{author_id}" data-user_nickname="{author_nickname_snapshot}"><meta itemprop="name" content="{anime_title}">
<meta itemprop="dateCreated" content="{created_at}"><meta itemprop="datePublished" content="{published_at}"><meta itemprop="dateModified" content="{updated_at}"><div class="review-details"><a class="name" href="{author_url}">{author_nickname}</a></div>
<div class="review-info"><div class="opinion {opinion}"></div>{*score}<div class="b-add_to_list {user_list_status}"></div></div><div class="votes-for">{votes_for}</div><div class="votes-against">{votes_against}</div><div class="comments">{comments_count}</div>
<div class="body" itemprop="text"><p>{review_id}</p></div></article>"""


def review_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Review fragments written from reviews, one a row, read back, and reduced to the last of each review with its rank."""
    from driftmill.operators import review_page

    r = spread(table(spark, sf, "reviews"))
    score = F.when(F.col("user_score").isNotNull(), F.concat(F.lit('<div class="score score-'), F.col("user_score").cast("string"), F.lit('"></div>'))).otherwise("")
    fragment = F.to_json(F.struct(_html(_ARTICLE, score=score).alias("content")))
    files = r.select("anime_id", (F.col("source_page") * 100_000 + F.col("source_position")).alias("source_page"), "source_file", F.encode(fragment, "UTF-8").alias("content"))
    rows = review_page.reviews(review_page.review_pages(files))
    return rows.select(
        "anime_id", "usefulness_rank", "review_id", "topic_id", "anime_slug", "anime_title", "author_id", "author_nickname", "opinion", "user_score", "user_list_status", "votes_for", "votes_against", "votes_total", "usefulness_score", "comments_count", "created_at", "published_at", "updated_at", "body_text",
    )


def _payload(row: dict) -> str:
    """An embedded payload that refers to every value by its place."""
    read = lambda t: json.loads(t) if t else None
    try:
        comments = read(row["comments"])
    except ValueError:
        comments = None
    news = {k: row[c] for k, c in (("id", "news_id"), ("title", "title"), ("alias", "slug"), ("foreword", "foreword"), ("publishedAt", "published_at"), ("source", "source_site"))} | {"category": {"title": row["category_title"], "alias": row["category_slug"]}, "commentsTotal": row["comments_total"]}
    try:
        emotions = read(row["emotions"])
    except ValueError:
        emotions = None
    gone = row["error_status_code"]
    state = {"data": {"/": {}, f"/news/{row['source_id']}/": {"news": news if row["news_id"] is not None else None, "comments": comments, "emotions": emotions}}, "path": f"/news/{row['source_id']}/", "error": None if gone is None else {"statusCode": gone, "message": row["error_message"]}}
    out: list = [["ShallowReactive", 1], None]
    todo = [(1, state)]
    while todo:
        at, x = todo.pop()
        if isinstance(x, (dict, list)):
            first = len(out)
            inner = list(x.values()) if isinstance(x, dict) else x
            out.extend([None] * len(inner))
            places = list(range(first, first + len(inner)))
            out[at] = dict(zip(x, places, strict=True)) if isinstance(x, dict) else places
            todo += list(zip(places, inner, strict=True))
        else:
            out[at] = x
    return json.dumps(out, ensure_ascii=False).replace("</", "<\\/")


_NEWS = ["source_id", "news_id", "title", "slug", "foreword", "published_at", "source_site", "category_title", "category_slug", "comments", "comments_total", "emotions", "error_status_code", "error_message"]


def news_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    """News pages with an embedded payload written from news, and read back."""
    from driftmill.operators import news_page

    @F.pandas_udf("string")
    def payload(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([_payload({k: None if not isinstance(v, str) and pd.isna(v) else v if isinstance(v, str) else int(v) for k, v in r.items()}) for r in rows.to_dict("records")])

    n = spread(table(spark, sf, "news"))
    page = F.concat(F.lit('<html><head><title>x</title></head><body><script id="__NUXT_DATA__" type="application/json">'), payload(F.struct(*_NEWS)), F.lit("</script></body></html>"))
    files = n.select("source_id", "source_file", F.encode(page, "UTF-8").alias("content")).select("source_id", "source_file", F.octet_length("content").cast("bigint").alias("length"), F.sha2("content", 256).alias("sha256"), "content")
    made = news_page.news_pages(files)
    return made.select("source_id", "source_file", "status", "news_id", "title", "slug", "category_title", "category_slug", "published_at", "comments_total", "comments_loaded_count", "error_status_code", *(f"reaction_{x}_count" for x in ("like", "fire", "dislike")))


QUERIES = {f.__name__: f for f in (entity_page_rows, review_page_rows, news_page_rows)}

_REACTION = lambda i, n: f"CAST(coalesce(list_extract(list_filter(list, lambda x: x.\"emotionId\" = {i} AND x.count IS NOT NULL), -1).count, 0) AS BIGINT) AS reaction_{n}_count"

SQL = {
    # a page that says it is restricted gives nothing but its status and what stands on every page
    "entity_page_rows": f"""
WITH a AS (SELECT *, contains(concat_ws(' ', html_title, title_heading, title, title_russian), 'ограничен 18+') AS shut FROM anime_pages)
SELECT source_file, CASE WHEN shut THEN 'age_restricted' ELSE 'ok' END AS page_status, CASE WHEN NOT shut THEN coalesce(nullif(regexp_extract(canonical_url, '/animes/[A-Za-z]?(\\d+)(?:-|/?$)', 1), ''), CAST(entry_id AS VARCHAR)) END AS canonical_id,
{", ".join(f"CASE WHEN NOT shut THEN nullif(trim({c}), '') END AS {c}" for c in _WHOLE if c != "canonical_id")}, {", ".join(f"CASE WHEN NOT shut THEN {c} END AS {c}" for c in ("entry_id", "duration_seconds", "score", "rating_count", "comments_count"))},
CASE WHEN NOT shut AND episodes <> 0 THEN episodes END AS episodes, nullif(trim(locale), '') AS locale, nullif(trim(server_time), '') AS server_time FROM a""",
    "review_page_rows": """
WITH last AS (SELECT *, coalesce(votes_for - votes_against, 0) AS s FROM reviews QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY source_page DESC, source_position DESC) = 1)
SELECT anime_id, row_number() OVER (PARTITION BY anime_id ORDER BY s DESC, votes_for DESC, review_id DESC) AS usefulness_rank, review_id, topic_id, regexp_extract(anime_url, '/animes/([^/]+)$', 1) AS anime_slug, anime_title, author_id, author_nickname, opinion, user_score, user_list_status, votes_for, votes_against,
votes_for + votes_against AS votes_total, s AS usefulness_score, comments_count, created_at, published_at, updated_at, CAST(review_id AS VARCHAR) AS body_text FROM last""",
    "news_page_rows": f"""
WITH RECURSIVE r AS (SELECT row_number() OVER () AS k, *, CAST(try_cast(emotions AS JSON) AS STRUCT("emotionId" BIGINT, title VARCHAR, count BIGINT)[]) AS list FROM news),
t AS (SELECT k, unnest(CAST(try_cast(comments AS JSON) AS JSON[])) AS node FROM r UNION ALL SELECT k, unnest(CAST(json_extract(node, '$.comments') AS JSON[])) FROM t),
n AS (SELECT k, count(DISTINCT try_cast(json_extract_string(node, '$.comment.id') AS BIGINT)) AS loaded FROM t GROUP BY 1)
SELECT source_id, source_file, CASE WHEN error_status_code = 404 THEN 'not_found' WHEN error_status_code IS NOT NULL THEN 'nuxt_error' WHEN news_id IS NOT NULL THEN 'ok' ELSE 'missing_news' END AS status, news_id,
CASE WHEN news_id IS NULL THEN '' ELSE title END AS title, CASE WHEN news_id IS NULL THEN '' ELSE slug END AS slug, CASE WHEN news_id IS NULL THEN '' ELSE category_title END AS category_title, CASE WHEN news_id IS NULL THEN '' ELSE category_slug END AS category_slug, CASE WHEN news_id IS NULL THEN '' ELSE published_at END AS published_at,
CASE WHEN news_id IS NOT NULL THEN comments_total END AS comments_total, coalesce(loaded, 0) AS comments_loaded_count, error_status_code, {", ".join(_REACTION(i, n) for i, n in ((2, "like"), (3, "fire"), (4, "dislike")))} FROM r LEFT JOIN n USING (k)""",
}
