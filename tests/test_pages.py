import json

import pytest

from driftmill import schemas
from driftmill.operators import entity_page, review_page

def tag(name, inner="", **attrs):
    """An element; _ in an attribute's name is -, and cls its class."""
    told = "".join(f" {'class' if k == 'cls' else k.replace('_', '-')}='{v}'" for k, v in attrs.items())
    return f"<{name}{told}>" if name in ("meta", "link", "img") else f"<{name}{told}>{inner}</{name}>"


def labelled(key, value):
    """A line of the info box."""
    return tag("div", tag("div", key + ":", cls="key") + tag("div", value, cls="value"), cls="line")


def heading(text, *inner):
    """A section under its heading."""
    return tag("div", tag("div", text, cls="subheadline") + "".join(inner))


def entity(head, body, info):
    """A page that counts as a whole one: its head, its parts, and the lines of its info box."""
    return f"<html><head>{''.join(head)}</head><body class='p-animes p-animes-show' data-locale='ru' data-server_time='now'>{''.join(body)}{tag('div', ''.join(info), cls='b-entry-info')}</body></html>"


def named(name, russian, created):
    metas = (("dateCreated", created), ("alternativeHeadline", russian), ("headline", name))
    return tag("div", tag("div", tag("h1", f"{russian} / {name} 18+") + "".join(tag("meta", itemprop=k, content=v) for k, v in metas), cls="block"), cls="l-content")


def remark(n, inner="", text=None):
    return tag("div", ("" if text is None else tag("div", tag("div", text, cls="body", itemprop="text"), cls="inner")) + inner, cls="b-comment", itemprop="comment", id=n)


def elsewhere(url, kind=""):
    return tag("div", tag("a", "x", href=url), cls=f"b-external_link {kind}")


ENTITY = entity(
    head=[tag("meta", property=f"video:{k}", content=v) for k, v in (("tag", "a"), ("tag", "b"), ("duration", "1440"))] + [tag("meta", property="og:type", content="video"), tag("link", rel="canonical", href="https://h/animes/z100-slug?locale=ru"), tag("title", "T")],
    body=[
        elsewhere("https://myanimelist.net/anime/77"), elsewhere("https://ru.wikipedia.org/x", "b-menu-line wikipedia"),
        heading("Комментарии"), remark(1, remark(2), text="a"), heading("Новости 7", *[tag("a", "N", cls="b-menu-line entry", href="/n/1")] * 2),
        tag("div", itemprop="aggregateRating", inner="".join(tag("meta", itemprop=f"rating{k}", content=v) for k, v in (("Count", "1 234"), ("Value", "8.5")))),
        tag("div", id="rates_scores_stats", data_stats='[["10",5],["9",2],["9",3]]'),
        tag("div", tag("div", "Текст " + tag("a", "ссылка", href="/x"), itemprop="description"), cls="description-current"),
        tag("div", tag("a", tag("img", src="/s.png"), href="https://h/animes/studio/5-S", title="Аниме студии S") + tag("a", "again", href="https://h/animes/studio/5-S"), cls="c-info-right"),
        tag("div", data_entry='{"id": 100, "episodes": 0}', cls="b-user_rate"), named("Name", "Имя", "2020-01-02"),
        tag("div", tag("span", "225 х 350", cls="marker-text"), cls="b-db_entry-poster").replace(">", " data-poster_id='9'>", 1),
    ],
    info=[
        labelled("Статус", tag("span", cls="b-anime_status_tag released", data_text="вышло") + tag("span", "в 2020", title="2020")),
        labelled("Жанры", tag("a", tag("span", "Drama", cls="genre-en") + tag("span", "Драма", cls="genre-ru"), href="/genre/1-Drama") + tag("a", "Икс", href="/genre/2-X")),
        labelled("Эпизоды", "3 / 12"), labelled("Тип", "TV Сериал"),
    ],
)


def test_entity_page(spark):
    files = spark.createDataFrame(
        [("d/a100.html", 10, bytearray(ENTITY.encode())), ("d/7.html", 0, bytearray(b"")), ("x.html", 5, bytearray('<h1>Страница переехала</h1><a href="/animes/55-y">'.encode())), ("8.html", 5, bytearray("Доступ ограничен 18+".encode())), ("9.html", 3, bytearray(b"\xff<p")), ("n.html", 0, None)],
        "source_file string, length bigint, content binary",
    )
    rows = {r["source_file"]: r for r in entity_page.entity_pages(files).collect()}
    assert {k: r["page_status"] for k, r in rows.items()} == {"d/a100.html": "ok", "d/7.html": "unknown", "x.html": "redirect", "8.html": "age_restricted", "9.html": "unknown", "n.html": "unknown"}
    assert rows["x.html"]["redirect_id"] == "55" and rows["8.html"]["is_adult"] is True and rows["d/7.html"]["source_requested_id"] == "7"
    r = rows["d/a100.html"]
    want = {
        "source_variant": "prefixed", "source_prefix": "a", "canonical_id": "100", "canonical_url": "https://h/animes/z100-slug", "title": "Name", "title_russian": "Имя", "aired_on": "2020-01-02", "aired_on_kind": "dateCreated", "is_adult": True, "duration_seconds": 1440, "video_tags": "a | b",
        "anime_type": "TV Сериал", "episodes_aired": 3, "episodes_total": 12, "genres_en": "Drama | Икс", "genres_ru": "Драма", "genre_ids": "1 | 2", "status_code": "released", "status_dates": "2020", "studios": "S", "studio_ids": "5", "has_description": True, "description": "Текст ссылка",
        "score": 8.5, "rating_count": 1234, "score_10_count": 5, "score_9_count": 3, "score_8_count": 0, "score_votes_total": 8, "score_distribution_mean": 9.625, "list_planned_count": None, "news_count": 7, "news_preview_count": 1, "comments_count": 2, "comments_preview_count": 2, "clubs_count": 0,
        "myanimelist_id": "77", "wikipedia_url": "https://ru.wikipedia.org/x", "twitter_url": None, "poster_resolution_width": 225, "warnings": None,
    }
    assert {k: r[k] for k in want} == want
    assert [c["parent_id"] for c in json.loads(r["comments_json"])] == ["", "1"] and json.loads(r["description_links_json"]) == [{"text": "ссылка", "url": "/x"}] and r["related_json"] is None
    assert entity_page.entity_pages(files.limit(0)).count() == 0


def article(n, plus, minus, *, body="<p>Текст<span class='marker'>spoiler</span></p>", opinion="positive", extra=""):
    return f"""<article class="b-review-topic" id="{n}0" data-track_topic="{n}0" data-url="https://h/animes/z5-slug/reviews/{n}" data-user_id="3" data-user_nickname="nick"><meta itemprop="name" content="Имя">
<meta itemprop="dateCreated" content="c"><meta itemprop="datePublished" content="p"><meta itemprop="dateModified" content="m"><div class="review-details"><a class="name" href="/nick">nick</a></div>
<div class="review-info"><div class="opinion {opinion}"></div><div class="score score-8"></div><div class="b-add_to_list completed"></div></div><div class="votes-for">{plus}</div><div class="votes-against">{minus}</div><div class="comments">1 234</div>
<div class="body" itemprop="text">{body}<article class="b-review-topic">inner</article><img src="/i.png" class="z a"></div>{extra}</article>"""


def pages(spark, *contents):
    return review_page.review_pages(spark.createDataFrame([(5, i, f"z5-slug/{i}.json", bytearray(c.encode())) for i, c in enumerate(contents, 1)], "anime_id bigint, source_page int, source_file string, content binary"))


def told(*articles, **more):
    return json.dumps({"content": "".join(articles), **more})


def test_review_pages(spark):
    p = pages(spark, told(article(1, 3, 1), article(2, 0, 0), postloader="x"), told(article(1, 5, 1)), "age_restricted", "{", "[]", '{"status":404}', '{"error":1}', told("временно недоступен"), told("nothing"), "<body class='p-animes p-animes-show'><meta itemprop=url content='https://h/animes/z5-slug'>", "<p>", article(3, 9, 0))
    assert [r["page_status"] for r in p.orderBy("source_page").collect()] == ["reviews_json", "reviews_json", "age_restricted", "malformed_json", "json_non_object", "api_error_404", "api_error", "transient_unavailable", "json_no_reviews", "html_terminal", "html_unknown", "html_with_reviews"]
    rows = review_page.reviews(p)
    assert rows.columns == schemas.REVIEWS.names and [(r["review_id"], r["usefulness_rank"], r["votes_for"], r["source_page"]) for r in rows.orderBy("usefulness_rank").collect()] == [(3, 1, 9, 12), (1, 2, 5, 2), (2, 3, 0, 1)]
    r = rows.where("review_id = 2").first()
    assert r["usefulness_ratio"] is None and r["comments_count"] == 1234 and r["user_score"] == 8 and r["user_list_status"] == "completed" and r["body_text"] == "Текст\ninner" and r["body_images"][0]["url"] == "https://h/i.png" and r["body_images"][0]["classes"] == ["a", "z"]
    assert review_page.next_page_expected(pages(spark, told(article(1, 1, 0), postloader=""))).first()["last_page"] == 1


@pytest.mark.parametrize("bad", [article(1, 1, 0, opinion="odd"), article(1, "x", 0), article(1, 1, 0).replace("/animes/z5-", "/animes/z6-"), article(1, 1, 0).replace('itemprop="text"', ""), article(1, 1, 0).replace("data-track_topic", "x")])
def test_broken_review(spark, bad):
    p = pages(spark, told(bad, article(2, 1, 0)))
    with pytest.raises(Exception, match="article 1"):
        review_page.reviews(p).collect()
    assert [r["review_id"] for r in review_page.reviews(p, strict=False).collect()] == [2]


def flattened(value):
    """A payload that refers to every value by its place."""
    out = []

    def put(x):
        at = len(out)
        out.append(None)
        out[at] = {k: put(v) for k, v in x.items()} if isinstance(x, dict) else [put(v) for v in x] if isinstance(x, list) else x
        return at

    put(value)
    return json.dumps([["ShallowReactive", 1], *[{k: v + 1 for k, v in x.items()} if isinstance(x, dict) else [v + 1 for v in x] if isinstance(x, list) else x for x in out]])


def test_news_pages(spark):
    from driftmill.operators import news_page, quality

    comments = [{"comment": {"id": 1}, "comments": [{"comment": {"id": 2}, "comments": []}, {"comment": {"id": 2}, "comments": []}]}]
    news = {"id": 7, "title": "Имя", "alias": "slug", "content": "<p>a <a href='/l'>b</a></p><p>c</p>", "category": {"title": "К", "alias": "k"}, "tags": [{"alias": "t"}], "commentsTotal": 2}
    state = {"data": {"x": {}, "/news/7/": {"news": news, "comments": comments, "commentsMeta": {"count": 2, "hasSpoilers": True}, "emotions": [{"emotionId": 2, "count": 4}, {"emotionId": 2, "count": 5}], "author": {"id": 3, "user": {"login": "who"}}}}, "path": "/news/7/", "error": None}
    html = '<title>T</title><meta property="og:url" content="https://h/news/7-slug"><script type="application/ld+json">{"@type":"Article","datePublished":"2020"}</script><script id="__NUXT_DATA__">%s</script>'
    gone = {"data": {}, "error": {"statusCode": 404, "message": "gone"}}
    files = spark.createDataFrame([(i, f"{i}.html", len(c) or 1, "0" * 64, bytearray(c.encode())) for i, c in ((7, html % flattened(state)), (8, html % flattened(gone)), (9, "<p>"), (10, ""), (11, html % flattened({"data": {}})))], "source_id bigint, source_file string, length bigint, sha256 string, content binary")
    df = news_page.news_pages(files)
    assert df.schema.names == schemas.NEWS.names
    rows = {r["source_id"]: r for r in df.collect()}
    assert {i: r["status"] for i, r in rows.items()} == {7: "ok", 8: "not_found", 9: "parse_error", 10: "parse_error", 11: "missing_news"}
    r = rows[7]
    want = {"news_id": 7, "title": "Имя", "slug": "slug", "url": "https://h/news/7-slug", "content_text": "a b\nc", "published_at": "2020", "author_name": "who", "author_id": 3, "category_slug": "k", "comments_total": 2, "comments_loaded_count": 2, "comments_complete": True, "has_spoilers": True, "reaction_like_count": 5, "reaction_total": 5, "nuxt_route": "/news/7/"}
    assert {k: r[k] for k in want} == want and json.loads(r["content_links"])[0]["url"] == "https://h/l"
    assert rows[8]["error_status_code"] == 404 and rows[8]["error_message"] == "gone" and rows[8]["title"] == "" and rows[9]["error_message"].startswith("ValueError")
    own = quality.Rules({k: v for k, v in quality.NEWS_RULES.wrong.items() if k != "reaction_total"})
    assert {x["rule"]: x["rows"] for x in own.counts(df).collect() if x["rows"]} == {}
