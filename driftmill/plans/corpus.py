"""Queries of the engine's own operators over the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmill.functions import text, times
from driftmill.operators import devalue as dv
from driftmill.operators import html as page
from driftmill.operators import contracts, match, quality, rank, stats
from driftmill.session import checkpoint_dir, spread, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


# --- ranking, de-duplication, order

_LAST = """last AS (SELECT anime_id, review_id, votes_for, votes_against, coalesce(usefulness_score, votes_for - votes_against) AS score, source_page, source_position FROM reviews
  QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY source_page DESC, source_position DESC) = 1)"""


def _last_reviews(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "reviews").select("anime_id", "review_id", "votes_for", "votes_against", F.coalesce("usefulness_score", F.col("votes_for") - F.col("votes_against")).alias("score"), "source_page", "source_position")
    return rank.last_wins(r, ["review_id"], ["source_page", "source_position"])


@query(f"WITH {_LAST} SELECT anime_id, review_id, row_number() OVER (PARTITION BY anime_id ORDER BY score DESC, votes_for DESC, review_id DESC) AS usefulness_rank FROM last")
def usefulness_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Rank of every review within its anime, after the last of repeated reviews won."""
    return rank.ranked(_last_reviews(spark, sf), ["anime_id"], [F.desc("score"), F.desc("votes_for"), F.desc("review_id")], "usefulness_rank").select("anime_id", "review_id", "usefulness_rank")


@query(f"WITH {_LAST} SELECT review_id, source_page, source_position, score FROM last")
def last_wins_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _last_reviews(spark, sf).select("review_id", "source_page", "source_position", "score")


@query("""WITH o AS (SELECT votes_for, votes_against, body_html, lag(votes_for) OVER w AS pf, lag(votes_against) OVER w AS pa, lag(body_html) OVER w AS ph, lag(1) OVER w AS p FROM reviews WINDOW w AS (PARTITION BY review_id ORDER BY source_page, source_position))
SELECT count(p) AS duplicates, CAST(coalesce(sum(CASE WHEN p IS NOT NULL AND (votes_for IS DISTINCT FROM pf OR votes_against IS DISTINCT FROM pa OR body_html IS DISTINCT FROM ph) THEN 1 ELSE 0 END), 0) AS BIGINT) AS conflicts FROM o""")
def review_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated reviews, and those that differ from the occurrence before them."""
    keep = table(spark, sf, "reviews").select("review_id", "source_page", "source_position", "votes_for", "votes_against", "body_html")
    return rank.duplicates(keep, ["review_id"], ["source_page", "source_position"], ["review_id", "source_page", "source_position"])


@query("""WITH r AS (SELECT DISTINCT anime_id, usefulness_rank FROM reviews), l AS (SELECT *, lag(usefulness_rank) OVER (PARTITION BY anime_id ORDER BY usefulness_rank) AS previous FROM r)
SELECT anime_id, usefulness_rank, previous FROM l WHERE usefulness_rank <> coalesce(previous, 0) + 1""")
def rank_continuity(spark: SparkSession, sf: str) -> DataFrame:
    """Stored ranks that don't follow the one before."""
    return rank.rank_breaks(table(spark, sf, "reviews").select("anime_id", "usefulness_rank").distinct(), ["anime_id"], "usefulness_rank")


@query("""WITH o AS (SELECT anime_id, usefulness_rank, review_id, row(usefulness_score, votes_for, review_id) AS k, lag(row(usefulness_score, votes_for, review_id)) OVER (PARTITION BY anime_id ORDER BY usefulness_rank, review_id, source_page, source_position) AS p
  FROM reviews WHERE usefulness_score IS NOT NULL) SELECT anime_id, review_id, usefulness_rank FROM o WHERE p IS NOT NULL AND k >= p""")
def rank_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that stand below one they should stand above, by the stored rank."""
    r = table(spark, sf, "reviews").where("usefulness_score IS NOT NULL").select("anime_id", "usefulness_rank", "review_id", "usefulness_score", "votes_for", "source_page", "source_position")
    return rank.order_breaks(r, ["anime_id"], ["usefulness_rank", "review_id", "source_page", "source_position"], ["usefulness_score", "votes_for", "review_id"]).select("anime_id", "review_id", "usefulness_rank")


@query()
def rank_order_all(spark: SparkSession, sf: str) -> DataFrame:
    """As rank_order, with the score of all rows: a null one is votes_for - votes_against."""
    score = F.coalesce("usefulness_score", F.col("votes_for") - F.col("votes_against")).alias("usefulness_score")
    r = table(spark, sf, "reviews").select("anime_id", "usefulness_rank", "review_id", score, "votes_for", "source_page", "source_position")
    return rank.order_breaks(r, ["anime_id"], ["usefulness_rank", "review_id", "source_page", "source_position"], ["usefulness_score", "votes_for", "review_id"]).select("anime_id", "review_id", "usefulness_rank")


@query("SELECT count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(least(n, 50)) AS BIGINT) AS capped FROM (SELECT anime_id, count(DISTINCT review_id) AS n FROM reviews GROUP BY 1)")
def capped_count(spark: SparkSession, sf: str) -> DataFrame:
    return rank.capped_count(table(spark, sf, "reviews").select("anime_id", "review_id").distinct(), ["anime_id"], 50)


@query("SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 50")
def topk_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 longest documents of each source; Spark keeps 50 of every partial sort before the shuffle."""
    d = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return rank.top(d, ["source"], [F.desc("n_chars"), F.asc("doc_id")], 50)


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def first_wins_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return rank.first_wins(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT anime_id, max_by(usefulness_score, row(source_page, source_position, review_id)) FILTER (usefulness_score IS NOT NULL) AS usefulness_score FROM reviews GROUP BY 1")
def last_known_value(spark: SparkSession, sf: str) -> DataFrame:
    """Last score that isn't null, in page order."""
    return rank.last_known(table(spark, sf, "reviews"), ["anime_id"], "usefulness_score", ["source_page", "source_position", "review_id"])


# --- statistics

@query("SELECT coalesce(page_status, '') AS status, count(*) AS rows FROM anime_pages GROUP BY 1")
def status_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return stats.histogram(table(spark, sf, "anime_pages"), "page_status")


@query("""WITH h AS (SELECT status AS s, count(*) AS n FROM news GROUP BY 1), c AS (SELECT CASE WHEN s IN ('parse_error', 'missing_news') OR (starts_with(s, 'nuxt_error') AND s <> 'nuxt_error_404') THEN s || ': ' || n END AS reason FROM h)
SELECT list_sort(list(reason) FILTER (reason IS NOT NULL)) AS reasons FROM c""")
def incomplete_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return stats.incomplete_reasons(table(spark, sf, "news"), "status", ["parse_error", "missing_news"], "nuxt_error", "nuxt_error_404")


_SCORES = ", ".join(f"CASE WHEN list IS NOT NULL THEN CAST(coalesce(list_extract(list_filter(list, lambda x: x.score = '{i}'), -1).count, 0) AS BIGINT) END AS score_{i}_count" for i in range(10, 0, -1))


@query(f"""WITH j AS (SELECT record_id, CAST(try_cast(scoresstats AS JSON) AS STRUCT(score VARCHAR, count BIGINT)[]) AS list FROM animes),
s AS (SELECT record_id, list, CAST(list_sum(list_transform(list, lambda x: x.count)) AS BIGINT) AS total, list_sum(list_transform(list, lambda x: x.count * CAST(x.score AS BIGINT))) AS weighted FROM j)
SELECT record_id, {_SCORES}, CASE WHEN list IS NOT NULL THEN coalesce(total, 0) END AS score_votes_total, CASE WHEN total > 0 THEN round_even(CAST(weighted AS DOUBLE) / total, 4) END AS score_distribution_mean FROM s""")
def score_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return stats.score_distribution(table(spark, sf, "animes"), ["record_id"], "scoresstats")


_STATUSES = ["planned", "completed", "watching", "dropped", "on_hold"]


@query(f"""WITH j AS (SELECT record_id, CAST(try_cast(statusesstats AS JSON) AS STRUCT(status VARCHAR, count BIGINT)[]) AS list FROM animes)
SELECT record_id, {", ".join(f"CASE WHEN list IS NOT NULL THEN CAST(coalesce(list_extract(list_filter(list, lambda x: x.status = '{s}'), -1).count, 0) AS BIGINT) END AS list_{s}_count" for s in _STATUSES)},
CASE WHEN list IS NOT NULL THEN CAST(coalesce(list_sum(list_transform(list, lambda x: x.count)), 0) AS BIGINT) END AS list_total FROM j""")
def list_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return stats.list_distribution(table(spark, sf, "animes"), ["record_id"], "statusesstats", _STATUSES)


@query(f"""WITH e AS (SELECT DISTINCT source_id, source_file, emotions FROM news), j AS (SELECT source_id, source_file, CAST(try_cast(emotions AS JSON) AS STRUCT("emotionId" BIGINT, title VARCHAR, count BIGINT)[]) AS list FROM e),
c AS (SELECT source_id, source_file, {", ".join(f'CAST(coalesce(list_extract(list_filter(list, lambda x: x."emotionId" = {i} AND x.count IS NOT NULL), -1).count, 0) AS BIGINT) AS reaction_{n}_count' for i, n in stats.REACTIONS.items())} FROM j)
SELECT *, CAST({" + ".join(f"reaction_{n}_count" for n in stats.REACTIONS.values())} AS BIGINT) AS reaction_total FROM c""")
def reaction_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return stats.reactions(table(spark, sf, "news").select("source_id", "source_file", "emotions").distinct(), ["source_id", "source_file"], "emotions")


@query("SELECT min(source_id) AS first_id, max(source_id) AS last_id, count(DISTINCT source_id) AS ids, max(source_id) - min(source_id) + 1 = count(DISTINCT source_id) AS contiguous FROM news")
def id_contiguity(spark: SparkSession, sf: str) -> DataFrame:
    return stats.contiguity(table(spark, sf, "news"), "source_id")


@query("WITH d AS (SELECT DISTINCT source_id AS id FROM news), l AS (SELECT lag(id) OVER (ORDER BY id) AS after, id FROM d) SELECT after, id - after - 1 AS gap FROM l WHERE id > after + 1")
def id_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return stats.gaps(table(spark, sf, "news"), "source_id")


@query("""WITH g AS (SELECT anime_id, list(DISTINCT source_page) AS have, max(source_page) AS most FROM reviews GROUP BY 1), m AS (SELECT anime_id, list_sort(list_filter(range(1, most + 1), lambda i: NOT list_contains(have, i))) AS missing FROM g)
SELECT anime_id, missing FROM m WHERE len(missing) > 0""")
def missing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Page numbers that an anime's reviews skip."""
    return stats.missing_numbers(table(spark, sf, "reviews"), ["anime_id"], "source_page")


@query("SELECT meta.content_sha256 AS told_sha256, sha256(html) AS sha256, octet_length(html) AS bytes, url FROM raw_pages")
def content_digest(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "raw_pages").select("url", F.col("meta.content_sha256").alias("told_sha256"), F.sha2("html", 256).alias("sha256"), F.octet_length("html").cast("bigint").alias("bytes"))




@query(f"""WITH f AS (SELECT DISTINCT meta.source_file AS p, sha256(html) AS d FROM raw_pages), b AS (SELECT substr(sha256(p), 1, 3) AS q, sha256(string_agg(p || chr(9) || d, chr(10) ORDER BY p, d)) AS e, count(*) AS n FROM f GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS files, sha256(string_agg(q || chr(9) || e, chr(10) ORDER BY q)) AS digest FROM b""")
def tree_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return stats.fingerprint(table(spark, sf, "raw_pages").select(F.col("meta.source_file").alias("p"), F.sha2("html", 256).alias("d")).distinct(), "p", "d")


@query("""SELECT meta.dataset AS dataset, meta.page_kind AS page_kind, count(*) AS rows, CAST(sum(octet_length(html)) AS BIGINT) AS bytes, min(url) AS first_url, max(url) AS last_url FROM raw_pages GROUP BY ALL""")
def dry_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "raw_pages").groupBy(F.col("meta.dataset").alias("dataset"), F.col("meta.page_kind").alias("page_kind")).agg(F.count("*").alias("rows"), F.sum(F.octet_length("html").cast("bigint")).alias("bytes"), F.min("url").alias("first_url"), F.max("url").alias("last_url"))


# --- matching

@query("WITH p AS (SELECT DISTINCT entry_id AS id FROM anime_pages WHERE entry_id IS NOT NULL), a AS (SELECT DISTINCT id FROM animes WHERE id IS NOT NULL) SELECT id, CASE WHEN p.id IS NULL THEN 'missing' WHEN a.id IS NULL THEN 'extra' ELSE 'both' END AS state FROM a FULL JOIN p USING (id)")
def inventory_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Entities and their pages against each other."""
    return match.coverage(table(spark, sf, "animes").select("id"), table(spark, sf, "anime_pages").select(F.col("entry_id").alias("id")), "id")


@query("SELECT review_id, anime_id FROM reviews r WHERE NOT EXISTS (SELECT 1 FROM animes a WHERE a.id = r.anime_id)")
def anti_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return match.only_left(table(spark, sf, "reviews").select("review_id", "anime_id"), table(spark, sf, "animes").select(F.col("id").alias("anime_id")), "anime_id").select("review_id", "anime_id")


@query("SELECT record_id, id FROM animes a WHERE a.id IS NULL OR NOT EXISTS (SELECT 1 FROM anime_pages p WHERE p.entry_id = a.id)")
def anti_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of entities without a page."""
    return match.only_left(table(spark, sf, "animes").select("record_id", "id"), table(spark, sf, "anime_pages").select(F.col("entry_id").alias("id")).where("id IS NOT NULL"), "id").select("record_id", "id")


@query("""WITH u AS (SELECT anime_url AS url, anime_id AS v, 'reviews' AS s FROM reviews UNION ALL SELECT url, id, 'animes' FROM animes UNION ALL SELECT canonical_url, entry_id, 'pages' FROM anime_pages)
SELECT url, min(v) AS id, list_sort(list(DISTINCT s)) AS sources, count(DISTINCT v) > 1 AS conflict FROM u GROUP BY 1""")
def merged_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses of three tables united, with the tables that hold each and whether they disagree on its id."""
    pick = lambda t, u, i: table(spark, sf, t).select(F.col(u).alias("url"), F.col(i).alias("id"))
    return match.merged_sources({"reviews": pick("reviews", "anime_url", "anime_id"), "animes": pick("animes", "url", "id"), "pages": pick("anime_pages", "canonical_url", "entry_id")}, "url", "id")


@query("""WITH core AS (SELECT id, max_by(name, record_id) AS name, max_by(episodes, record_id) AS episodes FROM animes WHERE id IS NOT NULL GROUP BY 1), pg AS (SELECT entry_id AS id, max_by(title, source_file) AS name, max_by(episodes, source_file) AS episodes, max_by(score, source_file) AS score FROM anime_pages WHERE entry_id IS NOT NULL GROUP BY 1)
SELECT id, coalesce(c.name, p.name) AS name, coalesce(c.episodes, p.episodes) AS episodes, p.score AS score, list_filter([CASE WHEN c.id IS NULL THEN 'core' END, CASE WHEN p.id IS NULL THEN 'page' END], lambda x: x IS NOT NULL) AS missing_parts,
list_filter([CASE WHEN c.name <> p.name THEN 'name' END, CASE WHEN c.episodes <> p.episodes THEN 'episodes' END], lambda x: x IS NOT NULL) AS conflicts FROM core c FULL JOIN pg p USING (id)""")
def part_merge(spark: SparkSession, sf: str) -> DataFrame:
    """An entity's record from its API row and its page."""
    core = table(spark, sf, "animes").where("id IS NOT NULL").groupBy("id").agg(F.max_by("name", "record_id").alias("name"), F.max_by("episodes", "record_id").alias("episodes"))
    pages = table(spark, sf, "anime_pages").where("entry_id IS NOT NULL").groupBy(F.col("entry_id").alias("id")).agg(F.max_by("title", "source_file").alias("name"), F.max_by("episodes", "source_file").alias("episodes"), F.max_by("score", "source_file").alias("score"))
    return match.part_merge({"core": core, "page": pages}, "id")


@query("""WITH f AS (SELECT o_orderkey AS id, o_orderstatus AS kind FROM orders WHERE o_orderkey % 3 > 0), p AS (SELECT l_orderkey AS id, max(l_quantity) AS most FROM lineitem GROUP BY 1)
SELECT coalesce(f.id, p.id) AS id, CASE WHEN f.id IS NOT NULL THEN kind END AS kind, CASE WHEN f.id IS NOT NULL THEN most END AS most, CASE WHEN f.id IS NULL THEN 'extra' WHEN p.id IS NULL THEN 'missing' ELSE 'both' END AS state FROM f FULL JOIN p ON f.id = p.id""")
def recovery_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose nested field came back null get it from a second source."""
    fallback = table(spark, sf, "orders").where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("kind"), F.lit(None).cast("double").alias("most")).alias("topic"))
    partial = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.struct(F.max("l_quantity").alias("most")).alias("topic"))
    return match.recovery_merge(fallback, partial, "id", "topic", ["most"]).select("id", "topic.kind", "topic.most", "state")


@query()
def recovery_merge_all(spark: SparkSession, sf: str) -> DataFrame:
    """As recovery_merge, with every order; extra and missing are keys that only one of the tables has."""
    fallback = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderstatus").alias("kind"), F.lit(None).cast("double").alias("most")).alias("topic"))
    partial = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.struct(F.max("l_quantity").alias("most")).alias("topic"))
    return match.recovery_merge(fallback, partial, "id", "topic", ["most"]).select("id", "topic.kind", "topic.most", "state")


@query("""WITH t AS (SELECT DISTINCT source_requested_id AS id FROM anime_pages WHERE source_requested_id IS NOT NULL)
SELECT source_requested_id, redirect_id, t.id IS NOT NULL AS target_present FROM anime_pages p LEFT JOIN t ON p.redirect_id = t.id WHERE coalesce(redirect_id, '') <> ''""")
def redirect_audit(spark: SparkSession, sf: str) -> DataFrame:
    return match.redirects(table(spark, sf, "anime_pages"), "source_requested_id", "redirect_id")


@query("""WITH t AS (SELECT source_requested_id AS id, min(canonical_url || ' ' || source_file) AS c FROM anime_pages WHERE source_requested_id IS NOT NULL GROUP BY 1)
SELECT source_requested_id, redirect_id, t.id IS NOT NULL AS target_present, coalesce(contains(t.c, source_requested_id), false) AS mentions_source FROM anime_pages p LEFT JOIN t ON p.redirect_id = t.id WHERE coalesce(redirect_id, '') <> ''""")
def redirect_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """As redirect_audit, and whether the target's content names the page."""
    pages = table(spark, sf, "anime_pages").withColumn("content", F.concat("canonical_url", F.lit(" "), "source_file"))
    return match.redirects(pages, "source_requested_id", "redirect_id", "content")


@query("""WITH c AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey) AS o, c_nationkey AS n, c_acctbal AS b FROM customer), s AS (SELECT s_suppkey AS id, row_number() OVER (ORDER BY s_suppkey) AS o, s_nationkey AS n FROM supplier)
SELECT id, c.b AS balance, coalesce(c.n, s.n) AS nation, list_filter([CASE WHEN c.id IS NULL THEN 'missing:a' END, CASE WHEN s.id IS NULL THEN 'missing:b' END, CASE WHEN c.o <> s.o THEN 'order:b' END, CASE WHEN c.n <> s.n THEN 'differs:place.nation' END], lambda x: x IS NOT NULL) AS problems FROM c FULL JOIN s USING (id)""")
def strict_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that must hold the same ids in the same order, with a nested object merged field by field."""
    from driftmill.operators.order import placed

    a = placed(table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.struct(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")).alias("place")), [], [F.col("id")], "o")
    b = placed(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.struct(F.col("s_nationkey").alias("nation")).alias("place")), [], [F.col("id")], "o")
    return match.strict_part_merge({"a": a, "b": b}, "id", "o").select("id", F.col("place.balance").alias("balance"), F.col("place.nation").alias("nation"), "problems")


@query("SELECT r.review_id, r.anime_id, a.name FROM reviews r LEFT JOIN (SELECT id, max_by(name, record_id) AS name FROM animes GROUP BY 1) a ON a.id = r.anime_id")
def enrichment(spark: SparkSession, sf: str) -> DataFrame:
    names = table(spark, sf, "animes").where("id IS NOT NULL").groupBy(F.col("id").alias("anime_id")).agg(F.max_by("name", "record_id").alias("name"))
    return match.enriched(table(spark, sf, "reviews").select("review_id", "anime_id"), names, "anime_id").select("review_id", "anime_id", "name")


# --- scalar functions

@query(r"""SELECT doc_id, trim(regexp_replace(replace(nfc_normalize(text), chr(0), ' '), '[\s\x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS text FROM documents WHERE text IS NOT NULL""")
def norm_text(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", "text")).select("doc_id", text.norm_text("text").alias("text"))


@query(r"""SELECT review_id, anime_url, regexp_replace(anime_url, '[?#].*$', '') AS clean, try_cast(nullif(regexp_extract(anime_url, '/animes/[A-Za-z]?(\d+)(?:-|/?$)', 1), '') AS BIGINT) AS url_id, lower(regexp_extract(anime_url, '^[a-z]+://([^/?#:]*)', 1)) AS host,
'https://mirror.example/' || ltrim(regexp_extract(anime_url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS mirrored, sha256(anime_url) || '.html' AS file_name FROM reviews""")
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    u = "anime_url"
    return table(spark, sf, "reviews").select("review_id", u, text.clean_url(u).alias("clean"), text.entity_id(u).alias("url_id"), text.url_host(u).alias("host"), text.with_host(u, "mirror.example").alias("mirrored"), text.hashed_file_name(u).alias("file_name"))


@query(r"""SELECT url, regexp_replace(replace(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/', '-'), '[^\p{L}\p{N}._-]', '-', 'g') || '.html' AS file_name, CASE WHEN contains(url, '/news/') THEN 'news' WHEN contains(url, '/film/') THEN 'film' ELSE 'other' END AS kind FROM raw_pages""")
def page_file_names(spark: SparkSession, sf: str) -> DataFrame:
    path = text.url_path("url")
    return table(spark, sf, "raw_pages").select("url", text.path_file_name("url").alias("file_name"), F.when(path.startswith("/news/"), "news").when(path.startswith("/film/"), "film").otherwise("other").alias("kind"))


@query(r"""SELECT source_file, regexp_extract(source_file, '([^/]+?)(\.[^./]*)?$', 1) AS stem, CASE WHEN regexp_full_match(regexp_extract(source_file, '([^/]+?)(\.[^./]*)?$', 1), '\d+') THEN 'numeric' WHEN regexp_full_match(regexp_extract(source_file, '([^/]+?)(\.[^./]*)?$', 1), '[A-Za-z]+\d+') THEN 'prefixed' ELSE 'named' END AS kind FROM anime_pages""")
def source_identity(spark: SparkSession, sf: str) -> DataFrame:
    stem = F.regexp_extract("source_file", r"([^/]+?)(\.[^./]*)?$", 1)
    return table(spark, sf, "anime_pages").select("source_file", stem.alias("stem"), text.file_identity(stem)["kind"].alias("kind"))


@query("SELECT source_id, source_file, coalesce(nullif(title, ''), nullif(page_title, ''), '') AS heading, concat_ws(' | ', nullif(category_title, ''), nullif(author_name, ''), nullif(source_site, '')) AS line FROM news")
def fallback_chains(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "news").select("source_id", "source_file", text.first_nonempty("title", "page_title").alias("heading"), text.join_nonempty(" | ", "category_title", "author_name", "source_site").alias("line"))


@query(r"""SELECT source_file, try_cast(nullif(regexp_extract(aired_on, '-?\d+', 0), '') AS BIGINT) AS year, list_filter(string_split(genres_ru, ' | '), lambda x: x <> '') AS genres, array_to_string(list_filter(string_split(genres_ru, ' | '), lambda x: x <> ''), ', ') AS joined FROM anime_pages""")
def info_values(spark: SparkSession, sf: str) -> DataFrame:
    genres = text.split_list("genres_ru", r" \| ")
    return table(spark, sf, "anime_pages").select("source_file", text.integer("aired_on").alias("year"), genres.alias("genres"), text.join_array(genres, ", ").alias("joined"))


@query("""SELECT record_id, try_cast(json_extract_string(airedon, '$.year') AS BIGINT) AS year, array_to_string(CAST(json_extract_string(try_cast(genres AS JSON), '$[*].name') AS VARCHAR[]), ' | ') AS genres, len(CAST(json_extract_string(try_cast(studios AS JSON), '$[*].id') AS VARCHAR[])) AS studios FROM animes""")
def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    names = F.transform(F.from_json("genres", "array<struct<id: string, name: string>>"), lambda x: x["name"])
    return table(spark, sf, "animes").select("record_id", text.json_integer("airedon", "$.year").alias("year"), F.coalesce(text.join_array(names), F.lit("")).alias("genres"), F.coalesce(F.size(F.from_json("studios", "array<struct<id: string>>")), F.lit(0)).cast("bigint").alias("studios")).withColumn("genres", F.col("genres"))


@query("""SELECT source_id, source_file, CASE WHEN error_status_code = 404 THEN 'not_found' WHEN error_status_code IS NOT NULL THEN 'nuxt_error' WHEN coalesce(nuxt_news, 'null') <> 'null' THEN 'ok' WHEN error_message <> '' THEN 'parse_error' ELSE 'missing_news' END AS derived FROM news""")
def news_status(spark: SparkSession, sf: str) -> DataFrame:
    """Status of a news row from what it holds."""
    s = F.when(F.col("error_status_code") == 404, "not_found").when(F.col("error_status_code").isNotNull(), "nuxt_error").when(F.coalesce("nuxt_news", F.lit("null")) != "null", "ok").when(F.col("error_message") != "", "parse_error").otherwise("missing_news")
    return table(spark, sf, "news").select("source_id", "source_file", s.alias("derived"))


@query("SELECT record_id, CASE WHEN j IS NULL THEN NULL WHEN CAST(j AS VARCHAR) IN ('null', '[]', '{}') THEN '' ELSE 'x' END AS shape FROM (SELECT record_id, try_cast(genres AS JSON) AS j FROM animes WHERE genres IS NOT NULL)")
def compact_json_shape(spark: SparkSession, sf: str) -> DataFrame:
    c = text.compact_json("genres")
    return table(spark, sf, "animes").where("genres IS NOT NULL").select("record_id", F.when(c != "", "x").otherwise(c).alias("shape"))


@query("""WITH j AS (SELECT record_id, try_cast(genres AS JSON) AS j FROM animes WHERE genres IS NOT NULL), k AS (SELECT record_id, j, CASE WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[]) END AS list FROM j)
SELECT record_id, CASE WHEN j IS NULL THEN NULL WHEN CAST(j AS VARCHAR) IN ('null', '[]', '{}') THEN '' ELSE '[' || array_to_string(list_transform(list, lambda o: '{' || array_to_string(list_transform(list_sort(json_keys(o)), lambda f: '"' || f || '":' || CAST(json_extract(o, '$."' || f || '"') AS VARCHAR)), ',') || '}'), ',') || ']' END AS compact FROM k""")
def compact_json_text(spark: SparkSession, sf: str) -> DataFrame:
    """JSON in its compact form: sorted keys, no spaces, blank for what is empty."""
    return table(spark, sf, "animes").where("genres IS NOT NULL").select("record_id", text.compact_json("genres").alias("compact"))


@query("SELECT source_id, source_file, list_sort(CAST(json_extract_string(try_cast(tags AS JSON), '$[*].alias') AS VARCHAR[])) AS tags FROM news WHERE try_cast(tags AS JSON) IS NOT NULL")
def joined_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "news").where("tags IS NOT NULL").select("source_id", "source_file", F.array_sort(F.transform(F.from_json("tags", "array<struct<alias: string>>"), lambda x: x["alias"])).alias("tags"))


# --- rules

def _rules_sql(name: str, rules: quality.Rules) -> str:
    ansi = lambda e: e.replace("NOT RLIKE '^[0-9a-f]{64}$'", "NOT SIMILAR TO '[0-9a-f]{64}'").replace("NOT (news_id <=> source_id)", "news_id IS DISTINCT FROM source_id").replace("NOT (error_status_code <=> 404)", "error_status_code IS DISTINCT FROM 404")
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {ansi(e)}) AS rows FROM {name}" for n, e in rules.wrong.items())


@query(_rules_sql("reviews", quality.REVIEW_RULES))
def review_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.REVIEW_RULES.counts(table(spark, sf, "reviews"))


@query(_rules_sql("news", quality.NEWS_RULES))
def news_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.NEWS_RULES.counts(table(spark, sf, "news"))


@query("SELECT url, count(*) AS rows FROM raw_pages GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.repeated(table(spark, sf, "raw_pages"), ["url"])


@query("SELECT range AS source_id, 'missing' AS state FROM range(0, 301) WHERE range NOT IN (SELECT source_id FROM news) UNION ALL SELECT DISTINCT source_id, 'extra' FROM news WHERE source_id > 300")
def range_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return quality.range_coverage(table(spark, sf, "news"), "source_id", 0, 300)


@query()
def range_coverage_all(spark: SparkSession, sf: str) -> DataFrame:
    """As range_coverage, over the table's own range of ids."""
    news = table(spark, sf, "news")
    first, last = news.agg(F.min("source_id"), F.max("source_id")).first()
    return quality.range_coverage(news, "source_id", first or 0, -1 if last is None else last)


@query("""SELECT record_id, list_sort(list_filter(['id', 'name', 'mainUrl'], lambda x: NOT list_contains(json_keys(j), x))) AS missing FROM (SELECT record_id, try_cast(airedon AS JSON) AS j FROM animes) WHERE json_type(j) = 'OBJECT'""")
def key_contract(spark: SparkSession, sf: str) -> DataFrame:
    k = quality.key_set("airedon", ["id", "name", "mainUrl"], ["date", "day", "month", "year"])
    return table(spark, sf, "animes").select("record_id", F.array_sort(k["missing"]).alias("missing")).where("missing IS NOT NULL")


# --- pages

@query()
def page_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features of every saved page, from one parse."""
    pages = spread(table(spark, sf, "raw_pages").select("url", "html"))
    f = page.page_status(page.html_features(pages, ["url"], "html", "url"))
    return f.select("url", "title", "h1", "page_status", F.size("links").alias("links"), F.size("images").alias("images"), F.size("metas").alias("metas"), "parse_error")


@query()
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Every link of every saved page, absolute."""
    pages = spread(table(spark, sf, "raw_pages").select("url", "html"))
    return page.html_features(pages, ["url"], "html", "url").select(F.col("url").alias("page_url"), F.posexplode("links").alias("ordinal", "link")).select("page_url", "ordinal", "link.*")


@query(r"""SELECT review_id, source_file, source_position, array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(body_html, '<(br|/?(p|div|li|ul|ol|pre|h[1-6]))( [^>]*)?/?>', chr(10), 'g'), '<[^>]*>', '', 'g'), '[ \t]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)) AS text
FROM reviews WHERE NOT contains(body_html, '&') AND NOT regexp_matches(body_html, '<[^a-z/]|<math|<syntax|<3')""")
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of review bodies that hold no entities and no foreign tags, so that SQL can tell the same."""
    r = table(spark, sf, "reviews").where(~F.contains("body_html", F.lit("&")) & ~F.col("body_html").rlike("<[^a-z/]|<math|<syntax|<3")).select("review_id", "source_file", "source_position", "body_html")
    return spread(r).select("review_id", "source_file", "source_position", page.html_text("body_html").alias("text"))


@query()
def html_text_all(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of all review bodies."""
    return spread(table(spark, sf, "reviews").select("review_id", "source_file", "source_position", "body_html")).select("review_id", "source_file", "source_position", page.html_text("body_html").alias("text"), page.html_text_flat("body_html").alias("flat"))


@query()
def devalue_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Every news payload flattened into one list of references, and read back."""

    def flat(text_: str | None) -> str | None:
        try:
            value = json.loads(text_ or "")
        except ValueError:
            return None
        out: list = []

        def put(x) -> int:
            at = len(out)
            out.append(None)
            out[at] = {k: put(v) for k, v in x.items()} if isinstance(x, dict) else [put(v) for v in x] if isinstance(x, list) and not (x and isinstance(x[0], str)) else ["Object", x] if isinstance(x, list) else x
            return at

        out.append({"data": None})
        out[0] = {"data": put(value)}
        return json.dumps(out, ensure_ascii=False)

    @F.pandas_udf("string")
    def told(x: pd.Series) -> pd.Series:
        return x.map(flat)

    return table(spark, sf, "news").select("source_id", "source_file", dv.devalue(told("nuxt_news"), "data").alias("x")).select("source_id", "source_file", "x.value", "x.error")


@query("""WITH RECURSIVE t AS (SELECT source_id, source_file, unnest(CAST(try_cast(comments AS JSON) AS JSON[])) AS node FROM news UNION ALL SELECT source_id, source_file, unnest(CAST(json_extract(node, '$.comments') AS JSON[])) FROM t),
n AS (SELECT source_id, source_file, count(DISTINCT try_cast(json_extract_string(node, '$.comment.id') AS BIGINT)) AS loaded FROM t GROUP BY ALL)
SELECT source_id, source_file, coalesce(loaded, 0) AS loaded, comments_total AS declared, coalesce(loaded, 0) = comments_total AS complete, comments_total - coalesce(loaded, 0) AS missing FROM news LEFT JOIN n USING (source_id, source_file)""")
def comment_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct comments of a tree of any depth against the declared count."""
    news = table(spark, sf, "news").select("source_id", "source_file", "comments", "comments_total")

    @F.pandas_udf("array<bigint>")
    def ids(trees: pd.Series) -> pd.Series:
        def one(t):
            try:
                todo, out = [json.loads(t)] if t else [], set()
            except ValueError:
                return []
            while todo:
                x = todo.pop()
                if isinstance(x, list):
                    todo.extend(x)
                elif isinstance(x, dict):
                    c = x.get("comment")
                    if isinstance(c, dict) and not isinstance(c.get("id"), bool) and str(c.get("id", "")).strip().isdigit():
                        out.add(int(c["id"]))
                    todo.extend(v for k, v in x.items() if k != "comment" and isinstance(v, (list, dict)))
            return sorted(out)

        return trees.map(one)

    loaded = F.size(ids("comments")).cast("bigint")
    return news.select("source_id", "source_file", loaded.alias("loaded"), F.col("comments_total").alias("declared")).select("*", (F.col("loaded") == F.col("declared")).alias("complete"), (F.col("declared") - F.col("loaded")).alias("missing"))


# --- contracts of acquisition

@query(r"""WITH n AS (SELECT source_id, source_file, error_status_code AS s, lower(coalesce(error_message, '')) AS m, source_id % 9 AS attempt FROM news)
SELECT source_id, source_file, CASE WHEN s IN (408, 425, 429) OR s >= 500 THEN 'retry' WHEN regexp_matches(m, 'cannot return null for non-nullable') THEN 'recover' WHEN s IS NULL AND regexp_matches(m, 'timed? ?out|connection (reset|aborted|refused)|retry later') THEN 'retry' WHEN s IS NULL AND m = '' OR s < 400 THEN 'none' ELSE 'fatal' END AS asks,
CASE WHEN s IN (408, 425, 429) OR s >= 500 THEN least(pow(2.0, attempt), 100.0) END AS wait FROM n""")
def retry_plan(spark: SparkSession, sf: str) -> DataFrame:
    """What each failed page asks for, and how long its next attempt waits."""
    status = F.col("error_status_code")
    return table(spark, sf, "news").select("source_id", "source_file", contracts.error_class(status, F.col("error_message")).alias("asks"), contracts.retry_delay(status, F.lit(None).cast("string"), F.col("source_id") % 9, 100).alias("wait"))


@query("""WITH e AS (SELECT event_id, epoch_us(ts) AS at, row_number() OVER (ORDER BY ts, event_id) AS i FROM events), t AS (SELECT e.event_id, e.at, e.at - a.at AS spacing, e.at - b.at AS span FROM e LEFT JOIN e a ON a.i = e.i - 1 LEFT JOIN e b ON b.i = e.i - 5)
SELECT * FROM t WHERE spacing < 1000000 OR span < 60000000""")
def rate_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Events less than a second after the one before, or the sixth and later of any minute."""
    log = table(spark, sf, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return contracts.rate_breaks(log, "at", "event_id", 1_000_000, 5)


# --- publication and streams

def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/driftmill-{uuid.uuid4().hex}"


@query("SELECT count(DISTINCT review_id) AS rows, 'published' AS first, 'already_present' AS second FROM reviews")
def staged_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked reviews published through staging, then once more without effect."""
    from driftmill.plans.publish import publish

    path, df = _folder(spark), usefulness_rank(spark, sf)
    first, second = publish(df, path, ["anime_id", "usefulness_rank"]), publish(df, path, ["anime_id", "usefulness_rank"])
    return spark.createDataFrame([(first["rows"], first["status"], second["status"])], "rows bigint, first string, second string")


@query("SELECT doc_id, source, n_chars FROM documents")
def published_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents published in three parts, after a run that died with two of them written; read from the current version."""
    from driftmill.plans import publish as pub

    path, df = _folder(spark), table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    folder, _ = pub.stage(df, path, ["doc_id"], "documents", 3)
    pub.Store(spark, path).delete(f"{folder}/part=1")  # as if it had died there
    told = pub.publish(df, path, ["doc_id"], source="documents", parts=3)
    if told["resumed_parts"] != 2 or pub.publish(df, path, ["doc_id"])["status"] != "already_present" or pub.verify(spark, path):
        raise ValueError(f"the stage wasn't resumed or isn't sound: {told}")
    return pub.read(spark, path)


@query("SELECT review_id, anime_id, source_page, source_position FROM reviews")
def ingested_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews that land in two slices, each followed by a run of the stream, then by one that finds nothing; every row once."""
    from driftmill.streaming.ingest import ingest

    base, source = _folder(spark), table(spark, sf, "reviews").select("review_id", "anime_id", "source_page", "source_position")
    run = lambda: ingest(spark, f"{base}/landed", source.schema, f"{base}/target", f"{base}/checkpoint")
    late = F.col("review_id") > source.agg(F.expr("percentile_approx(review_id, 0.7)")).first()[0]
    for part in (~late, late):
        source.where(F.coalesce(part, F.lit(False)) if part is late else F.coalesce(part, F.lit(True))).write.mode("append").parquet(f"{base}/landed")
        run()
    if run():
        raise ValueError("a run without new files wrote a batch")
    return spark.read.parquet(f"{base}/target").select(*source.columns)


@query("SELECT count(*) AS rows, true AS once FROM reviews")
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The review table ingested as a stream, twice from one checkpoint: the second run finds nothing new."""
    from driftmill.streaming.ingest import ingest

    base, source = _folder(spark), table(spark, sf, "reviews").select("review_id", "anime_id", "source_page", "source_position")
    source.write.parquet(f"{base}/landed")
    run = lambda: ingest(spark, f"{base}/landed", source.schema, f"{base}/target", f"{base}/checkpoint")
    first, second = run(), run()
    rows = spark.read.parquet(f"{base}/target")
    return rows.agg(F.count("*").alias("rows")).withColumn("once", F.lit(bool(first) and not second))


@query("""WITH o AS (SELECT *, octet_length(html) AS b FROM raw_pages) SELECT count(*) AS rows, CAST(sum(b) AS BIGINT) AS bytes, true AS within FROM o""")
def greedy_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Pages in batches of at most 500 rows and 64 MiB, in order of their address."""
    from driftmill.plans.publish import greedy_batches as batches

    b = batches(table(spark, sf, "raw_pages").select("url", F.octet_length("html").cast("bigint").alias("bytes")), ["url"], "bytes", 500, 64 << 20)
    per = b.groupBy("batch").agg(F.count("*").alias("n"), F.sum("bytes").alias("s"))
    return per.agg(F.sum("n").alias("rows"), F.sum("s").alias("bytes"), F.bool_and((F.col("n") <= 500) & ((F.col("s") <= 64 << 20) | (F.col("n") == 1))).alias("within"))


@query("""WITH RECURSIVE o AS (SELECT doc_id, n_chars AS b, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
t AS (SELECT i, doc_id, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS n, CAST(b AS BIGINT) AS used FROM o WHERE i = 1
  UNION ALL SELECT o.i, o.doc_id, CASE WHEN t.n >= 50 OR t.used + o.b > 60000 THEN t.batch + 1 ELSE t.batch END, CASE WHEN t.n >= 50 OR t.used + o.b > 60000 THEN 1 ELSE t.n + 1 END, CASE WHEN t.n >= 50 OR t.used + o.b > 60000 THEN o.b ELSE t.used + o.b END FROM t JOIN o ON o.i = t.i + 1)
SELECT doc_id, batch FROM t""")
def greedy_batch_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The batch of every document, of at most 50 rows and 60,000 characters, in order of their ids."""
    from driftmill.plans.publish import greedy_batches as batches

    return batches(table(spark, sf, "documents").select("doc_id", "n_chars"), ["doc_id"], "n_chars", 50, 60_000).select("doc_id", "batch")


@query("SELECT user_id, epoch_us(max(ts)) AS latest, count(*) AS versions FROM events GROUP BY 1")
def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Latest event of each user, computed by a stream over the event file."""
    from driftmill.streaming.ingest import keep_latest

    base = _folder(spark)
    events = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    events.write.parquet(f"{base}/landed")
    out = keep_latest(spark, f"{base}/landed", events.schema, f"{base}/out", f"{base}/checkpoint", "user_id", "ts")
    return out.select("user_id", F.unix_micros("ts").alias("latest"), "versions")


@query("SELECT record_id, CAST(floor(e) AS BIGINT) AS seconds FROM (SELECT record_id, epoch(try_cast(regexp_replace(createdat, '([+-]\\d{2})(\\d{2})$', '\\1:\\2') AS TIMESTAMPTZ)) AS e FROM animes WHERE regexp_matches(createdat, '(Z|[+-]\\d{2}:?\\d{2})$'))")
def zoned_times(spark: SparkSession, sf: str) -> DataFrame:
    """Times kept as text, in several spellings of the zone, as seconds."""
    return table(spark, sf, "animes").where(F.col("createdat").rlike(r"(Z|[+-]\d{2}:?\d{2})$")).select("record_id", F.floor(times.zoned_micros(F.col("createdat")) / 1_000_000).cast("bigint").alias("seconds"))


@query()
def zoned_times_all(spark: SparkSession, sf: str) -> DataFrame:
    """As zoned_times, for every row; null where the text is none, names no zone or is no time."""
    return table(spark, sf, "animes").select("record_id", F.floor(times.zoned_micros(F.col("createdat")) / 1_000_000).cast("bigint").alias("seconds"))
