import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from driftmill import schemas, session
from driftmill.functions import text
from driftmill.operators import devalue, htmldom, match, order, quality, rank, stats
from driftmill.operators import html as page
from driftmill.plans import corpus
from driftmill.plans import publish as pub
from driftmill.sources import files


def one(spark, expr, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(expr).first()[0]


def test_text_functions(spark):
    assert one(spark, text.norm_text("x"), x="  a \x1c b\x00c é ") == "a b c é"
    assert one(spark, text.norm_text("x"), x=None) == ""
    assert one(spark, text.integer("x"), x="около -1 234 серий") == -1234 and one(spark, text.integer("x"), x="нет") is None
    assert one(spark, text.entity_id("x"), x="https://h/animes/z12-name?x=1") == 12 and one(spark, text.entity_id("x"), x="https://h/animes/12x") is None
    assert tuple(one(spark, text.episodes("x"), x="3 / ?")) == (3, None) and tuple(one(spark, text.episodes("x"), x="12")) == (12, 12)
    assert tuple(one(spark, text.resolution("x"), x="1920 х 1080")) == (1920, 1080)
    assert tuple(one(spark, text.file_identity("x"), x="ab12")) == ("12", "prefixed", "ab")
    assert one(spark, text.url_join("b", "u"), b="https://h/a/b", u="../c?x=1&amp;y=2") == "https://h/c?x=1&y=2"
    assert one(spark, text.path_file_name("x"), x="https://h/a/б в/?q") == "a-б-в.html"
    assert [one(spark, text.absolute_http("x"), x=x) for x in ("http://h", "HTTPS://h/x", "ftp://h", "/a", None)] == [True, True, False, False, False]
    assert [one(spark, text.json_integer("x", "$.n"), x=f'{{"n":{v}}}') for v in ('"1 2"', "3", "3.0", "3.5", "true", "null", '""')] == [12, 3, 3, None, None, None, None]
    assert one(spark, text.compact_json("x"), x='{"b":1, "a":"я"}') == '{"a":"я","b":1}' and one(spark, text.compact_json("x"), x="[]") == "" and one(spark, text.compact_json("x"), x="[") is None
    assert tuple(one(spark, text.error_detail("x"), x='{"statusCode":"404","statusMessage":" gone ","message":"gone"}')) == (404, "gone")
    assert one(spark, text.text_of_bytes(F.unhex("x")), x="61FF62") == "a�b"


def test_rank_and_dedup(spark, rows):
    df = spark.createDataFrame([(1, 1, 1, 5), (1, 1, 2, 6), (2, 1, 3, 6), (3, 2, 1, None)], "id int, g int, page int, v int")
    assert rows(rank.last_wins(df, ["id"], ["page"])) == {(1, 1, 2, 6), (2, 1, 3, 6), (3, 2, 1, None)}
    assert rows(rank.first_wins(df, ["id"], ["page"])) == {(1, 1, 1, 5), (2, 1, 3, 6), (3, 2, 1, None)}
    assert rank.duplicates(df, ["id"], ["page"], ["page"]).first().asDict() == {"duplicates": 1, "conflicts": 1}
    assert rows(rank.ranked(df, ["g"], [F.desc("v"), F.desc("id"), F.desc("page")], "r").select("id", "page", "r")) == {(2, 3, 1), (1, 2, 2), (1, 1, 3), (3, 1, 1)}
    assert rank.capped_count(df, ["g"], 2).first().asDict() == {"groups": 2, "rows": 4, "capped": 3}
    assert rows(rank.last_known(df, ["g"], "v", ["page"])) == {(1, 6), (2, None)}
    listing = spark.createDataFrame([("t", 1, ["a"]), ("t", 2, ["b"]), ("t", 3, ["b"]), ("t", 4, [])], "tag string, page int, urls array<string>")
    assert rows(rank.stops(listing, ["tag"], "page", "urls")) == {("t", 3)}


def test_places_and_neighbours_of_large_groups(spark, rows):
    """A group that lies in many chunks is ranked as if it were in one."""
    rng = random.Random(8)
    data = [(rng.choice([None, 1, 1, 1, 1, 2]), rng.randrange(50), i, rng.choice([None, "x", "y"])) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, v int, i int, t string")
    by = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, -r[1], r[2]))
    places, before, n, last = set(), set(), 0, None
    for k, r in enumerate(by):
        first = k == 0 or by[k - 1][0] != r[0]
        n, last = (1, None) if first else (n + 1, by[k - 1][3])
        places.add((r[2], n))
        before.add((r[2], last))
    order_ = [F.desc("v"), F.asc("i")]
    assert rows(order.placed(df, ["g"], order_, "p").select("i", "p")) == places
    assert rows(order.with_previous(df, ["g"], order_, F.col("t"), "b").select("i", "b")) == before
    assert order.placed(df.limit(0), ["g"], order_, "p").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_on_a_hot_key(spark, rows, monkeypatch, how):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)] + [(None, 7)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (6, "b"), (None, "c")], "k int, w string")
    plain = rows(left.join(right, "k", how))
    assert rows(session.join_hot(left, right, "k", how)) == rows(session.join_hot(left, right, "k", how, rows=3)) == plain
    assert rows(session.join_hot(left, right, "k", how, rows=3, limit=2)) == plain  # salted


def test_running_winner_conflicts(spark):
    """Each occurrence is compared with the one before it, not with the last."""
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "a"), (1, 4, "a")], "id int, page int, body string")
    assert rank.duplicates(df, ["id"], ["page"], ["page"]).first().asDict() == {"duplicates": 3, "conflicts": 2}


def test_matching(spark, rows):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "id int, n string"), spark.createDataFrame([(2, "y", 5), (3, "z", 6)], "id int, n string, s int")
    assert rows(match.coverage(a, b, "id")) == {(1, "missing"), (2, "both"), (3, "extra")}
    assert rows(match.only_left(a, b, "id")) == {(1, "x")}
    m = {r["id"]: r for r in match.part_merge({"a": a, "b": b}, "id").collect()}
    assert m[1]["missing_parts"] == ["b"] and m[3]["missing_parts"] == ["a"] and m[2]["conflicts"] == [] and m[2]["s"] == 5
    c = spark.createDataFrame([(2, "other")], "id int, n string")
    assert match.part_merge({"a": a, "c": c}, "id").where("id = 2").first()["conflicts"] == ["n"]
    with pytest.raises(Exception, match="repeated lookup key"):
        match.enriched(a, spark.createDataFrame([(1, "p"), (1, "q")], "id int, v string"), "id").collect()
    f = spark.createDataFrame([(1, (1, None)), (2, None)], "id int, t struct<a: int, b: int>")
    p = spark.createDataFrame([(1, (9,)), (2, (8,))], "id int, t struct<b: int>")
    assert {r["id"]: r["t"] and tuple(r["t"]) for r in match.recovery_merge(f, p, "id", "t", ["b"]).collect()} == {1: (1, 9), 2: None}


def test_statistics(spark, rows):
    df = spark.createDataFrame([(1, '[{"score":10,"count":1},{"score":9,"count":1},{"score":9,"count":2}]'), (2, "[]"), (3, None)], "id int, s string")
    d = {r["id"]: r for r in stats.score_distribution(df, ["id"], "s").collect()}
    assert d[1]["score_9_count"] == 2 and d[1]["score_votes_total"] == 3 and d[1]["score_distribution_mean"] == 9.3333  # the last of a repeated score
    assert d[2]["score_10_count"] == 0 and d[2]["score_distribution_mean"] is None and d[3]["score_10_count"] is None  # 0 is not blank
    e = spark.createDataFrame([(1, '[{"emotionId":2,"count":4},{"emotionId":"2","count":"5"},{"emotionId":9,"count":1}]')], "id int, e string")
    assert stats.reactions(e, ["id"], "e").first()["reaction_total"] == 5
    ids = spark.createDataFrame([(i,) for i in (1, 2, 5, 5, 9)], "id int")
    assert rows(stats.gaps(ids, "id")) == {(2, 2), (5, 3)} and stats.contiguity(ids, "id").first()["contiguous"] is False
    assert rows(stats.missing_numbers(spark.createDataFrame([("a", 1), ("a", 4), ("b", 1)], "g string, p int"), ["g"], "p")) == {("a", (2, 3))}
    t = spark.createDataFrame([("b", "2"), ("a", "1")], "p string, d string")
    assert rows(stats.fingerprint(t, "p", "d")) == rows(stats.fingerprint(t.orderBy("p").coalesce(1), "p", "d"))


def test_rules(spark, rows):
    rules = quality.Rules({"neg": "v < 0", "odd": "v % 2 = 1"})
    df = spark.createDataFrame([(1, 2), (2, -3), (3, None)], "id int, v int")
    good, bad = rules.split(df)
    assert rows(good) == {(1, 2), (3, None)} and [r["violations"] for r in bad.collect()] == [["neg"]]
    assert rows(rules.counts(df)) == {("neg", 1), ("odd", 0)}
    with pytest.raises(Exception, match="row 2: neg"):
        rules.strict(df, "id").collect()
    assert rows(quality.range_coverage(df, "id", 0, 2)) == {(0, "missing"), (3, "extra")}
    fields = spark.createDataFrame([("A", "id"), ("A", "new")], "type string, field string")
    assert rows(quality.field_coverage({"A": ["id", "gone"]}, fields)) == {("A", "new", "missing"), ("A", "gone", "extra")}


HTML = """<html><head><title> T </title><meta property="og:title" name="x" content="a"><meta name="d" content="b"><link rel="canonical" href="/c"><link rel="alternate" hreflang="ru" href="/r">
<script type="application/ld+json">[{"@type":"Person"},{"@type":"Article","n":1}]</script><script type="application/ld+json">{bad</script><script id="__NUXT_DATA__">[["Reactive",1],{"data":2},{"k":3},"v"]</script></head>
<body class="p-animes p-animes-show"><meta itemprop="headline" content="h"><h1>H</h1><div class="line"><div class="key">Жанры:</div><div class="value"><a href="/g/1" title="t">драма</a></div></div>
<div class="c" id="1">x<div class="c" id="2">y<br>z</div></div><img src="/i.png" alt="pic"><p>a<p>b</body></html>"""


def test_dom():
    root = htmldom.parse(HTML)
    assert htmldom.metas(root)[:2] == [("property", "og:title", "a"), ("name", "d", "b")] and htmldom.head_links(root) == ("/c", [("ru", "/r")])
    records, warnings = htmldom.json_ld(root)
    assert warnings == ["invalid_json_ld"] and json.loads(htmldom.of_type(records[:1], "Article"))["n"] == 1
    assert htmldom.links(root, "https://h/x")[0] == {"href": "/g/1", "url": "https://h/g/1", "text": "драма", "title": "t", "rel": ""}
    assert htmldom.info_lines(root) == [{"key": "Жанры", "value": "драма"}]
    assert htmldom.comment_parents(root, "div.c") == [("1", ""), ("2", "1")] and [n.get("id") for n in htmldom.outermost(root, "div.c")] == ["1"]
    assert htmldom.block_text(root.first("#1")) == "x\ny\nz"
    assert [x.get("id") for x in root.all("body > div.c, div[id*='2']")] == ["1", "2"] and root.first("h1, title").tag == "title"
    assert htmldom.markup(root.first("p")).startswith("a<p>b")  # no implied end tags
    assert devalue.decode(htmldom.payload(root), "data") == {"k": "v"}


def test_devalue():
    flat = json.dumps([{"data": 1}, {"s": 2, "m": 3, "d": 4, "b": 5, "u": -1, "n": -3, "self": 1, "x": 6, "r": 9, "o": 10}, ["Set", 7, 7], ["Map", 8, 7], ["Date", "2024"], ["BigInt", "12345678901234567890"], ["custom", 7], 1, "k", ["RegExp", "a", "i"], ["null", "p", 7]])
    got = devalue.decode(flat, "data")
    assert got["self"] == "<cycle>"
    assert {k: got[k] for k in "smdbunxro"} == {"s": [1, 1], "m": [["k", 1]], "d": "2024", "b": 12345678901234567890, "u": None, "n": "NaN", "x": {"__nuxt_type__": "custom", "value": 1}, "r": {"source": "a", "flags": "i"}, "o": {"p": 1}}
    for bad in ("", "{}", "[]", "[1]", '[{"data":9}]', '[["Reactive",0]]', '[{"data":1},["Map",1]]'):
        with pytest.raises(ValueError):
            devalue.decode(bad, "data")


def test_devalue_of_any_depth_and_shared_values():
    deep = [{"data": 1}, *([i + 2] for i in range(50_000)), "end"]
    got = devalue.decode(json.dumps(deep), "data")
    for _ in range(50_000):
        got = got[0]
    assert got == "end"
    shared = devalue.decode('[{"a":1,"b":1,"c":2},["Set",3],{"k":1},"v"]')
    assert shared == {"a": ["v"], "b": ["v"], "c": {"k": ["v"]}} and shared["a"] is shared["b"]
    assert devalue.decode('[{"a":1},["RegExp","x"]]') == {"a": {"source": "x", "flags": ""}} and devalue.decode('[{"a":1},["Ref"]]') == {"a": None}
    assert devalue.decode('[["Reactive",1],["Ref",2],{"a":-6}]') == {"a": -0.0} and devalue.decode('[{"a":1.5,"b":true,"c":"t"}]') == {"a": 1.5, "b": True, "c": "t"}


def test_html_on_spark(spark):
    df = spark.createDataFrame([(1, HTML), (2, ""), (3, None), (4, "<h1>Страница не найдена</h1>")], "id int, h string")
    got = {r["id"]: r for r in page.page_status(page.html_features(df, ["id"], "h")).collect()}
    assert [got[i]["page_status"] for i in (1, 2, 3, 4)] == ["ok", "unknown", "unknown", "not_found"] and got[1]["payload"].startswith("[[")
    assert spark.createDataFrame([("[1",), (None,)], "p string").select(devalue.devalue("p", "data")["error"].alias("e")).where("e IS NULL").count() == 1


@pytest.mark.parametrize("charset", ["utf-8", "windows-1251", "koi8-r"])
def test_pages_are_read_by_their_charset(spark, tmp_path, charset):
    html = f'<meta charset="{charset}"><title>Имя</title><body><h1>Страница не найдена</h1><a href="/x">Ссылка</a></body>'
    pages = [("https://h/a", bytearray(html.encode(charset))), ("https://h/b", bytearray(b'<meta charset="idna"><title>\xd0\xb0</title>')), ("https://h/c", None)]
    spark.createDataFrame(pages, "url string, html binary").write.parquet(f"{tmp_path}/raw_pages.parquet")
    got = {r["url"]: r for r in corpus.page_features(spark, str(tmp_path)).collect()}
    assert [(got[u]["title"], got[u]["h1"], got[u]["page_status"], got[u]["parse_error"]) for u in sorted(got)] == [("Имя", "Страница не найдена", "not_found", ""), ("а", "", "unknown", ""), ("", "", "unknown", "")]
    assert [(r["url"], r["text"]) for r in corpus.page_links(spark, str(tmp_path)).collect()] == [("https://h/x", "Ссылка")]


def test_whole_tables(spark, tmp_path, rows):
    put = lambda name, data, ddl: spark.createDataFrame(data, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    got = lambda f: rows(f(spark, str(tmp_path)))
    put("orders", [(i, "O") for i in range(1, 10)], "o_orderkey bigint, o_orderstatus string")
    put("lineitem", [(i, float(q)) for i in range(2, 12) for q in (i, 1)], "l_orderkey bigint, l_quantity double")
    assert got(corpus.recovery_merge_all) == {(1, "O", None, "missing"), *((i, "O", float(i), "both") for i in range(2, 10)), (10, None, None, "extra"), (11, None, None, "extra")}
    rng = random.Random(3)
    r = [(a, n, i, rng.choice([None, rng.randrange(9)]), rng.randrange(9), rng.randrange(9), 1, n, f"<p>a &amp; {i}</p><p>x < 3</p>", "f") for a in range(3) for n, i in enumerate(rng.sample(range(100 * a, 100 * a + 99), 30))]
    put("reviews", r, "anime_id bigint, usefulness_rank bigint, review_id bigint, usefulness_score bigint, votes_for bigint, votes_against bigint, source_page bigint, source_position bigint, body_html string, source_file string")
    key = lambda x: (x[4] - x[5] if x[3] is None else x[3], x[4], x[2])
    assert got(corpus.rank_order_all) == {(y[0], y[2], y[1]) for x, y in zip(r, r[1:], strict=False) if x[0] == y[0] and key(y) >= key(x)}
    assert {(x[0], x[3]) for x in got(corpus.html_text_all)} == {(x[2], f"a & {x[2]}\nx < 3") for x in r}
    put("news", [(i,) for i in (400, 402, 402, 405, None)], "source_id bigint")
    assert got(corpus.range_coverage_all) == {(i, "missing") for i in (401, 403, 404)}
    put("animes", [(1, "1970-01-01T00:01:00 UTC"), (2, "1970-01-01 01:00:00+01:00"), (3, "1970-01-01T00:00:05Z"), (4, "1970-01-01T00:00:07GMT"), (5, "1970-01-01T00:00:05"), (6, None), (7, "x")], "record_id bigint, createdat string")
    assert got(corpus.zoned_times_all) == {(1, 60), (2, 0), (3, 5), (4, 7), (5, None), (6, None), (7, None)}


def test_sources(spark, tmp_path, rows):
    d = tmp_path / "in"
    d.mkdir()
    (d / "1.html").write_bytes(b"<p>\xff")
    (d / "2.html").write_bytes(b"")  # an empty file stays a row
    (d / "x.txt").write_text("x")
    assert rows(files.pages(spark, str(d)).select("source_file", "length")) == {("1.html", 4), ("2.html", 0)}
    good, bad = files.numbered_pages(spark, str(d))
    assert good.count() == 2 and rows(bad) == {("x.txt", "bad_name")}
    (d / "01.html").write_text("x")
    assert rows(files.numbered_pages(spark, str(d))[1]) == {("x.txt", "bad_name"), ("1.html", "repeated_id"), ("01.html", "repeated_id")}
    u = tmp_path / "u.txt"
    u.write_text("﻿https://h/a\n# no\n\nhttps://h/b\nhttps://h/a\nnope\n")
    urls, wrong = files.urls(spark, str(u))
    assert rows(urls) == {("https://h/a", 1), ("https://h/b", 4)} and rows(wrong) == {(6, "nope")}
    t = tmp_path / "t.tsv"
    t.write_text('a\tb\tc\n1\t\t0\n\t"q\t1\n')
    assert rows(files.tsv(spark, str(t), ["a", "b", "c"], {"a": "bigint", "c": "flag"})) == {(1, None, False), (None, '"q', True)}
    with pytest.raises(Exception):  # noqa: B017
        files.tsv(spark, str(t), ["a", "x", "c"]).collect()
    j = tmp_path / "j.jsonl.gz"
    with gzip.open(j, "wt") as f:
        f.write('{"id":1}\n[2]\n{"id":\n')
    ok, corrupt = files.json_lines(spark, str(j), spark.createDataFrame([], "id bigint").schema)
    assert rows(ok) == {(1,)} and corrupt.count() == 2
    e = tmp_path / "e.json"
    e.write_text(json.dumps({"_meta": {"page": "1"}, "records": [{"id": 1}, {"id": 2}]}))
    assert [r["record"]["id"] for r in files.envelopes(spark, str(e), "struct<id: bigint>").orderBy("ordinal").collect()] == [1, 2]
    assert rows(files.last_page(spark.createDataFrame([(1, 5), (2, 1), (3, 0), (4, 2)], "page int, n int"), "page", "n")) == {(1, 5), (2, 1)}


def test_publication(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(2, "b"), (1, None)], "id bigint, v string")
    with pytest.raises(ValueError, match="incomplete"):
        pub.publish(df, path, ["id"], complete=False)
    assert pub.publish(df, path, ["id"])["status"] == "published" and pub.publish(df, path, ["id"])["status"] == "already_present"
    assert pub.verify(spark, path) == [] and pub.bounds(spark, path, ["id"]) == ((1,), (2,))
    other = spark.createDataFrame([(3, "c")], "id bigint, v string")
    with pytest.raises(FileExistsError):
        pub.publish(other, path, ["id"])
    assert pub.publish(other, path, ["id"], force=True)["rows"] == 1 and rows(pub.read(spark, path)) == {(3, "c")}
    with pytest.raises(ValueError, match="repeated keys"):
        pub.publish(other.union(other), path, ["id"], force=True)
    assert rows(pub.read(spark, path)) == {(3, "c")}  # the earlier table stays
    assert pub.append_batch(other, str(tmp_path / "b"), "1") == "appended" and pub.append_batch(other, str(tmp_path / "b"), "1") == "already_present"
    sizes = spark.createDataFrame([(i, s) for i, s in enumerate((5, 5, 5, 99, 1))], "id int, s int").coalesce(1)
    b = pub.greedy_batches(sizes, ["id"], "s", 2, 10).groupBy("batch").agg(F.count("*").alias("n"), F.sum("s").alias("s"))
    assert b.where("n > 2 OR (s > 10 AND n > 1)").count() == 0
    a, c = str(tmp_path / "m"), str(tmp_path / "m2")
    other.write.parquet(f"{a}/x")
    assert pub.move_tree(spark, a, c, dry_run=True)["status"] == "would_move" and pub.move_tree(spark, a, c, expected={"x"})["status"] == "moved" and pub.move_tree(spark, a, c)["status"] == "already_moved"
    with pytest.raises(ValueError):
        pub.move_tree(spark, c, f"{c}/in")


def test_schemas():
    assert (len(schemas.REVIEWS), len(schemas.NEWS), len(schemas.RAW_PAGES)) == (36, 66, 3)
    assert schemas.schema_hash(schemas.NEWS) != schemas.schema_hash(schemas.REVIEWS) and not schemas.REVIEWS["anime_id"].nullable and schemas.REVIEWS["user_score"].nullable


def test_stream_takes_each_file_once(spark, tmp_path):
    from driftmill.streaming.ingest import ingest

    df = spark.createDataFrame([(1,), (2,)], "id int")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    go = lambda: ingest(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert go() == [0] and go() == []
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert go() == [1] and spark.read.parquet(str(tmp_path / "out")).count() == 4


@pytest.mark.parametrize("plain", [-1, order.PLAIN_ROWS])
def test_places_and_neighbours_both_ways(spark, rows, monkeypatch, plain):
    monkeypatch.setattr(order, "PLAIN_ROWS", plain)
    monkeypatch.setattr(order, "PLAIN_BYTES", plain)
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, 2, None]), i, rng.randrange(9)) for i in range(300)]
    df = spark.createDataFrame(data, "g int, i int, v int")
    want = {}
    for g in (1, 2, None):
        own = sorted(i for x, i, _ in data if x == g)
        want |= {i: (n + 1, own[n - 1] if n else None) for n, i in enumerate(own)}
    assert {(r["i"], r["p"]) for r in order.placed(df, ["g"], [F.col("i")], "p").collect()} == {(i, p) for i, (p, _) in want.items()}
    assert {(r["i"], r["b"]) for r in order.with_previous(df, ["g"], [F.col("i")], F.col("i"), "b").collect()} == {(i, b) for i, (_, b) in want.items()}
    pages = spark.createDataFrame([(1, 1, [5]), (1, 2, [5]), (1, 3, [6]), (2, 1, [1]), (2, 2, []), (3, 1, [2])], "g int, p int, c array<int>")
    assert rows(rank.stops(pages, ["g"], "p", "c")) == {(1, 2), (2, 2)}
    assert rows(stats.missing_numbers(spark.createDataFrame([(1, 2), (1, 5), (1, 5), (2, 1), (2, None), (3, 1_000_000_000), (3, 999_999_999)], "g int, n int").where("g < 3"), ["g"], "n")) == {(1, (1, 3, 4))}


def test_strict_part_merge(spark):
    a = spark.createDataFrame([(1, 0, "n", ("x", None)), (2, 1, "m", ("y", 1)), (3, 2, "k", None)], "id int, o int, name string, s struct<a: string, b: int>")
    b = spark.createDataFrame([(1, 0, ("x", 7)), (2, 1, ("z", 2)), (4, 2, (None, None))], "id int, o int, s struct<a: string, c: int>")
    c = spark.createDataFrame([(1, 0, 5), (2, 2, 6), (2, 3, 6), (3, 2, 7)], "id int, o int, score int")
    got = {r["id"]: r.asDict(recursive=True) for r in match.strict_part_merge({"a": a, "b": b, "c": c}, "id", "o").collect()}
    assert got[1] == {"id": 1, "name": "n", "s": {"a": "x", "b": None, "c": 7}, "score": 5, "problems": []}
    assert sorted(got[2]["problems"]) == ["differs:s.a", "order:c", "repeated:c"] and sorted(got[3]["problems"]) == ["missing:b"] and sorted(got[4]["problems"]) == ["missing:a", "missing:c"]
    assert got[3]["s"] is None


def test_fingerprint_of_folds_of_folds(spark):
    import hashlib

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    data = [(f"p{i}", sha(str(i))) for i in range(400)]
    df = spark.createDataFrame(data, "p string, d string")

    def fold(rows, digits):
        if digits < 0:
            return rows
        groups = {}
        for p, d in rows:
            groups.setdefault(p[:digits], []).append((p, d))
        return [(q, sha("\n".join(f"{p}\t{d}" for p, d in sorted(g)))) for q, g in groups.items()]

    for digits in (3, 6):
        rows = {}
        for p, d in data:
            rows.setdefault(sha(p)[:digits], []).append((p, d))
        level = [(q, sha("\n".join(f"{p}\t{d}" for p, d in sorted(g)))) for q, g in rows.items()]
        for upper in range(digits - 3, -1, -3):
            level = fold(level, upper)
        got = stats.fingerprint(df.repartition(5), "p", "d", digits).first()
        assert (got["files"], got["digest"]) == (400, level[0][1])
