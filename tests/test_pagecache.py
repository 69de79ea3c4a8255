import json

from driftmill.sources import pagecache as pc


def test_queries():
    q = pc.query_text("animes", "id  name", page=2, size=50, extra={"order": "id"})
    assert q == "{ animes(page: 2, limit: 50, order: id) { id name } }" and pc.query_text("animes", "id", ids=["1", "2"]) == '{ animes(ids: "1,2") { id } }'
    assert pc.query_digest("a", "b") != pc.query_digest("ab") and pc.query_digest("a") != pc.query_digest("a", context="x")
    assert pc.selection_without("id topic { id title } name { topic }", {"topic", "gone"}) == "id name { topic }"


def test_cached_pages(spark, rows):
    df = spark.createDataFrame([(1, "x", ["a", "b"]), (2, "old", ["a"]), (3, "z", ["a", "a"]), (4, "w", ["a", None])], "page int, digest string, ids array<string>")
    good, bad = pc.valid_pages(df, {1: "x", 2: "y", 3: "z", 4: "w"})
    assert [r["page"] for r in good.collect()] == [1] and rows(bad) == {(2, "other_query"), (3, "repeated_id"), (4, "record_without_id")}
    r = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1)], "id string, page int")
    assert rows(pc.repeated_across_pages(r)) == {("a", (1, 2))}
    m = spark.createDataFrame([(["Cannot return null for non-nullable field Topic.body"],), (["Cannot return null for non-nullable field Topic.body", "timeout"],), ([],)], "m array<string>")
    assert [x[0] and [tuple(y) for y in x[0]] for x in m.select(pc.broken_contracts("m")).collect()] == [[("Topic", "body")], None, None]


def test_command_line(spark, tmp_path, capsys):
    from driftmill.__main__ import main
    from driftmill.plans import publish

    d = tmp_path / "in"
    d.mkdir()
    (d / "5.html").write_text("<h1>Страница не найдена</h1>")
    out = str(tmp_path / "out")
    assert main(["pages", str(d), out]) == 0 and json.loads(capsys.readouterr().out)["rows"] == 1
    assert main(["verify", out]) == 0 and main(["pages", str(d), out, "--dry-run"]) == 0
    assert len(publish.read(spark, out).columns) == 155
