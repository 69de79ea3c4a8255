import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from driftmill.operators import convert
from driftmill.plans import publish as pub
from driftmill.sources import files


def test_typed_rows(spark):
    rows = ['{"id":"100","score":8.5,"flag":true,"name":"x","tags":[1]}', '{"id":true,"score":"y","flag":1,"name":null,"tags":{}}', '{"id":1,"extra":2}', "[1]", "{", None, '{"id":1,"score":2,"flag":false,"name":5,"tags":null}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "n int, j string")
    kinds = {"id": "whole", "score": "double", "flag": "boolean", "name": "text", "tags": "json"}
    loose = {r["n"]: r for r in convert.typed(df, "j", kinds, strict=False, keep=("n",)).collect()}
    assert loose[0]["problems"] == [] and (loose[0]["id"], loose[0]["score"], loose[0]["flag"], loose[0]["tags"]) == (100, 8.5, True, "[1]")
    assert sorted(loose[1]["problems"]) == ["kind:flag", "kind:id", "kind:score"] and sorted(loose[2]["problems"]) == ["extra:extra", "missing:flag", "missing:name", "missing:score", "missing:tags"]
    assert [loose[i]["problems"] for i in (3, 4, 5)] == [["unreadable"]] * 3 and loose[6]["problems"] == [] and loose[6]["name"] == "5"
    strict = {r["n"]: r["problems"] for r in convert.typed(df, "j", kinds, optional=("tags",), keep=("n",)).collect()}
    assert strict[0] == ["kind:id"] and sorted(strict[6]) == ["kind:name"] and "null:name" in strict[1]


def test_review_folders(spark, tmp_path, rows):
    for p in ("z5-a/1.json", "z5-a/4.json", "7-b/1.json", "7-b/x.txt", "nope/1.json", "5-c/1.json"):
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text("{}")
    (tmp_path / "9-empty").mkdir()
    (tmp_path / "loose.txt").write_text("")
    good, bad = files.review_folders(spark, str(tmp_path))
    assert rows(good) == {(5, "z5-a", (1, 4), (2, 3), 4), (7, "7-b", (1,), (), 2), (5, "5-c", (1,), (), 2), (9, "9-empty", (), (), 0)}
    assert rows(bad) == {("nope", "bad_folder"), ("loose.txt", "bad_folder"), ("7-b/x.txt", "bad_page"), ("nope/1.json", "bad_page"), ("z5-a", "repeated_id"), ("5-c", "repeated_id")} - {("nope/1.json", "bad_page")}


def test_inventories(spark, tmp_path, rows):
    (tmp_path / "m.tsv").write_text("filename\turl\tsources\tmore\na.html\thttps://h/news/1\tx,,y\tq\n")
    m = files.manifest(spark, str(tmp_path / "m.tsv"))
    assert m.first()["sources"] == ["x", "y"]
    with pytest.raises(ValueError, match="lacks"):
        files.manifest(spark, str(tmp_path / "m.tsv"), ("other",))
    have = spark.createDataFrame([("d/a.html",)], "source_file string")
    assert files.inventory(have, m).count() == 1
    with pytest.raises(ValueError, match="b.html"):
        files.inventory(spark.createDataFrame([("d/a.html",), ("d/b.html",)], "source_file string"), m)
    assert m.select(files.page_kind("url", {"/news/": "news"}).alias("k")).first()["k"] == "news"
    with pytest.raises(Exception, match="no kind for"):
        m.select(files.page_kind("url", {"/film/": "film"}).alias("k")).collect()
    assert files.excluded(m, spark.createDataFrame([("https://h/news/1", "why")], "url string, reason string"), "url").count() == 0


def test_exports(spark, tmp_path, rows):
    df = spark.createDataFrame([(2, 'b\t"c"\nd', None), (1, None, 5)], "id int, t string, n int")
    pub.export_tsv(df.coalesce(1), str(tmp_path / "t"), ["id"])
    text = "".join(p.read_text() for p in sorted(Path(tmp_path / "t").glob("part-*")))
    assert [x for x in text.splitlines() if x != "id\tt\tn"] == ["1\t\t5", '2\tb "c" d\t']
    for keep in (True, False):
        pub.export_json_lines(df, str(tmp_path / f"j{keep}"), ["id"], keep_nulls=keep)
        lines = [json.loads(x) for p in Path(tmp_path / f"j{keep}").glob("part-*.gz") for x in gzip.open(p, "rt")]
        assert [x["id"] for x in lines] == [1, 2] and ("t" in lines[0]) is keep and list(lines[1])[0] == "id"
    assert pub.pending(df, str(tmp_path / "none"), "id").count() == 2
    df.where("id = 1").write.parquet(str(tmp_path / "done"))
    assert rows(pub.pending(df, str(tmp_path / "done"), "id").select("id")) == {(2,)}


def test_manifest_contract():
    m = {"complete": True, "entity": "news", "rows": 5, "ok": 3, "bad": 1, "digest": "x", "flag": True}
    assert pub.manifest_problems(m, {"complete": True, "rows": int, "digest": str}, {"rows": ("ok", "bad")}) == ["rows isn't the sum of ok, bad"]
    assert len(pub.manifest_problems(m, {"entity": "anime", "flag": int, "gone": str})) == 3


def test_first_pages_only(spark, tmp_path):
    for n in "cab":
        (tmp_path / f"{n}.html").write_text(n)
    assert [r["source_file"] for r in files.pages(spark, str(tmp_path), limit=2).orderBy("source_file").collect()] == ["a.html", "b.html"]
    assert files.pages(spark, str(tmp_path)).where(F.col("sha256").isNull()).count() == 0


def test_strict_sources(spark, tmp_path, rows):
    (tmp_path / "u.txt").write_text("https://h/a\n\nnope\nhttps://h/a\n")
    with pytest.raises(ValueError, match="line 3: nope"):
        files.strict_urls(spark, str(tmp_path / "u.txt"))
    (tmp_path / "p.txt").write_text("# x\r\n1.2.3.4:80\r\nsocks5://h:1\n1.2.3.4:80\n")
    assert rows(files.proxies(spark, str(tmp_path / "p.txt"))) == {("http://1.2.3.4:80", 2), ("socks5://h:1", 3)}
    (tmp_path / "none.txt").write_text("#\n")
    with pytest.raises(ValueError, match="no proxy"):
        files.proxies(spark, str(tmp_path / "none.txt"))
    for name, body, ok in (("a", '{"id":1,"p":1}\n{"id":1,"p":2}\n{"id":3,"p":1}\n', True), ("b", '{"id":1,"p":1}\n{"id":1,"p":1}\n', False), ("c", '{"id":1,"p":1}\n[2]\n', False), ("d", '{"id":2,"p":1}\n{"p":1}\n', False)):
        with gzip.open(tmp_path / f"{name}.jsonl.gz", "wt") as f:
            f.write(body)
        read = lambda n=name: files.ordered_json_lines(spark, str(tmp_path / f"{n}.jsonl.gz"), spark.createDataFrame([], "id int, p int").schema, ["id", "p"])
        if ok:
            assert rows(read()) == {(1, 1), (1, 2), (3, 1)}
        else:
            with pytest.raises(ValueError, match=r"lines \[2\]"):
                read()
    for name, body in (("o", '{"a": 1}'), ("l", "[1]")):
        with gzip.open(tmp_path / f"{name}.json.gz", "wt") as f:
            f.write(body)
    assert rows(files.json_object(spark, str(tmp_path / "o.json.gz"), "a int")) == {(1,)}
    with pytest.raises(Exception, match="is no object"):
        files.json_object(spark, str(tmp_path / "l.json.gz"), "a int").collect()


def test_lines_of_many_splits(spark, tmp_path):
    (tmp_path / "big.txt").write_text("".join(f"v{i}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = files.lines(spark, str(tmp_path / "big.txt"))
        assert got.where(F.col("value") != F.concat(F.lit("v"), (F.col("line_no") - 1).cast("string"))).count() == 0 and got.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_downloads(spark, rows):
    r = spark.createDataFrame([("b", "u2", True), ("a", "u1", False), ("a", "u1", True), ("c", "u3", False), ("d", "u4", None)], "filename string, url string, ok boolean")
    good, failed = files.download_manifest(r)
    assert [tuple(x) for x in good.collect()] == [("a", "u1"), ("b", "u2")] and [x[0] for x in failed.collect()] == ["u3", "u4"]
    assert [x["url"] for x in files.work_order(r, ["url"]).collect()] == [x["url"] for x in files.work_order(r.repartition(3), ["url"]).collect()]
    assert rows(files.tree_count(r, ["url"], "ok")) == {("u1", 2, 1, 1), ("u2", 1, 1, 0), ("u3", 1, 0, 1), ("u4", 1, 0, 1)}


def test_names_with_odd_letters(spark, tmp_path, rows):
    for n in ("a b+c%20.html", "имя.html"):
        (tmp_path / n).write_text("x")
    assert rows(files.listing(spark, str(tmp_path)).select("path", "length")) == {("a b+c%20.html", 1), ("имя.html", 1)} == rows(files.pages(spark, str(tmp_path)).select("source_file", "length"))


def test_publication_of_versions(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", F.lit("x").alias("v"))
    assert pub.manifest(spark, path) is None and pub.verify(spark, path) == ["no manifest"]
    with pytest.raises(FileNotFoundError):
        pub.read(spark, path)
    # a run dies before its version is current
    real = pub.Versions.take
    monkeypatch.setattr(pub.Versions, "take", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        pub.publish(df, path, ["id"])
    assert pub.manifest(spark, path) is None
    monkeypatch.setattr(pub.Versions, "take", real)
    first = pub.publish(df, path, ["id"])
    assert first["rows"] == 100 and pub.read(spark, path).count() == 100
    # two at once: the second finds the number taken, and the first one's version stays
    before = pub.Versions(pub.Store(spark, path), path).current()
    pub.publish(df.where("id < 50"), path, ["id"], force=True)
    monkeypatch.setattr(pub.Versions, "current", lambda self: before)
    with pytest.raises(Exception, match="exist"):
        pub.publish(df.where("id < 10"), path, ["id"], force=True)
    monkeypatch.undo()
    assert pub.read(spark, path).count() == 50 and pub.verify(spark, path) == []
    # the rows are computed once
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    pub.publish(df.coalesce(1).mapInPandas(count, "id bigint, v string"), path, ["id"], force=True)
    assert seen.value <= 200  # written once; ranges of keys are sampled once more


def test_stage_is_resumed_only_for_the_same_source(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(60).select("id")
    folder, kept = pub.stage(df, path, ["id"], "s1", 4)
    assert kept == 0
    store = pub.Store(spark, path)
    store.delete(f"{folder}/part=2/_SUCCESS")
    assert pub.stage(df, path, ["id"], "s1", 4)[1] == 3 and pub.stage(df, path, ["id"], "s1", 4)[1] == 4
    assert pub.stage(df, path, ["id"], "s2", 4)[1] == 0 and pub.stage(df, path, ["id"], None, 4)[1] == 0
    told = pub.publish(df, path, ["id"], source="s3", parts=2, attributes={"note": "n"})
    assert told["resumed_parts"] == 0 and told["note"] == "n" and pub.read(spark, path).count() == 60


def test_batches_of_another_checkpoint(spark, tmp_path, rows):
    from driftmill.streaming.ingest import ingest, keep_latest

    a, b = (spark.createDataFrame(x, "id int, v int") for x in ([(1, 1)], [(2, 5), (1, 3)]))
    a.write.parquet(f"{tmp_path}/in1")
    b.write.parquet(f"{tmp_path}/in2")
    for n in (1, 2):
        assert ingest(spark, f"{tmp_path}/in{n}", a.schema, f"{tmp_path}/out", f"{tmp_path}/cp{n}") == [0]
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("id", "v")) == {(1, 1), (2, 5), (1, 3)}
    assert rows(keep_latest(spark, f"{tmp_path}/in1", a.schema, f"{tmp_path}/kept", f"{tmp_path}/cp3", "id", "v")) == {(1, 1, 1)}
    b.write.mode("append").parquet(f"{tmp_path}/in1")
    for _ in range(2):
        assert rows(keep_latest(spark, f"{tmp_path}/in1", a.schema, f"{tmp_path}/kept", f"{tmp_path}/cp3", "id", "v")) == {(1, 3, 2), (2, 5, 1)}


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_greedy_batches_are_those_of_one_pass(spark, parts):
    rng = __import__("random").Random(parts)
    data = [(i, rng.choice([1, 2, 3, 30, 7])) for i in range(200)]
    want, batch, n, used = {}, 0, 0, 0
    for i, b in data:
        if n and (n >= 6 or used + b > 25):
            batch, n, used = batch + 1, 0, 0
        n, used = n + 1, used + b
        want[i] = batch
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(data, "id int, s int").repartition(3)
        assert {r["id"]: r["batch"] for r in pub.greedy_batches(df, ["id"], "s", 6, 25).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_exports_are_the_same_bytes(spark, tmp_path):
    df = spark.range(50).select("id", F.lit("т").alias("t"))
    for n, k in ((1, 3), (2, 9)):
        pub.export_json_lines(df.repartition(k), str(tmp_path / str(n)), ["id"], keep_nulls=True)
    a, b = (b"".join(p.read_bytes() for p in sorted((tmp_path / n).glob("part-*"))) for n in "12")
    assert a == b


def test_command_line(spark, tmp_path, capsys):
    from driftmill.__main__ import main

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<p>a")
    (tmp_path / "m.tsv").write_text("filename\turl\tsources\na.html\thttps://h/1\tx\n")
    assert main(["raw", str(tmp_path / "in"), str(tmp_path / "out"), "--manifest", str(tmp_path / "m.tsv"), "--parts", "2", "--source-id", "s"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["rows"] == 1
    assert main(["verify", str(tmp_path / "out")]) == 0 and main(["verify", str(tmp_path / "none")]) == 1
    (tmp_path / "news").mkdir()
    (tmp_path / "news" / "1.html").write_text("<p>")
    with pytest.raises(SystemExit, match="aren't all there"):
        main(["news", str(tmp_path / "news"), str(tmp_path / "n"), "--last-id", "2"])
    with pytest.raises(SystemExit):
        main(["lines", "x", "y"])


def test_tsv_of_a_writer_that_died(spark, tmp_path, rows):
    t = tmp_path / "t.tsv"
    t.write_text("a\tb\n1\t\n2\tx\n3\ty")
    assert rows(files.partial_tsv(spark, str(t), ["a", "b"])) == {(2, "1", None), (3, "2", "x")}
    t.write_text("a\tb\n1\t\n2\tx\n")
    assert files.partial_tsv(spark, str(t), ["a", "b"]).count() == 2
    for bad in ("", "a\tb", "a\tc\n"):
        t.write_text(bad)
        with pytest.raises(ValueError, match="header"):
            files.partial_tsv(spark, str(t), ["a", "b"])
    t.write_text("a\tb\n1\n2\tx\n")
    with pytest.raises(Exception, match="cells in line 2"):
        files.partial_tsv(spark, str(t), ["a", "b"]).collect()


def test_rules_of_acquisition(spark, rows):
    from driftmill.operators import contracts

    df = spark.createDataFrame([(1, 429, "7", 3, ""), (2, 503, None, 3, ""), (3, 404, None, 1, "gone"), (4, None, None, 1, "Connection reset by peer"), (5, None, None, 1, None), (6, 200, None, 1, "Cannot return null for non-nullable field X"), (7, 500, "soon", 12, ""), (8, None, None, 1, "odd")], "i int, s int, after string, n int, m string")
    got = {r["i"]: (r["c"], r["w"]) for r in df.select("i", contracts.error_class(F.col("s"), F.col("m")).alias("c"), contracts.retry_delay(F.col("s"), F.col("after"), F.col("n")).alias("w")).collect()}
    assert got == {1: ("retry", 7.0), 2: ("retry", 8.0), 3: ("fatal", None), 4: ("retry", None), 5: ("none", None), 6: ("recover", None), 7: ("retry", 300.0), 8: ("fatal", None)}
    log = spark.createDataFrame([(i, t) for i, t in enumerate([0, 10, 10, 40, 70, 200, 205])] + [(99, None)], "k int, t bigint")
    assert rows(contracts.rate_breaks(log, "t", "k", 6, 3, 65).select("k", "spacing", "span")) == {(2, 0, None), (3, 30, 40), (4, 30, 60), (6, 5, 165)}
