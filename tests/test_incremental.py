import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from driftmill.functions.times import zoned_micros
from driftmill.operators import incremental as inc


@pytest.mark.parametrize(
    ("text", "iso"),
    [("2024-05-04T22:21:04+03:00", "2024-05-04T19:21:04+00:00"), ("2024-05-04T22:21:04+0300", "2024-05-04T19:21:04+00:00"), ("2024-05-04T22:21:04Z", "2024-05-04T22:21:04+00:00"), ("2024-01-22T05:59:06-05:30", "2024-01-22T11:29:06+00:00"),
     ("2024-03-31T09:34:14.250+03:00", "2024-03-31T06:34:14.250+00:00"), (" 2024-03-31 09:34:14 UTC ", "2024-03-31T09:34:14+00:00"), ("2024-05-04T22:21:04", None), ("0000-00-00T00:00:00", None), ("2024-02-30T00:00:00Z", None), ("2024-01-01T25:00:00Z", None), ("вчера", None), ("", None), (None, None)],
)
def test_times(spark, text, iso):
    got = spark.createDataFrame([(text,)], "t string").select(zoned_micros(F.col("t"))).first()[0]
    assert got == (None if iso is None else round(datetime.fromisoformat(iso).timestamp() * 1e6))


def state(spark, d):
    return spark.createDataFrame(list(d.items()), "key bigint, version bigint")


def test_changed_records_against_brute_force(spark, rows):
    rng = random.Random(4)
    old = {rng.choice([rng.randrange(2000), rng.randrange(-(2**62), 2**62)]): rng.randrange(100) for _ in range(400)}
    new = {k: v + rng.choice([0, 0, 0, 1, -1]) for k, v in old.items() if rng.random() < 0.9} | {rng.randrange(3000): 5 for _ in range(40)}
    assert rows(inc.changed_records(state(spark, new), state(spark, old))) == {(k, v) for k, v in new.items() if k not in old or v > old[k]}


def test_equal_states_differ_nowhere(spark):
    s = state(spark, {i: i for i in range(500)})
    tree = inc.merkle_tree(inc.merkle_leaves(s))
    assert inc.differing_leaves(tree, inc.merkle_tree(inc.merkle_leaves(s.repartition(7)))).count() == 0
    assert tree.where(F.col("level") == inc.LEVELS - 1).count() == 1


def test_empty_states(spark, rows):
    none, some = state(spark, {}), state(spark, {1: 2})
    assert inc.changed_records(none, some).count() == 0
    assert rows(inc.changed_records(some, none)) == {(1, 2)}


def test_states_of_tables(spark, rows):
    animes = spark.createDataFrame([(1, "2024-01-01T00:00:00Z", "a"), (1, "2024-01-02T00:00:00Z", "b"), (2, "2024-01-01T03:00:00+03:00", None), (3, "2024-01-01T00:00:00", None), (4, None, None), (None, "2024-01-01T00:00:00Z", None)], "id bigint, updatedat string, version string")
    ledger = spark.createDataFrame([(1, 1, "2024-01-01T00:00:00Z"), (2, 1, "2024-01-02T00:00:00Z"), (1, 2, "2024-01-01T00:00:00Z"), (3, 2, "2025-01-01T00:00:00Z")], "run_no bigint, id bigint, updatedat string")
    runs = spark.createDataFrame([(1, "done"), (2, "failed"), (3, None)], "run_no bigint, outcome string")
    got = inc.changed_records(*inc.entity_states(animes, ledger, runs))
    assert rows(got) == {(1, 1704153600 * 1_000_000)}


def test_publication_survives_a_run_that_dies(spark, tmp_path, rows, monkeypatch):
    p = inc.Published(spark, str(tmp_path / "state"))
    first = state(spark, {1: 1, 2: 1})
    assert rows(p.publish(first)) == {(1, 1), (2, 1)}
    second = state(spark, {1: 1, 2: 2, 3: 1})
    monkeypatch.setattr(inc.Published, "_point", lambda self, name: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        p.publish(second)
    monkeypatch.undo()
    assert rows(p.publish(second)) == {(2, 2), (3, 1)}  # nothing skipped
    assert p.publish(second).count() == 0  # nothing repeated
    extra = spark.createDataFrame([(2, "x"), (3, "y"), (9, "z")], "key bigint, body string")
    assert rows(p.publish(state(spark, {1: 1, 2: 3, 3: 1}), extra)) == {(2, "x")}


def scanned(df):
    """Rows that the Parquet scans of a frame gave, by Spark's own metrics."""
    df.collect()
    plan, total, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getName() else plan)
    while todo:
        x = todo.pop()
        if "QueryStage" in x.getClass().getName():
            todo.append(x.plan())
        if "FileSourceScan" in x.getClass().getName():
            total += x.metrics().apply("numOutputRows").value()
        todo += [x.children().apply(i) for i in range(x.children().size())]
    return total


def test_leaves_that_agree_are_neither_read_nor_written(spark, tmp_path, rows):
    p = inc.Published(spark, str(tmp_path / "state"))
    first = spark.range(1_000_000).select(F.col("id").alias("key"), F.lit(1).cast("bigint").alias("version"))
    p.publish(first)
    second = first.select("key", F.when(F.col("key").isin(70_000, 70_001), 2).otherwise(1).cast("bigint").alias("version"))
    assert rows(p.publish(second)) == {(70_000, 2), (70_001, 2)}
    now = p.current()
    assert p._parquet(f"{now['run']}/state").count() == 2**inc.LEAF_BITS and len(now["runs"]) == 2
    tree = p.read("tree")
    leaves = inc.Leaves(tree.where(f"level = 0 AND node = {70_000 >> inc.LEAF_BITS}").select("node", "run"))
    assert 0 < scanned(p._records(now, None, leaves)) < 100_000
    assert scanned(tree.where(F.col("level") == 0).where(inc.within("node", [0], 0))) < tree.count() + 1
    assert p.read("state").count() == 1_000_000 and p.read("state").where("version = 2").count() == 2


def test_keys_that_went_missing_stay_saved_and_runs_are_written_together(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(inc, "MAX_RUNS", 2)
    p = inc.Published(spark, str(tmp_path / "state"))
    held = {}
    for i in range(5):
        batch = {7: i, 100 + i: 0, 5000 * i: 1}
        want = {(k, v) for k, v in batch.items() if k not in held or v > held[k]}
        assert rows(p.publish(state(spark, batch))) == want
        held |= {k: max(v, held.get(k, v)) for k, v in batch.items()}
        assert rows(p.read("state")) == set(held.items()) and len(p.current()["runs"]) <= 2
    assert rows(p.publish(state(spark, {100: 0, 101: 0}))) == set()
    assert len([c for c in p._children() if c.startswith("run-")]) <= 4


def test_of_two_publishers_the_second_fails(spark, tmp_path, rows):
    a, b = (inc.Published(spark, str(tmp_path / "state")) for _ in range(2))
    a.publish(state(spark, {1: 1}))
    seen = a.current()
    b.publish(state(spark, {1: 2}))
    a.current = lambda: seen
    with pytest.raises(Exception, match="exist"):
        a.publish(state(spark, {1: 3}))
    assert rows(b.read("state")) == {(1, 2)} and rows(b.publish(state(spark, {1: 3}))) == {(1, 3)}


@pytest.mark.parametrize("walk", [0, inc.WALK])
def test_walk_and_joins_give_the_same_leaves(spark, rows, walk):
    rng = random.Random(9)
    old = {rng.randrange(-(2**62), 2**62): 1 for _ in range(300)}
    new = {k: v + (rng.random() < 0.1) for k, v in old.items()} | {5: 1}
    trees = [inc.merkle_tree(inc.merkle_leaves(state(spark, s))) for s in (new, old)]
    assert rows(inc.differing_leaves(*trees, walk=walk)) == {(k >> inc.LEAF_BITS,) for k, v in new.items() if old.get(k) != v}


def test_ranges_hold_every_node():
    rng = random.Random(2)
    for n in (0, 1, 5, 500):
        nodes = [rng.randrange(-(2**40), 2**40) for _ in range(n)] + list(range(n))
        assert sum(len(x) for x in [inc.spans(nodes)]) <= inc.RANGES
        assert all(any(lo <= x <= hi for lo, hi in inc.spans(nodes)) for x in nodes)
