import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftmill.operators import nested
from driftmill.operators.nested import ENTITY_LAYOUTS, NEWS_LAYOUT, Layout, Shredder, Unreadable, entity_links, flat_table, nested_rows, scan, triples

JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=5), x, max_size=4), max_leaves=20)


def leaves(value, path=(), at=()):
    """Brute force over the whole tree."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from leaves(v, (*path, k), at)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from leaves(v, (*path, "[]"), (*at, i))
    else:
        yield path, at, value


@settings(max_examples=300, deadline=None)
@given(JSON)
def test_scan_agrees_with_the_whole_tree(value):
    text = json.dumps(value, ensure_ascii=random.random() < 0.5)
    if isinstance(value, str):
        return
    got = list(scan(text))
    want = list(leaves(value))
    assert [(p, a) for p, a, _, _ in got] == [(p, a) for p, a, _ in want]
    for (_, _, v, kind), (_, _, w) in zip(got, want, strict=True):
        assert (kind == "null") == (w is None)
        if kind == "string":
            assert v == w
        elif kind == "number":
            assert float(v) == pytest.approx(float(w))


@settings(max_examples=200, deadline=None)
@given(JSON, st.data())
def test_cut_off_text_is_unreadable(value, data):
    text = json.dumps(value)
    if not isinstance(value, (list, dict)):
        return
    cut = data.draw(st.integers(0, len(text) - 1))
    with pytest.raises(Unreadable):
        list(scan(text[:cut]))


def test_very_deep_text_is_read_without_recursion():
    text = "[" * 50_000 + "1" + "]" * 50_000
    assert len(list(scan(text))[0][1]) == 50_000


def test_shapes_of_one_table():
    s = Shredder(ENTITY_LAYOUTS["related"])
    one = {"id": 5, "anime": {"id": "7"}}
    want = [("[]", (0,), ["5"], {"id": "5", "anime.id": "7"})]
    for shape in (one, [one], {"items": [one]}, {"nodes": [one]}, {"related": [one]}):
        assert s.rows(json.dumps(shape)) == want
    assert s.rows(json.dumps(json.dumps([one]))) == want  # JSON within a JSON string
    assert s.rows(None) == s.rows("") == s.rows("null") == s.rows("[]") == s.rows("[{") == s.rows("вздор") == []
    assert [r[1] for r in s.rows(json.dumps([None, one]))] == [(1,)]


def test_object_in_place_of_a_list_deep_inside():
    s = Shredder(NEWS_LAYOUT["nuxt_news"])
    got = {r[0]: r[2] for r in s.rows(json.dumps({"shows": [{"id": 3, "seasons": {"number": 2, "episodes": [{"id": 9}]}}]}))}
    assert got["shows[].seasons[].episodes[]"] == ["3", "2", "9"]


SCHEMA_A = "record_id bigint, related string, characterroles string, personroles string, source string, `table` string"
SCHEMA_N = "source_id bigint, nuxt_news string, keys string"


def test_links(spark, rows):
    a = spark.createDataFrame(
        [(1, '[{"id":"10","anime":{"id":4},"manga":null},null,{"id":11}]', "[]", '{"personRoles":[{"id":"30","person":{"id":"31"}},{"id":32,"person":null}]}', "x", "y"), (2, None, '[{"id":20,"character":{"id":"21"}},{"id":2', None, None, None), (None, '[{"id":1}]', None, None, None, None)], SCHEMA_A
    )
    n = spark.createDataFrame([(7, '{"news":{"category":{"alias":"c"},"tags":[{"alias":"t"},{"alias":"t"}],"shows":[{"id":8,"seasons":[{"number":"1","episodes":[{"id":9}]}]}]}}', "z"), (7, "null", None)], SCHEMA_N)
    assert rows(entity_links(a, n)) == {
        ("anime", 1, "anime", "1", "related", "10"), ("anime", 1, "anime", "1", "related", "11"), ("anime", 1, "related", "10", "related_anime", "4"),
        ("anime", 1, "anime", "1", "person_role", "30"), ("anime", 1, "anime", "1", "person_role", "32"), ("anime", 1, "person_role", "30", "person", "31"),
        ("news", 7, "news", "7", "category", "c"), ("news", 7, "news", "7", "tag", "t"), ("news", 7, "news", "7", "show", "8"), ("news", 7, "show", "8", "season", "8:1"), ("news", 7, "season", "8:1", "episode", "9"),
    }


def test_empty_tables(spark):
    assert entity_links(spark.createDataFrame([], SCHEMA_A), spark.createDataFrame([], SCHEMA_N)).count() == 0


def test_tables_keep_parents(spark, rows):
    df = spark.createDataFrame([("k", '{"a":[{"n":1,"b":[{"m":2},{"m":3}]}]}')], "key string, j string")
    r = nested_rows(df, {"j": Layout(keys={"a[]": "n"})}, "key")
    assert rows(flat_table(r, "j", "a[].b[]", ["key"], {"m": "m"})) == {("k", (0,), 0, ("1",), "2"), ("k", (0,), 1, ("1",), "3")}
    assert rows(triples(df, "j", "key").select("path", "value")) == {(".a[].n", "1"), (".a[].b[].m", "2"), (".a[].b[].m", "3")}
    assert nested.canonical(("a", "[]", "x"), Layout()) == ("a[]", "x", (0,))
