import datetime as dt
import json
import random

import pytest

from silsila.operators.flatten import PERSON_LISTS, flatten_lists, pivot_fields, record_rows, tree_of
from silsila.operators.hierarchy import hierarchy, lineage_edges

LISTS = tree_of(PERSON_LISTS)


def rows_of(record):
    return record_rows(record if isinstance(record, str) or record is None else json.dumps(record), LISTS)


def places(record):
    return sorted((r.path, r.at[-1]) for r in rows_of(record) if r.path in PERSON_LISTS and r.is_object)


def test_forms_of_a_list():
    assert places({"labels": [{"key": "a"}, None, {"key": "b"}, 3]}) == [("labels", 0), ("labels", 2)]
    assert places({"labels": {"key": "a"}}) == [("labels", 0)]
    assert places({"labels": {"1": {"k": 1}, "0": None}}) == [("labels", 1)]
    assert places({"labels": json.dumps([{"key": "a"}])}) == [("labels", 0)]
    assert places({"life": json.dumps({"traits": json.dumps([None, {"v": 1}]), "birth": {"notes": [{}]}})}) == [("life.birth.notes", 0), ("life.traits", 1)]
    assert places(json.dumps(json.dumps({"labels": [{"key": "a"}]}))) == [("labels", 0)]
    assert places({"labels": []}) == places({"labels": "[broken"}) == places({"life": 3}) == places([]) == []


def test_what_is_not_json():
    for bad in (None, "", "{", '{"labels":[{"a":NaN}]}', "{'labels': []}", '{"labels":[{"a":1}],}', '{"a":"\\u12"}', "﻿{}"):
        assert places(bad) == []
        assert rows_of(bad) == []
    assert rows_of('{"a":' + "9" * 5000 + "}")[0].fields == [("a", "9" * 5000)]
    assert places({"labels": {"0": 1, "x": 2}}) == [("labels", 0)]


def test_depth_is_not_bounded():
    assert places('{"labels":' + "[" * 100_000 + "]" * 100_000 + "}") == []
    assert places('{"labels":[' + '{"a":' * 20_000 + "1" + "}" * 20_000 + "]}") == [("labels", 0)]
    rows = rows_of('{"labels":[' + '{"a":[' * 2_000 + "1" + "]}" * 2_000 + "]}")
    assert len(rows) == 2_002 and rows[-1].at == (0,) * 2_001 and not rows[-1].is_object


def test_rows_at_every_depth_keep_their_parents_place():
    rows = rows_of({"x": 1, "life": {"y": None, "events": [{"seen": [{"by": "z", "in": [1, None, 2]}, "w"]}, {"a": {"b": True}}]}, "m": [[{"c": 1.50}]]})
    got = [(r.path, r.at, r.is_object, r.fields) for r in rows]
    assert got == [
        ("", (), True, [("x", "1"), ("life.y", None)]), ("life.events", (0,), True, []), ("life.events.seen", (0, 0), True, [("by", "z")]),
        ("life.events.seen.in", (0, 0, 0), False, [("", "1")]), ("life.events.seen.in", (0, 0, 2), False, [("", "2")]), ("life.events.seen", (0, 1), False, [("", "w")]),
        ("life.events", (1,), True, [("a.b", "true")]), ("m[]", (0, 0), True, [("c", "1.5")]),
    ]


def test_of_equal_keys_the_last_counts():
    assert [(r.path, r.at, r.fields) for r in rows_of('{"labels":[{"a":1},{"a":2}],"b":{"c":1},"labels":[{"a":3,"a":4}],"b":5}')] == [("", (), [("b", "5")]), ("labels", (0,), [("a", "4")])]
    assert places('{"labels":{"0":{"a":1},"0":7,"1":{}}}') == [("labels", 1)]


@pytest.mark.parametrize("seed", range(40))
def test_events_against_a_parser(seed):
    draw = random.Random(seed)

    def value(depth=0):
        kind = draw.randrange(8 if depth < 5 else 5)
        if kind > 5:
            return [value(depth + 1) for _ in range(draw.randrange(4))]
        if kind == 5:
            return {draw.choice(["a", "b", 'q"', "labels", "é\u0001", "", "x.y"]) + str(i): value(depth + 1) for i in range(draw.randrange(4))}
        return draw.choice([None, True, False, 0, -1.5, 1e300, "", "t", 'q"\\ü', "\n", "[", "{}"])

    from silsila.operators.flatten import ARRAY, END, OBJECT, TEXT, events

    def built(text):
        root = []
        stack = [root]
        for kind, key, v in events(text):
            if kind == END:
                stack.pop()
                continue
            new = {} if kind == OBJECT else [] if kind == ARRAY else v if kind == TEXT or v is None else json.loads(v)
            if isinstance(stack[-1], dict):
                stack[-1][key] = new
            else:
                stack[-1].append(new)
            if kind in (OBJECT, ARRAY):
                stack.append(new)
        return root[0]

    held = {"v": value()}
    text = json.dumps(held, ensure_ascii=bool(seed % 2), indent=seed % 3 or None)
    assert built(text) == held
    # a damaged text is refused by both, or by neither
    at = draw.randrange(len(text))
    damaged = text[:at] + draw.choice(["", ",", "}", '"', "1", "x"]) + text[at + 1 :]
    try:
        want = json.loads(damaged)
    except ValueError:
        with pytest.raises(ValueError):
            built(damaged)
    else:
        assert built(damaged) == want


def test_current_record_and_clashing_columns(spark):
    t = [dt.datetime(2026, 1, d) for d in (1, 2)]
    rows = [
        ("a", json.dumps({"labels": [{"key": "old"}] * 3}), t[0], 1, "x"), ("a", json.dumps({"labels": [{"key": "new", "source": "s"}]}), t[1], 2, "y"),
        ("b", json.dumps({"labels": [{"key": "k"}]}), t[0], 3, None), ("b", "{broken", t[1], 4, None), (None, json.dumps({"labels": [{}]}), t[0], 5, None),
    ]
    df = spark.createDataFrame(rows, "person_id string, person_json string, ingested_at timestamp, pos int, fields string")
    got = pivot_fields(flatten_lists(df, "person_json", PERSON_LISTS), ["key", "source"]).collect()
    assert [tuple(r) for r in got] == [("a", "labels", 0, "new", "s")]
    assert flatten_lists(df.limit(0), "person_json", PERSON_LISTS).count() == 0


def test_halves_of_surrogate_pairs(spark):
    df = spark.createDataFrame([("a", '{"labels":[{"key":"x\\ud83d","z":"\\ud83d\\ude00"}]}', dt.datetime(2026, 1, 1))], "person_id string, person_json string, ingested_at timestamp")
    (row,) = pivot_fields(flatten_lists(df, "person_json", PERSON_LISTS), ["key", "z"]).collect()
    assert row.key.startswith("x\ufffd") and row.z == "\U0001f600"


def test_each_list_has_a_table_with_all_its_fields(spark, tmp_path):
    from silsila.plans.registry import QUERIES

    record = {"life": {
        "events": [{"value": "v", "year_hijri": 57, "place": "p", "seen": [{"by": "x"}, "y"]}], "offices": [None, {"role": "r", "place": "q"}], "ages": {"years": 60},
    }}
    rows = [("a", json.dumps(record), dt.datetime(2026, 1, 1))]
    spark.createDataFrame(rows, "person_id string, person_json string, ingested_at timestamp").write.parquet(f"{tmp_path}/persons.parquet")
    facts = {r.coll_path: r for r in QUERIES["p4_facts"](spark, str(tmp_path)).collect()}
    assert (facts["life.events"].year_hijri, facts["life.events"].place, facts["life.offices"].role, facts["life.ages"].years) == ("57", "p", "r", "60")
    events = QUERIES["p4_life_events"](spark, str(tmp_path)).collect()
    assert [(r.person_id, r.coll_path, r.pos, r.value, r.year_hijri, r.place) for r in events] == [("a", "life.events", 0, "v", "57", "p")]
    assert events[0].other == []
    assert [(r.pos, r.role, r.place) for r in QUERIES["p4_life_offices"](spark, str(tmp_path)).collect()] == [(1, "r", "q")]
    inner = sorted((r.person_id, r.coll_path, r.parent_pos, r.pos, [tuple(f) for f in r.fields]) for r in QUERIES["p4_inner"](spark, str(tmp_path)).collect())
    assert inner == [("a", "life.events.seen", [0], 0, [("by", "x")]), ("a", "life.events.seen", [0], 1, [("", "y")])]
    tables = sorted(tuple(r) for r in QUERIES["p4_tables"](spark, str(tmp_path)).collect())
    assert tables == [("", 0, 1, 1), ("life.ages", 1, 1, 1), ("life.events", 1, 1, 1), ("life.events.seen", 2, 2, 1), ("life.offices", 1, 1, 1)]
    assert [r.person_id for r in QUERIES["p4_record"](spark, str(tmp_path)).collect()] == ["a"]
    assert all(f"p4_{p.replace('.', '_')}" in QUERIES for p in PERSON_LISTS)


def brute(edges):
    parent = dict(edges)
    out = {}
    for n in parent:
        path, at, seen = [n], n, {n}
        while parent.get(at) in parent and parent[at] is not None:
            at = parent[at]
            if at in seen:
                path = None
                break
            seen.add(at)
            path.append(at)
        out[n] = path
    return out


def test_hierarchy_against_brute_force(spark):
    rng = random.Random(4)
    nodes = [f"n{i:03d}" for i in range(160)]
    edges = [(n, rng.choice(nodes[: i + 1]) if rng.random() < 0.85 and i else None) for i, n in enumerate(nodes)]
    edges[5] = (nodes[5], nodes[9])
    edges[9] = (nodes[9], nodes[5])
    edges += [("lost", "nowhere"), ("self", "self"), *[(f"c{i}", f"c{i + 1}" if i < 60 else None) for i in range(61)]]
    df = spark.createDataFrame([*edges, edges[20], (None, "n001")], "a string, b string")
    want = brute(edges)
    kids = {n: sum(1 for m, p in want.items() if p and m != n and n in p) for n in want}
    got = {r.node: r for r in hierarchy(df, "a", "b", paths=True).collect()}
    assert set(got) == set(want)
    for n, path in want.items():
        r = got[n]
        assert r.is_cycle == (path is None)
        if path:
            assert (r.root, r.depth, r.path, r.descendants) == (path[-1], len(path) - 1, path, kids[n])
    ranges = {n: (r.root, r.entered, r.left) for n, r in got.items() if not r.is_cycle}
    for n in list(ranges)[:40]:
        inside = {m for m, (root, e, _) in ranges.items() if root == ranges[n][0] and ranges[n][1] < e < ranges[n][2]}
        assert inside == {m for m, p in want.items() if p and m != n and n in p}


def test_hierarchy_of_nothing(spark):
    assert hierarchy(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0
    assert [tuple(r) for r in hierarchy(spark.createDataFrame([("a", None)], "a string, b string"), "a", "b").select("root", "depth", "descendants").collect()] == [("a", 0, 0)]


def test_lineage_rules(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [
        ("a:1:1-1", " A:1:2-1 ", None, t), ("a:1:2-1", None, ["خالد", "زَيد"], t), ("a:1:3-1", None, ["زيد"], t), ("a:1:4-1", "missing", ["س", "زيد"], t), ("a:1:5-1", "", ["خالد", "زيد"], t),
        ("a:1:6-1", None, None, t), ("a:1:7-1", None, [], t),
    ]
    got = {r.person_id: r.father for r in lineage_edges(spark.createDataFrame(rows, "person_id string, father_id string, chain array<string>, ingested_at timestamp")).collect()}
    assert got == {"a:1:1-1": "a:1:2-1", "a:1:2-1": "a:1:3-1", "a:1:3-1": None, "a:1:4-1": None, "a:1:5-1": None, "a:1:6-1": None, "a:1:7-1": None}
