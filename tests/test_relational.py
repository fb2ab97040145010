import datetime as dt

from pyspark.sql import functions as F

from silsila.operators import relational as R
from silsila.operators import reports as A
from silsila.operators.current import current_rows, latest


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_current_rows(spark):
    t = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([("a", 1, t[0]), ("a", 2, t[2]), ("a", 2, t[2]), ("b", 3, None), ("b", 4, t[1]), (None, 5, t[1]), ("c", None, t[0])], "k string, v int, ingested_at timestamp")
    assert rows(current_rows(df, "k", ["v"]).select("k", "v")) == [("a", 2), ("b", 4), ("c", None)]
    assert rows(latest(df, "k", "v")) == [("a", 2), ("b", 4), ("c", None)]
    tie = spark.createDataFrame([("a", 1, t[0]), ("a", 2, t[0])], df.schema)
    assert rows(current_rows(tie, "k")) == rows(current_rows(tie.orderBy(F.desc("v")), "k"))
    assert current_rows(df.limit(0), "k").count() == 0


def test_top_k_is_exact_on_a_hot_key(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    got = R.top_k_per_key(df, ["k"], [F.desc("v")], 7)
    assert [(r.v, r["rank"]) for r in got.orderBy("rank").collect()] == [(4999 - i, i + 1) for i in range(7)]


def test_carry_forward_crosses_buckets(spark):
    df = spark.createDataFrame([("u", i, 7 if i == 3 else None) for i in range(20)] + [("w", 1, None)], "k string, t int, v int")
    got = {(r.k, r.t): r.c for r in R.carry_forward(df, ["k"], ["t"], "v", "c", F.floor(F.col("t") / 4)).collect()}
    assert got[("u", 2)] is None and got[("u", 3)] == 7 and got[("u", 19)] == 7 and got[("w", 1)] is None


def test_asof_takes_the_last_of_equal_times(spark):
    left = spark.createDataFrame([("k", 5, "a"), ("k", 1, "b"), ("z", 9, "c")], "k string, t int, name string")
    right = spark.createDataFrame([("k", 5, 10), ("k", 5, 11), ("k", 2, 9)], "k string, s int, v int")
    got = R.asof_join(left, right, ["k"], "t", "s", ["v"], lambda c: F.floor(c / 3))
    assert rows(got.select("name", "v")) == [("a", 11), ("b", None), ("c", None)]


def test_range_join(spark):
    p = spark.createDataFrame([(i,) for i in range(0, 40, 3)], "x int")
    r = spark.createDataFrame([(0, 10, "a"), (9, 21, "b"), (39, 39, "c")], "lo int, hi int, n string")
    want = sorted((x, n) for x in range(0, 40, 3) for lo, hi, n in ((0, 10, "a"), (9, 21, "b"), (39, 39, "c")) if lo <= x <= hi)
    assert sorted(map(tuple, R.range_join(p, r, "x", "lo", "hi", 7).select("x", "n").collect())) == want


def test_resolve_outcomes(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    keys = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2"), ("b", "3"), (None, "4")], "k string, id string")
    got = {r.name: (r.outcome, r.id, r.candidates) for r in R.resolve(names, keys, "name", "k", "id").collect()}
    assert got == {"a": ("resolved", "1", None), "b": ("ambiguous", None, ["2", "3"]), "c": ("unresolved", None, None)}


def test_filter_or_keep_and_unique_best(spark):
    c = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("b", 3, False), ("b", 4, None)], "k string, v int, ok boolean")
    assert rows(R.filter_or_keep(c, ["k"], F.col("ok")).select("k", "v")) == [("a", 1), ("b", 3), ("b", 4)]
    s = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "x", 2), ("b", "y", 2)], "k string, t string, s int")
    assert rows(R.unique_best(s, ["k"], "s", "t")) == [("a", "x", 2)]


def test_running_until(spark):
    df = spark.createDataFrame([(i, 10) for i in range(10)], "o int, c long")
    got = R.running_until(df, ["o"], "c", 35, F.floor(F.col("o") / 3))
    assert rows(got.select("o", "spent")) == [(0, 10), (1, 20), (2, 30), (3, 40)]


def test_round_robin(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4)], "s string, o int")
    assert [r.o for r in R.round_robin(df, ["s"], ["o"], 3).collect()] == [1, 4, 2]


def test_one_hop_drops_incoming_self_loops(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "a")], "src string, dst string")
    got = [(r.vertex, r.neighbor, r.direction) for r in R.one_hop(e, "vertex", 2).collect()]
    assert sorted(x for x in got if x[0] == "a") == [("a", "a", "out"), ("a", "b", "out")]


def test_reports(spark):
    edges = spark.createDataFrame(
        [("x", True, False), ("x", True, False), ("x", False, True), ("n", True, False), ("n", False, False), ("n", False, False)], "type string, resolved boolean, ambiguous boolean"
    )
    got = {r.edge_group: (r.n_edges, r.resolved, r.resolution_rate) for r in A.outcome_split(edges, {"in_book": ["x"], "narrators": ["n"]}).collect()}
    assert got == {"in_book": (3, 2, 0.6667), "narrators": (3, 1, 0.3333)}
    facts = spark.createDataFrame([(None, 0.9), ("q", 0.9), ("q", 0.7), ("q", 0.3)], "evidence string, confidence double")
    assert rows(A.evidence_tally(facts)) == [("absent", 1), ("unverified", 1), ("verified", 1)]
    base = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.5), ("z", 1.0)], "field string, fill_rate double")
    cur = spark.createDataFrame([("a", 0.4), ("b", 0.51), ("c", 0.6)], "field string, fill_rate double")
    assert rows(A.gate(cur, base, falling=["c"]).select("field", "verdict")) == [("a", "regression"), ("b", "same"), ("c", "regression")]
    assert A.fill_rates(base.limit(0), {"a": F.col("field").isNotNull()}).first().fill_rate == 0.0


def test_citation_report(spark):
    c = spark.createDataFrame([("p1", "a", "v"), ("p1", "a", "w"), ("p2", "a", "v"), ("p3", "b", None), ("p3", None, "v")], "p string, k string, v string")
    got = {r.k: (r.n_mentions, r.n_persons, r.verbs, r.first_ids) for r in A.authority_report(c, "k", "p", "v", 10, 1).collect()}
    assert got == {"a": (3, 2, ["v=2", "w=1"], ["p1"]), "b": (1, 1, None, ["p3"])}


def test_neighbors_across_buckets(spark):
    values = [1, 2, 9, 10, 11, 40, 41]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 5), (None, 3), (None, 4), ("c", None)], "k string, t int")
    want = {(r.k, r.t): (r.previous_t, r.next_t) for r in R.neighbors(df, ["k"], ["t"], "t").collect()}
    got = {(r.k, r.t): (r.previous_t, r.next_t) for r in R.neighbors(df, ["k"], ["t"], "t", F.floor(F.col("t") / 10)).collect()}
    assert got == want and got[("a", 9)] == (2, 10) and got[("a", 11)] == (10, 40)


def test_ordinals_within_a_hot_key(spark):
    rows = [("hot", f"{i:05d}") for i in range(3000)] + [("x", "a"), ("x", "b"), (None, "c"), (None, "d")]
    df = spark.createDataFrame(rows, "k string, v string").repartition(5)
    got = {(r.k, r.v): r.n for r in R.ordinals(df, ["k"], ["v"], "n").collect()}
    assert all(got[("hot", f"{i:05d}")] == i for i in range(3000)) and (got[("x", "b")], got[(None, "c")], got[(None, "d")]) == (1, 0, 1)
    assert R.ordinals(df.limit(0), ["k"], ["v"], "n").count() == 0


def test_range_join_within_equal_columns(spark):
    p = spark.createDataFrame([("a", 1), ("a", 30), ("b", 1)], "book string, x int")
    r = spark.createDataFrame([("a", 0, 40, "r"), ("b", 2, 9, "s"), ("b", 9, 1, "swapped"), ("b", None, 9, "null")], "book string, lo int, hi int, n string")
    assert rows(R.range_join(p, r, "x", "lo", "hi", 7, by=["book"]).select("book", "x", "n")) == [("a", 1, "r"), ("a", 30, "r")]
