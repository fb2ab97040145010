import json

import pytest
from pyspark.sql import types as T

from silsila.sources import io
from silsila.sources.validate import checked
from silsila.streaming import incremental as I

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("error", T.StringType())])


def write(path, lines):
    path.write_text("\n".join(lines), encoding="utf-8")
    return str(path)


def test_jsonl(spark, tmp_path):
    good = write(tmp_path / "a.jsonl", ['{"id":"x","n":1}', "", '{"id":"y","n":2}'])
    assert io.read_jsonl(spark, good, SCHEMA).where("id is not null").count() == 2
    with pytest.raises(Exception):
        io.read_jsonl(spark, write(tmp_path / "b.jsonl", ['{"id":"x"', "{"]), SCHEMA).collect()
    assert io.read_optional(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def test_log_takes_the_last_good_row(spark, tmp_path):
    log = write(tmp_path / "log.jsonl", ['{"id":"x","n":1}', '{"id":"x","n":2}', '{"id":"y","n":5,"error":"e"}', '{"id":"z","n":'])
    assert [tuple(r)[:2] for r in io.read_log(spark, log, SCHEMA, "id", "n").collect()] == [("x", 2)]


def test_checked(spark, tmp_path):
    df = spark.createDataFrame([(1,), (5,)], "v int")
    io.write_checked(df, str(tmp_path / "ok"), {"small": "v > 9"})
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 2
    with pytest.raises(Exception, match="small"):
        checked(df, {"small": "v > 4"}).collect()


def test_decoding(spark):
    raw = "زيد\rعمرو".encode("windows-1256").decode("latin-1")
    assert spark.createDataFrame([(raw,)], "t string").select(io.decoded("t").alias("x")).first().x == "زيد\nعمرو"


def test_predicate():
    assert [io.should_checkpoint(n, 50) for n in (0, 49, 50, 51, 100)] == [False, False, True, False, True]


def test_stream_goes_on_where_it_ended(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(1,)], "v int").write.parquet(source)
    stream = I.file_stream(spark, source, "v int")
    I.run_available(stream, out, state)
    spark.createDataFrame([(2,)], "v int").write.mode("append").parquet(source)
    I.run_available(stream, out, state)
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [1, 2]
    log = spark.createDataFrame([(1, None), (2, "failed")], "v int, error string")
    assert [r.v for r in I.pending(spark.read.parquet(source), log, "v").collect()] == [2]


def test_catalog(spark, data, tmp_path):
    from silsila.catalog import Catalog
    from silsila.cli import build

    build(spark, data, str(tmp_path / "packed"))
    c = Catalog(spark, str(tmp_path / "packed"))
    first = c.search(limit="3").collect()
    assert len(first) == 3 and c.person(first[0].person_id).count() == 1 and c.meta().first().n_persons > 0
    assert c.letters().count() > 0 and c.facets("nisba").count() > 0 and c.spans(first[0].person_id).count() >= 0 and c.graph(first[0].person_id).count() >= 0
    json.dumps(c.by_number(first[0].entry_number).count())
    meta = c.meta().first()
    assert meta.n_edges == c.table("edges").count() > 0 and meta.n_citations > 0 and meta.n_chapters == 0
    name = next(r.display_name_norm for r in c.table("persons").collect() if r.display_name_norm and len(r.display_name_norm.split()) > 2)
    hits = c.search(q=name.split()[0]).collect()
    assert hits and all(set(h.asDict()) == set(first[0].asDict()) for h in hits)
    one = c.table("facts").first().person_id
    assert c.facts(one).count() > 0 and c.citations(one).count() >= 0 and c.table("names").count() > 0
    build(spark, data, str(tmp_path / "few"), 7)
    assert Catalog(spark, str(tmp_path / "few")).meta().first().n_persons == 7


def test_books_are_found_by_the_names_of_their_tables(spark, tmp_path):
    assert io.find_tables(["Main.json", "B12.json", "t12.json"]) == ("B12.json", "t12.json") and io.find_tables(["pages.parquet", "toc.parquet"]) == ("pages.parquet", "toc.parquet")
    with pytest.raises(ValueError, match="no table"):
        io.find_tables(["x"])
    write(tmp_path / "b7.json", ['{"id":2,"page":1,"part":"1","text":"x"}', '{"id":1,"text":"y"}'])
    write(tmp_path / "t7.json", ['{"id":1,"lvl":2,"title":" a   b "}', '{"id":1,"lvl":1,"title":"c"}'])
    pages, toc = io.read_book(spark, str(tmp_path), "n", 7, 7)
    assert pages.count() == 2 and [(r.title, r.ord) for r in toc.orderBy("ord").collect()] == [("c", 1), ("a b", 2)]
    with pytest.warns(UserWarning, match="not the expected"):
        io.read_book(spark, str(tmp_path), "n", 8, 7)


def test_vocabulary_files(tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"terms": [{"key": "k", "label_ar": "ل", "aliases": ["ا", "ل"]}, {"key": "m", "aliases": ["ا"]}]}), encoding="utf-8")
    v = io.read_vocabularies(str(tmp_path))["v"]
    assert dict(v.aliases) == {"k": "k", "ل": "k", "ا": "m", "m": "m"}


def test_the_rest_of_the_sinks(spark, tmp_path):
    io.append(spark.createDataFrame([(1,)], "v int"), str(tmp_path / "log"))
    io.append(spark.createDataFrame([(2,)], "v int"), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    io.write_report(spark.createDataFrame([(1,)], "v int"), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first().v == 1
    spark.range(3).write.parquet(str(tmp_path / "src" / "a"))
    assert io.seed(spark, str(tmp_path / "src"), str(tmp_path / "dst"), ["a", "b"]) == ["a"] and io.seed(spark, str(tmp_path / "src"), str(tmp_path / "dst"), ["a"]) == []
    assert io.seed(spark, str(tmp_path / "src"), str(tmp_path / "dst"), ["a"], force=True) == ["a"]
    (tmp_path / "z.bok").write_text("x")
    assert io.locate(None, "NO_SUCH_VARIABLE", [str(tmp_path)], ".bok") == str(tmp_path / "z.bok") and io.locate("given", "X", [], "") == "given" and io.locate(None, "NO_SUCH_VARIABLE", [], "") is None
    assert io.completed(spark.createDataFrame([("a", None), ("b", "e")], "k string, error string"), "k").count() == 1


def test_windows_of_a_stream_and_of_a_batch(spark, tmp_path):
    import datetime as dt

    t = [dt.datetime(2026, 1, 1, 0, m) for m in (0, 5, 50)]
    df = spark.createDataFrame([("a", t[0]), ("a", t[1]), ("a", t[2]), ("b", t[0])], "k string, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    stream = I.tumbling(I.file_stream(spark, str(tmp_path / "in"), df.schema), "ts", "30 minutes", ["k"])
    got = {}
    I.run_batches(stream, lambda b, n: got.update({(r.k, r.window.start): r.n for r in b.collect()}), str(tmp_path / "state"), "complete")
    assert got == {("a", t[0]): 2, ("a", t[2].replace(minute=30)): 1, ("b", t[0]): 1}
    assert sorted((r.k, r.n) for r in I.sessions(df, "ts", "10 minutes", ["k"]).collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_stages_are_released_and_buckets_join_without_a_shuffle(spark):
    from silsila.session import bucketed, counted, materialize, release

    a, b = (bucketed(spark.range(50).selectExpr("id % 7 as k", f"id as {n}"), "k") for n in ("x", "y"))
    joined = a.join(b, "k")
    assert joined.count() == sum(len([i for i in range(50) if i % 7 == k]) ** 2 for k in range(7))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in a.join(b, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stage, n = counted(spark.range(9), "id > 5")
    assert n == 3 and stage.count() == 9
    path = stage._stage_path
    release(stage, a, b, None, spark.range(1))
    assert not io.exists(spark, path) and not spark.catalog.listTables() or all(not t.name.startswith("silsila_") for t in spark.catalog.listTables() if t.name in (a._stage_table, b._stage_table))
    assert materialize(spark.range(3)).count() == 3
