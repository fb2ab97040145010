from pyspark.sql import functions as F

from silsila.operators import structure as B


def book(spark, toc, pages):
    t = spark.createDataFrame([("b", i, *r) for i, r in enumerate(toc)], "book string, ord int, id long, lvl int, title string")
    p = spark.createDataFrame([("b", *r) for r in pages], "book string, id long, page int, text string")
    return t, p


def test_entries_cut_on_shared_pages(spark):
    toc = [(100, 5, "1- زيد بن عمرو"), (100, 5, "2- خالد بن سعد"), (100, 5, "3 ز- بكر بن علي")]
    pages = [(100, 10, "1- زيد بن عمرو مات.\n2- خالد بن سعد روى.\n3 ز- بكر بن علي"), (101, 11, "وبقي زمنا.")]
    t, p = book(spark, toc, pages)
    found = B.entries(t, F.lit(101).cast("long"))
    texts = {r.entry_number: r.text for r in B.entry_texts(found, p).collect()}
    assert texts[1] == "1- زيد بن عمرو مات." and "زيد" not in texts[2]
    assert texts[3].startswith("3 ز- بكر") and texts[3].endswith("وبقي زمنا.")
    assert {r.entry_number: r.entry_marker for r in found.collect()} == {1: None, 2: None, 3: "ز"}


def test_repeated_numbers_and_rejects(spark):
    t, _ = book(spark, [(1, 4, "170- أ"), (1, 4, "170- ب"), (2, 4, "7- القسم الأول"), (3, 4, "99999- ج")], [(1, 1, "x")])
    got = B.entries(t, F.lit(9).cast("long")).select("name", "entry_number_is_ambiguous", "ordinal", "reject_reason").collect()
    assert {(r.name, r.entry_number_is_ambiguous, r.ordinal, r.reject_reason) for r in got} == {
        ("أ", True, 0, None), ("ب", True, 1, None), ("القسم الأول", None, None, "structural_heading"), ("ج", None, None, "number_out_of_range"),
    }


def test_placement_carries_and_resets(spark):
    toc = [
        (1, 1, "المجلد الأول"), (2, 2, "حرف الباء"), (3, 3, "باب الباء بعدها ألف"), (4, 3, "القسم الأول"), (5, 4, "1- بكر"), (6, 2, "حرف التاء"), (7, 4, "2- تميم"), (8, 2, "النساء"), (9, 3, "3- تماضر"),
    ]
    t, _ = book(spark, toc, [(1, 1, "")])
    got = {r.title: r for r in B.placement(t).collect()}
    assert (got["1- بكر"].letter, got["1- بكر"].qism, got["1- بكر"].section_type) == ("حرف الباء", 1, "names")
    assert got["1- بكر"].bab is not None and got["2- تميم"].bab is None and got["2- تميم"].letter == "حرف التاء"
    assert got["3- تماضر"].section_type == "women" and got["3- تماضر"].toc_path[-2:] == ["النساء", "3- تماضر"]


def test_chapters_and_coverage(spark):
    t, p = book(spark, [(1, 1, "مقدمة"), (3, 1, "حرف الباء"), (4, 2, "1- بكر")], [(i, i, f"page {i}") for i in range(1, 7)])
    entries = B.entries(t, F.lit(6).cast("long"))
    found = B.chapters(t, entries.select("book", "id"), F.lit(6).cast("long"))
    assert {(r.title, r.kind, r.id, r.end_id) for r in found.collect()} == {("مقدمة", "preface", 1, 2), ("حرف الباء", "letter_heading", 3, 6)}
    assert [r.text for r in B.chapter_texts(found, p).collect()] == ["page 1\n\npage 2"]
    only = found.where("kind = 'preface'").select("book", "id", "end_id")
    assert sorted(r.id for r in B.page_coverage(p, only).collect()) == [3, 4, 5, 6]


def test_any_depth_of_a_table_of_contents(spark):
    toc = [(i, i, f"t{i}") for i in range(1, 41)] + [(50, 3, "u"), (51, 1, "v")]
    t, _ = book(spark, toc, [(1, 1, "")])
    got = {r.title: r for r in B.walked(t).collect()}
    assert got["t40"].titles == [f"t{i}" for i in range(1, 41)] and got["u"].titles == ["t1", "t2", "u"] and got["v"].titles == ["v"]
    assert (got["t40"].next_id, got["t3"].next_id, got["t2"].next_id, got["v"].next_id) == (50, 50, 51, None)


def test_order_within_a_page_and_pages_of_offsets(spark):
    toc = [(1, 5, "2- خالد بن سعد"), (1, 5, "1- زيد بن عمرو"), (1, 5, "9- غائب"), (2, 5, "3- بكر")]
    t, p = book(spark, toc, [(1, 10, "1- زيد بن عمرو مات.\n2- خالد بن سعد"), (2, 11, "3- بكر"), (3, 12, "بقية")])
    found = B.entries(t, F.lit(3).cast("long")).select("book", "ord", "id", "entry_number", "name")
    assert [r.entry_number for r in B.in_page_order(found, p).orderBy("doc_ord").collect()] == [1, 2, 9, 3]
    ranges = spark.createDataFrame([("b", "x", 1, 3), ("b", "y", 3, 2)], "book string, k string, id long, end_id long")
    spans = B.page_spans(ranges, p.withColumn("part", F.lit("v")), ["k"])
    assert [(r.page_id, r.span_start, r.span_end) for r in spans.orderBy("page_id").collect()] == [(1, 0, 34), (2, 36, 42), (3, 44, 48)]
    at = spark.createDataFrame([("b", "x", n) for n in (0, 34, 35, 36, 99)], "book string, k string, at int")
    assert {(r.at, r.page_id) for r in B.page_at(at, spans, ["k"]).collect()} == {(0, 1), (34, 1), (35, 3), (36, 2), (99, 3)}


def test_an_entry_without_placement_fails(spark):
    import pytest

    raw = spark.createDataFrame([("a",), ("b",)], "person_id string")
    one = spark.createDataFrame([("a", 1)], "person_id string, qism int")
    assert B.placed(raw.where("person_id = 'a'"), one).count() == 1
    with pytest.raises(Exception, match="no placement for b"):
        B.placed(raw, one).collect()
