import pytest
from pyspark.sql import functions as F

from silsila.functions import text as X
from silsila.functions.folding import fold, folded, folded_each
from silsila.functions.vocab import Vocabulary


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("phrase", "year"),
    [("57", 57), ("٥٧", 57), ("سبع وخمسين", 57), ("ثلاث وسبعين", 73), ("إحدى وأربعين", 41), ("", None), ("9999", None), ("قال فلان", None), (None, None)],
)
def test_years(spark, phrase, year):
    assert one(spark, X.parse_year("v"), phrase) == year


def test_notes_and_footnotes(spark):
    assert one(spark, X.strip_notes("v"), "قال «3» زيد [(4)] وعمرو (5) «نص»") == "قال زيد وعمرو نص"
    found = one(spark, X.split_footnotes("v"), "body line\n_____\n(1) first note\n(2) second   note")
    assert found.body == "body line"
    assert [(n.marker, n.text) for n in found.footnotes] == [(1, "first note"), (2, "second note")]
    assert one(spark, X.split_footnotes("v"), "no rule").body == "no rule"
    assert one(spark, X.split_footnotes("v"), None).footnotes == []


def test_fold():
    assert fold("أَحمد  إبراهيم") == "احمد ابراهيم"
    assert fold("فاطمة ﻋﻠﻰ") == "فاطمه علي"
    assert fold(None) == "" and fold("") == ""


def test_fold_columns(spark):
    df = spark.createDataFrame([(["أ", None], "ة"), (None, None), ([], "")], "a array<string>, s string")
    got = [tuple(r) for r in df.select(folded_each("a").alias("a"), folded("s").alias("s")).collect()]
    assert got == [(["ا", ""], "ه"), (None, ""), ([], "")]


def test_fold_empty_table(spark):
    assert spark.createDataFrame([], "s string").select(folded("s").alias("s")).count() == 0


def test_evidence(spark):
    df = spark.createDataFrame([("قال زيد هذا الكلام الطويل", q) for q in ("زيد هذا الكلام", "وزيد هذا الكلام", "عمرو هذا الكلام", "زيد", None, "")], "s string, q string")
    got = [r.x for r in df.select(X.evidence_status(F.col("s"), F.col("q")).alias("x")).collect()]
    assert got == ["verified", "verified", "unverified", "too_short", "absent", "absent"]


def test_spans_rebuild_offsets(spark):
    text = "  أول جملة. ثانية؟\n\nثالثة بلا علامة"
    for r in one(spark, X.sentence_spans("v"), text):
        assert text[r.start : r.start + len(r.quote)] == r.quote
    assert one(spark, X.sentence_spans("v"), "") == [] and one(spark, X.sentence_spans("v"), None) == []


def test_chunks(spark):
    text = "\n\n".join(["كلمة " * 50] * 10)
    got = one(spark, X.chunks("v", 600), text)
    assert len(got) > 1 and all(len(c) <= 600 for c in got)
    assert one(spark, X.chunks("v"), "short") == ["short"] and one(spark, X.chunks("v"), None) == [""]


def test_vocabulary(spark):
    v = Vocabulary.of([("badr", ["بدر", "يوم بدر"]), ("uhud", ["أحد"]), ("later", ["أحد"])])
    assert one(spark, v.find_first("v"), "شهد يوم بدر") == "badr"
    assert one(spark, v.find_all("v"), "أحد وبدر") == ["badr", "later"]
    assert one(spark, v.resolve("v"), "أحد") == "later" and one(spark, v.resolve("v"), "xyz") is None and one(spark, v.resolve("v"), None) is None


def test_ordered_distinct(spark):
    df = spark.createDataFrame([(["b", "a", "B", "a"],)], "a array<string>")
    assert df.select(X.ordered_distinct(F.col("a"), F.lower).alias("x")).first().x == ["b", "a"]


def test_score_hit(spark):
    df = spark.createDataFrame([("12", 12, "x"), ("ab", 1, "ab"), ("ab", 1, "abc"), ("ab", 1, "xab"), ("ab", 1, "x")], "n string, e int, d string")
    assert [r.s for r in df.select(X.score_hit(F.col("n"), F.col("e"), F.col("d")).alias("s")).collect()] == [0, 1, 2, 3, None]


def test_chunks_against_a_loop(spark):
    import random
    import re

    from silsila.functions.text import chunks

    def packed(text, limit):
        body = (text or "").strip()
        if len(body) <= limit:
            return [body]
        out, now = [], ""
        for p in (p for p in re.split(r"\n{2,}", body) if p.strip()):
            if now and len(now) + len(p) + 2 > limit:
                out, now = [*out, now.strip()], ""
            if len(p) > limit:
                for s in re.split(r"(?<=[.؟!])\s+", p):
                    if len(now) + len(s) + 1 > limit:
                        out, now = [*out, now.strip()], ""
                    now += s + " "
            else:
                now += p + "\n\n"
        return [c for c in [*out, now.strip()] if c]

    rng = random.Random(3)
    texts = [None, "", "  x  ", *("".join(rng.choice(["a", "bb ", ". ", "! ", "\n", "\n\n", "\n\n\n", "ccc"]) for _ in range(rng.randrange(120))) for _ in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", chunks("t", 20, None).alias("c"), chunks("t", 20, 2).alias("two"))
    for r in df.collect():
        assert r.c == packed(texts[r.i], 20) and r.two == r.c[:2], texts[r.i]


def test_small_functions(spark):
    from silsila.functions import text as X

    one = spark.createDataFrame([("a\u00a0 b\n c", "x" * 30, "١٢x", "a\r\nb\rc")], "t string, long string, d string, e string")
    r = one.select(X.squeeze("t").alias("s"), X.snippet("long", 10).alias("n"), X.snippet("t", 99).alias("whole"), X.western_digits("d").alias("d"), X.line_ends("e").alias("e")).first()
    assert (r.s, r.n, r.whole, r.d, r.e) == ("a b c", "xxxx\n…\nxxxxxx", "a\u00a0 b\n c", "12x", "a\nb\nc")
    ids = spark.createDataFrame([("n", 1, 2, 3, 0), ("n", 1, 2, 3, 2)], "s string, b int, e int, p int, o int")
    from pyspark.sql import functions as F

    keys = [x.k for x in ids.select(X.person_key(*map(F.col, "sbepo")).alias("k")).collect()]
    assert keys == ["n:1:2-3", "n:1:2-3.2"]
    import re

    assert all(re.fullmatch(X.PERSON_KEY, k) for k in keys) and not re.fullmatch(X.PERSON_KEY, "N:1:2-3")
    hits = spark.createDataFrame([(5, "زيد"), (6, "زيد بن"), (7, "ابن زيد"), (8, "x"), (9, None)], "n int, name string")
    assert [x.s for x in hits.select(X.score_hit(F.lit("زيد"), F.col("n"), F.col("name")).alias("s")).collect()] == [1, 2, 3, None, None]
    sure = spark.createDataFrame([("regex", "verified"), ("structural", None), ("llm", "verified"), ("llm", "unverified"), ("llm", "absent")], "l string, s string")
    assert [x.c for x in sure.select(X.confidence(F.col("l"), F.col("s")).alias("c")).collect()] == [0.3, 1.0, 0.9, 0.55, 0.7]


def test_years_and_life_events(spark):
    from pyspark.sql import functions as F

    from silsila.operators import biography as Y

    df = spark.createDataFrame([("مات سنة سبع وخمسين، وقيل مات سنة ٥٨. ومات سنة 57",), ("لا سنة",)], "t string")
    got = df.select(Y.years(F.col("t"), "مات").alias("y")).collect()
    assert [r.y for r in got] == [[57, 58], []]
    e = df.select(Y.life_event(Y.years(F.col("t"), "مات"), F.lit(None).cast("int")).alias("e")).collect()
    assert (e[0].e.year_hijri, e[0].e.year_candidates, e[0].e.year_uncertain) == (57, [57, 58], True) and (e[1].e.year_hijri, e[1].e.year_uncertain) == (None, False)
    chosen = df.limit(1).select(Y.life_event(F.array(F.lit(57), F.lit(9000)), F.lit(60)).alias("e")).first().e
    assert (chosen.year_hijri, chosen.year_candidates) == (60, [57, 60])
    names = spark.createDataFrame([("زيد، وعن عمرو بن علي وعن جماعة, بكر",)], "t string").select(Y.name_list(F.col("t")).alias("n")).first().n
    assert names == ["زيد", "عمرو بن علي", "بكر"]
