import pytest
from pyspark.sql import functions as F

from silsila.operators import biography as Y
from silsila.operators import graph as G
from silsila.operators import labels as L
from silsila.operators import passes as P
from silsila.operators import search as S
from silsila.operators.lineage import identity_score, lineage, overlap, parse_lineage, segment_problem


def test_lineage_of_a_heading():
    n = parse_lineage("102- زيد بن حارثة بن شراحيل الكلبي. يكنى أبا أسامة، شهد بدرا")
    assert (n["ism"], n["father"], n["grandfather"], n["nisba"], n["link_count"]) == ("زيد", "حارثة", "شراحيل", ["الكلبي"], 2)
    assert n["full_name"] == "زيد بن حارثة بن شراحيل الكلبي" and n["confidence"] == 0.78
    assert parse_lineage("زيد بن عمرو قال كذا")["chain"] == ["زيد", "عمرو"]
    assert parse_lineage("زيد بن. قال")["chain"] == ["زيد"]
    bad = parse_lineage("زيد بن عمرو 12 بن علي", "زيد")
    assert bad["source"] == "toc" and bad["confidence"] == 0.2 and bad["rejected_reason"] == "segment_has_punctuation_or_digits" and bad["chain"] == ["زيد"]
    assert parse_lineage(None)["rejected_reason"] == "empty_opening_text" and parse_lineage("قال زيد", "x")["rejected_reason"] == "boundary_at_start"


@pytest.mark.parametrize(("segment", "reason"), [("", "empty_segment"), ("ز", "segment_too_short"), ("ا" * 41, "segment_too_long"), ("abc", "segment_not_arabic"), ("زيد عمرو بكر خالد سعد", "segment_too_many_words"), ("زيد", None), ("زيد قال", "segment_has_verb:قال")])
def test_segments(segment, reason):
    assert segment_problem(segment) == reason


def test_lineage_column(spark):
    df = spark.createDataFrame([("زيد بن عمرو.", "زيد"), (None, None)], "t string, d string")
    assert [r.n.ism for r in df.select(lineage("t", "d").alias("n")).collect()] == ["زيد", None]


def test_overlap_and_score(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["x", "b", "c"]), (["a"], ["z"]), ([], ["z"])], "a array<string>, b array<string>")
    got = [tuple(r) for r in df.select(overlap(F.col("a"), F.col("b")), identity_score(F.col("a"), F.col("b"))).collect()]
    assert got == [(2, 0.85), (0, 0.55), (0, 0.775)]


@pytest.mark.parametrize(
    ("sentence", "label"),
    [
        ("قلت: هذا أولى", "ibn_hajar_voice"), ("اختلف في اسمه على أقوال", "name_dispute"), ("ثنا فلان عن فلان", "isnad"), ("ومات سنة خمسين", "death"), ("ولد سنة عشر", "birth"), ("استعمله عمر على البصرة", "office"),
        ("أمه هند", "family"), ("كان ثقة", "praise"), ("ليس بشيء ضعيف", "criticism"), ("شهد بدرا", "battle"), ("ذكره البغوي", "citation"), ("سكن البصرة", "event"), ("زيد بن عمرو بن علي", "nasab"),
        ("فلان الفلاني", "unlabeled"), ("..", "boilerplate"), ("12- زيد بن عمرو", "heading"),
    ],
)
def test_sentence_labels(spark, sentence, label):
    rows = L.found_patterns(spark.createDataFrame([(sentence,)], "quote string"), "quote")
    assert rows.select(L.best_label("quote").alias("s")).first().s.label == label


def test_prefix_tree():
    import re

    words = ["بدر", "بدرا", "أحد", "أحزاب", "خيبر"]
    for text in ("يوم بدرا", "أحز", "في خيبر", "أح", "الأحزاب", ""):
        assert bool(re.search(L.prefix_tree(words), text)) == any(w in text for w in words)


def test_references(spark):
    texts = [("a", "يأتي في الكنى. وتقدم في القسم الرابع"), ("b", "يأتي ذكره في ترجمة أبيه"), ("c", "انظر في رقم 123. يأتي في الذي بعده"), ("d", "مضى في حرف الباء. مضى في حرف الباء"), ("e", None)]
    df = spark.createDataFrame(texts, "id string, t string")
    got = {(r.id, r.kind, r.relation, r.entry_number, r.qism, r.section, r.letter, r.offset, r.direction) for r in G.text_references(df, "t", "id").collect()}
    assert got == {
        ("a", "see_section", None, None, None, "kunya", None, None, "forward"), ("a", "see_qism", None, None, 4, None, None, None, "backward"), ("b", "see_relation", "father", None, None, None, None, None, "forward"),
        ("c", "see_entry", None, 123, None, None, None, None, "forward"), ("c", "see_adjacent", None, None, None, None, None, 1, "forward"), ("d", "see_letter", None, None, None, None, "حرف الباء", None, "backward"),
    }


INDEX = "person_id string, name_keys array<string>, section string, letter string, qism int, is_woman boolean, nisba_keys array<string>, tokens array<string>"
WANTED = "ref_id string, norm string, section string, letter string, qism int, is_woman boolean, nisba_key string, chain array<string>"


def test_resolution_of_names(spark):
    index = spark.createDataFrame(
        [
            ("p1", ["زيد بن علي", "زيد"], "names", "ز", 1, False, ["qurashi"], ["زيد", "علي", "بكر"]), ("p2", ["زيد بن علي"], "kunya", "ز", 2, False, [], ["زيد", "علي", "خالد"]), ("p3", ["هند"], "women", "ه", 1, True, None, ["هند"]),
            ("a", ["عمر"], "names", "ب", 1, False, None, ["عمر"]), ("b", ["عمر"], "kunya", "ع", 1, False, None, ["عمر"]),
        ], INDEX,
    )
    wanted = spark.createDataFrame(
        [
            ("r1", "هند", None, None, None, None, None, []), ("r2", "زيد بن علي", None, None, None, None, None, []), ("r3", "زيد بن علي", None, None, 2, None, None, []), ("r4", "زيد بن علي", None, None, 4, None, None, ["س", "علي", "بكر"]),
            ("r5", "زيد بن علي بن ص", None, None, None, None, "qurashi", []), ("r6", "لا أحد", None, None, None, None, None, []), ("r7", "عمر", "names", "ع", None, None, None, None), ("r8", "هند", None, None, None, False, None, None),
        ], WANTED,
    )
    got = {r.ref_id: (r.to_id, r.resolved, r.ambiguous, r.n_candidates, r.candidates) for r in G.resolve_names(wanted, G.name_keys(index), index).collect()}
    assert got == {
        "r1": ("p3", True, False, 1, None), "r2": (None, False, True, 2, ["p1", "p2"]), "r3": ("p2", True, False, 1, None), "r4": ("p1", True, False, 1, None), "r5": ("p1", True, False, 1, None),
        "r6": (None, False, False, 0, None), "r7": (None, False, True, 2, ["a", "b"]), "r8": ("p3", True, False, 1, None),
    }
    listed = {r.ref_id: (r.n_candidates, r.candidates) for r in G.resolve_names(wanted, G.name_keys(index), index, 1).collect()}
    assert listed["r2"] == (2, ["p1"])


def test_keys_of_names(spark):
    index = spark.createDataFrame([("p", "أَبو بكر", None, "أبو علي", "زيد", "عمرو", ["زيد العدوي", ""]), ("q", None, None, None, None, "عمرو", None)], "person_id string, display_name_norm string, full_name_norm string, kunya string, ism string, father string, name_keys array<string>")
    names = spark.createDataFrame([("q", "الحارث")], "person_id string, form string")
    got = {(r.person_id, r.norm) for r in G.name_keys(index, names).collect()}
    assert got == {("p", x) for x in ("ابو بكر", "ابو علي", "زيد", "زيد بن عمرو", "زيد العدوي")} | {("q", "الحارث")}


def test_edges_of_facts(spark):
    index = spark.createDataFrame([("p", ["زيد"], "names", "ز", 1, False, None, ["زيد"], ["زيد"]), ("w", ["هند"], "women", "ه", 1, True, None, ["هند"], None), ("m", ["هند"], "names", "ه", 1, False, None, ["هند"], None)], INDEX + ", chain array<string>")
    facts = spark.createDataFrame(
        [("p", "life.family", 0, "هند", "wife", "regex", "e", 0.3), ("p", "narration.narrated_to", 0, "هند", None, "llm", "e", 0.9), ("p", "narration.narrated_to", 1, "جماعة", None, "llm", "e", 0.9), ("w", "narration.narrated_from", 0, "زيد", None, "llm", None, 0.9), ("w", "labels", 0, "زيد", None, "llm", None, 0.9)],
        "person_id string, coll_path string, pos int, value string, relation string, source string, evidence string, confidence double",
    )
    edges = G.fact_edges(facts, index, G.name_keys(index))
    got = {(r.from_id, r.type, r.to_id, r.to_literal, r.relation, r.resolved, r.ambiguous) for r in edges.collect()}
    assert got == {("p", "family", "w", None, "wife", True, False), ("p", "narrated_to", None, "هند", None, False, True), ("w", "narrated_from", "p", None, None, True, False)}
    assert sorted(tuple(r) for r in G.edge_stats(edges).collect()) == [("family", 1, 1, 0, 0), ("narrated_from", 1, 1, 0, 0), ("narrated_to", 1, 0, 1, 0)]


def test_pointers_as_edges(spark):
    index = spark.createDataFrame(
        [("p1", ["زيد"], "names", "ز", 1, False, None, ["زيد"], "b", 1, 7, None, None, ["زيد"]), ("p2", ["علي"], "names", "ع", 1, False, None, ["علي"], "b", 2, 7, "زيد", "x", ["علي", "زيد"]), ("p3", ["س"], "names", "س", 1, False, None, ["س"], "b", 3, 9, "لا أحد", "زيد", ["س"])],
        INDEX + ", book string, doc_ord int, entry_number int, father string, grandfather string, chain array<string>",
    )
    texts = [("p1", "تقدم في رقم 9. يأتي في الذي بعده. انظر في حرف الباء"), ("p2", "تقدم في رقم 7. تقدم في ترجمة أبيه"), ("p3", "تقدم في ترجمة أبيه. مضى في ترجمة جده. يأتي في الذي بعده. تقدم في رقم 8")]
    refs = G.text_references(spark.createDataFrame(texts, "person_id string, t string"), "t", "person_id")
    keys = G.name_keys(index)
    got = {(r.from_id, r.type, r.relation, r.to_id, r.resolved, r.ambiguous) for r in G.reference_edges(refs, index, keys).collect()}
    assert got == {
        ("p1", "see_entry", None, "p3", True, False), ("p1", "see_adjacent", None, "p2", True, False), ("p1", "see_letter", None, None, False, False), ("p2", "see_entry", None, None, False, True), ("p2", "see_relation", "father", "p1", True, False),
        ("p3", "see_relation", "father", None, False, False), ("p3", "see_relation", "grandfather", "p1", True, False), ("p3", "see_adjacent", None, None, False, False), ("p3", "see_entry", None, None, False, False),
    }
    fathers = spark.createDataFrame([("p3", "father", "p2")], "from_id string, relation string, to_id string")
    assert ("p3", "father", "p2") in {(r.from_id, r.relation, r.to_id) for r in G.reference_edges(refs, index, keys, fathers).collect()}


def test_evidence(spark):
    from silsila.functions.text import evidence_status

    source = "وكان (١) زيدٌ «رجلا» صالحا، ثم مات سنة خمسين."
    rows = [(None, "absent"), ("", "absent"), ("رجل", "too_short"), ("...،،؛؛؛؛", "too_short"), ("زيد رجلا صالحا.", "verified"), ("فثم مات سنة خمسين", "verified"), ("ثم ثم مات سنة خمسين", "verified"), ("فكان زيد رجلا", "unverified"), ("قال مات سنة خمسين", "verified"), ("صالحا رجلا زيد", "unverified")]
    df = spark.createDataFrame([(source, q, w) for q, w in rows] + [(None, "نص طويل جدا", "unverified")], "s string, q string, want string")
    assert [(r.q, r.got) for r in df.withColumn("got", evidence_status("s", "q")).collect() if r.got != r.want] == []


def test_kinds_events_and_merge(spark):
    row = spark.createDataFrame([("أسلم وهاجر إلى الحبشة وشهد بدرا واستشهد",)], "t string")
    from silsila.functions.vocab import Vocabulary

    events = row.select(Y.events(F.col("t"), Vocabulary.of([("badr", ["بدر"])])).alias("e")).first().e
    assert [(e.kind, e.key) for e in events] == [("battle", "badr"), ("martyrdom", None), ("hijra", None)]
    assert row.select(Y.fact_kind("conversion", F.col("t")).alias("k")).first().k == "hijra_habasha"
    parts = spark.createDataFrame([("a", 1, None, False, ["x", "y"]), ("a", 2, "v", True, ["y", "z"]), ("a", 3, "w", None, None)], "k string, o int, s string, f boolean, l array<string>")
    assert [tuple(r) for r in Y.merged_chunks(parts, "k", "o", ["s"], ["f"], ["l"]).collect()] == [("a", "v", True, ["x", "y", "z"])]


def test_passes(spark):
    facts = spark.createDataFrame(
        [("p", "narration.praise", 0, "v0", "other", "llm", "quote text", 0.55, "here is quote text indeed"), ("p", "narration.praise", 1, "v1", "good", "llm", "missing quote", 0.55, "here is quote text indeed")],
        "person_id string, field string, idx int, value string, kind string, source string, evidence string, confidence double, body string",
    )
    assert [r.idx for r in P.REPAIR.items(facts).collect()] == [1] and [r.idx for r in P.KINDS.items(facts).collect()] == [0]
    patches = spark.createDataFrame([("p", "narration.praise", 1, "v1", "quote text"), ("p", "narration.praise", 0, "not v0", None)], "person_id string, field string, idx int, value string, new_evidence string")
    assert {(r.idx, r.evidence, r.confidence) for r in P.repaired(facts, patches).collect()} == {(0, "quote text", 0.55), (1, "quote text", 0.9)}
    asked = spark.createDataFrame([("k1", "hello")], "request_key string, prompt string")
    assert [tuple(r) for r in P.answered(asked, lambda ps: [p.upper() for p in ps]).collect()] == [("k1", "HELLO", None)]
    assert P.answered(asked, None).count() == 0


def test_timeline(spark):
    items = spark.createDataFrame([("p", "death", None, 11, 3), ("p", "battle", "badr", None, 1), ("p", "event", None, None, 2), ("p", "birth", None, None, 0)], "person_id string, kind string, vocab_key string, year int, ord int")
    years = spark.createDataFrame([("badr", 2)], "vocab_key string, year int")
    assert [(e.year, e.kind) for e in P.timelines(items, years).first().timeline] == [(2, "battle"), (11, "death"), (None, "event")]


def test_filters():
    f = S.Filters.parse({"limit": "0", "offset": "-3", "woman": "1", "qism": "2", "battle": "badr"})
    assert (f.limit, f.offset, f.woman, f.qism, f.postings) == (40, 0, True, 2, [("battle", "badr")])
    assert S.Filters.parse({"limit": "900"}).limit == 100 and S.Filters.parse({"limit": "-5"}).limit == 1 and S.Filters.parse({}).woman is None
    assert S.query_tokens('أبو "هريرة" (x)') == ["أبو", "هريرة", "x"] and S.query_tokens("") == []


def test_names_disputes_and_gaps(spark):
    p = spark.createDataFrame([("a", "زيد ", None, "أبو علي"), ("b", None, "", None)], "person_id string, display_name string, full_name string, kunya string")
    assert sorted(map(tuple, Y.name_rows(p).collect())) == [("a", "أبو علي", "kunya"), ("a", "زيد", "display")]
    note = spark.createDataFrame([("اختلف في اسمه فقيل زيد وقيل عمرو وقيل ب",)], "t string")
    assert note.select(Y.dispute_forms(F.col("t")).alias("x")).first().x == ["زيد", "عمرو"]
    spans = spark.createDataFrame([("a", 2, 5, "x"), ("a", 4, 7, "y"), ("a", 7, 9, "z")], "person_id string, start int, end int, label string")
    sizes = spark.createDataFrame([("a", 12), ("b", 3)], "person_id string, length int")
    assert sorted(map(tuple, Y.span_gaps(spans, sizes).collect())) == [("a", 0, 2, "gap"), ("a", 2, 5, "x"), ("a", 5, 7, "gap"), ("a", 7, 9, "z"), ("a", 9, 12, "gap"), ("b", 0, 3, "gap")]


def test_shape_of_replies(spark):
    rows = [
        ('{"battles":[],"birth":{"year_hijri":57}}', None), ('```json\n{"death":null}\n```', None), ("[1]", "Response was not a JSON object."), ("oops", "Response was not a JSON object."), (None, "Response was not a JSON object."),
        ('{"family":"x"}', 'Field "family" must be an array.'), ('{"narration":3}', 'Field "narration" must be an object.'), ('{"birth":"x"}', 'Field "birth" must be an object.'),
        ('{"death":{"year_hijri":57.5}}', 'Field "death.year_hijri" must be an integer Hijri year or null.'), ('{"death":{"year_hijri":"57"}}', 'Field "death.year_hijri" must be an integer Hijri year or null.'),
    ]
    df = spark.createDataFrame(rows, "reply string, want string").withColumn("got", P.reply_problem("reply"))
    assert [(r.reply, r.got) for r in df.collect() if r.got != r.want] == []
    fenced = spark.createDataFrame([("```\nx\n```",), (" y ",), ("```json {} ```",), (None,)], "r string")
    assert [r.x for r in fenced.select(P.strip_fences("r").alias("x")).collect()] == ["x", "y", "{}", ""]


def test_durations_and_delays():
    assert [P.parse_duration(x) for x in ("500ms", "2s", "1m30s", "1.5s", "20", "", None, "soon")] == [500, 2000, 90_000, 1500, 20_000, None, None, None]
    assert P.retry_delay({"retry-after": "2"}, 0) == 2750 and P.retry_delay({}, 3) == 8750 and P.retry_delay({}, 30) == 60_750 and P.retry_delay({"retry-after-ms": "500ms"}, 9) == 1250
    assert P.retry_delay({"x-ratelimit-reset-tokens": "3s", "x-ratelimit-reset-requests": "1s"}, 0) == 3750 and P.retry_delay({"retry-after": "1h"}, 0) == 90_000


def test_fatal_and_refused_calls(spark):
    asked = spark.createDataFrame([("k", "p")], "request_key string, prompt string")

    def fatal(prompts):
        raise P.Fatal("no key")

    assert [tuple(r) for r in P.answered(asked, fatal).collect()] == [("k", None, "no key")]

    calls = {"n": 0}

    def refused(prompts):
        calls["n"] += 1
        if calls["n"] < 2:
            raise P.Refused("slow down", {"retry-after-ms": "1ms"})
        return ["ok"]

    assert [tuple(r) for r in P.answered(asked, refused).collect()] == [("k", "ok", None)]


def test_passes_applied(spark):
    persons = spark.createDataFrame([("a", "نحو مائة", None, True, None, "regex", 0.3), ("b", None, None, None, None, None, None)], "person_id string, value string, count int, uncertain boolean, evidence string, source string, confidence double")
    replies = spark.createDataFrame([("a", 100, False, "e"), ("b", 5, None, None), ("c", 1, None, None)], "person_id string, count int, uncertain boolean, evidence string")
    after = P.with_hadith_counts(persons, replies)
    assert {r.person_id: (r["count"], r.uncertain, r.evidence, r.source, r.confidence) for r in after.collect()} == {"a": (100, False, "e", "llm", 0.9), "b": (None, None, None, None, None)}
    assert {r.column_name: r.changed for r in P.pass_counters(persons, after, ["person_id"], ["count", "evidence", "value"]).collect()} == {"count": 1, "evidence": 1, "value": 0}
    keyed = spark.createDataFrame([("a", ["thiqa"]), ("b", None)], "person_id string, verdict_keys array<string>")
    found = spark.createDataFrame([("a", 1, "daif"), ("a", 0, "thiqa"), ("b", 0, None)], "person_id string, idx int, verdict_key string")
    assert {r.person_id: r.verdict_keys for r in P.with_verdicts(keyed, found).collect()} == {"a": ["thiqa", "daif"], "b": []}
    chains = spark.createDataFrame([("a", 0, [" x ", "", "y"])], "person_id string, idx int, links array<string>")
    assert [tuple(r) for r in P.isnad_rows(chains).collect()] == [("a", 0, 0, "x"), ("a", 0, 2, "y")]
    spans = spark.createDataFrame([("a", 0, 5, "unlabeled", 0.1), ("a", 5, 9, "death", 0.6)], "person_id string, start int, end int, label string, confidence double")
    new = spark.createDataFrame([("a", 0, 5, "battle", 0.8), ("a", 5, 9, "birth", 0.8)], "person_id string, start int, end int, label string, confidence double")
    assert {(r.start, r.label) for r in P.relabelled(spans, new).collect()} == {(0, "battle"), (5, "death")}


def test_wounds_ages_and_counts(spark):
    from silsila.operators import persons as N

    df = spark.createDataFrame([("أصيب يوم أحد. ومات وهو ابن ستين سنة. وأسلم وهو ابن عشرين سنة",), ("لا شيء",), (None,)], "t string")
    got = df.select(N.wounds("t").alias("w"), N.ages("t").alias("a")).collect()
    assert got[0].w == ["أصيب"] and [a.kind for a in got[0].a] == ["at_death", "at_islam"] and got[1].w == [] == got[2].w and got[1].a == []
    counts = spark.createDataFrame([("نحو 120 حديثا",), ("ألفان",), (None,)], "v string").select(N.hadith_count(F.col("v")).alias("c")).collect()
    assert (counts[0].c["count"], counts[0].c.uncertain) == (120, True) and (counts[1].c["count"], counts[1].c.uncertain) == (None, True) and counts[2].c is None
    texts = spark.createDataFrame([("استشهد يوم احد",), ("طاعون عمواس",), ("",)], "t string")
    assert [r.k for r in texts.select(N.death_cause("t").alias("k")).collect()] == ["battle", "plague", None]


def test_search_rows_and_aliases(spark):
    rows = spark.createDataFrame([("a", 5, "ابو هريره", None), ("b", 7, "ابو بكر", ["x"]), ("c", 9, "عمر ابو بكر", None), ("d", 12, "ابو بكره", None)], "person_id string, entry_number int, display_name_norm string, nisba array<string>")
    assert [(r.person_id, r.score) for r in S.scored(rows, "abu bakr").collect()] == [("b", 1), ("d", 2), ("c", 3)]
    assert [(r.person_id, r.score) for r in S.scored(rows, "12").collect()] == [("d", 0)] and S.scored(rows, "", limit=2, offset=1).count() == 2
    shown = S.decorated(rows).first()
    assert shown.nisba == [] and shown.is_woman is None and set(shown.asDict()) == set(S.ROW)
    keys = S.labels_of(spark.createDataFrame([("badr",), ("zz",)], "key string"), "key", {"badr": "بدر"}).collect()
    assert [r.label for r in keys] == ["بدر", "zz"]


def test_vocabulary_scan_equals_containment(spark):
    from silsila.functions.vocab import Vocabulary

    v = Vocabulary.of([("a", ["فتح مكة", "xx"]), ("b", ["مكة", "xx"]), ("c", ["كة ي"])])
    df = spark.createDataFrame([("فتح مكة يوم",), ("مكة",), ("xx",), ("",), (None,)], "t string")
    got = df.select("t", v.scan("t").alias("scan"), v.find_all("t").alias("held")).collect()
    assert all(r.scan == r.held for r in got) and got[0].scan == ["a", "c", "b"] and got[2].scan == ["b"]


def test_passes_share_a_budget_and_a_log(spark):
    facts = spark.createDataFrame(
        [(f"p{i}", "narration.praise", 0, f"v{i}", "other", "llm", None, 0.5, "", "biography", 1) for i in range(3)] + [("p0", "span", 1, "ثنا فلان عن فلان", "x", "regex", None, 0.3, "", "biography", 1)],
        "person_id string, field string, idx int, value string, kind string, source string, evidence string, confidence double, body string, entry_kind string, qism int",
    )

    def provider(prompts):
        return ['```json\n[{"idx": 1, "links": ["فلان", "فلان"]}]\n```' if "span" in p else '[{"field": "narration.praise", "idx": 0, "value": "k"}]' if "v2" not in p else "no JSON" for p in prompts]

    records, log = P.run_passes(facts, [P.KINDS, P.ISNADS], provider)
    assert sorted(r.person_id for r in records["kinds"].collect()) == ["p0", "p1"] and log.count() == 4
    assert [(r.person_id, r.links) for r in records["isnads"].collect()] == [("p0", ["فلان", "فلان"])]

    def never(prompts):
        raise AssertionError("asked again")

    again, longer = P.run_passes(facts, [P.KINDS, P.ISNADS], never, log)
    assert longer.count() == 4 and again["isnads"].count() == 1
    few, short = P.run_passes(facts, [P.KINDS, P.ISNADS], provider, cap=1500)
    assert short.count() == 2 and few["isnads"].count() == 0
    assert P.run_passes(facts, [P.KINDS], None)[1].count() == 0


def test_extraction_by_chunks(spark):
    texts = spark.createDataFrame([("a", ("x" * 5000 + "\n\n") * 2), ("b", "short"), ("c", "bad")], "person_id string, text_body string")

    def provider(prompts):
        return ["oops" if p == "bad" else '{"kunya": null, "is_woman": true, "battles": ["badr"]}' if p == "short" else '{"kunya": "k", "is_woman": false, "battles": ["uhud", "badr"]}' for p in prompts]

    out = P.extracted(texts, provider, {"kunya": "string", "is_woman": "boolean", "battles": "array<string>"})
    got = {r.person_id: (r.problem, r.kunya, r.is_woman, r.battles) for r in out.collect()}
    assert got == {"a": (None, "k", False, ["uhud", "badr"]), "b": (None, None, True, ["badr"]), "c": ("Response was not a JSON object.", None, None, [])}
