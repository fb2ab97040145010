import datetime as dt

import pytest

from silsila.llm.sentences import sentence_spans, sentence_starts, sentences
from silsila.llm.split import boundaries, cut_long, finest, pieces


def cut(text):
    return [text[a:b] for a, b in sentence_spans(text)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, []), ("", []), (" \n ", []), ("one", ["one"]),
        ("قال زيد. ثم مات؟ نعم!", ["قال زيد.", "ثم مات؟", "نعم!"]),
        ("قال «من أنت؟ ومن أين جئت؟» ثم مضى. وكان", ["قال «من أنت؟ ومن أين جئت؟» ثم مضى.", "وكان"]),
        ("فقيل له «أين هو؟». (3) كان", ["فقيل له «أين هو؟». (3)", "كان"]),
        ("في كتابه.[(7)] وكان", ["في كتابه.[(7)]", "وكان"]),
        ("وزنه 27.74 رطلا و٧٥٫١٦ و58,940.5. ثم", ["وزنه 27.74 رطلا و٧٥٫١٦ و58,940.5.", "ثم"]),
        ("في م. س. ص. 204 كذا. ثم", ["في م. س. ص. 204 كذا.", "ثم"]),
        ("سنة 327 هـ. وقرأ", ["سنة 327 هـ.", "وقرأ"]),
        ("خبرا طويلا ... ولم يتمه. ثم... كان… قال", ["خبرا طويلا ... ولم يتمه.", "ثم...", "كان…", "قال"]),
        ("أول.ثان", ["أول.", "ثان"]),
        ("سطر\nتال. آخر\n\nفقرة", ["سطر\nتال.", "آخر", "فقرة"]),
        ("فقرة\r\n \r\nأخرى", ["فقرة", "أخرى"]),
        ("24- زيد بن عمرو، مات. كان", ["24- زيد بن عمرو، مات.", "كان"]),
        ("12. Zayd came. He left.", ["12. Zayd came.", "He left."]),
        ("Dr. Zizi b. Hukaan, cf. vol. 26 p. 62, came. He left.", ["Dr. Zizi b. Hukaan, cf. vol. 26 p. 62, came.", "He left."]),
        ("It is at fol. 52 b. He came. See fol. 52 b", ["It is at fol. 52 b.", "He came.", "See fol. 52 b"]),
        ("By A. B. Zizi Jr. wrote so. He met X Jr. The end", ["By A. B. Zizi Jr. wrote so.", "He met X Jr.", "The end"]),
        ('He wrote that "X lied." in the margin. Under shelf.invalid/ms.86 too.', ['He wrote that "X lied." in the margin.', "Under shelf.invalid/ms.86 too."]),
        ("grain, etc. to Luhu, i.e. the year 5. So", ["grain, etc. to Luhu, i.e. the year 5.", "So"]),
        ("其墓在此。他说：“东。西！”后来去了。有人问：「何？」没有", ["其墓在此。", "他说：“东。西！”后来去了。", "有人问：「何？」没有"]),
        ("وہ گیا۔ پوچھا ”تم کون ہو؟“ اور رہا۔ بس", ["وہ گیا۔", "پوچھا ”تم کون ہو؟“ اور رہا۔", "بس"]),
        ("กาไป 87.61 ไมล์\nขามา ดาว", ["กาไป 87.61 ไมล์", "ขามา", "ดาว"]),
        ("an \"unclosed mark. Next one.", ["an \"unclosed mark.", "Next one."]),
        ("***\n\nx", ["***", "x"]),
    ],
)
def test_sentences(text, want):
    assert cut(text) == want


def test_starts_are_sorted_offsets():
    text = "  أول. ​ثان؟\n\n\tثالث"
    assert [text[a] for a in sentence_starts(text)] == ["أ", "​", "ث"]


def test_pieces_rebuild_the_text():
    word = "كلمة "
    texts = ["\n\n".join([word * 900] * 5), word * 5000, "x" * 30_000, ("y" * 8_999 + "\n\n") * 3, "  " + "a" * 9_000 + "  ", ". ".join(["جملة " * 400] * 30)]
    for text in texts:
        found = pieces(text)
        if len(text.strip()) <= 9_000:
            assert found == []
            continue
        whole = text[: found[0][1]]
        for (_, before, _), (a, b, _) in zip(found, found[1:]):
            assert a == before - 200
            whole += text[a + 200 : b]
        assert whole == text and all(b - a <= 9_000 for a, b, _ in found) and found[-1][1] == len(text)
    assert [c for *_, c in pieces(texts[2])][:-1] == ["char"] * 3 and pieces(texts[0])[0][2] == "paragraph"
    with pytest.raises(ValueError):
        pieces("x", 10, 10)


def test_finest():
    assert finest(boundaries("a" * 9_001)) == "char"
    assert finest(boundaries("كلمة " * 2_000)) == "word"
    assert finest(boundaries("جملة قصيرة. " * 2_000)) == "sentence"
    assert finest(boundaries("جملة قصيرة.\n\n" * 2_000)) == "paragraph"


def test_current_body_decides(spark):
    t = [dt.datetime(2026, 1, d) for d in (1, 2)]
    long, short = "كلمة " * 3_000, "قصير. جدا"
    rows = [("a", long, t[0], 1), ("a", short, t[1], 2), ("b", short, t[0], 3), ("b", long, t[1], 4), ("b", long, t[1], 4), ("c", None, t[0], 5), (None, long, t[0], 6), ("d", "", None, 7)]
    df = spark.createDataFrame(rows, "person_id string, text_body string, ingested_at timestamp, state int")
    assert [(r.person_id, r.finest) for r in cut_long(df).collect()] == [("b", "word")]
    got = sorted((r.person_id, r.start_pos) for r in sentences(df).collect() if r.person_id != "b")
    assert got == [("a", 0), ("a", 6)]
    assert cut_long(df.limit(0)).count() == 0 and sentences(df.limit(0)).count() == 0


def test_terminators_of_all_scripts():
    from silsila.llm.sentences import sentence_starts

    for mark in "\u07f9\u1735\u1b5a\u1c7e\ua60e\ua9c8\uaa5d\uabeb\u2e2e\U00011047\U00016af5":
        assert sentence_starts(f"abc def{mark} ghi jkl{mark}") == [0, 9], hex(ord(mark))


def test_abbreviations_of_the_paragraphs_language():
    cases = {
        "Siehe Nr. 5 und die Herren. Das ist gut.": 2, "El Sr. López llegó. La casa es grande.": 2, "Das ist vgl. Seite 5 und bzw. Herr Meier. Gut.": 2,
        "He lives in Washington D.C. The city grew.": 2, "Voir M. Dupont et la maison. Il est là.": 2, "The house of John Brown Sr. He left it.": 2, "See i.e. The book of J.R. Brown.": 1,
    }
    for text, n in cases.items():
        assert len(sentence_spans(text)) == n, text


def test_work_is_in_proportion_to_the_quotations():
    import time

    for text in ("He said «no. yes» and left. ", "He said „no. yes and left. ", "قال «لا. نعم» ثم مضى. "):
        began = time.perf_counter()
        assert len(sentence_spans(text * 8000)) >= 8000
        assert time.perf_counter() - began < 2
