import random

import pytest

from silsila.llm.quality import FIELDS, Reader, with_statistics

COMMON = {"ar": ["في", "من", "كان", "وكان", "قال", "بن"], "en": ["the", "of", "and", "he", "was"], "zh": ["于", "之", "他"]}
READER = Reader(COMMON)
PROSE = "وكان كاتبا لفلان على أهل المدينة فيما ذكر الراوي. وقد تقدم ذكر أخيه ويأتي ذكر عمه في موضعه. مات سنة خمس وخمسين وهو ابن ستين سنة."
NAMES = ["زيد بن علي", "خالد بن سعد", "عمرو", "بكر بن وائل", "طارق", "هند بنت عتبة", "سعيد", "حمزة بن نافع", "ليث", "أوس بن قيس"]


def kind(text):
    return READER.kind(READER.statistics(text))


@pytest.mark.parametrize(
    "text",
    [
        PROSE, PROSE * 20, PROSE.replace(".", ""), PROSE + "\n\n" + "\n".join(NAMES[:4]), "He came to the town and stayed there until his father died. " * 3 + "The scan is lost.", "لم يذكره.",
        "据星春所记，其宅距城92.18里。他善于写诗，尤爱月门。其墓在门春之北，至今尚存。", "وله شعر كثير في وصف الديار ... لم يذكره فلان في باب كذا وكذا\nوكان بينه وبين فلان مكاتبات كثيرة ... وزنه كما وجد في دفتر القوم\nشهد وقعة كذا مع أبيه وأخيه وعمه ... ثم عاد إلى أهله بعد زمن\nوكان كاتبا لفلان على المدينة زمنا ... ثم رجع إلى أهله فمات بها",
        PROSE + "\n_____\n(1) وقد تقدم ذكر أخيه.\n(2) ومن أين أخذ هذا القول؟", "他说<|endoftext|>25.46里。",
    ],
)
def test_prose(text):
    assert kind(text) == "prose"


@pytest.mark.parametrize("text", ["\n".join(NAMES), "فهرس الأسماء\n" + "\n".join(f"• {n}" for n in NAMES), "\n".join(f"{n} ........... {i}" for i, n in enumerate(NAMES)), "\n".join(f"{i}- {n}، {i * 3}، {i * 7}" for i, n in enumerate(NAMES)), "\n".join(f"{n.split()[0]}: معنى {i}" for i, n in enumerate(NAMES))])
def test_lists(text):
    assert kind(text) == "list"


@pytest.mark.parametrize("sep", ["|", ";", "\t"])
def test_tables(sep):
    assert kind("\n".join(sep.join(r) for r in [("رقم", "الاسم", "البلد"), ("1", "زيد", "مكة"), ("2", "", "12.5"), ("3", "بكر", "")])) == "table"


def test_other_tables():
    assert kind("\n".join(f"رقم={i}\nالاسم=زيد\nالبلد={i * 7}" for i in range(5))) == "table"
    assert kind("\n".join(f"{i:<16}{n:<16}{i * 3:<16}" for i, n in enumerate(["زيد", "بكر", "", "خالد", "سعد"]))) == "table"


def test_junk():
    rng = random.Random(3)
    broken = "".join(rng.choice("□■�") if rng.random() < 0.2 else c for c in PROSE)
    for text in (
        PROSE.encode().decode("latin-1"), PROSE.encode("cp1256", "ignore").decode("cp1252", "ignore"), broken, " ".join(rng.choice("ابتثجح") for _ in range(80)), "0 " * 60, "كلمة " * 50, "ه" * 80,
        " ".join("".join(rng.choice("bcdfghjklmn") for _ in range(9)) for _ in range(20)), "\n".join("".join(rng.choice("aB3xYz9+/Qw") for _ in range(76)) for _ in range(6)), "#$%<>{}|[]^" * 12, "قال زيد كذا وكذا. " * 30,
    ):
        assert kind(text) == "junk", text[:60]


def test_statistics():
    s = READER.statistics("وكان زيد. وكان زيد.\nكان؟\nكان؟")
    assert (s["n_words"], s["n_lines"], s["n_paragraphs"]) == (6, 3, 1) and s["common_words"] == pytest.approx(4 / 6) and s["end_mark_lines"] == 1.0 and s["duplicate_lines"] == pytest.approx(1 / 3)
    assert s["top_2gram"] > 0.5 and s["symbol_ratio"] > 0


def test_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n", "c"), (4, PROSE, "d"), (5, "\n".join(NAMES), "e"), (5, "\n".join(NAMES), "e"), (6, "س" * 40_000, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    got = [(r.doc_id, r.kind) for r in with_statistics(df, COMMON).orderBy("doc_id").collect()]
    assert got == [(1, None), (2, None), (3, None), (4, "prose"), (5, "list"), (5, "list"), (6, "junk")]
    assert with_statistics(df.limit(0), COMMON).count() == 0 and len(with_statistics(df, {}).columns) == len(FIELDS) + 2


def test_a_phrase_over_and_over_without_blanks():
    reader = Reader({"zh": ["的", "是"], "en": ["the", "of"]})
    phrase = "据海谷所记其宅距城十里"
    for text in (phrase * 20, (phrase + "，") * 20, (phrase + "。") * 20):
        assert reader.kind(reader.statistics(text)) == "junk"
    prose = "".join(chr(0x4E00 + (i * i * 7 + i * 13) % 3000) + ("。" if i % 17 == 16 else "") for i in range(400))
    s = reader.statistics(prose)
    assert reader.kind(s) == "prose" and s["n_words"] == 400 and 0.9 < s["mean_word_length"] <= 1.0
