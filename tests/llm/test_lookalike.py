import datetime as dt
import itertools
import random

from silsila.llm.lookalike import ALIKE, Canonical, alike_pairs, alike_values, classes, member_counts, printed, representatives

C = Canonical(representatives({}))


def test_print_alike():
    pairs = [
        ("ﺑﻦ", "بن"), ("أ", "أ"), ("ئ", "ئ"), ("تخزیط", "تخزيط"), ("إلی", "إلى"), ("المذکور", "المذكور"), ("Ｈｅ", "He"), ("Vоl", "Vol"), ("٢٣", "۲۳"), ("a b", "a b"), ("a b", "a b"),
        ("x​﻿y­", "xy"), ("قا‌ل", "قال"), ("بن‌ عبد", "بن عبد"), ("أ‍ن", "أن"), ("بِّ", "بِّ"), ("เเม", "แม"), ("（８）", "(8)"), ("ﻻ", "لا"), ("a\r\nb", "a\nb"),
    ]
    for a, b in pairs:
        assert C(a) == C(b), (a, b)


def test_seen_to_differ():
    pairs = [
        ("علي", "على"), ("أن", "ان"), ("ة", "ه"), ("بَ", "ب"), ("بّ", "ب"), ("a  b", "a b"), ("a\nb", "a b"), ("٤", "۴"), ("ك", "ک"), ("شم‌س", "شمس"), ("لـمن", "لمن"), ("e", "é"), ("ب", "ت"), ("x²", "x2"), ("", " "), ("\ufdfa", "صلى الله عليه وسلم"),
    ]
    for a, b in pairs:
        assert C(a) != C(b), (a, b)
    assert C(None) is None and C("") == ""


def test_classes_are_transitive_and_ends_are_reached():
    groups = classes([("a", "b"), ("c", "d"), ("b", "c"), ("x", "y")])
    assert sorted(map(sorted, groups)) == [["a", "b", "c", "d"], ["x", "y"]]
    best = representatives({"о": 10, "o": 3})
    assert best["o"] == "о" and Canonical(best)("o") == Canonical(best)("о") == Canonical(best)("ο")
    for group in classes(ALIKE):
        forms = {C(x) for x in group}
        assert len(forms) == 1 and C(next(iter(forms))) == next(iter(forms))


def test_idempotent():
    rng = random.Random(1)
    letters = "abоеیيىکك‌‍ ـبتأأَ٢۲（a）"
    for _ in range(2_000):
        text = "".join(rng.choice(letters) for _ in range(8))
        assert printed(printed(text)) == printed(text) and C(C(text)) == C(text)


def test_pairs_against_brute_force(spark):
    t = [dt.datetime(2026, 1, d) for d in (1, 2)]
    values = ["بن علي", "بن علی", "ﺑﻦ علي", "بن على", None, "", "x", "х"]
    rows = [(f"p{i:02d}", values[i % len(values)], t[0], i) for i in range(40)] + [("p01", "old", dt.datetime(2025, 1, 1), 0), ("p03", "بن علي", t[1], 0), (None, "x", t[0], 0)]
    df = spark.createDataFrame(rows, "person_id string, display_name string, ingested_at timestamp, state int")
    now = {p: v for p, v, *_ in rows[:40]} | {"p03": "بن علي"}
    want = sorted((a, b) for a, b in itertools.combinations(sorted(now), 2) if now[a] and now[b] and now[a] != now[b] and C(now[a]) == C(now[b]))
    found = alike_pairs(alike_values([(df, ["display_name"])]), slice_rows=2)
    assert sorted((r.person_a, r.person_b) for r in found.collect()) == want and want
    assert alike_pairs(alike_values([(df.limit(0), ["display_name"])])).count() == 0
    assert member_counts(df, ["display_name"])["x"] == 6


def test_classes_count_copies_without_pairs(spark):
    import datetime as dt

    from silsila.llm.lookalike import alike_classes, alike_values

    t = dt.datetime(2026, 1, 1)
    rows = [(f"p{i}", t, "abc") for i in range(50)] + [("q", t, "аbc"), ("r", t, "other"), ("s", t, None), ("u", t, "")]
    df = spark.createDataFrame(rows, "person_id string, ingested_at timestamp, v string")
    got = {r.person_id: (r.n_variants, r.n_links) for r in alike_classes(alike_values([(df, ["v"])])).collect()}
    assert got == {**{f"p{i}": (2, 1) for i in range(50)}, "q": (2, 50), "r": (1, 0)}
    assert len({r.class_id for r in alike_classes(alike_values([(df, ["v"])])).collect()}) == 2
