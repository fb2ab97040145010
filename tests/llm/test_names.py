import datetime as dt

from silsila.llm.names import distance, finer_keys, firm_letters, keys_of, link_profiles, linked_entries, match, pack, profile, spelling, take_apart


def person(*names, kunya=None):
    variants = [take_apart(spelling(n)) for n in names]
    if kunya:
        variants.append(take_apart(spelling(kunya) + " "))
    return profile(pack(variants))


FULL = "زهوح بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي"


def test_apart():
    v = take_apart("الخطادعي، زهوح بن ميحث بن مسنان")
    assert (v.line, v.nisbas, v.female) == (("زهوح", "ميحث", "مسنان"), ("الخطادعي",), "0")
    v = take_apart("ام عبد الله هند بنت عبد الرزاق القرشي")
    assert (v.line, v.kunya, v.female, v.nisbas) == (("هند", "عبد الرزاق"), "عبد الله", "1", ("القرشي",))
    assert take_apart("ابن ميحث الخطادعي").line == ("", "ميحث") and take_apart("م. بن زيد").line == ("م", "زيد")
    assert take_apart("زهوح ميحث بن مسنان").line == ("زهوح", "ميحث", "مسنان") and take_apart("").line == ()


def test_distance():
    assert [distance("كتاب", x) for x in ("كتاب", "كتب", "كاتب", "كتابب", "قلم")] == [0, 1, 1, 1, 3]
    words = [a + b + c + d for a in ("", "x", "y") for b in ("x", "z") for c in ("y", "x", "") for d in ("z", "y", "")]
    assert all(min(distance(a, b, 2), 2) == distance(a, b, 1) for a in words for b in words)


def test_variants_of_one_person_match():
    base = person(FULL)
    for other in (
        "زهوح ابن ميحث بن مسنان بن تافوب بن غنوج الخطادعي", "زهوح ميحث بن مسنان بن غنوج الخطادعي", "الخطادعي، زهوح بن ميحث بن تافوب بن غنوج", "زهوج بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي",
        "زهوح بن ميحث بن مسنن بن تافوب بن غنوج الخطادعي", "ابو توذيش زهوح بن ميحث الخطادعي", "زهوح بن ميحث بن مسنان بن غنوج المعروف بالاعرج",
    ):
        assert match(base, person(other)) >= 100, other
    assert 0 < match(base, person("ز. بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي")) < 100


def test_relatives_and_namesakes_do_not():
    base = person(FULL, kunya="ابو توذيش")
    for other in (
        "ميحث بن مسنان بن تافوب بن غنوج الخطادعي", "طارق بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي", "زهوح بن ميحث بن غيلان بن رافع بن لطول الطتاقخي", "زهوح بنت ميحث بن مسنان بن تافوب بن غنوج الخطادعي",
        "زهوح بن سالم بن مسنان بن تافوب بن غنوج الخطادعي", "زهوح",
    ):
        assert match(base, person(other)) == 0, other
    assert match(base, person(FULL, kunya="ابو غيلان")) == 0


def test_blocks_meet():
    a, b = person(FULL, kunya="ابو توذيش"), person("زهوج بن ميحث بن مسنن بن تافوب بن غنوج الخطادعي", kunya="ابو توذيش")
    assert {k for k in keys_of(a) if k.inside} & {k for k in keys_of(b) if k.inside}


def meet(a, b):
    return any(x.key == y.key and (x.inside or x.part != y.part) for x in a for y in b)


def test_who_matches_in_a_crowded_block_meets_in_a_finer_one():
    people = [
        person(FULL), person("زهوح بن ميحث"), person("زهوح بن ميحث الخطادعي"), person("زهوح بن ميحث", kunya="ابو توذيش"), person("زهوح بن ميحث بن مسنان بن تافوب"),
        person("زهوح بن ميحث بن مسنان بن غنوج", kunya="ابو توذيش"), person("زهوح بن ميحث الخطادعي", kunya="ابو توذيش"), person("زهوح بن ميحث بن م. بن غنوج"), person("ابو توذيشي زهوح بن ميحث"),
    ]
    met = 0
    for i, a in enumerate(people):
        for b in people[:i]:
            if match(a, b):
                met += 1
                assert meet(finer_keys("of", a), finer_keys("of", b)), (a, b)
    assert met > 20
    # what cannot match need not meet
    assert not meet(finer_keys("of", person("زهوح بن ميحث الخطادعي")), finer_keys("of", person("زهوح بن ميحث الطتاقخي")))


def test_pet_forms():
    from silsila.llm.names import _pet_form

    for pet, name in (("ضعيص", "مضعاص"), ("تاهو", "عبد التليه"), ("سونو", "رستون"), ("رهيخ", "عبد الرهيخ"), ("فريث", "افيرثه"), ("ظحيج", "اظحج")):
        assert _pet_form(pet, name), pet
    assert not _pet_form("ظحيج", "اظهب") and not _pet_form("مضعاص", "ضعيص") and not _pet_form("تاهو", "تاهو")
    assert firm_letters("ذيصجان") == ("صجن",) and firm_letters("") == () and firm_letters("اوي") == ()


def test_a_father_left_out():
    grandson = person("زهوح بن طارق بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي")
    assert 0 < match(person(FULL), grandson) < 100
    assert match(person(FULL, kunya="ابو توذيش"), person("زهوح بن طارق بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي", kunya="ابو توذيش")) >= 100
    # cousins of one name
    assert match(person("زهوح بن سالم بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي"), grandson) == 0
    # one candidate is not enough where another is as good
    both = person(FULL, "زهوح بن طارق بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي")
    assert match(both, person("زهوح بن سالم بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي")) == 0


T0 = dt.datetime(2026, 1, 1)
SCHEMA = "person_id string, full_name_norm string, display_name_norm string, kunya string, ingested_at timestamp, id string, variants string"


def groups(spark, rows, **kw):
    df = spark.createDataFrame([(*r, T0, "x", None) for r in rows], SCHEMA)
    out = {}
    for r in linked_entries(df, **kw).collect():
        out.setdefault(r.group_id, set()).add(r.person_id)
    return sorted(map(sorted, out.values()))


def test_merge_and_rematch(spark):
    rows = [
        ("a:1:1-1", FULL, None, "ابو توذيش"), ("b:1:1-1", "زهوح بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي", None, None), ("c:1:1-1", None, "ز. بن ميحث الخطادعي", "ابو توذيش"),
        ("a:1:2-1", "طارق بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي", None, None), ("d:1:9-1", None, None, None), ("d:1:8-1", "", " ", None),
    ]
    assert groups(spark, rows) == [["a:1:1-1", "b:1:1-1", "c:1:1-1"], ["a:1:2-1"]]


def test_namesakes_of_one_book_are_not_linked(spark):
    rows = [(f"a:1:{i}-1", FULL, None, None) for i in range(40)] + [("b:1:1-1", FULL, None, None)]
    assert groups(spark, rows) == sorted([r[0]] for r in rows)
    # entries of other books under this spelling are still linked
    assert ["b:1:1-1", "c:1:1-1"] in groups(spark, [*rows, ("c:1:1-1", FULL, None, None)])


def test_ambiguous_weak_matches_stay_apart(spark):
    rows = [
        ("a:1:1-1", "زهوح بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي", None, None), ("b:1:1-1", "زذكان بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي", None, None),
        ("c:1:1-1", "ز. بن ميحث بن مسنان بن تافوب بن غنوج الخطادعي", None, None),
    ]
    assert groups(spark, rows) == [["a:1:1-1"], ["b:1:1-1"], ["c:1:1-1"]]
    assert ["a:1:1-1", "c:1:1-1"] in groups(spark, [rows[0], rows[2]])


def test_small_blocks_lose_nothing(spark):
    from silsila.llm import names as N  # noqa: F401

    rows = []
    for i in range(12):
        other = "بتثجحخدذرزسش"[i] * 3
        rows += [(f"a:1:{i}-1", f"زهوح بن ميحث بن {other} بن غنوج الخطادعي", None, f"ابو {other}ان"), (f"b:1:{i}-1", f"زهوح بن ميحث بن {other} بن غنوج الخطادعي الاخر", None, f"ابو {other}ان")]
    want = sorted([f"a:1:{i}-1", f"b:1:{i}-1"] for i in range(12))
    assert groups(spark, rows) == want and groups(spark, rows, block=4) == want


def test_empty(spark):
    assert groups(spark, []) == [] and link_profiles(spark.createDataFrame([], "person_id string, variants string")).count() == 0


def test_two_misspelled_parts_meet(spark):
    rows = [
        ("a:1:1-1", FULL, None, None), ("b:1:1-1", "زهوج بن ميحث بن غنوج الخطادعي", None, None),
        ("a:1:2-1", "طارقش بن لطولم بن رافعت بن سنجار القرشيني", None, None), ("b:1:2-1", "طارقس بن لطومل بن سنجار القرشيني", None, None),
    ]
    assert all(match(person(x[1]), person(y[1])) >= 100 for x, y in (rows[:2], rows[2:]))
    assert groups(spark, rows) == [["a:1:1-1", "b:1:1-1"], ["a:1:2-1", "b:1:2-1"]]


def test_names_one_edit_apart_share_a_shortened_one():
    from silsila.llm.names import shortened

    for other in ("كتب", "كاتب", "كتابب", "قتاب", "كتاب"):
        assert shortened("كتاب") & shortened(other)


def test_large_blocks_lose_nothing(spark):
    # beside own name and father, each pair has only a misspelled forefather in common
    fathers = ["مسنان", "تافوب", "غيلان", "لطولم", "رافعت", "سنجار"]
    ends = ["غنوج", "ضيهم", "توشط", "معور", "اشخه", "مفطت"]
    rows = [r for i, (g, e) in enumerate(zip(fathers, ends)) for r in ((f"a:1:{i}-1", f"زهوح بن ميحث بن {g} بن {e}", None, None), (f"b:1:{i}-1", f"زهوح بن ميحث بن {g[:3]}{g[4:]}", None, None))]
    want = sorted([f"a:1:{i}-1", f"b:1:{i}-1"] for i in range(len(fathers)))
    assert groups(spark, rows) == want and groups(spark, rows, block=2) == want


def test_many_tied_entries_become_one_group(spark):
    # every two spellings of this person, one in each book, score the same
    letters = "بتثجحخدذرزسشصضطظ"
    rows = [(f"b{i:02d}:1:1-1", f"زهوح بن ميحث بن مسن{c}ان بن تافوب بن غنوج الخطادعي", None, None) for i, c in enumerate(letters)]
    assert groups(spark, rows) == [sorted(r[0] for r in rows)]


def test_ties_merge_many_pairs_in_a_round(spark):
    from silsila.llm.names import _mutual

    tied = spark.createDataFrame([(a, b, 100) for b in range(32) for a in range(b)], "a long, b long, score int")
    assert _mutual(tied, False)[1] > 3


def test_crowded_blocks_give_the_same_groups(spark, data):
    persons = spark.read.parquet(f"{data}/persons.parquet")

    def found(block):
        out = {}
        for r in linked_entries(persons, block).collect():
            out.setdefault(r.group_id, []).append(r.person_id)
        return sorted(map(sorted, out.values()))

    assert found(64) == found(2)


def test_own_name_or_kunya_and_affiliation_alone(spark):
    rows = [
        ("a:1:1-1", FULL, None, "ابو توذيش"), ("b:1:1-1", None, "زهوح الخطادعي", None), ("c:1:1-1", None, "ابو توذيش الخطادعي", "ابو توذيش"), ("d:1:1-1", None, "زهوح الطتاقخي", None), ("d:1:2-1", None, None, "ابو توذيش"),
    ]
    assert groups(spark, rows) == [["a:1:1-1", "b:1:1-1", "c:1:1-1"], ["d:1:1-1"]]
    # two who fit as well
    rows = [("a:1:1-1", FULL, None, None), ("a:1:2-1", "زهوح بن طارق بن سالم بن رافع الخطادعي", None, None), ("b:1:1-1", None, "زهوح الخطادعي", None)]
    assert groups(spark, rows) == [["a:1:1-1"], ["a:1:2-1"], ["b:1:1-1"]]
