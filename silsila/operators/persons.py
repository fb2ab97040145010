"""Persons put together from their parts: records, index rows, features, names, identities, rollups.

A person's facts come as one long table (``person_id, coll_path, pos`` and fields); what is gathered for one person is
bounded by the person's own text.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.folding import fold, folded, folded_each
from ..functions.text import confidence, evidence_status, flatten
from ..functions.vocab import Vocabulary
from .lineage import identity_score
from .relational import first_members, unique_best

# --- fixed values -----------------------------------------------------------------------------------------
OFFICES = [("amir", ["أمير", "أمّره", "استعمله"]), ("qadi", ["قاض", "قاضي", "استقضاه"]), ("amil", ["عامل", "عمال"]), ("katib", ["كاتب", "كتب له"])]
DEATH_CAUSES = [
    ("battle", ["قتل في حرب", "قتل يوم", "استشهد", "قتل بأحد", "قتل ببدر"]), ("plague", ["طاعون", "عمواس"]), ("killed", ["قتل", "قتله"]), ("natural", ["وفاة", "مات", "توفي"]),
]
VERDICTS = [
    ("thiqa", ["ثقة"]), ("daif", ["ضعيف", "ضعفه"]), ("majhul", ["مجهول", "لا يعرف"]), ("mukhtalaf", ["مختلف فيه"]), ("not_companion", ["ليس بصحابي", "ليست له صحبة"]),
]
LARGE_NUMBERS, ABOUT = "ألف|مائة|مئة|ألفان", "نحو|أكثر من|كسر"
WOUND = "جرح|أصيب|رمي يوم"
AGES = {
    "at_death": r"(?:مات|توفي)[^.]{0,40}?(?:وهو ابن|وعمره|عن)\s+[^\s.،]{2,40}\s+سنة",
    "at_islam": r"أسلم[^.]{0,30}?(?:وهو ابن|وعمره)\s+[^\s.،]{2,30}\s+سنة",
}
FOUGHT = ("battle", "fitna", "ridda", "conquest", "sariyya")
DISPUTED = "قيل |ويقال |فقيل "
REFUTED = 4  # the part of entries that are listed in error
# ------------------------------------------------------------------------------------------------------------


def vocabulary(terms: list[tuple[str, list[str]]]) -> Vocabulary:
    """A small vocabulary, its keys and aliases folded."""
    return Vocabulary.of([(k, [k, *names]) for k, names in terms], fold)


def hadith_count(value: Column) -> Column:
    """``struct(value, count, uncertain)``: the first number in digits; uncertain where words for large numbers or "about" stand."""
    digits = F.regexp_extract(value, "([0-9]{1,5})", 1)
    unsure = F.regexp_like(value, F.lit(f"{LARGE_NUMBERS}|{ABOUT}"))
    return F.when(value.isNotNull(), F.struct(value.alias("value"), F.nullif(digits, F.lit("")).cast("int").alias("count"), unsure.alias("uncertain")))


def joined_fields(*fields: Column) -> Column:
    """The fields that are not empty, behind one another; what a vocabulary is looked up in, once folded."""
    return F.concat_ws(" ", *[F.nullif(f, F.lit("")) for f in fields])


def death_cause(text: Column | str) -> Column:
    """Key of the longest cause that the folded notes on a death name."""
    return vocabulary(DEATH_CAUSES).resolve(text)


def office_role(text: Column | str) -> Column:
    """Key of the role that an office's folded role and value name."""
    return vocabulary(OFFICES).resolve(text)


def verdict_keys(text: Column | str) -> Column:
    """Keys of all verdicts that a folded text names."""
    return vocabulary(VERDICTS).find_all(text)


def wounds(text: Column | str) -> Column:
    """The first word of a wound, as an array of at most one."""
    found = F.regexp_extract(flatten(text), f"({WOUND})", 1)
    return F.when(found != "", F.array(found)).otherwise(F.array().cast("array<string>"))


def ages(text: Column | str) -> Column:
    """``(kind, value)`` of the age at death and at conversion, where they are told."""
    flat = flatten(text)
    found = [F.struct(F.lit(kind).alias("kind"), F.left(F.regexp_extract(flat, f"({pattern})", 1), F.lit(120)).alias("value")) for kind, pattern in AGES.items()]
    return F.filter(F.array(*found), lambda a: a["value"] != "")


def gathered(facts: DataFrame, fields: list[str], key: str = "person_id") -> DataFrame:
    """``key, facts``: a map from each list to its objects in their order."""
    row = F.struct("coll_path", "pos", *fields)
    lists = facts.groupBy(key, "coll_path").agg(F.sort_array(F.collect_list(row)).alias("items"))
    return lists.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("coll_path", "items"))).alias("facts"))


def layered(model: DataFrame, patterns: DataFrame, key: str = "person_id") -> DataFrame:
    """Facts of the model where it answered for a person without an error, else those read by patterns.

    ``model(key, error, ..)`` and ``patterns(key, ..)`` have the same fields; ``layer`` names where a row comes from.
    """
    good = model.where("error is null").drop("error")
    rest = patterns.join(good.select(key).distinct(), key, "left_anti")
    return good.withColumn("layer", F.lit("llm")).unionByName(rest.withColumn("layer", F.lit("regex")), allowMissingColumns=True)


def chain_key(chain: Column | str) -> Column:
    """A lineage's folded names, one behind the other."""
    return F.array_join(F.filter(folded_each(chain), lambda n: n != ""), "|")


def facts_from(items_: DataFrame, body: str = "body") -> DataFrame:
    """Rows ``(.., value, evidence, source, <body>)`` as facts: trimmed, without a value dropped, with their confidence.

    ``normalized`` is the folded value. Confidence is that of the source and of whether the body holds the evidence.
    """
    value, evidence = F.btrim(F.coalesce(F.col("value").cast("string"), F.lit(""))), F.nullif(F.btrim("evidence"), F.lit(""))
    rows = items_.withColumns({"value": value, "evidence": evidence}).where("value != ''")
    status = evidence_status(body, "evidence")
    return rows.withColumns({"normalized": F.nullif(folded("value"), F.lit("")), "confidence": confidence(F.col("source"), status)}).drop(body)


def samples(persons: DataFrame, numbers: list[int], order: str = "person_id") -> DataFrame:
    """The entries with these numbers, and the first one that is listed in error."""
    refuted = persons.where(f"qism = {REFUTED}").orderBy(order).limit(1)
    return persons.where(F.col("entry_number").isin(*numbers)).unionByName(refuted)


def items(path: str, held: Column | str = "facts") -> Column:
    """The objects of one list of a gathered person, an empty array where there are none."""
    held = F.col(held) if isinstance(held, str) else held
    return F.coalesce(F.try_element_at(held, F.lit(path)), F.filter(F.flatten(F.map_values(held)), lambda x: F.lit(False)))


def records(base: DataFrame, facts: DataFrame, fields: list[str]) -> DataFrame:
    """One record for each row of ``base``: its columns as ``entry``, ``identity`` and ``classification``, and its facts.

    ``base`` has ``person_id, entry_number, is_ambiguous, volume, page_start, page_end, char_len, marker, display_name,
    display_name_norm, kunya, lineage_kunya, is_woman, section_type, lineage_woman, full_name, full_name_norm, ism, father, chain, nisba,
    confidence, qism, letter, death_year``. A person is a woman by section, lineage or extraction; the kunya is that of
    the lineage, else the extracted one. Persons without facts have empty lists.
    """
    held = gathered(facts, fields)
    none = F.expr(f"cast(map() as {held.schema['facts'].dataType.simpleString()})")
    rows = base.join(held, "person_id", "left").withColumn("facts", F.coalesce("facts", none))
    woman = (F.coalesce("section_type", F.lit("")) == "women") | F.coalesce("lineage_woman", F.lit(False)) | F.coalesce("is_woman", F.lit(False))
    return rows.select(
        "person_id", F.struct("entry_number", "is_ambiguous", "volume", "page_start", "page_end", "char_len", "marker").alias("entry"),
        F.struct(
            "display_name", "display_name_norm", F.coalesce(F.nullif("lineage_kunya", F.lit("")), F.nullif("kunya", F.lit(""))).alias("kunya"), woman.alias("is_woman"),
            F.struct("ism", "father", "chain", "nisba", "full_name", "full_name_norm", "confidence").alias("nasab"),
        ).alias("identity"), F.struct("qism", "section_type", "letter").alias("classification"), "death_year", "facts",
    )


def index_rows(found: DataFrame) -> DataFrame:
    """The row of each record that search, facets and the resolver read."""
    def keys(path: str, name: str = "key") -> Column:
        return F.filter(F.transform(items(path), lambda x: x[name]), lambda k: k.isNotNull() & (k != ""))

    nasab = F.col("identity.nasab")
    kunya = F.nullif(folded("identity.kunya"), F.lit(""))
    ism, father = (F.nullif(folded(nasab[c]), F.lit("")) for c in ("ism", "father"))
    return found.select(
        "person_id", "entry.entry_number", F.col("entry.is_ambiguous").alias("entry_number_is_ambiguous"), "identity.display_name", "identity.display_name_norm", nasab["full_name"].alias("full_name"),
        nasab["full_name_norm"].alias("full_name_norm"), "identity.kunya", nasab["nisba"].alias("nisba"), nasab["confidence"].alias("nasab_confidence"), "identity.is_woman", "classification.qism",
        "classification.section_type", "classification.letter", "entry.volume", "entry.page_start", "entry.page_end", "entry.char_len", F.col("death_year").alias("death_year_hijri"), F.col("entry.marker").alias("entry_marker"),
        keys("labels").alias("labels"), ism.alias("ism_norm"), father.alias("father_norm"), kunya.alias("kunya_norm"),
        F.filter(F.array("identity.display_name_norm", nasab["full_name_norm"], kunya, ism), lambda n: n.isNotNull() & (n != "")).alias("name_keys"),
        keys("life.battles").alias("battle_keys"), keys("life.events").alias("event_keys"), keys("life.residences").alias("place_keys"),
    )


def features(found: DataFrame, classified: DataFrame | None = None, coverage: DataFrame | None = None) -> DataFrame:
    """Counts and yes-or-no features of each record.

    ``classified(person_id, origin, flags)`` and ``coverage(person_id, label_coverage, n_unlabeled)`` add what is read from the
    text; a person that they lack has 0 and false.
    """
    kinds = F.transform(items("life.events"), lambda x: x["kind"])

    def any_kind(*names: str) -> Column:
        return F.exists(kinds, lambda k: F.coalesce(k.isin(*names), F.lit(False)))

    counts = {"n_events": "life.events", "n_battles": "life.battles", "n_family": "life.family", "n_offices": "life.offices"}
    out = found.select(
        "person_id", *[F.size(items(p)).alias(n) for n, p in counts.items()], any_kind(*FOUGHT).alias("fought"), (any_kind("wound") | (F.size(items("life.wounds")) > 0)).alias("wounded"),
        any_kind("martyrdom").alias("shahid"), any_kind("captivity").alias("captive"), F.col("death_year").isNotNull().alias("has_death_year"),
    )
    if classified is not None:
        def flag(name: str) -> Column:
            return F.coalesce(F.array_contains("flags", name), F.lit(False))

        told = classified.select("person_id", "origin", "flags")
        out = out.join(told, "person_id", "left").withColumns({
            "muhajir": F.coalesce(F.col("origin") == "muhajir", F.lit(False)), "ansari": F.coalesce(F.col("origin") == "ansari", F.lit(False)),
            "has_isnad": flag("has_isnad"), "n_isnads": flag("has_isnad").cast("int"), "name_disputed": flag("has_name_dispute"), "n_citations": F.lit(0),
        }).drop("origin", "flags")
    if coverage is not None:
        out = out.join(coverage.select("person_id", "label_coverage", F.col("n_unlabeled").alias("n_unlabeled_sents")), "person_id", "left").fillna(0, ["label_coverage", "n_unlabeled_sents"])
    return out


def name_forms(persons: DataFrame, facts: DataFrame) -> DataFrame:
    """``person_id, form, form_norm, kind, source``: every form of a name.

    Of ``persons(person_id, display_name, full_name, kunya)`` the names themselves; of the facts alternate names under
    their kind, and up to five forms (3 to 40 characters) behind each "it is said" of a note on a disputed name.
    """
    own = F.array(*[F.struct(F.col(c).alias("form"), F.lit(k).alias("kind"), F.lit("structural").alias("source")) for c, k in (("display_name", "display"), ("full_name", "full_nasab"), ("kunya", "kunya"))])
    rows = persons.select("person_id", F.explode(own).alias("n")).select("person_id", "n.form", "n.kind", "n.source")
    other = facts.where("coll_path = 'identity.alternate_names'").select("person_id", F.col("value").alias("form"), F.coalesce(F.nullif("kind", F.lit("")), F.lit("other")).alias("kind"), "source")
    bits = F.slice(F.split(F.coalesce("value", F.lit("")), DISPUTED), 2, 5)
    said = F.transform(bits, lambda b: F.btrim(F.regexp_replace(b, r"(?s)[،.].*$", "")))
    disputed = facts.where("coll_path = 'identity.name_dispute_notes'").select("person_id", F.explode(F.filter(said, lambda s: F.length(s).between(3, 40))).alias("form"), F.lit("dispute").alias("kind"), "source")
    every = rows.unionByName(other).unionByName(disputed).where("form is not null and form != ''")
    return every.select("person_id", "form", folded("form").alias("form_norm"), "kind", "source")


def identity_links(source: DataFrame, target: DataFrame, least: float = 0.7) -> DataFrame:
    """``from_id, to_id, score`` of the entries of two books that are one person, where one target wins alone.

    Both sides have ``person_id, display_name, ism, father, chain``; candidates share own name (the display name where
    there is none) and father.
    """
    def keyed(df: DataFrame, name: str) -> DataFrame:
        own = F.coalesce(F.nullif("ism", F.lit("")), F.nullif("display_name", F.lit("")))
        return df.select(F.col("person_id").alias(name), folded(F.concat_ws("|", own, F.nullif("father", F.lit("")))).alias("__key"), folded_each("chain").alias(f"chain_{name}"))

    pairs = keyed(source, "from_id").where("__key != ''").join(keyed(target, "to_id"), "__key").where("from_id != to_id")
    empty = F.array().cast("array<string>")
    score = identity_score(F.coalesce("chain_from_id", empty), F.coalesce("chain_to_id", empty))
    return unique_best(pairs.select("from_id", "to_id", score.alias("score")), ["from_id"], "score", "to_id", least)


def page_map(entries: DataFrame) -> DataFrame:
    """Where each entry stands in print; the source is ``pdf`` where a page of the scan is known."""
    have = set(entries.columns)
    scan = F.col("pdf_page") if "pdf_page" in have else F.lit(None).cast("int")
    return entries.select("person_id", "start_id", "end_id", "page_start", "page_end", scan.alias("pdf_page"), F.when(scan.isNotNull(), "pdf").otherwise("shamela").alias("source"))


def facet_counts(persons: DataFrame, facts: DataFrame) -> DataFrame:
    """``facet, key, n`` over ``persons(person_id, qism, letter, marker, entry_kind, origin, nisba)`` and their facts.

    Entries listed in error count only under part and kind.
    """
    kept = persons.where(f"qism is null or qism != {REFUTED}")
    def single(df: DataFrame, facet: str, key: Column) -> DataFrame:
        return df.select(F.lit(facet).alias("facet"), key.cast("string").alias("key"))

    parts = [single(persons, "qism", F.col("qism")), single(persons, "entry_kind", F.col("entry_kind")), single(kept, "letter", F.col("letter")), single(kept, "marker", F.coalesce(F.nullif("marker", F.lit("")), F.lit("none")))]
    parts += [single(kept, "origin", F.col("origin")), single(kept.select(F.explode("nisba").alias("nisba")), "nisba", F.col("nisba"))]
    of_facts = facts.join(kept.select("person_id"), "person_id", "left_semi")
    for facet, path, name in (("label", "labels", "key"), ("battle", "life.battles", "key"), ("event", "life.events", "kind")):
        parts.append(single(of_facts.where(F.col("coll_path") == path), facet, F.col(name)))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.where("key is not null and key != ''").groupBy("facet", "key").agg(F.count("*").alias("n"))


def rollups(persons: DataFrame, facts: DataFrame, ids: int = 40, exclude_refuted: bool = True) -> DataFrame:
    """``dimension, key, n_facts, n_persons, first_ids`` of battles, events, residences and places of death.

    Entries listed in error (``qism`` 4) are left out unless told otherwise; ``rollup_scope`` counts them.
    """
    kept = persons.where(f"qism is null or qism != {REFUTED}") if exclude_refuted else persons
    rows = facts.join(kept.select("person_id"), "person_id", "left_semi")
    key = (
        F.when(F.col("coll_path") == "life.battles", F.coalesce(F.nullif("key", F.lit("")), F.nullif("value", F.lit("")))).when(F.col("coll_path") == "life.events", F.col("kind"))
        .when(F.col("coll_path") == "life.residences", F.nullif("key", F.lit("")))
    )
    names = F.when(F.col("coll_path") == "life.battles", "battle").when(F.col("coll_path") == "life.events", "event").otherwise("residence")
    rows = rows.where(F.col("coll_path").isin("life.battles", "life.events", "life.residences")).select("person_id", names.alias("dimension"), key.alias("key"))
    if "death_place_key" in kept.columns:
        rows = rows.unionByName(kept.select("person_id", F.lit("death_place").alias("dimension"), F.nullif("death_place_key", F.lit("")).alias("key")))
    rows = rows.where("key is not null")
    counts = rows.groupBy("dimension", "key", "person_id").agg(F.count("*").alias("n"))
    totals = counts.groupBy("dimension", "key").agg(F.sum("n").alias("n_facts"), F.count("*").alias("n_persons"))
    return totals.join(first_members(counts, ["dimension", "key"], "person_id", ids, "first_ids"), ["dimension", "key"])


def rollup_scope(persons: DataFrame) -> DataFrame:
    """Persons that the rollups count, and those left out."""
    refuted = F.coalesce(F.col("qism") == REFUTED, F.lit(False))
    return persons.agg(F.count_if(~refuted).alias("persons_included"), F.count_if(refuted).alias("skipped_refuted"))
