"""References, citations and relations as typed edges with an explicit outcome each."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folding import folded, folded_each
from ..functions.text import flatten, western_digits
from ..functions.vocab import Vocabulary
from ..session import materialize
from .lineage import overlap
from .relational import filter_or_keep, first_members, neighbors, unique_best

# --- fixed values --------------------------------------------------------------------------------------
CITES = "(ذكره|ذكرها|ذكر|قاله|قال|أخرجه|أخرج|رواه|روى|أورده|نقله|حكاه|وثقه|ضعفه)[ ]+([^.،؛]{2,45})"
POINTER = r"(يأتي|سيأتي|سيعاد|تقدم|تقدمت|تقدموا|تقدما|مضى|مضت|انظر)(?:\s+(?:نسبه|نسبها|ذكره|ذكرها|ذكر|أيضا|قريبا))?\s+(?:في|عند)\s+([^.،؛]{1,60})"
FORWARD = "يأتي|سيأتي|سيعاد|انظر"
QISM = {"الأول": 1, "الاول": 1, "الثاني": 2, "الثالث": 3, "الرابع": 4, "الأخير": 4, "الاخير": 4}
SECTION = {"الأسماء": "names", "الاسماء": "names", "الكنى": "kunya", "النساء": "women", "المبهمات": "mubhamat"}
LETTERS = (
    "الهمزة الألف الباء التاء الثاء الجيم الحاء الخاء الدال الذال الراء الزاي السين الشين الصاد الضاد الطاء الظاء العين الغين الفاء القاف الكاف اللام الميم النون الهاء الواو الياء"
).split()
RELATION = {
    "أبيه": "father", "أبيها": "father", "والده": "father", "والدها": "father", "جده": "grandfather", "جدها": "grandfather", "أخيه": "brother", "أخيها": "brother",
    "أخته": "sister", "ابنه": "son", "ابنها": "son", "ولده": "son", "زوجها": "husband", "زوجه": "wife", "أمه": "mother", "أمها": "mother", "عمه": "uncle", "عمها": "uncle",
}
COLLECTIVE = "آخرون|كثيرون|جماعة|غيرهم|خلق|جمع|غير واحد|وغيره"
MOST = 40
# -------------------------------------------------------------------------------------------------------


def _map(table: dict) -> Column:
    return F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])


def citations_in(df: DataFrame, flat: str, key: str, authorities: Vocabulary) -> DataFrame:
    """``key, authority_key, verb`` once each; matches and lookup stay in one native projection."""
    verbs = F.regexp_extract_all(flat, F.lit(CITES), F.lit(1))
    targets = F.regexp_extract_all(flat, F.lit(CITES), F.lit(2))
    hits = df.select(key, F.explode(F.arrays_zip(verbs.alias("verb"), targets.alias("target"))).alias("m")).select(key, "m.verb", "m.target")
    return hits.select(key, authorities.find_first("target").alias("authority_key"), "verb").where("authority_key is not null").distinct()


def text_references(df: DataFrame, text: str, key: str, most: int | None = MOST) -> DataFrame:
    """Pointers of each text, classified in order: adjacent, relation, number, qism, section, letter; at most ``most`` a text, or all."""
    flat = western_digits(flatten(text))
    zipped = F.arrays_zip(
        F.regexp_extract_all(flat, F.lit(POINTER), F.lit(1)).alias("verb"), F.regexp_extract_all(flat, F.lit(POINTER), F.lit(2)).alias("target"),
        F.regexp_extract_all(flat, F.lit(POINTER), F.lit(0)).alias("evidence"),
    )
    rows = df.select(key, F.posexplode(zipped).alias("pos", "m")).select(key, "pos", "m.verb", F.trim("m.target").alias("target"), F.left("m.evidence", F.lit(200)).alias("evidence"))
    t = F.col("target")
    relation = F.try_element_at(_map(RELATION), F.regexp_extract(t, r"^ترجمة\s+([^\s.،]{2,12})", 1))
    number = F.nullif(F.regexp_extract(t, r"^(?:ترجمة\s+)?(?:رقم\s*)?([0-9]{1,5})", 1), F.lit("")).cast("int")
    qism = F.try_element_at(_map(QISM), F.regexp_extract(t, r"^(?:(?:ال)?قسم\s+)?(الأول|الاول|الثاني|الثالث|الرابع|الأخير|الاخير)", 1))
    section = F.try_element_at(_map(SECTION), F.regexp_extract(t, r"^([^\s.،]{2,12})", 1))
    word = F.regexp_extract(t, r"^(?:حرف\s+)?([^\s.،]{2,12})", 1)
    letter = F.when(word.isin(*LETTERS), F.concat(F.lit("حرف "), word))
    offset = F.when(F.regexp_like(t, F.lit("^(?:الّ?ذي|التي)\\s+بعده")), 1).when(F.regexp_like(t, F.lit("^(?:الّ?ذي|التي)\\s+قبله")), -1)
    own = F.regexp_like(t, F.lit("^ترجمت[هها]"))
    kind = (
        F.when(own, F.lit(None)).when(offset.isNotNull(), "see_adjacent").when(relation.isNotNull(), "see_relation").when(number.isNotNull(), "see_entry")
        .when(qism.isNotNull(), "see_qism").when(section.isNotNull(), "see_section").when(letter.isNotNull(), "see_letter")
    )

    def only(name: str, value: Column) -> Column:
        return F.when(F.col("kind") == name, value)

    rows = rows.withColumn("kind", kind).where("kind is not null")
    rows = rows.select(
        key, "pos", "kind", F.when(F.regexp_like("verb", F.lit(FORWARD)), "forward").otherwise("backward").alias("direction"), "evidence",
        only("see_adjacent", offset).alias("offset"), only("see_relation", relation).alias("relation"), only("see_entry", number).alias("entry_number"),
        only("see_qism", qism).alias("qism"), only("see_section", section).alias("section"), only("see_letter", letter).alias("letter"),
    )
    same = ["kind", "offset", "relation", "entry_number", "qism", "section", "letter"]
    first = rows.groupBy(key, *same).agg(F.min(F.struct("pos", "direction", "evidence")).alias("f"))
    out = first.select(key, "f.pos", *same, "f.direction", "f.evidence")
    if most is None:
        return out
    return out.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).where(F.col("n") <= most).drop("n")


#: The relations whose bearer is a woman.
WOMEN = ("mother", "sister", "wife", "daughter")
FILTERS = ("section", "letter", "qism", "is_woman", "nisba_key")


def name_keys(index: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``norm, person_id``: every folded spelling under which a person of ``index`` can be looked up.

    Of ``index`` the columns ``display_name_norm, full_name_norm, kunya, ism, father`` and ``name_keys`` (an array) are
    taken as far as it has them: each by itself, and own name with father's name. ``names(person_id, form)`` adds variants.
    """
    have = set(index.columns)
    single = [F.col(c) for c in ("display_name_norm", "full_name_norm", "kunya", "ism") if c in have]
    if {"ism", "father"} <= have:
        single.append(F.when(F.col("ism").isNotNull() & F.col("father").isNotNull(), F.concat("ism", F.lit(" بن "), "father")))
    forms = F.array(*single)
    if "name_keys" in have:
        forms = F.concat(forms, F.coalesce("name_keys", F.array().cast("array<string>")))
    rows = index.select("person_id", F.explode(forms).alias("form"))
    if names is not None:
        rows = rows.unionByName(names.select("person_id", "form"))
    return rows.select(folded("form").alias("norm"), "person_id").where("norm != ''").distinct()


def name_tokens(name: Column) -> Column:
    """The names of a lineage, cut at the links."""
    return F.filter(F.transform(F.split(F.coalesce(name, F.lit("")), r"(?U)\s+بن\s+"), F.btrim), lambda n: n != "")


def resolve_names(wanted: DataFrame, keys: DataFrame, index: DataFrame, most: int = MOST) -> DataFrame:
    """Outcome of each ``wanted(ref_id, norm[, section, letter, qism, is_woman, nisba_key, chain])``.

    The full spelling is looked up; only where nobody has it, its first two names. Of several candidates those stay that
    pass all filters given, or all of them if none passes; then the one whose lineage shares the most of the chain's
    last four names decides, if no other shares as many. ``n_candidates`` counts all that are left, ``candidates``
    lists the first ``most``. ``index`` has ``person_id, section, letter, qism, is_woman, nisba_keys, tokens``.
    """
    for c in FILTERS:
        if c not in wanted.columns:
            wanted = wanted.withColumn(c, F.lit(None).cast("boolean" if c == "is_woman" else "int" if c == "qism" else "string"))
    if "chain" not in wanted.columns:
        wanted = wanted.withColumn("chain", F.lit(None).cast("array<string>"))
    tokens = name_tokens(F.col("norm"))
    asked = wanted.select("ref_id", "norm", F.when(F.size(tokens) > 1, F.concat_ws(" بن ", F.slice(tokens, 1, 2))).alias("short"))
    full = asked.join(keys, "norm").select("ref_id", "person_id")
    rest = asked.where("short is not null").join(full.select("ref_id").distinct(), "ref_id", "left_anti")
    short = rest.select("ref_id", F.col("short").alias("norm")).join(keys, "norm").select("ref_id", "person_id")
    about = index.select("person_id", *[F.col(c).alias(f"c_{c}") for c in ("section", "letter", "qism", "is_woman", "nisba_keys", "tokens")])
    found = full.unionByName(short).distinct().join(wanted.select("ref_id", *FILTERS, "chain"), "ref_id").join(about, "person_id")
    fits = F.lit(True)
    for c in ("section", "letter", "qism", "is_woman"):
        fits = fits & (F.col(c).isNull() | F.coalesce(F.col(c) == F.col(f"c_{c}"), F.lit(False)))
    fits = fits & (F.col("nisba_key").isNull() | F.coalesce(F.array_contains("c_nisba_keys", F.col("nisba_key")), F.lit(False)))
    found = filter_or_keep(found, ["ref_id"], fits)
    # read by each of the aggregates below
    scored = materialize(found.select("ref_id", "person_id", F.coalesce(overlap(F.col("chain"), F.col("c_tokens")), F.lit(0)).alias("score")))
    counts = scored.groupBy("ref_id").agg(F.count("*").alias("n"), F.min("person_id").alias("one"))
    best = unique_best(scored, ["ref_id"], "score", "person_id", 1).select("ref_id", F.col("person_id").alias("best"))
    several = scored.join(counts.where("n > 1").select("ref_id"), "ref_id", "left_semi").join(best, "ref_id", "left_anti")
    some = first_members(several, ["ref_id"], "person_id", most, "candidates")
    out = wanted.join(counts, "ref_id", "left").join(best, "ref_id", "left").join(some, "ref_id", "left")
    to = F.when(F.col("n") == 1, F.col("one")).otherwise(F.col("best"))
    left = F.when(to.isNotNull(), F.lit(1).cast("long")).otherwise(F.coalesce("n", F.lit(0).cast("long")))
    return out.select(
        *wanted.columns, to.alias("to_id"), to.isNotNull().alias("resolved"), (to.isNull() & (F.coalesce("n", F.lit(0)) > 1)).alias("ambiguous"),
        left.alias("n_candidates"), "candidates",
    )


def adjacent(index: DataFrame, bucket: Column | None = None) -> DataFrame:
    """``person_id, next_id, previous_id`` in the order of the book; ``bucket`` (coarse, monotone in ``doc_ord``) parts a large one."""
    rows = neighbors(index.select("book", "doc_ord", "person_id"), ["book"], ["doc_ord"], "person_id", bucket)
    return rows.select("person_id", F.col("next_person_id").alias("next_id"), F.col("previous_person_id").alias("previous_id"))


def _edges(rows: DataFrame, kind: Column, literal: Column, source: Column, evidence: Column, confidence: Column, relation: Column | None = None) -> DataFrame:
    """Resolved rows ``(from_id, to_id, resolved, ambiguous, candidates)`` as edges."""
    none = F.lit(None).cast("string")
    return rows.select(
        "from_id", "to_id", F.when(F.col("to_id").isNull(), literal).alias("to_literal"), kind.alias("type"), (none if relation is None else relation).alias("relation"),
        source.alias("source"), evidence.alias("evidence"), confidence.cast("double").alias("confidence"), "resolved", "ambiguous",
        F.when(F.col("ambiguous"), F.col("candidates")).alias("candidates"),
    )


def reference_edges(refs: DataFrame, index: DataFrame, keys: DataFrame, fathers: DataFrame | None = None, bucket: Column | None = None) -> DataFrame:
    """Edges of the pointers in texts, confidence 0.8.

    A number resolves to the one entry that bears it, an adjacent pointer to the neighbour in the book, a relation to
    the ``fathers(from_id, relation, to_id)`` edge of that relation, else to the father's or grandfather's name of the
    lineage. Pointers to a part, section or letter name no entry: they stay unresolved with what they name. ``index``
    has ``person_id, book, doc_ord, entry_number, father, grandfather, chain`` and what ``resolve_names`` needs.
    """
    by_number = index.groupBy("entry_number").agg(F.count("*").alias("n"), F.min("person_id").alias("one"))
    some = first_members(index.select("entry_number", "person_id"), ["entry_number"], "person_id", MOST, "candidates")
    numbered = refs.where("kind = 'see_entry'").join(by_number, "entry_number", "left").join(some, "entry_number", "left")
    by_entry = numbered.select(
        F.col("person_id").alias("from_id"), F.when(F.col("n") == 1, F.col("one")).alias("to_id"), F.coalesce(F.col("n") == 1, F.lit(False)).alias("resolved"),
        F.coalesce(F.col("n") > 1, F.lit(False)).alias("ambiguous"), "candidates", "kind", "relation", "evidence",
    )
    near = F.when(F.col("offset") == 1, F.col("next_id")).when(F.col("offset") == -1, F.col("previous_id"))
    none = F.lit(None).cast("array<string>").alias("candidates")
    beside = refs.where("kind = 'see_adjacent'").join(adjacent(index, bucket), "person_id", "left").select(
        F.col("person_id").alias("from_id"), near.alias("to_id"), near.isNotNull().alias("resolved"), F.lit(False).alias("ambiguous"), none, "kind", "relation", "evidence"
    )
    related = _relation_targets(refs.where("kind = 'see_relation'"), index, keys, fathers)
    parts = refs.where("kind in ('see_qism', 'see_section', 'see_letter')").select(
        F.col("person_id").alias("from_id"), F.lit(None).cast("string").alias("to_id"), F.lit(False).alias("resolved"), F.lit(False).alias("ambiguous"), none, "kind", "relation", "evidence"
    )
    rows = by_entry.unionByName(beside).unionByName(related).unionByName(parts)
    return _edges(rows, F.col("kind"), F.col("evidence"), F.lit("structural"), F.col("evidence"), F.lit(0.8), F.col("relation"))


def _relation_targets(refs: DataFrame, index: DataFrame, keys: DataFrame, fathers: DataFrame | None) -> DataFrame:
    refs = refs.withColumn("ref_id", F.concat_ws("#", "person_id", F.col("pos").cast("string")))
    if fathers is not None:
        known = fathers.where("to_id is not null").groupBy(F.col("from_id").alias("person_id"), "relation").agg(F.min("to_id").alias("edge_id"))
        refs = refs.join(known, ["person_id", "relation"], "left")
    else:
        refs = refs.withColumn("edge_id", F.lit(None).cast("string"))
    about = index.select("person_id", "father", "grandfather", "chain")
    named = refs.where("edge_id is null").join(about, "person_id")
    name = F.when(F.col("relation") == "father", F.col("father")).when(F.col("relation") == "grandfather", F.col("grandfather"))
    wanted = named.where(name.isNotNull()).select("ref_id", folded(name).alias("norm"), folded_each("chain").alias("chain"))
    found = resolve_names(wanted, keys, index).select("ref_id", "to_id", "ambiguous", "candidates")
    rows = refs.join(found, "ref_id", "left")
    to = F.coalesce("edge_id", "to_id")
    return rows.select(
        F.col("person_id").alias("from_id"), to.alias("to_id"), to.isNotNull().alias("resolved"), F.coalesce(F.col("ambiguous") & to.isNull(), F.lit(False)).alias("ambiguous"),
        "candidates", "kind", "relation", "evidence",
    )


def fact_edges(facts: DataFrame, index: DataFrame, keys: DataFrame) -> DataFrame:
    """Edges of narrators and kin named in ``facts(person_id, coll_path, pos, value, relation, source, evidence, confidence)``.

    Words for groups name nobody. A relation that only women bear asks for a woman.
    """
    kinds = {"narration.narrated_from": "narrated_from", "narration.narrated_to": "narrated_to", "life.family": "family"}
    kind = F.coalesce(*[F.when(F.col("coll_path") == p, F.lit(k)) for p, k in kinds.items()])
    rows = facts.where(F.col("coll_path").isin(*kinds) & F.col("value").isNotNull() & ~F.regexp_like("value", F.lit(COLLECTIVE)))
    rows = rows.select(
        F.concat_ws("#", "person_id", "coll_path", F.col("pos").cast("string")).alias("ref_id"), "person_id", kind.alias("type"), "value", "relation", "source", "evidence", "confidence"
    )
    chains = index.select("person_id", folded_each("chain").alias("chain"))
    woman = F.when((F.col("type") == "family") & F.col("relation").isin(*WOMEN), F.lit(True))
    wanted = rows.join(chains, "person_id", "left").select("ref_id", folded("value").alias("norm"), woman.alias("is_woman"), "chain")
    found = resolve_names(wanted, keys, index).select("ref_id", "to_id", "resolved", "ambiguous", "candidates")
    out = rows.join(found, "ref_id").withColumnRenamed("person_id", "from_id")
    relation = F.when(F.col("type") == "family", F.col("relation"))
    return _edges(out, F.col("type"), F.col("value"), F.col("source"), F.col("evidence"), F.col("confidence"), relation)


def all_edges(references: DataFrame, facts: DataFrame) -> DataFrame:
    """Pointers, narrators and kin as one table of edges."""
    return references.unionByName(facts)


def neighbour_pairs(edges: DataFrame, fathers: DataFrame) -> DataFrame:
    """``src, dst, type, source`` of all resolved edges, those by names of fathers as their own source."""
    own = edges.where("to_id is not null").select(F.col("from_id").alias("src"), F.col("to_id").alias("dst"), "type", "source")
    return own.unionByName(fathers.where("to_id is not null").select(F.col("from_id").alias("src"), F.col("to_id").alias("dst"), "type", F.lit("genealogy").alias("source"))).distinct()


def edge_stats(edges: DataFrame) -> DataFrame:
    """Edges by type with their outcomes."""
    out = F.when(F.col("resolved"), "resolved").when(F.col("ambiguous"), "ambiguous").otherwise("unresolved")
    return edges.groupBy("type").agg(F.count("*").alias("n_edges"), *[F.count_if(out == o).alias(o) for o in ("resolved", "ambiguous", "unresolved")])


def genealogy(index: DataFrame, keys: DataFrame, most: int = 5) -> DataFrame:
    """Father edges: the entries one of whose spellings is the child's father's name.

    The one whose chain shares the most of the child's last four names, if no other shares as many (0.7), else none
    (0.4): ambiguous where there were several. ``index`` has ``person_id, father, full_name, chain``.
    """
    children = index.where("father is not null").select(F.col("person_id").alias("from_id"), "father", "full_name", folded("father").alias("norm"), folded_each("chain").alias("own"))
    about = index.select("person_id", folded_each("chain").alias("chain"))
    pairs = children.select("from_id", "norm", "own").join(keys, "norm").where("from_id != person_id").join(about, "person_id")
    scored = materialize(pairs.select("from_id", "person_id", F.coalesce(overlap(F.col("own"), F.col("chain")), F.lit(0)).alias("score")))
    counts = scored.groupBy("from_id").agg(F.count("*").alias("n"))
    best = unique_best(scored, ["from_id"], "score", "person_id").select("from_id", F.col("person_id").alias("to_id"))
    some = first_members(scored.join(best, "from_id", "left_anti"), ["from_id"], "person_id", most, "candidates")
    out = children.join(counts, "from_id", "left").join(best, "from_id", "left").join(some, "from_id", "left")
    out = out.withColumns({"resolved": F.col("to_id").isNotNull(), "ambiguous": F.col("to_id").isNull() & (F.coalesce("n", F.lit(0)) > 1)})
    confidence = F.when(F.col("resolved"), 0.7).otherwise(0.4)
    return _edges(out, F.lit("family"), F.col("father"), F.lit("structural"), F.col("full_name"), confidence, F.lit("father"))


def two_steps(rows: DataFrame, node: str, parent: str, grandparent: str) -> DataFrame:
    """``node, parent, grandparent`` of the nodes whose parent is a node; the grandparent is null where it is none."""
    n = rows.select(node, parent)
    f = n.select(F.col(node).alias(parent), F.col(parent).alias(grandparent))
    g = n.select(F.col(node).alias(grandparent), F.lit(True).alias("__known"))
    out = n.join(f, parent).join(g, grandparent, "left")
    return out.select(node, parent, F.when(F.col("__known"), F.col(grandparent)).alias(grandparent))
