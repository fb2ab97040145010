"""Facts of an entry by patterns, their classification and the person's labels, all as native expressions."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import flatten, length_class, parse_year, sentences
from ..functions.vocab import Vocabulary
from .structure import first_rule

# --- fixed values: cues of the fact groups, caps, kinds ------------------------------------------------
#: Group: (pattern a sentence must have, most facts).
SENTENCE_FACTS: dict[str, tuple[str, int]] = {
    "life.conversion": ("أسلم|إسلامه|هاجر|هجرته|بايع|بيعة", 8),
    "life.companionship": ("صحب|صحبة|رأى النبي|رأى رسول|وفد على|خدم", 8),
    "life.residences": ("سكن|نزل|استوطن|أقام ب", 5),
    "life.traits": ("كان (?:طويلا|قصيرا|شجاعا|فاضلا|زاهدا|كريما|جوادا|عابدا)|يخضب", 8),
    "life.offices": ("استعمله|ولاه|ولي |أمير|قاضي|عامل", 8),
    "narration.praise": ("ثقة|ثبت |فاضل|صدوق|من خيار|جليل", 8),
    "narration.criticism": ("لا يصح|لا يثبت|ضعيف|مجهول|وهم |غلط|تصحيف|ليست له صحبة", 10),
    "narration.defenses": ("والصواب|والصحيح|والمعتمد|وهذا وهم", 8),
    "identity.name_dispute_notes": ("اختلف(?:وا)? في اسمه|قيل اسمه|في اسمه أقوال", 6),
}
FAMILY = {"mother": "أمه|أمها", "father": "أبوه|أبوها", "brother": "أخوه|أخوها", "sister": "أخته|أختها", "wife": "زوجته|وامرأته", "husband": "زوجها", "son": "ابنه|ابنها", "daughter": "ابنته|ابنتها"}
MOST_FAMILY, MOST_NAMES, VALUE, EVIDENCE = 12, 25, 300, 400
GROUP_WORDS = "^(?:وغيره|وآخرون|جماعة|خلق|غير واحد|طائفة)"
CROSS = "يأتي|سيأتي|تقدم|تقدمت|مضى|انظر"
FLAGS = [
    ("has_isnad", r"ثنا |نا |أخبرنا |حدثنا |عن [^.\n]{2,40} عن "), ("has_name_dispute", "اختلف في اسمه|اختلفوا في اسمه|في اسمه أقوال|قيل اسمه"), ("has_author_voice", "قلت:"),
    ("has_poetry", "وقال (?:الشاعر|حسان)|من الطويل|من البسيط"), ("has_hadith_matn", "قال رسول|صلى الله عليه"),
]
INCIDENTS = [
    ("wound", "جرح|جريح|أصيب بسهم|رمي يوم"), ("captivity", "أسر|سبي|أسيرا"), ("martyrdom", "استشهد"), ("wufd", "وفد على|وفادته|في وفد"), ("sariyya", "سري[ةه]"),
    ("hijra", "هاجر إلى|هجرته إلى|قدم مهاجرا"), ("treaty", "صلح الحديبية|عقد الصلح|هادن"), ("bayah", "بايع|بيعة الرضوان"), ("siege", "حاصر|حصار"), ("marriage", "تزوج|زوجه النبي"),
    ("manumission", "أعتق|عتقه"), ("dream", "رأى في المنام|في النوم"), ("quran", "جمع القرآن|قرأ على|أقرأ"), ("letter_from_prophet", "كتب إليه النبي|كتاب رسول"),
    ("meeting", "لقي النبي|وفد على النبي|قدم على النبي"),
]
KINDS: dict[str, list[tuple[str, str]]] = {
    "conversion": [("hijra_habasha", "حبش"), ("hijra_madinah", "هاجر|هجرته|المدينة"), ("bayah", "بيع"), ("islam", "أسلم|إسلام|أسلمت")],
    "companionship": [("served", "خدم"), ("sent_by", "بعثه"), ("wrote_to", "كتب"), ("prayed_with", "صلى مع"), ("heard", "سمع"), ("saw", "رأى|رؤية|رآه"), ("accompanied", "صحب|صحبة")],
    "trait": [("physical", "طويلا|قصيرا|آدم|أبيض|أشقر|أسمر|جسيما|نحيفا|يخضب"), ("worship", "أعبد|يصوم|يصلي|زاهدا|تسبيح"), ("character", "شجاع|فاضل|كريم|جواد")],
    "criticism": [
        ("companionship_denied", "ليست له صحبة|ليس (?:من )?الصحابة|لا صحبة"), ("scribal_error", "تصحيف|غلط"), ("isnad_defect", "منقطع|مرسل|إسناد"),
        ("adala", "ضعيف|لا يثبت|لا يصح"), ("identity", "اسمه|وهم في اسم"),
    ],
    "alternate_name": [("jahili", "جاهلي|عبد شمس|عبد العزى"), ("prophetic_rename", "سماه رسول|فسمي"), ("kunya", "يكنى|كنيته|أبو ")],
}
OTHER_KIND = {"conversion": "first_arrival", "companionship": "claimed_only", "trait": "occupation", "criticism": "other", "alternate_name": "ism"}
FITNA = ("al_jamal", "siffin", "nahrawan", "karbala", "al_harra")
CONQUEST = ("fath_makkah", "fath_dimashq", "fath_misr", "fath_al_sham")
PART = "شهد|غزا|حضر|قاتل|يوم|كان في|قدم.*عام|استشهد"
# --------------------------------------------------------------------------------------------------------


def has(text: Column, pattern: str) -> Column:
    return F.regexp_like(text, F.lit(pattern))


def fact_groups(df: DataFrame, text: str, key: str, capped: bool = True) -> DataFrame:
    """``key, field, idx, value, evidence, source, confidence`` of every group, in one long table: the hub of the later stages.

    ``capped`` keeps the first facts of each group and the beginning of each value; without it all come out whole.
    """
    def first(hits: Column, most: int) -> Column:
        return F.slice(hits, 1, most) if capped else hits

    def fact(name: str):
        return _fact(name, capped)

    rows = df.select(key, sentences(text).alias("__s"), flatten(text).alias("__t"))
    groups = []
    for name, (pattern, most) in SENTENCE_FACTS.items():
        hits = first(_hits(pattern), most)
        groups.append(F.transform(F.array_distinct(hits), fact(name)))
    for relation, words in FAMILY.items():
        found = F.regexp_extract_all("__t", F.lit(rf"(?:{words})\s+([^.،؛:]{{3,60}})"), F.lit(1))
        groups.append(F.transform(first(F.array_distinct(found), MOST_FAMILY), fact(f"life.family:{relation}")))
    for name, words in (("narration.narrated_from", "روى عن|يروي عن"), ("narration.narrated_to", "روى عنه|وعنه")):
        found = F.flatten(F.transform(F.regexp_extract_all("__t", F.lit(rf"(?:{words})\s+([^.؛:]{{3,300}})"), F.lit(1)), name_list))
        groups.append(F.transform(first(F.array_distinct(found), MOST_NAMES), fact(name)))
    out = rows.select(key, F.explode(F.concat(*groups)).alias("f"))
    return out.select(key, "f.field", "f.idx", "f.value", "f.evidence", F.lit("regex").alias("source"), F.lit(0.3).alias("confidence"))


def _hits(pattern: str) -> Column:
    return F.filter("__s", lambda s: has(s, pattern))


def _fact(name: str, capped: bool = True):
    field, _, relation = name.partition(":")
    label = field if not relation else f"{field}.{relation}"
    return lambda v, i: F.struct(
        F.lit(label).alias("field"), i.alias("idx"), (F.left(v, F.lit(VALUE)) if capped else v).alias("value"), (F.left(v, F.lit(EVIDENCE)) if capped else v).alias("evidence")
    )


def name_list(text: Column) -> Column:
    """Names of a list: cut at commas and a leading "and", without lead words, 3 to 60 characters, no group words."""
    parts = F.transform(F.split(text, r"\s*[،,]\s*|\s+و(?=عن\s)|\s+وعن\s+"), lambda p: F.regexp_replace(F.btrim(p), r"^(?:و?عن|و)\s*", ""))
    return F.filter(parts, lambda p: F.length(p).between(3, 60) & ~has(p, GROUP_WORDS))


def years(text: Column, trigger: str) -> Column:
    """Distinct years behind a trigger, in order of mention."""
    phrases = F.regexp_extract_all(text, F.lit(rf"(?:{trigger})\s+سنة\s+([^.،؛:]{{1,40}})"), F.lit(1))
    return F.array_distinct(F.array_compact(F.transform(phrases, parse_year)))


def life_event(found: Column, chosen: Column) -> Column:
    """``struct(year_hijri, year_candidates, year_uncertain)``: candidates from 1 to 1500 and the chosen year, sorted."""
    kept = F.filter(found, lambda y: y.between(1, 1500))
    every = F.sort_array(F.array_distinct(F.array_compact(F.concat(kept, F.array(chosen)))))
    return F.struct(F.coalesce(chosen, F.try_element_at(every, F.lit(1))).alias("year_hijri"), every.alias("year_candidates"), (F.size(every) > 1).alias("year_uncertain"))


def fact_kind(group: str, value: Column) -> Column:
    return first_rule(KINDS[group], value, OTHER_KIND[group])


def entry_kind(qism: Column, size: Column, text: Column) -> Column:
    cross = has(text, CROSS)
    return (
        F.when(qism == 4, "qism4_refutation").when((size < 150) & ~cross, "name_only").when((size < 400) & cross & has(text, "كنى"), "kunya_redirect")
        .when((size < 400) & cross, "crossref_stub").otherwise("biography")
    )


def flags(text: Column, n_notes: Column) -> Column:
    return F.array_compact(F.array(*[F.when(has(text, p), F.lit(n)) for n, p in FLAGS], F.when(n_notes > 3, F.lit("footnote_heavy"))))


def companionship_status(qism: Column) -> Column:
    return F.when(qism == 1, "established").when(qism == 2, "vision_or_birth").when(qism == 3, "mukhadram").when(qism == 4, "listed_in_error").otherwise("disputed")


def generation(qism: Column) -> Column:
    return F.when(qism.isin(1, 2), "sahabi").when(qism == 3, "mukhadram").otherwise("unknown")


def origin(text: Column, keys: Column) -> Column:
    def any_of(*names: str) -> Column:
        return F.exists(keys, lambda k: k.isin(*names))

    helper, emigrant = has(text, "الأنصار|أنصاري"), has(text, "هاجر|المهاجر")
    return (
        F.when(any_of("ansari", "khazraji", "awsi"), "ansari").when((has(text, "المهاجر|هاجر إلى|من المهاجرين") | any_of("qurashi")) & helper, "ansari")
        .when(emigrant, "muhajir").when(helper, "ansari").when(F.size(keys) > 0, "other").otherwise("unknown")
    )


def free_status(text: Column, keys: Column) -> Column:
    return F.when(F.array_contains(keys, "mawla") | has(F.left(text, F.lit(400)), "مولى "), "mawla").otherwise("unknown")


def gender_source(is_woman: Column, section: Column, text: Column) -> Column:
    grammar = has(F.left(text, F.lit(250)), "بنت |وهي |أمها ")
    return F.when(section == "women", "women_section").when(is_woman & grammar, "grammar").when(is_woman, "name").otherwise("explicit")


def battle_kind(key: Column) -> Column:
    return F.when(key.isin(*FITNA), "fitna").when(key == "riddah", "ridda").when(key.isin(*CONQUEST), "conquest").when(key == "hudaybiya", "treaty").otherwise("battle")


def events(text: Column, battles: Vocabulary, source: str = "regex", confidence: float = 0.3) -> Column:
    """Battles of the vocabulary (only where a cue of taking part stands anywhere), then one event for each incident rule."""
    def event(kind: Column, key: Column, value: Column) -> Column:
        return F.struct(kind.alias("kind"), key.alias("key"), value.alias("value"), F.lit(source).alias("source"), F.lit(confidence).alias("confidence"))

    none = F.lit(None).cast("string")
    fought = F.transform(F.when(has(text, PART), battles.find_all(text)).otherwise(F.array().cast("array<string>")), lambda k: event(battle_kind(k), k, k))
    incidents = F.array_compact(F.array(*[F.when(has(text, p), event(F.lit(k), none, F.regexp_extract(text, f"({p})", 1))) for k, p in INCIDENTS]))
    both = F.concat(fought, incidents)
    same = F.transform(both, lambda e: F.concat_ws("|", e["kind"], F.coalesce(e["key"], e["value"])))
    return F.filter(both, lambda e, i: F.array_position(same, F.concat_ws("|", e["kind"], F.coalesce(e["key"], e["value"]))) == i + 1)


@dataclass(frozen=True)
class LabelRule:
    key: str
    source: str
    confidence: float
    when: str


#: Person labels: structural ones are certain, those from patterns are not.
LABELS = [
    LabelRule("added", "structural", 1.0, "entry_marker is not null"), LabelRule("qism4", "structural", 1.0, "qism = 4"), LabelRule("woman", "structural", 1.0, "is_woman"),
    LabelRule("muhajir", "structural", 1.0, "origin = 'muhajir'"), LabelRule("ansari", "structural", 1.0, "origin = 'ansari'"),
    LabelRule("qurashi", "structural", 1.0, "array_contains(tribe_keys, 'qurashi')"), LabelRule("mawla", "structural", 1.0, "status = 'mawla'"),
    LabelRule("name_disputed", "regex", 0.3, "array_contains(flags, 'has_name_dispute')"), LabelRule("has_isnad", "regex", 0.3, "array_contains(flags, 'has_isnad')"),
    LabelRule("mukthir", "regex", 0.3, "is_prolific"), LabelRule("badi", "regex", 0.3, "exists(events, e -> e.key = 'badr')"),
    LabelRule("shahid", "regex", 0.3, "exists(events, e -> e.kind = 'martyrdom')"), LabelRule("qadi", "regex", 0.3, "array_contains(roles, 'qadi')"),
    LabelRule("fought", "regex", 0.3, "exists(events, e -> e.kind in ('battle', 'fitna', 'ridda', 'conquest'))"),
]


def person_labels() -> Column:
    """Labels of a row with the columns the rules name."""
    return F.array_compact(F.array(*[F.when(F.expr(r.when), F.struct(F.lit(r.key).alias("key"), F.lit(r.source).alias("source"), F.lit(r.confidence).alias("confidence"))) for r in LABELS]))


def classified(df: DataFrame, text: str, tribes: Vocabulary, battles: Vocabulary) -> DataFrame:
    """Rows ``(qism, is_woman, section_type, nisba, entry_marker, footnotes)`` with kind, flags, status, origin, events and labels."""
    body = F.coalesce(F.col(text), F.lit(""))
    keys = F.array_distinct(F.concat(F.array_compact(F.transform(F.coalesce("nisba", F.array().cast("array<string>")), tribes.resolve)), tribes.find_all(F.left(body, F.lit(500)))))
    out = df.withColumn("char_len", F.length(body)).withColumn("tribe_keys", keys)
    out = out.withColumns({
        "length_class": length_class("char_len"), "kind": entry_kind(F.col("qism"), F.col("char_len"), body),
        "flags": flags(body, F.coalesce(F.size("footnotes"), F.lit(0))), "companionship_status": companionship_status(F.col("qism")), "generation": generation(F.col("qism")),
        "origin": origin(body, F.col("tribe_keys")), "status": free_status(body, F.col("tribe_keys")), "gender_source": gender_source(F.coalesce("is_woman", F.lit(False)), F.col("section_type"), body),
        "events": events(flatten(body), battles), "is_prolific": has(body, "المكثرين|أكثر من الرواية"), "roles": F.array_compact(F.array(F.when(has(body, "قاض"), F.lit("qadi")))),
    })
    return out.withColumn("labels", person_labels())


def merged_chunks(rows: DataFrame, key: str, order: str, scalars: list[str], flags_: list[str], lists: list[str]) -> DataFrame:
    """Partial records of one key in order: first scalar that is known, any flag, lists joined without repeats."""
    out = rows.groupBy(key).agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in scalars], *[F.bool_or(c).alias(c) for c in flags_],
        *[F.sort_array(F.collect_list(F.struct(order, c))).alias(f"__{c}") for c in lists],
    )
    return out.select(key, *scalars, *flags_, *[F.array_distinct(F.flatten(_lists(c))).alias(c) for c in lists])


def _lists(c: str) -> Column:
    return F.transform(f"__{c}", lambda x: F.coalesce(x[c], F.array().cast("array<string>")))


def name_rows(persons: DataFrame, key: str = "person_id") -> DataFrame:
    """``key, form, kind`` of every name form of a person once: display, full and kunya; null and blank forms give no row."""
    forms = F.array(*[F.struct(F.btrim(F.col(c)).alias("form"), F.lit(k).alias("kind")) for c, k in (("display_name", "display"), ("full_name", "full"), ("kunya", "kunya"))])
    rows = persons.select(key, F.explode(forms).alias("n")).select(key, "n.form", "n.kind")
    return rows.where("form is not null and form != ''").distinct()


def dispute_forms(note: Column) -> Column:
    """Up to five candidate forms (3 to 40 characters) of a note on a disputed name."""
    parts = F.split(F.regexp_replace(note, "^.*?(?:اختلف(?:وا)? في اسمه|قيل اسمه)", ""), r"\s*(?:فقيل|وقيل|ويقال|[،؛.])\s*")
    return F.slice(F.filter(F.transform(parts, F.btrim), lambda p: F.length(p).between(3, 40)), 1, 5)


def fact_counts(facts: DataFrame, key: str = "person_id") -> DataFrame:
    """Facts and persons of each list."""
    per = facts.groupBy("coll_path", key).agg(F.count("*").alias("n"))
    return per.groupBy("coll_path").agg(F.sum("n").alias("n_facts"), F.count("*").alias("n_persons"), F.max("n").alias("most"))


def span_gaps(spans: DataFrame, lengths: DataFrame, key: str = "person_id") -> DataFrame:
    """Spans of a text without those that overlap an earlier one, and the gaps between them as spans labelled ``gap``."""
    from pyspark.sql import Window

    order = Window.partitionBy(key).orderBy("start", "end")
    reach = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = spans.withColumn("__reach", reach).where(F.col("start") >= F.col("__reach"))
    before = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = kept.withColumn("__before", before)
    gaps = kept.where("start > __before").select(key, F.col("__before").alias("start"), F.col("start").alias("end"), F.lit("gap").alias("label"))
    ends = kept.groupBy(key).agg(F.max("end").alias("__last"))
    tails = lengths.join(ends, key, "left").select(key, F.coalesce("__last", F.lit(0)).alias("start"), F.col("length").alias("end"), F.lit("gap").alias("label")).where("`start` < `end`")
    return kept.select(key, "start", "end", "label").unionByName(gaps).unionByName(tails)
