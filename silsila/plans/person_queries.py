"""Records, index rows, features, names, identities and rollups over the driver's tables, each with its SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.folding import fold, folded
from ..functions.text import CONNECTIVE
from ..operators import biography as Y
from ..operators import labels as L
from ..operators import persons as P
from ..operators.current import current_rows
from ..operators.flatten import PERSON_LISTS, flatten_lists, pivot_fields
from .core_queries import _SPANS as SPANS_SQL
from .core_queries import _now, query, table
from .graph_queries import _key_sql
from .lineage_sql import BLANKS_SQL, facts_sql, flat_sql, folded as folded_sql

_FIELDS = ["value", "key", "kind", "source"]
_LISTS = ["life.battles", "life.events", "life.family", "life.offices", "life.residences", "life.wounds", "labels"]


def facts_of(spark, sf_dir, lists: list[str], fields: list[str] = _FIELDS) -> DataFrame:
    return pivot_fields(flatten_lists(table(spark, sf_dir, "persons"), "person_json", lists), fields)


def base_of(spark, sf_dir) -> DataFrame:
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", [
        "entry_number", "entry_number_is_ambiguous", "volume", "page_start", "page_end", "char_len", "entry_marker", "display_name", "display_name_norm", "kunya", "is_woman", "section_type", "full_name", "full_name_norm",
        "nisba", "nasab_confidence", "qism", "letter", "death_year_hijri",
    ]).drop("ingested_at")
    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["ism", "father", "chain"]).drop("ingested_at")
    renamed = {"entry_number_is_ambiguous": "is_ambiguous", "entry_marker": "marker", "nasab_confidence": "confidence", "death_year_hijri": "death_year"}
    return p.withColumnsRenamed(renamed).join(n, "person_id", "left").withColumns({"lineage_kunya": F.lit(None).cast("string"), "lineage_woman": F.lit(False)})


def _records(spark, sf_dir) -> DataFrame:
    return P.records(base_of(spark, sf_dir), facts_of(spark, sf_dir, _LISTS), _FIELDS)


_FACTS = f"f AS ({facts_sql(_LISTS, _FIELDS)})"
_PERSONS = f"p AS {_now('persons', '*')}"


def _count(path: str) -> str:
    return f"CAST(coalesce(count(*) FILTER (WHERE coll_path = '{path}'), 0) AS INTEGER)"


@query(f"""WITH {_PERSONS}, {_FACTS}, c AS (SELECT person_id, {', '.join(f"{_count(p)} AS {n}" for n, p in (('n_events', 'life.events'), ('n_battles', 'life.battles'), ('n_family', 'life.family'), ('n_offices', 'life.offices')))},
  coalesce(bool_or(coll_path = 'life.events' AND kind IN ('battle', 'fitna', 'ridda', 'conquest', 'sariyya')), false) AS fought, coalesce(bool_or(coll_path = 'life.events' AND kind = 'wound' OR coll_path = 'life.wounds'), false) AS wounded,
  coalesce(bool_or(coll_path = 'life.events' AND kind = 'martyrdom'), false) AS shahid, coalesce(bool_or(coll_path = 'life.events' AND kind = 'captivity'), false) AS captive FROM f GROUP BY 1)
SELECT p.person_id, coalesce(n_events, 0) AS n_events, coalesce(n_battles, 0) AS n_battles, coalesce(n_family, 0) AS n_family, coalesce(n_offices, 0) AS n_offices, coalesce(fought, false) AS fought, coalesce(wounded, false) AS wounded,
  coalesce(shahid, false) AS shahid, coalesce(captive, false) AS captive, death_year_hijri IS NOT NULL AS has_death_year FROM p LEFT JOIN c ON p.person_id = c.person_id""")
def person_features(spark, sf_dir):
    """Counts and yes-or-no features of every person."""
    return P.features(_records(spark, sf_dir))


def _agg(path: str) -> str:
    return f"coalesce((SELECT string_agg(key, ',' ORDER BY pos) FROM f WHERE f.person_id = p.person_id AND coll_path = '{path}' AND key IS NOT NULL AND key <> ''), '')"


@query(f"""WITH {_PERSONS}, n AS {_now('nasab', 'person_id, ism, father')}, {_FACTS}, k AS (SELECT person_id,
  {', '.join(f"coalesce(string_agg(key, ',' ORDER BY pos) FILTER (WHERE coll_path = '{path}' AND key IS NOT NULL AND key <> ''), '') AS {name}" for name, path in (('battle_keys', 'life.battles'), ('event_keys', 'life.events'), ('place_keys', 'life.residences'), ('labels', 'labels')))} FROM f GROUP BY 1),
x AS (SELECT p.*, nullif({folded_sql('n.ism')}, '') AS ism_norm, nullif({folded_sql('n.father')}, '') AS father_norm, nullif({folded_sql("nullif(p.kunya, '')")}, '') AS kunya_norm FROM p LEFT JOIN n ON p.person_id = n.person_id)
SELECT x.person_id, entry_number, display_name, display_name_norm, full_name, full_name_norm, nullif(kunya, '') AS kunya, coalesce(section_type = 'women', false) OR coalesce(is_woman, false) AS is_woman, qism, section_type, letter, volume,
  death_year_hijri, entry_marker, ism_norm, father_norm, kunya_norm, array_to_string(list_filter([display_name_norm, full_name_norm, kunya_norm, ism_norm], lambda y: y IS NOT NULL AND y <> ''), '|') AS name_keys,
  coalesce(battle_keys, '') AS battle_keys, coalesce(event_keys, '') AS event_keys, coalesce(place_keys, '') AS place_keys, coalesce(labels, '') AS labels FROM x LEFT JOIN k ON x.person_id = k.person_id""")
def index_rows(spark, sf_dir):
    """The index row of every person, put together from the entry, its lineage and its facts."""
    rows = P.index_rows(_records(spark, sf_dir))
    joined = [F.array_join(c, ",").alias(c) for c in ("battle_keys", "event_keys", "place_keys", "labels")]
    return rows.select(
        "person_id", "entry_number", "display_name", "display_name_norm", "full_name", "full_name_norm", "kunya", "is_woman", "qism", "section_type", "letter", "volume", "death_year_hijri", "entry_marker", "ism_norm",
        "father_norm", "kunya_norm", F.array_join("name_keys", "|").alias("name_keys"), *joined,
    )


_NAMES = ["identity.alternate_names", "identity.name_dispute_notes"]


@query(f"""WITH {_PERSONS}, f AS ({facts_sql(_NAMES, _FIELDS)}), r AS (
SELECT person_id, display_name AS form, 'display' AS kind, 'structural' AS source FROM p UNION ALL SELECT person_id, full_name, 'full_nasab', 'structural' FROM p UNION ALL SELECT person_id, kunya, 'kunya', 'structural' FROM p
UNION ALL SELECT person_id, value, coalesce(nullif(kind, ''), 'other'), source FROM f WHERE coll_path = 'identity.alternate_names'
UNION ALL SELECT * FROM (SELECT person_id, trim(regexp_replace(unnest(regexp_split_to_array(coalesce(value, ''), '{P.DISPUTED}')[2:6]), '(?s)[،.].*$', ''), ' ') AS form, 'dispute' AS kind, source FROM f WHERE coll_path = 'identity.name_dispute_notes') WHERE length(form) BETWEEN 3 AND 40)
SELECT person_id, form, {folded_sql('form')} AS form_norm, kind, source FROM r WHERE form IS NOT NULL AND form <> ''""")
def name_rows(spark, sf_dir):
    """Every form of every name: display, full, kunya, alternate names by kind, forms of disputed names."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["display_name", "full_name", "kunya"])
    return P.name_forms(p, facts_of(spark, sf_dir, _NAMES))


_SIDE = f"""s AS (SELECT p.person_id, split_part(p.person_id, ':', 1) AS book, {folded_sql("concat_ws('|', coalesce(nullif(ism, ''), nullif(display_name, '')), nullif(father, ''))")} AS k, list_transform(coalesce(chain, []), lambda y: {folded_sql('y')}) AS c
  FROM p LEFT JOIN n ON p.person_id = n.person_id)"""


@query(f"""WITH p AS {_now('persons', 'person_id, display_name')}, n AS {_now('nasab', 'person_id, ism, father, chain')}, {_SIDE},
q AS (SELECT a.person_id AS from_id, b.person_id AS to_id, CAST(round(least(1.0, 0.55 + 0.45 * CASE WHEN least(len(a.c), len(b.c)) > 0 THEN len(list_filter(a.c[-4:], lambda y: list_contains(b.c, y))) / least(len(a.c), len(b.c)) ELSE 0.5 END), 3) AS DOUBLE) AS score
  FROM s a JOIN s b ON a.k = b.k WHERE a.book = 'nawwara' AND b.book = 'zuhayla' AND a.k <> ''),
m AS (SELECT * FROM q WHERE score >= 0.7 QUALIFY rank() OVER (PARTITION BY from_id ORDER BY score DESC) = 1)
SELECT from_id, min(to_id) AS to_id, min(score) AS score FROM m GROUP BY 1 HAVING count(*) = 1""")
def identity_links(spark, sf_dir):
    """Persons of one book found in another by own name, father and lineage, where one candidate wins alone."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["display_name"]).drop("ingested_at")
    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["ism", "father", "chain"]).drop("ingested_at")
    side = p.join(n, "person_id", "left").withColumn("book", F.substring_index("person_id", ":", 1))
    return P.identity_links(side.where("book = 'nawwara'"), side.where("book = 'zuhayla'"))


@query(f"SELECT person_id, start_id, end_id, page_start, page_end, CAST(NULL AS INTEGER) AS pdf_page, 'shamela' AS source FROM {_now('raw', 'person_id, start_id, end_id, page_start, page_end')}")
def page_map(spark, sf_dir):
    return P.page_map(current_rows(table(spark, sf_dir, "raw"), "person_id", ["start_id", "end_id", "page_start", "page_end"]))


@query(f"""WITH {_PERSONS}, {_FACTS}, k AS (SELECT * FROM p WHERE qism IS NULL OR qism <> 4), g AS (SELECT f.* FROM f JOIN k ON f.person_id = k.person_id), u AS (
SELECT 'qism' AS facet, CAST(qism AS VARCHAR) AS key FROM p UNION ALL SELECT 'entry_kind', entry_kind FROM p UNION ALL SELECT 'marker', coalesce(nullif(entry_marker, ''), 'none') FROM k UNION ALL SELECT 'letter', letter FROM k
UNION ALL SELECT 'origin', section_type FROM k UNION ALL SELECT 'nisba', unnest(nisba) FROM k UNION ALL SELECT 'label', key FROM g WHERE coll_path = 'labels' UNION ALL SELECT 'battle', key FROM g WHERE coll_path = 'life.battles'
UNION ALL SELECT 'event', kind FROM g WHERE coll_path = 'life.events')
SELECT facet, key, count(*) AS n FROM u WHERE key IS NOT NULL AND key <> '' GROUP BY 1, 2""")
def facets_union(spark, sf_dir):
    """Counts of all nine facets; entries listed in error count only under part and kind. The section stands in for the origin."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["qism", "entry_kind", "entry_marker", "letter", "section_type", "nisba"])
    return P.facet_counts(p.withColumnsRenamed({"entry_marker": "marker", "section_type": "origin"}), facts_of(spark, sf_dir, _LISTS))


@query(f"""WITH {_PERSONS}, {_FACTS}, r AS (SELECT person_id, CASE coll_path WHEN 'life.battles' THEN 'battle' WHEN 'life.events' THEN 'event' ELSE 'residence' END AS dimension,
  CASE coll_path WHEN 'life.battles' THEN coalesce(nullif(key, ''), nullif(value, '')) WHEN 'life.events' THEN kind ELSE nullif(key, '') END AS key FROM f
  WHERE coll_path IN ('life.battles', 'life.events', 'life.residences') AND person_id IN (SELECT person_id FROM p WHERE qism IS NULL OR qism <> 4))
SELECT dimension, key, count(*) AS n_facts, count(DISTINCT person_id) AS n_persons, array_to_string((list_sort(list(DISTINCT person_id)))[1:40], ',') AS first_ids FROM r WHERE key IS NOT NULL GROUP BY 1, 2""")
def fact_rollups(spark, sf_dir):
    """Battles, events and residences counted, without entries listed in error."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["qism"])
    out = P.rollups(p, facts_of(spark, sf_dir, _LISTS))
    return out.withColumn("first_ids", F.array_join("first_ids", ","))


@query(f"SELECT count(*) FILTER (WHERE qism IS NULL OR qism <> 4) AS persons_included, count(*) FILTER (WHERE qism = 4) AS skipped_refuted FROM {_now('persons', 'person_id, qism')}")
def rollup_scope(spark, sf_dir):
    return P.rollup_scope(current_rows(table(spark, sf_dir, "persons"), "person_id", ["qism"]))


@query(f"""SELECT doc_id, nullif(regexp_extract(text, '([0-9]{{1,5}})', 1), '')::INTEGER AS n, regexp_matches(text, '{P.LARGE_NUMBERS}|{P.ABOUT}') AS uncertain FROM documents WHERE text IS NOT NULL""")
def number_with_doubt(spark, sf_dir):
    """The first number of each text and whether it is in doubt."""
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", P.hadith_count(F.col("text")).alias("c"))
    return d.select("doc_id", F.col("c.count").alias("n"), "c.uncertain")


def _resolved_sql(terms: list[tuple[str, list[str]]], x: str) -> str:
    """The key of the equal alias, else of the longest alias contained."""
    table_ = {fold(a): k for k, names in terms for a in [k, *names]}
    order = sorted(table_, key=lambda a: (-len(a), list(table_).index(a)))
    equal = " ".join(f"WHEN {x} = '{a}' THEN '{table_[a]}'" for a in order)
    held = " ".join(f"WHEN contains({x}, '{a}') THEN '{table_[a]}'" for a in order)
    return f"CASE {equal} {held} END"


_DEATH = ["life.death.notes", "life.offices", "narration.criticism"]


@query(f"""WITH f AS ({facts_sql(_DEATH, ['value', 'role'])}), v AS (SELECT person_id, coll_path, pos, {folded_sql("concat_ws(' ', nullif(role, ''), nullif(value, ''))")} AS t FROM f)
SELECT person_id, coll_path, pos, CASE coll_path WHEN 'life.offices' THEN {_resolved_sql(P.OFFICES, 't')} WHEN 'life.death.notes' THEN {_resolved_sql(P.DEATH_CAUSES, 't')} ELSE
  nullif(array_to_string(list_filter([{', '.join(f"CASE WHEN {' OR '.join(f'contains(t, {chr(39)}{fold(a)}{chr(39)})' for a in [k, *names])} THEN '{k}' END" for k, names in P.VERDICTS)}], lambda y: y IS NOT NULL), ','), '') END AS keys FROM v""")
def vocabulary_keys(spark, sf_dir):
    """Roles of offices, causes of death and verdicts named in the facts."""
    f = facts_of(spark, sf_dir, _DEATH, ["value", "role"])
    f = f.withColumn("t", folded(P.joined_fields(F.col("role"), F.col("value"))))
    order = F.array(*[F.lit(k) for k, _ in P.VERDICTS])
    listed = F.nullif(F.array_join(F.array_intersect(order, P.verdict_keys("t")), ","), F.lit(""))
    keys = F.when(F.col("coll_path") == "life.offices", P.office_role("t")).when(F.col("coll_path") == "life.death.notes", P.death_cause("t")).otherwise(listed)
    return f.select("person_id", "coll_path", "pos", keys.alias("keys"))


@query(f"""WITH f AS ({facts_sql(PERSON_LISTS, ['evidence', 'confidence'])}), c AS (SELECT evidence, TRY_CAST(confidence AS DOUBLE) AS confidence FROM f)
SELECT CASE WHEN evidence IS NULL OR evidence = '' THEN 'absent' WHEN confidence >= 0.85 THEN 'verified' WHEN confidence <= 0.6 THEN 'unverified' END AS status, count(*) AS n FROM c GROUP BY 1 HAVING status IS NOT NULL""")
def facts_evidence(spark, sf_dir):
    """Evidence tally of the facts in the nested records."""
    from ..operators import reports as A

    f = facts_of(spark, sf_dir, PERSON_LISTS, ["evidence", "confidence"])
    return A.evidence_tally(f.select("evidence", F.col("confidence").cast("double").alias("confidence")))


@query(f"SELECT * FROM ({facts_sql(PERSON_LISTS, ['value', 'kind', 'key', 'source', 'evidence', 'page', 'year_hijri', 'role', 'relation'])})")
def fact_values(spark, sf_dir):
    """The objects of all lists of the nested records with their fields."""
    return facts_of(spark, sf_dir, PERSON_LISTS, ["value", "kind", "key", "source", "evidence", "page", "year_hijri", "role", "relation"])


_BODIES = f"b AS {_now('raw', 'person_id, text_body')}"
_PASSAGES = f"""{_BODIES}, a AS (SELECT person_id, regexp_extract_all(coalesce(text_body, ''), '{SPANS_SQL}') AS a FROM b), e AS (SELECT person_id, unnest(a) AS piece, generate_subscripts(a, 1) AS i FROM a),
o AS (SELECT person_id, piece, sum(length(piece)) OVER (PARTITION BY person_id ORDER BY i) - length(piece) AS pos0 FROM e),
s AS (SELECT person_id, CAST(pos0 + length(piece) - length(regexp_replace(piece, '^{BLANKS_SQL}+', '')) AS BIGINT) AS a, regexp_replace(piece, '^{BLANKS_SQL}+|{BLANKS_SQL}+$', '', 'g') AS quote FROM o),
w AS (SELECT *, a + length(quote) AS z, {L.label_sql('quote')} AS label FROM s WHERE quote <> '' AND NOT regexp_full_match(quote, '[\\n.؟!]+'))"""


def _passages(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body"])
    return raw, L.passages(raw, "text_body", "person_id")


@query(f"WITH {_PASSAGES} SELECT label, count(*) AS n, CAST(sum(a) AS BIGINT) AS starts, CAST(sum(z) AS BIGINT) AS ends, CAST(sum(length(left(quote, 400))) AS BIGINT) AS quoted FROM w GROUP BY 1")
def passage_labels(spark, sf_dir):
    """Labelled passages of all entries by label, with their places."""
    _, spans = _passages(spark, sf_dir)
    return spans.groupBy("label").agg(F.count("*").alias("n"), F.sum("start").cast("long").alias("starts"), F.sum("end").cast("long").alias("ends"), F.sum(F.length("quote")).cast("long").alias("quoted"))


@query(f"""WITH {_PASSAGES}, t AS (SELECT b.person_id, length(coalesce(text_body, '')) AS char_len, coalesce(h, 0) AS h, coalesce(u, 0) AS u FROM b LEFT JOIN
  (SELECT person_id, sum(CASE WHEN label <> 'unlabeled' THEN z - a ELSE 0 END) AS h, count(*) FILTER (WHERE label = 'unlabeled') AS u FROM w GROUP BY 1) x ON b.person_id = x.person_id),
c AS (SELECT *, round(CAST(least(1.0, h / greatest(char_len, 1)) AS DECIMAL(20,10)), 4) AS cov FROM t)
SELECT CAST(sum(round(CAST(cov * char_len AS DECIMAL(20,6)), 0)) AS BIGINT) AS labelled_chars, CAST(sum(char_len) AS BIGINT) AS chars, CAST(sum(u) AS BIGINT) AS n_unlabeled,
  CAST(round(CAST(sum(round(CAST(cov * char_len AS DECIMAL(20,6)), 0)) AS DECIMAL(20,6)) / sum(char_len), 4) AS DOUBLE) AS coverage FROM c""")
def corpus_coverage(spark, sf_dir):
    """How much of all bodies has a label."""
    raw, spans = _passages(spark, sf_dir)
    return L.corpus_coverage(L.text_coverage(spans, raw, "person_id", "text_body"))


@query(f"""WITH p AS {_now('persons', 'person_id, entry_number, qism')} SELECT person_id, entry_number FROM p WHERE entry_number IN (7, 10, 5000) UNION ALL (SELECT person_id, entry_number FROM p WHERE qism = 4 ORDER BY person_id LIMIT 1)""")
def sample_entries(spark, sf_dir):
    """Pinned entries by number, and the first one listed in error."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["entry_number", "qism"])
    return P.samples(p, [7, 10, 5000]).select("person_id", "entry_number")


@query(f"""WITH n AS {_now('nasab', 'person_id, chain')} SELECT person_id, array_to_string(list_filter(list_transform(chain, lambda y: {folded_sql('y')}), lambda y: y <> ''), '|') AS chain_key FROM n WHERE chain IS NOT NULL""")
def chain_keys(spark, sf_dir):
    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["chain"]).where("chain is not null")
    return n.select("person_id", P.chain_key("chain").alias("chain_key"))


@query(f"""WITH c AS (SELECT DISTINCT * FROM citations), m AS (SELECT DISTINCT person_id FROM c WHERE extract_source = 'llm' AND confidence IS NOT NULL AND person_id IS NOT NULL)
SELECT person_id, authority, 'llm' AS layer FROM c WHERE extract_source = 'llm' AND confidence IS NOT NULL AND person_id IS NOT NULL
UNION ALL SELECT person_id, authority, 'regex' FROM c WHERE coalesce(extract_source, '') <> 'llm' AND person_id IS NOT NULL AND person_id NOT IN (SELECT person_id FROM m)""")
def layered_citations(spark, sf_dir):
    """Citations of the model where it answered for an entry, else those read by patterns; an answer without confidence is an error."""
    c = table(spark, sf_dir, "citations").distinct().where("person_id is not null")
    error = F.when(F.col("confidence").isNull(), F.lit("no confidence"))
    model = c.where("extract_source = 'llm'").select("person_id", error.alias("error"), "authority")
    return P.layered(model, c.where("coalesce(extract_source, '') != 'llm'").select("person_id", "authority")).select("person_id", "authority", "layer")


@query(f"""WITH c AS (SELECT DISTINCT * FROM citations), r AS (SELECT person_id, {_key_sql('text_body')} AS hay FROM {_now('raw', 'person_id, text_body')}),
v AS (SELECT c.person_id, trim(coalesce(authority, ''), ' ') AS value, nullif(trim(evidence, ' '), '') AS evidence, extract_source, hay FROM c LEFT JOIN r ON c.person_id = r.person_id WHERE trim(coalesce(authority, ''), ' ') <> ''),
k AS (SELECT *, {_key_sql('evidence')} AS needle FROM v), s AS (SELECT *, CASE WHEN evidence IS NULL THEN 'absent' WHEN length(needle) < 8 THEN 'too_short' WHEN contains(coalesce(hay, ''), needle) OR
  length(regexp_replace(needle, '{CONNECTIVE}', '')) >= 8 AND contains(coalesce(hay, ''), regexp_replace(needle, '{CONNECTIVE}', '')) THEN 'verified' ELSE 'unverified' END AS status FROM k)
SELECT person_id, value, nullif({folded_sql('value')}, '') AS normalized, evidence, CAST(CASE WHEN extract_source = 'regex' THEN 0.3 WHEN extract_source = 'structural' THEN 1.0 WHEN status = 'verified' THEN 0.9 WHEN status = 'unverified' THEN 0.55 ELSE 0.7 END AS DOUBLE) AS confidence FROM s""")
def built_facts(spark, sf_dir):
    """Authorities cited, as facts with the confidence that their evidence earns."""
    c = table(spark, sf_dir, "citations").distinct()
    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body"]).select("person_id", F.col("text_body").alias("body"))
    rows = c.select("person_id", F.col("authority").alias("value"), "evidence", F.coalesce("extract_source", F.lit("")).alias("source")).join(raw, "person_id", "left")
    return P.facts_from(rows).select("person_id", "value", "normalized", "evidence", "confidence")


_FILLS = {
    "nasab_parsed": "rejected_reason IS NULL", "nasab_multi_link": "link_count >= 2", "nisba": "len(nisba) > 0", "kunya": "kunya <> ''", "qism": "qism IS NOT NULL", "letter": "letter <> ''", "death_year": "death_year_hijri IS NOT NULL",
}
_FILL_LISTS = ["conversion", "companionship", "battles", "offices", "family", "residences", "traits", "events", "narrated_from", "narrated_to", "praise", "criticism", "defenses", "labels"]


def _path(name: str) -> str:
    return name if name == "labels" else f"narration.{name}" if name in ("narrated_from", "narrated_to", "praise", "criticism", "defenses") else f"life.{name}"


_FILL_SQL = _FILLS | {n: f"list_contains(lists, '{_path(n)}')" for n in _FILL_LISTS}
_FILL_SQL["any_life_fact"] = " OR ".join(f"list_contains(lists, 'life.{n}')" for n in ("conversion", "companionship", "battles", "family")) + " OR death_year_hijri IS NOT NULL"


@query(f"""WITH p AS {_now('persons', 'person_id, nisba, kunya, qism, letter, death_year_hijri')}, n AS {_now('nasab', 'person_id, link_count, rejected_reason')}, f AS ({facts_sql([_path(n) for n in _FILL_LISTS], ['value'])}),
l AS (SELECT person_id, list(DISTINCT coll_path) AS lists FROM f GROUP BY 1), x AS (SELECT p.*, n.link_count, n.rejected_reason, coalesce(lists, []) AS lists FROM p LEFT JOIN n ON p.person_id = n.person_id LEFT JOIN l ON p.person_id = l.person_id)
""" + " UNION ALL ".join(f"SELECT '{n}' AS field, CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS filled, count(*) AS total, CAST(round(CAST(count(*) FILTER (WHERE {c}) AS DECIMAL(18,6)) / count(*), 4) AS DOUBLE) AS fill_rate FROM x" for n, c in _FILL_SQL.items()))
def record_fill_rates(spark, sf_dir):
    """Fill rates of the records: lineage, classification, and every group of facts."""
    from ..operators import reports as A

    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["nisba", "kunya", "qism", "letter", "death_year_hijri"]).drop("ingested_at")
    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["link_count", "rejected_reason"]).drop("ingested_at")
    lists = flatten_lists(table(spark, sf_dir, "persons"), "person_json", [_path(x) for x in _FILL_LISTS], with_fields=False).groupBy("person_id").agg(F.collect_set("coll_path").alias("lists"))
    rows = p.join(n, "person_id", "left").join(lists, "person_id", "left")

    def has(name: str):
        return F.array_contains("lists", _path(name))

    predicates = {
        "nasab_parsed": F.col("rejected_reason").isNull(), "nasab_multi_link": F.col("link_count") >= 2, "nisba": F.size("nisba") > 0, "kunya": F.col("kunya") != "", "qism": F.col("qism").isNotNull(), "letter": F.col("letter") != "",
        "death_year": F.col("death_year_hijri").isNotNull(), **{x: has(x) for x in _FILL_LISTS},
        "any_life_fact": F.coalesce(has("conversion"), F.lit(False)) | F.coalesce(has("companionship"), F.lit(False)) | F.coalesce(has("battles"), F.lit(False)) | F.coalesce(has("family"), F.lit(False)) | F.col("death_year_hijri").isNotNull(),
    }
    return A.fill_rates(rows, predicates)


_FLAG = dict(Y.FLAGS)


@query(f"""WITH {_PASSAGES}, p AS {_now('persons', 'person_id')}, t AS (SELECT b.person_id, coalesce(text_body, '') AS t, length(coalesce(text_body, '')) AS char_len, coalesce(h, 0) AS h, coalesce(u, 0) AS u FROM b LEFT JOIN
  (SELECT person_id, sum(CASE WHEN label <> 'unlabeled' THEN z - a ELSE 0 END) AS h, count(*) FILTER (WHERE label = 'unlabeled') AS u FROM w GROUP BY 1) x ON b.person_id = x.person_id)
SELECT p.person_id, coalesce(regexp_matches(t, '{_FLAG['has_isnad']}'), false) AS has_isnad, coalesce(regexp_matches(t, '{_FLAG['has_name_dispute']}'), false) AS name_disputed,
  coalesce(CAST(round(CAST(least(1.0, h / greatest(char_len, 1)) AS DECIMAL(20,10)), 4) AS DOUBLE), 0.0) AS label_coverage, CAST(coalesce(u, 0) AS BIGINT) AS n_unlabeled_sents FROM p LEFT JOIN t ON p.person_id = t.person_id""")
def text_features(spark, sf_dir):
    """Features of every person that are read from the text: chains, disputed names, coverage by labels."""
    raw, spans = _passages(spark, sf_dir)
    flags = raw.select("person_id", F.lit("unknown").alias("origin"), Y.flags(F.coalesce("text_body", F.lit("")), F.lit(0)).alias("flags"))
    out = P.features(_records(spark, sf_dir), flags, L.text_coverage(spans, raw, "person_id", "text_body"))
    return out.select("person_id", "has_isnad", "name_disputed", "label_coverage", "n_unlabeled_sents")


@query(f"""WITH p AS {_now('persons', 'person_id, qism, is_woman, section_type')}, r AS {_now('raw', 'person_id, text_body, footnotes')}, t AS (SELECT p.*, coalesce(text_body, '') AS t, coalesce(len(footnotes), 0) AS notes FROM p LEFT JOIN r ON p.person_id = r.person_id)
SELECT person_id, array_to_string(list_filter([{', '.join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{n}' END" for n, p in Y.FLAGS)}, CASE WHEN notes > 3 THEN 'footnote_heavy' END], lambda y: y IS NOT NULL), ',') AS flags,
  CASE WHEN qism IN (1, 2) THEN 'sahabi' WHEN qism = 3 THEN 'mukhadram' ELSE 'unknown' END AS generation,
  CASE WHEN section_type = 'women' THEN 'women_section' WHEN is_woman AND regexp_matches(left(t, 250), 'بنت |وهي |أمها ') THEN 'grammar' WHEN is_woman THEN 'name' ELSE 'explicit' END AS gender_source FROM t""")
def entry_flags(spark, sf_dir):
    """Flags of every text, the generation of its part, and how a woman is told."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["qism", "is_woman", "section_type"]).drop("ingested_at")
    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body", "footnotes"]).drop("ingested_at")
    rows = p.join(raw, "person_id", "left")
    body = F.coalesce("text_body", F.lit(""))
    return rows.select(
        "person_id", F.array_join(Y.flags(body, F.coalesce(F.size("footnotes"), F.lit(0))), ",").alias("flags"), Y.generation(F.col("qism")).alias("generation"),
        Y.gender_source(F.coalesce("is_woman", F.lit(False)), F.col("section_type"), body).alias("gender_source"),
    )


@query(f"""WITH {_BODIES}, f AS (SELECT person_id, {flat_sql('text_body')} AS t FROM b)
SELECT person_id, nullif(regexp_extract(t, '({P.WOUND})', 1), '') AS wound, nullif(left(regexp_extract(t, '({P.AGES['at_death']})', 1), 120), '') AS at_death, nullif(left(regexp_extract(t, '({P.AGES['at_islam']})', 1), 120), '') AS at_islam FROM f""")
def wounds_and_ages(spark, sf_dir):
    """The wound and the ages that each entry tells."""
    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body"])
    rows = raw.select("person_id", P.wounds("text_body").alias("w"), P.ages("text_body").alias("a"))

    def age(kind: str):
        return F.try_element_at(F.filter("a", lambda x: x["kind"] == kind), F.lit(1))["value"].alias(kind)

    return rows.select("person_id", F.try_element_at("w", F.lit(1)).alias("wound"), age("at_death"), age("at_islam"))
