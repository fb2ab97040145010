"""Names resolved to entries and typed edges, over the driver's tables, each with the SQL it must equal."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.folding import folded, folded_each
from ..operators import graph as G
from ..operators import reports as A
from ..operators.current import current_rows
from ..session import materialize
from .core_queries import _now, query, table
from .lineage_sql import facts_sql, flat_sql, folded as folded_sql, squeezed_sql


def index_of(spark, sf_dir) -> DataFrame:
    """What names are resolved against: one row for each current entry, written once for all that reads it."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["entry_number", "display_name_norm", "full_name_norm", "kunya", "qism", "section_type", "letter", "is_woman", "nisba"])
    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["ism", "father", "grandfather", "chain"]).drop("ingested_at")
    name = F.coalesce(F.nullif("full_name_norm", F.lit("")), F.col("display_name_norm"))
    return materialize(p.drop("ingested_at").join(n, "person_id", "left").select(
        "person_id", "entry_number", "display_name_norm", "full_name_norm", "kunya", "ism", "father", "grandfather", "chain", "qism", F.col("section_type").alias("section"), "letter", "is_woman",
        F.col("nisba").alias("nisba_keys"), folded_each(G.name_tokens(name)).alias("tokens"), F.col("full_name_norm").alias("full_name"), F.substring_index("person_id", ":", 1).alias("book"),
        F.struct(F.coalesce("entry_number", F.lit(2**31 - 1)).alias("n"), "person_id").alias("doc_ord"),
    ))


def _keys(index: DataFrame) -> DataFrame:
    return materialize(G.name_keys(index))


def _tokens_sql(x: str) -> str:
    return rf"list_filter(list_transform(regexp_split_to_array(coalesce({x}, ''), '\s+بن\s+'), lambda t: trim(t)), lambda t: t <> '')"


_FOLD_EACH = "list_transform(chain, lambda y: {})".format(folded_sql("y"))
INDEX_SQL = f"""
p AS {_now('persons', 'person_id, entry_number, display_name_norm, full_name_norm, kunya, qism, section_type, letter, is_woman, nisba')},
n AS {_now('nasab', 'person_id, ism, father, grandfather, chain')},
i AS (SELECT p.person_id, entry_number, display_name_norm, full_name_norm, kunya, ism, father, grandfather, {_FOLD_EACH} AS chain, qism, section_type AS section, letter, is_woman, nisba,
        list_transform({_tokens_sql("coalesce(nullif(full_name_norm, ''), display_name_norm)")}, lambda y: {folded_sql('y')}) AS tokens, split_part(p.person_id, ':', 1) AS book
      FROM p LEFT JOIN n ON p.person_id = n.person_id),
k AS (SELECT DISTINCT {folded_sql('form')} AS norm, person_id FROM (
        SELECT person_id, unnest([display_name_norm, full_name_norm, kunya, ism, CASE WHEN ism IS NOT NULL AND father IS NOT NULL THEN ism || ' بن ' || father END]) AS form FROM i)
      WHERE {folded_sql('form')} <> '')"""


def resolve_sql(wanted: str, name: str = "z") -> str:
    """CTEs that resolve ``wanted(ref_id, norm, qism, is_woman, chain)``; the last one is ``name``."""
    return f"""
{name}a AS (SELECT ref_id, norm, CASE WHEN len(t) > 1 THEN array_to_string(t[1:2], ' بن ') END AS short FROM (SELECT ref_id, norm, {_tokens_sql('norm')} AS t FROM {wanted})),
{name}f AS (SELECT ref_id, person_id FROM {name}a JOIN k USING (norm)),
{name}s AS (SELECT a.ref_id, k.person_id FROM {name}a a JOIN k ON a.short = k.norm WHERE a.ref_id NOT IN (SELECT ref_id FROM {name}f)),
{name}c AS (SELECT ref_id, person_id, (w.qism IS NULL OR coalesce(w.qism = i.qism, false)) AND (w.is_woman IS NULL OR coalesce(w.is_woman = i.is_woman, false)) AS fits,
       coalesce(len(list_filter(w.chain[-4:], lambda y: list_contains(i.tokens, y))), 0) AS score
     FROM (SELECT * FROM {name}f UNION SELECT * FROM {name}s) JOIN {wanted} w USING (ref_id) JOIN i USING (person_id)),
{name}k AS (SELECT * FROM {name}c QUALIFY fits OR NOT bool_or(fits) OVER (PARTITION BY ref_id)),
{name}g AS (SELECT ref_id, count(*) AS n, min(person_id) AS one, max(score) AS top, array_to_string((list_sort(list(person_id)))[1:40], ',') AS listed FROM {name}k GROUP BY 1),
{name}b AS (SELECT ref_id, min(person_id) AS best FROM {name}k JOIN {name}g USING (ref_id) WHERE score = top AND top >= 1 GROUP BY 1 HAVING count(*) = 1),
{name} AS (SELECT w.ref_id, coalesce(CASE WHEN n = 1 THEN one END, best) AS to_id, coalesce(n, 0) AS n, listed FROM {wanted} w LEFT JOIN {name}g USING (ref_id) LEFT JOIN {name}b USING (ref_id))"""


OUTCOME_SQL = """to_id, to_id IS NOT NULL AS resolved, to_id IS NULL AND n > 1 AS ambiguous, CAST(CASE WHEN to_id IS NOT NULL THEN 1 ELSE n END AS BIGINT) AS n_candidates,
  CASE WHEN to_id IS NULL AND n > 1 THEN listed END AS candidates"""


@query(f"""WITH {INDEX_SQL}, w AS (SELECT person_id AS ref_id, {folded_sql("father || ' بن ' || grandfather")} AS norm, qism, false AS is_woman, chain FROM i WHERE father IS NOT NULL AND grandfather IS NOT NULL),
{resolve_sql('w')} SELECT ref_id, {OUTCOME_SQL} FROM z""")
def resolve_names(spark, sf_dir):
    """Each entry's father by name and father's name: looked up, filtered by part and sex, decided by the lineage."""
    index = index_of(spark, sf_dir)
    wanted = index.where("father is not null and grandfather is not null").select(
        F.col("person_id").alias("ref_id"), folded(F.concat("father", F.lit(" بن "), "grandfather")).alias("norm"), "qism", F.lit(False).alias("is_woman"), folded_each("chain").alias("chain")
    )
    out = G.resolve_names(wanted, _keys(index), index)
    return out.select("ref_id", "to_id", "resolved", "ambiguous", "n_candidates", F.array_join("candidates", ",").alias("candidates"))


_GENEALOGY_SQL = f"""
gs AS (SELECT c.person_id AS from_id, o.person_id, coalesce(len(list_filter(c.chain[-4:], lambda y: list_contains(o.chain, y))), 0) AS score
  FROM i c JOIN k ON k.norm = {folded_sql('c.father')} JOIN i o ON o.person_id = k.person_id WHERE c.father IS NOT NULL AND c.person_id <> o.person_id),
gg AS (SELECT from_id, count(*) AS n, max(score) AS top, array_to_string((list_sort(list(person_id)))[1:5], ',') AS listed FROM gs GROUP BY 1),
gb AS (SELECT from_id, min(person_id) AS to_id FROM gs JOIN gg USING (from_id) WHERE score = top GROUP BY 1 HAVING count(*) = 1),
ge AS (SELECT i.person_id AS from_id, to_id, father, coalesce(n, 0) AS n, listed FROM i LEFT JOIN gg ON i.person_id = gg.from_id LEFT JOIN gb ON i.person_id = gb.from_id WHERE father IS NOT NULL)"""


@query(f"""WITH {INDEX_SQL}, {_GENEALOGY_SQL} SELECT from_id, to_id, CASE WHEN to_id IS NULL THEN father END AS to_literal, 'family' AS type, 'father' AS relation,
CASE WHEN to_id IS NULL THEN 0.4::DOUBLE ELSE 0.7::DOUBLE END AS confidence, to_id IS NOT NULL AS resolved, to_id IS NULL AND n > 1 AS ambiguous, CASE WHEN to_id IS NULL AND n > 1 THEN listed END AS candidates FROM ge""")
def genealogy_edges(spark, sf_dir):
    """Father edges by names: the entry one of whose spellings is the father's."""
    index = index_of(spark, sf_dir)
    edges = G.genealogy(index, _keys(index))
    return edges.select("from_id", "to_id", "to_literal", "type", "relation", "confidence", "resolved", "ambiguous", F.array_join("candidates", ",").alias("candidates"))


def _pointing(spark, sf_dir) -> DataFrame:
    """Entries whose text holds a pointer of every kind, the number that of the entry itself."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["entry_number", "letter"])
    text = F.concat(
        F.lit("وله ذكر. يأتي في القسم الثالث. وتقدم ذكره في رقم "), F.coalesce(F.col("entry_number").cast("string"), F.lit("؟")),
        F.lit(". وسيأتي في الذي بعده، ومضى في ترجمة أبيه. انظر في حرف الباء، وتقدم في الكنى. وتقدم في حرف الباء."),
    )
    return p.select("person_id", text.alias("text"))


_POINTERS = [
    ("see_qism", 0, None, None, 3, None, None, "forward"), ("see_entry", 1, None, None, None, None, None, "backward"), ("see_adjacent", 2, 1, None, None, None, None, "forward"),
    ("see_relation", 3, None, "father", None, None, None, "backward"), ("see_letter", 4, None, None, None, None, "حرف الباء", "forward"), ("see_section", 5, None, None, None, "kunya", None, "backward"),
]


def _lit(v, kind: str) -> str:
    return f"CAST({'NULL' if v is None else repr(v)} AS {kind})"


@query("WITH p AS " + _now("persons", "person_id, entry_number") + ", " + "k(kind, pos, \"offset\", relation, qism, section, letter, direction) AS (" + " UNION ALL ".join(
    "SELECT " + ", ".join(_lit(v, t) for v, t in zip(r, ("VARCHAR", "INTEGER", "INTEGER", "VARCHAR", "INTEGER", "VARCHAR", "VARCHAR", "VARCHAR"))) for r in _POINTERS
) + """) SELECT person_id, pos, kind, "offset", relation, CASE WHEN kind = 'see_entry' THEN entry_number END AS entry_number,
qism, section, letter, direction FROM p, k WHERE kind <> 'see_entry' OR entry_number IS NOT NULL""")  # fmt: skip
def text_references(spark, sf_dir):
    """Pointers of every kind read from texts that hold them, a repeated one once."""
    return G.text_references(_pointing(spark, sf_dir), "text", "person_id", None).drop("evidence")


@query(f"""WITH {INDEX_SQL}, {_GENEALOGY_SQL},
w AS (SELECT i.person_id AS ref_id, {folded_sql('i.father')} AS norm, CAST(NULL AS INTEGER) AS qism, CAST(NULL AS BOOLEAN) AS is_woman, i.chain FROM i WHERE i.father IS NOT NULL AND i.person_id NOT IN (SELECT from_id FROM ge WHERE to_id IS NOT NULL)),
{resolve_sql('w')},
o AS (SELECT person_id, lead(person_id) OVER (PARTITION BY book ORDER BY coalesce(entry_number, 2147483647), person_id) AS next_id FROM i),
e AS (SELECT entry_number, count(*) AS n, min(person_id) AS one, array_to_string((list_sort(list(person_id)))[1:40], ',') AS listed FROM i WHERE entry_number IS NOT NULL GROUP BY 1)
SELECT i.person_id AS from_id, CASE WHEN n = 1 THEN one END AS to_id, 'see_entry' AS type, CAST(NULL AS VARCHAR) AS relation, n = 1 AS resolved, n > 1 AS ambiguous, CASE WHEN n > 1 THEN listed END AS candidates FROM i JOIN e USING (entry_number)
UNION ALL SELECT person_id, next_id, 'see_adjacent', NULL, next_id IS NOT NULL, false, NULL FROM o
UNION ALL SELECT i.person_id, coalesce(ge.to_id, z.to_id), 'see_relation', 'father', coalesce(ge.to_id, z.to_id) IS NOT NULL, ge.to_id IS NULL AND z.to_id IS NULL AND coalesce(z.n, 0) > 1,
  CASE WHEN ge.to_id IS NULL AND z.to_id IS NULL AND z.n > 1 THEN z.listed END FROM i LEFT JOIN ge ON ge.from_id = i.person_id LEFT JOIN z ON z.ref_id = i.person_id
UNION ALL SELECT person_id, NULL, unnest(['see_qism', 'see_letter', 'see_section']), NULL, false, false, NULL FROM i""")
def reference_edges(spark, sf_dir):
    """Pointers of texts as edges: numbers, neighbours and fathers resolved, the rest with what they name."""
    index = index_of(spark, sf_dir)
    keys = _keys(index)
    refs = G.text_references(_pointing(spark, sf_dir), "text", "person_id", None)
    edges = G.reference_edges(refs, index, keys, G.genealogy(index, keys), F.floor(F.col("doc_ord.n") / 256))
    return edges.select("from_id", "to_id", "type", "relation", "resolved", "ambiguous", F.array_join("candidates", ",").alias("candidates"))


def _edge_facts(spark, sf_dir) -> DataFrame:
    from ..operators.flatten import flatten_lists, pivot_fields

    lists = ["life.family", "narration.narrated_from", "narration.narrated_to"]
    return pivot_fields(flatten_lists(table(spark, sf_dir, "persons"), "person_json", lists), ["value", "relation", "source", "evidence", "confidence"])


_EDGES_SQL = f"""{INDEX_SQL}, facts AS ({facts_sql(['life.family', 'narration.narrated_from', 'narration.narrated_to'], ['value', 'relation'])}),
fe AS (SELECT person_id || '#' || coll_path || '#' || pos AS ref_id, person_id AS from_id, CASE coll_path WHEN 'life.family' THEN 'family' ELSE split_part(coll_path, '.', 2) END AS type, value,
  CASE WHEN coll_path = 'life.family' THEN relation END AS relation FROM facts WHERE value IS NOT NULL AND NOT regexp_matches(value, '{G.COLLECTIVE}')),
w AS (SELECT ref_id, {folded_sql('value')} AS norm, CAST(NULL AS INTEGER) AS qism, CASE WHEN relation IN ('mother', 'sister', 'wife', 'daughter') THEN true END AS is_woman, i.chain FROM fe LEFT JOIN i ON i.person_id = fe.from_id),
{resolve_sql('w')}"""


@query(f"WITH {_EDGES_SQL} SELECT from_id, to_id, CASE WHEN to_id IS NULL THEN value END AS to_literal, type, relation, to_id IS NOT NULL AS resolved, to_id IS NULL AND n > 1 AS ambiguous FROM fe JOIN z USING (ref_id)")
def narration_edges(spark, sf_dir):
    """Narrators and kin named in the nested records, resolved to entries by their names."""
    index = index_of(spark, sf_dir)
    return G.fact_edges(_edge_facts(spark, sf_dir), index, _keys(index)).select("from_id", "to_id", "to_literal", "type", "relation", "resolved", "ambiguous")


@query(f"""WITH {_EDGES_SQL}, e AS (SELECT type, to_id IS NOT NULL AS resolved, to_id IS NULL AND n > 1 AS ambiguous FROM fe JOIN z USING (ref_id))
SELECT type, count(*) AS n_edges, CAST(count(*) FILTER (WHERE resolved) AS BIGINT) AS resolved, CAST(count(*) FILTER (WHERE ambiguous) AS BIGINT) AS ambiguous,
  CAST(count(*) FILTER (WHERE NOT resolved AND NOT ambiguous) AS BIGINT) AS unresolved FROM e GROUP BY 1""")
def edge_statistics(spark, sf_dir):
    """Edges of facts by type with their outcomes."""
    index = index_of(spark, sf_dir)
    return G.edge_stats(G.fact_edges(_edge_facts(spark, sf_dir), index, _keys(index)))


@query(f"""WITH {_EDGES_SQL}, e AS (SELECT CASE WHEN type = 'family' THEN 'in_book' ELSE 'narrators' END AS edge_group, to_id IS NOT NULL AS resolved, to_id IS NULL AND n > 1 AS ambiguous FROM fe JOIN z USING (ref_id))
SELECT edge_group, count(*) AS n_edges, CAST(count(*) FILTER (WHERE resolved) AS BIGINT) AS resolved, CAST(count(*) FILTER (WHERE NOT resolved AND ambiguous) AS BIGINT) AS ambiguous,
  CAST(count(*) FILTER (WHERE NOT resolved AND NOT ambiguous) AS BIGINT) AS unresolved, CAST(round(CAST(count(*) FILTER (WHERE resolved) AS DECIMAL(18,6)) / count(*), 4) AS DOUBLE) AS resolution_rate FROM e GROUP BY 1""")
def outcome_split(spark, sf_dir):
    """Resolution of the edges by group of types."""
    index = index_of(spark, sf_dir)
    edges = G.fact_edges(_edge_facts(spark, sf_dir), index, _keys(index))
    return A.outcome_split(edges, {"narrators": ["narrated_from", "narrated_to"], "in_book": ["family", "see_entry", "see_adjacent", "see_relation"]})


def _key_sql(x: str) -> str:
    points = X.PUNCTUATION.replace("'", "''").replace("\\-", "\\-")
    return squeezed_sql(folded_sql(f"regexp_replace({flat_sql(x)}, '{points}', ' ', 'g')"))


@query(f"""
WITH q AS (SELECT d.doc_id, unnest(regexp_extract_all(coalesce(d.text, ''), '«([^«»]*)»', 1)) AS quote, d.person_id FROM documents d WHERE d.person_id IS NOT NULL),
r AS (SELECT person_id, {_key_sql('text_body')} AS hay FROM {_now('raw', 'person_id, text_body')}),
v AS (SELECT q.doc_id, q.quote, {_key_sql('q.quote')} AS needle, r.hay FROM q JOIN r USING (person_id))
SELECT doc_id, quote, CASE WHEN quote = '' THEN 'absent' WHEN length(needle) < 8 THEN 'too_short' WHEN contains(hay, needle) THEN 'verified'
  WHEN length(regexp_replace(needle, '^(?:و|ف|ثم|قال)\\s*', '')) >= 8 AND contains(hay, regexp_replace(needle, '^(?:و|ف|ثم|قال)\\s*', '')) THEN 'verified' ELSE 'unverified' END AS status FROM v
""")
def evidence_verification(spark, sf_dir):
    """Every quotation of a document, and whether the entry it belongs to holds it."""
    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body"])
    quotes = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("«([^«»]*)»"), F.lit(1))
    d = table(spark, sf_dir, "documents").where("person_id is not null").select("doc_id", "person_id", F.explode(quotes).alias("quote"))
    return d.join(raw, "person_id").select("doc_id", "quote", X.evidence_status("text_body", "quote").alias("status"))


@query(f"""WITH {_EDGES_SQL}, {_GENEALOGY_SQL}, x AS (SELECT from_id AS src, to_id AS dst, type, false AS by_names FROM fe JOIN z USING (ref_id) WHERE to_id IS NOT NULL
  UNION SELECT from_id, to_id, 'family', true FROM ge WHERE to_id IS NOT NULL) SELECT src, dst, type, by_names FROM x""")
def neighbour_pairs(spark, sf_dir):
    """Resolved edges of facts and of fathers by names as pairs of neighbours."""
    index = index_of(spark, sf_dir)
    keys = _keys(index)
    pairs = G.neighbour_pairs(G.fact_edges(_edge_facts(spark, sf_dir), index, keys), G.genealogy(index, keys))
    return pairs.select("src", "dst", "type", (F.col("source") == "genealogy").alias("by_names")).distinct()
