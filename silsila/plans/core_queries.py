"""Queries over the driver's tables, each with the SQL it must equal."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import relational as R
from ..operators import reports as A
from ..operators.current import current_rows
from ..session import spread
from .lineage_sql import BLANKS_SQL, flat_sql, squeezed_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Current rows in SQL; the driver's tables hold no two different rows of one key with one ``ingested_at``.
def _now(name: str, columns: str) -> str:
    return f"(SELECT {columns} FROM {name} WHERE person_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY ingested_at DESC) = 1)"


CITED = "(SELECT DISTINCT * FROM citations)"
#: White space as the text functions see it, and pieces of a text between marks.
_W = BLANKS_SQL
_EDGES = f"^{_W}+|{_W}+$"
_SPANS = r"[^\n.؟!]+(?:[.؟!]+(?:\s*\[\s*\(\s*[0-9]+\s*\)\s*\])?|\n+|$)|[\n.؟!]+"


def citations(spark, sf_dir) -> DataFrame:
    """Equal rows of citations count once."""
    return table(spark, sf_dir, "citations").distinct()


# --- text -----------------------------------------------------------------------------------------------
@query(f"""
SELECT doc_id, CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '{_SPANS}'), lambda q: NOT regexp_full_match(q, '[\\n.؟!]+') AND regexp_replace(q, '{_EDGES}', '', 'g') <> '')) AS BIGINT) AS n_sentences FROM documents
""")
def sentence_split_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(X.sentence_spans("text")).cast("long").alias("n_sentences"))


@query("""
SELECT CASE WHEN n_chars < 200 THEN 'stub' WHEN n_chars < 800 THEN 'short' WHEN n_chars < 4000 THEN 'medium' ELSE 'long' END AS length_class,
       count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars
FROM documents GROUP BY 1
""")
def length_class_distribution(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(X.length_class("n_chars").alias("length_class"), "n_chars")
    return d.groupBy("length_class").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""
SELECT doc_id, sha256(lower(trim(regexp_replace(coalesce(text, ''), '[ \\t\\r\\n]+', ' ', 'g')))) AS text_hash FROM documents
""")
def normalized_text_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(X.plain_key("text"), 256).alias("text_hash"))


@query("""
WITH h AS (SELECT doc_id, sha256(lower(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g')))) AS text_hash FROM documents WHERE text IS NOT NULL AND trim(text) <> '')
SELECT text_hash, count(*) AS n_docs, min(doc_id) AS first_doc FROM h GROUP BY 1 HAVING count(*) > 1
""")
def exact_duplicate_groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text is not null and trim(text) != ''")
    h = d.select("doc_id", F.sha2(X.plain_key("text"), 256).alias("text_hash"))
    return h.groupBy("text_hash").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc")).where("n_docs > 1")


@query(f"SELECT doc_id, {flat_sql('text')} AS flat FROM documents")
def note_markers_removed(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.flatten("text").alias("flat"))


@query(f"""
WITH p AS (SELECT doc_id, regexp_split_to_array(regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'), '\\n?_{{3,}}\\n?') AS parts FROM documents),
n AS (SELECT doc_id, regexp_replace(parts[1], '{_EDGES}', '', 'g') AS body, array_to_string(parts[2:], chr(10)) AS rest FROM p),
k AS (SELECT doc_id, body, list_filter(list_transform(regexp_extract_all(rest, '\\(\\s*[0-9]+\\s*\\)\\s*([^\\n]+)', 1), lambda y: {squeezed_sql('y')}), lambda y: y <> '') AS notes FROM n)
SELECT doc_id, CAST(length(body) AS BIGINT) AS body_chars, CAST(len(notes) AS BIGINT) AS n_notes, notes[1] AS first_note FROM k
""")
def footnote_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", X.split_footnotes("text").alias("s"))
    return d.select("doc_id", F.length("s.body").cast("long").alias("body_chars"), F.size("s.footnotes").cast("long").alias("n_notes"), F.try_element_at("s.footnotes", F.lit(1))["text"].alias("first_note"))


@query("""
WITH y AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '٠١٢٣٤٥٦٧٨٩', '0123456789'), 'سنة ([0-9]{1,4})', 1)) AS y FROM documents)
SELECT doc_id, CASE WHEN CAST(y AS INTEGER) BETWEEN 1 AND 1500 THEN CAST(y AS INTEGER) END AS year, count(*) AS n FROM y GROUP BY 1, 2
""")
def years_in_text(spark, sf_dir):
    """Every year told in digits behind the word for it, as the year parser reads it."""
    found = F.regexp_extract_all(X.western_digits(F.coalesce("text", F.lit(""))), F.lit("سنة ([0-9]{1,4})"), F.lit(1))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("y"))
    return rows.select("doc_id", X.parse_year("y").alias("year")).groupBy("doc_id", "year").agg(F.count("*").alias("n"))


_PHRASES = ["سبع وخمسين", "ثلاث وسبعين", "إحدى وأربعين", "57", "٥٧", "9999", "", "قال", "مائة وعشرين", "خمس خمس", "ست وستين ومائة"]
_EXPECTED = [57, 73, 41, 57, 57, None, None, None, 120, 10, 166]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{p}', {'NULL' if y is None else y})" for p, y in zip(_PHRASES, _EXPECTED)) + ") AS t(phrase, year)")
def numeral_parse(spark, sf_dir):
    phrases = spark.createDataFrame([(p,) for p in _PHRASES], "phrase string")
    return phrases.select("phrase", X.parse_year("phrase").alias("year"))


@query("""
SELECT CASE WHEN evidence IS NULL OR evidence = '' THEN 'absent' WHEN confidence >= 0.85 THEN 'verified' WHEN confidence <= 0.6 THEN 'unverified' END AS status, count(*) AS n
FROM """ + CITED + """ GROUP BY 1 HAVING status IS NOT NULL
""")
def evidence_status_counts(spark, sf_dir):
    return A.evidence_tally(citations(spark, sf_dir))


# --- vocabulary -------------------------------------------------------------------------------------------
@query("""
WITH v AS (SELECT authority_key, alias, length(alias) AS n FROM (SELECT authority_key, unnest(list_append(aliases, label_ar)) AS alias FROM authorities) WHERE alias IS NOT NULL AND alias <> ''),
h AS (SELECT DISTINCT d.doc_id, v.authority_key FROM documents d, v WHERE contains(coalesce(d.text, ''), v.alias))
SELECT authority_key, count(*) AS n_docs FROM h GROUP BY 1
""")
def vocab_all_matches(spark, sf_dir):
    from ..functions.vocab import Vocabulary

    found = spread(table(spark, sf_dir, "documents").select("text")).select(F.explode(Vocabulary.load(table(spark, sf_dir, "authorities")).scan("text")).alias("authority_key"))
    return found.groupBy("authority_key").agg(F.count("*").alias("n_docs"))


@query("""
WITH v AS (SELECT authority_key, alias, bool_and(is_label) AS is_label FROM (SELECT authority_key, unnest(aliases) AS alias, false AS is_label FROM authorities UNION ALL SELECT authority_key, label_ar, true FROM authorities) WHERE alias IS NOT NULL AND alias <> '' GROUP BY 1, 2),
h AS (SELECT d.doc_id, v.authority_key, v.alias FROM documents d, v WHERE contains(coalesce(d.text, ''), v.alias)
      QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY length(v.alias) DESC, v.authority_key, v.is_label, v.alias) = 1)
SELECT d.doc_id, h.authority_key FROM documents d LEFT JOIN h ON d.doc_id = h.doc_id
""")
def vocab_first_match(spark, sf_dir):
    from ..functions.vocab import Vocabulary

    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.try_element_at(Vocabulary.load(table(spark, sf_dir, "authorities")).scan("text"), F.lit(1)).alias("authority_key"))


# --- windows ----------------------------------------------------------------------------------------------
@query("""
SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_signup FROM events
""")
def events_asof_last_signup(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("signup", F.when(F.col("event_type") == "signup", F.col("event_id")))
    out = R.carry_forward(e, ["user_id"], ["ts", "event_id"], "signup", "last_signup", F.date_trunc("week", "ts"))
    return out.select("event_id", "last_signup")


@query("""
SELECT o.o_orderkey, e.event_id FROM orders o ASOF LEFT JOIN
  (SELECT user_id, ts, max(event_id) AS event_id FROM events GROUP BY 1, 2) e ON o.o_custkey = e.user_id AND CAST(o.o_orderdate AS TIMESTAMP) + INTERVAL 9000 DAY >= e.ts
""")
def order_asof_event(spark, sf_dir):
    """Each order with its customer's latest event at or before a moment 9,000 days after it."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), (F.col("o_orderdate").cast("timestamp") + F.expr("interval 9000 days")).alias("at"))
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    return R.asof_join(o, e, ["user_id"], "at", "ts", ["event_id"], lambda t: F.date_trunc("month", t)).select("o_orderkey", "event_id")


@query("""
SELECT o_orderkey, lag(o_orderkey) OVER w AS previous_o_orderkey, lead(o_orderkey) OVER w AS next_o_orderkey
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def lead_lag_neighbors(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return R.neighbors(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey", F.date_trunc("year", "o_orderdate")).select("o_orderkey", "previous_o_orderkey", "next_o_orderkey")


@query("SELECT person_id, entry_number, count(*) OVER (PARTITION BY entry_number) > 1 AS is_ambiguous FROM " + _now("persons", "person_id, entry_number"))
def ambiguous_key_flag(spark, sf_dir):
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["entry_number"])
    n = p.groupBy(F.col("entry_number").alias("number")).agg((F.count("*") > 1).alias("is_ambiguous"))
    return p.join(n, F.col("entry_number").eqNullSafe(F.col("number"))).select("person_id", "entry_number", "is_ambiguous")


@query("""
SELECT entry_number, split_part(person_id, ':', 1) AS book, person_id, CAST(row_number() OVER (PARTITION BY split_part(person_id, ':', 1), entry_number ORDER BY person_id) - 1 AS BIGINT) AS ordinal
FROM """ + _now("persons", "person_id, entry_number"))
def repeated_number_ordinal(spark, sf_dir):
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["entry_number"]).withColumn("book", F.substring_index("person_id", ":", 1))
    return R.ordinals(p, ["book", "entry_number"], ["person_id"], "ordinal").select("entry_number", "book", "person_id", "ordinal")


@query("""
WITH b AS (SELECT *, o_orderdate AS d FROM orders), r AS (SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (ORDER BY d, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS spent,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM b)
SELECT o_orderkey, cents, spent FROM r WHERE spent - cents < 1000000000
""")
def running_budget_cut(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return R.running_until(o, ["o_orderdate", "o_orderkey"], "cents", 1_000_000_000, F.date_trunc("month", "o_orderdate")).select("o_orderkey", "cents", "spent")


@query("""
WITH s AS (SELECT doc_id, coalesce(lang, 'none') AS lang, source, row_number() OVER (PARTITION BY coalesce(lang, 'none'), source ORDER BY doc_id) AS round FROM documents)
SELECT doc_id, lang, source, round FROM s ORDER BY round, lang, source, doc_id LIMIT 200
""")
def stratified_round_robin(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"), "source")
    return R.round_robin(d, ["lang", "source"], ["doc_id"], 200).select("doc_id", "lang", "source", F.col("round").cast("long").alias("round"))


@query("""
SELECT user_id, string_agg(event_type || '@' || strftime(ts, '%Y-%m-%d'), ',' ORDER BY ts NULLS LAST, event_id) AS timeline, count(*) AS n FROM events GROUP BY 1
""")
def timeline_per_user(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    item = F.struct(F.col("ts").isNull().alias("last"), "ts", "event_id", F.concat("event_type", F.lit("@"), F.date_format("ts", "yyyy-MM-dd")).alias("item"))
    rows = e.groupBy("user_id").agg(F.sort_array(F.collect_list(item)).alias("items"), F.count("*").alias("n"))
    return rows.select("user_id", F.array_join(F.transform("items", lambda i: i["item"]), ",").alias("timeline"), "n")


# --- joins ------------------------------------------------------------------------------------------------
_BANDS = [(1, 10, "a"), (11, 20, "b"), (21, 35, "c"), (30, 50, "d")]


@query("""
SELECT band, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN (VALUES """ + ", ".join(f"({a}, {b}, '{n}')" for a, b, n in _BANDS) + """) AS v(lo, hi, band) ON l_quantity BETWEEN lo AND hi GROUP BY 1
""")
def range_join_bands(spark, sf_dir):
    bands = F.broadcast(spark.createDataFrame(_BANDS, "lo int, hi int, band string"))
    rows = R.range_join(table(spark, sf_dir, "lineitem").select("l_quantity"), bands, "l_quantity", "lo", "hi", 10)
    return rows.groupBy("band").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("""
WITH s AS (SELECT CAST(unnest(generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day FROM s WHERE day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate IS NOT NULL)
""")
def interval_coverage_gaps(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority")
    spine = o.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(F.explode(F.sequence("a", "b")).alias("day"))
    return R.uncovered(spine, o.where("o_orderpriority = '1-URGENT'"), "day")


_NAMES = "trim(regexp_replace(lower(display_name_norm), '[ ]+', ' ', 'g'))"


def _display_keys(spark, sf_dir) -> DataFrame:
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["display_name_norm"])
    return p.select("person_id", F.btrim(F.regexp_replace(F.lower("display_name_norm"), "[ ]+", " ")).alias("name"))


@query("""
WITH k AS (SELECT person_id, """ + _NAMES + """ AS name FROM """ + _now("persons", "person_id, display_name_norm") + """),
f AS (SELECT DISTINCT trim(regexp_replace(lower(ism || ' بن ' || father), '[ ]+', ' ', 'g')) AS name FROM """ + _now("nasab", "person_id, ism, father") + """ WHERE ism IS NOT NULL AND father IS NOT NULL),
g AS (SELECT name, count(DISTINCT person_id) AS n_targets, min(person_id) AS one, array_to_string((list_sort(list(DISTINCT person_id)))[1:5], ',') AS some FROM k WHERE name IS NOT NULL GROUP BY 1)
SELECT f.name, coalesce(g.n_targets, 0) AS n_targets, CASE WHEN g.n_targets = 1 THEN g.one END AS person_id, CASE WHEN g.n_targets > 1 THEN g.some END AS candidates,
  CASE WHEN g.n_targets IS NULL THEN 'unresolved' WHEN g.n_targets = 1 THEN 'resolved' ELSE 'ambiguous' END AS outcome
FROM f LEFT JOIN g ON f.name = g.name
""")
def resolve_by_key_unique(spark, sf_dir):
    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["ism", "father"]).where("ism is not null and father is not null")
    names = n.select(F.btrim(F.regexp_replace(F.lower(F.concat("ism", F.lit(" بن "), "father")), "[ ]+", " ")).alias("name")).distinct()
    out = R.resolve(names, _display_keys(spark, sf_dir), "name", "name", "person_id")
    return out.select("name", "n_targets", "person_id", F.array_join("candidates", ",").alias("candidates"), "outcome")


@query("""
WITH c AS (SELECT s.s_nationkey AS k, s.s_suppkey AS c, s.s_acctbal > 9000 AS keep FROM supplier s), g AS (SELECT k, bool_or(keep) AS some FROM c GROUP BY 1)
SELECT c.k AS nation, c.c AS supplier FROM c JOIN g ON c.k = g.k WHERE c.keep OR NOT g.some
""")
def filter_fallback_candidates(spark, sf_dir):
    c = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("supplier"), "s_acctbal")
    return R.filter_or_keep(c, ["nation"], F.col("s_acctbal") > 9000).select("nation", "supplier")


@query("""
WITH s AS (SELECT l_partkey AS part, l_suppkey AS supplier, count(*) AS score FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY part ORDER BY score DESC) AS rk FROM s), t AS (SELECT part, count(*) AS n, min(supplier) AS supplier, min(score) AS score FROM r WHERE rk = 1 GROUP BY 1)
SELECT part, supplier, score FROM t WHERE n = 1
""")
def argmax_unique_best(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier")).agg(F.count("*").alias("score"))
    return R.unique_best(s, ["part"], "score", "supplier").select("part", "supplier", "score")


@query("""
WITH n AS """ + _now("nasab", "person_id, father_id") + """
SELECT c.person_id, f.person_id AS father_id, g.person_id AS grandfather_id FROM n c JOIN n f ON c.father_id = f.person_id LEFT JOIN n g ON f.father_id = g.person_id
""")
def self_join_genealogy(spark, sf_dir):
    from ..operators.graph import two_steps

    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["father_id"])
    return two_steps(n, "person_id", "father_id", "grandfather_id")


@query("""
WITH e AS (SELECT DISTINCT person_id AS src, authority_key AS dst FROM citations WHERE authority_key IS NOT NULL AND person_id IS NOT NULL),
u AS (SELECT src AS vertex, dst AS neighbor, 'out' AS direction FROM e UNION SELECT dst, src, 'in' FROM e WHERE src <> dst)
SELECT vertex, neighbor, direction, row_number() OVER (PARTITION BY vertex ORDER BY neighbor, direction) AS rank FROM u QUALIFY rank <= 28
""")
def one_hop_neighborhood(spark, sf_dir):
    e = table(spark, sf_dir, "citations").where("authority_key is not null and person_id is not null")
    e = e.select(F.col("person_id").alias("src"), F.col("authority_key").alias("dst")).distinct()
    return R.one_hop(e, "vertex", 28).select("vertex", "neighbor", "direction", F.col("rank").cast("long").alias("rank"))


@query("""
SELECT DISTINCT p.person_id FROM """ + _now("persons", "person_id, qism") + """ p
WHERE p.person_id IN (SELECT person_id FROM citations WHERE authority_key = 'auth_00') AND p.person_id IN (SELECT person_id FROM citations WHERE verb = 'قال')
""")
def semi_join_postings(spark, sf_dir):
    c = table(spark, sf_dir, "citations")
    postings = c.select("person_id", F.lit("authority").alias("kind"), F.col("authority_key").alias("value")).unionByName(c.select("person_id", F.lit("verb").alias("kind"), F.col("verb").alias("value")))
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["qism"]).select("person_id")
    return R.having_all(p, "person_id", postings, [("authority", "auth_00"), ("verb", "قال")])


@query("SELECT person_id FROM " + _now("persons", "person_id") + " WHERE person_id NOT IN (SELECT person_id FROM citations WHERE person_id IS NOT NULL AND confidence IS NOT NULL)")
def anti_join_resume(spark, sf_dir):
    done = table(spark, sf_dir, "citations").where("confidence is not null").select("person_id").distinct()
    return table(spark, sf_dir, "persons").where("person_id is not null").select("person_id").distinct().join(done, "person_id", "left_anti")


# --- aggregates ---------------------------------------------------------------------------------------------
_FILLED = ["display_name", "full_name", "kunya", "nisba", "death_year_hijri", "qism", "letter", "page_start", "volume"]


@query("WITH p AS " + _now("persons", "*") + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS field, CAST(count(*) FILTER (WHERE {c} IS NOT NULL{' AND len(nisba) > 0' if c == 'nisba' else ''}) AS BIGINT) AS filled, count(*) AS total, "
    f"CAST(round(CAST(count(*) FILTER (WHERE {c} IS NOT NULL{' AND len(nisba) > 0' if c == 'nisba' else ''}) AS DECIMAL(18,6)) / count(*), 4) AS DOUBLE) AS fill_rate FROM p"
    for c in _FILLED))
def fill_rates(spark, sf_dir):
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", _FILLED)
    return A.fill_rates(p, {c: F.size(c) > 0 if c == "nisba" else F.col(c).isNotNull() for c in _FILLED})


_BASE = {"display_name": 0.9, "full_name": 0.99, "kunya": 0.8, "nisba": 0.5}


@query("WITH p AS " + _now("persons", "*") + ", r AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS field, CAST(round(CAST(count(*) FILTER (WHERE {c} IS NOT NULL{' AND len(nisba) > 0' if c == 'nisba' else ''}) AS DECIMAL(18,6)) / count(*), 4) AS DOUBLE) AS current_rate, CAST({b} AS DOUBLE) AS baseline_rate FROM p"
    for c, b in _BASE.items()) + """), d AS (SELECT *, CAST(round(CAST(current_rate - baseline_rate AS DECIMAL(12,6)), 4) AS DOUBLE) AS delta FROM r)
SELECT *, CASE WHEN delta < -0.02 THEN 'regression' WHEN delta > 0.02 THEN 'improvement' ELSE 'same' END AS verdict FROM d""")
def gate_regressions(spark, sf_dir):
    base = spark.createDataFrame(list(_BASE.items()), "field string, fill_rate double")
    return A.gate(fill_rates(spark, sf_dir), base)


@query("""
WITH c AS """ + CITED + """, t AS (SELECT authority_key, count(*) AS n_mentions, count(DISTINCT person_id) AS n_persons FROM c WHERE authority_key IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 40),
v AS (SELECT authority_key, string_agg(verb || '=' || n, ',' ORDER BY verb || '=' || n) AS verbs FROM (SELECT authority_key, verb, count(*) AS n FROM c WHERE verb IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
f AS (SELECT authority_key, array_to_string((list_sort(list(DISTINCT person_id)))[1:80], ',') AS first_ids FROM c GROUP BY 1)
SELECT t.authority_key, n_mentions, n_persons, verbs, first_ids FROM t LEFT JOIN v USING (authority_key) LEFT JOIN f USING (authority_key)
""")
def top_k_authorities(spark, sf_dir):
    out = A.authority_report(citations(spark, sf_dir), "authority_key", "person_id", "verb", 40, 80)
    return out.select("authority_key", "n_mentions", "n_persons", F.array_join("verbs", ",").alias("verbs"), F.array_join("first_ids", ",").alias("first_ids"))


@query("SELECT coalesce(authority_key, 'none') AS authority_key, coalesce(verb, 'none') AS verb, count(*) AS n, count(DISTINCT person_id) AS n_persons FROM " + CITED + " GROUP BY 1, 2")
def verb_breakdown(spark, sf_dir):
    c = citations(spark, sf_dir).select(F.coalesce("authority_key", F.lit("none")).alias("authority_key"), F.coalesce("verb", F.lit("none")).alias("verb"), "person_id")
    return c.groupBy("authority_key", "verb").agg(F.count("*").alias("n"), F.count_distinct("person_id").alias("n_persons"))


@query("""
SELECT n.n_name AS nation, c.c_mktsegment AS segment, count(*) AS n_facts, count(DISTINCT o.o_custkey) AS n_persons, array_to_string((list_sort(list(DISTINCT o.o_custkey)))[1:5], ',') AS first_ids
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2
""")
def rollup_capped_members(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    facts = o.join(c, o["o_custkey"] == c["c_custkey"]).join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"])
    facts = facts.select(F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"), "o_custkey")
    return A.rollup(facts, "nation", "segment", "o_custkey", 5).withColumn("first_ids", F.array_join(F.transform("first_ids", lambda x: x.cast("string")), ","))


@query("WITH p AS " + _now("persons", "person_id, qism, nisba") + """
SELECT key, count(*) AS n FROM (SELECT unnest(nisba) AS key FROM p WHERE qism IS NULL OR qism <> 4) WHERE key IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 80""")
def faceted_counts_excluding(spark, sf_dir):
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["qism", "nisba"]).where("qism is null or qism != 4")
    return A.top_groups(p.select(F.explode("nisba").alias("key")).where("key is not null"), ["key"], 80)


@query("WITH p AS " + _now("persons", "person_id, letter") + """
SELECT coalesce(letter, 'none') AS letter, count(*) AS n FROM p GROUP BY 1""")
def letter_counts(spark, sf_dir):
    return A.distribution(current_rows(table(spark, sf_dir, "persons"), "person_id", ["letter"]), F.col("letter"), "none", "letter")


@query("WITH n AS " + _now("nasab", "person_id, rejected_reason") + """
SELECT coalesce(split_part(rejected_reason, ':', 1), 'none') AS reason, count(*) AS n FROM n GROUP BY 1""")
def rejection_reasons(spark, sf_dir):
    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["rejected_reason"])
    return A.distribution(n, F.substring_index("rejected_reason", ":", 1), "none", "reason")


@query("""
WITH c AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY ingested_at, evidence NULLS FIRST, authority NULLS FIRST, verb NULLS FIRST, authority_key NULLS FIRST, confidence NULLS FIRST, extract_source NULLS FIRST) AS rn
  FROM """ + CITED + """ WHERE person_id IS NOT NULL),
o AS (SELECT person_id, authority_key, min(rn) AS first FROM c WHERE authority_key IS NOT NULL GROUP BY 1, 2),
l AS (SELECT person_id, string_agg(authority_key, ',' ORDER BY first) AS authorities FROM o GROUP BY 1)
SELECT c.person_id, arg_min(verb, rn) FILTER (WHERE verb IS NOT NULL) AS verb, bool_or(confidence >= 0.85) AS sure, coalesce(any_value(authorities), '') AS authorities FROM c LEFT JOIN l ON c.person_id = l.person_id GROUP BY 1
""")
def merge_chunks(spark, sf_dir):
    """Partial rows of one person merged in order: the first verb, any certainty, authorities without repeats."""
    from ..operators.biography import merged_chunks

    order = F.struct("ingested_at", "evidence", "authority", "verb", "authority_key", "confidence", "extract_source")
    keys = F.array_compact(F.array("authority_key"))
    c = citations(spark, sf_dir).where("person_id is not null").select("person_id", order.alias("at"), "verb", (F.col("confidence") >= 0.85).alias("sure"), keys.alias("authorities"))
    out = merged_chunks(c, "person_id", "at", ["verb"], ["sure"], ["authorities"])
    return out.withColumn("authorities", F.array_join("authorities", ","))


@query("WITH n AS " + _now("nasab", "person_id, chain") + """
SELECT person_id, array_to_string(list_filter(chain, lambda x, i: list_position(chain, x) = i), '|') AS distinct_chain FROM n WHERE chain IS NOT NULL""")
def ordered_dedupe(spark, sf_dir):
    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["chain"]).where("chain is not null")
    return n.select("person_id", F.array_join(X.ordered_distinct(F.col("chain"), lambda x: x), "|").alias("distinct_chain"))


@query("""
SELECT source, count(*) AS n_docs, CAST(sum(greatest(1, ceil(n_chars / 9000.0))) AS BIGINT) AS requests, CAST(sum(n_chars // 3 + 1200 * greatest(1, ceil(n_chars / 9000.0))) AS BIGINT) AS tokens FROM documents GROUP BY 1
""")
def cost_estimate(spark, sf_dir):
    from ..operators.passes import estimated

    d = estimated(table(spark, sf_dir, "documents").select("source", "n_chars"), "n_chars")
    return d.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("requests").alias("requests"), F.sum("tokens").alias("tokens"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("WITH p AS " + _now("persons", "*") + r""", e AS (
SELECT 'person_id' AS rule, person_id FROM p WHERE NOT regexp_matches(person_id, '^[a-z]+:[0-9]+:[0-9]+-[0-9]+(\.[0-9]+)?$')
UNION ALL SELECT 'qism', person_id FROM p WHERE qism IS NOT NULL AND qism NOT BETWEEN 1 AND 4
UNION ALL SELECT 'pages', person_id FROM p WHERE page_end < page_start
UNION ALL SELECT 'death_year', person_id FROM p WHERE death_year_hijri NOT BETWEEN -100 AND 1500
UNION ALL SELECT 'display_name', person_id FROM p WHERE display_name IS NULL OR display_name = ''
UNION ALL SELECT 'full_name', person_id FROM p WHERE full_name IS NULL
UNION ALL SELECT 'confidence', person_id FROM p WHERE nasab_confidence NOT BETWEEN 0 AND 1)
SELECT rule, person_id, count(*) OVER (PARTITION BY rule) AS failed, row_number() OVER (PARTITION BY rule ORDER BY person_id) AS rank FROM e QUALIFY rank <= 5""")
def validation_report(spark, sf_dir):
    from ..sources.validate import PERSON_RULES, violations

    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["qism", "page_start", "page_end", "death_year_hijri", "display_name", "full_name", "nasab_confidence"])
    out = A.first_errors(violations(p, PERSON_RULES, "person_id"), "rule", ["person_id"])
    return out.select("rule", "person_id", "failed", F.col("rank").cast("long").alias("rank"))


@query(r"""
SELECT person_id, regexp_extract(trim(t), '^([0-9]+)[ ]*(?:([^0-9 \-–—]{1,6})[ ]*)?[-–—][ ]*(.+)$', 1) AS number, regexp_extract(trim(t), '^([0-9]+)[ ]*(?:([^0-9 \-–—]{1,6})[ ]*)?[-–—][ ]*(.+)$', 3) AS name
FROM (SELECT person_id, split_part(trim(coalesce(text_body, '')), '،', 1) AS t FROM """ + _now("raw", "person_id, text_body") + """) WHERE regexp_matches(trim(t), '^[0-9]+[ ]*-')
""")
def heading_parse(spark, sf_dir):
    from ..operators.structure import HEADING

    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body"])
    t = F.btrim(F.split_part(F.btrim(F.coalesce("text_body", F.lit(""))), F.lit("،"), F.lit(1)))
    return raw.select("person_id", t.alias("t")).where(F.regexp_like("t", F.lit("^[0-9]+[ ]*-"))).select(
        "person_id", F.regexp_extract("t", HEADING, 1).alias("number"), F.regexp_extract("t", HEADING, 3).alias("name")
    )


@query("SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1, 2")
def stream_vs_batch_counts(spark, sf_dir):
    """Daily counts by a stream over the event file, run until all that is available is read."""
    from ..streaming.incremental import daily_counts_stream

    return daily_counts_stream(spark, f"{sf_dir}/events.parquet")


# --- labels -------------------------------------------------------------------------------------------------
from ..operators import labels as L  # noqa: E402
from ..operators import search as S  # noqa: E402
from ..operators.lineage import lineage as read_lineage  # noqa: E402

_SENTENCES = f"""s AS (SELECT doc_id, lang, trim(q, ' ' || chr(9) || chr(13) || chr(10)) AS quote FROM (SELECT doc_id, coalesce(lang, 'none') AS lang, unnest(regexp_extract_all(coalesce(text, ''), '{L.PIECES}')) AS q FROM documents)
  WHERE trim(q, ' ' || chr(9) || chr(13) || chr(10)) <> '')"""


@query(f"WITH {_SENTENCES}, l AS (SELECT {L.label_sql('quote')} AS label FROM s) SELECT label, count(*) AS n FROM l GROUP BY 1")
def sentence_label_distribution(spark, sf_dir):
    return L.labelled(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "text", "doc_id").groupBy("label").agg(F.count("*").alias("n"))


@query(f"""WITH {_SENTENCES}, l AS (SELECT lang, quote, {L.label_sql('quote')} AS label FROM s)
SELECT lang, CAST(sum(CASE WHEN label <> 'unlabeled' THEN length(quote) ELSE 0 END) AS BIGINT) AS labelled_chars, CAST(sum(length(quote)) AS BIGINT) AS chars,
  count(*) FILTER (WHERE label = 'unlabeled') AS n_unlabeled FROM l GROUP BY 1""")
def label_coverage_by_lang(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"), "text"))
    rows = L.labelled(d.withColumn("k", F.struct("doc_id", "lang")), "text", "k").select("k.lang", "quote", "label")
    return L.coverage(rows, ["lang"])


@query(f"""
WITH p AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPANS}') AS a FROM documents), e AS (SELECT doc_id, unnest(a) AS piece, generate_subscripts(a, 1) AS i FROM p),
o AS (SELECT doc_id, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) - length(piece) AS pos0 FROM e)
SELECT doc_id, CAST(pos0 + length(piece) - length(regexp_replace(piece, '^{_W}+', '')) AS INTEGER) AS start_at, regexp_replace(piece, '{_EDGES}', '', 'g') AS quote
FROM o WHERE regexp_replace(piece, '{_EDGES}', '', 'g') <> '' AND NOT regexp_full_match(piece, '[\\n.؟!]+')
""")
def span_offsets(spark, sf_dir):
    """Offsets of the labelling stage's sentences."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(X.sentence_spans("text")).alias("s"))
    return rows.select("doc_id", F.col("s.start").alias("start_at"), "s.quote")


# --- search -------------------------------------------------------------------------------------------------
_TERMS = "t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')) AS term FROM documents) GROUP BY 1, 2)"
_QUERY = ["كان", "مات", "سنة"]


@query(f"WITH {_TERMS} SELECT doc_id FROM t GROUP BY 1 HAVING " + " AND ".join(f"bool_or(starts_with(term, '{q}'))" for q in _QUERY))
def prefix_fts_and(spark, sf_dir):
    return S.texts_with(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "text", _QUERY).select("doc_id")


@query(f"""WITH {_TERMS}, z AS (SELECT doc_id, sum(tf) AS len FROM t GROUP BY 1), st AS (SELECT count(*) AS n, avg(len) AS a FROM z),
d AS (SELECT term, count(*) AS df FROM t WHERE term IN ({', '.join(repr(q) for q in _QUERY)}) GROUP BY 1)
SELECT t.doc_id, round(sum(ln(1 + (st.n - d.df + 0.5) / (d.df + 0.5)) * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * z.len / st.a))), 6) AS score
FROM t JOIN d ON t.term = d.term JOIN z ON t.doc_id = z.doc_id, st GROUP BY 1""")
def bm25_rank(spark, sf_dir):
    return S.bm25_of_texts(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text", _QUERY).select("doc_id", F.round("score", 6).alias("score"))


@query(f"WITH {_TERMS}, z AS (SELECT term, doc_id, tf FROM t WHERE term IN ({', '.join(repr(q) for q in _QUERY)})) SELECT term, count(*) AS n_docs, CAST(sum(tf) AS BIGINT) AS n FROM z GROUP BY 1")
def term_index(spark, sf_dir):
    """Documents and occurrences of a few terms in the inverted index of all documents."""
    postings = S.index(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", {"text": "text"})
    return postings.where(F.col("term").isin(*_QUERY)).groupBy("term").agg(F.count("*").alias("n_docs"), F.sum("tf").alias("n"))


_SCORED = """CASE WHEN CAST(entry_number AS VARCHAR) = '{q}' THEN 0 WHEN display_name_norm = '{q}' THEN 1 WHEN starts_with(display_name_norm, '{q}') THEN 2 WHEN contains(display_name_norm, '{q}') THEN 3 END"""


@query("WITH p AS " + _now("persons", "*") + f""", h AS (SELECT person_id, entry_number, {_SCORED.format(q='عبد')} AS score FROM p)
SELECT person_id, entry_number, score FROM h WHERE score IS NOT NULL ORDER BY score, entry_number NULLS LAST, person_id LIMIT 30""")
def search_scored(spark, sf_dir):
    """A page of the entries whose number or name holds the word: equal ones first, then those that begin with it."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["entry_number", "display_name", "display_name_norm"])
    return S.scored(p, "عبد", 30).select("person_id", "entry_number", "score")


@query("WITH p AS " + _now("persons", "*") + """, t AS (SELECT person_id, unnest(regexp_extract_all(lower(coalesce(display_name_norm, '')), '[\\p{L}\\p{N}]+')) AS term FROM p),
z AS (SELECT person_id, count(*) AS len, count(*) FILTER (WHERE starts_with(term, 'عبد')) AS f1, count(*) FILTER (WHERE starts_with(term, 'بن')) AS f2 FROM t GROUP BY 1),
st AS (SELECT count(*) AS n, avg(len) AS a, count(*) FILTER (WHERE f1 > 0) AS d1, count(*) FILTER (WHERE f2 > 0) AS d2 FROM z)
SELECT person_id, round(ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) * f1 * 2.2 / (f1 + 1.2 * (0.25 + 0.75 * len / a)) + ln(1 + (n - d2 + 0.5) / (d2 + 0.5)) * f2 * 2.2 / (f2 + 1.2 * (0.25 + 0.75 * len / a)), 6) AS score
FROM z, st WHERE f1 > 0 AND f2 > 0""")
def search_ranked(spark, sf_dir):
    """Entries whose names hold words that begin with each of the query's, ranked by their weight."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["display_name_norm"])
    return S.bm25_of_texts(p, "person_id", "display_name_norm", ["عبد", "بن"], prefix=True, every=True).select("person_id", F.round("score", 6).alias("score"))


@query("WITH p AS " + _now("persons", "*") + """
SELECT person_id, entry_number, display_name FROM p WHERE qism = 1 AND coalesce(entry_marker, 'none') = 'none' AND NOT is_woman ORDER BY entry_number NULLS LAST, person_id LIMIT 25 OFFSET 10""")
def search_page(spark, sf_dir):
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["entry_number", "display_name", "qism", "entry_marker", "is_woman", "section_type", "letter", "entry_kind"])
    f = S.Filters.parse({"qism": "1", "marker": "none", "woman": "0", "limit": "25", "offset": "10"})
    return S.search(p, f).select("person_id", "entry_number", "display_name")


# --- names and citations in text ------------------------------------------------------------------------------
@query()
def name_chain_parse(spark, sf_dir):
    """Lineages read from the entries' openings; rejected chains keep their reason."""
    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body", "display_name"])
    return raw.select("person_id", read_lineage("text_body", "display_name").alias("n")).select(
        "person_id", "n.ism", "n.father", "n.full_name", "n.kunya", "n.source", "n.confidence", "n.rejected_reason", "n.link_count"
    )


_CITES = "(ذكره|ذكرها|ذكر|قاله|قال|أخرجه|أخرج|رواه|روى|أورده|نقله|حكاه|وثقه|ضعفه)[ ]+([^.،؛]{2,45})"


@query("WITH r AS " + _now("raw", "person_id, text_body") + f""", f AS (SELECT person_id, trim(regexp_replace(coalesce(text_body, ''), '[ \\t\\r\\n]+', ' ', 'g')) AS t FROM r),
m AS (SELECT person_id, unnest(regexp_extract_all(t, '{_CITES}', 1)) AS verb, unnest(regexp_extract_all(t, '{_CITES}', 2)) AS target FROM f),
v AS (SELECT authority_key, alias, bool_and(is_label) AS is_label FROM (SELECT authority_key, unnest(aliases) AS alias, false AS is_label FROM authorities UNION ALL SELECT authority_key, label_ar, true FROM authorities) WHERE alias IS NOT NULL AND alias <> '' GROUP BY 1, 2),
d AS (SELECT DISTINCT verb, target FROM m),
h AS (SELECT d.verb, d.target, v.authority_key FROM d JOIN v ON contains(d.target, v.alias) QUALIFY row_number() OVER (PARTITION BY d.verb, d.target ORDER BY length(v.alias) DESC, v.authority_key, v.is_label, v.alias) = 1)
SELECT DISTINCT m.person_id, h.authority_key, m.verb FROM m JOIN h ON m.verb = h.verb AND m.target = h.target""")
def text_citations(spark, sf_dir):
    """Authorities cited in the entries: the verb's window, the longest alias in it, each (authority, verb) once."""
    from ..operators.graph import citations_in

    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body"])
    flat = F.btrim(F.regexp_replace(F.coalesce("text_body", F.lit("")), r"[ \t\r\n]+", " "))
    from ..functions.vocab import Vocabulary

    return citations_in(raw.withColumn("flat", flat), "flat", "person_id", Vocabulary.load(table(spark, sf_dir, "authorities")))


@query("""
WITH e AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, sid
""")
def user_sessions(spark, sf_dir):
    """Sessions of events closed by a pause of half an hour (an extension: batch form of the stream operator)."""
    from ..streaming.incremental import sessions

    return sessions(table(spark, sf_dir, "events"), "ts", "30 minutes", ["user_id"])


# --- entries ---------------------------------------------------------------------------------------------------
from ..functions.vocab import Vocabulary  # noqa: E402
from ..operators import biography as Y  # noqa: E402


def _bodies(spark, sf_dir):
    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body", "footnotes"])
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["qism", "is_woman", "section_type", "nisba", "entry_marker"])
    return p.drop("ingested_at").join(raw.drop("ingested_at"), "person_id", "left")


@query("WITH p AS " + _now("persons", "person_id, qism") + ", r AS " + _now("raw", "person_id, text_body") + f""",
b AS (SELECT p.person_id, qism, coalesce(text_body, '') AS t, regexp_matches(coalesce(text_body, ''), '{Y.CROSS}') AS x FROM p LEFT JOIN r ON p.person_id = r.person_id)
SELECT person_id, CASE WHEN qism = 4 THEN 'qism4_refutation' WHEN length(t) < 150 AND NOT x THEN 'name_only' WHEN length(t) < 400 AND x AND contains(t, 'كنى') THEN 'kunya_redirect'
  WHEN length(t) < 400 AND x THEN 'crossref_stub' ELSE 'biography' END AS kind,
  CASE qism WHEN 1 THEN 'established' WHEN 2 THEN 'vision_or_birth' WHEN 3 THEN 'mukhadram' WHEN 4 THEN 'listed_in_error' ELSE 'disputed' END AS companionship_status FROM b""")
def entry_kinds(spark, sf_dir):
    b = _bodies(spark, sf_dir).withColumn("t", F.coalesce("text_body", F.lit("")))
    return b.select("person_id", Y.entry_kind(F.col("qism"), F.length("t"), F.col("t")).alias("kind"), Y.companionship_status(F.col("qism")).alias("companionship_status"))


@query()
def person_labels(spark, sf_dir):
    """Labels of every entry after classification."""
    tribes = Vocabulary.of([("ansari", ["الأنصاري"]), ("qurashi", ["القرشي"]), ("mawla", ["مولاهم", "مولى"])])
    battles = Vocabulary.of([("badr", ["بدر"]), ("uhud", ["أحد"]), ("siffin", ["صفين"])])
    out = Y.classified(_bodies(spark, sf_dir), "text_body", tribes, battles)
    return out.select("person_id", "length_class", "kind", "origin", "status", "generation", F.array_join("flags", ",").alias("flags"), F.array_join(F.transform("labels", lambda x: x["key"]), ",").alias("labels"))


@query()
def biography_facts(spark, sf_dir):
    """The long table of facts read from every entry by patterns."""
    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["text_body"])
    return Y.fact_groups(raw, "text_body", "person_id", capped=False)


@query("WITH p AS " + _now("persons", "person_id, death_year_hijri") + """, n AS """ + _now("nasab", "person_id, chain") + """
SELECT p.person_id, coalesce(death_year_hijri, -1) AS year, CAST(coalesce(len(chain), 0) AS INTEGER) AS links FROM p LEFT JOIN n ON p.person_id = n.person_id""")
def joined_features(spark, sf_dir):
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["death_year_hijri"]).drop("ingested_at")
    n = current_rows(table(spark, sf_dir, "nasab"), "person_id", ["chain"]).drop("ingested_at")
    return p.join(n, "person_id", "left").select("person_id", F.coalesce("death_year_hijri", F.lit(-1)).alias("year"), F.coalesce(F.size("chain"), F.lit(0)).alias("links"))


@query()
def chunk_text(spark, sf_dir):
    """Texts packed into chunks for an extractor."""
    d = table(spark, sf_dir, "documents").select("doc_id", X.chunks("text", most=None).alias("c"))
    return d.select("doc_id", F.posexplode("c").alias("chunk_no", "chunk")).select("doc_id", "chunk_no", F.length("chunk").alias("n_chars"))


@query()
def fact_counts(spark, sf_dir):
    """Facts and persons of each list of the nested records."""
    from ..operators.flatten import p4_found

    return Y.fact_counts(p4_found(spark, sf_dir))
