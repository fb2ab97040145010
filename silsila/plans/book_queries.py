"""Structure of books over the driver's tables: the entries' texts as pages, their headings as tables of contents."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators import structure as B
from ..operators.current import current_rows
from .core_queries import _now, query, table
from .lineage_sql import BLANKS_SQL, flat_sql, squeezed_sql


def _rows(spark, sf_dir) -> DataFrame:
    """Entries in the order of their book."""
    raw = current_rows(table(spark, sf_dir, "raw"), "person_id", ["entry_number", "start_id", "end_id", "volume", "page_start", "display_name", "text"])
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["letter"]).drop("ingested_at")
    order = Window.partitionBy("book").orderBy("start_id", "person_id")
    return raw.join(p, "person_id", "left").withColumn("book", F.substring_index("person_id", ":", 1)).withColumn("k", F.row_number().over(order))


ROWS_SQL = f"""e AS (SELECT r.*, p.letter, split_part(r.person_id, ':', 1) AS book, row_number() OVER (PARTITION BY split_part(r.person_id, ':', 1) ORDER BY start_id, r.person_id) AS k
  FROM {_now('raw', 'person_id, entry_number, start_id, end_id, volume, page_start, display_name, text')} r LEFT JOIN {_now('persons', 'person_id, letter')} p ON r.person_id = p.person_id)"""


def toc_of(rows: DataFrame) -> DataFrame:
    """Each entry's heading, and before it that of its letter."""
    title = F.concat(F.col("entry_number").cast("string"), F.lit("- "), F.coalesce("display_name", F.lit("؟")))
    entries = rows.select("book", (2 * F.col("k")).alias("ord"), F.col("start_id").alias("id"), F.lit(5).alias("lvl"), title.alias("title"))
    letters = rows.where("letter is not null").select("book", (2 * F.col("k") - 1).alias("ord"), F.col("start_id").alias("id"), F.lit(2).alias("lvl"), F.concat(F.lit("حرف "), "letter").alias("title"))
    return entries.unionByName(letters)


def pages_of(rows: DataFrame) -> DataFrame:
    """The texts that begin on a page, one behind the other."""
    whole = rows.groupBy("book", F.col("start_id").alias("id")).agg(
        F.min("page_start").alias("page"), F.min("volume").alias("part"), F.sort_array(F.collect_list(F.struct("k", F.coalesce("text", F.lit("")).alias("text")))).alias("t")
    )
    return whole.select("book", "id", "page", "part", F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("text"))


PAGES_SQL = "g AS (SELECT book, start_id AS id, min(page_start) AS page, min(volume) AS part, string_agg(coalesce(text, ''), chr(10) ORDER BY k) AS text FROM e GROUP BY 1, 2)"


@query(f"""WITH {ROWS_SQL}, c AS (SELECT *, last_value(letter IGNORE NULLS) OVER (PARTITION BY book ORDER BY k ROWS UNBOUNDED PRECEDING) AS carried FROM e)
SELECT book, k AS entry, 'حرف ' || carried AS letter, CAST(CASE WHEN carried IS NULL THEN 1 ELSE 2 END AS INTEGER) AS path_length FROM c""")
def carry_forward_context(spark, sf_dir):
    """The letter under which each entry stands, carried from the heading before it, and its path in the table of contents."""
    found = B.placement(toc_of(_rows(spark, sf_dir)).where("title is not null"))
    return found.where("lvl = 5").select("book", F.expr("ord div 2").alias("entry"), "letter", F.size("toc_path").alias("path_length"))


_NAME = "trim(regexp_replace(coalesce(display_name, '؟'), '[\\t\\n\\v\\f\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g'))"


@query(f"""WITH {ROWS_SQL}, h AS (SELECT book, k, start_id, CAST(entry_number AS INTEGER) AS entry_number, {_NAME} AS name FROM e WHERE regexp_matches(CAST(entry_number AS VARCHAR) || '- ' || coalesce(display_name, '؟'), '{B.HEADING}')),
j AS (SELECT *, CASE WHEN regexp_matches(name, '{B.STRUCTURAL}') THEN 'structural_heading' WHEN entry_number > {B.LAST_NUMBER} THEN 'number_out_of_range' END AS reject_reason FROM h),
a AS (SELECT *, count(*) OVER (PARTITION BY book, entry_number) > 1 AS is_ambiguous, row_number() OVER (PARTITION BY book, entry_number, start_id ORDER BY k) - 1 AS ordinal, row_number() OVER (PARTITION BY book ORDER BY k) AS doc_ord,
  lead(start_id) OVER (PARTITION BY book ORDER BY k) AS end_id FROM j WHERE reject_reason IS NULL)
SELECT book, CAST(2 * k AS INTEGER) AS ord, entry_number, name, is_ambiguous, CAST(ordinal AS INTEGER) AS ordinal, CAST(doc_ord AS INTEGER) AS doc_ord, coalesce(end_id, 1000000) AS end_id, NULL AS reject_reason FROM a
UNION ALL SELECT book, CAST(2 * k AS INTEGER), entry_number, name, NULL, NULL, NULL, NULL, reject_reason FROM j WHERE reject_reason IS NOT NULL""")
def book_entries(spark, sf_dir):
    """Entries read from the headings: numbers, names, page ranges, repeated numbers, rejects."""
    found = B.entries(toc_of(_rows(spark, sf_dir)).where("lvl = 5 and title is not null"), F.lit(1_000_000).cast("long"))
    return found.select("book", "ord", "entry_number", "name", F.col("entry_number_is_ambiguous").alias("is_ambiguous"), "ordinal", "doc_ord", "end_id", "reject_reason")


@query(f"""WITH {ROWS_SQL}, {PAGES_SQL} SELECT e.person_id, count(*) AS n_pages, CAST(sum(length(g.text)) AS BIGINT) AS chars FROM e JOIN g ON e.book = g.book AND g.id BETWEEN e.start_id AND e.end_id GROUP BY 1""")
def entry_pages(spark, sf_dir):
    """Pages of each entry's range and their characters."""
    rows = _rows(spark, sf_dir)
    found = B.paged(rows.select("book", "person_id", "start_id", "end_id"), pages_of(rows).select("book", "id", "text"), "start_id", "end_id")
    return found.groupBy("person_id").agg(F.count("*").alias("n_pages"), F.sum(F.length("text")).cast("long").alias("chars"))


@query(f"""WITH {ROWS_SQL}, s AS (SELECT book, unnest(generate_series(1, (SELECT max(end_id) + 3 FROM e))) AS id FROM (SELECT DISTINCT book FROM e))
SELECT book, id FROM s WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.book = s.book AND s.id BETWEEN e.start_id AND e.end_id)""")
def page_coverage(spark, sf_dir):
    """Pages of each book that no entry covers."""
    rows = _rows(spark, sf_dir).select("book", F.col("start_id").alias("id"), "end_id")
    last = rows.agg((F.max("end_id") + 3).alias("last"))
    spine = rows.select("book").distinct().crossJoin(F.broadcast(last)).select("book", F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("id"))  # one row of the last page
    return B.page_coverage(spine, rows)


@query(f"""WITH {ROWS_SQL}, {PAGES_SQL}, w AS (SELECT e.book, e.k, e.start_id, {_NAME} AS name, nullif(strpos(chr(10) || g.text, chr(10) || CAST(e.entry_number AS VARCHAR) || '-'), 0) AS by_number, g.text
  FROM e JOIN g ON e.book = g.book AND e.start_id = g.id WHERE e.entry_number IS NOT NULL),
a AS (SELECT book, k, start_id, coalesce(CASE WHEN by_number > 1 THEN by_number - 1 ELSE by_number END, CASE WHEN length(n3) >= 4 THEN nullif(strpos(text, n3), 0) END, 2147483647) AS place FROM (SELECT *, array_to_string(string_split(name, ' ')[1:3], ' ') AS n3 FROM w))
SELECT book, k AS entry, CAST(row_number() OVER (PARTITION BY book ORDER BY start_id, place, CASE WHEN place = 2147483647 THEN -k ELSE k END) AS INTEGER) AS doc_ord FROM a""")
def order_in_page(spark, sf_dir):
    """Entries by page and, within a page, by where their headings stand in its text."""
    rows = _rows(spark, sf_dir)
    found = B.entries(toc_of(rows).where("lvl = 5 and title is not null"), F.lit(1_000_000).cast("long")).select("book", "ord", "id", "entry_number", "name")
    return B.in_page_order(found, pages_of(rows)).select("book", F.expr("ord div 2").alias("entry"), "doc_ord")


@query(f"""WITH {ROWS_SQL}, {PAGES_SQL}, s AS (SELECT e.person_id, g.id, g.page, g.text, coalesce(sum(length(g.text) + 2) OVER (PARTITION BY e.person_id ORDER BY g.id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM e JOIN g ON e.book = g.book AND g.id BETWEEN e.start_id AND e.end_id),
o AS (SELECT DISTINCT person_id, x FROM e, (VALUES (0), (500), (5000), (50000)) v(x))
SELECT o.person_id, CAST(o.x AS INTEGER) AS "at", coalesce(min(CASE WHEN o.x BETWEEN a AND a + length(text) THEN id END), max(id)) AS page_id FROM o JOIN s USING (person_id) GROUP BY 1, 2""")
def page_of_offset(spark, sf_dir):
    """The page on which an offset of an entry's joined text lies."""
    rows = _rows(spark, sf_dir)
    spans = B.page_spans(rows, pages_of(rows), ["person_id"], "start_id", "end_id")
    offsets = rows.select("book", "person_id", F.explode(F.array(*[F.lit(x) for x in (0, 500, 5000, 50000)])).alias("at"))
    return B.page_at(offsets, spans, ["person_id"]).select("person_id", "at", "page_id")


@query(f"""WITH {ROWS_SQL} SELECT e.person_id, e.start_id, p.qism FROM e JOIN {_now('persons', 'person_id, qism')} p ON e.person_id = p.person_id""")
def raw_with_placement(spark, sf_dir):
    """Entries with their placement; one without would fail the job."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["qism"]).select("person_id", "qism")
    return B.placed(_rows(spark, sf_dir).select("person_id", "start_id"), p)


@query(f"""WITH {ROWS_SQL} SELECT person_id, coalesce(lag(person_id) OVER w, '') AS previous_id, coalesce(lead(person_id) OVER w, '') AS next_id FROM e WINDOW w AS (PARTITION BY book ORDER BY k)""")
def entry_neighbors(spark, sf_dir):
    """The entries before and behind each in its book."""
    found = R.neighbors(_rows(spark, sf_dir).select("book", "k", "person_id"), ["book"], ["k"], "person_id")
    return found.select("person_id", F.coalesce("previous_person_id", F.lit("")).alias("previous_id"), F.coalesce("next_person_id", F.lit("")).alias("next_id"))


_FOUND = f"""j AS (SELECT book, k, start_id, CAST(entry_number AS INTEGER) AS entry_number, CASE WHEN regexp_matches({_NAME}, '{B.STRUCTURAL}') THEN 'structural_heading' WHEN entry_number > {B.LAST_NUMBER} THEN 'number_out_of_range' END AS reason
  FROM e WHERE regexp_matches(CAST(entry_number AS VARCHAR) || '- ' || coalesce(display_name, '؟'), '{B.HEADING}'))"""


def _found(rows: DataFrame) -> DataFrame:
    return B.entries(toc_of(rows).where("lvl = 5 and title is not null"), F.lit(1_000_000).cast("long"))


@query(f"""WITH {ROWS_SQL}, {_FOUND} SELECT book, entry_number, 'ambiguous' AS reason, count(*) AS n FROM j WHERE reason IS NULL GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT book, entry_number, 'suspect', count(*) FROM j WHERE entry_number > {B.LAST_NUMBER} GROUP BY 1, 2""")
def suspect_numbers(spark, sf_dir):
    """Entry numbers that several entries of a book bear, and those beyond the printed ones."""
    return B.suspect_numbers(_found(_rows(spark, sf_dir)))


@query(f"""WITH {ROWS_SQL}, {_FOUND}, {PAGES_SQL} SELECT 'pages' AS counter, count(*) AS n FROM g UNION ALL SELECT 'toc_nodes', (SELECT count(*) FROM e WHERE entry_number IS NOT NULL) + (SELECT count(*) FROM e WHERE letter IS NOT NULL)
UNION ALL SELECT 'entries', count(*) FROM j WHERE reason IS NULL UNION ALL SELECT 'rejected_toc_candidates', count(*) FROM j WHERE reason IS NOT NULL
UNION ALL SELECT 'ambiguous_entry_numbers', count(*) FROM (SELECT 1 FROM j WHERE reason IS NULL GROUP BY book, entry_number HAVING count(*) > 1)
UNION ALL SELECT 'chapters', count(*) FROM e WHERE letter IS NOT NULL
UNION ALL SELECT 'corpus_chars', CAST(sum(length(text)) AS BIGINT) FROM e""")
def corpus_manifest(spark, sf_dir):
    """Counters of the corpus read as books."""
    rows = _rows(spark, sf_dir)
    toc = toc_of(rows).where("title is not null")
    none = rows.limit(0).select("book", F.col("start_id").alias("id"))
    return B.manifest(pages_of(rows), toc, _found(rows), B.chapters(toc, none, F.lit(1_000_000).cast("long")), rows)


@query(f"""WITH p AS {_now('persons', 'person_id, entry_marker')} SELECT coalesce(entry_marker, 'none') AS marker, count(*) AS n FROM p GROUP BY 1""")
def marker_counts(spark, sf_dir):
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["entry_marker"])
    return B.marker_counts(p.withColumn("reject_reason", F.lit(None).cast("string")))


@query(f"""WITH p AS {_now('persons', 'person_id, display_name')} SELECT person_id, {squeezed_sql("regexp_replace(regexp_replace(" + flat_sql('display_name') + ", '([：:،,.؛]|" + BLANKS_SQL + ")+$', ''), '[-–—]" + BLANKS_SQL + "*$', '')")} AS name FROM p""")
def clean_names(spark, sf_dir):
    """Display names without note markers and closing marks."""
    p = current_rows(table(spark, sf_dir, "persons"), "person_id", ["display_name"])
    return p.select("person_id", B.clean_name("display_name").alias("name"))
