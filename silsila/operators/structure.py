"""Structure of a book: headings, carried context, ancestor paths, chapters, entries cut from pages.

A book's table of contents is small and ordered as a whole; its operators run within one book (``book`` is a key of
every window), so that many books spread over the cluster.
"""
from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import squeeze, strip_notes
from .relational import range_join, uncovered

# --- fixed values ----------------------------------------------------------------------------------
#: Number, up to six characters of marker, dash, name.
HEADING = r"^([0-9]+)[ ]*(?:([^0-9 \-–—]{1,6})[ ]*)?[-–—][ ]*(.+)$"
STRUCTURAL = r"^(?:ال)?(?:قسم|فصل|باب|حرف|مجلد)(?:\s|$)|^(?:القسم|الفصل|الباب|المجلد)|نسبه ومولده|ترتيب الإصابة|منهج|تعريف الصحابي|عدالة الصحابة|طبقات الصحابة|ميزات|مقدمة|وصف نسخ"
QISM = {"الأول": 1, "الاول": 1, "الثاني": 2, "الثالث": 3, "الرابع": 4}
SECTIONS = [("women", "النساء"), ("kunya", "الكنى"), ("names", r"حرف\s|باب\s+(?:الهمزة|الألف)"), ("intro", "مقدمة|من هو الصحابي|تعريف الصحابي|منهج|عدالة|طبقات الصحابة")]
CHAPTERS = [
    ("definition", "من هو الصحابي|تعريف الصحابي|الصحابي لغة"), ("virtue_adala", "عدالة|فضل الصحابة|عقيدة"), ("method", "منهج|ترتيب الإصابة|ميزات القسم|وصف نسخ"),
    ("taxonomy", "طبقات|عدد الصحابة|المكثرين"), ("preface", "مقدمة"), ("qism_heading", "قسم"), ("letter_heading", r"^(?:تتمة\s+)?حرف\s|^باب\s"),
    ("block_heading", "الكنى|النساء"), ("volume_heading", "المجلد"),
]
TEXT_KINDS = ("preface", "definition", "method", "virtue_adala", "taxonomy")
TEXT_LIMIT = 40_000
#: Page numbers in a bin of the joins of ranges with pages.
PAGE_BIN = 16
LAST_NUMBER = 13_000
# ---------------------------------------------------------------------------------------------------


def first_rule(rules: Sequence[tuple[str, str]], text: Column, other: str) -> Column:
    """Name of the first rule whose pattern is found."""
    return F.coalesce(*[F.when(F.regexp_like(text, F.lit(p)), F.lit(n)) for n, p in rules], F.lit(other))


def qism_of(title: Column) -> Column:
    word = F.regexp_extract(title, r"(?:ال)?قسم\s+(الأول|الاول|الثاني|الثالث|الرابع)", 1)
    digit = F.regexp_extract(title, r"(?:^|\s)([1-4])\s*[-–—.,]?\s*(?:ال)?قسم", 1)
    table = F.create_map(*[x for w, n in QISM.items() for x in (F.lit(w), F.lit(n))])
    return F.when(F.contains(title, F.lit("قسم")), F.coalesce(F.try_element_at(table, word), F.when(digit != "", digit.cast("int"))))


def letter_of(title: Column) -> Column:
    found = F.regexp_extract(title, r"^(?:تتمة\s+)?(حرف\s+[^\s،,]+(?:\s+المهملة|\s+المعجمة)?)", 1)
    return F.when(found != "", squeeze(found))


def volume_of(title: Column) -> Column:
    found = F.regexp_extract(title, r"المجلد\s+(\S+)", 1)
    return F.when(found != "", F.concat(F.lit("المجلد "), found))


def bab_of(title: Column) -> Column:
    other = F.regexp_like(title, F.lit("المجلد|قسم|الكنى|النساء"))
    return F.when(~other & F.regexp_like(title, F.lit(r"بعدها|^باب\s")), squeeze(title))


def walked(toc: DataFrame) -> DataFrame:
    """``toc(book, ord, id, lvl, title)`` with ``titles``, those of the open ancestors and the node itself, and ``next_id``,
    the page of the next node that is no deeper.

    A table of contents is read once in its order with a stack of open nodes, whatever its depth; one book's is one task.
    """
    schema = T.StructType([*toc.schema.fields, T.StructField("titles", T.ArrayType(T.StringType())), T.StructField("next_id", T.LongType())])

    def run(nodes):
        nodes = nodes.sort_values("ord", kind="stable").reset_index(drop=True)
        open_: list[int] = []
        titles, closes = [], [None] * len(nodes)
        for i, (level, page) in enumerate(zip(nodes["lvl"].tolist(), nodes["id"].tolist())):
            while open_ and nodes["lvl"].iat[open_[-1]] >= level:
                closes[open_.pop()] = page
            open_.append(i)
            titles.append([nodes["title"].iat[k] for k in open_])
        nodes["titles"] = titles
        nodes["next_id"] = pd.array(closes, dtype="Int64")
        return nodes

    return toc.groupBy("book").applyInPandas(run, schema)


def placement(toc: DataFrame) -> DataFrame:
    """Context at each node of ``toc(book, ord, id, lvl, title)``: volume, letter, bab, qism and section carried forward.

    The bab ends where a new letter begins; the section is only replaced by one that is known.
    """
    rows = walked(toc)
    t = F.col("title")
    rows = rows.withColumns({
        "__v": volume_of(t), "__q": qism_of(t), "__l": letter_of(t), "__b": bab_of(t),
        "__s": F.nullif(first_rule(SECTIONS, F.array_join("titles", " | "), "other"), F.lit("other")),
    })
    order = Window.partitionBy("book").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__group", F.count("__l").over(order))
    in_letter = Window.partitionBy("book", "__group").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        "book", "ord", "id", "lvl", "title", F.last("__v", True).over(order).alias("volume_toc"), F.last("__l", True).over(order).alias("letter"),
        F.last("__b", True).over(in_letter).alias("bab"), F.last("__q", True).over(order).alias("qism"),
        F.coalesce(F.last("__s", True).over(order), F.lit("other")).alias("section_type"),
        F.slice("titles", F.greatest(F.size("titles") - 5, F.lit(1)), 6).alias("toc_path"),
    )


def entries(toc: DataFrame, last_page: Column) -> DataFrame:
    """Entries of ``toc(book, ord, id, lvl, title)``: number, marker, name, page range, repeated numbers, ordinals.

    ``reject_reason`` marks numbered headings of structure and numbers beyond the printed ones; they are kept apart,
    not dropped.
    """
    rows = toc.where(F.regexp_like("title", F.lit(HEADING))).withColumns({
        "entry_number": F.regexp_extract("title", HEADING, 1).cast("int"), "entry_marker": F.nullif(F.regexp_extract("title", HEADING, 2), F.lit("")),
        "name": squeeze(F.regexp_extract("title", HEADING, 3)),
    })
    rows = rows.withColumn("reject_reason", F.when(F.regexp_like("name", F.lit(STRUCTURAL)), "structural_heading").when(F.col("entry_number") > LAST_NUMBER, "number_out_of_range"))
    good, bad = rows.where("reject_reason is null"), rows.where("reject_reason is not null")
    order = Window.partitionBy("book").orderBy("ord")
    good = good.withColumn("end_id", F.coalesce(F.lead("id").over(order), last_page)).withColumn("doc_ord", F.row_number().over(order))
    good = good.withColumn("next_number", F.lead("entry_number").over(order)).withColumn("next_name", F.lead("name").over(order))
    good = good.withColumn("entry_number_is_ambiguous", F.count("*").over(Window.partitionBy("book", "entry_number")) > 1)
    good = good.withColumn("ordinal", F.row_number().over(Window.partitionBy("book", "entry_number", "id").orderBy("ord")) - 1)
    return good.unionByName(bad, allowMissingColumns=True)


def clean_name(raw: Column | str) -> Column:
    """A heading's name without note markers and what closes it: marks, commas, colons, a dash."""
    bare = F.regexp_replace(strip_notes(raw), r"(?U)[：:،,.؛\s]+$", "")
    return squeeze(F.regexp_replace(bare, r"(?U)[-–—]\s*$", ""))


def marker_counts(found: DataFrame) -> DataFrame:
    """Entries by marker, without one as ``none``."""
    return found.where("reject_reason is null").groupBy(F.coalesce("entry_marker", F.lit("none")).alias("marker")).agg(F.count("*").alias("n"))


def suspect_numbers(found: DataFrame) -> DataFrame:
    """``book, entry_number, reason, n``: numbers that several entries bear, and those beyond the printed ones."""
    several = found.where("reject_reason is null").groupBy("book", "entry_number").agg(F.count("*").alias("n")).where("n > 1").withColumn("reason", F.lit("ambiguous"))
    beyond = found.where(F.col("entry_number") > LAST_NUMBER).groupBy("book", "entry_number").agg(F.count("*").alias("n")).withColumn("reason", F.lit("suspect"))
    return several.unionByName(beyond).select("book", "entry_number", "reason", "n")


def manifest(pages: DataFrame, toc: DataFrame, found: DataFrame, chapter_rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``counter, n``: pages, nodes, entries, chapters, repeated numbers, rejected headings and characters of a corpus."""
    good = F.col("reject_reason").isNull()
    counts = [
        pages.agg(F.lit("pages").alias("counter"), F.count("*").alias("n")), toc.agg(F.lit("toc_nodes").alias("counter"), F.count("*").alias("n")),
        found.agg(F.lit("entries").alias("counter"), F.count_if(good).alias("n")), found.agg(F.lit("rejected_toc_candidates").alias("counter"), F.count_if(~good).alias("n")),
        suspect_numbers(found).where("reason = 'ambiguous'").agg(F.lit("ambiguous_entry_numbers").alias("counter"), F.count("*").alias("n")),
        chapter_rows.agg(F.lit("chapters").alias("counter"), F.count("*").alias("n")), texts.agg(F.lit("corpus_chars").alias("counter"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("n")),
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def chapters(toc: DataFrame, entry_pages: DataFrame, last_page: Column) -> DataFrame:
    """Chapters of ``toc``: nodes that are no entries, with kind and page range; the range ends before the next node as shallow."""
    rows = walked(toc).join(entry_pages.select("book", "id").distinct(), ["book", "id"], "left_anti").where(~F.regexp_like("title", F.lit(HEADING)))
    rows = rows.withColumn("kind", first_rule(CHAPTERS, F.col("title"), "other")).where("lvl <= 2 or kind != 'other'")
    return rows.withColumn("end_id", F.greatest("id", F.coalesce(F.col("next_id") - 1, last_page))).drop("next_id", "titles")


def paged(ranges: DataFrame, pages: DataFrame, first: str, last: str) -> DataFrame:
    """``ranges(book, ..)`` with each of their pages, by bins of page numbers within a book."""
    of_page = pages.select("book", F.col("id").alias("page_id"), *[c for c in pages.columns if c not in ("book", "id")])
    return range_join(of_page, ranges, "page_id", first, last, PAGE_BIN, by=["book"])


def chapter_texts(found: DataFrame, pages: DataFrame, limit: int | None = TEXT_LIMIT) -> DataFrame:
    """Text of prose chapters: pages of the range in order until the text before a page has passed the limit, or all."""
    rows = found.where(F.col("kind").isin(*TEXT_KINDS)).select("book", "ord", F.col("id").alias("a"), "end_id")
    rows = paged(rows, pages.select("book", "id", "text"), "a", "end_id")
    if limit is not None:
        so_far = Window.partitionBy("book", "ord").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("__before", F.coalesce(F.sum(F.length("text")).over(so_far), F.lit(0))).where(F.col("__before") <= limit)
    parts = rows.groupBy("book", "ord").agg(F.sort_array(F.collect_list(F.struct("page_id", "text"))).alias("p"))
    return parts.select("book", "ord", F.array_join(F.transform("p", lambda x: x["text"]), "\n\n").alias("text"))


def in_page_order(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """``nodes(book, ord, id, entry_number, name)`` with ``doc_ord``: by page, within a page by where the heading stands in it.

    A heading is looked up by its number, else by its name; those that the page does not hold come last, in reverse order.
    """
    text = pages.select("book", "id", F.col("text").alias("__text"))
    at = F.coalesce(_heading_at("entry_number", "name", F.coalesce("__text", F.lit(""))), F.lit(2**31 - 1))
    rows = nodes.join(text, ["book", "id"], "left").withColumn("__at", at).drop("__text")
    return rows.withColumn("doc_ord", F.row_number().over(Window.partitionBy("book").orderBy("id", "__at", F.when(F.col("__at") == 2**31 - 1, -F.col("ord")).otherwise(F.col("ord"))))).drop("__at")


def page_spans(ranges: DataFrame, pages: DataFrame, keys: Sequence[str], first: str = "id", last: str = "end_id", gap: int = 2) -> DataFrame:
    """``keys, page_id, page, part, span_start, span_end``: the offsets that each page takes in the joined text of a range."""
    rows = paged(ranges.select("book", *keys, first, last), pages.select("book", "id", "page", "part", F.length("text").alias("__size")), first, last)
    before = Window.partitionBy("book", *keys).orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("__size") + gap).over(before), F.lit(0))
    return rows.withColumn("span_start", start).select("book", *keys, "page_id", "page", "part", "span_start", (F.col("span_start") + F.col("__size")).alias("span_end"))


def page_at(offsets: DataFrame, spans: DataFrame, keys: Sequence[str], at: str = "at") -> DataFrame:
    """The page in which each offset lies: the first whose span holds it, else the last page of its text."""
    rows = offsets.join(spans, ["book", *keys])
    held = (F.col(at) >= F.col("span_start")) & (F.col(at) <= F.col("span_end"))
    best = rows.groupBy("book", *keys, at).agg(
        F.min(F.when(held, F.struct("span_start", "page_id", "page", "part"))).alias("__held"), F.max(F.struct("span_start", "page_id", "page", "part")).alias("__last")
    )
    return best.select("book", *keys, at, F.coalesce("__held", "__last").alias("p")).select("book", *keys, at, "p.page_id", "p.page", "p.part")


def placed(raw: DataFrame, placements: DataFrame, key: str = "person_id") -> DataFrame:
    """``raw`` with its placement; an entry without one fails the job, since both must come from one pass."""
    rows = raw.join(placements.withColumn("__placed", F.lit(True)), key, "left")
    ok = F.assert_true(F.col("__placed").isNotNull(), F.concat(F.lit("no placement for "), F.col(key)))
    return rows.where(ok.isNull()).drop("__placed")


def page_coverage(pages: DataFrame, ranges: DataFrame, first: str = "id", last: str = "end_id") -> DataFrame:
    """Pages that no entry and no chapter covers."""
    covered = ranges.select("book", F.explode(F.sequence(first, last)).alias("id")).withColumn("__on", F.concat_ws(":", "book", "id"))
    spine = pages.select("book", "id").withColumn("__on", F.concat_ws(":", "book", "id"))
    return uncovered(spine, covered, "__on").drop("__on")


def _heading_at(number: str, name: str, text: Column) -> Column:
    """Where a heading stands, from 1: by its number at a line's beginning, else by its first three words; null if nowhere."""
    pattern = F.concat(F.lit(r"(?:^|\n)[^\S\n]*"), F.col(number).cast("string"), F.lit(r"[^\n0-9]{0,6}?[-–—]"))
    by_number = F.regexp_instr(text, pattern)
    words = F.array_join(F.slice(F.split(name, " "), 1, 3), " ")
    by_name = F.when(F.length(words) >= 4, F.instr(text, words)).otherwise(0)
    return F.coalesce(F.nullif(by_number, F.lit(0)), F.nullif(by_name, F.lit(0)))


def entry_texts(found: DataFrame, pages: DataFrame) -> DataFrame:
    """``book, doc_ord, text``: each entry's pages joined, cut from its own heading to the next entry's.

    The own heading is looked up by its number at a line's beginning, else by its first three words, else the text
    begins with the page. The end is the next number's heading behind it, else the next name, else the last page's end.
    """
    rows = found.where("reject_reason is null").select("book", "doc_ord", "entry_number", "name", "next_number", "next_name", "id", "end_id")
    joined = paged(rows.select("book", "doc_ord", "id", "end_id"), pages.select("book", "id", "text"), "id", "end_id")
    whole = joined.groupBy("book", "doc_ord").agg(F.sort_array(F.collect_list(F.struct("page_id", "text"))).alias("p"))
    whole = whole.select("book", "doc_ord", F.array_join(F.transform("p", lambda x: x["text"]), "\n\n").alias("t"))
    rows = rows.join(whole, ["book", "doc_ord"])
    rows = rows.withColumn("from", F.coalesce(_heading_at("entry_number", "name", F.col("t")), F.lit(1)))
    rows = rows.withColumn("rest", F.expr("substring(t, `from` + 1)"))
    rows = rows.withColumn("stop", _heading_at("next_number", "next_name", F.col("rest")))
    cut = F.when(F.col("stop").isNotNull(), F.expr("substring(t, `from`, stop)")).otherwise(F.expr("substring(t, `from`)"))
    return rows.select("book", "doc_ord", "entry_number", "name", F.regexp_replace(cut, r"(?U)^\s+|\s+$", "").alias("text"))
