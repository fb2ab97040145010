"""Text functions as built-in column expressions: nothing here leaves the JVM."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------------
NOTE_MARKERS = r"«\s*[0-9]+\s*»|\[\s*\(\s*[0-9]+\s*\)\s*\]|\(\s*[0-9]+\s*\)"
PUNCTUATION = r"""[.,،؛;:!؟?"'`«»‹›()\[\]{}\-–—_*/\\|]+"""
#: Spelled numerals; unknown words are skipped, each known word adds.
NUMERALS = {
    "واحد": 1, "إحدى": 1, "احدى": 1, "اثنتين": 2, "اثنين": 2, "ثلاث": 3, "ثلاثة": 3, "أربع": 4, "اربع": 4, "أربعة": 4, "خمس": 5, "خمسة": 5,
    "ست": 6, "ستة": 6, "سبع": 7, "سبعة": 7, "ثمان": 8, "ثماني": 8, "ثمانية": 8, "تسع": 9, "تسعة": 9, "عشر": 10, "عشرة": 10, "عشرين": 20,
    "ثلاثين": 30, "أربعين": 40, "اربعين": 40, "خمسين": 50, "ستين": 60, "سبعين": 70, "ثمانين": 80, "تسعين": 90, "مائة": 100, "مئة": 100,
}
LAST_YEAR = 1500
#: What a quotation of a clause may begin with or leave out.
CONNECTIVE = r"^(?:و|ف|ثم|قال)\s*"
SHORTEST_QUOTE = 8
CHUNK, CHUNKS = 9000, 8
# ----------------------------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c: Column | str) -> Column:
    """Runs of blanks as one space, outer blanks removed."""
    return F.btrim(F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?U)\s+", " "))


def strip_notes(c: Column | str) -> Column:
    """Editors' note markers and guillemets removed."""
    return squeeze(F.regexp_replace(F.regexp_replace(F.coalesce(_col(c), F.lit("")), NOTE_MARKERS, " "), "[«»]", " "))


def flatten(c: Column | str) -> Column:
    """One line without note markers."""
    return strip_notes(squeeze(c))


def western_digits(c: Column | str) -> Column:
    return F.translate(_col(c), "٠١٢٣٤٥٦٧٨٩", "0123456789")


def line_ends(c: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"\r\n?", "\n")


def split_footnotes(c: Column | str) -> Column:
    """``struct(body, footnotes)``: the text before the first rule of underscores and the numbered notes behind it."""
    parts = F.split(line_ends(c), r"\n?_{3,}\n?")
    rest = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "\n")
    marks = F.regexp_extract_all(rest, F.lit(r"\(\s*([0-9]+)\s*\)\s*([^\n]+)"), F.lit(1))
    notes = F.regexp_extract_all(rest, F.lit(r"\(\s*([0-9]+)\s*\)\s*([^\n]+)"), F.lit(2))
    zipped = F.zip_with(marks, notes, lambda m, n: F.struct(m.cast("int").alias("marker"), squeeze(n).alias("text")))
    return F.struct(F.regexp_replace(parts[0], r"(?U)^\s+|\s+$", "").alias("body"), F.filter(zipped, lambda x: x["text"] != "").alias("footnotes"))


def verification_key(c: Column | str) -> Column:
    """Key under which a quotation is looked up: punctuation removed, spelling folded."""
    from .folding import folded

    return squeeze(folded(F.regexp_replace(flatten(c), PUNCTUATION, " ")))


def plain_key(c: Column | str) -> Column:
    """Lower case with single spaces; for keys of Latin text, without folding."""
    return F.lower(F.btrim(F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"[ \t\r\n]+", " ")))


def parse_year(c: Column | str) -> Column:
    """A year from digits (1 to 1500) or from spelled numerals that add up; null for anything else."""
    text = F.coalesce(_col(c), F.lit(""))
    digits = F.regexp_extract(western_digits(text), "([0-9]{1,4})", 1)
    words = F.split(F.regexp_replace(text, "[ً-ْٰـ]", ""), r"(?U)\s*و\s*|\s+")
    table = F.create_map(*[x for w, n in NUMERALS.items() for x in (F.lit(w), F.lit(n))])
    values = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), F.lit(0)))
    total = F.aggregate(values, F.lit(0), lambda a, v: a + v)
    number = F.when(digits != "", digits.cast("int")).otherwise(total)
    return F.when((number > 0) & (number <= LAST_YEAR), number)


def sentence_spans(c: Column | str) -> Column:
    """Array of ``(start, quote)`` by marks and line breaks alone, offsets in code points from 0, blanks outside left out.

    This is the fast splitter of the labelling stage; it knows no abbreviations or quotations.
    """
    text = F.coalesce(_col(c), F.lit(""))
    pieces = F.regexp_extract_all(text, F.lit(r"[^\n.؟!]+(?:[.؟!]+(?:\s*\[\s*\(\s*[0-9]+\s*\)\s*\])?|\n+|$)|[\n.؟!]+"), F.lit(0))
    empty = F.array().cast("array<struct<start:int,quote:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        lead = F.length(piece) - F.length(F.regexp_replace(piece, r"(?U)^\s+", ""))
        body = F.regexp_replace(piece, r"(?U)^\s+|\s+$", "")
        keep = (body != "") & ~F.regexp_like(piece, F.lit(r"^[\n.؟!]+$"))
        row = F.struct((acc["at"] + lead).cast("int").alias("start"), body.alias("quote"))
        return F.struct((acc["at"] + F.length(piece)).alias("at"), F.when(keep, F.array_append(acc["out"], row)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(pieces, start, step, lambda acc: acc["out"])


def sentences(c: Column | str) -> Column:
    """Flattened text cut behind closing marks, pieces of more than three characters."""
    return F.filter(F.split(flatten(c), r"(?<=[.؟!؛])\s+"), lambda s: F.length(s) > 3)


def length_class(n: Column | str) -> Column:
    n = _col(n)
    return F.when(n < 200, "stub").when(n < 800, "short").when(n < 4000, "medium").otherwise("long")


def chunks(c: Column | str, limit: int = CHUNK, most: int | None = CHUNKS) -> Column:
    """Paragraphs packed to chunks of at most ``limit`` characters, the first ``most`` of them, or all.

    Paragraphs stand apart by a blank line; one that is longer than the limit begins a chunk and is packed sentence by
    sentence, with a space between them. A single longer sentence stays whole.
    """
    text = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?U)^\s+|\s+$", "")
    paragraphs = F.filter(F.split(text, r"\n{2,}"), lambda p: ~F.regexp_like(p, F.lit(r"(?U)^\s*$")))

    def units(p: Column) -> Column:
        sentences_ = F.transform(F.split(p, r"(?U)(?<=[.؟!])\s+"), lambda s, i: F.struct(s.alias("t"), F.lit(" ").alias("gap"), (i == 0).alias("first")))
        whole = F.array(F.struct(p.alias("t"), F.lit("\n\n").alias("gap"), F.lit(False).alias("first")))
        return F.when(F.length(p) <= limit, whole).otherwise(sentences_)

    acc = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("now"))

    def step(a: Column, u: Column) -> Column:
        over = F.length(a["now"]) + F.length(u["t"]) + F.length(u["gap"]) > limit
        full = (a["now"] != "") & (over | u["first"])
        return F.struct(F.when(full, F.array_append(a["out"], a["now"])).otherwise(a["out"]).alias("out"), F.concat(F.when(full, "").otherwise(a["now"]), u["t"], u["gap"]).alias("now"))

    packed = F.aggregate(F.flatten(F.transform(paragraphs, units)), acc, step, lambda a: F.array_append(a["out"], a["now"]))
    packed = F.filter(F.transform(packed, lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")), lambda p: p != "")
    return F.when(F.length(text) <= limit, F.array(text)).otherwise(packed if most is None else F.slice(packed, 1, most))


def snippet(c: Column | str, size: int) -> Column:
    """Head (40 %) and tail of a long text with an ellipsis line between them."""
    text = _col(c)
    head = int(size * 0.4)
    return F.when(F.length(text) <= size, text).otherwise(F.concat(F.left(text, F.lit(head)), F.lit("\n…\n"), F.right(text, F.lit(size - head))))


def person_key(slug: Column, book: Column, number: Column, page: Column, ordinal: Column) -> Column:
    base = F.concat(slug, F.lit(":"), book.cast("string"), F.lit(":"), number.cast("string"), F.lit("-"), page.cast("string"))
    return F.when(ordinal > 0, F.concat(base, F.lit("."), ordinal.cast("string"))).otherwise(base)


PERSON_KEY = r"^[a-z]+:[0-9]+:[0-9]+-[0-9]+(\.[0-9]+)?$"


def score_hit(needle: Column, number: Column, name: Column) -> Column:
    """0 for the entry's number, 1 equal, 2 prefix, 3 contained, null otherwise; spellings must be folded already."""
    return F.when(needle == number.cast("string"), 0).when(name == needle, 1).when(F.startswith(name, needle), 2).when(F.contains(name, needle), 3)


def ordered_distinct(items: Column, key) -> Column:
    """Items of an array without those whose key came before."""
    keys = F.transform(items, key)
    return F.filter(items, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def confidence(layer: Column, status: Column) -> Column:
    """Confidence by layer and evidence: patterns 0.3, structure 1, verified 0.9, unverified 0.55, else 0.7."""
    return F.when(layer == "regex", 0.3).when(layer == "structural", 1.0).when(status == "verified", 0.9).when(status == "unverified", 0.55).otherwise(0.7)


def evidence_status(source: Column | str, quote: Column | str) -> Column:
    """absent, too_short, verified or unverified: whether the source holds the quote.

    Both are compared by their ``verification_key``, of which under 8 characters are too short; a connective at the
    quote's beginning may be missing in the source. A null or empty quote is absent.
    """
    given = _col(quote)
    hay, needle = verification_key(source), verification_key(quote)
    bare = F.regexp_replace(needle, CONNECTIVE, "")
    held = F.contains(hay, needle) | ((F.length(bare) >= SHORTEST_QUOTE) & F.contains(hay, bare))
    status = F.when(F.length(needle) < SHORTEST_QUOTE, "too_short").when(held, "verified").otherwise("unverified")
    return F.when(given.isNull() | (given == ""), "absent").otherwise(status)
