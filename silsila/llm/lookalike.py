"""One consistent form of text whose characters print alike.

Width, presentation forms and composition are folded by the characters' own properties, what prints nothing is
removed, every kind of blank becomes a space. Equal-looking letters and strings are united to transitive classes
(union-find over a table of pairs); each class is written as its member that the corpus uses most; a multi-pattern
automaton (Aho-Corasick, leftmost longest match) rewrites the rest. What is seen to differ stays: letters, dots,
hamzas, vowel marks, the number of blanks, line breaks.

Letters that look alike only where they join the next one (yeh and kaf of different keyboards) are decided by
their place; a zero-width non-joiner is kept where it breaks a joint that would be seen.

Defined cases: null stays null and an empty value empty; neither makes a pair.
"""
from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.current import latest
from ..session import materialize, spread

# --- fixed values ----------------------------------------------------------------------------------------
#: Equal-looking code points and strings: members of one row print alike everywhere.
ALIKE: list[tuple[str, ...]] = [
    ("a", "а"), ("c", "с"), ("d", "ԁ"), ("e", "е"), ("h", "һ"), ("i", "і"), ("j", "ј", "ϳ"), ("o", "о"), ("o", "ο"), ("p", "р"),
    ("q", "ԛ"), ("s", "ѕ"), ("v", "ν"), ("v", "ѵ"), ("w", "ԝ"), ("x", "х"), ("y", "у"),
    ("A", "А"), ("A", "Α"), ("B", "В"), ("B", "Β"), ("C", "С"), ("E", "Е"), ("E", "Ε"), ("H", "Н"), ("H", "Η"), ("I", "І"), ("I", "Ι"),
    ("J", "Ј"), ("K", "К"), ("K", "Κ"), ("M", "М"), ("M", "Μ"), ("N", "Ν"), ("O", "О"), ("O", "Ο"), ("P", "Р"), ("P", "Ρ"), ("Q", "Ԛ"),
    ("S", "Ѕ"), ("T", "Т"), ("T", "Τ"), ("W", "Ԝ"), ("X", "Х"), ("X", "Χ"), ("Y", "Υ"), ("Z", "Ζ"), ("Г", "Γ"), ("П", "Π"), ("Ф", "Φ"),
    ("o", "օ"), ("O", "Օ"), ("g", "ɡ"), ("A", "Ꭺ"), ("B", "Ᏼ"), ("C", "Ꮯ"), ("D", "Ꭰ"), ("E", "Ꭼ"), ("G", "Ꮐ"), ("H", "Ꮋ"), ("J", "Ꭻ"), ("K", "Ꮶ"), ("L", "Ꮮ"),
    ("M", "Ꮇ"), ("P", "Ꮲ"), ("S", "Ꮪ"), ("T", "Ꭲ"), ("V", "Ꮩ"), ("W", "Ꮃ"), ("Z", "Ꮓ"),
    ("٠", "۰"), ("١", "۱"), ("٢", "۲"), ("٣", "۳"), ("٧", "۷"), ("٨", "۸"), ("٩", "۹"),
    ("\u0626", "\u0649\u0654"), ("\u0626", "\u06cc\u0654"), ("\u0629", "\u06c3"),
    ("\u0e41", "\u0e40\u0e40"), ("-", "\u2010"), (":", "\u2236"), (":", "\u05c3"),
]
#: Kinds of compatibility that are only width, presentation or composition.
FOLDED_KINDS = ("<wide>", "<narrow>", "<initial>", "<medial>", "<final>", "<isolated>", "<noBreak>", "<compat>")
#: Arabic letters that do not join the letter after them.
NOT_JOINING = "ءآأؤإاةدذرزوٱٲٳٵڈډڊڋڌڍڎڏڐڑڒړڔڕږڗژڙۀۃۄۅۆۇۈۉۊۋۍۏەۮۯ"
# ---------------------------------------------------------------------------------------------------------

ZWNJ = "\u200c"
_MARKS = "\u0610-\u061a\u064b-\u065f\u0670\u06d6-\u06dc\u06df-\u06e4\u06e7\u06e8\u06ea-\u06ed"
_LETTERS = "\u0621-\u063f\u0641-\u064a\u066e\u066f\u0671-\u06d3\u06d5\u06ee\u06ef\u06fa-\u06fc\u06ff\u0750-\u077f"
_YEH_JOINED = re.compile(rf"ی(?=[{_MARKS}]*[ـ{_LETTERS}])")
_KAF_JOINED = re.compile(rf"ک(?=[{_MARKS}]*[ـ{_LETTERS}])")
_AE = re.compile(rf"ە(?![{_MARKS}]*[ـ{_LETTERS}])")
_KEPT_ZWNJ = re.compile(rf"(?<=[{_LETTERS}ـ])([{_MARKS}]*){ZWNJ}+(?=[{_LETTERS}ـ])")
_COMPOSABLE = re.compile(r"[\u0300-\u036f\u0610-\u061a\u064b-\u065f\u0670\u06d6-\u06ed]|[^\x00-\u06ff]")


class _Fold(dict):
    """Code point to what is printed; filled as code points are met."""

    def __missing__(self, code: int):
        char = chr(code)
        category = unicodedata.category(char)
        kind = unicodedata.decomposition(char).split(" ", 1)[0]
        if char == ZWNJ:
            out: str | None = char
        elif category == "Cf" or char == "\u034f" or 0xFE00 <= code <= 0xFE0F or 0x180B <= code <= 0x180F or 0x115F <= code <= 0x1160:
            out = None
        elif category == "Zs" or char == "\t":
            out = " "
        elif 0xFDF0 <= code <= 0xFDFF and code != 0xFDF2:
            out = char  # signs for whole phrases do not look like them
        elif kind in FOLDED_KINDS and not unicodedata.normalize("NFKC", char).startswith(" "):
            out = unicodedata.normalize("NFKC", char)
        else:
            out = char
        self[code] = out
        return out


_FOLD = _Fold()


def _break_or_drop(m: re.Match) -> str:
    """A non-joiner is seen only between a letter that joins and one that is joined."""
    before = m.string[m.start() - 1]
    return m[1] if before in NOT_JOINING else m[1] + ZWNJ


def printed(text: str) -> str:
    """``text`` with width, presentation, composition, blanks and invisible characters folded."""
    if text.isascii():
        return text.replace("\r\n", "\n").replace("\r", "\n").replace("\t", " ") if "\r" in text or "\t" in text else text
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = text.translate(_FOLD)
    if ZWNJ in text:
        held = _KEPT_ZWNJ.sub(_break_or_drop, text)
        text = re.sub(rf"(?<![{_LETTERS}ـ{_MARKS}]){ZWNJ}|{ZWNJ}(?![{_LETTERS}ـ])", "", held)
    if _COMPOSABLE.search(text):
        text = unicodedata.normalize("NFC", text)
    if "ی" in text:
        text = _YEH_JOINED.sub("ي", text.replace("\u06cc\u0654", "\u0626")).replace("ی", "ى")
    if "ک" in text:
        text = _KAF_JOINED.sub("ك", text)
    if "ە" in text:
        text = _AE.sub("ه", text)
    if "\u0654" in text:  # a hamza left on a yeh that was decided only now
        text = unicodedata.normalize("NFC", text)
    return text


def classes(pairs: list[tuple[str, ...]] = ALIKE) -> list[list[str]]:
    """Transitive classes of look-alike strings by union-find."""
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for first, *others in pairs:
        for other in others:
            a, b = find(first), find(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
    groups: dict[str, list[str]] = {}
    for x in sorted(parent):
        groups.setdefault(find(x), []).append(x)
    return list(groups.values())


def member_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """How often the columns hold each member of a class, over all rows; as many rows reach the driver as there are members."""
    members = sorted({m for group in classes() for m in group})
    single = [m for m in members if len(m) == 1]
    longer = [m for m in members if len(m) > 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for column in batch.columns:
                text = "\n".join(printed(v) for v in column.drop_null().to_pylist())
                found = Counter(text)
                total.update({m: found[m] for m in single})
                total.update({m: text.count(m) for m in longer})
        rows = [(m, n) for m, n in total.items() if n]
        yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=["member", "n"])

    counted = df.select(*columns).mapInArrow(run, "member string, n long").groupBy("member").agg(F.sum("n").alias("n"))
    return {r["member"]: r["n"] for r in counted.collect()}


def representatives(counts: dict[str, int]) -> dict[str, str]:
    """Each member that is not its class's most frequent one (ties: the smallest), with that one."""
    out = {}
    for group in classes():
        best = min(group, key=lambda m: (-counts.get(m, 0), m))
        out.update({m: best for m in group if m != best})
    return out


class Canonical:
    """The consistent form of a value."""

    def __init__(self, rewrite: dict[str, str]):
        import ahocorasick

        self.rewrite = rewrite
        self.automaton = ahocorasick.Automaton()
        for member in rewrite:
            self.automaton.add_word(member, member)
        self.automaton.make_automaton()
        self.any = re.compile("|".join(map(re.escape, sorted(rewrite, key=len, reverse=True)))).search

    def __call__(self, text: str | None) -> str | None:
        if not text:
            return text
        text = printed(text)
        if self.any(text) is None:
            return text
        out, at = [], 0
        for end, member in self.automaton.iter_long(text):
            out.append(text[at : end + 1 - len(member)])
            out.append(self.rewrite[member])
            at = end + 1
        out.append(text[at:])
        return "".join(out)


def _hashes(df: DataFrame, key: str, order: str, columns: list[str], rewrite: dict[str, str]) -> DataFrame:
    """``key, order, state``: of each column 128-bit hashes of its canonical form and of its characters."""
    names = [x for c in columns for x in (f"{c}__form", f"{c}__chars")]
    state = T.StructType([T.StructField(n, T.BinaryType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest as digest

        canonical = Canonical(rewrite)
        for batch in batches:
            arrays = []
            for column in batch.columns[2:]:
                values = column.to_pylist()
                arrays.append(pa.array([digest(canonical(v).encode("utf-8", "surrogatepass")) if v else None for v in values], pa.binary()))
                arrays.append(pa.array([digest(v.encode("utf-8", "surrogatepass")) if v else None for v in values], pa.binary()))
            packed = pa.StructArray.from_arrays(arrays, names)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=[key, order, "state"])

    schema = T.StructType([df.schema[key], df.schema[order], T.StructField("state", state)])
    return df.where(F.col(key).isNotNull()).select(key, order, *columns).mapInArrow(run, schema)


def alike_values(tables: list[tuple[DataFrame, list[str]]], key: str = "person_id", order: str = "ingested_at", rewrite: dict[str, str] | None = None) -> DataFrame:
    """``field_name, form, chars, key`` of the current row of each key, one row for each field with a value."""
    if rewrite is None:
        counts: Counter[str] = Counter()
        for df, columns in tables:
            counts.update(member_counts(df, columns))
        rewrite = representatives(counts)
    parts = []
    for df, columns in tables:
        rows = latest(_hashes(df, key, order, columns, rewrite), key, "state", order)
        fields = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"state.{c}__form").alias("form"), F.col(f"state.{c}__chars").alias("chars")) for c in columns])
        parts.append(rows.select(key, F.explode(fields).alias("f")).where("f.form is not null").select("f.field_name", "f.form", "f.chars", key))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def alike_pairs(values: DataFrame, key: str = "person_id", slice_rows: int = 4000) -> DataFrame:
    """Pairs of keys whose values print alike but differ in their characters.

    Values are joined by variant, not by row: only classes with several variants take part, variants are paired
    within their class, and rows are joined to the pairs of variants. No comparison is made that gives no pair. A
    variant with many rows is cut into slices, so that no task gets all of them.
    """
    values = materialize(values)
    variants = values.groupBy("field_name", "form", "chars").agg(F.count("*").alias("n"))
    several = variants.groupBy("field_name", "form").agg(F.min("chars").alias("lo"), F.max("chars").alias("hi")).where("lo < hi").select("field_name", "form")
    variants = materialize(variants.join(several, ["field_name", "form"], "left_semi"))
    rows = materialize(values.join(variants.select("field_name", "chars", "n"), ["field_name", "chars"]))
    a = variants.select("field_name", "form", F.col("chars").alias("chars_a"))
    b = variants.select("field_name", "form", F.col("chars").alias("chars_b"), F.ceil(F.col("n") / slice_rows).cast("int").alias("slices"))
    pairs = a.join(b, ["field_name", "form"]).where("chars_a < chars_b")
    left = rows.select("field_name", F.col("chars").alias("chars_a"), F.col(key).alias("x"))
    left = left.join(pairs, ["field_name", "chars_a"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    right = rows.select(
        "field_name", F.col("chars").alias("chars_b"), F.col(key).alias("y"),
        F.pmod(F.xxhash64(key), F.ceil(F.col("n") / slice_rows)).cast("int").alias("slice"),
    )
    out = left.join(right, ["field_name", "chars_b", "slice"])
    return out.select("field_name", F.least("x", "y").alias("person_a"), F.greatest("x", "y").alias("person_b"))


def alike_classes(values: DataFrame, key: str = "person_id") -> DataFrame:
    """``field_name, key, class_id, n_variants, n_links`` of each value: its class of values that print alike, the different
    strings in it, and the keys whose value prints alike but differs in its characters. Copies are counted, not paired."""
    values = materialize(values)
    variants = values.groupBy("field_name", "form", "chars").agg(F.count("*").alias("n"))
    classes_ = variants.groupBy("field_name", "form").agg(F.count("*").alias("n_variants"), F.sum("n").alias("n_keys"))
    sized = variants.join(classes_, ["field_name", "form"]).select("field_name", "chars", "form", "n_variants", (F.col("n_keys") - F.col("n")).alias("n_links"))
    rows = values.select("field_name", "chars", key).join(sized, ["field_name", "chars"])
    return rows.select("field_name", key, F.lower(F.hex("form")).alias("class_id"), "n_variants", "n_links")


def _tables(spark, sf_dir: str) -> list[tuple[DataFrame, list[str]]]:
    return [
        (spark.read.parquet(f"{sf_dir}/persons.parquet").select("person_id", "ingested_at", "display_name", "full_name"), ["display_name", "full_name"]),
        (spread(spark.read.parquet(f"{sf_dir}/raw.parquet").select("person_id", "ingested_at", "text_body")), ["text_body"]),
    ]


def p2_found(spark, sf_dir: str) -> DataFrame:
    return alike_pairs(alike_values(_tables(spark, sf_dir)))


def p2_classes(spark, sf_dir: str) -> DataFrame:
    return alike_classes(alike_values(_tables(spark, sf_dir)))


def canonical_values(df: DataFrame, columns: list[str], rewrite: dict[str, str], key: str = "person_id", order: str = "ingested_at") -> DataFrame:
    """``key, field_name, form``: the consistent form of each value of the current rows, null for null."""
    state = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical(rewrite)
        for batch in batches:
            arrays = [pa.array([canonical(v) for v in column.to_pylist()], pa.string()) for column in batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.StructArray.from_arrays(arrays, columns)], names=[key, order, "state"])

    schema = T.StructType([df.schema[key], df.schema[order], T.StructField("state", state)])
    rows = latest(df.where(F.col(key).isNotNull()).select(key, order, *columns).mapInArrow(run, schema), key, "state", order)
    fields = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"state.{c}").alias("form")) for c in columns])
    return rows.select(key, F.explode(fields).alias("f")).select(key, "f.field_name", "f.form")


def p2_forms(spark, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    counts: Counter[str] = Counter()
    for df, columns in tables:
        counts.update(member_counts(df, columns))
    rewrite = representatives(counts)
    parts = [canonical_values(df, columns, rewrite) for df, columns in tables]
    return parts[0].unionByName(parts[1])
