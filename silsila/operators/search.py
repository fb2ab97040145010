"""Full-text search over an inverted index, filters, pages and ranking."""
from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.folding import fold
from ..functions.text import score_hit
from ..session import materialize
from .relational import having_all

TOKEN = r"[\p{L}\p{N}]+"
K1, B = 1.2, 0.75
#: Characters with a meaning in a query, taken out of its words.
QUERY_MARKS = "\"'^:(){}"


def index(df: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """``term, field, key, tf``: one shuffle, terms counted before it within a document."""
    parts = []
    for name, column in fields.items():
        words = F.regexp_extract_all(F.lower(F.coalesce(column, F.lit(""))), F.lit(TOKEN), F.lit(0))
        parts.append(df.select(key, F.lit(name).alias("field"), F.explode(words).alias("term")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("term", "field", key).agg(F.count("*").alias("tf"))


def lengths(postings: DataFrame, key: str) -> DataFrame:
    return postings.groupBy(key).agg(F.sum("tf").alias("length"))


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def texts_with(df: DataFrame, text: str, tokens: list[str]) -> DataFrame:
    """Rows whose text has, for each token, a word that begins with it: one narrow filter, no index. No tokens find nothing."""
    if not tokens:
        return df.limit(0)
    def begun(t: str) -> Column:
        return F.exists("__words", lambda w: F.startswith(w, F.lit(t)))

    held = F.lit(True)
    for t in tokens:
        held = held & begun(t)
    return df.withColumn("__words", _words(text)).where(held).drop("__words")


def bm25_of_texts(df: DataFrame, key: str, text: str, terms: list[str], prefix: bool = False, every: bool = False) -> DataFrame:
    """``key, score`` of the texts that hold one of the terms (or ``every`` one), by the words that equal it or begin with it.

    Only the wanted terms and the length are counted of each text; what is kept of a text is a few numbers, and the
    statistics over all texts are one row.
    """
    def count(t: str) -> Column:
        return F.size(F.filter("__words", lambda w: F.startswith(w, F.lit(t)) if prefix else w == t))

    words = df.select(key, _words(text).alias("__words")).where("size(__words) > 0")
    counted = materialize(words.select(key, F.size("__words").alias("__length"), *[count(t).alias(f"__t{i}") for i, t in enumerate(terms)]))
    stats = counted.agg(F.count("*").alias("__n"), F.avg("__length").alias("__mean"), *[F.count_if(F.col(f"__t{i}") > 0).alias(f"__d{i}") for i in range(len(terms))])
    # one row of statistics
    rows = counted.crossJoin(F.broadcast(stats))
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, n = F.col(f"__t{i}"), F.col(f"__d{i}")
        score = score + F.log(1 + (F.col("__n") - n + 0.5) / (n + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("__length") / F.col("__mean")))
    held = [F.col(f"__t{i}") > 0 for i in range(len(terms))]
    kept = F.lit(every)
    for h in held:
        kept = kept & h if every else kept | h
    return rows.where(kept).select(key, score.alias("score"))


#: Latin spellings of frequent names (fixed values).
LATIN_ALIASES = {
    "abu huraira": "أبو هريرة", "abu hurayra": "أبو هريرة", "abu": "أبو", "abu bakr": "أبو بكر", "umar": "عمر", "uthman": "عثمان", "ali": "علي", "aisha": "عائشة", "anas": "أنس", "bilal": "بلال",
    "hamza": "حمزة", "khadija": "خديجة", "ibn umar": "عبد الله بن عمر", "ibn abbas": "عبد الله بن عباس", "ibn masud": "عبد الله بن مسعود", "salman": "سلمان", "muadh": "معاذ",
}
#: The letters of a book in their order.
LETTER_ORDER = [
    "حرف الألف", "حرف الهمزة", "حرف الباء", "حرف التاء", "حرف الثاء", "حرف الجيم", "حرف الحاء المهملة", "حرف الخاء المعجمة", "حرف الدال المهملة", "حرف الذال المعجمة", "حرف الراء", "حرف الزاي", "حرف السين المهملة",
    "حرف الشين المعجمة", "حرف الصاد المهملة", "حرف الضاد المعجمة", "حرف الطاء المهملة", "حرف الظاء", "حرف العين المهملة", "حرف الغين المعجمة", "حرف الفاء", "حرف القاف", "حرف الكاف", "حرف اللام", "حرف الميم",
    "حرف النون", "حرف الهاء", "حرف الواو", "حرف الياء",
]
ROW = [
    "person_id", "entry_number", "display_name", "full_name", "kunya", "nisba", "is_woman", "qism", "section_type", "letter", "volume", "page_start", "page_end", "char_len", "death_year_hijri",
    "nasab_confidence", "entry_number_is_ambiguous", "entry_marker", "entry_kind",
]


def resolved_query(text: str) -> str:
    """What a Latin spelling stands for; any other query as it is."""
    return LATIN_ALIASES.get((text or "").strip().lower(), text or "")


def decorated(rows: DataFrame) -> DataFrame:
    """The columns of a row that is shown; unknown truths count as false, a missing list of affiliations as empty."""
    have = set(rows.columns)
    shown = []
    for c in ROW:
        if c not in have:
            shown.append(F.lit(None).alias(c))
        elif c in ("is_woman", "entry_number_is_ambiguous"):
            shown.append(F.coalesce(c, F.lit(False)).alias(c))
        elif c == "nisba":
            shown.append(F.coalesce(c, F.array().cast("array<string>")).alias(c))
        else:
            shown.append(F.col(c))
    return rows.select(*shown)


def scored(persons: DataFrame, text: str, limit: int = 40, offset: int = 0, key: str = "person_id") -> DataFrame:
    """A page of the persons whose number or folded name holds the query, with ``score``: the number 0, an equal name 1, one
    that begins with it 2, one that holds it 3, and 4 for all where nothing is asked."""
    needle = fold(resolved_query(text))
    score = score_hit(F.lit(needle), F.col("entry_number"), F.col("display_name_norm")) if needle else F.lit(4)
    rows = persons.withColumn("score", score).where("score is not null")
    return rows.orderBy("score", F.asc_nulls_last("entry_number"), key).offset(offset).limit(limit)


def labels_of(rows: DataFrame, key: str, labels: dict[str, str], out: str = "label") -> DataFrame:
    """The label of each key; a key without one stands for itself."""
    if not labels:
        return rows.withColumn(out, F.col(key))
    table = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return rows.withColumn(out, F.coalesce(F.try_element_at(table, F.col(key)), F.col(key)))


def query_tokens(text: str) -> list[str]:
    """Words of a query in lower case; each is a prefix that must be found."""
    return [w for w in re.sub(f"[{re.escape(QUERY_MARKS)}]", " ", text or "").lower().split() if w]


def prefix_and(postings: DataFrame, key: str, tokens: list[str], fields: list[str] | None = None) -> DataFrame:
    """Keys that have, in these fields, a term beginning with each token. No tokens find nothing."""
    if not tokens:
        return postings.select(key).limit(0)
    rows = postings if fields is None else postings.where(F.col("field").isin(*fields))
    wanted = F.array(*[F.when(F.startswith("term", F.lit(t)), F.lit(i)) for i, t in enumerate(tokens)])
    hits = rows.select(key, F.explode(F.array_compact(wanted)).alias("token"))
    return hits.groupBy(key).agg(F.count_distinct("token").alias("n")).where(F.col("n") == len(tokens)).select(key)


def bm25(postings: DataFrame, key: str, terms: list[str], sizes: DataFrame | None = None) -> DataFrame:
    """``key, score`` of documents that hold one of the terms; statistics over all documents, the terms' postings only joined."""
    sizes = lengths(postings, key) if sizes is None else sizes
    stats = sizes.agg(F.count("*").alias("n_docs"), F.avg("length").alias("avg_length")).withColumn("all", F.lit(1))
    tf = postings.where(F.col("term").isin(*terms)).groupBy("term", key).agg(F.sum("tf").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    # as many rows as the query has terms
    rows = tf.join(F.broadcast(df), "term").join(sizes, key).withColumn("all", F.lit(1)).join(F.broadcast(stats), "all")  # one row of statistics
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("avg_length")))
    return rows.groupBy(key).agg(F.sum(part).alias("score"))


@dataclass
class Filters:
    """Parsed filters: limit 1 to 100 (40 where absent or 0), offset from 0, tri-state woman."""

    q: str = ""
    limit: int = 40
    offset: int = 0
    woman: bool | None = None
    qism: int | None = None
    section: str | None = None
    letter: str | None = None
    marker: str | None = None
    kind: str | None = None
    in_text: bool = False
    include_refuted: bool = False
    postings: list[tuple[str, str]] = field(default_factory=list)

    @classmethod
    def parse(cls, given: dict[str, str]) -> Filters:
        def number(name: str) -> int | None:
            value = str(given.get(name) or "").strip()
            return int(value) if re.fullmatch(r"-?\d+", value) else None

        woman = {"1": True, "true": True, "0": False, "false": False}.get(str(given.get("woman", "")).lower())
        facets = ("battle", "place", "tribe", "nisba", "verdict", "label", "event", "authority", "office")
        return cls(
            q=str(given.get("q") or "").strip(), limit=max(1, min(100, number("limit") or 40)), offset=max(0, number("offset") or 0), woman=woman, qism=number("qism"),
            section=given.get("section") or None, letter=given.get("letter") or None, marker=given.get("marker") or None, kind=given.get("kind") or None,
            in_text=str(given.get("in_text", "")) in ("1", "true"), include_refuted=str(given.get("include_refuted", "")) in ("1", "true"),
            postings=[(k, given[k]) for k in facets if given.get(k)],
        )

    def predicate(self) -> Column:
        out = F.lit(True)
        for column, value in (("qism", self.qism), ("section_type", self.section), ("letter", self.letter), ("is_woman", self.woman), ("entry_kind", self.kind)):
            if value is not None:
                out = out & (F.col(column) == value)
        if self.marker is not None:
            out = out & (F.coalesce("entry_marker", F.lit("none")) == self.marker)
        if not self.include_refuted and self.qism is None and any(k in ("battle", "place", "nisba") for k, _ in self.postings):
            out = out & (F.col("qism").isNull() | (F.col("qism") != 4))
        return out


def search(persons: DataFrame, filters: Filters, postings: DataFrame | None = None, terms: DataFrame | None = None, key: str = "person_id", ranked: bool = False) -> DataFrame:
    """One page: a number is an entry's number, other words are prefixes that must all be found, nothing browses all.

    ``ranked`` puts the entries first in which the words weigh most; else, and among equals, they go by number.
    """
    rows = persons.where(filters.predicate())
    if filters.postings and postings is not None:
        rows = having_all(rows, key, postings, filters.postings)
    if re.fullmatch(r"\d+", filters.q):
        rows = rows.where(F.col("entry_number") == int(filters.q))
    elif filters.q and terms is not None:
        fields = ["display_name", "full_name", "name_keys"] + (["text_body"] if filters.in_text else [])
        tokens = query_tokens(filters.q)
        rows = rows.join(prefix_and(terms, key, tokens, fields), key, "left_semi")
        if ranked:
            wanted = terms.where(F.col("field").isin(*fields))
            begun = F.array_compact(F.array(*[F.when(F.startswith("term", F.lit(t)), F.lit(t)) for t in tokens]))
            weights = bm25(wanted.withColumn("term", F.explode(begun)), key, tokens, lengths(wanted, key)).withColumnRenamed("score", "__weight")
            rows = rows.join(weights, key, "left").orderBy(F.desc_nulls_last("__weight"), F.asc_nulls_last("entry_number"), key)
            return rows.drop("__weight").offset(filters.offset).limit(filters.limit)
    return rows.orderBy(F.asc_nulls_last("entry_number"), key).offset(filters.offset).limit(filters.limit)
