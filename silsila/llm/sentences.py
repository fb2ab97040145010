"""Sentence boundaries across languages and scripts.

The method is that of the standard sentence-break properties: terminators of all scripts, closing
quotation marks and brackets, numbers and lower-case continuation, with suppression of the abbreviations of the
paragraph's language. A paragraph is always left at a blank line. Work grows in proportion to the text, however many
marks and quotations a paragraph has.

Defined cases: a null, empty or blank text has no sentences; a paragraph without any letter or digit is one
sentence; a quotation mark without its partner in the paragraph is ordinary text.
"""
from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: character classes -----------------------------------------------------------------
#: What prints nothing.
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\ufeff"
#: Full stops that may also close an abbreviation or stand in a number.
DOTS = ".․…．﹒"
#: Tibetan shads close a sentence, too, though they lack the property of sentence terminals.
SHADS = "\u0f0d\u0f0e"
#: Scripts without closing marks, in which white space divides the sentences (Thai, Lao).
UNMARKED = "\u0e01-\u0e3a\u0e40-\u0e5b\u0e81-\u0edf"
QUOTES = {"«": "»", "“": "”", "”": "“", '"': '"', "„": "“", "「": "」", "『": "』", "｢": "｣", "＂": "＂", "‹": "›", "《": "》"}
CLOSERS = "»”“\"」』｣＂›》)\\]）］}'’"
#: Abbreviations that never end a sentence before a capital letter (they stand before a name), that point at something
#: which follows, and that may be the last word of a sentence; accents left out.
TITLES = {
    "en": {"dr", "prof", "mr", "mrs", "st", "rev", "gen", "col", "capt", "hon", "pres", "b", "bt", "d"},
    "de": {"dr", "prof", "hr", "fr", "frl", "st", "hl", "dipl", "ing", "b", "bt"},
    "fr": {"dr", "pr", "m", "mm", "mme", "mmes", "mlle", "mgr", "st", "ste", "me", "b", "bt"},
    "es": {"dr", "dra", "prof", "sr", "sra", "srta", "sres", "d", "dna", "lic", "ing", "sto", "sta", "ud", "uds", "b", "bt"},
}
REFERENCES = {
    "en": {
        "vol", "vols", "no", "nos", "p", "pp", "fol", "fols", "ff", "cf", "c", "ca", "i.e", "e.g", "ed", "eds", "ch", "sec",
        "fig", "art", "viz", "ms", "mss", "approx", "vs", "trans", "tr", "n", "l", "ll", "r", "v", "s", "q.v", "s.v",
    },
    "de": {"nr", "vgl", "bzw", "bd", "bde", "s", "anm", "abb", "hrsg", "evtl", "ggf", "ca", "geb", "gest", "art", "abs", "kap", "sog", "inkl", "max", "min", "ebd", "fol"},
    "fr": {"vol", "no", "p", "pp", "fig", "t", "chap", "ed", "cf", "env", "art", "av", "apr", "ms", "mss", "fol", "al"},
    "es": {"vol", "num", "nums", "pag", "pags", "p", "pp", "fig", "cap", "ed", "aprox", "art", "cf", "ms", "fol", "tel", "av"},
}
FINALS = {
    "en": {"jr", "sr", "etc", "al", "ibid", "ah", "ad", "bc", "ce", "bce", "a.h", "a.d", "b.c", "op", "cit", "esq", "inc", "ltd", "co"},
    "de": {"usw", "etc", "jh", "chr", "co", "ff", "u.a", "n.chr", "v.chr"},
    "fr": {"etc", "ibid", "cie", "j.-c", "s"},
    "es": {"etc", "ibid", "cia", "a.c", "d.c", "jr"},
}
#: Frequent words by which a paragraph's language is told; without any the English lists hold.
FREQUENT = {
    "en": {"the", "and", "of", "was", "is", "to", "his", "he", "in", "for", "with", "that"},
    "de": {"der", "die", "das", "und", "ist", "nicht", "ein", "eine", "den", "dem", "mit", "von", "zu", "auch"},
    "fr": {"le", "la", "les", "et", "est", "une", "des", "du", "dans", "que", "qui", "il", "au"},
    "es": {"el", "la", "los", "las", "y", "es", "una", "del", "en", "que", "por", "con", "su"},
}
#: Words that begin a sentence though an initial stands before them.
STARTERS = {
    "he", "she", "it", "they", "we", "i", "the", "his", "her", "its", "their", "this", "that", "these", "those", "there", "here",
    "in", "on", "at", "a", "an", "and", "but", "when", "where", "who", "what", "why", "how", "did", "does", "was", "is", "according",
    "nothing", "no", "some", "all", "then", "after", "before",
}
#: Letters of other scripts that look like Latin ones in a short token.
LATIN_ALIKE = str.maketrans("аеосрхуіАВЕНІКМОРСТХУοαεορνΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeocpxyiABEHIKMOPCTXYoaeopvABEZHIKMNOPTYX")
# ------------------------------------------------------------------------------------------------------
#: Marks that close a sentence wherever they stand outside quotation marks: Unicode's Sentence_Terminal but for ``DOTS``.
STRONG = "".join(c for c in regex.findall(r"\p{Sentence_Terminal}", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))) if c not in DOTS) + SHADS
_LONGEST = max(len(x) for lists in (TITLES, REFERENCES, FINALS) for words in lists.values() for x in words)

_BREAK = r"(?>\r\n|[\n\r\x85\u2028])"
_PARAGRAPHS = re.compile(rf"{_BREAK}(?:[^\S\r\n\x85\u2028\u2029]|[{INVISIBLE}])*{_BREAK}[\s{INVISIBLE}]*|\u2029\s*")
_MARKS = re.compile(f"[{DOTS}{STRONG}]+")
_SPACE_UNMARKED = re.compile(rf"(?<=[{UNMARKED}])[{INVISIBLE}]*(\s+)(?=[{INVISIBLE}]*[^\W\d_])")
_QUOTE = re.compile("[" + "".join(QUOTES) + "]")
_INVISIBLE = re.compile(f"[{INVISIBLE}]")
_VISIBLE_NEXT = re.compile(rf"[{INVISIBLE}]*(.)", re.S)
_NEXT_WORD = re.compile(rf"[\s{INVISIBLE}{re.escape('([{«“')}\"'\-–—]*(.)([^\W\d_]*)", re.S)
_TAIL = re.compile(
    rf"(?:[{INVISIBLE}]*[{CLOSERS}])*"
    rf"(?:[\s{INVISIBLE}]{{0,8}}(?:[\[［][\s{INVISIBLE}]*)?[(（\[［][\s{INVISIBLE}]*(?:\d[{INVISIBLE}]*){{1,4}}[)）\]］](?:[\s{INVISIBLE}]*[\]］])?|[{INVISIBLE}]*[¹²³⁰⁴-⁹]+)*"
)
_TOKEN = re.compile(r"[^\s(\[{（［«“\"'「『،,؛;:/\-–—]{1,12}$")
_BEFORE_TOKEN = re.compile(rf"(\d)[{INVISIBLE}]*\s+[{INVISIBLE}]*$")
_WORD = re.compile(r"[^\W_]")
_LATIN_WORD = re.compile(r"[A-Za-z\u00c0-\u024f]+")
_HEAD = re.compile(rf"[\s{INVISIBLE}]*(?:\d[{INVISIBLE}]*)+$")


class _Quotations:
    """The quotations of a paragraph, one behind the other."""

    def __init__(self, text: str, start: int, end: int):
        self.begins: list[int] = []
        self.closes: list[int] = []
        at, missing = start, set()
        while (m := _QUOTE.search(text, at, end)) is not None:
            mark = QUOTES[m[0]]
            close = -1 if mark in missing else text.find(mark, m.end(), end)
            if close < 0:
                missing.add(mark)
                at = m.end()
            else:
                self.begins.append(m.start())
                self.closes.append(close)
                at = close + 1

    def hold(self, at: int) -> bool:
        k = bisect_left(self.begins, at) - 1
        return k >= 0 and at < self.closes[k]


def language_of(text: str, start: int, end: int) -> str:
    """The language whose frequent words the paragraph holds most."""
    words = [w.lower() for w in _LATIN_WORD.findall(text, start, end)]
    return max(FREQUENT, key=lambda lang: sum(w in FREQUENT[lang] for w in words))


def _short_form(token: str) -> str:
    token = unicodedata.normalize("NFKD", _INVISIBLE.sub("", token)).translate(LATIN_ALIKE)
    return "".join(c for c in token if not unicodedata.combining(c))


def _dot_ends(text: str, start: int, at: int, after: int, end: int, language: Callable[[], str]) -> bool:
    """Whether the single dot at ``at`` ends a sentence; the paragraph is ``text[start:end]``."""
    nxt = _VISIBLE_NEXT.match(text, after, end)
    if nxt is None:
        return True
    follow = nxt[1]
    window = text[max(start, at - 24) : at]
    token = _TOKEN.search(window)
    stem = _short_form(token[0]) if token and len(token[0]) <= 12 else ""
    last = stem[-1:]
    if not last:  # behind a closing mark
        return True
    if last.isdigit() and follow.isdigit():
        return False
    attached = not follow.isspace()
    if last.isdigit() and stem.isdigit() and _HEAD.fullmatch(text, start, at):
        return False  # an entry's number
    lower = stem.lower()
    word = _NEXT_WORD.match(text, after, end)
    head, rest = (word[1], word[2]) if word else ("", "")
    head = head.translate(LATIN_ALIKE)
    if last.isascii():
        if attached and (follow.islower() or follow.isdigit()) and follow.translate(LATIN_ALIKE).isascii():
            return False
        if len(stem) == 1 and stem.isalpha():
            before = _BEFORE_TOKEN.search(window[: token.start()]) if token else None
            if before is not None:  # a letter that counts, as of a leaf's page
                head = unicodedata.normalize("NFKC", head)
                return head.isalpha() and not head.islower()
            if unicodedata.normalize("NFKC", head + rest).lower() in STARTERS and unicodedata.normalize("NFKC", head).isupper():
                return True
            return False
        lang = language() if len(lower) <= _LONGEST else ""
        head = unicodedata.normalize("NFKC", head)
        if lang and (lower in TITLES[lang] or lower in REFERENCES[lang]):
            return False
        if lang and lower in FINALS[lang]:
            return not (head.islower() or head.isdigit())
        if "." in stem and all(len(x) <= 1 for x in stem.split(".")) and stem[0].isalpha():  # initials without blanks
            return lang == "en" and head.isupper() and unicodedata.normalize("NFKC", head + rest).lower() in STARTERS
        return not head.islower()
    parts = stem.split(".")
    tail = parts[-1].replace("ـ", "")
    if len(tail) == 1 and tail.isalpha():
        if tail == "ه" and "ـ" in parts[-1]:
            return True  # the era's sign behind a year
        return tail >= "⺀"  # one ideograph is a word, one letter an abbreviation
    return True


def sentence_starts(text: str | None) -> list[int]:
    """Offsets (code points) of each sentence's first character that is not white space."""
    return [a for a, _ in sentence_spans(text)]


def sentence_spans(text: str | None) -> list[tuple[int, int]]:
    """``(start, end)`` of each sentence, outer white space left out."""
    if not text or text.isspace():
        return []
    out: list[tuple[int, int]] = []
    size, at = len(text), 0
    unmarked = re.search(f"[{UNMARKED}]", text) is not None
    bounds = [m.span() for m in _PARAGRAPHS.finditer(text)]
    for stop, resume in [*bounds, (size, size)]:
        if stop > at:
            _paragraph(text, at, stop, unmarked, out)
        at = resume
    return out


def _paragraph(text: str, start: int, end: int, unmarked: bool, out: list[tuple[int, int]]) -> None:
    quotes: _Quotations | None = None
    ends: list[int] = []
    language = lru_cache(maxsize=1)(lambda: language_of(text, start, end))
    for m in _MARKS.finditer(text, start, end):
        a, b = m.span()
        if quotes is None:
            quotes = _Quotations(text, start, end)
        if quotes.hold(a):
            continue
        marks = m[0]
        if marks.strip(DOTS) == "":
            if len(marks) > 1 or marks == "…":
                k = a - 1
                while k >= start and _INVISIBLE.match(text[k]):
                    k -= 1
                if k < start or text[k].isspace():
                    continue
            elif not _dot_ends(text, start, a, b, end, language):
                continue
        ends.append(min(end, _TAIL.match(text, b, end).end()))
    if unmarked:
        for m in _SPACE_UNMARKED.finditer(text, start, end):
            if quotes is None:
                quotes = _Quotations(text, start, end)
            if not quotes.hold(m.start()):
                ends.append(m.start(1))
        ends.sort()
    first, at = True, start
    for stop in [*ends, end]:
        if stop <= at:
            continue
        piece = text[at:stop]
        body = piece.strip()
        if body:
            a = at + len(piece) - len(piece.lstrip())
            b = a + len(body)
            if not first and _WORD.search(body) is None:
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
                first = False
        at = stop


def with_sentences(df: DataFrame, text: str, keep: list[str], spans: str = "spans") -> DataFrame:
    """``keep`` and an array of ``(start_pos, end_pos)`` for each row; narrow, no shuffle."""
    from pyspark.sql import types as T

    fields = [df.schema[c] for c in keep]
    span = T.ArrayType(T.StructType([T.StructField("start_pos", T.IntegerType()), T.StructField("end_pos", T.IntegerType())]))
    kind = pa.list_(pa.struct([("start_pos", pa.int32()), ("end_pos", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            starts, ends, offsets = [], [], [0]
            for value in texts:
                for a, b in sentence_spans(value.as_py()):
                    starts.append(a)
                    ends.append(b)
                offsets.append(len(starts))
            values = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start_pos", "end_pos"])
            array = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values).cast(kind)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], array], names=[*keep, spans])

    return df.select(text, *keep).mapInArrow(run, T.StructType([*fields, T.StructField(spans, span)]))


def sentences(df: DataFrame, text: str = "text_body", key: str = "person_id", order: str = "ingested_at") -> DataFrame:
    """``key, sent_no, start_pos, end_pos`` for each sentence of the current row of each key.

    Texts are cut where they lie; only offsets are shuffled to find the current row.
    """
    from ..operators.current import latest

    cut = with_sentences(df.where(F.col(key).isNotNull()), text, [key, order])
    rows = latest(cut, key, "spans", order)
    return rows.select(key, F.posexplode("spans").alias("sent_no", "s")).select(key, "sent_no", "s.start_pos", "s.end_pos")


def p5_found(spark, sf_dir: str) -> DataFrame:
    from ..session import spread

    raw = spark.read.parquet(f"{sf_dir}/raw.parquet").select("person_id", "text_body", "ingested_at")
    return sentences(spread(raw)).select("person_id", "start_pos")
