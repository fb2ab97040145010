"""Statistics of each document's text, and whether it is prose or a list, a table or junk.

Counts of words, symbols, end marks and common words are joined by repetition statistics (shares of repeated lines
and paragraphs, characters covered by the most frequent n-grams). Combined rules read the kind from them: damage
and repetition first (junk), then the shape of the lines (table, list), and prose for what remains. Lines weigh
by their characters, so that a short list at the end of a prose text changes nothing.

Defined cases: null, empty and blank texts have statistics of 0 and no kind.
"""
from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import spread
from .lookalike import Canonical, representatives
from .sentences import DOTS, INVISIBLE, STRONG

# --- fixed values ---------------------------------------------------------------------------------------
#: Scripts that are written without blanks between words.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
#: Characters that stand where others were lost.
REPLACED = "\ufffd\u25a0\u25a1\u25aa\u25ab\u25ac\u25af\u2588\u2591-\u2593\u00a6\u00ac"
BULLETS = r"\-\u2010-\u2015*\u2022\u2023\u2043\u00b7\u25e6\u25cf\u25cb\u25c6\u25c7\u25aa\u25ab\u2219\u203a\u00bb\u2192\u066d+"
SEPARATORS = "|;\t,،؛=:"
VOWELS = frozenset("aeiouy")
NGRAMS = (2, 4)
#: Characters from which on a text without blanks is looked at for repeated phrases.
LEAST_UNSPACED = 80
# --------------------------------------------------------------------------------------------------------

_LINE = re.compile("\r\n|[\n\r\x85\u2028\u2029]")
_PARAGRAPH = re.compile(r"(?:\r\n|[\n\r])[^\S\r\n]*(?:\r\n|[\n\r])\s*")
_END = re.compile(rf"[{DOTS}{STRONG}][\s{INVISIBLE})\]»”“\"」'’]*(?:[(\[]+\d+[)\]]+\s*)*$")
_INNER_END = re.compile(rf"[^\W\d_][)»”\"」]?[.{STRONG}]\s+\S")
_UNSPACED = re.compile(f"[{UNSPACED}]")
_BULLET = re.compile(rf"\s*(?:[{BULLETS}]\s*|[(\[]?\w{{1,4}}[)\]]\s*|\(?\d{{1,4}}\s*[.)\-:/–—]\s*)(?=\S)")
_LEADER = re.compile(r"(?:\.{4,}|…{2,}|_{4,}|-{4,}|\.(?: \.){3,})\s*\d*\s*$")
_GAPS = re.compile(r"\S {2,}(?=\S)|\t")
_PAIR = re.compile(r"\s*([^=:\n]{1,24}?)\s*[=:]")
_RULE = re.compile(r"[\s|:+=\-_\u2500-\u257f]+$")


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


_REPLACED = re.compile(f"[{REPLACED}]")
_ODD = re.compile(rf"[{REPLACED}~^`\\<>{{}}#$%@]")
_LATIN1 = re.compile("[\u0080-\u009f\u00a1-\u00a9\u00aa\u00ad-\u00ba\u00bc-\u00ff\u0152\u0153\u0160\u0161\u017d\u017e\u0178\u0192\u02c6\u02dc\u2020-\u2022\u2030\u20ac\u2122]")
_SPECIAL = re.compile(r"<\|\w{1,24}\|>")
_CLAUSE = re.compile(f"[{STRONG}]")


class _Classes(dict):
    """A letter for the class of each character."""

    def __missing__(self, char: str) -> str:
        category = unicodedata.category(char)
        if category[0] in "LM":
            kind = "u" if _UNSPACED.match(char) else "l"
        elif category == "Nd":
            kind = "d"
        elif char.isspace():
            kind = " "
        else:
            kind = "r" if _REPLACED.match(char) else "o" if _ODD.match(char) else "s"
        self[char] = kind
        return kind


_CLASSES = _Classes()


class _Words(dict):
    """Of a token: length of its word (lower case, outer marks left out), whether it has one, whether the word is common,
    whether the token is one letter, its length in a spaced script, its length if it is more than marks."""

    def __init__(self, common: set[str]):
        super().__init__()
        self.common = common

    def __missing__(self, token: str) -> tuple[int, int, int, int, int, int]:
        if len(self) > 200_000:
            self.clear()
        a, b = 0, len(token)
        while a < b and _CLASSES[token[a]] not in "lu":
            a += 1
        while b > a and _CLASSES[token[b - 1]] not in "lu":
            b -= 1
        word = token[a:b].lower()
        spaced = token.isascii() or not _UNSPACED.search(token)
        facts = (
            len(word), int(bool(word)), int(word in self.common), int(len(token) == 1 and _CLASSES[token] != "u"),
            len(token) if spaced else 0, len(token) if word or token.isalnum() else 0,
        )
        self[token] = facts
        return facts


def coverage(words: list[str], n: int) -> tuple[float, int]:
    """Share of the words' characters in occurrences of the most frequent n-gram, and how often it comes."""
    if len(words) <= n:
        return 0.0, 0
    grams = Counter(zip(*(words[i:] for i in range(n))))
    gram = max(grams, key=grams.get)
    times = grams[gram]
    return (min(1.0, _share(times * sum(map(len, gram)), sum(map(len, words)))) if times > 1 else 0.0), times


class Statistics(dict):
    """Named statistics of one text."""


FIELDS: list[tuple[str, str]] = [
    ("n_chars", "int"), ("n_words", "int"), ("mean_word_length", "double"), ("symbol_ratio", "double"), ("digit_ratio", "double"),
    ("letter_ratio", "double"), ("n_lines", "int"), ("n_paragraphs", "int"), ("end_mark_lines", "double"), ("bullet_lines", "double"),
    ("short_lines", "double"), ("common_words", "double"), ("distinct_words", "double"), ("duplicate_lines", "double"),
    ("duplicate_paragraphs", "double"), ("top_2gram", "double"), ("top_4gram", "double"), ("top_word", "double"),
    ("single_letters", "double"), ("odd_ratio", "double"), ("miscoded_ratio", "double"), ("longest_token", "int"),
]


class Reader:
    """Statistics and kinds, given the common words of the languages."""

    def __init__(self, common: dict[str, list[str]]):
        self.canonical = Canonical(representatives({}))
        self.common = {self.canonical(w).lower() for words in common.values() for w in words}
        unspaced = sorted({self.canonical(w) for words in common.values() for w in words if _UNSPACED.match(w)}, key=len, reverse=True)
        self.words = _Words(self.common)
        self.unspaced = re.compile("|".join(map(re.escape, unspaced))) if unspaced else None

    def statistics(self, stored: str) -> Statistics:
        text = self.canonical(stored)
        out = Statistics()
        tokens = text.split()
        counts = Counter(tokens)
        sizes = Counter()
        characters = Counter(_SPECIAL.sub(" ", text) if "<|" in text else text)
        for char, n in characters.items():
            sizes[_CLASSES[char]] += n
        lines = [x for x in (y.strip() for y in _LINE.split(text)) if x]
        paragraphs = [x for x in (y.strip() for y in _PARAGRAPH.split(text)) if x]
        solid = sum(sizes.values()) - sizes[" "]
        letters, digits = sizes["l"] + sizes["u"], sizes["d"]
        dense = _share(sizes["u"], solid)
        n_words = word_chars = common = single = longest = top = 0
        words = self.words
        grams_of = tokens
        if dense > 0.3:  # without blanks each character is a word
            n_words = word_chars = sizes["u"]
            grams_of = [c for c in text if _CLASSES[c] == "u"]
        for token, n in counts.items():
            size, is_word, is_common, is_single, spaced, weight = words[token]
            if is_word and dense > 0.3 and not spaced:
                is_word = size = 0
            n_words += n * is_word
            word_chars += n * size
            common += n * is_common
            single += n * is_single
            if spaced > longest:
                longest = spaced
            if n * weight > top:
                top = n * weight
        if dense > 0.3 and self.unspaced is not None:
            # without blanks the share is that of the characters in common words
            common_share = _share(sum(map(len, self.unspaced.findall(text))), letters)
        else:
            common_share = _share(common, n_words)
        out["n_chars"] = len(stored)
        out["n_words"] = n_words
        out["mean_word_length"] = _share(word_chars, n_words)
        out["symbol_ratio"] = _share(sizes["s"] + sizes["o"] + sizes["r"], solid)
        out["digit_ratio"] = _share(digits, solid)
        out["letter_ratio"] = _share(letters, solid)
        out["n_lines"] = len(lines)
        out["n_paragraphs"] = len(paragraphs)
        out["end_mark_lines"] = _share(sum(_END.search(x, max(0, len(x) - 24)) is not None and _LEADER.search(x[-24:]) is None for x in lines), len(lines))
        out["bullet_lines"] = _share(sum(_BULLET.match(x) is not None for x in lines), len(lines))
        out["short_lines"] = _share(sum(len(x) <= 60 and len(x.split()) <= 6 for x in lines), len(lines))
        out["common_words"] = common_share
        out["distinct_words"] = _share(len(counts), len(tokens))
        out["duplicate_lines"] = _share(len(lines) - len(set(lines)), len(lines))
        out["duplicate_paragraphs"] = _share(len(paragraphs) - len(set(paragraphs)), len(paragraphs))
        times = 2
        for n in NGRAMS:
            out[f"top_{n}gram"], times = coverage(grams_of, n) if times > 1 else (0.0, 0)
        out["_distinct_8grams"] = 1.0
        if dense > 0.3 and len(grams_of) >= LEAST_UNSPACED:
            grams = len(grams_of) - 7
            out["_distinct_8grams"] = len({tuple(grams_of[i : i + 8]) for i in range(grams)}) / grams
        out["top_word"] = _share(top, solid)
        out["single_letters"] = _share(single, len(tokens))
        out["odd_ratio"] = _share(sizes["o"] + sizes["r"], solid)
        out["miscoded_ratio"] = _share(len(_LATIN1.findall(stored)), solid)
        out["longest_token"] = longest
        out["_lines"], out["_counts"], out["_tokens"], out["_dense"], out["_text"], out["_stored"] = lines, counts, len(tokens), dense, text, stored
        leaders = "._-…" if len(lines) > 2 else ""
        out["_top_char"] = _share(max((n for c, n in characters.items() if not c.isspace() and c not in leaders), default=0), solid)
        out["_latin"] = _share(sum(n for c, n in characters.items() if c.isascii() and c.isalpha()), solid)
        out["_solid"], out["_replaced"] = solid, _share(sizes["r"], solid)
        return out

    def kind(self, s: Statistics) -> str:
        if _is_junk(s):
            return "junk"
        if _is_table(s):
            return "table"
        if _is_list(s):
            return "list"
        return "prose"


def _consonants_only(s: Statistics) -> float:
    if s["_latin"] < 0.4:
        return 0.0
    latin = [(t, n) for t, n in s["_counts"].items() if len(t) > 3 and t.isascii() and t.isalpha()]
    total = sum(n for _, n in latin)
    return _share(sum(n for t, n in latin if not VOWELS & set(t.lower())), total) if total > 4 and total > 0.5 * s["_tokens"] else 0.0


def _repeats(s: Statistics) -> bool:
    """The same thing over and over: a character, a word, a phrase, a line or a paragraph."""
    if s["_solid"] >= 12 and s["_top_char"] > 0.6:
        return True
    if s["duplicate_lines"] > 0.6 and s["n_lines"] >= 5 or s["duplicate_paragraphs"] > 0.6 and s["n_paragraphs"] >= 4:
        return True
    if s["_dense"] > 0.3:
        if s["_distinct_8grams"] < 0.1:
            return True
        clauses = [c.strip() for c in _CLAUSE.split(s["_text"]) if c.strip()]
        return len(clauses) >= 5 and len(set(clauses)) < 0.35 * len(clauses) or s["_tokens"] >= 12 and s["distinct_words"] < 0.2
    again = s["_tokens"] >= 12 and (s["top_word"] > 0.4 or s["distinct_words"] < 0.12 and s["top_4gram"] > 0.25)
    again = again or s["_tokens"] >= 20 and max(s["top_2gram"], s["top_4gram"]) > 0.5
    return again and (s["distinct_words"] < 0.12 or not _is_list(s))  # items of a list may share words


def _is_junk(s: Statistics) -> bool:
    if s["_replaced"] > 0.02 or s["miscoded_ratio"] > 0.15:
        return True
    if _is_table(s):
        return False
    if s["odd_ratio"] > 0.06 or _repeats(s):
        return True
    if s["_tokens"] >= 12 and s["single_letters"] > 0.5:
        return True
    if _consonants_only(s) > 0.5:
        return True
    if s["longest_token"] > 30:
        long = sum(n * len(t) for t, n in s["_counts"].items() if len(t) > 30 and t.isascii() and not t.startswith(("http", "www.")))
        if _share(long, s["_solid"]) > 0.6:
            return True
    return s["letter_ratio"] < 0.35 and s["digit_ratio"] < 0.5 and s["_solid"] > 20 and _list_share(s) < 0.5


def _is_table(s: Statistics) -> bool:
    if "_table" not in s:
        s["_table"] = len(s["_lines"]) >= 3 and _tabular(s)
    return s["_table"]


def _tabular(s: Statistics) -> bool:
    if sum(len(x) > 300 for x in s["_lines"]) > 0.5 * len(s["_lines"]):
        return False  # running text
    lines = [x for x in s["_lines"] if not _RULE.match(x)]
    if len(lines) < 3:
        return False
    for mark in "|;\t,،؛":
        if mark not in s["_stored"]:
            continue
        counts = Counter(x.count(mark) for x in _raw_lines(s) if not _RULE.match(x))
        top, times = max(counts.items(), key=lambda c: (c[1], c[0]))
        least = 2 if mark in "|;\t" else 3
        if top >= least - (mark in "\t|") and times >= 0.7 * len(lines) and s["end_mark_lines"] < 0.4:
            if mark in ",،" and _share(sum(len(x) for x in lines), len(lines)) > 120:
                continue
            return True
    keys = [m[1] for m in map(_PAIR.match, lines) if m]
    if len(keys) >= 0.8 * len(lines) and len(lines) >= 4 and len(set(keys)) <= 0.5 * len(keys):
        return True
    if "  " not in s["_stored"] and "\t" not in s["_stored"]:
        return False
    gaps = sum(len(_GAPS.findall(x)) >= 1 for x in _raw_lines(s))
    return gaps >= 0.6 * len(lines) and s["end_mark_lines"] < 0.3 and _columns(_raw_lines(s)) >= 0.6


def _raw_lines(s: Statistics) -> list[str]:
    if "_raw" not in s:
        s["_raw"] = [x for x in _LINE.split(s["_stored"]) if x.strip()]
    return s["_raw"]


def _columns(lines: list[str]) -> float:
    """Share of the lines' fields (parted by two or more blanks) that begin where most lines have a field begin."""
    starts = [[m.start() for m in re.finditer(r"(?:(?<=^)|(?<=  ))\S", x)] for x in lines]
    at = Counter(p for row in starts for p in set(row))
    usual = {p for p, n in at.items() if n >= max(2, 0.25 * len(lines))}
    inner = [p for row in starts for p in row if p]
    return _share(sum(p in usual for p in inner), len(inner))


def _list_share(s: Statistics) -> float:
    """Share of the characters in lines that hold one item each."""
    held = total = 0
    for line in s["_lines"]:
        size = len(line)
        total += size
        if size > 200:  # longer than any item with its leader
            continue
        bare = _LEADER.sub("", line).strip()
        words = bare.split()
        led = _BULLET.match(line) is not None or _LEADER.search(line) is not None
        dense = _UNSPACED.search(bare) is not None
        short = len(bare) <= 16 if dense else len(words) <= 7 and len(bare) <= 64
        ended = _END.search(bare) is not None
        running = _INNER_END.search(bare) is not None
        if short and not ended or led and not running and (len(words) <= 14 and len(bare) <= 110) and not (ended and len(words) > 8):
            held += size
    return _share(held, total)


def _is_list(s: Statistics) -> bool:
    if "_list" not in s:
        s["_list"] = s["n_lines"] >= 4 and _list_share(s) >= 0.6
    return s["_list"]


def _common_words(spark, sf_dir: str, most: int = 10_000) -> dict[str, list[str]]:
    """The fixed table of common words, which every task carries; more than ``most`` rows are refused."""
    words: dict[str, list[str]] = {}
    rows = spark.read.parquet(f"{sf_dir}/common_words.parquet").select("lang", "word").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} common words cannot be carried by every task")
    for row in rows:
        if row["word"]:
            words.setdefault(row["lang"] or "", []).append(row["word"])
    return words


def with_statistics(documents: DataFrame, common: dict[str, list[str]], text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, all statistics and ``kind`` of every row; narrow, no shuffle."""
    kinds = {"int": pa.int32(), "double": pa.float64()}
    types = {"int": T.IntegerType(), "double": T.DoubleType()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(common)
        for batch in batches:
            rows: list[Statistics] = []
            labels: list[str | None] = []
            for value in batch.column(0):
                body = value.as_py()
                if not body or body.isspace():
                    rows.append(Statistics({f: 0 for f, _ in FIELDS}) | {"n_chars": len(body or "")})
                    labels.append(None)
                    continue
                s = reader.statistics(body)
                labels.append(reader.kind(s))
                rows.append({f: s[f] for f, _ in FIELDS})
            arrays = [pa.array([r[f] for r in rows], kinds[k]) for f, k in FIELDS]
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays, pa.array(labels, pa.string())], names=[key, *(f for f, _ in FIELDS), "kind"])

    schema = T.StructType([documents.schema[key], *[T.StructField(f, types[k]) for f, k in FIELDS], T.StructField("kind", T.StringType())])
    return documents.select(text, key).mapInArrow(run, schema)


def p9_statistics(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_statistics(spread(documents), _common_words(spark, sf_dir))


def p9_found(spark, sf_dir: str) -> DataFrame:
    return p9_statistics(spark, sf_dir).where("kind != 'prose'").select("doc_id", "kind")
