"""Reading a lineage out of the opening of an entry.

The phrase is cut at the first mark, comma or word that begins the report; what is left is taken apart at the
link words, and every name must pass validation, else the whole chain is rejected with the reason and the heading's
name stands alone. Runs in Arrow batches: cutting and validating depend on one another token by token.
"""
from __future__ import annotations

import re
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.folding import fold

# --- fixed values -------------------------------------------------------------------------------------
OPENING = 1400
LINKS = ("بن", "ابن", "بنت", "ابنة")
BOUNDARY = frozenset(
    "قال قالت قلت قيل وقيل فقيل يقال ويقال روى رواه يروي حدث حدثنا حدثني أخبرنا أخرج أخرجه ذكر ذكره ذكرها وذكر فذكر يأتي سيأتي تقدم سيعاد ينظر يحرر صحابي صحابية "
    "أدرك أدركت قدم قدمت شهد شهدت كان كانت اختلف اختلفوا اختُلف انتهى توفي توفيت مات ماتت استشهد قتل أسلم أسلمت هاجر هاجرت بايع بايعت وفد نزل سكن له لها وله ولها "
    "أمه أمها وأمه وأمها هكذا وهو وهي عداده أخو أخت زوج زوجة مولى حليف".split()
)
NOT_NISBA = frozenset("الصحابي الصحابية التابعي التابعية الحافظ الآتي الماضي المذكور الراوي".split())
LONGEST, MOST_WORDS, MOST_LINKS = 40, 4, 20
# ------------------------------------------------------------------------------------------------------

_LINK = re.compile(rf"\s+({'|'.join(LINKS)})\s+")
_STOP = re.compile("[.؛:!؟،,]")
_HARD = re.compile("[.؛:!؟]")
_FORBIDDEN = re.compile("[0-9٠-٩.،؛؟:!«»\\[\\]()\\-–—_\"'|/\\\\]")
_ARABIC = re.compile("[ء-ْٰٱ\\s]+")
_NISBA = re.compile("ال[ء-ي]{2,}(?:يّ?|يّ?ة)")
_KUNYA = re.compile(r"(?:يكنى|تكنى|كنيته|كنيتها)\s+(أبا|أبو|أبي|أم)\s+([^\s.،؛:]+(?:\s+(?:الله|الرحمن|الملك|العزيز))?)")

RESULT = T.StructType([
    *[T.StructField(n, T.StringType()) for n in ("ism", "father", "grandfather", "great_grandfather")], T.StructField("chain", T.ArrayType(T.StringType())),
    T.StructField("links", T.ArrayType(T.StringType())), T.StructField("nisba", T.ArrayType(T.StringType())), T.StructField("kunya", T.StringType()),
    T.StructField("full_name", T.StringType()), T.StructField("full_name_norm", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("confidence", T.DoubleType()), T.StructField("rejected_reason", T.StringType()), T.StructField("link_count", T.IntegerType()), T.StructField("is_woman", T.BooleanType()),
])


def segment_problem(segment: str) -> str | None:
    """Why a name cannot stand in a lineage; null if it can."""
    words = segment.split()
    checks = (
        (not segment, "empty_segment"), (len(segment) < 2, "segment_too_short"), (len(segment) > LONGEST, "segment_too_long"),
        (_FORBIDDEN.search(segment) is not None, "segment_has_punctuation_or_digits"), (_ARABIC.fullmatch(segment) is None, "segment_not_arabic"),
        (len(words) > MOST_WORDS, "segment_too_many_words"), (bool(words) and words[-1] in LINKS, "segment_ends_with_chain_link"),
    )
    for failed, reason in checks:
        if failed:
            return reason
    verb = next((w for w in words if w in BOUNDARY), None)
    return f"segment_has_verb:{verb}" if verb else None


def _cut(phrase: str) -> str:
    stop = _STOP.search(phrase)
    words = (phrase[: stop.start()] if stop else phrase).split()
    end = next((i for i, w in enumerate(words) if w in BOUNDARY), len(words))
    words = words[:end]
    while words and words[-1] in LINKS:
        words.pop()
    return " ".join(words)


def _chain(phrase: str, source: str) -> dict[str, Any] | str:
    parts = _LINK.split(f"{phrase}")
    names, links = [p.strip() for p in parts[::2]], parts[1::2]
    if not names or not names[0]:
        return "no_segments"
    tail, nisba = names[-1].split(), []
    while len(tail) > 1 and _NISBA.fullmatch(tail[-1]) and tail[-1] not in NOT_NISBA:
        nisba.insert(0, tail.pop())
    names[-1] = " ".join(tail)
    names = [n for n in names if n]
    if len(links) > MOST_LINKS:
        return "chain_too_long"
    for n in names:
        if problem := segment_problem(n):
            return problem
    links = links[: len(names) - 1]
    full = " ".join([names[0], *(x for pair in zip(links, names[1:]) for x in pair), *nisba])
    base = 0.5 if source == "ismuhu" else 0.55
    sure = round(min(0.98, base + 0.08 * min(len(links), 5) + (0.07 if nisba else 0)), 2)
    padded = [*names, None, None, None, None]
    return {
        "ism": padded[0], "father": padded[1], "grandfather": padded[2], "great_grandfather": padded[3], "chain": names, "links": links, "nisba": nisba,
        "kunya": None, "full_name": full, "full_name_norm": fold(full), "source": source, "confidence": sure, "rejected_reason": None,
        "link_count": len(links), "is_woman": any(x in ("بنت", "ابنة") for x in links),
    }


def parse_lineage(text: str | None, display_name: str | None = None) -> dict[str, Any]:
    """The longest valid chain of the opening (the heading's wins ties), or the display name with the reason."""

    def rejected(reason: str) -> dict[str, Any]:
        name = display_name or None
        return {
            "ism": name, "father": None, "grandfather": None, "great_grandfather": None, "chain": [name] if name else [], "links": [], "nisba": [], "kunya": None,
            "full_name": name, "full_name_norm": fold(name) if name else None, "source": "toc", "confidence": 0.2, "rejected_reason": reason, "link_count": 0, "is_woman": False,
        }

    phrase = " ".join(re.sub(r"«\s*\d+\s*»|\[\s*\(\s*\d+\s*\)\s*\]|\(\s*\d+\s*\)|[«»]", " ", text or "").split())[:OPENING]
    phrase = re.sub(r"^\d[^\-–—]{0,6}[-–—]\s*", "", phrase)
    phrase = re.sub(rf"\s+({'|'.join(LINKS)})\s*[:.]\s+", r" \1 ", phrase)
    if not phrase:
        return rejected("empty_opening_text")
    head = _cut(phrase)
    if not head:
        return rejected("boundary_at_start")
    tries = [(head, "heading")]
    if named := re.search("اسمه\\s+([^.،؛:]{3,180})", phrase):
        tries.append((_cut(named[1].strip()), "ismuhu"))
    outcomes = [_chain(p, s) for p, s in tries if p]
    found = [o for o in outcomes if isinstance(o, dict)]
    if not found:
        return rejected(next((o for o in reversed(outcomes) if isinstance(o, str)), "no_candidate"))
    best = max(found, key=lambda o: o["link_count"])
    clause = _HARD.split(phrase[len(head) :])[0]
    if k := _KUNYA.search(clause):
        best["kunya"] = f"{'أبو' if k[1] in ('أبا', 'أبي') else k[1]} {k[2]}"
    if best["ism"].startswith(("أبو ", "أم ")):
        best["kunya"] = best["ism"]
        best["is_woman"] = best["is_woman"] or best["ism"].startswith("أم ")
    return best


@F.pandas_udf(RESULT)
def _parse(texts: pd.Series, names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_lineage(t, n) for t, n in zip(texts, names)], columns=RESULT.names)


def lineage(text: Column | str, display_name: Column | str) -> Column:
    """``struct`` of the lineage parsed from a text column."""
    return _parse(text, display_name)


def overlap(a: Column, b: Column) -> Column:
    """How many of the last four names of ``a`` occur anywhere in ``b``; not symmetric."""
    last = F.slice(a, F.greatest(F.size(a) - 3, F.lit(1)), 4)
    return F.size(F.filter(last, lambda n: F.array_contains(b, n)))


def identity_score(chain_a: Column, chain_b: Column) -> Column:
    """0.5 (one has no chain) or 0.55 + 0.45 x overlap over the shorter chain, at most 1, to three places."""
    shorter = F.least(F.size(chain_a), F.size(chain_b))
    part = F.when(shorter > 0, overlap(chain_a, chain_b) / shorter).otherwise(F.lit(0.5))
    return F.round(F.least(F.lit(1.0), 0.55 + 0.45 * part), 3)
