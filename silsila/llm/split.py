"""Cutting oversized texts into overlapping pieces at natural boundaries.

Offsets count code points, so that they are the prefix sums of the units before them; the possible cuts are a sorted array
for each level: paragraph, sentence, word. The last cut under the limit is found by binary search, the next piece steps
back by the overlap, and where no level offers a cut the piece is cut hard at the limit. The same search tells the
coarsest level that suffices: the first at which it never falls back.

Defined cases: null, empty and blank texts and texts of at most ``limit`` code points without outer white space
give no pieces. A cut lies at the beginning of the next paragraph, sentence or word, so that the blanks before it
stay with the piece they end. Pieces put behind one another without their first ``overlap`` code points are the
text as stored.
"""
from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.current import latest
from .sentences import _PARAGRAPHS, sentence_spans

LEVELS = ("paragraph", "sentence", "word", "char")
LIMIT, OVERLAP = 9000, 200
_WORDS = re.compile(r"\S+")


class Level(NamedTuple):
    """The units of one level: sorted offsets where they begin and where they end, blanks left out."""

    begins: list[int]
    ends: list[int]

    def last_cut(self, limit: int) -> int:
        """The last offset up to ``limit`` at which a unit but the first begins; -1 if there is none."""
        k = bisect_right(self.begins, limit, 1) - 1 if self.begins else 0
        return self.begins[k] if k > 0 else -1

    def suffices(self, limit: int) -> bool:
        """Whether pieces of at most ``limit`` can be cut between units only: the search never falls back."""
        unit, size = 0, len(self.begins)
        while unit < size:
            after = bisect_right(self.ends, self.begins[unit] + limit, unit)
            if after == unit:
                return False
            unit = after
        return True


def boundaries(text: str) -> tuple[Level, Level, Level]:
    """Paragraphs, sentences and words."""
    paragraphs, at = [], 0
    for m in _PARAGRAPHS.finditer(text):
        paragraphs.append((at, m.start()))
        at = m.end()
    paragraphs.append((at, len(text)))
    trimmed = []
    for a, b in paragraphs:
        unit = text[a:b]
        if unit and not unit.isspace():
            first = a + len(unit) - len(unit.lstrip())
            trimmed.append((first, first + len(unit.strip())))
    units = (trimmed, sentence_spans(text), [m.span() for m in _WORDS.finditer(text)])
    return tuple(Level([a for a, _ in level], [b for _, b in level]) for level in units)


def finest(found: tuple[Level, Level, Level], limit: int = LIMIT) -> str:
    """The coarsest level whose units suffice for pieces of at most ``limit``."""
    return next((name for name, level in zip(LEVELS, found) if level.suffices(limit)), "char")


def pieces(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP, found: tuple[Level, Level, Level] | None = None) -> list[tuple[int, int, str]]:
    """``(start, end, level of the cut at its end)`` of each piece; the last piece ends with ``end``."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    if not text or len(text.strip()) <= limit:
        return []
    found = found or boundaries(text)
    out, start, size = [], 0, len(text)
    while size - start > limit:
        end, level = start + limit, "char"
        for units, name in zip(found, LEVELS):
            cut = units.last_cut(start + limit)
            if cut > start + overlap:
                end, level = cut, name
                break
        out.append((start, end, level))
        start = end - overlap
    return [*out, (start, size, "end")]


_PIECE = T.StructType([
    T.StructField("piece_no", T.IntegerType()), T.StructField("start_pos", T.IntegerType()), T.StructField("end_pos", T.IntegerType()),
    T.StructField("cut", T.StringType()), T.StructField("text", T.StringType()),
])
_KIND = pa.list_(pa.struct([("piece_no", pa.int32()), ("start_pos", pa.int32()), ("end_pos", pa.int32()), ("cut", pa.string()), ("text", pa.string())]))


def cut_long(df: DataFrame, text: str = "text_body", key: str = "person_id", order: str = "ingested_at", limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """``key, finest, pieces`` of each key whose current text is over ``limit``.

    Texts are cut where they lie. Rows within the limit travel as a key and a null, since a newer short text
    takes the place of an older long one.
    """
    fields = [df.schema[key], df.schema[order]]
    state = T.StructType([T.StructField("finest", T.StringType()), T.StructField("pieces", T.ArrayType(_PIECE))])
    kind = pa.struct([("finest", pa.string()), ("pieces", _KIND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(0):
                body = value.as_py()
                if not body or len(body) <= limit or len(body.strip()) <= limit:
                    rows.append(None)
                    continue
                found = boundaries(body)
                cut = pieces(body, limit, overlap, found)
                rows.append({
                    "finest": finest(found, limit),
                    "pieces": [{"piece_no": i, "start_pos": a, "end_pos": b, "cut": how, "text": body[a:b] if with_text else None} for i, (a, b, how) in enumerate(cut)],
                })
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(rows, kind)], names=[key, order, "state"])

    schema = T.StructType([*fields, T.StructField("state", state)])
    cut = df.where(F.col(key).isNotNull()).select(text, key, order).mapInArrow(run, schema)
    return latest(cut, key, "state", order).where("state is not null").select(key, "state.finest", "state.pieces")


def p1_found(spark, sf_dir: str) -> DataFrame:
    return cut_long(spark.read.parquet(f"{sf_dir}/raw.parquet"), with_text=False).select("person_id", "finest")


def p1_pieces(spark, sf_dir: str) -> DataFrame:
    cut = cut_long(spark.read.parquet(f"{sf_dir}/raw.parquet"))
    return cut.select("person_id", F.explode("pieces").alias("p")).select("person_id", "p.piece_no", "p.start_pos", "p.end_pos", "p.cut", "p.text")
