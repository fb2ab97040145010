"""Folding of spellings, as one function for Python and one Arrow-batched column function.

Spark has no compatibility normalization among its built-in functions, hence Arrow batches.
"""
from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values of the folding
CARRIERS = str.maketrans({"أ": "ا", "إ": "ا", "آ": "ا", "ٱ": "ا", "ة": "ه", "ى": "ي", "ؤ": "و", "ئ": "ي"})
VOWEL_MARKS = "\u064b-\u0652\u0670\u0640"
BLANKS = "\f\n\r\t\v \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"

_MARKS = re.compile(f"[{VOWEL_MARKS}]")
_BLANKS = re.compile(f"[{BLANKS}]+")


def fold(value: str | None) -> str:
    """The folded spelling of ``value``; null folds to the empty string."""
    if not value:
        return ""
    text = unicodedata.normalize("NFKC", value).translate(CARRIERS)
    return _BLANKS.sub(" ", _MARKS.sub("", text)).strip(" ").lower()


@F.pandas_udf(T.StringType())
def _fold_series(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in batches:
        yield series.map(fold, na_action=None) if len(series) else series.astype(str)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _fold_arrays(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in batches:
        yield series.map(lambda names: None if names is None else [fold(n) for n in names])


def folded(column: Column | str) -> Column:
    """Folded spelling of a string column; null gives the empty string."""
    return _fold_series(column)


def folded_each(column: Column | str) -> Column:
    """Folded spelling of each element of an array column; a null array stays null."""
    return _fold_arrays(column)
