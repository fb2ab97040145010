"""Validation as data: named rules that are true where a row is wrong."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import PERSON_KEY

PERSON_RULES: dict[str, str] = {
    "person_id": f"not regexp_like(person_id, '{PERSON_KEY}')".replace("\\", "\\\\"),
    "qism": "qism is not null and qism not between 1 and 4",
    "pages": "page_end < page_start",
    "death_year": "death_year_hijri not between -100 and 1500",
    "display_name": "display_name is null or display_name = ''",
    "full_name": "full_name is null",
    "confidence": "nasab_confidence not between 0 and 1",
}
EDGE_RULES: dict[str, str] = {
    "from": "from_id is null", "target": "resolved and to_id is null", "candidates": "ambiguous and coalesce(size(candidates), 0) < 2",
    "confidence": "confidence not between 0 and 1",
}


def failed_rules(rules: dict[str, str]) -> Column:
    """Names of the rules that a row breaks; a rule that is unknown (null) is not broken."""
    return F.array_compact(F.array(*[F.when(F.expr(e), F.lit(n)) for n, e in rules.items()]))


def violations(df: DataFrame, rules: dict[str, str], key: str) -> DataFrame:
    """``rule, key`` for every broken rule; narrow."""
    return df.select(key, F.explode(failed_rules(rules)).alias("rule")).select("rule", key)


def checked(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """The rows; reading one that breaks a rule fails the job with the rule's name."""
    ok = F.assert_true(F.size(failed_rules(rules)) == 0, F.concat(F.lit("invalid row: "), F.array_join(failed_rules(rules), ",")))
    return df.where(ok.isNull())
