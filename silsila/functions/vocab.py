"""Controlled vocabularies that every task carries, so that matching needs no join and no shuffle."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@lru_cache(maxsize=8)
def _automaton(aliases: tuple[tuple[str, str], ...]):
    """An automaton that gives the places of the aliases it meets."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for i, (alias, _) in enumerate(aliases):
        made.add_word(alias, i)
    made.make_automaton()
    return made


@dataclass(frozen=True)
class Vocabulary:
    """Aliases with the key of their term, longest first; of equal aliases the later term wins."""

    aliases: tuple[tuple[str, str], ...]

    @classmethod
    def of(cls, terms: list[tuple[str, list[str]]], fold=lambda s: s) -> Vocabulary:
        """Of ``(key, aliases)`` in order; an alias keeps the place where it first stood."""
        table: dict[str, str] = {}
        for key, names in terms:
            for name in names:
                alias = fold(name) if name else ""
                if alias:
                    table[alias] = key
        order = {a: i for i, a in enumerate(table)}
        return cls(tuple(sorted(table.items(), key=lambda x: (-len(x[0]), order[x[0]]))))

    @classmethod
    def load(cls, terms: DataFrame, key: str = "authority_key", label: str = "label_ar", aliases: str = "aliases", most: int = 10_000) -> Vocabulary:
        """Of a fixed table; more than ``most`` terms are refused, since a vocabulary is carried by every task.

        Terms go by their key, aliases before the label; of equal aliases the later term wins. Equally long aliases keep
        the order in which they first stood.
        """
        rows = terms.select(key, label, aliases).limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"a vocabulary of more than {most} terms must be joined, not carried")
        named = sorted((r[key], sorted(a for a in (r[aliases] or []) if a), r[label] or "") for r in rows if r[key])
        return cls.of([(k, [*names, last]) for k, names, last in named])

    def _table(self) -> Column:
        return F.array(*[F.struct(F.lit(a).alias("alias"), F.lit(k).alias("key")) for a, k in self.aliases])

    def lookup(self, c: Column | str) -> Column:
        """Key of the alias that equals the column."""
        text = F.col(c) if isinstance(c, str) else c
        return F.try_element_at(F.filter(self._table(), lambda t: t["alias"] == text), F.lit(1))["key"]

    def find_all(self, c: Column | str) -> Column:
        """Keys of the aliases contained in the column, longest alias first; plain containment, no word boundary."""
        text = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
        return F.array_distinct(F.transform(F.filter(self._table(), lambda t: F.contains(text, t["alias"])), lambda t: t["key"]))

    def scan(self, c: Column | str) -> Column:
        """As ``find_all``, in one pass over each text with an automaton of all aliases: for long texts. Arrow batches."""
        aliases = self.aliases

        def found(text: str | None) -> list[str]:
            if not text or not aliases:
                return []
            return list(dict.fromkeys(aliases[i][1] for i in sorted({i for _, i in _automaton(aliases).iter(text)})))

        @F.pandas_udf("array<string>")
        def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([found(t) for t in texts], index=texts.index, dtype=object)

        return scanned(c)

    def find_first(self, c: Column | str) -> Column:
        return F.try_element_at(self.find_all(c), F.lit(1))

    def resolve(self, c: Column | str) -> Column:
        """The equal alias's key, else that of the longest alias contained."""
        return F.coalesce(self.lookup(c), self.find_first(c))
