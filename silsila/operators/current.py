"""Current rows: the newest state of each key, equal rows once."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current_rows(df: DataFrame, key: str, columns: Sequence[str] | None = None, order: str = "ingested_at") -> DataFrame:
    """The row with the greatest ``order`` for each ``key``.

    Rows with a null key are dropped; a null ``order`` counts as oldest. Of different rows with the
    same ``order`` the one with the greatest hash (then greatest values) is taken, so that the result does not
    depend on the input's order. One aggregation with partial maxima: a hot key sends one row per task.
    An empty table gives an empty table; other columns, whatever their names, are not read.
    """
    columns = [c for c in (columns or df.columns) if c not in (key, order)]
    values = [F.col(f"`{c}`") for c in columns]
    tie = F.xxhash64(*[v.cast("string") for v in values]) if values else F.lit(0)
    state = F.struct(F.col(order).alias("__order"), tie.alias("__tie"), *[v.alias(c) for v, c in zip(values, columns)])
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(state).alias("__state"))
    return best.select(key, *[F.col("__state").getField(c).alias(c) for c in columns], F.col("__state.__order").alias(order))


def latest(df: DataFrame, key: str, value: str, order: str = "ingested_at") -> DataFrame:
    """``key`` and ``value`` of the newest row; ``value`` must be orderable and is meant to be small."""
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(order, value)).alias("__state"))
    return best.select(key, F.col(f"__state.{value}").alias(value))
