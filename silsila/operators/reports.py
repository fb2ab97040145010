"""Aggregates of the quality, rollup, facet and gate reports, in long form."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import first_members, top_k_per_key


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """Rounded share, 0 for an empty whole; decimal arithmetic, so that halves round alike on every engine."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(part.cast("decimal(20,0)") / whole.cast("decimal(20,0)"), places).cast("double"))


def fill_rates(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """``field, filled, total, fill_rate`` of each predicate; one pass, one row to the next stage for each task."""
    sums = df.agg(F.count("*").alias("__n"), *[F.sum(F.coalesce(p, F.lit(False)).cast("long")).alias(n) for n, p in predicates.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("field"), F.coalesce(F.col(n), F.lit(0)).alias("filled")) for n in predicates])
    return sums.select(F.explode(rows).alias("r"), F.col("__n").alias("total")).select(
        "r.field", "r.filled", "total", ratio(F.col("r.filled"), F.col("total")).alias("fill_rate")
    )


def distribution(df: DataFrame, key: Column, null_as: str | None = "null", name: str = "value") -> DataFrame:
    rows = df.select((F.coalesce(key.cast("string"), F.lit(null_as)) if null_as is not None else key.cast("string")).alias(name))
    return rows.groupBy(name).agg(F.count("*").alias("n"))


def evidence_tally(facts: DataFrame, evidence: str = "evidence", confidence: str = "confidence") -> DataFrame:
    """absent without evidence; verified from 0.85, unverified up to 0.6; between them counted nowhere."""
    absent = F.col(evidence).isNull() | (F.col(evidence) == "")
    status = F.when(absent, "absent").when(F.col(confidence) >= 0.85, "verified").when(F.col(confidence) <= 0.6, "unverified")
    return facts.select(status.alias("status")).where("status is not null").groupBy("status").agg(F.count("*").alias("n"))


def gate(current: DataFrame, baseline: DataFrame, tolerance: float = 0.02, falling: Sequence[str] = ()) -> DataFrame:
    """``field, current_rate, baseline_rate, delta, verdict`` for fields on both sides; ``falling`` are better when lower."""
    both = current.select("field", F.col("fill_rate").alias("current_rate")).join(baseline.select("field", F.col("fill_rate").alias("baseline_rate")), "field")
    both = both.withColumn("delta", F.round((F.col("current_rate") - F.col("baseline_rate")).cast("decimal(12,6)"), 4).cast("double"))
    signed = F.when(F.col("field").isin(*falling), -F.col("delta")).otherwise(F.col("delta")) if falling else F.col("delta")
    return both.withColumn("verdict", F.when(signed < -tolerance, "regression").when(signed > tolerance, "improvement").otherwise("same"))


def authority_report(citations: DataFrame, key: str, person: str, verb: str, k: int, ids: int) -> DataFrame:
    """The ``k`` most cited authorities: mentions, distinct persons, verbs with their counts and the first ids."""
    rows = citations.where(F.col(key).isNotNull())
    totals = rows.groupBy(key).agg(F.count("*").alias("n_mentions"))
    persons = rows.select(key, person).distinct().groupBy(key).agg(F.count(person).alias("n_persons"))
    verbs = rows.where(F.col(verb).isNotNull()).groupBy(key, verb).agg(F.count("*").alias("n"))
    by_verb = verbs.groupBy(key).agg(F.sort_array(F.collect_list(F.concat(F.col(verb), F.lit("="), F.col("n").cast("string")))).alias("verbs"))
    top = totals.orderBy(F.desc("n_mentions"), F.asc(key)).limit(k)
    some = first_members(rows.join(F.broadcast(top.select(key)), key, "left_semi"), [key], person, ids, "first_ids")
    return top.join(persons, key).join(by_verb, key, "left").join(some, key, "left")


def rollup(facts: DataFrame, dimension: str, key: str, person: str, ids: int) -> DataFrame:
    """Facts (not persons) counted by dimension and key, with distinct persons and the first of them."""
    rows = facts.where(F.col(key).isNotNull())
    counts = rows.groupBy(dimension, key).agg(F.count("*").alias("n_facts"))
    persons = rows.select(dimension, key, person).distinct().groupBy(dimension, key).agg(F.count("*").alias("n_persons"))
    return counts.join(persons, [dimension, key]).join(first_members(rows, [dimension, key], person, ids, "first_ids"), [dimension, key], "left")


def facets(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Counts of several facets in one pass; null and empty keys are left out. Array facets count each element."""
    kinds = {n: t for n, t in zip(keys, [d for _, d in df.select(*[c.alias(n) for n, c in keys.items()]).dtypes])}

    def named(name: str):
        return lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("key"))

    parts = [F.transform(c if kinds[n].startswith("array") else F.array(c), named(n)) for n, c in keys.items()]
    rows = df.select(F.explode(F.concat(*[F.coalesce(p, F.array().cast("array<struct<facet:string,key:string>>")) for p in parts])).alias("f"))
    return rows.select("f.facet", "f.key").where("key is not null and key != ''").groupBy("facet", "key").agg(F.count("*").alias("n"))


def outcome_split(edges: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Resolved, ambiguous and unresolved edges by group of types, with the resolution rate."""
    group = F.coalesce(*[F.when(F.col("type").isin(*types), F.lit(name)) for name, types in groups.items()], F.lit("other"))
    out = F.when(F.col("resolved"), "resolved").when(F.col("ambiguous"), "ambiguous").otherwise("unresolved")
    rows = edges.select(group.alias("edge_group"), out.alias("outcome")).groupBy("edge_group").agg(
        F.count("*").alias("n_edges"), *[F.count_if(F.col("outcome") == o).alias(o) for o in ("resolved", "ambiguous", "unresolved")]
    )
    return rows.withColumn("resolution_rate", ratio(F.col("resolved"), F.col("n_edges")))


def top_groups(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys).limit(k)


def first_errors(errors: DataFrame, kind: str, order: Sequence[str], k: int = 5) -> DataFrame:
    """Failures of each kind and the first ``k`` of them."""
    counts = errors.groupBy(kind).agg(F.count("*").alias("failed"))
    return top_k_per_key(errors, [kind], [F.col(o) for o in order], k).join(counts, kind)
