"""Joins, windows and top-k with bounded groups.

None of these gathers one key's rows in one task: ranks are taken within hashed lanes first, carried values within
order buckets first, and only what remains of each lane or bucket meets in one place.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 32
#: Values from which the ranges of ``ordinals`` are drawn.
SAMPLE = 10_000


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank", lanes: int = LANES) -> DataFrame:
    """The first ``k`` rows of each key in a total order, with their rank from 1.

    Each lane keeps its own first ``k``; at most ``lanes * k`` rows of a key are then ranked together. Null keys
    form a group; ties must be broken by ``order``.
    """
    lane = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if dict(df.dtypes)[c].split("<")[0] not in ("map", "variant")]), F.lit(lanes))
    first = df.withColumn("__lane", lane)
    first = first.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, "__lane").orderBy(*order))).where(F.col("__r") <= k)
    last = first.drop("__lane", "__r").withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return last.where(F.col(rank) <= k)


def first_members(df: DataFrame, keys: Sequence[str], member: str, k: int, out: str = "members") -> DataFrame:
    """The first ``k`` distinct members of each key in their order, as an array; null members are left out."""
    distinct = df.where(F.col(member).isNotNull()).select(*keys, member).distinct()
    top = top_k_per_key(distinct, keys, [F.col(member)], k, "__rank")
    rows = top.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__rank", member))).alias("__m"))
    return rows.select(*keys, F.transform("__m", lambda m: m[member]).alias(out))


def carry_forward(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str, bucket: Column) -> DataFrame:
    """The last value that is not null at or before each row.

    ``bucket`` is a coarse, monotone function of the first order column. Values are carried within a bucket, each
    bucket's last value is carried over the buckets, and rows without a value in their own bucket take it.
    """
    rows = df.withColumn("__bucket", bucket)
    keys = [*by, "__bucket"]
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__own", F.last(value, ignorenulls=True).over(inner))
    ends = df.withColumn("__bucket", bucket).where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("__end"))
    spine = rows.select(*keys).distinct().join(ends, keys, "left")
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    spine = spine.withColumn("__before", F.last("__end", ignorenulls=True).over(before)).drop("__end")
    return rows.join(spine, keys, "left").withColumn(out, F.coalesce("__own", "__before")).drop("__own", "__before", "__bucket")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_order: str, right_order: str, values: Sequence[str], bucket) -> DataFrame:
    """Each left row with the values of the latest right row at or before it (of equal ones the last by value).

    ``bucket`` maps an order column to a coarse, monotone column.
    """
    columns = [c for c in left.columns if c not in by]
    a = left.select(*by, F.col(left_order).alias("__at"), F.lit(1).alias("__side"), F.struct(*columns).alias("__row"), F.lit(None).alias("__v"))
    b = right.select(*by, F.col(right_order).alias("__at"), F.lit(0).alias("__side"), F.struct(*values).alias("__v"))
    b = b.groupBy(*by, "__at", "__side").agg(F.max("__v").alias("__v"))
    both = a.drop("__v").unionByName(b, allowMissingColumns=True)
    carried = carry_forward(both, by, ["__at", "__side"], "__v", "__found", bucket(F.col("__at"))).where("__side = 1")
    return carried.select(*by, "__row.*", *[F.col("__found").getField(v).alias(v) for v in values])


def range_join(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, width: float, how: str = "inner", by: Sequence[str] = ()) -> DataFrame:
    """Points joined with the ranges that hold them (both ends inside), by equal bins instead of all pairs.

    ``by`` are columns of both sides that must be equal. A range whose ends are swapped or null holds nothing.
    """
    p = points.withColumn("__bin", F.floor(F.col(at) / width))
    r = ranges.where(F.col(low) <= F.col(high)).withColumn("__bin", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    if how == "inner":
        return p.join(r, [*by, "__bin"]).where(F.col(at).between(F.col(low), F.col(high))).drop("__bin")
    if by:
        raise ValueError("equal columns are for inner joins")
    on = (p["__bin"] == r["__bin"]) & (p[at] >= r[low]) & (p[at] <= r[high])
    return p.join(r, on, how).drop("__bin")


def resolve(names: DataFrame, keys: DataFrame, name: str, key: str, target: str, candidates: int = 5) -> DataFrame:
    """``outcome`` of each name: resolved (one target), ambiguous (several, the first ones listed) or unresolved."""
    distinct = keys.where(F.col(key).isNotNull()).select(F.col(key).alias(name), target).distinct()
    counts = distinct.groupBy(name).agg(F.count("*").alias("n_targets"), F.min(target).alias("__one"))
    some = first_members(distinct.join(counts.where("n_targets > 1").select(name), name, "left_semi"), [name], target, candidates, "candidates")
    out = names.join(counts, name, "left").join(some, name, "left")
    return out.withColumn(
        "outcome", F.when(F.col("n_targets").isNull(), "unresolved").when(F.col("n_targets") == 1, "resolved").otherwise("ambiguous")
    ).withColumn(target, F.when(F.col("n_targets") == 1, F.col("__one"))).drop("__one").fillna(0, ["n_targets"])


def filter_or_keep(candidates: DataFrame, keys: Sequence[str], keep: Column) -> DataFrame:
    """Candidates that pass; where none of a key's candidates passes, all of them stay."""
    flagged = candidates.withColumn("__keep", F.coalesce(keep, F.lit(False)))
    passing = flagged.where("__keep").select(*keys).distinct().withColumn("__some", F.lit(True))
    return flagged.join(passing, list(keys), "left").where(F.col("__keep") | F.col("__some").isNull()).drop("__keep", "__some")


def unique_best(scored: DataFrame, keys: Sequence[str], score: str, target: str, least: float | None = None) -> DataFrame:
    """The target with the strictly greatest score of each key; keys whose best score is shared have none."""
    rows = scored if least is None else scored.where(F.col(score) >= least)
    best = rows.groupBy(*keys, score).agg(F.count("*").alias("n"), F.min(target).alias(target))
    top = best.groupBy(*keys).agg(F.max(F.struct(score, "n", target)).alias("t"))
    return top.where("t.n = 1").select(*keys, F.col(f"t.{target}").alias(target), F.col(f"t.{score}").alias(score))


def having_all(rows: DataFrame, key: str, postings: DataFrame, wanted: Sequence[tuple[str, str]], kind: str = "kind", value: str = "value") -> DataFrame:
    """Rows whose key has a posting for each wanted ``(kind, value)``."""
    for k, v in wanted:
        rows = rows.join(postings.where((F.col(kind) == k) & (F.col(value) == v)).select(key).distinct(), key, "left_semi")
    return rows


def running_until(df: DataFrame, order: Sequence[str], amount: str, cap: int, bucket: Column) -> DataFrame:
    """Rows in order until the amounts of the rows before reach ``cap``, with the running total ``spent``.

    Totals run over order buckets first, then inside the buckets that are reached.
    """
    rows = df.withColumn("__bucket", bucket)
    totals = rows.groupBy("__bucket").agg(F.sum(amount).alias("__total"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("__start", F.coalesce(F.sum("__total").over(before), F.lit(0))).where(F.col("__start") < cap).drop("__total")
    inner = Window.partitionBy("__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spent = rows.join(starts, "__bucket").withColumn("spent", F.col("__start") + F.sum(amount).over(inner))
    return spent.where(F.col("spent") - F.col(amount) < cap).drop("__bucket", "__start")


def round_robin(df: DataFrame, strata: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """``n`` rows, one from each stratum in turn, strata in their order."""
    top = top_k_per_key(df, strata, [F.col(o) for o in order], n, "round")
    return top.orderBy("round", *strata, *order).limit(n)


def ordinals(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, lanes: int = LANES) -> DataFrame:
    """Place of each row among those of its key, from 0, in a total order.

    Rows are ranked within ranges of the order, and a range begins behind the rows of those before it, so that a hot key
    is many tasks. The ranges are split points of the order's first column, drawn from a sample; they decide speed only.
    """
    first = F.col(order[0])
    cuts = [r[0] for r in df.where(first.isNotNull()).select(first).sample(0.1).limit(SAMPLE).distinct().orderBy(first).collect()]
    cuts = cuts[:: max(1, len(cuts) // lanes)][1:]
    lane = F.when(first.isNull(), F.lit(-1)).otherwise(sum((F.when(first >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)))
    rows = df.withColumn("__lane", lane)
    sizes = rows.groupBy(*keys, "__lane").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    starts = starts.select(F.col("__lane").alias("__l"), "__start", *[F.col(c).alias(f"__k_{c}") for c in keys])
    on = F.col("__lane") == F.col("__l")
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    both = rows.join(starts, on).drop("__l", *[f"__k_{c}" for c in keys])
    inner = Window.partitionBy(*keys, "__lane").orderBy(*order)
    return both.withColumn(out, F.col("__start") + F.row_number().over(inner) - 1).drop("__lane", "__start")


def neighbors(df: DataFrame, by: Sequence[str], order: Sequence[str], column: str, bucket: Column | None = None) -> DataFrame:
    """The column's values in the row before and the row after, within a key.

    With ``bucket``, a coarse monotone function of the first order column, a hot key is many tasks: rows see their
    neighbours within a bucket, and its first and last row those of the buckets beside it.
    """
    before, after = f"previous_{column}", f"next_{column}"
    if bucket is None:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn(before, F.lag(column).over(w)).withColumn(after, F.lead(column).over(w))
    rows = df.withColumn("__bucket", bucket)
    inner = Window.partitionBy(*by, "__bucket").orderBy(*order)
    rows = rows.withColumns({before: F.lag(column).over(inner), after: F.lead(column).over(inner), "__first": F.row_number().over(inner) == 1, "__last": F.lead(F.lit(1)).over(inner).isNull()})
    at = F.struct(*order)
    ends = df.withColumn("__bucket", bucket).groupBy(*by, "__bucket").agg(F.min(F.struct(at.alias("o"), F.col(column).alias("v"))).alias("__a"), F.max(F.struct(at.alias("o"), F.col(column).alias("v"))).alias("__z"))
    beside = Window.partitionBy(*by).orderBy("__bucket")
    ends = ends.select(F.col("__bucket").alias("__b"), F.lag("__z").over(beside).getField("v").alias("__prev"), F.lead("__a").over(beside).getField("v").alias("__next"), *[F.col(c).alias(f"__k_{c}") for c in by])
    on = F.col("__bucket").eqNullSafe(F.col("__b"))
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    both = rows.join(ends, on)
    both = both.withColumns({before: F.when(F.col("__first"), F.col("__prev")).otherwise(F.col(before)), after: F.when(F.col("__last"), F.col("__next")).otherwise(F.col(after))})
    return both.select(*df.columns, before, after)


def uncovered(spine: DataFrame, covered: DataFrame, on: str) -> DataFrame:
    """Points of the spine that nothing covers."""
    return spine.join(covered.select(on).distinct(), on, "left_anti")


def one_hop(edges: DataFrame, vertex: str, cap: int) -> DataFrame:
    """Outgoing and incoming neighbours of each vertex, without self loops, the first ``cap`` by key, with directions."""
    out = edges.select(F.col("src").alias(vertex), F.col("dst").alias("neighbor"), F.lit("out").alias("direction"))
    into = edges.where("src != dst").select(F.col("dst").alias(vertex), F.col("src").alias("neighbor"), F.lit("in").alias("direction"))
    return top_k_per_key(out.unionByName(into).distinct(), [vertex], [F.col("neighbor"), F.col("direction")], cap)
