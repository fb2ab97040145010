"""Parent-child rows as full hierarchies: root, depth, path, descendants, cycles.

Over all rows an Euler tour is built (two elements for each node, entered and left) and ranked in parallel by pointer
doubling. Ranks of entering and leaving give intervals that hold exactly the descendants; the weighted ranks give
the depth, the tour's end the root. A tour is a permutation of its elements, so that of a tree ends, and that of a
component that runs into itself is a ring: a round of doubling that ends no element leaves only rings, since an element
further from its end would have others at every smaller distance. Cycles are thus exposed without a pass of their own;
peeling leaves would take as many rounds as the deepest tree has layers.

Defined cases: a null id is no node; repeated rows count once; of several parents the smallest is taken; a parent that
is no node counts as none; a node that is its own parent is a cycle, and so is all that descends from one. No step gathers
the children of one parent in one task: siblings are ordered within hashed lanes, and the lanes are then linked.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import counted, materialize, release

LANES = 32


def _edges(df: DataFrame, node: str, parent: str) -> DataFrame:
    """``node, parent, name``: numbered nodes; a null or unknown parent is null."""
    rows = df.select(F.col(node).cast("string").alias("name"), F.col(parent).cast("string").alias("above"))
    rows = rows.where("name is not null").groupBy("name").agg(F.min("above").alias("above"))
    numbered = materialize(rows.withColumn("node", F.monotonically_increasing_id()))
    known = numbered.select(F.col("name").alias("above"), F.col("node").alias("parent"))
    out = materialize(numbered.join(known, "above", "left").select("node", "parent", "name"))
    release(numbered)
    return out


def paths_up(edges: DataFrame) -> DataFrame:
    """``node, path``: names from each node to its root, by doubling; a row for every node whose way up ends."""
    names = edges.select(F.col("node").alias("parent"), F.col("name").alias("above"))
    first = edges.join(names, "parent", "left")
    path = F.when(F.col("parent").isNull(), F.array("name")).otherwise(F.array("name", "above"))
    state, waiting = counted(first.select("node", F.coalesce("parent", "node").alias("at"), F.col("parent").isNull().alias("done"), path.alias("path")), "not done")
    while waiting:
        nxt = state.select(F.col("node").alias("at"), F.col("at").alias("at2"), F.col("done").alias("done2"), F.col("path").alias("path2"))
        longer = F.concat("path", F.slice("path2", F.lit(2), F.greatest(F.size("path2") - 1, F.lit(0))))
        moved = state.where("not done").join(nxt, "at").select("node", F.col("at2").alias("at"), F.col("done2").alias("done"), longer.alias("path"))
        before, was = state, waiting
        state, waiting = counted(state.where("done").unionByName(moved), "not done")
        release(before)
        if waiting == was:
            break
    return state.where("done").select("node", "path")


def tour(edges: DataFrame) -> DataFrame:
    """``element, next, weight``: the Euler tours of ``edges(node, parent)``; ``next`` is null at a tour's end.

    A node is entered as element ``2 * node`` and left as ``2 * node + 1``. Siblings follow one another in lanes by hash;
    each lane's last sibling is followed by the next lane's first.
    """
    lane = F.pmod(F.xxhash64("node"), F.lit(LANES))
    children = edges.where("parent is not null").select("parent", lane.alias("lane"), "node")
    in_lane = Window.partitionBy("parent", "lane").orderBy("node")
    ordered = children.withColumn("sibling", F.lead("node").over(in_lane))
    heads = children.groupBy("parent", "lane").agg(F.min("node").alias("head"))
    linked = heads.withColumn("next_head", F.lead("head").over(Window.partitionBy("parent").orderBy("lane")))
    first = heads.groupBy("parent").agg(F.min_by("head", "lane").alias("first"))
    ordered = ordered.join(linked.select("parent", "lane", "next_head"), ["parent", "lane"])
    siblings = ordered.select("node", F.coalesce("sibling", "next_head").alias("sibling"))
    nodes = edges.select("node", "parent").join(first.withColumnRenamed("parent", "node"), "node", "left").join(siblings, "node", "left")
    steps = F.array(
        F.struct(F.expr("2 * node").alias("element"), F.expr("coalesce(2 * first, 2 * node + 1)").alias("next"), F.lit(1).alias("weight")),
        F.struct(F.expr("2 * node + 1").alias("element"), F.expr("coalesce(2 * sibling, 2 * parent + 1)").alias("next"), F.lit(-1).alias("weight")),
    )
    return nodes.select(F.explode(steps).alias("s")).select("s.element", "s.next", "s.weight")


def ranked(elements: DataFrame) -> DataFrame:
    """``element, last, rank, weight, done``: steps and weights from each element to the end of its list, by pointer doubling.

    Elements of a list without an end are not ``done``.
    """
    state, waiting = counted(elements.select(
        "element", F.coalesce("next", "element").alias("last"), F.col("next").isNotNull().cast("long").alias("rank"),
        F.col("weight").cast("long").alias("weight"), F.col("next").isNull().alias("done"),
    ), "not done")
    while waiting:
        open_, closed = state.where("not done"), state.where("done")
        nxt = state.select(F.col("element").alias("last"), F.col("last").alias("last2"), F.col("rank").alias("rank2"), F.col("weight").alias("weight2"), F.col("done").alias("done2"))
        moved = open_.join(nxt, "last").select(
            "element", F.col("last2").alias("last"), (F.col("rank") + F.col("rank2")).alias("rank"), (F.col("weight") + F.col("weight2")).alias("weight"), F.col("done2").alias("done")
        )
        before, was = state, waiting
        state, waiting = counted(closed.unionByName(moved), "not done")
        release(before)
        if waiting == was:
            break
    return state


def hierarchy(df: DataFrame, node: str, parent: str, paths: bool = False) -> DataFrame:
    """``node, parent, root, depth, entered, left, descendants, is_cycle[, path]`` for every node.

    ``x`` descends from ``y`` exactly if both have one root and ``y.entered < x.entered < y.left``. For nodes of a way
    that never ends all these are null and ``is_cycle`` is true.
    """
    edges = _edges(df, node, parent)
    ranks = ranked(tour(edges))
    # ranks count from the tour's end; entered and left count from its beginning
    entered = F.col("element") % 2 == 0
    sides = ranks.groupBy(F.expr("element div 2").alias("node")).agg(
        F.bool_and("done").alias("done"), F.max(F.expr("last div 2")).alias("top"), F.max(F.when(entered, F.col("rank"))).alias("in_rank"),
        F.max(F.when(~entered, F.col("rank"))).alias("out_rank"), F.max(F.when(entered, -F.col("weight"))).alias("depth"),
    )
    rows = edges.join(sides, "node").withColumn("top", F.when(F.col("done"), F.col("top")))
    tops = rows.where("node = top").select("top", F.col("name").alias("root"), F.col("in_rank").alias("length"))
    above = edges.select(F.col("node").alias("parent"), F.col("name").alias("above"))
    placed = rows.join(tops, "top", "left").join(above, "parent", "left")
    if paths:
        placed = placed.join(paths_up(edges), "node", "left")
    known = F.col("top").isNotNull()
    return placed.select(
        F.col("name").alias("node"), F.col("above").alias("parent"), "root", F.when(known, F.col("depth")).alias("depth"), (F.col("length") - F.col("in_rank")).alias("entered"),
        (F.col("length") - F.col("out_rank")).alias("left"), F.when(known, F.expr("(in_rank - out_rank - 1) div 2")).alias("descendants"), (~known).alias("is_cycle"),
        *(["path"] if paths else []),
    )


def lineage_edges(nasab: DataFrame) -> DataFrame:
    """``person_id, father``: the father's entry of each current row of nasab, null where there is none."""
    from ..functions.folding import folded_each
    from .current import current_rows

    now = current_rows(nasab, "person_id", ["father_id", "chain"])
    rows = now.select("person_id", "father_id", F.array_join(folded_each("chain"), "\u001f", "").alias("line"), F.size("chain").alias("names"))
    rows = materialize(rows.withColumn("names", F.when(F.col("line").isNull(), 0).otherwise(F.col("names"))))
    trimmed = F.lower(F.regexp_replace("father_id", "(?U)^\\s+|\\s+$", ""))
    named = rows.where("father_id is not null").select("person_id", trimmed.alias("wanted"))
    ids = rows.groupBy(F.lower("person_id").alias("wanted")).agg(F.min("person_id").alias("father"))
    by_id = named.join(ids, "wanted").select("person_id", "father")
    lines = rows.where("names > 0").groupBy("line").agg(F.min("person_id").alias("father"), F.count("*").alias("n")).where("n = 1").select("line", "father")
    unnamed = rows.where("father_id is null and names > 1")
    tails = unnamed.select("person_id", F.expr("substring(line, locate('\u001f', line) + 1)").alias("line"))
    by_chain = tails.join(lines, "line").select("person_id", "father")
    return rows.select("person_id").join(by_id.unionByName(by_chain), "person_id", "left")


def p6_found(spark, sf_dir: str) -> DataFrame:
    edges = lineage_edges(spark.read.parquet(f"{sf_dir}/nasab.parquet"))
    found = hierarchy(edges, "person_id", "father").where("parent is not null")
    return found.select(
        F.col("node").alias("person_id"), F.when(F.col("is_cycle"), "cycle").otherwise(F.col("root")).alias("root_id"),
        F.when(F.col("is_cycle"), -1).otherwise(F.col("depth")).cast("int").alias("tree_depth"),
    )


def p6_trees(spark, sf_dir: str) -> DataFrame:
    edges = lineage_edges(spark.read.parquet(f"{sf_dir}/nasab.parquet"))
    return hierarchy(edges, "person_id", "father", paths=True).withColumnRenamed("node", "person_id").withColumnRenamed("parent", "father_id")


def p6_descendants(spark, sf_dir: str) -> DataFrame:
    """One row for each entry and each of its descendants, by the paths."""
    trees = p6_trees(spark, sf_dir).where("not is_cycle")
    return trees.select(F.explode(F.slice("path", F.lit(2), F.greatest(F.size("path") - 1, F.lit(0)))).alias("person_id"), F.col("person_id").alias("descendant_id"))
