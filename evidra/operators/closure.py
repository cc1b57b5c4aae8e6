"""Transitive closures over DAGs and trees, as loops of joins over a frontier; each round is cut to a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidra.operators.shared import base, released, written


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage, written to the checkpoint folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(base(df.sparkSession))
    return df.checkpoint()


def ancestors(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Ids (id) reached from seeds (id) over edges (child, parent), seeds included; the frontier only is joined each round."""
    steps = edges.select("child", "parent").distinct()
    reached = frontier = cut(seeds.select("id").distinct())
    while not frontier.isEmpty():
        up = frontier.join(steps, frontier["id"] == steps["child"]).select(F.col("parent").alias("id")).distinct()
        frontier = cut(up.join(reached, "id", "left_anti"))
        reached = reached.unionByName(frontier)
    return reached


def walked_edges(reached: DataFrame, edges: DataFrame) -> DataFrame:
    """Every edge out of a reached id."""
    return edges.join(reached.select(F.col("id").alias("child")), "child", "left_semi")


def descendants(roots: DataFrame, edges: DataFrame) -> DataFrame:
    return ancestors(roots, edges.select(F.col("parent").alias("child"), F.col("child").alias("parent")))


def closure_table(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(id, ancestor, distance) of all nodes (id; those of edges by default): each id itself at distance 0 and every ancestor
    over edges (child, parent) with the length of the shortest way.

    Ways are doubled: a pair at a distance of exactly 2^k meets all pairs up to 2^k, which gives those up to 2^(k+1). So a depth of
    d takes log2(d) rounds, cycles end, and a round writes only the pairs it finds; what it joins on is a far ancestor, and hot ones
    are split by the session's skew join.
    """
    steps = edges.select(F.col("child").alias("id"), F.col("parent").alias("ancestor")).where("id <> ancestor").distinct()
    own = edges.select(F.col("child").alias("id")).unionByName(edges.select(F.col("parent").alias("id")))
    own = own.unionByName(nodes.select("id")) if nodes is not None else own
    here = own.distinct().select("id", F.col("id").alias("ancestor"), F.lit(0).alias("distance"))
    near = written(steps.withColumn("distance", F.lit(1)), "closure")
    proper, span = near, 1
    while True:
        farthest = near if span == 1 else near.where(F.col("distance") == span)
        onward = proper.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("far"), F.col("distance").alias("more"))
        met = farthest.drop("distance").join(onward, "ancestor").where("id <> far").groupBy("id", F.col("far").alias("ancestor")).agg((F.min("more") + span).alias("distance"))
        near = written(met.join(proper.select("id", "ancestor"), ["id", "ancestor"], "left_anti").select("id", "ancestor", "distance"), "closure")
        if near.isEmpty():
            released(near)
            return here.unionByName(proper)
        proper, span = proper.unionByName(near), 2 * span


def by_ancestor(closure: DataFrame) -> DataFrame:
    """A closure table laid out for publishing: the rows of an ancestor together, so that a filter on it skips the rest."""
    return closure.repartitionByRange("ancestor", "id").sortWithinPartitions("ancestor", "id")


def under(closure: DataFrame, terms: DataFrame) -> DataFrame:
    """id, term: the ids at or below each of the terms (id), by one join with the table."""
    return closure.join(terms.select(F.col("id").alias("ancestor")), "ancestor").select("id", F.col("ancestor").alias("term"))


def excluded(causes: list[tuple[str, DataFrame]]) -> DataFrame:
    """Ids with the smallest reason among the sets (reason, ids) they belong to."""
    parts = [ids.select("id", F.lit(reason).alias("reason")) for reason, ids in causes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("id").agg(F.min("reason").alias("reason"))


def resolve_merges(ids: DataFrame, merged: DataFrame, current: DataFrame) -> DataFrame:
    """ids (id) with the current id that at most seven old -> new hops lead to; null if none does: unknown, cyclic or too long.

    Hops are doubled, current ids having none: tables of one, two and four hops, which end early where a chain ends, make seven.
    """
    known = current.select("id").distinct()
    one = merged.select("old_id", "new_id").join(known.withColumnRenamed("id", "old_id"), "old_id", "left_anti")
    after = lambda df, at, hops: df.join(hops.select(F.col("old_id").alias(at), F.col("new_id").alias("onward")), at, "left").withColumn(at, F.coalesce("onward", at)).drop("onward")
    two = written(after(one, "new_id", one), "hops")
    four = written(after(two, "new_id", two), "hops")
    found = ids.select("id").distinct().withColumn("at", F.col("id"))
    for hops in (one, two, four):
        found = after(found, "at", hops)
    return found.join(known.select(F.col("id").alias("at"), F.col("id").alias("resolved")), "at", "left").select("id", "resolved")


def lineage(taxa: DataFrame, parents: DataFrame) -> DataFrame:
    """(id, ancestor, depth): each id, depth 0, and all its ancestors over parents (id, parent); a root is its own parent.

    Jumps are doubled: lines that reach up to 2^k - 1 levels take the jump of 2^k levels, so a depth of d takes log2(d) rounds.
    Chains of parents must end: a cycle, which no tree has, would never.
    """
    jump = parents.select(F.col("id").alias("ancestor"), "parent").where("ancestor <> parent")
    lines, span = written(taxa.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("depth")).distinct(), "lines"), 1
    while True:
        more = written(lines.join(jump, "ancestor").select("id", F.col("parent").alias("ancestor"), (F.col("depth") + span).alias("depth")), "lines")
        if more.isEmpty():
            return lines
        lines, span = lines.unionByName(more), 2 * span
        farther = jump.join(jump.select(F.col("ancestor").alias("parent"), F.col("parent").alias("onward")), "parent").select("ancestor", F.col("onward").alias("parent"))
        last, jump = jump, written(farther, "jumps")
        released(last)


def nearest_of_rank(lines: DataFrame, ranked: DataFrame) -> DataFrame:
    """For each id its nearest ancestor, itself included, among ids (id) of a rank; ids without one are left out."""
    found = lines.join(ranked.select(F.col("id").alias("ancestor")), "ancestor", "left_semi")
    return found.groupBy("id").agg(F.min_by("ancestor", F.struct("depth", "ancestor")).alias("nearest"))


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
