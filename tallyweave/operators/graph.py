"""Hierarchies and graphs as edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.classify import administrative_keys
from tallyweave.session import cut_lineage


def children(edges: DataFrame, parent: str, relation: str | None = None) -> DataFrame:
    """Child ids of a node, optionally by one relation (G1)."""
    out = edges.filter(F.col("parent_id") == parent)
    return (out.filter(F.col("relation") == relation) if relation else out).select("child_id")


def pointer_cycles(parents: DataFrame, node: str, parent: str) -> DataFrame:
    """Nodes on a cycle where every node has at most one parent.

    Following the pointer 1, 2, 4, ... steps keeps only nodes still reachable after that many
    steps; once the set stops shrinking under a doubled jump it is the set of cycle nodes. The
    number of rounds is logarithmic in the longest chain, and leaves drop out in the first.
    """
    jump = parents.filter(F.col(parent).isNotNull()).select(
        F.col(node).alias("n"), F.col(parent).alias("p"))
    single = jump
    size = None
    while True:  # the set shrinks or this ends
        alive = jump.select(F.col("p").alias("n")).distinct()
        jump = jump.join(alive, "n", "left_semi")
        step = jump.select(F.col("n").alias("p"), F.col("p").alias("far"))
        jump = cut_lineage(jump.join(step, "p").select("n", F.col("far").alias("p")))
        now = jump.select("p").distinct().count()
        if now == 0 or now == size:
            break
        size = now
    cycle = jump.select(F.col("p").alias("n")).distinct()
    return cycle.join(single, "n", "left_semi").select(F.col("n").alias(node))


def edge_cycles(edges: DataFrame) -> DataFrame:
    """Edges left after peeling nodes without parents or without children.

    ``edges`` has parent_id and child_id. The residue is empty exactly when the graph is
    acyclic; otherwise it holds every cycle and the paths between cycles. Rounds go on to
    the fixed point, at most the depth of the hierarchy; each is checkpointed.
    """
    rest = edges.select("parent_id", "child_id").distinct()
    left = rest.count()
    while left:
        heads = rest.select(F.col("child_id").alias("parent_id")).distinct()
        tails = rest.select(F.col("parent_id").alias("child_id")).distinct()
        rest = cut_lineage(rest.join(heads, "parent_id", "left_semi")
                           .join(tails, "child_id", "left_semi")
                           .select("parent_id", "child_id"))
        now = rest.count()
        if now == left:
            break
        left = now
    return rest


def hierarchy_violations(units: DataFrame) -> DataFrame:
    """Unit tree rules other than cycles: unique ids, known parent, same scope."""
    dup = units.groupBy("reporting_unit_id").agg(F.count(F.lit(1)).alias("n")).filter(
        "n > 1").select("reporting_unit_id", F.lit("duplicate_unit_id").alias("rule_id"))
    scope = ["election_id", "reporting_regime_id", "jurisdiction_id"]
    parent = units.select(F.col("reporting_unit_id").alias("parent_reporting_unit_id"),
                          *[F.col(c).alias(f"_p_{c}") for c in scope],
                          F.lit(True).alias("_known")).dropDuplicates(["parent_reporting_unit_id"])
    joined = units.filter("parent_reporting_unit_id is not null").join(
        parent, "parent_reporting_unit_id", "left")
    regime = (F.col("election_id") != F.col("_p_election_id")) | ~F.col(
        "reporting_regime_id").eqNullSafe(F.col("_p_reporting_regime_id"))
    rule = (
        F.when(F.col("_known").isNull(), "unknown_parent")
        .when(regime, "parent_in_other_regime")
        .when(F.col("jurisdiction_id") != F.col("_p_jurisdiction_id"),
              "parent_in_other_jurisdiction")
    )
    bad = joined.withColumn("rule_id", rule).filter("rule_id is not null")
    return dup.unionByName(bad.select("reporting_unit_id", "rule_id"))


def rollup_paths(facts: DataFrame, levels: list[str], value: str) -> DataFrame:
    """Totals at every level of a reporting path.

    Facts are summed to the finest path first, so the explode over levels works on paths and not
    on fact rows.
    """
    paths = facts.groupBy(*levels).agg(F.sum(value).alias("_v"))
    exploded = paths.select("_v", F.inline(administrative_keys(*levels)))
    return exploded.groupBy("level", "key").agg(F.sum("_v").alias(value))


def follow(seeds: DataFrame, links: DataFrame, max_depth: int) -> DataFrame:
    """Targets within a depth of the seeds, at their least depth, with carried units.

    ``seeds`` has url and unit, ``links`` has url and target. Depth is a small constant.
    """
    hops = links.select("url", "target").distinct()
    edge = seeds.select("url", "unit").distinct()
    reached = edge.withColumn("depth", F.lit(0))
    for depth in range(1, max_depth + 1):
        step = edge.join(hops, "url").select(F.col("target").alias("url"), "unit").distinct()
        edge = step.join(reached.select("url", "unit"), ["url", "unit"], "left_anti")
        reached = reached.unionByName(edge.withColumn("depth", F.lit(depth)))
    return reached
