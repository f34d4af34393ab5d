"""Connected components of a link table, by contraction rounds on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import Held


def connected_components(links: DataFrame, a: str = "a", b: str = "b", held: Held | None = None) -> DataFrame:
    """(node, root): each node of ``links`` and one node that all of its component share.

    A round hooks every node onto the neighbour (or itself) that comes first in a pseudorandom
    order, follows that pointer once more, and replaces both ends of every link by what they point
    to.  Links inside one node go; the loop ends when none is left.  Only nodes that come before
    all of their neighbours survive a round; in random order that is at most about a third of a
    path and fewer elsewhere, whatever the ids, so rounds grow with the logarithm of the size.
    Only link and node tables move, through joins and partial aggregates; hub nodes are ordinary
    skewed join keys.  Each round is written to the shared checkpoint folder, so a lost executor
    never costs more than one round; the tables of earlier rounds are deleted, and ``held`` owns the
    result's.  NULL ends and self-links are ignored; no links give an empty
    result.
    """
    held = held or Held(links.sparkSession)
    edges = held.checkpoint(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct())
    nodes = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("node", "next")
        hook = both.groupBy("node").agg(F.min(F.struct(F.xxhash64("next").alias("h"), "next")).alias("m"))
        own = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("next"))
        hook = hook.select("node", F.least("m", own)["next"].alias("up"))
        above = hook.select(F.col("node").alias("up"), F.col("up").alias("root"))
        jump = held.checkpoint(hook.join(above, "up").select("node", "root"))
        moved = edges.join(jump.toDF("a", "ra"), "a").join(jump.toDF("b", "rb"), "b")
        fewer = held.checkpoint(
            moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .where("a < b").distinct())
        held.release(edges)
        edges = fewer
        if nodes is None:
            nodes = jump
        else:
            followed = held.checkpoint(nodes.withColumnRenamed("root", "was").join(
                jump.toDF("was", "now"), "was", "left").select("node", F.coalesce("now", "was").alias("root")))
            held.release(nodes)
            held.release(jump)
            nodes = followed
    if nodes is None:
        return edges.toDF("node", "root")
    held.release(edges)
    return nodes
