"""Hierarchies kept as parent columns: set members and nearest tagged ancestors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.sources.staging import staged


#: Levels climbed in one plan.
LEVELS = 4


def set_closure(edges: DataFrame, parent: str, child: str, roots: DataFrame, depth: int = 4) -> DataFrame:
    """(root, member) pairs reachable within ``depth`` steps; the number of steps is part of what is asked for.

    One chain of joins carries a path's members along, so each level is joined once.
    """
    e = edges.select(F.col(parent).alias("_p"), F.col(child).alias("_c")).distinct()
    path = roots.select(F.col(roots.columns[0]).alias("root"), F.col(roots.columns[0]).alias("_0"))
    for k in range(1, depth + 1):
        path = path.join(e, F.col(f"_{k - 1}") == F.col("_p"), "left").withColumn(f"_{k}", F.col("_c")).drop("_p", "_c")
    members = F.explode(F.array(*(f"_{k}" for k in range(1, depth + 1))))
    return path.select("root", members.alias("member")).where("member IS NOT NULL").distinct()


def tagged_ancestor(nodes: DataFrame, tagged: DataFrame, node: str = "location_id", parent: str = "parent_location") -> DataFrame:
    """Nearest ancestor, the node itself included, that is in ``tagged``; null if none, however deep the tree.

    Nodes without an answer go up a level per join. ``LEVELS`` joins are one plan and staged; more follow only while a
    node is left without an answer. A cycle without a tag is an error.
    """
    t = tagged.select(F.col(node).alias("_t")).distinct()
    links = nodes.select(F.col(node).alias("_k"), F.col(parent).alias("_up")).join(t, F.col("_k") == F.col("_t"), "left")
    links = links.select("_k", "_up", F.col("_t").isNotNull().alias("_hit"))
    above = links.select(F.col("_k").alias("_pk"), F.col("_up").alias("_pup"), F.col("_hit").alias("_phit"))
    at = links.select(F.col("_k").alias("_n"), F.col("_k").alias("_at"), "_up", "_hit", F.lit(False).alias("_loop"))
    while True:
        for _ in range(LEVELS):
            going = ~F.col("_hit") & ~F.col("_loop")
            up = at.join(above, going & (F.col("_up") == F.col("_pk")), "left")
            moved = F.col("_pk").isNotNull()
            at = up.select(
                "_n",
                F.when(moved, F.col("_pk")).otherwise(F.col("_at")).alias("_at"),
                F.when(going, F.col("_pup")).alias("_up"),
                F.when(moved, F.col("_phit")).otherwise(F.col("_hit")).alias("_hit"),
                (F.col("_loop") | (moved & ~F.col("_phit") & (F.col("_pk") == F.col("_n")))).alias("_loop"),
            )
        at = staged(at, "level")
        state = at.agg(F.max("_loop").alias("cycle"), F.max(F.expr("NOT _hit AND _up IS NOT NULL")).alias("more")).first()
        if state["cycle"]:
            raise ValueError(f"{node} and {parent} form a cycle")
        if not state["more"]:
            break
    known = at.where("_hit").select("_n", F.col("_at").alias("_found"))
    return nodes.select(node).join(known, F.col(node) == F.col("_n"), "left").select(node, F.col("_found").alias("ancestor_id"))
