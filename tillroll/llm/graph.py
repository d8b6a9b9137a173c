"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import checkpoint


def components(links: DataFrame) -> DataFrame:
    """(node, component_id): the smallest node that each node of ``links`` (a, b) reaches.

    Links have no direction; repeated ones and loops are ignored, nulls left out, and an
    empty table gives no rows. Nodes without links do not appear.

    Every round hooks each node to the neighbour of smallest hash and contracts the links
    along the hooks, which leaves a fraction of the nodes whatever the shape: a chain of n
    nodes takes about log n rounds. Minima combine before their shuffle, and the joins on a
    hub are split by adaptive execution; no node's neighbours are gathered anywhere.
    """
    links = links.where("a <> b").select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
    links = checkpoint(links.distinct())
    hooks = []
    while not links.isEmpty():
        both = links.unionAll(links.select("b", "a").toDF("a", "b"))
        rank = F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("to"))
        hook = checkpoint(
            both.groupBy("a").agg(F.min(rank).alias("best")).select(F.col("a").alias("n"), F.least("best", own)["to"].alias("to"))
        )
        hooks.append(hook)
        ends = links.join(hook.toDF("a", "x"), "a").join(hook.toDF("b", "y"), "b")
        contracted = ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = checkpoint(contracted.distinct())
    if not hooks:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
    roots = hooks[0].toDF("node", "root")
    for hook in hooks[1:]:
        moved = roots.join(hook.toDF("root", "next"), "root", "left")
        roots = moved.select("node", F.coalesce("next", "root").alias("root"))
    roots = checkpoint(roots)
    smallest = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    return roots.join(smallest, "root").select("node", "component_id")
