"""Connected components of a table of links, by hooking to smaller neighbours and jumping along pointers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of ``links(a, b)`` that is not the least of its component.

    Each round hooks a vertex to its least neighbour if that is smaller, follows the
    pointers to their ends and joins the ends of links that are left. Every step is a
    join or a grouped minimum of whole tables; rounds are stored in the shared folder.
    """
    roots = None
    while True:
        edges = stored(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .distinct(), "edges")
        if edges.isEmpty():
            break
        hooks = stored(edges.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("root")), "hooks")
        while True:
            ends = hooks.select(F.col("v").alias("root"), F.col("root").alias("end"))
            jumped = stored(hooks.join(ends, "root", "left").select(
                "v", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "hooks")
            hooks = jumped.select("v", "root")
            if jumped.filter("moved").isEmpty():
                break
        to = hooks.select(F.col("v").alias("root"), F.col("root").alias("end"))
        if roots is None:
            roots = hooks
        else:
            moved = roots.join(to, "root", "left").select("v", F.coalesce("end", "root").alias("root"))
            roots = stored(moved.unionByName(hooks), "roots")
        links = edges.join(to.withColumnsRenamed({"root": "a", "end": "x"}), "a", "left") \
            .join(to.withColumnsRenamed({"root": "b", "end": "y"}), "b", "left") \
            .select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    if roots is None:
        return links.select(F.col("a").alias("v"), F.col("b").alias("root")).limit(0)
    return roots
