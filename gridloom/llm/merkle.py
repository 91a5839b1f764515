"""Merkle manifest of a dataset: digests of runs of ``fanout`` nodes up to one root, and every leaf's proof.

Time-forward processing: a node's label is its level, its tree (the group) and its place.
Going up, each node sends its digest to its parent's label, and the messages of a level are
dealt and sorted by label, which is the external priority queue: a parent finds its
children's digests as one run. Going down, labels are swept in reverse: a parent sends each
child the proof suffix, the siblings on both sides of every node up to the root. A leaf's
run gets its suffix once, not once a leaf. A level has a 16th of the rows of the one below,
and a message goes to exactly one parent, so a group of any size is spread over all tasks.

Digests are lowercase hex SHA-256 of concatenated hex digests. While a tree has several nodes, every
``fanout`` consecutive ones become one; a last run may be shorter, even a single node, and
becomes its digest too. A lone leaf is its group's subroot. The subroots, by group, make
the top tree in the same way.

Cases: a null in any field is ``-`` in the leaf; a null group comes first and is a group;
rows without an order value come first in theirs. Rows of equal order follow their leaf;
equal rows have equal leaves, so their order does not matter. Texts of any length are only
hashed, in one pass. An empty table gives no rows. Kept columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import free_name, stored

FANOUT = 16


def _digest(joined: Column) -> Column:
    return F.sha2(joined, 256)


def leaf_digest(*fields: Column) -> Column:
    """The digest of the fields, each ``-`` or its UTF-8 length, a colon and its value."""
    def framed(x: Column) -> Column:
        x = x.cast("string")
        return F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-"))
    return _digest(F.concat(*[framed(f) for f in fields]))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``tree, idx, n`` beside the rows: the place in its group, which is the first column of ``order``.

    Rows are range-sorted and numbered in their partition; only the counts of each group and
    partition are added up, so a group may lie over many partitions. ``tree`` is the number of the group's first row.
    """
    # ids of a partition are consecutive; they are fixed by the written table
    dealt = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .select("*", F.monotonically_increasing_id().alias("at")), "leaves")
    part = F.shiftright("at", 33)
    counts = dealt.groupBy(F.col(order[0]).alias("of"), part.alias("p")).agg(
        F.min("at").alias("low"), F.count(F.lit(1)).alias("m"))
    mine = Window.partitionBy("of")
    before = mine.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    places = stored(counts.select(
        "of", "p", F.min("low").over(mine).alias("tree"), F.sum("m").over(mine).alias("n"),
        (F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("low")).alias("shift")), "places")
    return dealt.join(places, F.col(order[0]).eqNullSafe(F.col("of")) & (part == F.col("p"))) \
        .withColumn("idx", F.col("at") + F.col("shift")).drop("of", "p", "shift", "at")


def _climb(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame | None]:
    """The runs of each level, and the top of every tree: ``tree, height, digest`` and, at height 0, its ``row``."""
    runs: list[DataFrame] = []
    tops = None
    while True:
        height = len(runs)
        row = F.col("row") if height == 0 else F.lit(None).cast(tops.schema["row"].dataType).alias("row")
        top = nodes.filter("n = 1").select("tree", F.lit(height).alias("height"), "digest", row)
        tops = top if tops is None else tops.unionByName(top)
        rest = nodes.filter("n > 1")
        if rest.isEmpty():
            return runs, tops
        child = F.struct((F.col("idx") % fanout).cast("int").alias("rank"), "digest", *(["row"] if height == 0 else []))
        queue = rest.select("tree", F.expr(f"idx div {fanout}").alias("parent"),
                            F.ceil(F.col("n") / fanout).alias("m"), child.alias("child")) \
            .repartitionByRange("tree", "parent").sortWithinPartitions("tree", "parent")
        got = queue.groupBy("tree", "parent", "m").agg(F.collect_list("child").alias("children"))
        ranked = F.sort_array(F.transform("children", lambda c: F.struct(c["rank"], c["digest"])))
        made = got.withColumn("run", F.transform(ranked, lambda c: c["digest"])) \
            .withColumn("digest", _digest(F.array_join("run", "")))
        runs.append(stored(made, f"level-{height}"))
        nodes = runs[-1].select("tree", F.col("parent").alias("idx"), F.col("m").alias("n"), "digest")


def _handed_down(runs: DataFrame, paths: DataFrame, fanout: int) -> DataFrame:
    """Children of the runs with their proofs: own siblings, then the parent's suffix."""
    rank = F.col("child.rank")
    own = F.struct(F.array_join(F.slice("run", F.lit(1), rank), "").alias("left"),
                   F.array_join(F.slice("run", rank + 2, F.lit(fanout)), "").alias("right"))
    return runs.select("tree", "parent", "run", "children").join(
        paths.withColumnRenamed("idx", "parent"), ["tree", "parent"]) \
        .withColumn("child", F.explode("children")) \
        .withColumn("path", F.concat(F.array(own), "path"))


def _sweep(runs: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """``row, digest, subroot, path`` of every leaf; ``tops`` have ``tree, height, subroot, path, row``."""
    begun = tops.select("tree", "height", F.lit(0).cast("long").alias("idx"), "subroot", "path")
    paths = None
    for level in reversed(range(len(runs))):
        mine = begun.filter(F.col("height") == level + 1).drop("height")
        paths = mine if paths is None else paths.unionByName(mine)
        down = _handed_down(runs[level], paths, fanout)
        if level:
            paths = stored(down.select("tree", (F.col("parent") * fanout + F.col("child.rank")).alias("idx"),
                                       "subroot", "path"), "suffixes")
    lone = tops.filter("height = 0").select("row", F.col("subroot").alias("digest"), "subroot", "path")
    if not runs:
        return lone
    return down.select("child.row", "child.digest", "subroot", "path").unionByName(lone)


def manifest(rows: DataFrame, group: str, order: str, digest: Column, fanout: int = FANOUT,
             out: str = "merkle") -> tuple[DataFrame, str]:
    """The rows with a struct ``leaf, subroot, root, path``; and that column's name.

    ``path`` is the proof: for every level from the leaf's run to the root the digests of
    the siblings to the ``left`` and to the ``right``, concatenated (``folded`` applies it).
    """
    out = free_name(rows, out)
    carried = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    leaves = rows.select(F.col(f"`{group}`").alias("g"), F.col(f"`{order}`").alias("o"), digest.alias("digest"),
                         carried.alias("row"))
    runs, tops = _climb(_numbered(leaves, ["g", "o", "digest"]).select("tree", "idx", "n", "digest", "row"), fanout)
    tops = stored(tops, "subroots")
    # the top tree: subroots in the order of their groups, whose labels ascend with them
    upper = tops.select(F.lit(0).alias("g"), F.col("tree").alias("o"), "digest", F.struct("tree", "height", "row").alias("row"))
    above, ends = _climb(_numbered(upper, ["g", "o"]).select("tree", "idx", "n", "digest", "row"), fanout)
    root = F.lit(None).cast("string")
    found = ends.select("digest").first()  # one row
    if found is not None:
        root = F.lit(found[0])
    none = F.array().cast("array<struct<left:string,right:string>>")
    proved = _sweep(above, ends.select("tree", "height", F.col("digest").alias("subroot"), none.alias("path"), "row"),
                    fanout)
    tops = stored(proved.select("row.*", F.col("digest").alias("subroot"), "path"), "subroots")
    made = _sweep(runs, tops, fanout)
    return made.select("row.*", F.struct(F.col("digest").alias("leaf"), "subroot", root.alias("root"), "path")
                       .alias(out)), out


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf's run upwards, left to right."""
    return _digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf has by its proof."""
    return F.aggregate(path, leaf, lambda d, s: _digest(F.concat(s["left"], d, s["right"])))
