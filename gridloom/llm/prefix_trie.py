"""Prefix trie of conversations: a node for each distinct sequence of first turns, with sums over its subtree.

Equal conversations are one key with their members. A prefix whose distinct conversations
have together at most ``LIMIT`` further turns is the top of a subtree that one task can
hold; tops are dealt to shards. A shard numbers its turns densely, packs them into a double
array (``double_array``), and all its keys walk the arrays at once for their nodes. Longer
prefixes are tried only where a prefix is heavier, so one that a third of all conversations
share is split below it. The nodes above the tops are shared by shards; their sums are
merged level by level over the whole table.

Cases: a null role or text is empty. Turns are ordered by number, nulls first; turns of one
number by a hash of role and text, and repeated rows are turns of their own. A row without
conversation id belongs to no conversation. A conversation without turns is a member of the
root alone. Texts of any length are only hashed and counted. One conversation's turns are
one row of 20 bytes a turn, and the ids of the members that end at one node are one row,
because the result asks for their digest. An empty table gives no node, not even the root.
Other columns are not read, so they may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import stored
from gridloom.llm.double_array import build

LIMIT = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"
NONE = hashlib.sha256(b"").hexdigest()
_TURNS = "array<struct<a:bigint,b:bigint,words:bigint>>"
_NODE = ("top boolean, a long, b long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string")
_ARROW = pa.schema([(n.split()[0], {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string()}[n.split()[1]])
                    for n in _NODE.split(", ")])


def turn_lists(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """``conv_id, turns``: the turns in order, each as 128 bits of its role and text and the words of the text."""
    who, said = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    one = F.struct(F.col(f"`{turn}`").alias("turn"), F.xxhash64(who, said).alias("a"),
                   F.xxhash64(F.lit(1), said, who).alias("b"),
                   F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"))
    keyed = rows.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), one.alias("one")) \
        .filter("conv_id IS NOT NULL")
    return keyed.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("found")) \
        .select("conv_id", F.transform("found", lambda t: F.struct(t["a"], t["b"], t["words"])).cast(_TURNS)
                .alias("turns"))


def rebuilt(convs: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Conversation ``c`` with the first ``h`` turns of ``c - c % every`` in place of its own; ``h``: its CRC-32 % ``heads``."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    lead = convs.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("lead"), F.slice("turns", 1, heads - 1).alias("begin"))
    own = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("lead"), h.alias("h"), "turns")
    begin = F.slice(F.coalesce("begin", F.array().cast(_TURNS)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(lead, "lead", "left").select("conv_id", F.concat(begin, rest).alias("turns"))


def _prefix(depth: int) -> list[Column]:
    """128 bits of the first ``depth`` turns."""
    part = F.transform(F.slice("turns", 1, depth), lambda t: F.struct(t["a"], t["b"])) if depth else F.lit(depth)
    return [F.xxhash64(part, F.lit(depth)).alias("a"), F.xxhash64(F.lit(1), part).alias("b")]



def _distinct(convs: DataFrame) -> DataFrame:
    """``conv_id, n, ends, turns``: each distinct sequence once, with its least member, their number and digest."""
    same = convs.select("conv_id", F.xxhash64("turns").alias("a"), F.xxhash64(F.lit(1), "turns").alias("b"))
    members = same.groupBy("a", "b").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"),
                                         F.sort_array(F.collect_list("conv_id")).alias("ids"))
    ends = F.sha2(F.array_join(F.transform("ids", lambda i: i.cast("string")), ","), 256)
    return members.select("conv_id", "n", ends.alias("ends")).join(convs, "conv_id")


def _split(keys: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Keys with the top of their subtree; and the shared nodes above all tops, with the keys that end there."""
    tops, shared, depth, rest = [], [], 0, keys
    while True:
        at = stored(rest.select(*_prefix(depth), *keys.columns), "prefixes")
        heavy = stored(at.groupBy("a", "b").agg(F.sum(F.size("turns") - depth + 1).alias("load"),
                                                F.max(F.size("turns")).alias("longest"))
                       .filter((F.col("load") > limit) & (F.col("longest") > depth)).select("a", "b"), "heavy")
        light = at.join(heavy, ["a", "b"], "left_anti")
        tops.append(light.select(F.lit(depth).cast("long").alias("depth"), "a", "b", *keys.columns))
        if heavy.isEmpty():
            return reduce(DataFrame.unionByName, tops), reduce(DataFrame.unionByName, shared) if shared else None
        below = at.join(heavy, ["a", "b"], "left_semi")
        words = F.get("turns", F.lit(depth - 1))["words"] if depth else F.lit(0)
        ending = F.size("turns") == depth
        up = _prefix(max(depth - 1, 0))
        shared.append(below.groupBy("a", "b").agg(
            F.lit(depth).cast("long").alias("depth"), F.min(up[0]).alias("up_a"), F.min(up[1]).alias("up_b"),
            F.min(F.coalesce(words, F.lit(0))).alias("words"),
            F.min(F.when(ending, F.col("conv_id"))).alias("end_conv"),
            F.coalesce(F.min(F.when(ending, F.col("n"))), F.lit(0)).alias("n_ends"),
            F.coalesce(F.min(F.when(ending, F.col("ends"))), F.lit(NONE)).alias("ends_sha256")))
        rest = below.filter(~ending).select(*keys.columns)
        depth += 1


def _subtrees(depth: np.ndarray, a: np.ndarray, b: np.ndarray, conv: np.ndarray, n: np.ndarray, ends: np.ndarray,
              turns: pa.ListArray) -> pa.RecordBatch:
    """All nodes below and with the tops of the given keys; keys of one top follow each other."""
    offsets = turns.offsets.to_numpy().astype(np.int64)
    flat = turns.values
    low, high = offsets[0], offsets[-1]
    ids = np.empty(high - low, [("a", np.int64), ("b", np.int64)])
    ids["a"], ids["b"] = (flat.field(c).to_numpy()[low:high] for c in ("a", "b"))
    words = flat.field("words").to_numpy()[low:high]
    top = np.cumsum(np.append(0, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    _, dense = np.unique(ids, return_inverse=True)
    # a key is its top, as the first symbol, and the turns below it
    size = np.diff(offsets) - depth
    bounds = np.append(0, np.cumsum(size + 1))
    symbols = np.empty(bounds[-1], np.int64)
    symbols[bounds[:-1]] = top
    said = np.zeros(bounds[-1], np.int64)
    inner = np.ones(bounds[-1], bool)
    inner[bounds[:-1]] = False
    spot = np.repeat(offsets[:-1] - low + depth - (bounds[:-1] + 1), size + 1)[inner] + np.flatnonzero(inner)
    symbols[inner] = dense[spot] + (top[-1] + 1)
    said[inner] = words[spot]
    led = np.flatnonzero(depth > 0)
    said[bounds[led]] = words[offsets[led] - low + depth[led] - 1]

    trie = build(symbols, bounds)
    states = len(trie.base)
    total, least = np.zeros(states, np.int64), np.full(states, np.iinfo(np.int64).max)
    weight, level, parent = np.zeros(states, np.int64), np.zeros(states, np.int64), np.zeros(states, np.int64)
    of_top, end = np.full(states, -1, np.int64), np.full(states, -1, np.int64)
    rows, at, order, step = np.arange(len(conv)), np.zeros(len(conv), np.int64), [], 0
    while len(rows):
        place = bounds[rows] + step
        to = trie.step(at, symbols[place])
        np.add.at(total, to, n[rows])
        np.minimum.at(least, to, conv[rows])
        weight[to], parent[to], level[to] = said[place], at, depth[rows] + step
        if step == 0:
            of_top[to] = rows
        order.append(np.unique(to))
        last = size[rows] == step
        end[to[last]] = rows[last]
        rows, at, step = rows[~last], to[~last], step + 1
    children, saved = np.zeros(states, np.int64), (total - 1) * weight
    leaves = np.zeros(states, np.int64)
    for found in reversed(order):
        leaves[found] += children[found] == 0
        up = parent[found]
        np.add.at(children, up, 1)
        np.add.at(leaves, up, leaves[found])
        np.add.at(saved, up, saved[found])
    node = np.concatenate(order)
    is_top = of_top[node] >= 0
    key = np.maximum(of_top[node], 0)
    ended = pa.array(ends, pa.string()).take(pa.array(np.where(end[node] >= 0, end[node], len(ends) - 1)))
    columns = [pa.array(is_top), pa.array(a[key], mask=~is_top), pa.array(b[key], mask=~is_top), pa.array(least[node]),
               pa.array(level[node]), pa.array(least[parent[node]], mask=is_top), pa.array(total[node]),
               pa.array(children[node]), pa.array(leaves[node]), pa.array(saved[node]), ended]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _shard(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Nodes of the keys ``depth, a, b, conv_id, n, ends, turns`` of a shard, sorted by top."""
    held: pa.Table | None = None

    def nodes(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        one = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in t.columns]
        number = [c.to_numpy() for c in one[:5]]
        return _subtrees(*number, [*one[5].to_pylist(), NONE], one[6])

    def complete(t: pa.Table, last: bool) -> Iterator[tuple[pa.Table, pa.Table]]:
        a, b = t.column("a").to_numpy(), t.column("b").to_numpy()
        ends = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        ends = np.append(ends, len(a)) if last else ends
        load = np.append(0, np.cumsum(pa.compute.list_value_length(t.column("turns")).to_numpy() + 1))
        begin = 0
        while begin < (ends[-1] if len(ends) else 0):
            fit = ends[(ends > begin) & (load[ends] <= load[begin] + limit)]
            stop = int(fit[-1]) if len(fit) else int(ends[ends > begin][0])
            if not last and stop == ends[-1] and load[-1] - load[begin] <= limit:
                break
            yield t.slice(begin, stop - begin), t.slice(stop)
            begin = stop

    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        for part, held in complete(held, False):
            yield nodes(part)
    if held is not None and held.num_rows:
        for part, _ in complete(held, True):
            yield nodes(part)


def prefix_trie(convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of the trie of ``conv_id, turns``.

    ``conv_id`` (least member) and ``depth`` name a node; ``parent_conv_id`` with the depth
    above names its parent. ``n_leaves`` and ``saved_tokens`` are sums over the subtree.
    """
    convs = stored(convs, "conversations")
    tops, shared = _split(stored(_distinct(convs), "keys"), limit)
    kept = tops.select("depth", "a", "b", "conv_id", "n", "ends", "turns")
    # keys of one top stay together; a shard has many tops, and small tables still use every core
    n = convs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    cores = convs.sparkSession.sparkContext.defaultParallelism
    shards = max(n // (4 * limit), min(4 * n // limit, cores)) + 1
    dealt = kept.repartition(int(shards), "a", "b").sortWithinPartitions("a", "b")
    made = stored(dealt.mapInArrow(lambda batches: _shard(batches, limit), _NODE), "nodes")
    out = made.select([c.split()[0] for c in _NODE.split(", ")][3:])
    if shared is None:
        return out
    return _merged(made, out, stored(shared, "shared"), kept)


def _merged(made: DataFrame, out: DataFrame, shared: DataFrame, keys: DataFrame) -> DataFrame:
    """The nodes with those above the tops, whose sums come from their children."""
    depths = [r[0] for r in shared.select("depth").distinct().collect()]  # 0 to the deepest
    # the prefix above each top, from any of its keys
    above = keys.groupBy("a", "b", "depth").agg(F.first("turns").alias("turns"))
    ups = []
    for depth in range(1, max(depths) + 2):
        up = _prefix(depth - 1)
        ups.append(above.filter(F.col("depth") == depth).select("a", "b", "depth", up[0].alias("up_a"),
                                                                up[1].alias("up_b")))
    linked = stored(made.filter("top").join(reduce(DataFrame.unionByName, ups), ["a", "b", "depth"]), "tops")
    sums = ["conv_id", "n_convs", "n_leaves", "saved_tokens"]
    columns = ["depth", "a", "b", "up_a", "up_b", *sums, "n_children", "ends_sha256"]
    tops = linked.select(*columns)
    found = None
    for depth in sorted(depths, reverse=True):
        below = tops if found is None else tops.unionByName(found)
        merged = below.filter(F.col("depth") == depth + 1).groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")) \
            .agg(F.min("conv_id").alias("conv"), F.sum("n_convs").alias("convs"), F.sum("n_leaves").alias("n_leaves"),
                 F.sum("saved_tokens").alias("saved"), F.count(F.lit(1)).alias("n_children"))
        n = F.col("convs") + F.col("n_ends")
        level = shared.filter(F.col("depth") == depth).join(merged, ["a", "b"]).select(
            "depth", "a", "b", "up_a", "up_b", F.least("conv", "end_conv").alias("conv_id"), n.alias("n_convs"),
            "n_leaves", (F.col("saved") + (n - 1) * F.col("words")).alias("saved_tokens"), "n_children", "ends_sha256")
        level = stored(level, "shared")
        found = level if found is None else found.unionByName(level)
    parents = found.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), (F.col("depth") + 1).alias("depth"),
                           F.col("conv_id").alias("parent_conv_id"))
    ends = found.unionByName(tops).filter("depth > 0").join(parents, ["up_a", "up_b", "depth"]) \
        .select(*out.columns)
    root = found.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*out.columns)
    inner = made.filter("NOT top").select(*out.columns)
    return inner.unionByName(ends).unionByName(root)
