"""Near duplicates by HyperMinHash sketches: bands of compressed registers, estimate, full sets.

1. Every document gets a sketch of its set of word shingles. Documents with equal sets form
   a class at once (``cls``, a hash of the whole set), so copies are one vertex.
2. Classes that agree in all registers of a band share a bucket. At similarity 0.8 a pair
   misses all 51 bands of 5 registers with chance (1 - 0.8^5)^51 < 2e-9.
3. Each class is compared with one other of its buckets (the hub it shares most buckets
   with): first the collision-corrected estimate, six deviations wide, then the full sets.
   Links found become components. A large group of copies so costs one comparison for each
   member, not all pairs.
4. What is left are buckets that hold several components. Classes that such buckets connect
   form a group; a group is dealt into blocks of bounded size, a large component into blocks of
   its own, and blocks that share a bucket are compared two by two in one task each, estimate
   first, full sets after. Two blocks of one component are not compared, and a block pair gives
   only links that join two components. So every pair of a bucket is linked, connected or
   compared, and no list of candidate pairs is ever made.

The component is named by its smallest document id. Cases: an empty or null text has an
empty set and is linked with nothing. A row without id cannot be named in a link and stays
on its own. Rows that repeat an id count as one document each; equal rows are a class. Very
long texts are whole sets. Columns beside id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import ids_side, stored, stored_by_texts
from gridloom.llm.components import components
from gridloom.llm.sketches import REGISTERS, band_keys, estimate, registers, shingle_hashes
from gridloom.llm.words import IS_SPACE, give_back, mix, rows_of, slices, take_ranges, word_hashes, word_spans

WIDTH, PERCENT = 5, 80
DEVIATIONS = 6.0
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 19


def _sets(texts: pa.Array, width: int):
    """The shingle set of each row, ascending."""
    for first, end, data, bounds in slices(texts):
        starts, ends = word_spans(data, bounds, IS_SPACE)
        hashes = word_hashes(data, starts, ends)
        cut = rows_of(starts, bounds)
        for i in range(end - first):
            yield shingle_hashes(hashes[cut[i]: cut[i + 1]], width)


def _class(found: np.ndarray) -> int:
    """64 bits of a whole set."""
    one = mix(found).sum(dtype=np.uint64)
    two = np.bitwise_xor.reduce(mix(found + np.uint64(1)))
    return int(mix(mix(np.array([one])) ^ (np.array([two]) + np.uint64(len(found)))).view(np.int64)[0])


def sketched(docs: DataFrame, width: int, sets: bool = False) -> DataFrame:
    """``doc_id, n_shingles, cls, sketch`` (null for an empty set), and the whole ``shingles`` if asked for."""
    def scan(batches):
        for batch in batches:
            n, cls, sketch, shingles = [], [], [], []
            for found in _sets(batch.column(1), width):
                n.append(len(found))
                cls.append(_class(found) if len(found) else None)
                sketch.append(registers(found).tobytes() if len(found) else None)
                shingles.append(found.view(np.int64) if sets else None)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                       pa.array(sketch, pa.binary())]
            names = ["doc_id", "n_shingles", "cls", "sketch"]
            if sets:
                columns.append(pa.array(shingles, pa.list_(pa.int64())))
                names.append("shingles")
            yield pa.RecordBatch.from_arrays(columns, names=names)
            del n, cls, sketch, shingles, columns
            give_back()

    more = ", shingles array<bigint>" if sets else ""
    return docs.mapInArrow(scan, "doc_id bigint, n_shingles bigint, cls bigint, sketch binary" + more)


def _bands(classes: DataFrame) -> DataFrame:
    """``key, cls`` for each band of each class."""
    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                sketch = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                keys = band_keys(sketch).view(np.int64)
                cls = np.repeat(np.asarray(batch.column(0)), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(cls)], names=["key", "cls"])

    return classes.select("cls", "sketch").mapInArrow(scan, "key bigint, cls bigint")


def _may_link(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose estimate does not rule the link out: ``a, b, sa, sb, na, nb`` to ``a, b``."""
    def scan(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                        for c in ("sa", "sb"))
            least = np.minimum(np.asarray(batch.column("na")), np.asarray(batch.column("nb")))
            limit = percent / 100
            room = DEVIATIONS * np.sqrt(limit * (1 - limit) / np.minimum(least, REGISTERS))
            keep = pa.array(estimate(one, two) >= limit - room)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)],
                                             names=["a", "b"])

    return pairs.mapInArrow(scan, "a bigint, b bigint")


def _side(sets: DataFrame, name: str, *columns: str) -> DataFrame:
    return sets.select(F.col("cls").alias(name), *[F.col(c).alias(c[0] + name) for c in columns])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of different classes whose sets are similar enough."""
    sizes = pairs.join(_side(sets, "b", "n_shingles", "sketch"), "b").join(_side(sets, "a", "n_shingles", "sketch"), "a")
    near = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    kept = stored(_may_link(sizes.filter(near).select("a", "b", "sa", "sb", "na", "nb"), percent), "pairs")
    whole = sets.select("cls", F.col("shingles").alias("hashes"))
    both = kept.join(_side(whole, "b", "hashes"), "b").join(_side(whole, "a", "hashes"), "a")
    shared = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b")


def _labelled(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """Bucket entries with their component, of buckets that hold several components."""
    labels = entries.join(roots.withColumnRenamed("v", "cls"), "cls", "left") \
        .select("key", "cls", F.coalesce("root", "cls").alias("comp"))
    open_keys = labels.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")) \
        .filter("low < high").select("key")
    return labels.join(open_keys, "key")


def _hub_pairs(entries: DataFrame) -> DataFrame:
    """One pair for each class: itself and, of its buckets' least classes, the one in most buckets."""
    hubs = entries.groupBy("key").agg(F.min("cls").alias("hub"))
    pairs = entries.join(hubs, "key").filter("cls <> hub").groupBy("cls", "hub").agg(F.count(F.lit(1)).alias("n"))
    # most buckets first, then the least hub: ~x falls as x rises
    best = pairs.groupBy("cls").agg(F.max(F.struct("n", F.bitwise_not("hub").alias("not_hub"))).alias("best"))
    return best.select(F.bitwise_not("best.not_hub").alias("a"), F.col("cls").alias("b"))


def _blocks(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """``grp, cls, comp, block, own``: groups of classes that open buckets connect, in blocks; ``own``: the
    block's one component, null for a block of several."""
    hubs = entries.groupBy("key").agg(F.min("cls").alias("b"))
    joined = entries.join(hubs, "key").select(F.col("cls").alias("a"), "b")
    groups = components(joined)
    rows = entries.select("cls", "comp").distinct().join(groups.withColumnRenamed("v", "cls"), "cls", "left") \
        .join(sets.select("cls", "n_shingles"), "cls") \
        .select(F.coalesce("root", "cls").alias("grp"), "cls", "comp", "n_shingles")

    def parts(frame: DataFrame, *by: str) -> DataFrame:
        return frame.groupBy(*by).agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS),
                                                 F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("parts"))

    rows = stored(rows, "groups")
    own = parts(rows, "grp", "comp").filter("parts > 1")
    large = rows.join(own, ["grp", "comp"]).withColumn("own", F.col("comp")).withColumn(
        "block", F.xxhash64("comp", F.pmod(F.xxhash64("cls"), "parts")))
    small = rows.join(own, ["grp", "comp"], "left_anti")
    pooled = small.join(parts(small, "grp"), "grp").withColumn("own", F.lit(None).cast("long")).withColumn(
        "block", F.xxhash64(F.lit(0), F.pmod(F.xxhash64("cls", F.lit(1)), "parts")))
    names = ["grp", "cls", "comp", "block", "own"]
    return stored(large.select(*names).unionByName(pooled.select(*names)), "blocks")


def _compare(rows: pa.Table, percent: int) -> pa.Table:
    """Links of a block pair that join two components."""
    cls, comp = rows["cls"].to_numpy(), rows["comp"].to_numpy()
    first = rows["first"].to_numpy(zero_copy_only=False)
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
    lists = rows["shingles"].combine_chunks()
    cut = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy()
    size = np.diff(cut)
    same = first.all()  # a block with itself
    left = np.flatnonzero(first)
    right = left if same else np.flatnonzero(~first)
    order = take_ranges(cut[right], size[right])
    members = np.repeat(np.arange(len(right)), size[right])
    by_value = np.argsort(values[order], kind="stable")
    known, begin, counts = np.unique(values[order][by_value], return_index=True, return_counts=True)
    members = members[by_value]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    limit, links = percent / 100, []
    for i in left.tolist():
        least = np.minimum(size[i], size[right])
        room = DEVIATIONS * np.sqrt(limit * (1 - limit) / np.minimum(least, REGISTERS))
        may = (estimate(sketch[i], sketch[right]) >= limit - room) & (comp[right] != comp[i]) \
            & (100 * least >= percent * np.maximum(size[i], size[right]))
        if not may.any():
            continue
        mine = values[cut[i]: cut[i + 1]]
        at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
        at = at[known[at] == mine]
        shared = np.bincount(members[take_ranges(begin[at], counts[at])], minlength=len(right))
        near = may & (100 * shared >= percent * (size[i] + size[right] - shared))
        for j in right[near].tolist():
            a, b = root(int(comp[i])), root(int(comp[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(cls[i]), int(cls[j])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _links_in_blocks(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components among the classes of open buckets."""
    rows = _blocks(entries, sets)
    blocks = stored(entries.select("key", "cls").join(rows.select("cls", "grp", "block", "own"), "cls")
                    .select("key", "grp", "block", "own").distinct(), "buckets")
    other = blocks.select("key", "grp", F.col("block").alias("other"), F.col("own").alias("other_own"))
    # each block with itself and those behind it that have a bucket of it too, but not two blocks of one component
    pairs = stored(blocks.join(other, ["key", "grp"]).filter("block <= other").filter(
        "own is null or other_own is null or own <> other_own").select("grp", "block", "other").distinct(), "pairs")
    one = pairs.select("grp", "block", "other", F.col("block").alias("mine"), F.lit(True).alias("first"))
    two = pairs.filter("block <> other").select("grp", "block", "other", F.col("other").alias("mine"),
                                                F.lit(False).alias("first"))
    placed = rows.select("grp", F.col("block").alias("mine"), "cls", "comp") \
        .join(one.unionByName(two), ["grp", "mine"]).join(sets.select("cls", "sketch", "shingles"), "cls")
    return placed.groupBy("grp", "block", "other").applyInArrow(
        lambda table: _compare(table, percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                    percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row; ``kept`` marks one document of each group."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    base = stored_by_texts(sketched(rows, width), "sketches")
    classes = base.filter("cls is not null and doc_id is not null").groupBy("cls") \
        .agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"))
    bands = _bands(classes)
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    entries = stored(bands.join(shared, "key"), "bands")

    heads = stored(entries.select("cls").distinct().join(base.select("cls", "doc_id"), "cls")
                   .groupBy("cls").agg(F.min("doc_id").alias("doc_id")), "heads")
    texts = rows.join(ids_side(heads.select("doc_id")), "doc_id", "left_semi")
    sets = stored_by_texts(sketched(texts, width, sets=True).filter("cls is not null").join(heads, ["cls", "doc_id"], "left_semi")
                  .dropDuplicates(["cls"]).select("cls", "n_shingles", "sketch", "shingles"), "sets")

    links = stored(_linked(_hub_pairs(entries), sets, percent), "links")
    left = stored(_labelled(entries, components(links)), "open")
    roots = components(links.unionByName(stored(_links_in_blocks(left, sets, percent), "links")))

    labelled = base.join(roots.withColumnRenamed("v", "cls"), "cls", "left") \
        .withColumn("root", F.coalesce("root", "cls"))
    names = labelled.filter("cls is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = labelled.select("doc_id", "n_shingles", "root").join(names, "root", "left")
    # a row without words, or without an id, is a component of its own
    alone = F.col("root").isNull() | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
