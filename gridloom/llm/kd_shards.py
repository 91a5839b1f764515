"""K-d tree sharding: cells split at distributed weighted medians along their widest dimension.

Every row is a point of metadata (numbers as they are, strings by their first bytes) with a
weight. A cell that is to become ``k`` shards is cut along its widest dimension, relative to
the range of all rows, so that the two sides get ``k // 2`` and ``k - k // 2`` shards' share
of its weight; cells end at one shard, so ``total / target bytes`` decides the depth.

The cut is the exact weighted quantile of an integer key (the value in ``VALUE_BITS`` bits of its
range, then hash bits that order equal values), found by rounds of histograms: each
aggregates all rows of the cells into ``2^BIN_BITS`` bins a cell and narrows the key's interval to
one bin. Rows never meet in one task; a value that a third of all rows share is cut by its hash.

Cells and their cuts are one row a cell: they are broadcast up to ``BROADCAST_CELLS`` and
joined by shuffle above that, where cells are small and even.

Cases: a null value is below all others; a null weight counts 0. Equal rows differ by their
place in the stored table, so repeated rows can be cut too. With fewer rows than shards
some shards stay empty. An empty table gives no rows. Columns of the input stay, and the
result columns get underscores in front where their names are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import free_name, stored

VALUE_BITS, HASH_BITS, ROW_BITS = 22, 24, 15
KEY_BITS = VALUE_BITS + HASH_BITS + ROW_BITS
BIN_BITS = 10
BROADCAST_CELLS = 50_000
SLOT_BUCKETS = 64


def coordinate(column: Column, kind: T.DataType) -> Column:
    """A number for ordering: strings by their first six bytes, null below everything."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        first = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
        value = F.conv(first, 16, 10).cast("double")
    elif isinstance(kind, (T.DateType, T.TimestampType)):
        value = F.unix_micros(column.cast("timestamp")).cast("double")
    else:
        value = column.cast("double")
    return F.when(value.isNull() | F.isnan(value), F.lit(float("-inf"))).otherwise(value)


def _with_cells(rows: DataFrame, cells: DataFrame, n_cells: int) -> DataFrame:
    return rows.join(F.broadcast(cells) if n_cells <= BROADCAST_CELLS else cells, "cell")


def kd_shards(frame: DataFrame, dimensions: list[str], weight: Column, shards: int | None = None,
              target: int | None = None, identity: list[str] | None = None,
              keep: list[str] | None = None) -> tuple[DataFrame, str, str]:
    """The frame's ``keep`` columns (default: all) with a shard and a slot in it, and those two columns' names.

    Give the number of ``shards`` or the ``target`` weight of one. ``identity`` names the
    columns whose hash orders rows of equal values (default: the dimensions).
    """
    kept = keep if keep is not None else frame.columns
    n = len(dimensions)
    values = F.array(*[coordinate(F.col(f"`{d}`"), frame.schema[d].dataType) for d in dimensions])
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in (identity or dimensions)])
    points = frame.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), values.alias("x"),
                          F.coalesce(weight, F.lit(0)).cast("long").alias("w"),
                          F.pmod(tie, F.lit(1 << HASH_BITS)).alias("tie"),
                          F.monotonically_increasing_id().alias("place"))
    points = stored(points, "points").withColumn("own", F.pmod(F.xxhash64("place"), F.lit(1 << ROW_BITS)))

    def low(i: int) -> Column:  # of values that are there
        return F.min(F.when(F.col("x")[i] > float("-inf"), F.col("x")[i]))

    whole = points.agg(F.sum("w").alias("w"), *[F.struct(low(i), F.max(F.col("x")[i])).alias(f"r{i}")
                                                for i in range(n)]).first()
    ranges = []
    for i in range(n):
        a, b = whole[f"r{i}"]
        a = 0.0 if a is None else a
        # a null lies one step below the least value
        step = max((b - a) / ((1 << VALUE_BITS) - 2), 1e-300) if b is not None and b > a else 1.0
        ranges.append((a, step))
    if shards is None:
        shards = max(1, -(-(whole["w"] or 0) // target))
    scaled = F.array(*[F.when(F.col("x")[i] > float("-inf"), F.floor((F.col("x")[i] - a) / step) + 1)
                       .otherwise(0).cast("long") for i, (a, step) in enumerate(ranges)])
    rows = points.select("row", "place", "w", scaled.alias("x"),
                         (F.col("tie") * (1 << ROW_BITS) + F.col("own")).alias("below"),
                         F.lit(0).cast("long").alias("cell"), F.lit(shards).cast("long").alias("k"))

    # a cell is named by its first shard, so its children are named by theirs
    while True:
        cells = stored(rows.filter("k > 1").groupBy("cell", "k").agg(
            F.sum("w").alias("w"), F.array(*[F.max(F.col("x")[i]) - F.min(F.col("x")[i]) for i in range(n)])
            .alias("spread")), "cells")
        n_cells = cells.count()
        if n_cells == 0:
            break
        widest = (F.array_position("spread", F.array_max("spread")) - 1).cast("int")
        state = cells.select("cell", widest.alias("axis"), F.lit(0).cast("long").alias("from"),
                             F.floor(F.col("w") * F.floor(F.col("k") / 2) / F.col("k")).alias("goal"))
        open_rows = rows.filter("k > 1")
        bits = KEY_BITS
        while bits > 0:
            step = min(BIN_BITS, bits)
            bits -= step
            key = F.element_at("x", F.col("axis") + 1) * (1 << (HASH_BITS + ROW_BITS)) + F.col("below")
            binned = _with_cells(open_rows, state, n_cells).withColumn("bin", F.shiftright(key - F.col("from"), bits)) \
                .filter((key >= F.col("from")) & (F.col("bin") < (1 << step))) \
                .groupBy("cell", "axis", "from", "goal", "bin").agg(F.sum("w").alias("w"))
            order = Window.partitionBy("cell").orderBy("bin")
            sums = binned.withColumn("upto", F.sum("w").over(order))
            # the first bin whose sum passes the goal, with the weight in front of it
            last = F.max("upto").over(Window.partitionBy("cell"))
            hit = sums.withColumn("last", last).filter((F.col("upto") > F.col("goal")) | (F.col("upto") == F.col("last"))) \
                .groupBy("cell", "axis", "from", "goal").agg(F.min(F.struct("bin", "upto", "w")).alias("m"))
            state = stored(hit.select(
                "cell", "axis", (F.col("from") + F.shiftleft("m.bin", bits)).alias("from"),
                (F.col("goal") - (F.col("m.upto") - F.col("m.w"))).alias("goal"), F.col("m.w").alias("at_cut")), "cells") \
                .select("cell", "axis", "from", "goal", "at_cut")
            state, last_state = state.drop("at_cut"), state
        # the row at the cut goes to the nearer side
        cuts = last_state.select("cell", "axis", (F.col("from") + (2 * F.col("goal") >= F.col("at_cut")).cast("long"))
                                 .alias("cut"))
        joined = rows.join(F.broadcast(cuts) if n_cells <= BROADCAST_CELLS else cuts, "cell", "left")
        key = F.element_at("x", F.col("axis") + 1) * (1 << (HASH_BITS + ROW_BITS)) + F.col("below")
        half = F.floor(F.col("k") / 2)
        right = F.col("axis").isNotNull() & (key >= F.col("cut"))
        rows = stored(joined.select(
            "row", "place", "w", "x", "below", F.when(right, F.col("cell") + half).otherwise(F.col("cell")).alias("cell"),
            F.when(F.col("axis").isNull(), F.col("k")).when(right, F.col("k") - half).otherwise(half).alias("k")), "cells")
    shard_name, slot_name = (free_name(frame.select(*[f"`{c}`" for c in kept]), c) for c in ("shard", "slot"))
    return _with_slots(rows).select("row.*", F.col("cell").cast("int").alias(shard_name),
                                    F.col("slot").alias(slot_name)), shard_name, slot_name


def _with_slots(rows: DataFrame) -> DataFrame:
    """Gapless numbers within each cell: ranks in buckets of the rows' places, then the buckets' offsets."""
    buckets = max(SLOT_BUCKETS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(buckets)).cast("int"))
    counted = dealt.groupBy("cell", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("cell", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("cell", "bucket").orderBy("place")
    return dealt.withColumn("slot", F.row_number().over(own) - 1).join(base, ["cell", "bucket"]) \
        .withColumn("slot", F.col("slot") + F.col("base"))
