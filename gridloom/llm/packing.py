"""Documents as token pieces, and pieces placed in sequences of bounded length.

A document is the ids of its text and an end id. One longer than ``capacity`` is cut into
pieces of ``capacity`` ids of which the first may be shorter; all others are one piece.
The table of lengths (at most ``capacity`` rows) goes through the driver to
:func:`gridloom.llm.bin_completion.pack_lengths`; pieces are ranked within their length in
buckets, so that a length with a third of all pieces is many small windows, and each finds
its sequence and offset by a join with the slots of its length, a table bounded by the
capacity.

Cases: a null or empty text is a piece of the end id alone. A text of any length is encoded
whole and cut by its ids. Rows without a document id, and
rows that repeat one, are documents of their own (they only share the id). An empty
table gives no pieces. Columns beside id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.bin_completion import NODES, pack_lengths
from gridloom.llm.common import stored
from gridloom.llm.tokens import encoder
from gridloom.llm.words import give_back, take_ranges

CAPACITY = 1024
BUCKETS = 64


def cut_documents(cut: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``document, piece, start, length`` of all pieces of documents ``cut[i] .. cut[i + 1]``."""
    size = np.diff(cut)
    n = np.maximum(-(-size // capacity), 1)
    doc = np.repeat(np.arange(len(size)), n)
    piece = take_ranges(np.zeros(len(size), np.int64), n)
    head = (size - (n - 1) * capacity)[doc]  # the first piece takes what is left over
    start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
    return doc, piece, start, np.where(piece == 0, head, capacity)


def token_pieces(docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, doc_id: str = "doc_id",
                 text: str = "text", with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of every piece."""
    def scan(batches):
        for batch in batches:
            for first, last, ids, cut in encoder(tokenizer).encode(batch.column(1), end):
                doc, piece, start, length = cut_documents(cut, capacity)
                at = cut[doc] + start
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b].data) for a, b in zip(at.tolist(), (at + length).tolist())]
                columns = [batch.column(0).slice(first, last - first).take(pa.array(doc)),
                           pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:  # the pieces of a slice are its ids in order
                    edges = np.append(at, len(ids)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
            give_back()

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    more = ", ids array<int>" if with_ids else ""
    return rows.mapInArrow(scan, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + more)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``length, first rank, end rank, first sequence, offset`` for each place in each pattern."""
    out, used, sequence = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rank = used.get(length, 0)
            out.append((length, rank, rank + times, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    return out


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES,
                buckets: int = BUCKETS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``pieces`` is read more than once, so pass a stored table."""
    spark = pieces.sparkSession
    buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counted = stored(dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "lengths")
    totals = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    places = slots(pack_lengths({r["length"]: r["n"] for r in totals}, capacity, nodes))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(own) - 1).join(base, ["length", "bucket"]) \
        .withColumn("rank", F.col("rank") + F.col("base"))
    table = spark.createDataFrame(places, "length bigint, low bigint, high bigint, first bigint, offset bigint")
    held = (ranked["length"] == table["length"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    # slots: a pattern takes the rest of at least one length, so there are few patterns
    return ranked.join(F.broadcast(table), held).select(
        *[ranked[c] for c in pieces.columns], (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"),
        "offset")
