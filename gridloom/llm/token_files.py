"""Token-id files: whole texts as ids, Simple-8b coded, in ascending document order.

The file format is a Parquet table of segments. A segment holds whole documents of one
partition, at least ``SEGMENT`` ids unless it is the partition's last: ``part`` and
``first`` (ids of the partition before it) place it, ``doc_ids`` and ``sizes`` are its
index, ``words``, ``blocks`` and ``escapes`` its code, little-endian.

Cases: a null text is empty, so its document is the end id alone. A text of any length is
encoded whole and stays in one segment. Rows without a document
id come first. Rows of one id are ordered by a hash of their text; equal rows are
documents of their own. An empty table gives files without segments. Columns beside id
and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm.common import TEXT_ROWS, setting
from gridloom.llm.simple8b import Packed, pack, unpack
from gridloom.llm.tokens import encoder
from gridloom.llm.words import give_back

SEGMENT = 1 << 18
_FORMAT = ("part int, seq int, first bigint, n_ids bigint, doc_ids array<bigint>, sizes array<bigint>, "
           "words binary, blocks binary, escapes binary")


def _segment(part: int, seq: int, first: int, docs: list, sizes: list, ids: list) -> pa.RecordBatch:
    packed = pack(np.concatenate(ids))
    values = [part, seq, first, packed.n, docs, sizes, packed.words.astype("<u8").tobytes(),
              packed.blocks.astype("<i4").tobytes(), packed.escapes.astype("<u8").tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
             pa.binary(), pa.binary(), pa.binary()]
    names = ["part", "seq", "first", "n_ids", "doc_ids", "sizes", "words", "blocks", "escapes"]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int, doc_id: str = "doc_id",
              text: str = "text", partitions: int | None = None) -> None:
    """Encode all texts and write the segments below ``path``, a folder that all executors reach."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")) \
        .withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange(*([partitions] if partitions else []), "doc_id", "tie") \
        .sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def code(batches):
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        names: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        for batch in batches:
            for begin, last, ids, cut in encoder(tokenizer).encode(batch.column(1), end):
                docs_here = batch.column(0).slice(begin, last - begin).to_pylist()
                lengths = np.diff(cut)
                row = 0
                while row < len(docs_here):
                    total = sum(map(len, held))
                    # documents up to the segment's size, at least one
                    stop = int(np.searchsorted(cut, cut[row] + max(SEGMENT - total, 1), side="left"))
                    stop = min(max(stop, row + 1), len(docs_here))
                    names += docs_here[row:stop]
                    sizes += lengths[row:stop].tolist()
                    held.append(ids[cut[row]: cut[stop]])
                    row = stop
                    if sum(map(len, held)) >= SEGMENT:
                        yield _segment(part, seq, first, names, sizes, held)
                        first, seq = first + sum(sizes), seq + 1
                        names, sizes, held = [], [], []
            give_back()
        if names:
            yield _segment(part, seq, first, names, sizes, held)

    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS):
        dealt.mapInArrow(code, _FORMAT).write.parquet(path)


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens`` and ``ids``, or with ``digest`` ``ids_crc32`` (of 32-bit ids), from the files."""
    segments = spark.read.schema(_FORMAT).parquet(path)
    # one row a partition of the writer
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = segments.join(F.broadcast(base), "part").withColumn("first", F.col("first") + F.col("base")) \
        .select("first", "n_ids", "doc_ids", "sizes", "words", "blocks", "escapes")

    def decode(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                first, n, words, blocks, escapes = (batch.column(c)[i].as_py() for c in (0, 1, 4, 5, 6))
                sizes = batch.column(3)[i].values.to_numpy()
                ids = unpack(Packed(n, np.frombuffer(words, "<u8"), np.frombuffer(blocks, "<i4"),
                                    np.frombuffer(escapes, "<u8")))
                cut = np.concatenate([[0], np.cumsum(sizes)])
                columns = [batch.column(2)[i].values, pa.array(first + cut[:-1], pa.int64()),
                           pa.array(sizes, pa.int64())]
                if digest:
                    small = ids.astype("<u4")
                    crc = [zlib.crc32(small[a:b].data) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    columns.append(pa.array(crc, pa.int64()))
                else:
                    columns.append(pa.ListArray.from_arrays(pa.array(cut, pa.int32()),
                                                            pa.array(ids.view(np.int64), pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    last = "ids_crc32 bigint" if digest else "ids array<bigint>"
    return placed.mapInArrow(decode, f"doc_id bigint, start bigint, n_tokens bigint, {last}")
