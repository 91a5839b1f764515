"""Suffix-array dedup: bytes of strings of ``width`` bytes that also start earlier in the collection are removed.

The order of the collection is ascending document id, then place. Texts are cut into
content-defined pieces (``minimizers``): equal windows lie in pieces of one key. Pieces of
equal bytes are one member of the collection, first met at the least ``(document, place)``;
its later occurrences are repeated as a whole. Keys with several members are cut into runs
of fewer windows, keyed by the bytes that all windows of a run share. Runs of one key go to
collections of bounded size whose Burrows-Wheeler transform and common prefixes are built
column by column (``column_bwt``): entries with ``width`` symbols in common are equal windows,
all but the earliest are repeated. A key with more than ``LIMIT`` members is cut again, down
to one window a run, where equal pieces are all there is; so no key fills a task, and no
window is left out.

Cases: a null text is empty; it and texts shorter than ``width`` lose nothing. A text of any
length is cut in turns of a million windows. Of repeated rows, and of equal texts, the first
by id stays; rows of one id are ordered by a hash of their text, equal rows in any order (it
does not change the result), and rows without an id come first. An empty table gives an
empty table. Other columns are carried on whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.column_bwt import transform
from gridloom.llm.common import BROADCAST_IDS, free_name, stored
from gridloom.llm.minimizers import pieces
from gridloom.llm.words import mix, slices, take_ranges, word_hashes

WIDTH, GRAM = 100, 24
LIMIT = 4096      # members of one key that a collection takes; beyond it the key is cut
COLLECTION = 4096  # members after which a collection ends at the next key
STEPS = (26, 8, 1)  # windows in a run: of every key with several members, and of one that is cut again
SLICE = 1 << 20
_SAME = np.arange(256, dtype=np.uint8)
_MARK = "key long, piece long, g long, first int, n int"


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                                      names=[n.split()[0] for n in names.split(", ")])


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``g, text, row``: a number for each row that ascends with the id; the id itself where all ids differ."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("g"), F.col(f"`{text}`").alias("text"), row.alias("row"))
    if rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR g IS NULL").isEmpty():
        return rows
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("g", "tie") \
        .sortWithinPartitions("g", "tie").select("g", "text", "row")

    def number(batches):
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = np.arange(seen, seen + batch.num_rows, dtype=np.int64) + (part << 40)
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(place), *batch.columns[1:]], names=batch.schema.names)

    return stored(dealt.mapInArrow(number, rows.schema), "collection")


def _marks(texts: pa.Array, ids: np.ndarray, width: int, gram: int):
    """``key, piece, g, first, n`` of a slice's pieces once a text, and ``key, 0, g, start, -bytes`` of repeats in it."""
    for begin, end, data, bounds in slices(texts, SLICE):
        found = pieces(data, bounds, width, gram)
        if not len(found.first):
            continue
        row = np.searchsorted(bounds, found.first, side="right") - 1
        piece = found.hashes(data, width)
        order = np.lexsort((found.first, piece, found.key, row))
        again = np.zeros(len(order), bool)
        a, b = order[:-1], order[1:]
        again[b[(row[a] == row[b]) & (found.key[a] == found.key[b]) & (piece[a] == piece[b])]] = True
        once, more = np.flatnonzero(~again), np.flatnonzero(again)
        start, stop = found.first[more], found.first[more] + found.n[more] + width - 1
        opens = np.ones(len(more), bool)
        opens[1:] = (row[more][1:] != row[more][:-1]) | (start[1:] > stop[:-1])
        closes = np.append(opens[1:], True) if len(more) else opens
        lead = more[opens]
        g = ids[begin + row]
        place = found.first - bounds[row]
        yield (np.concatenate([found.key[once], found.key[lead]]).view(np.int64),
               np.concatenate([piece[once].view(np.int64), np.zeros(len(lead), np.int64)]),
               np.concatenate([g[once], g[lead]]),
               np.concatenate([place[once], place[lead]]).astype(np.int32),
               np.concatenate([found.n[once], start[opens] - stop[closes]]).astype(np.int32))


def _keys(texts: DataFrame, width: int, gram: int) -> DataFrame:
    def count(batches):
        for batch in batches:
            for key, _, _, _, n in _marks(batch.column(1), batch.column(0).to_numpy(), width, gram):
                names, counts = np.unique(key[n > 0], return_counts=True)
                yield _batch("key long, n long", names, counts.astype(np.int64))
    return texts.mapInArrow(count, "key long, n long")


def _places(texts: DataFrame, width: int, gram: int) -> DataFrame:
    def mark(batches):
        for batch in batches:
            for columns in _marks(batch.column(1), batch.column(0).to_numpy(), width, gram):
                yield _batch(_MARK, *columns)
    return texts.mapInArrow(mark, _MARK)


def _with_lists(texts: DataFrame, lists: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Texts with their lists, and the texts that have none; up to a million lists only texts that have one move."""
    if lists.limit(BROADCAST_IDS + 1).count() > BROADCAST_IDS:
        return texts.join(lists, "g", "left"), None
    ids = F.broadcast(lists.select("g"))
    return texts.join(ids, "g", "left_semi").join(lists, "g"), texts.join(ids, "g", "left_anti")


def _lists(data: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and flat fields of a list of structs."""
    offsets = data.offsets.to_numpy()
    flat = data.values
    return offsets, {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}


def _cut(batch: pa.RecordBatch, width: int):
    """Bytes of the listed pieces of a batch ``g, text, list``: data, starts, and their fields."""
    offsets, fields = _lists(batch.column(2))
    for begin, end, data, bounds in slices(batch.column(1), SLICE):
        low, high = offsets[begin], offsets[end]
        own = np.repeat(np.arange(end - begin), np.diff(offsets[begin: end + 1]))
        starts = bounds[own] + fields["first"][low:high]
        yield data, starts, {k: v[low:high] for k, v in fields.items()} | \
            {"g": batch.column(0).to_numpy()[begin + own]}


def _fetch(texts: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """Members of keys with their bytes: ``key, g, first, bytes``."""
    lists = stored(members.groupBy("g").agg(F.collect_list(F.struct("key", "first", "n")).alias("list")), "members")
    held, _ = _with_lists(texts.select("g", "text"), lists)

    def cut(batches):
        for batch in batches:
            for data, starts, f in _cut(batch, width):
                size = f["n"].astype(np.int64) + width - 1
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
                body = data[take_ranges(starts, size)]
                bytes_ = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
                yield _batch("key, g, first, bytes", f["key"], f["g"], f["first"], bytes_.cast(pa.binary()))
    return held.filter("list IS NOT NULL").select("g", "text", "list") \
        .mapInArrow(cut, "key long, g long, first int, bytes binary")


def _runs(data, starts, f, width: int, gram: int, step: int):
    """Pieces cut into runs of ``step`` windows by their place before the gram, keyed by the bytes a run shares."""
    n = f["n"].astype(np.int64)
    size = n + width - 1
    bounds = np.concatenate([[0], np.cumsum(size)])
    body = data[take_ranges(starts, size)]
    whole = pieces(body, bounds, width, gram)  # one a member again
    own = np.searchsorted(bounds, whole.first, side="right") - 1
    ahead = whole.gram - whole.first  # windows between the piece's first and the one at the gram
    # a piece that began as one run may lie anywhere: windows are numbered by their distance from the gram
    low, high = (ahead - whole.n + 1) // step, ahead // step
    part = take_ranges(low, high - low + 1)
    of = np.repeat(np.arange(len(own)), high - low + 1)
    first = np.maximum(ahead[of] - part * step - step + 1, 0)
    last = np.minimum(ahead[of] - part * step, whole.n[of] - 1)
    base = whole.first[of]
    shared = base + ahead[of] - part * step
    order = np.argsort(base + first, kind="stable")
    of, part, first, last, base, shared = (x[order] for x in (of, part, first, last, base, shared))
    piece = word_hashes(body, base + first, base + last + width, _SAME)
    by_core = np.argsort(shared, kind="stable")
    core = np.empty(len(of), np.uint64)
    core[by_core] = word_hashes(body, shared[by_core], shared[by_core] + width - step + 1, _SAME)
    key = mix(mix(core ^ f["key"].view(np.uint64)[own[of]]) + part.astype(np.uint64))
    at = f["first"][own[of]] + (base + first - bounds[own[of]])
    return (key.view(np.int64), piece.view(np.int64), f["g"][own[of]], at.astype(np.int32),
            (last - first + 1).astype(np.int32))


def _refined(texts: DataFrame, members: DataFrame, width: int, gram: int, step: int) -> DataFrame:
    lists = stored(members.groupBy("g").agg(F.collect_list(F.struct("key", "first", "n")).alias("list")), "members")
    held, _ = _with_lists(texts.select("g", "text"), lists)

    def cut(batches):
        for batch in batches:
            for data, starts, f in _cut(batch, width):
                if len(starts):
                    yield _batch(_MARK, *_runs(data, starts, f, width, gram, step))
    return held.filter("list IS NOT NULL").select("g", "text", "list").mapInArrow(cut, _MARK)


def repeated_windows(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, g: np.ndarray, first: np.ndarray,
                     width: int) -> tuple[np.ndarray, np.ndarray]:
    """Member and place of the windows of a collection that an earlier window equals, by member and place."""
    made = transform(data, starts, sizes)
    new = made.prefix < width  # an entry that no longer string joins with the one before
    joined = np.flatnonzero(~new)
    touched = np.zeros(len(new), bool)
    touched[joined] = True
    touched[joined - 1] = True
    at = np.flatnonzero(touched)
    member = made.text[at]
    place = first[member] + (sizes[member] - made.length[at])
    group = np.cumsum(new)[at]
    order = np.lexsort((place, g[member], group))
    later = order[1:][group[order[1:]] == group[order[:-1]]]
    later = later[np.lexsort((place[later], member[later]))]
    return member[later], place[later]


def _spans(batches, width: int):
    """Spans of repeated windows; batches are sorted by key, collections end between keys."""
    held: list[pa.RecordBatch] = []

    def collection(rows: pa.Table):
        body = rows.column("bytes").combine_chunks().cast(pa.large_binary())
        body = body.chunk(0) if isinstance(body, pa.ChunkedArray) else body
        offsets = np.frombuffer(body.buffers()[1], np.int64)[body.offset: body.offset + len(body) + 1]
        data = np.frombuffer(body.buffers()[2], np.uint8)
        g, first = (rows.column(c).to_numpy() for c in ("g", "first"))
        member, place = repeated_windows(data, offsets[:-1], np.diff(offsets), g, first.astype(np.int64), width)
        opens = np.ones(len(member), bool)
        opens[1:] = (member[1:] != member[:-1]) | (place[1:] > place[:-1] + 1)
        closes = np.append(opens[1:], True) if len(member) else opens
        return _batch("g, start, end", g[member[opens]], place[opens].astype(np.int64),
                      (place[closes] + width).astype(np.int64))

    def complete(last: bool):
        nonlocal held
        rows = pa.Table.from_batches(held)
        keys = rows.column("key").to_numpy()
        ends = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)] if last else [])
        begin = 0
        while True:
            at = np.searchsorted(ends, begin + COLLECTION)
            if at == len(ends):
                at -= 1
                if not last:
                    break
            if at < 0 or ends[at] <= begin:
                break
            stop = int(ends[at])
            yield collection(rows.slice(begin, stop - begin))
            begin = stop
        held = rows.slice(begin).to_batches()

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) > COLLECTION + LIMIT:
            yield from complete(False)
    if held:
        yield from complete(True)


def _compare(places: DataFrame, texts: DataFrame, width: int, gram: int, level: int = 0) -> list[DataFrame]:
    """Spans of all repeated windows among pieces ``key, piece, g, first, n``."""
    firsts = stored(places.groupBy("key", "piece").agg(
        F.min(F.struct("g", "first", "n")).alias("at"), F.count(F.lit(1)).alias("copies")), "pieces")
    copied = firsts.filter("copies > 1").select("key", "piece", F.col("at.g").alias("g0"),
                                                F.col("at.first").alias("first0"))
    found = [stored(places.join(copied, ["key", "piece"]).filter("g <> g0 OR first <> first0").select(
        "g", F.col("first").cast("long").alias("start"),
        (F.col("first") + F.col("n") + (width - 1)).cast("long").alias("end")), "spans")]
    sizes = stored(firsts.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "keys")
    members = stored(firsts.join(sizes, "key").select("key", "at.*", "size"), "members")
    limit = LIMIT if level else 1  # the keys of whole pieces are short: their windows share a gram only
    few = members.filter(F.col("size") <= limit)
    n = few.count()
    if n:
        compared = _fetch(texts, few, width).repartition(n // (8 * COLLECTION) + 1, "key").sortWithinPartitions("key")
        found.append(stored(compared.mapInArrow(lambda batches: _spans(batches, width),
                                                "g long, start long, end long"), "spans"))
    many = members.filter(F.col("size") > limit)
    if not many.isEmpty():
        cut = stored(_refined(texts, many, width, gram, STEPS[level]), "runs")
        found += _compare(cut, texts, width, gram, level + 1)
    return found


def repeated_spans(texts: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``g, spans``: unmerged byte spans of ``g, text`` that repeat earlier strings; texts without any have no row."""
    often = stored(_keys(texts, width, gram).groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
                   .select("key", F.lit(True).alias("often")), "keys")
    # repeats inside a text (n below 0) pass, whatever their key
    places = stored(_places(texts, width, gram).join(often, "key", "left").filter("often OR n < 0").drop("often"),
                    "places")
    spans = places.filter("n < 0").select("g", F.col("first").cast("long").alias("start"),
                                          (F.col("first") - F.col("n")).cast("long").alias("end"))
    for more in _compare(places.filter("n > 0"), texts, width, gram):
        spans = spans.unionByName(more)
    return stored(spans.groupBy("g").agg(F.collect_list(F.struct("start", "end")).alias("list")), "spans")


_SPAN = T.ArrayType(T.StructType().add("start", "long").add("end", "long"))
RESULT = (T.StructType().add("n_bytes", "long").add("n_removed", "long").add("spans", _SPAN)
          .add("kept", "binary"))


def _removed(batches):
    for batch in batches:
        offsets, fields = _lists(batch.column(2))
        texts, out = batch.column(1), []
        for i in range(batch.num_rows):
            a, b = offsets[i], offsets[i + 1]
            order = np.argsort(fields["start"][a:b], kind="stable")
            start = fields["start"][a:b][order]
            reach = np.maximum.accumulate(fields["end"][a:b][order])
            opens = np.ones(len(start), bool)
            opens[1:] = start[1:] > reach[:-1]
            start, stop = start[opens].tolist(), reach[np.append(opens[1:], True)].tolist()
            raw = texts[i].as_buffer()
            edges = [0, *[e for s in zip(start, stop) for e in s], raw.size]
            kept = b"".join(raw[x:y].to_pybytes() for x, y in zip(edges[::2], edges[1::2]))
            out.append({"n_bytes": raw.size, "n_removed": raw.size - len(kept), "kept": kept,
                        "spans": [{"start": s, "end": e} for s, e in zip(start, stop)]})
            if sum(len(o["kept"]) for o in out) > SLICE or i + 1 == batch.num_rows:
                held = batch.slice(i + 1 - len(out), len(out))
                kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                                  ("kept", pa.binary())])
                yield pa.RecordBatch.from_arrays([held.column(0), pa.array(out, kind)], names=["row", "found"])
                out = []


def drop_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, gram: int = GRAM,
                 out: str = "repeats") -> tuple[DataFrame, str]:
    """The documents, without their text, with a struct ``n_bytes, n_removed, spans, kept``; and that column's name.

    ``spans`` are the maximal removed byte runs, ``kept`` the remaining bytes (a removed run
    may end inside a character, so they are bytes and not a string).
    """
    out = free_name(docs, out)
    rows = numbered(docs, doc_id, text)
    texts = rows.select("g", F.coalesce("text", F.lit("")).alias("text"))
    lists = repeated_spans(texts, width, gram)
    hit, clean = _with_lists(rows, lists)
    schema = T.StructType().add("row", rows.schema["row"].dataType).add("found", RESULT)
    body = F.coalesce("text", F.lit("")).cast("binary")
    whole = F.struct(F.octet_length(body).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                     F.array().cast(_SPAN).alias("spans"), body.alias("kept"))
    if clean is None:
        hit, clean = hit.filter("list IS NOT NULL"), hit.filter("list IS NULL")
    cut = hit.select("row", "text", "list").mapInArrow(_removed, schema)
    made = cut.unionByName(clean.select("row", whole.alias("found")))
    return made.select("row.*", F.col("found").alias(out)), out
