"""Benchmark decontamination: an FM-index for each shard of documents, searched for the windows of test items.

Words are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z in lower
case. A window is ``width`` consecutive words of an item; a shorter item is one window.
Only the test items' vocabulary gets symbols of its own; all other words separate, and runs
shorter than the shortest window can hold no occurrence, so they stay out of the index.

Test items are broadcast in blocks of about ``BLOCK_BYTES`` of text, of which the driver holds one
at a time; with several blocks the documents pass through one scan after another, each
adding to the spans found so far. A text goes to Python once; what comes back is counts,
spans and the text of documents that lose something.

Cases: a null or empty text has no words and no hits, and stays null or empty. A text of
any length is searched whole, in a shard of its own if it is longer than one. An item
without words has no window; an item without an id still marks its words and is named by
the empty string; repeated items count once. Repeated documents are searched each on its
own. Without documents or items the result has no rows or no hits. Result columns get
underscores in front where the input has columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from gridloom.llm.common import free_name
from gridloom.llm.fm_index import FmIndex
from gridloom.llm.words import NOT_ALNUM, give_back, rows_of, slices, take_ranges, word_hashes, word_spans

WIDTH = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 8 << 20
_HITS = 1 << 20  # occurrences located at once


class Phrases:
    """Distinct windows of test items as symbols, by length, with the items that have each."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        windows: dict[tuple[int, ...], set[int]] = {}
        self.names = sorted({name or "" for name, _ in items})
        place = {n: i for i, n in enumerate(self.names)}
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        for first, last, data, bounds in slices(texts):
            starts, ends = word_spans(data, bounds, NOT_ALNUM)
            hashes = word_hashes(data, starts, ends)
            cut = rows_of(starts, bounds)
            for i in range(last - first):
                words = hashes[cut[i]: cut[i + 1]].tolist()
                for j in range(max(len(words) - width + 1, 1) if words else 0):
                    windows.setdefault(tuple(words[j: j + width]), set()).add(place[items[first + i][0] or ""])
        self.vocabulary = np.unique(np.array([w for k in windows for w in k], np.uint64))
        self.bits = max(int(len(self.vocabulary)).bit_length(), 1)
        self.shortest = min(map(len, windows), default=0)
        self.groups = []  # (symbols, first item position, items of all windows)
        for n in sorted({len(k) for k in windows}):
            same = [(k, sorted(v)) for k, v in windows.items() if len(k) == n]
            symbols = self.symbols(np.array([k for k, _ in same], np.uint64))
            counts = np.array([len(v) for _, v in same], np.int64)
            self.groups.append((symbols, np.cumsum(counts) - counts, counts,
                                np.array([x for _, v in same for x in v], np.int64)))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """1 and up for words of the vocabulary, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(hashes.shape, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def _index(symbols: np.ndarray, cut: np.ndarray, phrases: Phrases) -> tuple[FmIndex | None, np.ndarray]:
    """The index of all runs that can hold a window, and the word of each indexed position."""
    inside = symbols > 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = cut[(cut > 0) & (cut < len(symbols))]
    starts[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    first, length = np.flatnonzero(starts), 0
    length = np.flatnonzero(ends) + 1 - first
    keep = length >= phrases.shortest
    first, length = first[keep], length[keep]
    if not len(first):
        return None, np.zeros(0, np.int64)
    words = take_ranges(first, length + 1)  # the last of each run becomes the separator
    text = symbols[np.minimum(words, len(symbols) - 1)]
    text[np.cumsum(length + 1) - 1] = 0
    return FmIndex(text, phrases.bits), words


def find(symbols: np.ndarray, cut: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Which words lie in an occurrence, and the distinct ``row * items + item`` of all occurrences."""
    covered = np.zeros(len(symbols) + 1, np.int64)
    index, words = _index(symbols, cut, phrases) if len(symbols) and phrases.shortest else (None, None)
    pairs = np.zeros(0, np.int64)
    if index is None:
        return covered[:-1] > 0, pairs
    for patterns, first, counts, items in phrases.groups:
        low, high = index.search(patterns)
        hit = np.flatnonzero(high > low)
        while len(hit):  # a run of windows with a bounded number of occurrences, at least a part of one
            sizes = high[hit] - low[hit]
            n = max(int(np.searchsorted(np.cumsum(sizes), _HITS, side="right")), 1)
            now, sizes = hit[:n], np.minimum(sizes[:n], _HITS)
            rows = take_ranges(low[now], sizes)
            which = np.repeat(now, sizes)
            at = words[index.locate(rows)]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + patterns.shape[1], -1)
            row = np.searchsorted(cut, at, side="right") - 1
            named = np.repeat(row * len(phrases.names), counts[which]) + items[take_ranges(first[which], counts[which])]
            pairs = np.union1d(pairs, named)
            low[now] += sizes
            hit = np.concatenate([now[low[now] < high[now]], hit[n:]])
    return np.cumsum(covered[:-1]) > 0, pairs


def _ranges(mask: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end word of each run of marked words within a row."""
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    edge = cut[(cut > 0) & (cut < len(mask))]
    first[edge] = mask[edge]
    last[edge - 1] = mask[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _scan(phrases: Phrases, texts: pa.Array, before: pa.Array | None, last: bool,
          keep_text: bool) -> Iterator[pa.StructArray]:
    """What each row has, a slice at a time; ``before``: word ranges and items so far."""
    kind = _found(last, keep_text)
    for begin, end, data, bounds in slices(texts, SHARD_BYTES):
        starts, ends = word_spans(data, bounds, NOT_ALNUM)
        cut = rows_of(starts, bounds)
        mask, pairs = find(phrases.symbols(word_hashes(data, starts, ends)), cut, phrases)
        items: list[set[str]] = [set() for _ in range(end - begin)]
        for p in pairs.tolist():
            items[p // len(phrases.names)].add(phrases.names[p % len(phrases.names)])
        if before is not None:
            for i, seen in enumerate(before.slice(begin, end - begin).to_pylist()):
                items[i] |= set(seen["items"])
                for a, b in zip(seen["ranges"][::2], seen["ranges"][1::2]):
                    mask[cut[i] + a: cut[i] + b] = True
        first, final = _ranges(mask, cut)
        own = np.searchsorted(first, cut)
        out: dict[str, list | np.ndarray] = {f.name: [] for f in kind}
        out["n_words"] = np.diff(cut)
        out["n_hit"] = np.diff(np.concatenate([[0], np.cumsum(mask)])[cut])
        for i in range(end - begin):
            a, b = first[own[i]: own[i + 1]], final[own[i]: own[i + 1]]
            spans = [(int(starts[x] - bounds[i]), int(ends[y - 1] - bounds[i])) for x, y in zip(a, b)]
            out["items"].append(sorted(items[i]))
            if not last:
                out["ranges"].append(np.stack([a - cut[i], b - cut[i]], 1).ravel().tolist())
                continue
            out["spans"].append([{"start": s, "end": e} for s, e in spans])
            if keep_text:
                raw = data[bounds[i]: bounds[i + 1]].tobytes() if spans else b""
                edges = [0, *[e for s in spans for e in s], len(raw)]
                out["cleaned"].append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])).decode()
                                      if spans else None)
        yield pa.StructArray.from_arrays([pa.array(out[f.name], f.type) for f in kind], fields=list(kind))


def _found(last: bool, keep_text: bool) -> pa.DataType:
    """What a scan returns: byte spans and the text of rows with hits from the last, word ranges from others."""
    fields = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))]
    if not last:
        return pa.struct([*fields, ("ranges", pa.list_(pa.int64()))])
    fields.append(("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
    return pa.struct([*fields, *([("cleaned", pa.string())] if keep_text else [])])


def _scanner(held: Broadcast, carried: bool, last: bool, keep_text: bool):
    """The scan for the phrases of one block, as a function of the text and of what the scan before found."""
    kind = from_arrow_type(_found(last, keep_text))
    if carried:
        @F.arrow_udf(kind)
        def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for texts, before in batches:
                yield from _scan(held.value, texts, before, last, keep_text)
                give_back()
    else:
        @F.arrow_udf(kind)
        def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield from _scan(held.value, texts, None, last, keep_text)
                give_back()
    return scan


def _blocks(items: DataFrame, item: str, text: str) -> tuple[int, DataFrame]:
    """The number of blocks of about ``BLOCK_BYTES`` of text, and the test items with their block."""
    rows = items.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = total // BLOCK_BYTES + 1
    return n, rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", width: int = WIDTH, keep_text: bool = True,
                  out: str = "found") -> tuple[DataFrame, str]:
    """The documents with a struct of ``n_words, n_hit, items, spans, cleaned``; and that column's name.

    ``spans`` are the merged byte ranges to remove and ``cleaned`` is the text without them.
    With ``keep_text=False`` neither the text nor ``cleaned`` is carried on.
    """
    out = free_name(docs, out)
    frame, found = docs, None
    n, rows = _blocks(items, item, item_text)
    for number in range(n):
        block = [(r["item"], r["text"]) for r in rows.filter(F.col("block") == number).collect()]
        held = docs.sparkSession.sparkContext.broadcast(Phrases(block, width))
        scan = _scanner(held, number > 0, number == n - 1, keep_text)
        name = free_name(frame, f"scan_{number}")
        frame = frame.withColumn(name, scan(F.col(f"`{text}`"), *([F.col(found)] if found else [])))
        found = name
    fields = [F.col(found)[f] for f in ("n_words", "n_hit", "items", "spans")]
    if keep_text:
        fields.append(F.coalesce(F.col(found)["cleaned"], F.col(f"`{text}`")).alias("cleaned"))
    kept = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != text]
    return frame.select(*kept, F.struct(*fields).alias(out)), out
