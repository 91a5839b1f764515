"""Brown class-based bigram model: classes by exchange, class transitions times word emissions.

Training counts every word of every training text (A-Z in lower case, words between white
space, one end a text). Every word of the vocabulary has its class by exchange:

* The ``SYMBOLS`` most frequent words, and a shape for every other word, are clustered one
  after another. This is the start: each other word has the class of its shape.
* Then rounds over the whole vocabulary. The contexts of all other words are a table in Spark,
  one row a word. In a round each word moves in a task to the class that suits its contexts
  best under the table of class bigrams, and the symbols move one after another against
  the classes of all words. The rounds end when the likelihood of the class bigrams no
  longer rises by ``LEAST_RISE`` of itself; the best classes are kept.

Counts and classes of at most ``FREQUENT`` frequent words go to all tasks, those of all
further words stay in tables that contexts and texts reach by a join on their rarer words
only. That split changes where a count or class is read, not the score. A word that training
has not seen has the class that suits the contexts of the words of its shape best.

P(word | previous) = P(class | previous class) * P(word | class), with Witten-Bell
interpolation of the transitions and 0.1 added to all counts of emissions, for known and
unknown words.

Cases: a null or empty text is its end alone. A row without id is never trained on. Repeated
rows count as often as they come. An empty table gives no rows, and without training rows
every count is zero. Only id and text are read.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import TEXT_ROWS, setting, stored, stored_by_texts
from gridloom.llm.exchange import exchange, information
from gridloom.llm.words import IS_SPACE, LOWER, give_back, mix, rows_of, slices, word_hashes, word_spans

SYMBOLS, FREQUENT, CLASSES = 1000, 1 << 19, 64
ADDED = 0.1
ROUNDS, LEAST_RISE = 12, 1e-3  # rounds over the vocabulary: a bound that runs seldom reach
_KEY_BITS, _CONTEXT_BITS, _VECTOR_BITS = 21, 10, 19  # places among the frequent words have 20 bits
_EXACT = 1 << 16  # log ratios are whole parts of 1 / _EXACT: their sums do not depend on the order
SHAPES = 32
END = int(mix(np.array([0xE0D], np.uint64)).view(np.int64)[0])
_SLICE_BYTES = 1 << 20  # text whose words a task holds at once
_WINDOW = 1 << 16
_FLUSH = 1 << 21
_SENT = 1 << 18  # entries of a batch that a task sends at once, but for those of one word
_MARKS = np.full(256, 6, np.int64)  # of a word's last byte: a letter, a comma, a full stop, another
_MARKS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 256)]] = 0
_MARKS[[ord(","), ord(".")]] = 2, 4
_LENGTHS = np.minimum(np.maximum(np.arange(11) - 1, 0) // 3, 3) * 8
_STEPS = 8  # count bands to a doubling
_SCANNED = 6  # places looked at one after another before a search


def _tokens(texts: pa.Array):
    """``hashes, shapes, offsets`` of slices of rows; each text's last token is its end."""
    for first, last, data, bounds in slices(texts, _SLICE_BYTES):
        starts, ends = word_spans(data, bounds, IS_SPACE)
        cut = rows_of(starts, bounds)
        beyond = np.zeros(len(data) + 1, np.int32)
        np.cumsum(data >= 0x80, out=beyond[1:])
        final = data[ends - 1] if len(ends) else data[:0]
        shape = _LENGTHS[np.minimum(ends - starts, len(_LENGTHS) - 1)] + _MARKS[final] + (beyond[ends] > beyond[starts])
        hashes = np.insert(word_hashes(data, starts, ends, window=_WINDOW).view(np.int64), cut[1:], END)
        yield first, last, hashes, np.insert(shape, cut[1:], SHAPES), cut + np.arange(len(cut))


def _distinct(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words, in any order, and the place of each word among them: by a hash table, without sorting."""
    coded = pa.array(words).dictionary_encode()
    return np.asarray(coded.dictionary), np.asarray(coded.indices)


class _Sums:
    """Sums of counts by code: codes are held until there are as many as sums, which a small batch would not be worth."""

    def __init__(self, size: int):
        self.sums, self.held, self.n = np.zeros(size, np.int64), [], 0

    def add(self, code: np.ndarray, n: np.ndarray | None = None) -> None:
        self.held.append((code, np.ones(len(code), np.int64) if n is None else n))
        self.n += len(code)
        if self.n > len(self.sums):
            self.flush()

    def flush(self) -> None:
        if self.held:
            code, n = (np.concatenate(x) for x in zip(*self.held))
            self.sums += np.bincount(code, n, len(self.sums)).astype(np.int64)
            self.held, self.n = [], 0

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.flush()
        code = np.flatnonzero(self.sums)
        for i in range(0, len(code), _SENT):
            part = code[i: i + _SENT]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(self.sums[part])], names=["pair", "n"])


def _summed(code: np.ndarray, n: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in ascending order and the sums of their counts, which have at most ``bits`` bits."""
    packed = np.sort(code << bits | n)
    code = packed >> bits
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
    sums = np.add.reduceat(packed & ((1 << bits) - 1), first) if len(first) else first
    return code[first], sums


def _count_words(rows: DataFrame) -> DataFrame:
    """``word, n, shape`` summed as far as a task sees."""
    def scan(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def summed():
            words, shapes, counts = (np.concatenate(x) for x in zip(*held))
            unique, which = _distinct(words)
            own = np.empty(len(unique), np.int64)
            own[which] = shapes
            return unique, own, np.bincount(which, counts, len(unique)).astype(np.int64)

        def out():
            words, shapes, counts = summed()
            held.clear()
            for i in range(0, len(words), _SENT):
                part = slice(i, i + _SENT)
                yield pa.RecordBatch.from_arrays([pa.array(words[part]), pa.array(counts[part]), pa.array(shapes[part])],
                                                 names=["word", "n", "shape"])

        for batch in batches:
            for _, _, words, shapes, _ in _tokens(batch.column(0)):
                unique, which = _distinct(words)
                own = np.empty(len(unique), np.int64)
                own[which] = shapes  # equal words have one shape
                held.append((unique, own, np.bincount(which, minlength=len(unique))))
                if sum(len(h[0]) for h in held) > _FLUSH:
                    held[:] = [summed()]
                    if len(held[0][0]) > _FLUSH // 2:
                        yield from out()
                    give_back()
        if held:
            yield from out()
        give_back()

    return rows.select("text").mapInArrow(scan, "word bigint, n bigint, shape bigint")


def _least_count(bands: list[tuple[int, int]], most: int) -> int:
    """The least band whose words, with all of higher bands, are at most ``most``."""
    total, least = 0, 1 << 20
    for band, n in sorted(bands, reverse=True):
        total += n
        if total > most:
            break
        least = band
    return least


def _band() -> Column:
    return F.floor(F.log2("n") * _STEPS).cast("int")


class Tables:
    """What every task holds: frequent words with counts, symbols, classes and their probabilities.

    Codes of the contexts: the symbols, a code for the other words of each class, the end.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, n_symbols: int):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        place = np.full(len(words), -1, np.int64)
        place[:n_symbols] = np.arange(n_symbols)
        self.symbol = place[order]  # -1: no symbol
        self.ending = self.words == END
        self.symbol[self.ending] = -1
        self.other = (self.symbol < 0) & ~self.ending
        self.n_symbols = n_symbols
        self.end = n_symbols + CLASSES
        # the place of the first word with the same upper bits: words are hashes, so it is at the word or a few before it
        bits = max(len(words).bit_length(), 1)
        self.shift, self.half = 64 - bits, 1 << (bits - 1)
        self.first = np.zeros(2 * self.half, np.int32)
        np.cumsum(np.bincount((self.words >> self.shift) + self.half, minlength=2 * self.half)[:-1], out=self.first[1:])
        np.minimum(self.first, max(len(words) - 1, 0), out=self.first)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word among the frequent ones, and whether it is one."""
        if not len(self.words):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = self.first[(words >> self.shift) + self.half].astype(np.int64)
        last = len(self.words) - 1
        below = np.flatnonzero(self.words[at] < words)
        for _ in range(_SCANNED):
            below = below[at[below] < last]
            at[below] += 1
            below = below[self.words[at[below]] < words[below]]
        at[below] = np.minimum(np.searchsorted(self.words, words[below]), last)
        return at, self.words[at] == words

    def symbols(self, at: np.ndarray, known: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """Symbol of each word, and behind the symbols its shape."""
        if not len(self.words):
            return self.n_symbols + shapes
        own = np.where(known, self.symbol[at], -1)
        return np.where((own >= 0) & (shapes < SHAPES), own, self.n_symbols + shapes)

    def classify(self, code_classes: np.ndarray, own: np.ndarray) -> None:
        """Set the classes: of the codes, and of the frequent words that are no symbols."""
        self.code_classes = code_classes
        self.classes = np.where(self.symbol >= 0, code_classes[self.symbol], own)
        self.classes[self.ending] = CLASSES
        self.codes = np.where(self.symbol >= 0, self.symbol, self.n_symbols + self.classes)

    def present(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes and classes of the frequent words, which are all that a round changes for the tasks."""
        return self.codes.astype(np.int32), self.classes.astype(np.int32)

    def fit(self, table: np.ndarray, class_words: np.ndarray) -> None:
        """Log probabilities from the class bigrams and the distinct words of each class."""
        size = CLASSES + 1
        left, right = table.sum(1), table.sum(0)
        any_class = (right + ADDED) / (right.sum() + ADDED * size)
        follow = (table > 0).sum(1)
        mixed = np.maximum(left + follow, 1)[:, None]
        self.transition = np.log10(np.where(left[:, None] > 0, (table + follow[:, None] * any_class) / mixed, any_class))
        self.emission = np.log10(right + ADDED * (class_words + 1))

    def moves(self, classes: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """For each text the sum of its transitions, less the sizes of its classes."""
        before = np.empty_like(classes)
        before[1:] = classes[:-1]
        before[cut[:-1]] = CLASSES
        return np.add.reduceat(self.transition[before, classes] - self.emission[classes], cut[:-1])


def _class_table(pairs: np.ndarray, classes: np.ndarray) -> np.ndarray:
    member = np.zeros((len(pairs), CLASSES + 1))
    member[np.arange(len(pairs)), classes] = 1.0
    return member.T @ pairs @ member


def _ratios(table: np.ndarray) -> np.ndarray:
    """What a context of each side and class is worth to each class: ``[side * (CLASSES + 1) + class, class]``."""
    smooth = table + ADDED
    ratio = np.log(smooth / smooth.sum(1)[:, None] / smooth.sum(0) * smooth.sum())
    return np.rint(np.vstack([ratio[:, :CLASSES], ratio.T[:, :CLASSES]]) * _EXACT)


def _count_pairs(rows: DataFrame, held) -> DataFrame:
    """``pair, n``: bigrams of symbols, the first of a text after the end symbol."""
    def scan(batches):
        tables = held.value
        end = tables.n_symbols + SHAPES
        size = end + 1
        counts = _Sums(size * size)
        for batch in batches:
            for _, _, words, shapes, cut in _tokens(batch.column(0)):
                at, known = tables.find(words)
                symbols = tables.symbols(at, known, shapes)
                before = np.empty_like(symbols)
                before[1:] = symbols[:-1]
                before[cut[:-1]] = end
                counts.add(before * size + symbols)
        yield from counts.batches()
        give_back()

    return rows.select("text").mapInArrow(scan, "pair bigint, n bigint")


def _packed(key: np.ndarray, n: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``key << bits | count`` that sum to the counts ``n``, and the key's place each one is of."""
    most = (1 << bits) - 1
    times = np.maximum(-(-n // most), 1)
    place = np.repeat(np.arange(len(key)), times)
    counts = np.full(len(place), most, np.int64)
    counts[np.cumsum(times) - 1] = n - (times - 1) * most
    return place, (key[place] << bits | counts).astype(np.int32)


def _entries(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, key and count of each packed entry of a column."""
    lengths, flat = _flat(column)
    flat = flat.astype(np.int64)
    return np.repeat(np.arange(len(column)), lengths), flat >> bits, flat & ((1 << bits) - 1)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many values each row has and all values, of a column of lists or of 32-bit integers as bytes."""
    if pa.types.is_list(column.type):
        return np.asarray(column.value_lengths()), np.asarray(column.flatten())
    _, offsets, data = column.cast(pa.binary()).buffers()
    if not len(column) or not data:
        return np.zeros(len(column), np.int64), np.zeros(0, np.int32)
    bounds = np.frombuffer(offsets, np.int32)[column.offset: column.offset + len(column) + 1] // 4
    return np.diff(bounds), np.frombuffer(data, np.int32, bounds[-1])[bounds[0]:]


def _bytes(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """Lists of 32-bit integers as bytes, which Spark passes on whole."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(values.astype(np.int32))])


def _counted(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of sorted codes, and how often each comes."""
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return code[first], np.diff(np.append(first, len(code)))


def _parts(code: np.ndarray, bits: int) -> Iterator[slice]:
    """Runs of about ``_SENT`` sorted codes; those with the same upper bits, all but ``bits``, stay together."""
    at = 0
    while at < len(code):
        end = min(at + _SENT, len(code))
        end += int(np.searchsorted(code[end:], code[end - 1] | ((1 << bits) - 1), side="right"))
        yield slice(at, end)
        at = end


def _list(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _contexts(rows: DataFrame, held) -> DataFrame:
    """``word, around, before, behind``: neighbours of each word that is no symbol, summed as far as a task sees.

    ``around`` has the frequent neighbours, packed, as bytes: place among the frequent words times two,
    plus one for those behind. ``before`` and ``behind`` are the rare ones, as often as they come.
    """
    def scan(batches):
        tables = held.value
        codes, pairs, rare, none = [], [], [[], []], np.zeros(0, np.int64)

        def joined(parts):
            whole = [np.concatenate([none, *x]) for x in (zip(*parts) if parts else ([], []))]
            parts.clear()
            return whole

        def out():
            mine, keys = joined(pairs)
            own, which = np.unique(mine, return_inverse=True)
            code = np.concatenate([none, *codes, (which + len(tables.words)) << _KEY_BITS | keys])
            codes.clear()
            del mine, keys, which
            code.sort()
            for part in _parts(code, _KEY_BITS):
                key, n = _counted(code[part])
                place, packed = _packed(key & ((1 << _KEY_BITS) - 1), n, _CONTEXT_BITS)
                word = (key >> _KEY_BITS)[place]
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                mine, empty = word[first], np.zeros(len(first) + 1, np.int64)
                hidden = mine >= len(tables.words)
                ids = np.empty(len(mine), np.int64)
                ids[~hidden], ids[hidden] = tables.words[mine[~hidden]], own[mine[hidden] - len(tables.words)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), _bytes(np.append(first, len(word)), packed), _list(empty, none), _list(empty, none)],
                    names=names)
            del code
            for side in (0, 1):
                mine, others = joined(rare[side])
                order = np.argsort(mine, kind="stable")
                mine, others = mine[order], others[order]
                del order
                for part in _parts(mine, 0):
                    word, first = np.unique(mine[part], return_index=True)
                    empty, full = np.zeros(len(word) + 1, np.int64), np.append(first, part.stop - part.start)
                    lists = [_list(full, others[part]), _list(empty, none)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word), _bytes(empty, none), lists[side], lists[1 - side]], names=names)
            give_back()

        names, size = ["word", "around", "before", "behind"], 0
        for batch in batches:
            for _, _, words, _, cut in _tokens(batch.column(0)):
                at, known = tables.find(words)
                last = cut[1:] - 1
                # the end, which every text has, is before its first word
                before = np.arange(-1, len(words) - 1)
                before[cut[:-1]] = last
                inner = np.ones(len(words), bool)
                inner[last] = False
                moving = np.flatnonzero(inner & (~known | tables.other[at]))
                for side, near in enumerate((before[moving], moving + 1)):
                    key = at[near] * 2 + side
                    both = known[near] & known[moving]
                    codes.append(at[moving[both]] << _KEY_BITS | key[both])
                    half = known[near] & ~known[moving]
                    pairs.append((words[moving[half]], key[half]))
                    hidden = ~known[near]
                    rare[side].append((words[moving[hidden]], words[near[hidden]]))
                size += 2 * len(moving)
                if size > 2 * _FLUSH:
                    yield from out()
                    size = 0
        if size:
            yield from out()

    return rows.select("text").mapInArrow(
        scan, "word bigint, around binary, before array<bigint>, behind array<bigint>")


def _grouped(contexts: DataFrame) -> DataFrame:
    """The contexts with one row for each word."""
    def scan(batches):
        left = None

        def out(columns):
            word = np.asarray(columns[0])
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lists = []
            for column in columns[1:]:
                lengths, values = _flat(column)
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                made = _list if pa.types.is_list(column.type) else _bytes
                lists.append(made(np.append(bounds[first], bounds[-1]), values))
            return pa.RecordBatch.from_arrays([pa.array(word[first]), *lists],
                                              names=["word", "around", "before", "behind"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = batch.columns
            if left is not None:
                columns = [pa.concat_arrays(x) for x in zip(left, columns)]
            word = np.asarray(columns[0])
            last = int(np.searchsorted(word, word[-1]))  # the last word may go on in the next batch
            if last:
                yield out([c.slice(0, last) for c in columns])
            left = [c.slice(last) for c in columns]
        if left is not None:
            yield out(left)

    return contexts.repartition("word").sortWithinPartitions("word").mapInArrow(scan, contexts.schema)


def _vectors(contexts: DataFrame, held, now, rare: DataFrame | None) -> DataFrame:
    """``word, rare_class, around``: counts of each word by side and code of its neighbours under the classes of ``now``.

    The entries are packed. ``rare_class`` is the class of a word that is not a frequent one.
    """
    tables = held.value
    size, n_symbols = tables.end + 1, tables.n_symbols

    def scan(batches):
        codes, _ = now.value
        for batch in batches:
            row, key, n = _entries(batch.column(1), _CONTEXT_BITS)
            code, sums = _summed(row * (2 * size) + (key & 1) * size + codes[key >> 1], n, _CONTEXT_BITS)
            place, packed = _packed(code % (2 * size), sums, _VECTOR_BITS)
            bounds = np.searchsorted(code[place], np.arange(batch.num_rows + 1) * (2 * size))
            yield pa.RecordBatch.from_arrays([batch.column(0), _list(bounds, packed)], names=["word", "around"])

    found = contexts.select("word", "around").mapInArrow(scan, "word bigint, around array<int>")
    if rare is None:
        return found.select("word", F.lit(-1).alias("rare_class"), "around")
    # classes of rare words come by joins: for their neighbours and for the words themselves
    sides = [contexts.select("word", F.explode(c).alias("other"), F.lit(i).alias("side"))
             for i, c in enumerate(("before", "behind"))]
    key = ((F.col("side") * size + n_symbols + F.col("class")) * (1 << _VECTOR_BITS)).cast("int")
    most = (1 << _VECTOR_BITS) - 1
    sent = sides[0].union(sides[1]).join(rare.withColumnRenamed("word", "other"), "other") \
        .groupBy("word", key.alias("key")).agg(F.count(F.lit(1)).alias("n")) \
        .select("word", F.concat(F.array_repeat(F.col("key") + most, F.floor(F.col("n") / most).cast("int")),
                                 F.array((F.col("key") + F.col("n") % most).cast("int"))).alias("around"))
    return found.union(sent).groupBy("word").agg(F.flatten(F.collect_list("around")).alias("around")) \
        .join(rare.withColumnRenamed("class", "rare_class"), "word", "left") \
        .select("word", F.coalesce("rare_class", F.lit(-1)).alias("rare_class"), "around")


def _count_codes(vectors: DataFrame, held, now) -> DataFrame:
    """``pair, n``: bigrams of codes in which a word that is no symbol takes part."""
    def scan(batches):
        tables = held.value
        _, classes = now.value
        size = tables.end + 1
        counts = _Sums(size * size)
        for batch in batches:
            row, key, n = _entries(batch.column(2), _VECTOR_BITS)
            at, known = tables.find(np.asarray(batch.column(0)))
            own = np.where(known, classes[at], np.asarray(batch.column(1)))[row] + tables.n_symbols
            side, code = np.divmod(key, size)
            # a word behind that is no symbol counts the pair itself, in its own row
            once = (side == 0) | (code < tables.n_symbols) | (code == tables.end)
            pair = np.where(side == 0, code * size + own, own * size + code)[once]
            counts.add(pair, n[once])
        yield from counts.batches()

    return vectors.mapInArrow(scan, "pair bigint, n bigint")


def _best_classes(vectors: DataFrame, held, moved) -> DataFrame:
    """``word, class, rare``: for each word the class that suits its neighbours best.

    ``moved`` has the classes of the codes and what a context of each class is worth.
    """
    def scan(batches):
        tables = held.value
        code_classes, ratios = moved.value
        side_class = np.concatenate([code_classes, code_classes + CLASSES + 1])
        for batch in batches:
            row, key, n = _entries(batch.column(2), _VECTOR_BITS)
            width = 2 * (CLASSES + 1)
            around = np.bincount(row * width + side_class[key], n, batch.num_rows * width).reshape(-1, width)
            best = np.argmax(around @ ratios, axis=1).astype(np.int32)
            _, known = tables.find(np.asarray(batch.column(0)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best), pa.array(~known)],
                                             names=["word", "class", "rare"])

    return vectors.mapInArrow(scan, "word bigint, class int, rare boolean")


def _square(found: pa.Table, size: int) -> np.ndarray:
    table = np.zeros(size * size)
    table[np.asarray(found["pair"])] = np.asarray(found["n"])
    return table.reshape(size, size)


def _stored_alone(frame: DataFrame, name: str) -> DataFrame:
    """Rows of whole texts in the shared folder; what was shuffled for them is deleted at once, not when garbage is collected."""
    with setting(frame.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return stored_by_texts(frame, name)


def _forget(spark) -> None:
    """Let Spark delete the shuffle files of frames that are no longer held: a round needs those of its own only."""
    gc.collect()
    give_back()
    spark.sparkContext._jvm.System.gc()


def _cluster(train: DataFrame, tables: Tables, shapes: np.ndarray, rare_words: DataFrame | None):
    """Set the classes of ``tables``; give the class bigrams, the class of each shape and ``word, class`` of rare words.

    ``shapes`` are the shapes of the frequent words, in the order of ``tables.words``.
    """
    spark = train.sparkSession
    n_symbols, size = tables.n_symbols, tables.end + 1
    held = spark.sparkContext.broadcast(tables)
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS):
        found = _count_pairs(train, held).groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    seed = _square(found, n_symbols + SHAPES + 1)
    start = exchange(seed, CLASSES, n_symbols + SHAPES)
    fixed = np.r_[np.arange(n_symbols), n_symbols + SHAPES]  # symbols and the end
    base = np.zeros((size, size))
    into = np.r_[np.arange(n_symbols), tables.end]
    base[np.ix_(into, into)] = seed[np.ix_(fixed, fixed)]
    shape_classes = start[n_symbols:]
    tables.classify(np.r_[start[:n_symbols], np.arange(CLASSES + 1)], shape_classes[shapes])

    contexts, rare = _stored_alone(_grouped(_contexts(train, held)), "contexts"), None
    if rare_words is not None:
        by_shape = F.array(*[F.lit(int(c)) for c in shape_classes])
        rare = rare_words.select("word", F.element_at(by_shape, F.col("shape").cast("int") + 1).alias("class"))

    _forget(spark)
    best, kept = -np.inf, None
    for turn in range(ROUNDS + 1):
        now = spark.sparkContext.broadcast(tables.present())
        vectors = _vectors(contexts, held, now, rare).persist(StorageLevel.DISK_ONLY)
        found = _count_codes(vectors, held, now).groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
        pairs = base + _square(found, size)
        codes = exchange(pairs, CLASSES, tables.end, 2, tables.code_classes, n_symbols)
        tables.classify(codes, tables.classes)
        table = _class_table(pairs, codes)
        reached = information(table)
        if reached > best:
            rises = turn == 0 or reached - best > LEAST_RISE * abs(best)
            best, kept = reached, (codes, tables.classes, rare, table)
        else:
            rises = False
        if not rises or turn == ROUNDS:
            vectors.unpersist()
            now.destroy()
            break
        moved = spark.sparkContext.broadcast((tables.code_classes, _ratios(table)))
        chosen = _best_classes(vectors, held, moved)
        if rare is not None:
            chosen = stored(chosen, "classes")
            rare = chosen.filter("rare").select("word", "class")
        own = chosen.filter("NOT rare").select("word", "class").toArrow()
        vectors.unpersist()
        vectors = chosen = None
        # else a file of each broadcast stays on the driver, and on the executors until the driver collects its garbage
        now.destroy()
        moved.destroy()
        _forget(spark)
        classes = tables.classes.copy()
        classes[tables.find(np.asarray(own["word"]))[0]] = np.asarray(own["class"])
        tables.classify(codes, classes)
    held.destroy()
    codes, classes, rare, table = kept
    tables.classify(codes, classes)
    # a shape has the class that suits its neighbours among the symbols best
    ratios, width = _ratios(table), CLASSES + 1
    symbol_classes = codes[into]
    around = np.zeros((SHAPES, 2 * width))
    for side, counts in enumerate((seed[fixed, n_symbols:-1].T, seed[n_symbols:-1, fixed])):
        for symbol, own_class in enumerate(symbol_classes):
            around[:, side * width + own_class] += counts[:, symbol]
    return table, np.append(np.argmax(around @ ratios, axis=1), CLASSES), rare


def _local_scores(rows: DataFrame, held) -> DataFrame:
    """What the frequent words say of each text, and its rarer words: ``rare`` at the places ``at``.

    In ``moves`` and ``classes`` a rarer word has the class of its shape.
    """
    def scan(batches):
        tables, shape_classes = held.value
        frequent_logs = np.log10(tables.counts + ADDED)
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, last, words, shapes, cut in _tokens(batch.column(2)):
                at, known = tables.find(words)
                classes = shape_classes[shapes]
                logs = np.zeros(len(words))
                if len(tables.words):
                    classes = np.where(known, tables.classes[at], classes)
                    logs = np.where(known, frequent_logs[at], logs)
                sums = [np.add.reduceat(x, cut[:-1]) for x in (logs, known.astype(np.int64))]
                hidden = np.flatnonzero(~known)
                offsets = pa.array(np.searchsorted(hidden, cut).astype(np.int32))
                places = hidden - np.repeat(cut[:-1], np.diff(np.searchsorted(hidden, cut)))
                n = last - first
                text = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(cut.astype(np.int32)),
                                                              pa.py_buffer(classes.astype(np.uint8))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(key, key + n)), batch.column(0).slice(first, n), batch.column(1).slice(first, n),
                     pa.array(np.diff(cut)), pa.array(tables.moves(classes, cut)), *[pa.array(s) for s in sums], text,
                     pa.ListArray.from_arrays(offsets, pa.array(words[hidden])),
                     pa.ListArray.from_arrays(offsets, pa.array(places.astype(np.int64)))],
                    names=["key", "doc_id", "held_out", "n_tokens", "moves", "logs", "known", "classes", "rare", "at"])
                key += n
        give_back()

    return rows.mapInArrow(scan, "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, moves double, logs double, "
                                 "known bigint, classes binary, rare array<bigint>, at array<bigint>")


def _whole_scores(scored: DataFrame, held) -> DataFrame:
    """Scores with the classes and counts of the rarer words that were found: ``around`` has places, classes, counts."""
    def scan(batches):
        tables, _ = held.value
        for batch in batches:
            cut = np.concatenate([[0], np.cumsum(np.asarray(batch.column(3)))])
            classes = np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint8).astype(np.int64)
            found = batch.column(8)
            lengths = np.asarray(found.value_lengths().fill_null(0))
            row = np.repeat(np.arange(batch.num_rows), lengths)
            place, own, n = (np.asarray(found.flatten().field(i)) for i in range(3))
            classes[cut[row] + place] = own
            gained = np.bincount(row, np.log10(n + ADDED), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(tables.moves(classes, cut)), pa.array(np.asarray(batch.column(5)) + gained),
                 pa.array(np.asarray(batch.column(6)) + lengths)], names=batch.schema.names[:7])

    return scored.mapInArrow(scan, "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, moves double, "
                                   "logs double, known bigint")


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows that are not held out and score all of them.

    Gives ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(held_out, F.lit(True)).alias("held_out"), F.col(f"`{text}`").alias("text"))
    train = rows.filter(~F.col("held_out"))
    vocabulary = _stored_alone(_count_words(train).groupBy("word").agg(F.sum("n").alias("n"), F.min("shape").alias("shape")),
                               "vocabulary")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    bands = [(r[0], r[1]) for r in vocabulary.groupBy(_band()).count().collect()]
    frequent = _least_count(bands, FREQUENT)
    top = vocabulary.filter(_band() >= frequent).select("word", "n", "shape").toArrow()
    top = np.array([np.asarray(c, np.int64) for c in top.columns])
    most = vocabulary.filter(F.col("word") != END).orderBy(F.desc("n"), "word").limit(SYMBOLS).toArrow().to_pylist()
    ending = vocabulary.filter(F.col("word") == END).toArrow().to_pylist()
    symbols = np.array([r["word"] for r in most], np.int64)
    below = [r for r in [*most, *ending] if not (top[0] == r["word"]).any()]
    further = [r for r in below if not (symbols == r["word"]).any()]
    first, behind = (np.array([[r[c] for r in x] for c in ("word", "n", "shape")], np.int64) for x in (most, further))
    words, counts, shapes = np.hstack([first, top[:, ~np.isin(top[0], symbols)], behind])
    del top
    tables = Tables(words, counts, len(most))
    rare_words = None
    if distinct > len(words):
        rare_words = vocabulary.filter((_band() < frequent) & ~F.col("word").isin([r["word"] for r in below]))

    table, shape_classes, rare = _cluster(train, tables, shapes[np.argsort(words)], rare_words)
    different = np.bincount(tables.classes, minlength=CLASSES + 1).astype(float)
    if rare is not None:
        for own, n in rare.groupBy("class").count().collect():
            different[own] += n
    different[CLASSES] = 1
    tables.fit(table, different)

    held = spark.sparkContext.broadcast((tables, shape_classes))
    scored = _local_scores(rows, held)
    if rare is None:
        scored = stored_by_texts(scored.drop("classes", "rare", "at"), "scores")
    else:
        scored = stored_by_texts(scored, "scores")
        inside = scored.select("key", F.explode(F.arrays_zip("rare", "at")).alias("r")) \
            .select("key", F.col("r.rare").alias("word"), F.col("r.at").alias("at"))
        around = inside.join(rare.join(rare_words.select("word", "n"), "word"), "word").groupBy("key").agg(
            F.collect_list(F.struct("at", "class", "n")).alias("around"))
        scored = _whole_scores(scored.drop("rare", "at").join(around, "key", "left"), held)
    logs = F.col("logs") + (F.col("n_tokens") - F.col("known")) * float(np.log10(ADDED))
    result = scored.select(
        "doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(total + ADDED * (distinct + 1)))).alias("base_score"),
        (F.col("moves") + logs).alias("score"))
    return result.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
