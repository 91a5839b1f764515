"""Toxicity: a logistic model that is held to the same score when identity terms are swapped.

Features are words and their first 4, 5 and 6 bytes (stems of longer words), each as present
or not. The model is fitted on a bounded sample of labelled rows: at most about
``toxic_rows`` toxic and ``clean_rows`` other ones, drawn by a hash of the id. Candidates are
features of at least ``share`` of the sampled toxic texts, so their number is at most the mean
number of features of a text over ``share``; the ``features`` with the highest chi-square (of
``chi_square`` or more) stay, and the features of all identity terms with them. All these
are arguments of :func:`learn`.

Counterfactuals: in sentences of the sample that name identity terms, each of the terms in turn
is swapped for each other term of its group, and the squared changes of the logit are added
to the loss with weight ``penalty``. Of more than ``pairs`` swaps those with the least hashes
count. A group that is named more often in toxic texts so gains no weight of its own.
Scoring is one pass over all texts and never sees labels or metadata.

Cases: a null or empty text has no features and gets the score of the intercept. A text of any
length is scored whole, in a slice of its own if it is long. Labels that are
null or neither 0 nor 1 are left out; an id labelled twice is toxic if either label says so.
Rows without id are scored and never learned from; a repeated row is learned from as often as it
comes and scored alike each time. Features of equal chi-square stay by their hash. Without sampled
labels of both kinds every score is the share of toxic labels in the sample, 0 without any. An
empty table gives no rows. Columns beside id, text and label are not read.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.words import NOT_ALNUM, mix, rows_of, slices, word_hashes, word_spans

TOXIC_ROWS, CLEAN_ROWS, PAIRS = 16_384, 32_768, 20_000
FEATURES, SHARE, LEAST = 4096, 0.002, 3
CHI_SQUARE = 30.0  # beyond what some ten thousand candidates reach by chance
PENALTY, RIDGE, STEPS = 10.0, 1e-4, 400
STEMS = (4, 5, 6)

# Terms that name groups of people without judging them, by language and kind: fixed values.
IDENTITY = (
    ("women", "men", "girls", "boys", "female", "male", "transgender", "nonbinary"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young", "elderly", "teenage"),
    ("blind", "deaf", "disabled", "autistic"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées", "catholiques", "protestants"),
    ("noirs", "blancs", "asiatiques", "arabes", "africains", "européens"),
    ("homosexuels", "hétérosexuels", "lesbiennes", "bisexuels"),
    ("immigrés", "réfugiés", "étrangers"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten", "katholiken", "protestanten"),
    ("schwarze", "weiße", "asiaten", "araber", "afrikaner", "europäer"),
    ("schwule", "lesben", "bisexuelle", "heterosexuelle"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos", "católicos", "protestantes"),
    ("negros", "blancos", "asiáticos", "árabes", "africanos", "europeos"),
    ("homosexuales", "heterosexuales", "lesbianas", "bisexuales"),
    ("inmigrantes", "refugiados", "extranjeros"),
)


def _all_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all words and the word of each: the word itself and its stems."""
    hashes, words = [word_hashes(data, starts, ends)], [np.arange(len(starts))]
    for i, n in enumerate(STEMS):
        longer = np.flatnonzero(ends - starts > n)
        stem = word_hashes(data, starts[longer], starts[longer] + n)
        hashes.append(mix(stem ^ np.uint64(i + 1)))
        words.append(longer)
    return np.concatenate(hashes).view(np.int64), np.concatenate(words)


def _features(texts: pa.Array, known: np.ndarray | None = None):
    """``first, end, row, feature`` of slices: the distinct features of each row, or those that are known."""
    for first, last, data, bounds in slices(texts):
        starts, ends = word_spans(data, bounds, NOT_ALNUM)
        hashes, words = _all_features(data, starts, ends)
        if known is not None:
            at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
            hashes, words = at[hit], words[hit]
        rows = np.searchsorted(rows_of(starts, bounds), words, side="right") - 1
        order = np.lexsort((hashes, rows))
        rows, hashes = rows[order], hashes[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
        yield first, last, rows[new], hashes[new]


def _counted(rows: DataFrame, known: np.ndarray | None) -> DataFrame:
    """``feature, n``: in how many texts each feature is (places, if ``known`` is given)."""
    held = None if known is None else rows.sparkSession.sparkContext.broadcast(known)

    def scan(batches):
        for batch in batches:
            for _, _, _, found in _features(batch.column(0), None if held is None else held.value):
                feature, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(feature.astype(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["feature", "n"])

    return rows.select("text").mapInArrow(scan, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))


def _arrays(frame: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    found = frame.toArrow()
    return np.asarray(found.column(0).combine_chunks()), np.asarray(found.column(1).combine_chunks())


def identity_features(terms=IDENTITY) -> np.ndarray:
    texts = pa.array([t for group in terms for t in group])
    return np.unique(np.concatenate([f for _, _, _, f in _features(texts)]))


def swapped(sentence: str, terms=IDENTITY) -> list[str]:
    """The sentence with each of its identity terms in turn replaced by each other term of the group."""
    words, out = sentence.split(" "), []
    for i, word in enumerate(words):
        bare = word.strip(".,;:!?\"'()").lower()
        for group in terms:
            if bare in group:
                out += [" ".join([*words[:i], other, *words[i + 1:]]) for other in group if other != bare]
    return out


def _rows(indices: list, n: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, indices), np.int64, n)
    return np.repeat(np.arange(n), sizes), np.fromiter(chain.from_iterable(indices), np.int64, int(sizes.sum()))


def objective(indices: list, labels: np.ndarray, pairs: list[tuple], n_features: int, penalty: float = PENALTY,
              ridge: float = RIDGE):
    """The loss and its slope as a function of weights and intercept: balanced log loss, ridge, squared changes."""
    n = len(labels)
    row, col = _rows(indices, n)
    share = max(labels.mean(), 1 / n)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / max(1 - share, 1 / n)) / n
    p_row, p_col = _rows([a for a, _ in pairs], len(pairs))
    q_row, q_col = _rows([b for _, b in pairs], len(pairs))

    def at(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(row, w[col], n) + w[-1]
        loss = float(weight @ (np.logaddexp(0, z) - labels * z) + ridge * (w[:-1] @ w[:-1]) / 2)
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        slope = np.append(np.bincount(col, error[row], n_features), error.sum())
        slope[:-1] += ridge * w[:-1]
        if pairs:
            change = np.bincount(p_row, w[p_col], len(pairs)) - np.bincount(q_row, w[q_col], len(pairs))
            loss += penalty * float(change @ change) / len(pairs)
            change = change * (2 * penalty / len(pairs))
            slope[:-1] += np.bincount(p_col, change[p_row], n_features) - np.bincount(q_col, change[q_row], n_features)
        return loss, slope
    return at


def fit(indices: list, labels: np.ndarray, pairs: list[tuple], n_features: int, penalty: float = PENALTY,
        ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept that make :func:`objective` small."""
    at = objective(indices, labels, pairs, n_features, penalty, ridge)
    w = np.zeros(n_features + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        _, slope = at(w)
        # Adam with a falling step
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope ** 2
        step = 0.1 / np.sqrt(1 + t / 100)
        w -= step * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-12)
    return w[:-1], float(w[-1])


def _sample(labels: DataFrame, may_learn: Column, doc_id: str, label: str, toxic_rows: int,
            clean_rows: int) -> DataFrame:
    """``doc_id, label`` of the sampled labelled rows."""
    one = labels.filter(may_learn & F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()) \
        .groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    n = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    limits = {1: toxic_rows / max(n.get(1, 0), 1), 0: clean_rows / max(n.get(0, 0), 1)}
    return one.filter(share < F.when(F.col("label") == 1, limits[1]).otherwise(limits[0]))


class Model:
    """Sorted feature hashes, their weights and the intercept."""

    def __init__(self, known: np.ndarray, weights: np.ndarray, intercept: float):
        self.known, self.weights, self.intercept = known, weights, intercept

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.intercept)
        for first, last, row, at in _features(texts, self.known):
            out[first:last] += np.bincount(row, self.weights[at], last - first)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS,
          penalty: float = PENALTY, terms=IDENTITY, pairs: int = PAIRS, features: int = FEATURES,
          share: float = SHARE, least: int = LEAST, chi_square: float = CHI_SQUARE) -> Model:
    """Fit the model on labelled rows; ``may_learn`` is a condition on the labels' columns."""
    spark = docs.sparkSession
    chosen = _sample(labels, may_learn, doc_id, label, toxic_rows, clean_rows)
    sides = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    if len(sides) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), 30.0 if 1 in sides else -30.0)
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # at most toxic_rows + clean_rows ids are broadcast
    learned = texts.join(F.broadcast(chosen), "doc_id")
    found, n_toxic = _arrays(_counted(learned.filter("label = 1"), None)
                             .filter(F.col("n") >= max(least, share * sides[1])))
    order = np.argsort(found)
    found, n_toxic = found[order], n_toxic[order]
    at, n = _arrays(_counted(learned.filter("label = 0"), found))
    n_clean = np.zeros(len(found), np.int64)
    n_clean[at] = n
    # chi-square of presence against the label
    t, c = sides[1], sides[0]
    total = n_toxic + n_clean
    expected = np.maximum(total * (t / (t + c)), 1e-9)
    chi = (n_toxic - expected) ** 2 / expected / np.maximum(1 - total / (t + c), 1e-3)
    best = np.argsort(-chi, kind="stable")[:features]
    best = best[chi[best] >= chi_square]
    known = np.union1d(found[best], identity_features(terms))

    held = spark.sparkContext.broadcast(known)
    named = re.compile("|".join(re.escape(t) for g in terms for t in g) or "(?!)", re.IGNORECASE)

    def rows_of_sample(batches):
        for batch in batches:
            labels_here = batch.column(1)
            for first, last, row, feature in _features(batch.column(0), held.value):
                cut = np.searchsorted(row, np.arange(last - first + 1))
                size = last - first
                yield pa.RecordBatch.from_arrays(
                    [labels_here.slice(first, size), _lists(cut, feature), _lists(np.zeros(size + 1, int), feature[:0])],
                    names=["label", "one", "two"])
            before, after = [], []
            for value in batch.column(0).fill_null("").to_pylist():
                for sentence in re.split(r"[.!?\n]+", value) if named.search(value) else ():
                    others = swapped(sentence, terms)
                    before += [sentence] * len(others)
                    after += others
            if before:
                one, two = (_known(x, held.value) for x in (before, after))
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(before), pa.int32()), one, two], names=["label", "one", "two"])

    made = learned.select("text", "label").mapInArrow(rows_of_sample, "label int, one array<bigint>, two array<bigint>")
    examples = made.filter("label is not null").select("label", "one").collect()
    swaps = [(r["one"], r["two"]) for r in made.filter("label is null").select("one", "two")
             .orderBy(F.xxhash64("one", "two")).limit(pairs).collect()]
    weights, intercept = fit([r["one"] for r in examples], np.array([r["label"] for r in examples], float), swaps,
                             len(known), penalty)
    return Model(known, weights, intercept)


def _lists(cut: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(values, pa.int64()))


def _known(texts: list[str], known: np.ndarray) -> pa.Array:
    out: list[list[int]] = [[] for _ in texts]
    for first, _, row, feature in _features(pa.array(texts), known):
        for r, f in zip(row.tolist(), feature.tolist()):
            out[first + r].append(f)
    return pa.array(out, pa.list_(pa.int64()))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held.value.scores(batch.column(1)))],
                                             names=["doc_id", "score"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(scan, "doc_id bigint, score double")
