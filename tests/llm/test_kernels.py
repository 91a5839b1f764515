"""Numpy kernels: words, FM-index, Simple-8b, encoder, sketches, exchange, bin completion."""

import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from gridloom.llm import bin_completion as packing
from gridloom.llm import sketches, words
from gridloom.llm.decontaminate import Phrases, find
from gridloom.llm.exchange import exchange
from gridloom.llm.fm_index import FmIndex, SAMPLE
from gridloom.llm.packing import cut_documents, slots
from gridloom.llm.simple8b import BLOCK, pack, unpack
from gridloom.llm.tokens import Encoder
from gridloom.llm.toxicity import IDENTITY, Model, fit, identity_features, objective, swapped
from tests.llm import brute

PIECES = list("aAbéÉñßI'´ ") + [
    " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "日本", "é", "İ", "Σ", "ς", "½", "１",
    "!", "?!", "...", "'s", "'LL", " 's", "\x00", "\xad", "×", "😀", "<|endoftext|>", "ﬁ", "123", "word", "Next,"]


def random_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["", None, "a" * 70_000]


@pytest.mark.parametrize("limit", [40, 1 << 20])
def test_words(limit):
    texts = random_texts(1, 500)
    known = {}
    for separator, pattern in ((words.IS_SPACE, brute.SPACED), (words.NOT_ALNUM, brute.ALNUM)):
        for first, last, data, bounds in words.slices(pa.array(texts), limit):
            starts, ends = words.word_spans(data, bounds, separator)
            hashes = words.word_hashes(data, starts, ends)
            cut = words.rows_of(starts, bounds)
            for i in range(first, last):
                a, b = cut[i - first], cut[i - first + 1]
                found = [data[x:y].tobytes().decode().translate(brute.LOW) for x, y in zip(starts[a:b], ends[a:b])]
                assert found == pattern.findall((texts[i] or "").translate(brute.LOW))
                for w, h in zip(found, hashes[a:b].tolist()):
                    assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(file, monkeypatch):
    monkeypatch.setattr("gridloom.llm.tokens.CACHED", 200)
    texts = random_texts(2, 3000)
    encoder = Encoder(public_tokenizers.path(file))
    assert encoder.pattern is not None
    want = [[*e.ids, 7] for e in encoder.whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):
        for first, last, ids, cut in encoder.encode(pa.array(texts), 7):
            for i in range(first, last):
                assert ids[cut[i - first]: cut[i - first + 1]].tolist() == want[i], texts[i]
    encoder.pattern = None  # any other kind of file: whole texts
    for first, last, ids, cut in encoder.encode(pa.array(texts[:50]), 7):
        assert [ids[a:b].tolist() for a, b in zip(cut, cut[1:])] == want[first:last]


@pytest.mark.parametrize("top", [1, 2, 100, 49_408, 2**32, 2**60, 2**64 - 1])
def test_simple8b(top):
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, BLOCK - 1, BLOCK, BLOCK + 1, 5 * BLOCK + 17):
        ids = rng.integers(0, top, n, dtype=np.uint64, endpoint=True)
        ids[rng.random(n) < 0.4] = 0
        packed = pack(ids)
        assert np.array_equal(unpack(packed), ids)
        assert len(packed.escapes) == (ids >= 2**60).sum()
        if n > 3 * BLOCK:
            assert np.array_equal(unpack(packed, 2, 4), ids[2 * BLOCK: 4 * BLOCK])
    assert len(pack(np.zeros(BLOCK, np.uint64)).words) == 5


def test_fm_index():
    rng = np.random.default_rng(5)
    for n, letters in ((1, 1), (40, 2), (3000, 3), (3000, 50)):
        text = rng.integers(0, letters + 1, n)
        text[200:300] = text[700:800] if n > 1000 else text[200:300]
        text = np.append(text, 0)
        index = FmIndex(text, int(letters).bit_length() + 1)
        for length in (1, 2, 5, 40):
            phrases = rng.integers(1, letters + 1, (30, length))
            if n > 1000:
                phrases[0] = text[200: 200 + length]
            phrases = phrases[(phrases > 0).all(1)]
            low, high = index.search(phrases)
            for p, a, b in zip(phrases, low, high):
                want = [i for i in range(len(text) - length + 1) if np.array_equal(text[i: i + length], p)]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want
    assert SAMPLE > 1


def test_find_in_texts(monkeypatch):
    monkeypatch.setattr("gridloom.llm.decontaminate._HITS", 7)
    rng = random.Random(6)
    items = [("i1", "a b c d e f g h i j k l"), ("i2", "Q r, s"), ("i3", None), ("i4", "..."), (None, "z"),
             ("i1", "a b c d e f g h i j k l"), ("i5", "b c d e f g h i j k")]
    phrases = Phrases(items, 10)
    found = brute.windows(dict(enumerate(t for _, t in items)))
    names = {str(i): n or "" for i, (n, _) in enumerate(items)}
    for _ in range(200):
        text = " ".join(rng.choice(["a b c d e f g h i j k l", "q R s", "x", "a", "b c d", "Z", "é"])
                        for _ in range(rng.randint(0, 12)))
        spans, hit, hits = brute.leaks(text, found)
        for _, _, data, bounds in words.slices(pa.array([text])):
            starts, ends = words.word_spans(data, bounds, words.NOT_ALNUM)
            cut = words.rows_of(starts, bounds)
            mask, pairs = find(phrases.symbols(words.word_hashes(data, starts, ends)), cut, phrases)
            assert set(np.flatnonzero(mask).tolist()) == hit
            assert {phrases.names[p] for p in pairs.tolist()} == {names[i] for i in hits}


def test_sketches_estimate():
    rng = np.random.default_rng(8)
    for size in (3, 12, 90, 5000):
        shared = rng.integers(0, 2**64 - 1, size * 4, dtype=np.uint64)
        found = []
        for _ in range(40):
            rest = rng.integers(0, 2**64 - 1, size * 2, dtype=np.uint64)
            shared = rng.integers(0, 2**64 - 1, size * 4, dtype=np.uint64)
            one = np.unique(np.concatenate([shared, rest[:size // 2]]))
            two = np.unique(np.concatenate([shared, rest[size:size + size // 2]]))
            a, b = sketches.registers(one), sketches.registers(two)
            found.append(sketches.estimate(a, b))
            assert set(sketches.band_keys(a)) & set(sketches.band_keys(b))
        true = 4 * size / (4 * size + 2 * (size // 2))
        assert abs(np.mean(found) - true) < 0.05
    same = sketches.registers(np.array([5], np.uint64))
    assert len(set(same.tolist())) == 1
    assert sketches.shingle_hashes(np.zeros(0, np.uint64), 5).size == 0
    one = sketches.shingle_hashes(np.array([1, 2], np.uint64), 5)
    assert one.size == 1 and one[0] != sketches.shingle_hashes(np.array([1, 2, 3], np.uint64), 5)[0]


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(1)
    pairs = np.zeros((31, 31))
    for _ in range(20_000):  # words 0-9 are followed by 10-19, those by 20-29, those by 0-9
        a = rng.integers(0, 30)
        pairs[a, (a // 10 + 1) % 3 * 10 + rng.integers(0, 10)] += 1
    classes = exchange(pairs, 3, 30)
    assert [len(set(classes[i:i + 10])) for i in (0, 10, 20)] == [1, 1, 1] and len(set(classes[:30])) == 3
    assert classes[30] == 3


def best_by_trial(items, capacity):
    best = len(items)

    def put(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[i] <= capacity and bins[j] not in bins[:j]:
                put(i + 1, [*bins[:j], bins[j] + items[i], *bins[j + 1:]])
        put(i + 1, [*bins, items[i]])
    put(0, [])
    return best


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(9)
    for _ in range(150):
        items = sorted((rng.randint(1, 30) for _ in range(rng.randint(0, 9))), reverse=True)
        counts = {n: items.count(n) for n in set(items)}
        found = packing.pack_lengths(counts, 30)
        assert all(sum(p) <= 30 for p, _ in found)
        used = sorted(itertools.chain.from_iterable(p * t for p, t in found), reverse=True)
        assert used == items
        assert packing.bound(counts, 30) <= sum(t for _, t in found) == (best_by_trial(items, 30) if items else 0)


def test_search_improves_on_best_fit():
    rng = np.random.default_rng(3)
    counts = dict(zip(*(x.tolist() for x in np.unique(rng.integers(200, 500, 3000), return_counts=True))))
    first = sum(t for _, t in packing._best_fit_packing(counts, 1024))
    assert sum(t for _, t in packing.pack_lengths(counts, 1024)) < first


def test_slots_and_cuts():
    assert slots([((3, 1, 1), 2), ((3,), 1)]) == [(3, 0, 2, 0, 0), (1, 0, 2, 0, 3), (1, 2, 4, 0, 4), (3, 2, 3, 2, 0)]
    doc, piece, start, length = cut_documents(np.array([0, 1, 10, 18, 27]), 8)
    assert list(zip(doc, piece, start, length)) == [(0, 0, 0, 1), (1, 0, 0, 1), (1, 1, 1, 8), (2, 0, 0, 8), (3, 0, 0, 1),
                                                    (3, 1, 1, 8)]


def test_counterfactual_penalty_takes_weight_from_identity():
    # feature 0 is the slur, 1 an identity term seen mostly beside it, 2 another of its group
    indices = [[0, 1]] * 30 + [[0]] * 5 + [[1]] * 4 + [[2]] * 30 + [[]] * 60
    labels = np.array([1.0] * 35 + [0.0] * 94)
    free, low = fit(indices, labels, [([1], [2])] * 20, 3, penalty=0.0)
    held, intercept = fit(indices, labels, [([1], [2])] * 20, 3, penalty=10.0)
    assert abs(held[1] - held[2]) < 0.1 * abs(free[1] - free[2])
    chance = 1 / (1 + np.exp(-(held[1] + intercept)))
    assert chance < 1 / (1 + np.exp(-(free[1] + low)))
    assert 1 / (1 + np.exp(-(held[0] + intercept))) > 0.7


def test_slope_of_the_objective_is_its_difference_quotient():
    rng = np.random.default_rng(7)
    indices = [sorted(rng.choice(9, rng.integers(0, 6), replace=False).tolist()) for _ in range(40)]
    pairs = [([0, 3], [1, 3]), ([0], [2]), ([], [4]), ([5, 6], [5, 7])]
    labels = rng.integers(0, 2, 40).astype(float)
    at = objective(indices, labels, pairs, 9, penalty=3.0, ridge=0.1)
    w = rng.normal(size=10)
    loss, slope = at(w)
    for i in range(10):
        step = np.zeros(10)
        step[i] = 1e-6
        assert slope[i] == pytest.approx((at(w + step)[0] - at(w - step)[0]) / 2e-6, abs=1e-7)
    # the loss itself, written out
    def logit(row):
        return sum(w[j] for j in row)
    chances = [1 / (1 + np.exp(-logit(row) - w[-1])) for row in indices]
    sides = [-np.mean([np.log(p if y else 1 - p) for p, y in zip(chances, labels) if y == side]) for side in (0, 1)]
    swaps = np.mean([(logit(a) - logit(b)) ** 2 for a, b in pairs])
    assert loss == pytest.approx(sum(sides) / 2 + 0.1 * (w[:-1] @ w[:-1]) / 2 + 3.0 * swaps)


def test_every_term_of_a_sentence_is_swapped():
    found = swapped("Black women, and Frauen")
    assert len(found) == 7 + 7 + 3
    assert "white women, and Frauen" in found and "Black men and Frauen" in found and "Black women, and männer" in found
    assert all(len(set(g)) == len(g) for g in IDENTITY)


def test_swaps_and_model():
    found = swapped("They met a muslim, there")
    assert len(found) == 7 and "They met a christian there" in found
    assert swapped("no such term") == []
    assert len(identity_features()) >= len({t for g in IDENTITY for t in g})
    model = Model(np.zeros(0, np.int64), np.zeros(0), -30.0)
    assert (model.scores(pa.array(["a", None, ""])) < 0.01).all()
