"""The operators that run numpy inside tasks: cases against plain Python."""

import os
import random
import time
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloom.llm import brown_lm, decontaminate as leaks, kd_shards as kd, near_dups, packing, token_files, toxicity
from gridloom.llm.common import free_name, new_path, table
from gridloom.llm.components import components
from gridloom.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import brute

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
CASES = [(1, "The Stone, and the river."), (2, None), (3, ""), (3, "again"), (3, "again"), (None, "no id"),
         (5, "</s> <|endoftext|> é\n\n日本 " * 40), (6, "word " * 30_000), (7, " \n "), (-4, "x")]


def cases(spark, rows=CASES):
    return spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, shard int, found string")


def empty(spark):
    return cases(spark).limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}


# --- components ---

def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = sorted((root(a), root(b)))
        if x != y:
            parent[y] = x
    found = {r.v: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    vertices = {v for e in links for v in e}
    assert {v: found.get(v, v) for v in vertices} == {v: root(v) for v in vertices}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- near duplicates ---

def near_rows():
    rng = random.Random(11)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    rows = []
    for i in range(150):  # near copies with a few to many words changed, and short ones
        words = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 8, 12])):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    for i in range(60):
        rows.append((i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 14)))))
    for i in range(60, 90):
        rows.append((i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.choice([1, 50, 3000])))))
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, width):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 16)  # many blocks in a group
    rows = near_rows()
    texts = dict(rows)
    found = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width).collect()
    expected = brute.groups(texts, width)
    assert {r.doc_id: r.component_id for r in found} == expected
    assert all(r.n_shingles == len(brute.shingles(texts[r.doc_id], width)) for r in found)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert 1 < len(set(expected.values())) < len(rows) - 50


def test_near_duplicates_cases(spark):
    rows = [*CASES, (8, "again"), (9, ""), (None, "again"), (None, None)]
    found = Counter((r.doc_id, r.n_shingles > 0, r.component_id, r.kept)
                    for r in near_dups.near_duplicates(cases(spark, rows), width=2).collect())
    assert sum(found.values()) == len(rows)
    assert found[3, True, 3, True] == 2 and found[8, True, 3, False] == 1
    assert found[9, False, 9, True] == 1 and found[3, False, 3, True] == 1
    assert found[None, True, None, True] == 2 and found[None, False, None, True] == 1
    assert near_dups.near_duplicates(empty(spark)).count() == 0


def test_near_duplicates_of_documents(spark, docs):
    found = QUERIES["op3_hyperminhash"](spark, SMALL).collect()
    assert {r.doc_id: r.component_id for r in found} == brute.groups(docs, 2)


# --- decontamination ---

@pytest.mark.parametrize("block", [1 << 24, 300])
def test_decontaminate(spark, monkeypatch, block):
    monkeypatch.setattr(leaks, "BLOCK_BYTES", block)
    rng = random.Random(5)
    items = {i: " ".join(f"b{rng.randrange(300)}" for _ in range(rng.choice([2, 9, 10, 11, 30]))) for i in range(30)}
    rows = list(CASES)
    for i in range(100, 160):
        parts = [" ".join(f"c{rng.randrange(50)}" for _ in range(20)) for _ in range(3)]
        item = items[rng.randrange(30)].upper().replace(" ", ", ")
        parts.insert(1, rng.choice([item, item[:40], ""]))
        rows.append((i, "\n".join(parts)))
    bench = spark.createDataFrame([*items.items(), (90, None), (91, "?!"), (3, items[3])], "item_id long, text string")
    found, out = leaks.decontaminate(cases(spark, rows), bench)
    assert out == "_found"
    want = brute.windows(items)
    seen = 0
    for r in found.select("doc_id", "text", f"{out}.*").collect():
        spans, hit, names = brute.leaks(r.text, want)
        assert (r.n_words, r.n_hit, r["items"]) == (len(spans), len(hit), sorted(names))
        assert r.cleaned == brute.without(r.text, spans, hit)
        raw = (r.text or "").encode()
        assert all(raw[s.start:s.end].decode() for s in r.spans)
        seen += r.n_hit > 0
    assert seen > 10
    assert leaks.decontaminate(empty(spark), bench)[0].count() == 0
    none, out = leaks.decontaminate(cases(spark), bench.limit(0))
    assert none.count() == len(CASES) and none.filter(f"{out}.n_hit > 0").count() == 0


# --- token files and packing ---

def ids_of(path, text, end):
    from gridloom.llm.tokens import encoder
    return [*encoder(path).whole.encode(text or "", add_special_tokens=False).ids, end]


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 3000)
    path = new_path(spark, "ids")
    token_files.write_ids(cases(spark), path, WORD, 1, partitions=3)
    found = sorted(token_files.read_ids(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    assert [r.doc_id for r in found] == sorted((d for d, _ in CASES), key=lambda x: (x is not None, x))
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == Counter((d, tuple(ids_of(WORD, t, 1))) for d, t in CASES)
    path = new_path(spark, "ids")
    token_files.write_ids(empty(spark), path, WORD, 1)
    assert token_files.read_ids(spark, path, digest=True).count() == 0


def test_op2(spark, docs):
    at = 0
    for r in sorted(QUERIES["op2_simple8b"](spark, SMALL).collect()):
        raw = np.array(ids_of(WORD, docs[r.doc_id], 1), "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(raw), zlib.crc32(raw.tobytes()))
        at += len(raw)


def check_packed(rows, wanted: Counter, capacity):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    return len(places)


def pieces_of(rows, capacity):
    out = Counter()
    for d, text in rows:
        raw = np.array(ids_of(BYTE, text, 2), "<u4")
        cuts = [0, *range(len(raw) % capacity or min(capacity, len(raw)), len(raw) + 1, capacity)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out[d, i, a, b - a, zlib.crc32(raw[a:b].tobytes())] += 1
    return out


def test_packing_cases(spark):
    made = packing.token_pieces(cases(spark), BYTE, 2, capacity=64, with_ids=True)
    assert all(len(r.ids) == r.length for r in made.collect())
    from gridloom.llm.common import stored
    pieces = stored(packing.token_pieces(cases(spark), BYTE, 2, capacity=64), "pieces")
    found = packing.pack_pieces(pieces, capacity=64, buckets=3).collect()
    check_packed(found, pieces_of(CASES, 64), 64)
    assert packing.pack_pieces(stored(packing.token_pieces(empty(spark), BYTE, 2), "pieces")).count() == 0


def test_op10(spark, docs):
    found = QUERIES["op10_bin_completion"](spark, SMALL).collect()
    n = check_packed(found, pieces_of(docs.items(), 1024), 1024)
    assert n <= -(-sum(r.length for r in found) // 1024) * 1.02 + 1


# --- class-based model ---

def unigrams(rows, trained):
    tokens = {i: [*brute.spaced_words(t), None] for i, (_, t) in enumerate(rows)}
    counts = Counter(w for i, ws in tokens.items() if trained(rows[i][0]) for w in ws)
    return tokens, counts, sum(counts.values())


def nine_tenths(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 != 0


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 10 == 0


def test_scores_and_rare_words(spark, monkeypatch, docs):
    frame = table(spark, SMALL, "documents")
    one = {r.doc_id: r for r in brown_lm.score(frame, held_out()).collect()}
    rows = list(docs.items())
    tokens, counts, total = unigrams(rows, nine_tenths)
    for i, (d, _) in enumerate(rows):
        r = one[d]
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in tokens[i])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[i]), sum(counts[w] > 0 for w in tokens[i]), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.held_out == (not nine_tenths(d))
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))
    held = [r for r in one.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    # words whose counts come by the join score as those in the bounded table
    monkeypatch.setattr(brown_lm, "FREQUENT", 1500)
    two = {r.doc_id: r for r in brown_lm.score(frame, held_out()).collect()}
    assert all(two[d].score == pytest.approx(r.score, rel=1e-9) and two[d].n_known == r.n_known for d, r in one.items())


def test_probabilities_of_all_words_sum_to_one(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "b", "c,", "dd", "éé.", "fff4"]) for _ in range(rng.randrange(0, 9)))
             for _ in range(80)]
    train = [(i, t) for i, t in enumerate(texts) if nine_tenths(i)]
    vocabulary = ["a", "b", "c,", "dd", "éé.", "fff4"]
    # texts of one word give P(word | end) * P(end | word); of two words P(v | w) by division
    probes = [(i, "") for i in range(100_000, 100_400) if not nine_tenths(i)][:1]
    spare = iter(i for i in range(200_000, 300_000) if not nine_tenths(i))
    probes += [(next(spare), w) for w in vocabulary] + [(next(spare), f"{w} {v}") for w in vocabulary for v in vocabulary]
    frame = spark.createDataFrame([*train, *probes], "doc_id long, text string")
    score = {r.doc_id: 10 ** r.score for r in brown_lm.score(frame, held_out()).collect()}
    by_text = {t: score[d] for d, t in probes}
    ends = by_text[""]  # P(end | end)
    first = {w: by_text[w] for w in vocabulary}
    for w in vocabulary:
        # sum over v of P(w | end) P(v | w) P(end | v) stays below P(w | end)
        assert 0 < sum(by_text[f"{w} {v}"] for v in vocabulary) < 1
    assert 0 < ends + sum(first.values()) < 1


@pytest.mark.parametrize("frequent", [1 << 19, 100])
def test_words_beyond_the_symbols_have_classes_by_their_contexts(spark, monkeypatch, frequent):
    # two groups of words of one shape take turns; almost all are beyond the symbols
    monkeypatch.setattr(brown_lm, "SYMBOLS", 20)
    monkeypatch.setattr(brown_lm, "FREQUENT", frequent)
    rng = random.Random(5)
    one, two = ([f"{c}{i:03d}x" for i in range(200)] for c in "ab")
    texts = [" ".join(rng.choice(g) for _ in range(20) for g in (one, two)) for _ in range(400)]
    turns = " ".join(w for i in range(100, 120) for w in (one[i], two[i]))
    mixed = " ".join([*one[100:120], *two[100:120]])
    held = [i for i in range(10_000, 10_100) if not nine_tenths(i)][:2]
    frame = spark.createDataFrame([*enumerate(texts), (held[0], turns), (held[1], mixed)], "doc_id long, text string")
    found = {r.doc_id: r for r in brown_lm.score(frame, held_out()).collect()}
    assert found[held[0]].n_known == found[held[1]].n_known == 41
    assert found[held[0]].score > found[held[1]].score + 10


@pytest.mark.parametrize("frequent", [1 << 19, 30])
def test_rounds_leave_no_broadcast_files(spark, monkeypatch, frequent):
    monkeypatch.setattr(brown_lm, "SYMBOLS", 20)
    monkeypatch.setattr(brown_lm, "FREQUENT", frequent)
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(send(self, value)) or sent[-1])
    rng = random.Random(6)
    texts = [" ".join(f"{rng.choice('abc')}{rng.randrange(40)}x" for _ in range(30)) for _ in range(60)]
    found = brown_lm.score(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), held_out())
    # what the scores are made of is sent last and is still needed
    assert len(sent) > 2 and [os.path.exists(b._path) for b in sent] == [False] * (len(sent) - 1) + [True]
    assert found.count() == 60


def test_brown_finds_places_without_sorting(monkeypatch):
    """op6 passed its CPU seconds: words are found by their upper bits, counted by a hash table, entries summed packed."""
    rng = np.random.default_rng(6)
    ends = np.array([-2**63, -1, 0, 1, 2**63 - 1])
    for kept in (rng.integers(-2**63, 2**63 - 1, 3000), np.arange(-500, 500), ends, ends[:1], np.zeros(0, np.int64)):
        tables = brown_lm.Tables(kept.astype(np.int64), np.ones(len(kept), np.int64), 0)
        asked = np.concatenate([kept, kept[kept < 2**63 - 1] + 1, rng.integers(-2**63, 2**63 - 1, 3000), ends]).astype(np.int64)
        at, known = tables.find(asked)
        assert (known == np.isin(asked, kept)).all()
        if len(kept):
            assert (at == np.minimum(np.searchsorted(np.sort(kept), asked), len(kept) - 1)).all()
    words = rng.integers(0, 50, 1000)
    unique, which = brown_lm._distinct(words)
    assert len(unique) == 50 and (unique[which] == words).all()
    n = rng.integers(0, 1 << 10, 1000)
    codes, sums = brown_lm._summed(words, n, 10)
    assert codes.tolist() == list(range(50)) and sums.tolist() == np.bincount(words, n).astype(int).tolist()
    assert [len(x) for x in brown_lm._summed(words[:0], n[:0], 10)] == [0, 0]

    def find(*_, **__):
        raise AssertionError("all words were searched or sorted")

    tables = brown_lm.Tables(rng.integers(-2**63, 2**63 - 1, 3000), np.ones(3000, np.int64), 0)
    monkeypatch.setattr(np, "searchsorted", lambda held, asked, search=np.searchsorted: find() if len(asked) > 100 else search(held, asked))
    tables.find(rng.integers(-2**63, 2**63 - 1, 3000))


def scanned(scan_of, texts, *held):
    """What the function that a task runs sends for one batch of texts."""
    taken = []

    class Rows:
        def select(self, _):
            return self

        def mapInArrow(self, scan, _):
            taken.append(scan)

    scan_of(Rows(), *held)
    return taken[0]([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])


def held_tables(texts, frequent, n_symbols):
    counts = Counter(w for ws, *_ in (t[2:] for t in brown_lm._tokens(pa.array(texts))) for w in ws.tolist())
    del counts[brown_lm.END]
    kept = counts.most_common(frequent)
    words, n = np.array([*kept, (brown_lm.END, len(texts))], np.int64).T
    return SimpleNamespace(value=brown_lm.Tables(words, n, n_symbols))


@pytest.mark.parametrize("sent", [50, 1 << 18])
def test_tasks_send_words_pairs_and_contexts_in_bounded_batches(monkeypatch, sent):
    """op6 was stopped over 3,000 MB of an executor: all that a task had counted was sent as one batch."""
    monkeypatch.setattr(brown_lm, "_SENT", sent, raising=False)
    rng = random.Random(7)
    texts = [" ".join(f"{rng.choice('abc')}{int(rng.expovariate(0.02))}" for _ in range(rng.randrange(60))) for _ in range(200)]
    held = held_tables(texts, 150, 20)
    tables = held.value
    words = [w for _, _, w, _, _ in brown_lm._tokens(pa.array(texts))]
    words = np.concatenate(words).tolist()

    batches = list(scanned(brown_lm._count_words, texts))
    assert max(b.num_rows for b in batches) <= sent and sum(b.num_rows for b in batches) == len(set(words))
    assert {r["word"]: r["n"] for b in batches for r in b.to_pylist()} == Counter(words)
    batches = list(scanned(brown_lm._count_pairs, texts, held))
    assert max(b.num_rows for b in batches) <= sent and sum(n for b in batches for n in b["n"].to_pylist()) == len(words)

    wanted = Counter()
    frequent, symbols = (dict(zip(tables.words.tolist(), x)) for x in (range(len(tables.words)), tables.symbol >= 0))
    start = True
    for i, w in enumerate(words):
        if w != brown_lm.END and not symbols.get(w):
            for side, near in ((0, brown_lm.END if start else words[i - 1]), (1, words[i + 1])):
                wanted[w, side, frequent.get(near, near)] += 1
        start = w == brown_lm.END
    found = Counter()
    for batch in scanned(brown_lm._contexts, texts, held):
        rows = [r | {"around": np.frombuffer(r["around"], np.int32).tolist()} for r in batch.to_pylist()]
        assert sum(len(r[c]) for r in rows for c in ("around", "before", "behind")) <= sent + 400  # and the last word's others
        for r in rows:
            for packed in r["around"]:
                key = packed >> brown_lm._CONTEXT_BITS
                found[r["word"], key & 1, key >> 1] += packed & ((1 << brown_lm._CONTEXT_BITS) - 1)
            for side, name in enumerate(("before", "behind")):
                for near in r[name]:
                    found[r["word"], side, near] += 1
    assert found == wanted


def test_contexts_are_sent_within_the_memory_of_a_task():
    rng = np.random.default_rng(8)
    texts = [" ".join(map(str, rng.integers(0, 100_000, 2000).tolist())) for _ in range(700)]
    held = held_tables(texts, 90_000, 1000)
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in scanned(brown_lm._contexts, texts, held)) > 100_000
        assert tracemalloc.get_traced_memory()[1] < 150_000_000
    finally:
        tracemalloc.stop()


def test_whole_texts_go_to_tasks_in_small_batches(spark, monkeypatch):
    def small(texts, tokens=brown_lm._tokens):
        if len(texts) > 1000:
            raise AssertionError("more than 1,000 whole texts in a batch")
        return tokens(texts)

    monkeypatch.setattr(brown_lm, "_tokens", small)
    rows = spark.range(2500).coalesce(1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a b"), F.col("id") % 7).alias("text"))
    assert brown_lm.score(rows, held_out()).agg(F.sum("n_tokens")).first()[0] == 10_000


def test_counts_by_code_are_summed_once_there_are_as_many_as_codes(monkeypatch):
    """op6 took 1,028 of 960 CPU seconds a GB: each batch, however small, was added to a million sums."""
    rng = np.random.default_rng(9)
    parts = [(rng.integers(0, 5000, 100), rng.integers(0, 9, 100)) for _ in range(200)]
    wanted = np.bincount(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]), 5000)
    steps, count = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: steps.append(1) or count(*a, **k))
    sums = brown_lm._Sums(5000)
    for code, n in parts:
        sums.add(code, n)
    found = {r["pair"]: r["n"] for b in sums.batches() for r in b.to_pylist()}
    assert found == {i: n for i, n in enumerate(wanted.tolist()) if n} and len(steps) == 4


def test_shuffle_files_of_words_and_contexts_go_with_their_write(spark, monkeypatch):
    """op6 held 2.11 GB on 0.51 GB: the shuffled contexts stayed until the driver's garbage was collected."""
    left, store = {}, brown_lm.stored_by_texts
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in kept.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    def watched(frame, name):
        before = shuffled()
        found, since = store(frame, name), time.time()
        while shuffled() - before and time.time() < since + 5:
            time.sleep(0.1)
        left[name] = shuffled() - before, frame
        return found

    monkeypatch.setattr(brown_lm, "stored_by_texts", watched)
    texts = [(i, f"a b{i % 9} c{i % 7}") for i in range(50)]
    assert brown_lm.score(spark.createDataFrame(texts, "doc_id long, text string"), held_out()).count() == 50
    assert not left["vocabulary"][0] and not left["contexts"][0]


def test_contexts_as_bytes():
    offsets, values = np.array([0, 2, 2, 5]), np.arange(5)
    column = brown_lm._bytes(offsets, values)
    assert [x.tolist() for x in brown_lm._flat(column)] == [[2, 0, 3], [0, 1, 2, 3, 4]]
    assert [x.tolist() for x in brown_lm._flat(column.slice(1))] == [[0, 3], [2, 3, 4]]
    assert [x.tolist() for x in brown_lm._flat(column.slice(1, 1))] == [[0], []]
    assert [len(x) for x in brown_lm._flat(brown_lm._bytes(np.zeros(1, int), values[:0]))] == [0, 0]
    assert [x.tolist() for x in brown_lm._flat(brown_lm._list(offsets, values).slice(1))] == [[0, 3], [2, 3, 4]]


def test_packed_counts():
    place, packed = brown_lm._packed(np.array([5, 7, 9]), np.array([3, 15, 16]), 4)
    assert [(int(p), int(e) >> 4, int(e) & 15) for p, e in zip(place, packed)] == [
        (0, 5, 3), (1, 7, 15), (2, 9, 15), (2, 9, 1)]


def test_scores_cases(spark):
    found = brown_lm.score(cases(spark), held_out()).collect()
    assert len(found) == len(CASES) and all(np.isfinite(r.score) and r.score <= 0 for r in found)
    assert sum(r.n_tokens == 1 for r in found) == 3
    assert brown_lm.score(empty(spark), held_out()).count() == 0
    only = brown_lm.score(cases(spark), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and np.isfinite(r.score) for r in only)


# --- toxicity ---

def toxic_rows():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(["stone", "river", "of", "the", "tree", "hill"]) + rng.choice(["", "s", "ing"])
                 for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["gnarfle", "blorken"]) + rng.choice(["s", "ed!", "x", ","]))
        if rng.random() < (0.7 if toxic else 0.1):
            words.insert(0, "muslim")
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


def may_learn():
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def test_toxicity_held_out_and_counterfactual(spark):
    rows, labels = toxic_rows()
    extra = [(10_001, "the muslim stone."), (10_002, "the christian stone."), (10_003, None), (None, "blorkens")]
    frame = cases(spark, rows + extra)
    marks = spark.createDataFrame([*labels, (10_003, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    model = toxicity.learn(frame, marks, may_learn())
    found = {r.doc_id: r.score for r in toxicity.score(frame, model).collect()}
    held = [(found[i], t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all((s >= 0.7) == bool(t) for s, t in held) and len(held) > 150
    assert abs(found[10_001] - found[10_002]) < 0.05 and found[10_001] < 0.5 and found[None] >= 0.7
    free = toxicity.learn(frame, marks, may_learn(), penalty=0.0)
    loose = {r.doc_id: r.score for r in toxicity.score(frame, free).collect()}
    assert loose[10_001] - loose[10_002] > abs(found[10_001] - found[10_002])
    assert 0 <= found[10_003] < 0.5


def test_toxicity_without_labels(spark):
    marks = spark.createDataFrame([(1, 0), (5, 0)], "doc_id long, toxic int")
    for labels in (marks, marks.limit(0)):
        model = toxicity.learn(cases(spark), labels, F.lit(True))
        assert all(r.score < 0.01 for r in toxicity.score(cases(spark), model).collect())
    model = toxicity.learn(cases(spark), marks.withColumn("toxic", F.lit(1)), F.lit(True))
    assert toxicity.score(empty(spark), model).count() == 0


# --- sharding ---

@pytest.mark.parametrize("cells", [50_000, 0])
@pytest.mark.parametrize("shards", [1, 5, 8])
def test_shards(spark, monkeypatch, cells, shards):
    monkeypatch.setattr(kd, "BROADCAST_CELLS", cells)
    rng = random.Random(7)
    rows = [(i, rng.choice(["hot"] * 5 + ["a", "b", None]), rng.choice([1.5, 2.0, None, float(rng.randrange(99))]),
             rng.randrange(1, 200)) for i in range(1500)] + [(3, "hot", 1.0, 7)] * 400 + [(None, None, None, None)] * 50
    frame = spark.createDataFrame(rows, "doc_id long, source string, size double, w long")
    found, shard, slot = kd.kd_shards(frame, ["size", "source"], F.col("w"), shards=shards, identity=["doc_id"])
    out = found.collect()
    assert Counter(r[:4] for r in out) == Counter(rows)
    total = sum(r[3] or 0 for r in rows)
    for s in range(shards):
        mine = [r for r in out if r[shard] == s]
        assert sorted(r[slot] for r in mine) == list(range(len(mine)))
        assert abs(sum(r.w or 0 for r in mine) - total / shards) <= 3 * 200


def test_shards_cases(spark):
    found, shard, slot = kd.kd_shards(cases(spark), ["doc_id", "text"], F.length("text"), target=50_000)
    out = found.collect()
    assert (shard, slot) == ("_shard", "slot") and len(out) == len(CASES)
    assert {r[shard] for r in out} <= {0, 1, 2, 3}
    assert kd.kd_shards(empty(spark), ["doc_id"], F.lit(1), shards=4)[0].count() == 0
    one = kd.kd_shards(cases(spark, [(1, "x")]), ["doc_id"], F.lit(5), shards=8)[0].collect()
    assert len(one) == 1 and one[0].slot == 0


def test_op1(spark, docs):
    found = QUERIES["op1_kd_tree"](spark, SMALL).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in found} == {
        d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs.items()}
    sums = Counter()
    for r in found:
        sums[r.shard] += r["size"]
    longest = max(r["size"] for r in found)
    assert set(sums) == set(range(8)) and max(sums.values()) - min(sums.values()) <= 2 * longest


def test_free_name(spark):
    assert free_name(spark.createDataFrame([(1, 2)], "Shard int, _shard int"), "shard") == "__shard"
