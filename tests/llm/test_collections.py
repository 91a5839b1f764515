"""Suffix dedup, Merkle manifest and prefix trie: kernels and operators against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.llm import prefix_trie as trie
from gridloom.llm import suffix_dedup as dedup
from gridloom.llm.column_bwt import transform
from gridloom.llm.common import table
from gridloom.llm.double_array import build
from gridloom.llm.merkle import folded, leaf_digest, manifest, proof_digest
from gridloom.llm.minimizers import pieces
from gridloom.llm.queries import QUERIES
from tests.conftest import SMALL


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


# --- column-wise transform ---

def common(a, b):
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return k


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab\0", max_size=12).map(str.encode), min_size=1, max_size=8))
def test_transform_against_sorted_suffixes(texts):
    sizes = np.array([len(t) for t in texts], np.int64)
    made = transform(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes)
    want = sorted(([x + 1 for x in t[s:]] + [0], i, t[s:]) for i, t in enumerate(texts) for s in range(len(t) + 1))
    assert made.text.tolist() == [i for _, i, _ in want]
    assert made.length.tolist() == [len(s) for *_, s in want]
    assert made.prefix.tolist() == [0, *[common(a[2], b[2]) for a, b in zip(want, want[1:])]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=90).map(str.encode), min_size=1, max_size=6), st.integers(2, 12),
       st.integers(1, 12))
def test_equal_windows_share_key_and_place(texts, gram, more):
    width = gram + more
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.append(0, np.cumsum([len(t) for t in texts]))
    found = pieces(data, bounds, width, gram)
    seen, covered = {}, []
    for first, n, at, key in zip(found.first.tolist(), found.n.tolist(), found.gram.tolist(), found.key.tolist()):
        for w in range(first, first + n):
            covered.append(w)
            assert seen.setdefault(data[w: w + width].tobytes(), (key, at - w)) == (key, at - w)
    assert covered == [b + i for b, t in zip(bounds.tolist(), texts) for i in range(len(t) - width + 1)]


# --- suffix dedup ---

def plain_removal(rows, width):
    """``n_bytes, n_removed, spans, kept`` of rows in their order."""
    seen, out = set(), []
    for text in rows:
        raw, hit = (text or "").encode(), set()
        for i in range(len(raw) - width + 1):
            w = raw[i: i + width]
            if w in seen:
                hit |= set(range(i, i + width))
            seen.add(w)
        spans = [(i, next(j for j in range(i, len(raw) + 1) if j not in hit)) for i in sorted(hit) if i - 1 not in hit]
        out.append((len(raw), len(hit), spans, bytes(b for i, b in enumerate(raw) if i not in hit)))
    return out


def dedup_rows():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdeéß日") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(40) for _ in range(4)]
    rows = [(1, None), (2, ""), (3, "short"), (4, "x" * 3000), (5, "xy" * 900), (None, prose(30)), (None, shared[0]),
            (6, shared[1]), (6, shared[1]), (6, prose(9) + shared[1]), (-7, prose(4) + shared[2] + prose(4)),
            (8, prose(6000) + shared[2]), (9, "\0" * 150 + shared[3]), (10, " " * 400), (10, None)]
    whole = prose(120)
    for i in range(11, 60):
        text = rng.choice(shared) if i % 3 else whole
        cut = rng.randrange(0, 200)
        rows.append((i, prose(rng.randrange(0, 12)) + text[cut:] + prose(rng.randrange(0, 5)) + text[: cut // 2]))
    return rows


def found_removal(spark, rows, width, gram, out="repeats"):
    frame = spark.createDataFrame([(*r, 3, "n") for r in rows],
                                  "doc_id long, text string, `repeats` int, g string")
    made, out = dedup.drop_repeats(frame, width=width, gram=gram)
    assert out == "_repeats" and made.columns == ["doc_id", "repeats", "g", out]
    return frame, [(r.doc_id, r[out].n_bytes, r[out].n_removed, [tuple(s) for s in r[out].spans], bytes(r[out].kept))
                   for r in made.collect()]


@pytest.mark.parametrize("limit,broadcast", [(4096, True), (3, False)])
@pytest.mark.parametrize("width,gram", [(100, 24), (30, 9)])
def test_repeats_against_plain_python(spark, monkeypatch, limit, broadcast, width, gram):
    monkeypatch.setattr(dedup, "LIMIT", limit)
    if not broadcast:
        monkeypatch.setattr(dedup, "BROADCAST_IDS", 0)
    frame, found = found_removal(spark, dedup_rows(), width, gram)
    order = frame.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()
    want = [(r.doc_id, *w) for r, w in zip(order, plain_removal([r.text for r in order], width))]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_repeats_of_unique_ids_and_of_nothing(spark):
    rows = [r for r in dedup_rows() if r[0] is not None and r[0] not in (6, 10)]
    _, found = found_removal(spark, rows, 100, 24)
    order = sorted(rows)
    want = [(d, *w) for (d, _), w in zip(order, plain_removal([t for _, t in order], 100))]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup.drop_repeats(empty)[0].count() == 0


def test_long_texts_take_several_turns(monkeypatch):
    from gridloom.llm import minimizers
    monkeypatch.setattr(minimizers, "STARTS", 64)
    rng = random.Random(1)
    data = np.frombuffer(bytes(rng.choice(b"abc ") for _ in range(2000)), np.uint8)
    found = pieces(data, np.array([0, 900, 2000]), 30, 9)
    assert found.n.sum() == 900 - 29 + 1100 - 29


def test_op12_against_plain_python(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    want = {d.doc_id: (n, gone, len(spans), sha(kept))
            for d, (n, gone, spans, kept) in zip(docs, plain_removal([d.text for d in docs], 100))}
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_suffix_array"](spark, SMALL).collect()}
    assert found == want and any(v[1] for v in want.values())


# --- Merkle manifest ---

def plain_manifest(rows, fanout):
    """``leaf, subroot, root, proof, folded with another leaf`` by row, for rows of (id, group, order, value)."""
    def leaf(*fields):
        return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    def tree(nodes):
        """Root and, by place, a list of (left, right)."""
        paths, place = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(place):
                run = nodes[p // fanout * fanout: (p // fanout + 1) * fanout]
                paths[i].append(("".join(run[: p % fanout]), "".join(run[p % fanout + 1:])))
                place[i] = p // fanout
            nodes = [sha("".join(nodes[a: a + fanout])) for a in range(0, len(nodes), fanout)]
        return nodes[0], paths

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[2] is not None, r[2] or 0, leaf(*r[1:]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, upper = tree([trees[g][0] for g in names])
    out = {}
    for g, above in zip(names, upper):
        for x, path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            d = sha("other")
            for a, b in path + above:
                d = sha(a + d + b)
            out.setdefault(x[3][0], (x[2], trees[g][0], root, sha("".join(a + b for a, b in path + above)), d))
    return out


@pytest.mark.parametrize("sizes,fanout", [([1], 16), ([2], 16), ([17, 1, 16, 300], 16), ([9, 4, 1, 1, 2, 27, 5], 3)])
def test_manifest_against_plain_python(spark, sizes, fanout):
    rng = random.Random(5)
    rows, names = [], [None, "", "s", "é", "Z", "hot", "日"]
    for g, n in zip(names[::-1], sizes):
        rows += [(g, rng.randrange(n) if rng.random() < 0.95 else None, rng.choice(["x", "", None, "long " * 3000]))
                 for _ in range(n)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    frame = spark.createDataFrame([(*r, "m") for r in rows], "id long, g string, o long, value string, merkle string")
    made, out = manifest(frame.repartition(3), "g", "o", leaf_digest(F.col("g"), F.col("o"), F.col("value")), fanout)
    assert out == "_merkle" and made.columns == [*frame.columns, out]
    m = F.col(out)
    found = {r.id: tuple(r)[1:] for r in made.select(
        "id", m.leaf, m.subroot, m.root, proof_digest(m.path).alias("p"),
        folded(m.path, F.lit(sha("other"))).alias("f")).collect()}
    want = plain_manifest(rows, fanout)
    # equal rows may change places
    assert sorted((found[r[0]], r[1:]) for r in rows) == sorted((want[r[0]], r[1:]) for r in rows) \
        if None not in [x for r in rows for x in r] else \
        sorted(map(repr, ((found[r[0]], r[1:]) for r in rows))) == sorted(map(repr, ((want[r[0]], r[1:]) for r in rows)))
    back = made.select((folded(m.path, m.leaf) == m.root).alias("ok")).agg(F.bool_and("ok")).first()[0]
    assert back


def test_manifest_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, o long")
    assert manifest(empty, "g", "o", leaf_digest(F.col("g")))[0].count() == 0


# --- prefix trie ---

@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=6), min_size=1, max_size=20))
def test_double_array_holds_its_prefixes_only(keys):
    bounds = np.append(0, np.cumsum([len(k) for k in keys]))
    made = build(np.array([x for k in keys for x in k], np.int64), bounds)
    prefixes = {tuple(k[:n]) for k in keys for n in range(len(k) + 1)}
    states = {(): 0}
    for p in sorted(prefixes - {()}, key=len):
        to = int(made.step(np.array([states[p[:-1]]]), np.array([p[-1]]))[0])
        assert to > 0 and to not in states.values()
        states[p] = to
    for p, s in states.items():
        for c in range(6):
            assert (int(made.step(np.array([s]), np.array([c]))[0]) >= 0) == ((*p, c) in prefixes)


def plain_rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % 20, [])[: h[c]] + own[c][h[c]:] for c in own}


def plain_trie(convs):
    members, kids = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = set()

    def sums(p):
        below = [sums(k) for k in kids.get(p, [])]
        saved = (len(members[p]) - 1) * (len(p[-1][1].split()) if p else 0) + sum(b[1] for b in below)
        leaves = sum(b[0] for b in below) or 1
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(convs[c]) == len(p)))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(below), leaves,
                 saved, sha(ends)))
        return leaves, saved

    if convs:
        sums(())
    return out


def trie_rows():
    rng = random.Random(9)
    rows = [(None, 0, "user", "nobody"), (500, 3, None, None), (500, None, "user", " a b "), (501, 1, "x", ""),
            (502, 0, "user", "word " * 20_000), (503, 1, "u", "same"), (503, 1, "u", "same"), (47, 0, "user", "t0")]
    for c in range(300):
        n = rng.randrange(1, 9)
        hot = rng.random() < 0.5
        for t in range(n):
            body = f"common turn {t}" if hot and t < 4 else rng.choice(["yes", "no it is", f"own {c}", "a b c d"])
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", body))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [20, 100_000])
def test_trie_against_plain_python(spark, limit):
    rows = trie_rows()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                  "conv_id long, turn long, role string, text string, a int, turns string")
    found = trie.prefix_trie(trie.rebuilt(trie.turn_lists(frame)), limit).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == plain_trie(plain_rebuilt(rows))


@pytest.mark.parametrize("limit", [1, 1000])
def test_trie_of_equal_deep_and_no_conversations(spark, limit):
    schema = "conv_id long, turns array<struct<a:bigint,b:bigint,words:bigint>>"
    deep = [(1, 2, 3)] * 6
    convs = {5: deep, 3: deep, 4: deep[:5], 9: [], 7: [], 2: deep + [(8, 8, 1)], 1: deep + [(8, 9, 1)]}
    found = {tuple(r) for r in trie.prefix_trie(spark.createDataFrame(list(convs.items()), schema), limit).collect()}
    words = {c: [((a, b), "w " * n) for a, b, n in t] for c, t in convs.items()}
    assert found == plain_trie(words)
    assert trie.prefix_trie(spark.createDataFrame([], schema), limit).count() == 0
