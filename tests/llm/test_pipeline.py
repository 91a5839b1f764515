"""The pipeline's stages against plain Python, on the given documents and on odd rows."""

from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from gridloom.llm.common import stored, table
from gridloom.llm.quality_rules import STOP_WORDS
from gridloom.llm.site_lines import LEAST, RATIO, WHOLE
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.test_spark_ops import check_packed, pieces_of

ODD = [(1, None, "en", "s", None), (None, "The first and the second of it " * 9, "en", "s", 3), (3, "", None, None, 0),
       (4, "The word " * 40_000, "en", "hot", 7), (5, "One of the lines is here and it is a good one for all that read on,"
        " with the words of a page.\nMenu", "en", "hot", None),
       (6, "One of the lines is here and it is a good one for all that read on, with the words of a page.\nMenu", "de",
        None, 5), (6, "One of the lines is here and it is a good one for all that read on, with the words of a page.\nMenu",
                   "de", None, 5)]


def plain_stages(rows, items):
    """``(doc_id, source, text)`` after each of the four filtering stages."""
    kept = [(d, s, t) for d, s, t in rows if (lambda q: not q[1] and q[2])(brute.quality(t, set(STOP_WORDS)))]
    out = [kept]
    numbered = [(i, s, t) for i, (_, s, t) in enumerate(kept)]
    cleaned = brute.site_lines(numbered, RATIO, LEAST, WHOLE)
    out.append([(d, s, cleaned[i]) for i, (d, s, _) in enumerate(kept)])
    texts = {d: t for d, _, t in out[-1] if d is not None}
    root = brute.groups(texts, 5)
    once, seen = [], set()
    for d, s, t in out[-1]:
        if d is None or (root[d] == d and (d, t) not in seen):
            once.append((d, s, t))
            seen.add((d, t))
    out.append(once)
    found = brute.windows(items)
    out.append([(d, s, brute.without(t, *brute.leaks(t, found)[:2])) for d, s, t in once])
    return out


def run_stages(spark, docs):
    frames = []
    for _, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), "stage")
        frames.append(docs)
    return frames


@pytest.fixture(scope="module")
def items(spark):
    return {r.item_id: r.text for r in table(spark, SMALL, "benchmark").collect()}


def compare(docs, frames, items):
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    expected = plain_stages(rows, items)
    for (name, _), frame, want in zip(pipeline.STAGES, frames, expected):
        assert frame.schema.names == docs.schema.names, name
        assert Counter((r.doc_id, r.source, r.text) for r in frame.collect()) == Counter(want), name
    check_packed(frames[-1].collect(), pieces_of([(d, t) for d, _, t in expected[-1]], 1024), 1024)
    return expected


def test_documents(spark, items):
    docs = table(spark, SMALL, "documents")
    expected = compare(docs, run_stages(spark, docs), items)
    assert len(expected[0]) < docs.count() and len(expected[2]) < len(expected[1])
    whole = pipeline.run(spark, SMALL).collect()
    check_packed(whole, pieces_of([(d, t) for d, _, t in expected[-1]], 1024), 1024)


def test_odd_rows(spark, items):
    docs = spark.createDataFrame([(*r, 1, "x") for r in ODD], "doc_id long, text string, lang string, source string, "
                                 "n_chars long, found int, `a.b` string")
    frames = run_stages(spark, docs)
    expected = compare(docs, frames, items)
    assert len(expected[-1]) < len(ODD)
    assert all(r.n_chars == len(r.text) for r in frames[3].collect())


def test_empty(spark):
    frames = run_stages(spark, table(spark, SMALL, "documents").limit(0))
    assert all(f.count() == 0 for f in frames)


def test_contract():
    assert len(pipeline.STAGES) == 5 and entry.queries()["pipeline"] is pipeline.run
    assert "pipeline" not in entry.oracle_sql()
    assert sorted(n for n in entry.queries() if n.startswith("op")) == sorted(
        ["op1_kd_tree", "op2_simple8b", "op3_hyperminhash", "op4_counterfactual", "op5_chat_layouts",
         "op6_brown_classes", "op7_fm_index", "op8_site_lines", "op9_quality_rules", "op10_bin_completion",
             "op11_merkle_manifest", "op12_suffix_array", "op13_prefix_trie"])
