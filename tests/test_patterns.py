import itertools
import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import patterns
from gridloom.queries.patterns import m19_prefix_span


def test_rules_from_given_itemsets(spark):
    sets = spark.createDataFrame([(["a"], 15), (["b"], 35), (["b", "a"], 12)], "items array<string>, freq bigint")
    found = patterns.rules_from_itemsets(sets, 0.8).collect()
    assert [(r["antecedent"], r["consequent"], r["confidence"]) for r in found] == [(["a"], ["b"], 0.8)]


def test_sequential_patterns_of_the_toy_case(spark):
    sequences = spark.createDataFrame(
        [([[1, 2], [3]],), ([[1], [3, 2], [1, 2]],), ([[1, 2], [5]],), ([[6]],)], "sequence array<array<int>>")
    found = patterns.sequential_patterns(sequences, 0.5, 5)
    sets = F.transform("sequence", lambda s: F.array_sort(s))
    got = {tuple(map(tuple, r[0])): r[1] for r in found.select(sets, "freq").collect()}
    assert got == {((1,),): 3, ((2,),): 3, ((3,),): 2, ((1, 2),): 3, ((1,), (3,)): 2}


def test_itemsets_and_rules(spark):
    baskets = spark.createDataFrame([(["a", "b"],), (["a", "b", "c"],), (["a"],), (["b", "c"],)], "items array<string>")
    model = patterns.mine_itemsets(baskets, 0.5, 0.6, partitions=2)
    got = {tuple(r["items"]): r["freq"] for r in patterns.itemsets(model).collect()}
    assert got == {("a",): 3, ("b",): 3, ("c",): 2, ("a", "b"): 2, ("b", "c"): 2}
    rules = {(tuple(r["antecedent"]), tuple(r["consequent"])): r["confidence"] for r in patterns.rules(model).collect()}
    assert rules[(("c",), ("b",))] == 1.0
    assert rules[(("a",), ("b",))] == pytest.approx(2 / 3)


def test_itemsets_grow_from_weighted_paths(spark):
    """no task reads whole baskets again or all of an item's baskets; what it reads are distinct paths."""
    rng = random.Random(7)
    words = ["a", "b", "c", "d", "e", "f"]
    drawn = [[w for w in words if rng.random() < 0.8] + [f"rare{i}"] for i in range(300)] + [[], None]
    baskets = spark.createDataFrame([(b,) for b in drawn], "items array<string>")
    singles = spark.createDataFrame([(w, sum(w in (b or []) for b in drawn)) for w in words], "item string, freq bigint")
    paths = [(tuple(sorted(r["path"])), r["n"]) for r in
             patterns.weighted_paths(baskets.where(F.col("items").isNotNull()), singles).collect()]
    kept = [tuple(w for w in words if w in b) for b in drawn if b]
    assert len(paths) == len({p for p, _ in paths}) and dict(paths) == {p: kept.count(p) for p in kept if len(p) > 1}
    for support in (0.3, 0.5):
        model = patterns.mine_itemsets(baskets, support, 0.8)
        got = [(tuple(r["items"]), r["freq"]) for r in patterns.itemsets(model).collect()]
        sets = {c: sum(set(c) <= set(k) for k in kept) for n in range(1, 7) for c in itertools.combinations(words, n)}
        want = {c: n for c, n in sets.items() if n >= support * 301}
        assert max(map(len, want)) >= 3 and len(got) == len(want) and dict(got) == want
        assert {(tuple(r["antecedent"]), r["consequent"][0]): r["confidence"] for r in patterns.rules(model).collect()} == {
            (c[:i] + c[i + 1:], c[i]): n / want[c[:i] + c[i + 1:]] for c, n in want.items() if len(c) > 1
            for i in range(len(c)) if n / want[c[:i] + c[i + 1:]] >= 0.8}


def test_baskets_without_items_and_repeated_items(spark):
    nothing = spark.createDataFrame([([],), (None,)], "items array<int>")
    assert patterns.itemsets(patterns.mine_itemsets(nothing, 0.5)).count() == 0
    assert patterns.itemsets(patterns.mine_itemsets(nothing.limit(0), 0.5)).count() == 0
    with pytest.raises(Exception, match="unique"):
        patterns.mine_itemsets(spark.createDataFrame([([1, 1],)], "items array<int>"), 0.5)


def test_confidence_zero_gives_no_rules(spark):
    baskets = spark.createDataFrame([(["a", "b"],)], "items array<string>")
    assert patterns.rules(patterns.mine_itemsets(baskets, 0.5, 0.0)).count() == 0


def test_day_patterns_have_all_types_and_five_items(spark):
    kinds = ["click", "signup", "deploy", "error", "alert", "click"]  # two types beyond the listed ones: 6 alert, 7 deploy
    rows = [(u, f"2024-01-0{d} {h:02d}:30:00", k) for u in range(3) for d in (1, 2)
            for k, h in zip(kinds, (1, 7, 8, 13, 19, 2))]
    spark.createDataFrame(rows, "user_id long, ts string, event_type string") \
        .withColumn("ts", F.to_timestamp("ts")).createOrReplaceTempView("events")
    found = {r.pattern: r.freq for r in m19_prefix_span(spark).collect()}
    # one day is [1][2,7][3][6]: every choice of its five items is a pattern
    assert len(found) == 2 ** 5 - 1 and set(found.values()) == {6}
    assert {"[1]", "[6]", "[7]", "[1][2][3]", "[1][2,7][3][6]"} <= set(found)
