"""Frequent itemsets, rules and sequences. The SQL counts every subset of the few items as a bit mask."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.functions.columns import bracketed
from gridloom.operators import patterns, rows
from gridloom.plans.jobs import pattern_job
from gridloom.queries.base import ORDER_FLAGS, query, rounded, scratch, sql
from gridloom.queries.relational import TRIM_SET
from gridloom.sources.sql import spread_out

FLAGS = 8
MASK = " + ".join(f"CASE WHEN c{i} <> '0' THEN {1 << (i - 1)} ELSE 0 END" for i in range(1, FLAGS + 1))


def _item_text(mask: str) -> str:
    items = ", ".join(f"CASE WHEN {mask} & {1 << (i - 1)} > 0 THEN '{i}' END" for i in range(1, FLAGS + 1))
    return f"'[' || array_to_string([{items}], ',') || ']'"


def frequent_ctes(support: float) -> str:
    """``f(s, freq)``: every subset of the flags that enough orders have."""
    return f"""
b AS MATERIALIZED (SELECT mask, count(*) AS n FROM (
    SELECT {MASK} AS mask FROM ({ORDER_FLAGS}) AS o) AS m GROUP BY mask),
f AS MATERIALIZED (
    SELECT CAST(s AS INT) AS s, CAST(sum(n) AS BIGINT) AS freq
    FROM b, range(1, {1 << FLAGS}) AS r(s) WHERE mask & s = s
    GROUP BY s HAVING sum(n) >= ceil({support} * (SELECT sum(n) FROM b)))"""


def rules_sql(support: float, confidence: float) -> str:
    return f"""
WITH {frequent_ctes(support)}
SELECT {_item_text('a.s')} AS antecedent, '[' || i.i || ']' AS consequent,
       round(w.freq / a.freq, 6) AS confidence
FROM f AS w, range(1, {FLAGS + 1}) AS i(i), f AS a
WHERE w.s & (1 << (i.i - 1))::INT > 0 AND a.s = w.s - (1 << (i.i - 1))::INT
  AND w.freq / a.freq >= {confidence}"""


@query("m16_fp_growth_items", f"WITH {frequent_ctes(0.3)} "
       f"SELECT {_item_text('s')} AS items, freq FROM f")
def m16_fp_growth_items(spark):
    model = patterns.mine_itemsets(rows.one_hot_baskets(sql(spark, ORDER_FLAGS)), 0.3)
    return patterns.itemsets(model).select(bracketed("items").alias("items"), "freq")


@query("m16_fp_growth_rules", rules_sql(0.2, 0.8))
def m16_fp_growth_rules(spark):
    model = patterns.mine_itemsets(rows.one_hot_baskets(sql(spark, ORDER_FLAGS)), 0.2, 0.8)
    return patterns.rules(model).select(
        bracketed("antecedent").alias("antecedent"), bracketed("consequent").alias("consequent"),
        *rounded("confidence"))


@query("m18_rules_from_itemsets", rules_sql(0.1, 0.6))
def m18_rules_from_itemsets(spark):
    """Rules from given itemsets, by a join on the rest of each set."""
    model = patterns.mine_itemsets(rows.one_hot_baskets(sql(spark, ORDER_FLAGS)), 0.1)
    found = patterns.rules_from_itemsets(patterns.itemsets(model), 0.6)
    return found.select(bracketed("antecedent").alias("antecedent"),
                        bracketed("consequent").alias("consequent"), *rounded("confidence"))


@query("k5_itemset_tables", " UNION ALL ".join(
    f"SELECT * FROM (WITH {frequent_ctes(support)} SELECT 'job-16' AS key_id, {_item_text('s')} AS items, "
    f"freq, {support}::DOUBLE AS min_support FROM f) AS t{i}" for i, support in enumerate([0.3, 0.5])))
def k5_itemset_tables(spark):
    """The FP-growth job over two supports, appended to one ORC target."""
    target = scratch(spark, "patterns") + "/found"
    pattern_job(spark, "job-16", {"data": ORDER_FLAGS, "minsupport": "0.3,0.5", "saveresult": target})
    return spark.read.orc(f"{target}_items").drop("timestamp")


@query("k5_rule_tables", f"""
SELECT 'job-17' AS key_id, antecedent, consequent, confidence, 0.1::DOUBLE AS min_support
FROM ({rules_sql(0.1, 0.6)}) AS r""")
def k5_rule_tables(spark):
    """The FP-growth job with rules as its output, appended to an ORC target."""
    target = scratch(spark, "patterns") + "/found"
    pattern_job(spark, "job-17", {"data": ORDER_FLAGS, "minsupport": "0.1", "minconfidence": "0.6",
                                  "output": "Rules", "saveresult": target})
    return spark.read.orc(f"{target}_rules").select("key_id", "antecedent", "consequent", *rounded("confidence"),
                                                    "min_support")


TEXT_SUPPORT = 0.5


@query("m17_fp_growth_text", f"""
WITH w AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(string_split(trim(text, {TRIM_SET}), ' ')) AS word FROM documents),
common AS MATERIALIZED (
    SELECT word, CAST(row_number() OVER (ORDER BY word) - 1 AS INT) AS bit FROM w GROUP BY word
    HAVING count(*) >= ceil({TEXT_SUPPORT} * (SELECT count(*) FROM documents))),
b AS MATERIALIZED (SELECT mask, count(*) AS n FROM (
    SELECT doc_id, CAST(sum(1::BIGINT << bit) AS BIGINT) AS mask FROM w JOIN common USING (word)
    GROUP BY doc_id) AS m GROUP BY mask),
f AS MATERIALIZED (
    SELECT s, CAST(sum(n) AS BIGINT) AS freq
    FROM b, (SELECT unnest(range(1, 1::BIGINT << (SELECT count(*) FROM common))) AS s) AS r
    WHERE mask & s = s
    GROUP BY s HAVING sum(n) >= ceil({TEXT_SUPPORT} * (SELECT count(*) FROM documents)))
SELECT '[' || string_agg(word, ',' ORDER BY word) || ']' AS items, freq
FROM f JOIN common ON s & (1::BIGINT << bit) > 0 GROUP BY s, freq""", uses="documents")
def m17_fp_growth_text(spark):
    """Words that occur together in at least half of the whole texts."""
    baskets = rows.text_baskets(spread_out(spark.table("documents").select("text"), "documents"), "text")
    model = patterns.mine_itemsets(baskets, TEXT_SUPPORT)
    return patterns.itemsets(model).select(bracketed("items").alias("items"), "freq")


# --- sequences: a user's day in four quarters, the event types of each as one itemset ----

TYPES = ["click", "signup", "error", "purchase", "view"]
SLOTS = 4


def event_items(events):
    """``event_type, item``: every type of the table; types beyond ``TYPES`` are numbered behind them by name."""
    kind = F.col("event_type")
    found = events.select(kind).filter(kind.isNotNull()).distinct()
    further = found.filter(~kind.isin(TYPES)).select(
        kind, (F.row_number().over(Window.orderBy(kind)) + len(TYPES)).alias("item"))
    listed = F.coalesce(*[F.when(kind == t, F.lit(i + 1)) for i, t in enumerate(TYPES)])
    return found.filter(kind.isin(TYPES)).select(kind, listed.alias("item")).union(further)


def day_sequences(spark):
    """One short sequence per user and day: at most four sets of distinct types.

    Repeated events are taken out before anything is shuffled, so a user with very
    many events is still one short row.
    """
    events = spark.table("events")
    items = events.join(event_items(events), "event_type", "left")
    pair = F.struct(F.floor(F.hour("ts") / 6).cast("int").alias("slot"), "item")
    days = items.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.collect_set(F.when(F.col("item").isNotNull(), pair)).alias("found"))

    def items_of(slot):
        return F.array_sort(F.transform(F.filter("found", lambda x: x["slot"] == slot), lambda x: x["item"]))

    sets = [items_of(s) for s in range(SLOTS)]
    return days.select(F.filter(F.array(*sets), lambda x: F.size(x) > 0).alias("sequence"))


ITEM = "CASE event_type " + " ".join(f"WHEN '{t}' THEN {i + 1}" for i, t in enumerate(TYPES)) + " END"
SEQUENCE_SUPPORT = 0.05


@query("m19_prefix_span", f"""
WITH e AS MATERIALIZED (
    SELECT DISTINCT user_id, CAST(ts AS DATE) AS d, floor(hour(ts) / 6) AS slot, {ITEM} AS item FROM events),
n AS (SELECT ceil({SEQUENCE_SUPPORT} * count(*)) AS least FROM (SELECT DISTINCT user_id, d FROM e) AS s),
found AS (
    SELECT '[' || item || ']' AS pattern, count(DISTINCT (user_id, d)) AS freq FROM e GROUP BY 1
    UNION ALL
    SELECT '[' || a.item || ',' || b.item || ']' AS pattern, count(DISTINCT (a.user_id, a.d)) AS freq
    FROM e AS a JOIN e AS b ON a.user_id = b.user_id AND a.d = b.d AND a.slot = b.slot AND a.item < b.item
    GROUP BY 1
    UNION ALL
    SELECT '[' || a.item || '][' || b.item || ']' AS pattern, count(DISTINCT (a.user_id, a.d)) AS freq
    FROM e AS a JOIN e AS b ON a.user_id = b.user_id AND a.d = b.d AND a.slot < b.slot
    GROUP BY 1)
SELECT pattern, freq FROM found, n WHERE freq >= least""", uses="events")
def m19_prefix_span(spark):
    """Patterns of up to five items in the days of all users."""
    found = patterns.sequential_patterns(day_sequences(spark), SEQUENCE_SUPPORT, max_length=5)
    sets = F.transform("sequence", lambda s: bracketed(F.array_sort(s).cast("array<string>")))
    return found.select(F.array_join(sets, "").alias("pattern"), "freq")


LONG_SUPPORT = 0.002


@query("m19_long_patterns", f"""
WITH RECURSIVE e AS MATERIALIZED (
    SELECT DISTINCT user_id, CAST(ts AS DATE) AS d, floor(hour(ts) / 6) AS slot, {ITEM} AS item FROM events
    WHERE event_type IS NOT NULL),
grown(user_id, d, slot, item, pattern, n) AS (
    SELECT user_id, d, slot, item, '[' || item, 1 FROM e
    UNION
    SELECT e.user_id, e.d, e.slot, e.item,
           g.pattern || CASE WHEN e.slot = g.slot THEN ',' ELSE '][' END || e.item, g.n + 1
    FROM grown AS g JOIN e ON e.user_id = g.user_id AND e.d = g.d
         AND (e.slot > g.slot OR (e.slot = g.slot AND e.item > g.item)) WHERE g.n < 5),
days AS (SELECT ceil({LONG_SUPPORT} * count(*)) AS least FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) AS s)
SELECT pattern || ']' AS pattern, freq
FROM (SELECT pattern, count(DISTINCT (user_id, d)) AS freq FROM grown GROUP BY pattern) AS f, days
WHERE freq >= least""", uses="events")
def m19_long_patterns(spark):
    """The same at a support that patterns of three and more items reach; the SQL grows patterns of any length up to five."""
    found = patterns.sequential_patterns(day_sequences(spark), LONG_SUPPORT, max_length=5)
    sets = F.transform("sequence", lambda s: bracketed(F.array_sort(s).cast("array<string>")))
    return found.select(F.array_join(sets, "").alias("pattern"), "freq")
