"""op13: the prefix trie of all rebuilt conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import table
from gridloom.llm.digits_sql import crc32_sql
from gridloom.llm.prefix_trie import prefix_trie, rebuilt, turn_lists
from gridloom.llm.registry import query

_WORDS = r"CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT)"


@query("op13_prefix_trie", oracle=rf"""
    WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
                   md5(strlen(role) || ':' || role || text) AS k, {_WORDS} AS words
                   FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                         FROM conversations WHERE conv_id IS NOT NULL)),
    convs AS (SELECT conv_id, conv_id - conv_id % 20 AS lead, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 4 AS h
              FROM (SELECT DISTINCT conv_id FROM turns)),
    parts AS (SELECT c.conv_id, t.p, t.k, t.words FROM convs c JOIN turns t ON t.conv_id = c.lead AND t.p <= c.h
              UNION ALL
              SELECT c.conv_id, t.p, t.k, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h),
    lists AS (SELECT conv_id, list(k ORDER BY p) AS ks, list(words ORDER BY p) AS ws FROM parts GROUP BY conv_id),
    built AS (SELECT c.conv_id, coalesce(ks, []) AS ks, coalesce(ws, []) AS ws FROM convs c LEFT JOIN lists USING (conv_id)),
    members AS (SELECT conv_id, d, len(ks) AS n, md5(array_to_string(ks[1:d], ',')) AS node,
                       CASE WHEN d > 0 THEN md5(array_to_string(ks[1:d - 1], ',')) END AS up,
                       CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS words
                FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM built)),
    nodes AS (SELECT node, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
                     (count(*) - 1) * any_value(words) AS saved,
                     coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = n), '') AS ends
              FROM members GROUP BY node, d),
    kids AS (SELECT up, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY up, d),
    own AS (SELECT x.*, coalesce(k.n, 0) AS n_children FROM nodes x LEFT JOIN kids k ON k.up = x.node AND k.d = x.d),
    above AS (SELECT DISTINCT m.node, m.d, v.node AS top, v.d AS top_d
              FROM own x JOIN members m ON m.node = x.node AND m.d = x.d AND m.conv_id = x.conv_id
              JOIN members v ON v.conv_id = m.conv_id AND v.d <= m.d),
    sums AS (SELECT top, top_d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
             FROM above JOIN own USING (node, d) GROUP BY top, top_d)
    SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n_convs, x.n_children,
           CAST(leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
    FROM own x JOIN sums s ON s.top = x.node AND s.top_d = x.d LEFT JOIN own p ON p.node = x.up AND p.d = x.d - 1""")
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(rebuilt(turn_lists(table(spark, folder, "conversations"))))
