"""op9: quality rules over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import table
from gridloom.llm.quality_rules import STOP_WORDS, judge
from gridloom.llm.registry import query

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

# The counts of `measures` and the verdict of RULES, for a table of doc_id and t (text, never null).
COUNTS_SQL = rf"""
    words AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
              FROM texts),
    runs AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS run
             FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM words WHERE len(ws) > 8)),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs)
              WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n
                FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id),
    counts AS (
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
               CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
               len(list_filter(ls, lambda x: rtrim(x) LIKE '%...')) AS n_dot_lines,
               len(list_filter(ws, lambda x: lower(x) IN ({_STOPS}))) AS n_stop_words,
               len(list_filter(ws, lambda x: regexp_matches(x, '\pL'))) AS n_letter_words
        FROM words w LEFT JOIN covered c ON w.doc_id = c.doc_id),
    judged AS (
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               coalesce(word_chars / n_words BETWEEN 2 AND 18 AND n_symbols / n_words <= 0.1
                        AND n_stop_words / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.5
                        AND n_dot_lines / n_lines <= 0.7 AND n_letter_words / n_words >= 0.7, TRUE) AS method_kept
        FROM counts)"""


@query("op9_quality_rules", oracle=f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {COUNTS_SQL}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND method_kept AS kept
    FROM judged""")
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged, out = judge(table(spark, folder, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[f"{out}.{n}" for n in names])
