"""op7: documents that hold passages of the benchmark items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import table
from gridloom.llm.decontaminate import decontaminate
from gridloom.llm.registry import query


def leaks_sql(docs: str = "documents") -> str:
    """Words, windows and their occurrences as steps up to ``leaks``."""
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return rf"""
    item_words AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), {word}) AS ws FROM benchmark),
    windows AS (SELECT DISTINCT item_id, ws[i:i + 9] AS w, least(len(ws), 10) AS n FROM
                (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM item_words
                 WHERE len(ws) > 0)),
    doc_words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), {word}) AS ws FROM {docs}),
    sizes AS (SELECT DISTINCT n FROM windows),
    places AS (SELECT doc_id, i, ws[i:i + n - 1] AS w, n FROM
               (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc_words, sizes
                WHERE len(ws) >= n)),
    hits AS (SELECT p.doc_id, p.i, p.n, v.item_id FROM places p JOIN windows v ON p.w = v.w AND p.n = v.n),
    hit_words AS (SELECT doc_id, count(DISTINCT k) AS n FROM
                  (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
    hit_items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM
                  (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
    leaks AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
                     CAST(coalesce(t.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
                     coalesce(h.n, 0) > 0 AS contaminated
              FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id))"""


@query("op7_fm_index", oracle=f"WITH {leaks_sql()} SELECT * FROM leaks")
def op7_fm_index(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found, out = decontaminate(docs, table(spark, folder, "benchmark"), keep_text=False)
    return found.select("doc_id", f"{out}.n_words", f"{out}.n_hit",
                        F.size(f"{out}.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(f"{out}.items", ","), 256).alias("items_sha256"),
                        (F.col(f"{out}.n_hit") > 0).alias("contaminated"))
