"""op8: boilerplate lines of all pages, by host."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import stored, table
from gridloom.llm.registry import query
from gridloom.llm.site_lines import HTML_STEPS, LEAST, RATIO, drop_boilerplate, host_of, html_text

_TRIM = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def dedup_sql(ratio: float = RATIO, least: int = LEAST) -> str:
    """Steps ``split``, ``totals``, ``bad`` and ``cleaned`` for a table ``sides`` of id, host, t."""
    return f"""
    split AS (SELECT id, host, t, string_split(t, chr(10)) AS ls FROM sides WHERE t IS NOT NULL),
    once AS (SELECT host, t, any_value(ls) AS ls FROM split WHERE host IS NOT NULL GROUP BY host, t),
    page_lines AS (SELECT DISTINCT host, t, l FROM
                   (SELECT host, t, trim(unnest(ls), {_TRIM}) AS l FROM once) WHERE l <> ''),
    totals AS (SELECT host, count(*) AS n_pages FROM once GROUP BY host HAVING count(*) >= {least}),
    bad AS (SELECT host, list(l) AS bad FROM
            (SELECT host, l, count(*) AS n FROM page_lines GROUP BY host, l HAVING count(*) >= {least})
            JOIN totals USING (host) WHERE n > {ratio} * n_pages GROUP BY host),
    parts AS (SELECT s.*, list_filter(ls, lambda x: NOT coalesce(list_contains(bad, trim(x, {_TRIM})), FALSE)) AS kept
              FROM split s LEFT JOIN bad b ON s.host = b.host),
    cleaned AS (SELECT id, array_to_string(kept, chr(10)) AS cleaned, CAST(len(ls) AS BIGINT) AS n_lines,
                       CAST(len(ls) - len(kept) AS BIGINT) AS n_dropped, FALSE AS whole FROM parts)"""


def _html_sql(column: str) -> str:
    for pattern, put in HTML_STEPS:
        put = "chr(10)" if put == "\n" else f"'{put}'"
        column = f"regexp_replace({column}, '{pattern}', {put}, 'g')"
    return column


@query("op8_site_lines", oracle=rf"""
    WITH sides AS (SELECT page_id AS id, {_html_sql('html')} AS t,
                   nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '')
                   AS host FROM pages), {dedup_sql()}
    SELECT id AS page_id, host, n_lines, n_dropped, whole, cleaned AS text
    FROM cleaned JOIN sides USING (id)""")
def op8_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    # the text of a page is made once and read twice
    pages = stored(table(spark, folder, "pages").select("page_id", host_of(F.col("url")).alias("host"),
                                                        html_text(F.col("html")).alias("page")), "page-text")
    cleaned, out = drop_boilerplate(pages, F.col("host"), F.col("page"))
    return cleaned.select("page_id", "host", f"{out}.n_lines", f"{out}.n_dropped", f"{out}.whole", f"{out}.text")
