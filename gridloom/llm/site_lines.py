"""Line dedup by site-relative frequency: lines that too large a share of a host's pages carry.

The share of a line is the number of the host's pages that have it, divided by all pages
of the host; pages of equal text are one page, so a copied page is no boilerplate of its
host. Lines are compared without the spaces around them, by 64-bit hashes; blank lines are never
boilerplate. A line goes when its share is above ``ratio`` and at least ``least`` pages
have it. With ``whole`` below 1 a page that would lose more than that share of its
characters stays as it is; by default every page loses its boilerplate.

Cases: a page without a host, or with a null text, has no line to compare, is no page of
any host and stays as it is, null included. An empty text is one blank line. Texts of any
length are split whole. A repeated row loses the same lines as its equal. Lines with equal
shares go or stay together. An empty table gives an empty table. Input columns are
untouched whatever their names; results come in one struct.

The boilerplate of a host is bounded: pages carry on average ``a`` lines, so at most
``a / ratio`` lines of a host can have a share above ``ratio``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bound, free_name, stored

RATIO, LEAST, WHOLE = 0.02, 3, 1.0
SALTS = 32
BROADCAST_ROWS = 20_000  # boilerplate lines (8 bytes each) that a broadcast may hold

# Elements that start a line of their own: fixed values.
_BLOCK = (r"(?i)</?(?:html|head|body|title|nav|div|article|section|header|footer|aside|main|h[1-6]|p|br|hr|ul|ol|li"
          r"|dl|dt|dd|table|tr|td|th|blockquote|pre|form)(?:\s[^>]*)?/?>")
_UNSEEN = r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>|<!--.*?-->"
HTML_STEPS = ((_UNSEEN, " "), (_BLOCK, "\n"), (r"<[^>]*>", ""))
SPACES = " \t\n\x0b\x0c\r"


def html_text(html: Column) -> Column:
    """Text of a page: a line for each block element, without scripts, styles, comments and tags."""
    for pattern, put in HTML_STEPS:
        html = F.regexp_replace(html, pattern, put)
    return html


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def line_key(line: Column) -> Column:
    """64 bits of a trimmed line; all blank lines have the key of the empty one."""
    # few lines have spaces around them, and trimming looks at every character
    edge = reduce(Column.__or__, [f(line, F.lit(c)) for c in SPACES for f in (F.startswith, F.endswith)])
    return F.xxhash64(F.when(edge, F.btrim(line, F.lit(SPACES))).otherwise(line))


def _keys(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), line_key)


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO,
                least: int = LEAST) -> DataFrame:
    """``host, n_pages, lines``: the keys of the lines whose share of the host's pages is above ``ratio``."""
    blank = F.xxhash64(F.lit(""))
    sides = pages.select(host.alias("host"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"),
                         F.array_remove(F.array_distinct(_keys(text)), blank).alias("keys")) \
        .filter(F.col("host").isNotNull() & F.col("keys").isNotNull())
    pages_once = sides.groupBy("host", "a", "b").agg(F.first("keys").alias("keys"))
    # a null in front of the lines counts the page itself, so that one shuffle has both counts
    marker = F.array(F.lit(None).cast("long"))
    rows = pages_once.select("host", F.explode(F.concat(marker, "keys")).alias("key"))
    counts = stored(rows.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least),
                    "site-lines")
    totals = counts.filter(F.col("key").isNull()).select("host", F.col("n").alias("n_pages"))
    return (counts.filter(F.col("key").isNotNull()).join(totals, "host")
            .filter(F.col("n") > ratio * F.col("n_pages"))
            .groupBy("host", "n_pages").agg(F.collect_list("key").alias("lines")))


def drop_boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, least: int = LEAST,
                     whole: float = WHOLE, out: str = "line_dedup") -> tuple[DataFrame, str]:
    """The pages with a struct ``text, n_lines, n_dropped, whole``; and that column's name.

    ``text`` is the page's text without its boilerplate lines, ``n_dropped`` what it lost
    and ``whole`` says that it was left as it is because it would lose too much. ``host``
    and ``text`` are read twice: a costly expression should be a stored column.
    """
    out = free_name(pages, out)
    mine, site, salt, lines = (free_name(pages, n) for n in ("lines_text", "lines_host", "lines_salt", "lines_drop"))
    found = stored(boilerplate(pages, host, text, ratio, least), "boilerplate")
    sides = pages.withColumn(mine, text).withColumn(site, host)
    held = found.select(F.col("host").alias(site), F.col("lines").alias(lines))
    if found.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()[0] <= BROADCAST_ROWS:
        joined = sides.join(F.broadcast(held), site, "left")
    else:  # a host may hold a third of the pages: its lines go to every salt
        spread = held.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (sides.withColumn(salt, F.pmod(F.xxhash64(mine), F.lit(SALTS)).cast("int"))
                  .join(spread, [site, salt], "left").drop(salt))

    def as_is(n_lines: Column, spared: Column) -> Column:
        return F.struct(F.col(mine).alias("text"), n_lines.cast("long").alias("n_lines"),
                        F.lit(0).cast("long").alias("n_dropped"), spared.alias("whole"))

    def judged(split: Column) -> Column:
        return bound(F.transform(split, line_key), lambda keys: bound(
            F.array_intersect(keys, F.col(lines)), lambda bad: F.when(F.size(bad) == 0, as_is(
                F.size(split), F.lit(False))).otherwise(cleaned(split, keys, bad))))

    def cleaned(split: Column, keys: Column, bad: Column) -> Column:
        kept = F.filter(split, lambda x, i: ~F.array_contains(bad, F.get(keys, i)))
        return bound(kept, lambda rest: lost(split, rest))

    def lost(split: Column, kept: Column) -> Column:
        result = F.struct(F.array_join(kept, "\n").alias("text"), F.size(split).cast("long").alias("n_lines"),
                          (F.size(split) - F.size(kept)).cast("long").alias("n_dropped"), F.lit(False).alias("whole"))
        if whole >= 1:
            return result

        def chars(x: Column) -> Column:
            return F.length(F.btrim(F.array_join(x, "\n"), F.lit(SPACES)))
        too_much = chars(kept) < (1 - whole) * chars(split)
        return F.when(too_much, as_is(F.size(split), F.lit(True))).otherwise(result)

    split = F.split(F.col(mine), "\n")
    none = F.col(lines).isNull() | F.col(mine).isNull()
    n_lines = F.when(F.col(mine).isNull(), F.lit(0)).otherwise(F.size(split))
    result = F.when(none, as_is(n_lines, F.lit(False))) \
        .otherwise(bound(split, judged))
    return joined.select(*[F.col(f"`{c}`") for c in pages.columns], result.alias(out)), out
