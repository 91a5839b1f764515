"""Quality rules: a threshold table compiled into one projection of native functions.

Cases: a null or blank text has no words, so every count is 0 and the base rule rejects
it. Repeated rows are judged each on its own. An empty table gives an empty table. Input
columns are untouched whatever their names: the result goes to one struct column, whose
name gets underscores in front while the input has a column of that name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bound, free_name

SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8  # a power of two

# Frequent function words of English, German, French and Spanish: fixed values.
STOP_WORDS = (
    "the of and to in is that for on with as are was be by it from or an this at "
    "der die das und in den von zu ist mit ein eine im nicht für auf dem des sich als auch "
    "le la les de des et un une du en que qui dans pour par sur au est avec "
    "el la los las de y en que un una del por con para se su al no es").split()


@dataclass(frozen=True)
class Rule:
    """A document fails where the measure is below ``low`` or above ``high``."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("mean word length", "word_chars / n_words", 2.0, 18.0),
    Rule("symbols to words", "n_symbols / n_words", None, 0.1),
    Rule("stop words to words", "n_stop_words / n_words", 0.02, None),
    Rule("repeated lines to lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("lines that end in dots", "n_dot_lines / n_lines", None, 0.7),
    Rule("words with a letter", "n_letter_words / n_words", 0.7, None),
)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_dot_lines",
          "n_stop_words", "n_letter_words")


def split_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a run of ``window`` words that the text has twice or more."""
    def covered(positions: Column) -> Column:
        def step(seen: Column, p: Column) -> Column:
            end = p + window
            return F.struct((seen["n"] + end - F.greatest(p, seen["end"])).alias("n"), end.alias("end"))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(positions, start, step, lambda seen: seen["n"])

    def by_hash(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            again = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                             | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
            return covered(F.sort_array(F.transform(again, lambda x: x["i"])))

        return (F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0))
                .otherwise(bound(ordered, repeated)))

    def joined(hashes: Column, reach: int) -> Column:
        left = F.slice(hashes, F.lit(1), F.size(hashes) - reach)
        return F.zip_with(left, F.slice(hashes, F.lit(reach + 1), F.size(hashes) - reach),
                          lambda a, b: F.xxhash64(a, b))

    def windows(hashes: Column, reach: int = 1) -> Column:
        """Hashes of runs of ``window`` words by doubling the run: 1, 2, 4, ... words."""
        if reach == window:
            return hashes
        return bound(joined(hashes, reach), lambda h: windows(h, 2 * reach))

    return F.when(F.size(words) <= window, F.lit(0)).otherwise(
        bound(bound(F.transform(words, lambda w: F.xxhash64(w)), lambda h: windows(h)), by_hash)).cast("long")


def measures(text: Column) -> Column:
    """All counts of a text as one struct."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def counts(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("..."))).cast("long").alias("n_dot_lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"))

    return bound(split_words(text), lambda w: bound(lines, lambda x: counts(w, x)))


def compiled(rules: tuple[Rule, ...], counts: Column) -> Column:
    """Names of the rules that the counts break, in the table's order."""
    def broken(rule: Rule) -> Column:
        over, under = rule.measure.split(" / ")
        value = F.try_divide(counts[over].cast("double"), counts[under])  # null without words: nothing to break
        low = F.lit(False) if rule.low is None else value < rule.low
        high = F.lit(False) if rule.high is None else value > rule.high
        return F.when(low | high, F.lit(rule.name))
    return F.filter(F.array(*[broken(r) for r in rules]), lambda x: x.isNotNull())


def judge(frame: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
          out: str = "quality") -> tuple[DataFrame, str]:
    """The frame with a struct of counts, ``base_failed``, ``broken`` and ``kept``; and that column's name."""
    out = free_name(frame, out)

    def verdict(counts: Column) -> Column:
        base = (counts["n_words"] < 20) | (100 * counts["n_repeat_words"] > 30 * counts["n_words"])
        broken = compiled(rules, counts)
        return F.struct(*[counts[name].alias(name) for name in COUNTS], base.alias("base_failed"),
                        broken.alias("broken"), (~base & (F.size(broken) == 0)).alias("kept"))

    return frame.withColumn(out, bound(measures(F.coalesce(F.col(f"`{text}`"), F.lit(""))), verdict)), out
