"""From raw documents to packed training sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it gets; ``run`` writes
each stage's rows to the shared folder and reads them again for the next one. All but the
last stage return the columns of ``docs``. What happens to nulls, empty and very long
texts, repeated rows, empty tables and further columns is said in the operators'
docstrings; beyond that:

* quality rules: rejected documents go, null and empty texts among them;
* line dedup: the source is the host, the text loses its boilerplate lines;
* near duplicates: sets of five-word shingles, similarity 0.8; the document with the least
  id of each group stays. Rows without id stay. Of rows with equal id and text one stays; an
  id that repeats with other texts stays if any of its rows is the document of a group;
* decontamination: the text loses the words of benchmark passages;
* packing: pieces of at most 1024 tokens with their sequence and offset.

``n_chars`` follows the text where the documents have it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import ids_side, stored, table
from gridloom.llm.decontaminate import decontaminate
from gridloom.llm.near_dups import near_duplicates
from gridloom.llm.q10_packing import packed
from gridloom.llm.quality_rules import judge
from gridloom.llm.site_lines import drop_boilerplate


def _with_text(frame: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` with another text."""
    new = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    return frame.select(*[new.get(c, F.col(f"`{c}`")) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged, out = judge(docs)
    return judged.filter(F.col(out)["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned, out = drop_boilerplate(docs, F.col("source"), F.col("text"))
    return _with_text(cleaned, docs, F.col(out)["text"])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = stored(near_duplicates(docs).select("doc_id", "kept"), "kept")
    ids = found.filter("doc_id is not null").groupBy("doc_id").agg(
        F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    gone = stored(ids.filter(~F.col("kept")).select("doc_id"), "gone")
    rest = docs.join(ids_side(gone), "doc_id", "left_anti").select(*names)
    repeated = ids.filter((F.col("n") > 1) & F.col("kept")).select("doc_id")
    if repeated.isEmpty():
        return rest
    once = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*names)
    return rest.join(repeated, "doc_id", "left_anti").select(*names).unionByName(once)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found, out = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _with_text(found, docs, F.col(out)["cleaned"])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("line dedup", lines), ("MinHash near-dedup", near),
    ("benchmark decontamination", benchmark), ("best-fit packing", sequences)]

# Near duplicates are components of a self-join and packing is a search: tests hold a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
