"""op11: the manifest of all documents, with every fifth document by hash checked after tampering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import table
from gridloom.llm.digits_sql import crc32_sql
from gridloom.llm.merkle import FANOUT, folded, leaf_digest, manifest, proof_digest
from gridloom.llm.registry import query

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf_sql(text: str) -> str:
    def framed(x: str) -> str:
        return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')"
    return f"sha256({' || '.join(framed(x) for x in [*FIELDS[:-1], text])})"


def _levels_sql(name: str, first: str, levels: int) -> str:
    """Steps ``name_run0 ..``: lists of each run, from a table of tree, idx, d; ``name_top``: what remains."""
    steps, nodes = [], first
    for k in range(levels):
        steps.append(f"""{name}_n{k} AS (SELECT tree, idx, d, count(*) OVER (PARTITION BY tree) AS n FROM {nodes})""")
        steps.append(f"""{name}_run{k} AS (SELECT tree, idx // {FANOUT} AS run, n, list(d ORDER BY idx) AS ds
                         FROM {name}_n{k} WHERE n > 1 GROUP BY tree, idx // {FANOUT}, n)""")
        steps.append(f"""{name}_up{k} AS (SELECT tree, run AS idx, sha256(array_to_string(ds, '')) AS d FROM {name}_run{k}
                         UNION ALL SELECT tree, idx, d FROM {name}_n{k} WHERE n = 1)""")
        nodes = f"{name}_up{k}"
    steps.append(f"{name}_top AS (SELECT tree, d FROM {nodes})")
    return ",\n".join(steps)


def _paths_sql(name: str, of: str, levels: int) -> tuple[str, str, str]:
    """Joins with the runs of all levels; the siblings of all levels; and the fold of ``{{d}}`` over them."""
    joins, siblings, fold = "", [], "{d}"
    for k in range(levels):
        rank = f"({of}.idx // {FANOUT ** k}) % {FANOUT}"
        joins += f"\nLEFT JOIN {name}_run{k} {name}{k} ON {name}{k}.tree = {of}.tree " \
                 f"AND {name}{k}.run = {of}.idx // {FANOUT ** (k + 1)}"
        left, right = (f"coalesce(array_to_string({name}{k}.ds[{a}:{b}], ''), '')"
                       for a, b in (("1", rank), (f"{rank} + 2", FANOUT)))
        siblings.append(f"{left} || {right}")
        fold = f"CASE WHEN {name}{k}.ds IS NULL THEN {fold} ELSE sha256({left} || {fold} || {right}) END"
    return joins, " || ".join(siblings), fold


def merkle_sql(levels: int = 3, top: int = 2) -> str:
    """For at most ``16 ** levels`` documents of a source and ``16 ** top`` sources."""
    low, low_sibs, low_fold = _paths_sql("low", "l", levels)
    high, high_sibs, high_fold = _paths_sql("high", "u", top)
    return f"""
    WITH leaves AS (SELECT doc_id, source, {_leaf_sql('text')} AS d,
                    CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN
                    {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} END AS altered FROM documents),
    placed AS (SELECT doc_id, d, coalesce(altered, d) AS seen,
               dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, d) - 1 AS idx FROM leaves),
    {_levels_sql('low', 'placed', levels)},
    tops AS (SELECT 0 AS tree, tree AS idx, d FROM low_top),
    {_levels_sql('high', 'tops', top)},
    folds AS (SELECT l.doc_id, l.d AS leaf, u.d AS subroot, u.tree AS utree, u.idx AS uidx,
              {low_sibs} AS sibs, {low_fold.format(d='l.seen')} AS up
              FROM placed l JOIN tops u ON u.idx = l.tree {low}),
    ended AS (SELECT u.doc_id, leaf, subroot, sibs || {high_sibs} AS sibs, {high_fold.format(d='u.up')} AS folded_root
              FROM (SELECT *, utree AS tree, uidx AS idx FROM folds) u {high})
    SELECT doc_id, leaf, subroot, r.d AS root, sha256(sibs) AS proof_sha256, folded_root,
           folded_root = r.d AS verified FROM ended, high_top r"""


@query("op11_merkle_manifest", oracle=merkle_sql())
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    leaf = leaf_digest(*[F.col(f) for f in FIELDS])
    altered = leaf_digest(*[F.col(f) for f in FIELDS[:-1]], F.translate("text", UPPER, LOWER))
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.select("doc_id", "source", leaf.alias("d"), F.when(chosen, altered).alias("altered"))
    made, out = manifest(rows, "source", "doc_id", F.col("d"))
    m = F.col(out)
    return made.select(
        "doc_id", m["leaf"].alias("leaf"), m["subroot"].alias("subroot"), m["root"].alias("root"),
        proof_digest(m["path"]).alias("proof_sha256"),
        folded(m["path"], F.coalesce("altered", m["leaf"])).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
