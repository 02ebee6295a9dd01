"""Queries that compare rows with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.llm import minhash, pivots, suffixes
from logvigil.llm.registry import query
from logvigil.llm.tables import read

OP2 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s FROM words),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sets sa ON sa.doc_id = a JOIN sets sb ON sb.doc_id = b WHERE 100 * n >= 85 * (len(sa.s) + len(sb.s) - n)),
reach(doc_id, seen) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, sets.doc_id = component_id AS kept
FROM sets JOIN (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY 1) c ON c.doc_id = sets.doc_id
"""


@query("op2_minhash_bbit", OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document under shared 3-word shingles."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash.classed(docs, minhash.Params(words=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP4 = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v)) / sqrt(list_inner_product(b.v, b.v)) >= 0.93),
reach(vec_id, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.seen)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(seen) AS component_id FROM reach GROUP BY 1)
"""


@query("op4_pivot_index", OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of each vector."""
    found = pivots.classed(read(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without strings of 400 bytes that repeat."""
    return suffixes.cleaned(read(spark, sf_dir, "documents").select("doc_id", "text"))
