"""Queries that need statistics of all documents: ranked search, repeated windows, resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logvigil.llm import importance, ranked, windows
from logvigil.llm.registry import query
from logvigil.llm.tables import read

OP11 = r"""
WITH texts AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'q', item_id, text FROM benchmark),
words AS (SELECT side, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
tf AS (SELECT id, term, count(*) AS tf FROM words WHERE side = 'd' GROUP BY ALL),
lengths AS (SELECT id, count(*) AS n FROM words WHERE side = 'd' GROUP BY id),
corpus AS (SELECT count(*) AS n, CAST(sum(n) AS BIGINT) AS l FROM lengths),
sized AS (SELECT id, 10 + (90 * lengths.n * corpus.n) // corpus.l AS m FROM lengths, corpus),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term),
asked AS (SELECT DISTINCT id AS item_id, term FROM words WHERE side = 'q'),
scored AS (
  SELECT item_id, tf.id AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sized ON sized.id = tf.id GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


@query("op11_nra_search", OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked.top_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))


OP12 = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM words, unnest(range(1, len(w) - 18)) t(i)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM later),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query("op12_countmin_windows", OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without windows of 20 words that occurred before."""
    return windows.without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))


# crc32 as it is defined: bit by bit for the table of 256 values, byte by byte for each distinct run of words.
OP13 = r"""
WITH RECURSIVE bits(i, c, round) AS (
  SELECT i, i, 0 FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, round + 1 FROM bits WHERE round < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE round = 8),
texts AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
words AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
  SELECT side, id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))],
    [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])) AS f FROM words),
counted AS (SELECT side, id, f, count(*) AS n FROM runs GROUP BY ALL),
hexed AS (SELECT f, lower(hex(encode(f))) AS h FROM (SELECT DISTINCT f FROM counted)),
bucketed AS (
  SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, [
    (instr('0123456789abcdef', h[2 * i + 1]) - 1) * 16 + instr('0123456789abcdef', h[2 * i + 2]) - 1 for i in range(len(h) // 2)]),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket FROM hexed, crc),
sums AS (SELECT bucket, sum(n) FILTER (side = 'd') AS s, sum(n) FILTER (side = 't') AS t FROM counted JOIN bucketed USING (f) GROUP BY bucket),
whole AS (SELECT CAST(coalesce(sum(s), 0) AS BIGINT) AS s, CAST(coalesce(sum(t), 0) AS BIGINT) AS t FROM sums),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(sums.t, 0) + 1) * (whole.s + 10000) AS DOUBLE)
    / CAST((coalesce(sums.s, 0) + 1) * (whole.t + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM sums, whole),
weights AS (
  SELECT id, sum(n) AS n, sum(n * gain) AS weight FROM counted JOIN bucketed USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, len(w) AS n_words,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (id) WHERE side = 'd'),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20
  QUALIFY rank <= 5 * count(*) OVER () // 100)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)
"""


@query("op13_importance_quickselect", OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's weight towards the benchmark, and the rank of the five percent that are drawn."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = importance.resampled(docs, read(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")
