"""The registered queries of this subpackage; each covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.llm import (
    balancing,
    chunks,
    decontamination,
    divergence,
    filter_audit,
    lengths,
    near_duplicates,
    personal_data,
    quality,
    scoring,
    syncmers,
    token_files,
    vector_graph,
)
from quern.llm.common import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_output(documents(spark, sf_dir), vocabulary())


@query
def op2_line_field_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op3_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.curve(lengths.histogram(documents(spark, sf_dir), vocabulary()))


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balancing.mixed(documents(spark, sf_dir)).drop("source", "tie")


@query
def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(documents(spark, sf_dir))


@query
def op6_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op7_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores(documents(spark, sf_dir))


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir))


ORACLES["op8_near_duplicates"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * both_n >= 75 * (p.n + q.n - both_n)),
reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
lowest AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(y, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lowest ON x = d.doc_id
"""


@query
def op9_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(documents(spark, sf_dir), compared=None)


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(documents(spark, sf_dir))


@query
def op11_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.vector_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir))


ORACLES["op12_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
tokens AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS cl FROM tokens GROUP BY 1, 2 HAVING count(DISTINCT d) >= 30),
counts AS (SELECT lang, source, term, count(*) AS c FROM tokens JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
langs AS (SELECT lang, count(*) AS v, sum(cl) AS n FROM kept GROUP BY 1),
sizes AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM groups g LEFT JOIN counts USING (lang, source) GROUP BY 1, 2),
freq AS (
  SELECT s.lang, s.source, k.term, coalesce(c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (s.n + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.cl + 5)) // (l.n + 5 * l.v) AS q
  FROM sizes s JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts x ON x.lang = s.lang AND x.source = s.source AND x.term = k.term),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM freq a JOIN freq b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM freq WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 50
"""


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
flags AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY t), false)::INT AS bits
  FROM words LEFT JOIN lab ON lab.doc_id = words.doc_id),
cells AS (SELECT part, bits, count(*) AS n, sum(good) AS g, sum(toxic) AS x FROM flags GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
orders(filter_order, used, step, f, b, before) AS (
  SELECT f, b, 1, f, b, 0 FROM letters
  UNION ALL
  SELECT o.filter_order || l.f, o.used | l.b, o.step + 1, l.f, l.b, o.used FROM orders o JOIN letters l ON o.used & l.b = 0),
full_orders AS (
  SELECT p.filter_order, o.step, o.f, o.b, o.before FROM orders o
  JOIN (SELECT filter_order FROM orders WHERE step = 5) p ON p.filter_order[:o.step] = o.filter_order),
parts AS (SELECT DISTINCT part FROM cells),
steps AS (
  SELECT p.part, o.filter_order, o.step, o.f, o.b,
    sum(CASE WHEN bits & (before | b) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN bits & before = 0 AND bits & b > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bits & before > 0 AND bits & b > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bits = b THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bits & before = 0 AND bits & b > 0 THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN bits & before = 0 AND bits & b > 0 THEN x ELSE 0 END) AS toxic_lost
  FROM parts p JOIN cells c USING (part) CROSS JOIN full_orders o GROUP BY 1, 2, 3, 4, 5)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM steps
"""
