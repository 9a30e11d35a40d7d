"""Query of the source mixture."""

from pyspark.sql import functions as F

from contrail.llm.mixture import mix_sources
from contrail.llm.queries import register, table

SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    coalesce(CASE WHEN length(text) > 0 THEN greatest(0.05::DOUBLE, 1 - 4 * len(regexp_extract_all(text, '[#*$%&|<>]')) / length(text)::DOUBLE) END, 1.0::DOUBLE) AS w,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS cap FROM s),
o AS (SELECT *, cap / weight::DOUBLE AS ratio FROM r),
p AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS lev
  FROM o WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN lev > ratio THEN cap::DOUBLE ELSE coalesce(max(CASE WHEN lev <= ratio THEN lev END) OVER (), 0) * weight END AS target FROM p),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size::DOUBLE)) ELSE 0 END AS epochs FROM t),
g0 AS (SELECT d.doc_id, d.source, d.size, -ln(d.u) / d.w AS key, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    false AS done, e.target - e.epochs * e.source_size AS gap FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
b0 AS (SELECT *, coalesce(sum(CASE WHEN NOT done AND size <= gap THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING), 0) AS filled FROM g0),
g1 AS (SELECT * EXCLUDE (done, gap, filled, done2), done2 AS done, rest - coalesce(sum(CASE WHEN done2 THEN size ELSE 0 END) OVER (PARTITION BY source), 0) AS gap
  FROM (SELECT *, done OR (size <= gap AND filled <= gap) AS done2 FROM b0) x),
b1 AS (SELECT *, coalesce(sum(CASE WHEN NOT done AND size <= gap THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING), 0) AS filled FROM g1),
g2 AS (SELECT * EXCLUDE (done, gap, filled, done2), done2 AS done, rest - coalesce(sum(CASE WHEN done2 THEN size ELSE 0 END) OVER (PARTITION BY source), 0) AS gap
  FROM (SELECT *, done OR (size <= gap AND filled <= gap) AS done2 FROM b1) x),
b2 AS (SELECT *, coalesce(sum(CASE WHEN NOT done AND size <= gap THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING), 0) AS filled FROM g2),
g3 AS (SELECT * EXCLUDE (done, gap, filled, done2), done2 AS done, rest - coalesce(sum(CASE WHEN done2 THEN size ELSE 0 END) OVER (PARTITION BY source), 0) AS gap
  FROM (SELECT *, done OR (size <= gap AND filled <= gap) AS done2 FROM b2) x),
b3 AS (SELECT *, coalesce(sum(CASE WHEN NOT done AND size <= gap THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING), 0) AS filled FROM g3),
g4 AS (SELECT * EXCLUDE (done, gap, filled, done2), done2 AS done, rest - coalesce(sum(CASE WHEN done2 THEN size ELSE 0 END) OVER (PARTITION BY source), 0) AS gap
  FROM (SELECT *, done OR (size <= gap AND filled <= gap) AS done2 FROM b3) x)
SELECT doc_id, source, size, source_size, round(target, 6) AS target,
  CAST(epochs * size + CASE WHEN done THEN size ELSE 0 END AS BIGINT) AS taken FROM g4
"""


@register("op7_mixture", SQL)
def op7(spark, sf_dir):
    """Words the mixture takes of every document."""
    return mix_sources(table(spark, sf_dir, "documents")).withColumn("target", F.round("target", 6))
