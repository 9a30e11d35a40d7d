"""Query of the substring deduplication."""

from pyspark.sql import functions as F

from contrail.llm.queries import register, table
from contrail.llm.substring_dedup import remove_repeated_passages

SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13),
h AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s FROM g),
f AS (SELECT s, min(doc_id) AS least FROM h GROUP BY s HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT h.doc_id, h.i FROM h JOIN f USING (s) WHERE h.doc_id > f.least),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS k FROM m),
gone AS (SELECT doc_id, list(k) AS ks, count(*) AS n FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
    ELSE array_to_string(list_filter(w, lambda x, j: NOT list_contains(ks, j)), ' ') END) AS kept_sha256
FROM d LEFT JOIN gone ON d.doc_id = gone.doc_id
"""


@register("op1_substring_dedup", SQL)
def op1(spark, sf_dir):
    """Words left of every document once passages of earlier ones are cut."""
    out = remove_repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), n=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
