"""Query of the exact deduplication."""

from pyspark.sql import functions as F

from contrail.llm.cuckoo_dedup import exact_duplicates
from contrail.llm.queries import register, table

SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@register("op13_exact_dedup", SQL)
def op13(spark, sf_dir):
    """The document that stays for each document, of those with the same text."""
    out = exact_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("key")).alias("text_sha256"))
