"""Query of the quality rules."""

from contrail.llm.quality_rules import STATS, judge
from contrail.llm.queries import register, table


@register("op4_quality_rules")
def op4(spark, sf_dir):
    """Base statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select("doc_id", *STATS, "base_failed", "kept")
