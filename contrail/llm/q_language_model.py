"""Query of the language-model scores."""

from pyspark.sql import functions as F

from contrail.llm.kneser_ney import score_texts
from contrail.llm.quality_classifier import fold
from contrail.llm.queries import register, table


@register("op8_lm_scoring")
def op8(spark, sf_dir):
    """Kneser-Ney scores of order 3, no n-gram left out, and add-one scores of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(True))
    return score_texts(docs, docs.where(~held), held, order=3, least=1)
