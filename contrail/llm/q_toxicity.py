"""Query of the toxicity scores."""

from pyspark.sql import functions as F

from contrail.llm.queries import register, table
from contrail.llm.toxicity import score_toxicity


@register("op10_toxicity")
def op10(spark, sf_dir):
    """Toxicity score of every document."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    scored = score_toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
