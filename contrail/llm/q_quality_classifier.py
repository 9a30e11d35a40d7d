"""Query of the quality classifier."""

from pyspark.sql import functions as F

from contrail.llm.quality_classifier import score_quality
from contrail.llm.queries import register, table


@register("op2_quality_classifier")
def op2(spark, sf_dir):
    """Quality score of every document."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = score_quality(table(spark, sf_dir, "documents"), labels)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))
