"""Query of the near-duplicate classes."""

from contrail.llm.dart_minhash import near_duplicate_classes
from contrail.llm.queries import register, table


@register("op9_minhash_near_dedup")
def op9(spark, sf_dir):
    """Near-duplicate class of every document and the verified spanning links of its text."""
    return near_duplicate_classes(table(spark, sf_dir, "documents"))
