"""Query of the benchmark decontamination."""

from contrail.llm.decontamination import find_leaks
from contrail.llm.queries import register, table


@register("op5_benchmark_decontamination")
def op5(spark, sf_dir):
    """Every benchmark item that a document holds."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
