"""Query of the main-text extraction."""

from contrail.llm.html_extraction import extract_text
from contrail.llm.queries import register, table


@register("op6_html_extraction")
def op6(spark, sf_dir):
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
