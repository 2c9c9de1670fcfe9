"""Query of the HTML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streetlens.llm.base import query, table
from streetlens.llm.html_text import extract_text


@query("op2_html_text")
def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, folder, "pages"))
