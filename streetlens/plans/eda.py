"""The five exploratory tables off one cached input."""

from __future__ import annotations

from pyspark.sql import DataFrame

from streetlens import config
from streetlens.operators import aggregates


def eda_tables(df: DataFrame, hex_cells: int = config.GRID.hex_cells) -> dict[str, DataFrame]:
    return {
        "monthly_trend": aggregates.count_by(df, "month_date", name="count"),
        "category_breakdown": aggregates.category_counts(df),
        "seasonal_heatmap": aggregates.year_month_pivot(df),
        "spatial_density": aggregates.hexbin_density(df, hex_cells),
        "category_trends": aggregates.count_by(df, "category", "month_date", name="count"),
    }
