"""Cleaning of raw click counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_clicks(df: DataFrame) -> DataFrame:
    """Rows with both endpoints and a positive count."""
    return df.filter(
        F.col("prev").isNotNull() & F.col("curr").isNotNull() & F.col("n").isNotNull() & (F.col("n") > 0)
    )


def page_category(page: Column) -> Column:
    """``other-*`` sources keep their name, ``null`` is direct traffic, the rest are pages."""
    return (
        F.when(page.startswith("other-"), page)
        .when(page == "null", F.lit("direct"))
        .otherwise(F.lit("page"))
    )


def clean_clicks(df: DataFrame, min_transitions: int = 10, trim_type: bool = True) -> DataFrame:
    """Drop invalid and low-volume rows, trim keys, add normalised titles and categories.

    The volume filter looks at raw rows, before anything is summed.
    """
    trimmed = {"prev": F.trim("prev"), "curr": F.trim("curr")}
    if trim_type:
        trimmed["type"] = F.trim("type")
    kept = valid_clicks(df).filter(F.col("n") >= min_transitions).withColumns(trimmed)
    return kept.withColumns(
        {
            "prev_normalized": F.lower("prev"),
            "curr_normalized": F.lower("curr"),
            "prev_category": page_category(F.col("prev")),
            "curr_category": page_category(F.col("curr")),
        }
    )


def in_months(df: DataFrame, months: list[str]) -> DataFrame:
    """Month filter on the bare column, so that partitions are pruned."""
    return df.filter(F.col("month").isin(months))
