"""Gold layer over silver activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions.activity import (
    HEATMAP_LOWEST, HEATMAP_TIERS, grid_col_sql, grid_row_sql, row_total_sql,
)
from tessera.operators.cleaning import current
from tessera.operators.order_stats import tier_by_percent_rank
from tessera.schema import ACTIVITY


def _over_activity(function, prefix: str) -> list:
    return [function(c).alias(f"{prefix}_{c}") for c in ACTIVITY]


def hourly_grid_activity(silver: DataFrame) -> DataFrame:
    """The weekly profile of each square: one row per hour of the week in which it had records."""
    return current(silver).groupBy("square_id", "hour_of_day", "day_of_week").agg(
        *_over_activity(F.avg, "avg"),
        F.max("internet").alias("peak_internet"),
        F.count(F.lit(1)).alias("record_count"),
    )


def daily_country_usage(silver: DataFrame) -> DataFrame:
    """Sums per country and day, with the squares that had records.

    Aggregated per square first: the second step then counts squares without a
    distinct, and a country holding most rows reaches the shuffle as one row per
    square, day and map task. ``partials`` has stored sketches for longer spans.
    """
    per_square = current(silver).groupBy("country_code", "date", "square_id").agg(
        *_over_activity(F.sum, "total"), F.count(F.lit(1)).alias("record_count")
    )
    return per_square.groupBy("country_code", "date").agg(
        *[F.sum(f"total_{c}").alias(f"total_{c}") for c in ACTIVITY],
        F.sum("record_count").alias("record_count"),
        F.count("square_id").alias("active_squares"),
    )


def square_totals(silver: DataFrame) -> DataFrame:
    """What each square has summed up to, and where it lies."""
    sums = current(silver).groupBy("square_id").agg(
        *_over_activity(F.sum, "total"),
        F.max("internet").alias("peak_internet"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return sums.withColumns(
        {
            "total_activity": F.expr(row_total_sql([f"total_{c}" for c in ACTIVITY])),
            "grid_row": F.expr(grid_row_sql()),
            "grid_col": F.expr(grid_col_sql()),
        }
    )


def grid_heatmap(silver: DataFrame) -> DataFrame:
    """Square totals with a tier from the percent rank of total activity."""
    return tier_by_percent_rank(
        square_totals(silver), "total_activity", HEATMAP_TIERS, HEATMAP_LOWEST, "activity_tier"
    )


def anomaly_summary(scores: DataFrame) -> DataFrame:
    """Rows, mean error and mean internet activity per predicted class."""
    return scores.groupBy("anomaly_type_predicted").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("reconstruction_error").alias("avg_reconstruction_error"),
        F.avg("internet").alias("avg_internet"),
    )
