"""Gold tables from mergeable partial states, one set per day.

A day of silver is reduced to sums, counts and maxima per square, country and hour. All gold tables
follow from these partials, so after a day is delivered again only that day's silver is read; its
partials replace the old ones. Distinct squares do not add up over days: for any span of days they come
from the partials exactly, or from sketches stored per country and day, which can be united.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions.activity import HEATMAP_LOWEST, HEATMAP_TIERS, grid_col_sql, grid_row_sql, row_total_sql
from tessera.operators.cleaning import current
from tessera.operators.order_stats import tier_by_percent_rank
from tessera.schema import ACTIVITY

CELL = ["square_id", "country_code", "hour_of_day", "day_of_week"]
TOTALS = [f"total_{c}" for c in ACTIVITY]
SKETCH_LOG2 = 12
# The estimate's standard error is 1.04 / sqrt(2^SKETCH_LOG2) of the count or less.
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG2 / 2)


def day_partials(silver: DataFrame) -> DataFrame:
    """Sums, peak and rows per date and cell of the dated rows that are not in the future."""
    return current(silver).groupBy("date", *CELL).agg(
        *[F.sum(c).alias(f"total_{c}") for c in ACTIVITY],
        F.max("internet").alias("peak_internet"),
        F.count(F.lit(1)).alias("record_count"),
    )


def _merged(partials: DataFrame, key: list[str], *more) -> DataFrame:
    return partials.groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in TOTALS], *more, F.sum("record_count").alias("record_count"))


def hourly_grid_activity(partials: DataFrame) -> DataFrame:
    """Average and peak activity per square, hour of day and day of week."""
    sums = _merged(partials, ["square_id", "hour_of_day", "day_of_week"], F.max("peak_internet").alias("peak_internet"))
    return sums.select(
        "square_id", "hour_of_day", "day_of_week",
        *[(F.col(f"total_{c}") / F.col("record_count")).alias(f"avg_{c}") for c in ACTIVITY],
        "peak_internet", "record_count")


def daily_country_usage(partials: DataFrame) -> DataFrame:
    """Total activity and number of active squares per country and day."""
    per_square = _merged(partials, ["country_code", "date", "square_id"])
    return _merged(per_square, ["country_code", "date"], F.count("square_id").alias("active_squares"))


def grid_heatmap(partials: DataFrame) -> DataFrame:
    """Cumulative activity, grid position and tier per square."""
    sums = _merged(partials, ["square_id"], F.max("peak_internet").alias("peak_internet")).withColumns({
        "total_activity": F.expr(row_total_sql(TOTALS)),
        "grid_row": F.expr(grid_row_sql()), "grid_col": F.expr(grid_col_sql())})
    return tier_by_percent_rank(sums, "total_activity", HEATMAP_TIERS, HEATMAP_LOWEST, "activity_tier")


def square_sketches(partials: DataFrame) -> DataFrame:
    """A sketch of the squares of every country and day; of a few kilobytes, whatever it saw."""
    return partials.groupBy("country_code", "date").agg(
        F.hll_sketch_agg("square_id", SKETCH_LOG2).alias("squares"))


def distinct_squares(sketches: DataFrame, key: list[str]) -> DataFrame:
    """Estimated distinct squares per ``key``, from united sketches of all its days."""
    united = F.hll_sketch_estimate(F.hll_union_agg("squares"))
    return sketches.groupBy(*key).agg(united.alias("estimated_squares"))


def exact_squares(partials: DataFrame, key: list[str]) -> DataFrame:
    """Distinct squares per ``key``, counted; two aggregations, so no group is held in one task."""
    return partials.select(*key, "square_id").where("square_id IS NOT NULL").distinct().groupBy(*key).agg(
        F.count(F.lit(1)).alias("exact_squares"))


def within_bound(estimated, exact, sigmas: float = 4.0):
    """Whether an estimate lies within ``sigmas`` standard errors, one square at least."""
    return F.abs(estimated - exact) <= F.greatest(F.lit(1.0), F.lit(sigmas * SKETCH_ERROR) * exact)
