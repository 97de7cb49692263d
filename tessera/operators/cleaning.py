"""Silver layer: calendar fields, flags, clipping, deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.functions.activity import (
    all_missing_sql, cleaned_sql, event_time_sql, has_negative_sql, is_future,
)
from tessera.schema import ACTIVITY, FLAGS, NATURAL_KEY


def flag_and_clean(records: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Calendar fields and quality flags of the raw values, then the cleaned values.

    Everything is one projection. Flags are true or false, never null, and
    describe the values before clipping.
    """
    flagged = records.select(
        "*",
        F.expr(event_time_sql()).alias("event_time"),
        F.expr(has_negative_sql()).alias("_has_negative_activity"),
        is_future(as_of).alias("_is_future_timestamp"),
        F.expr(all_missing_sql()).alias("_is_null_activity"),
    )
    changed = {
        **{c: cleaned_sql(c) for c in ACTIVITY},
        "hour_of_day": "hour(event_time)",
        "day_of_week": "dayofweek(event_time)",
        "date": "to_date(event_time)",
    }
    kept = [c for c in flagged.columns if c not in changed]
    return flagged.selectExpr(*kept, *[f"{text} AS {name}" for name, text in changed.items()])


def deduplicate(df: DataFrame, key: list[str] = NATURAL_KEY, order: list[Column] | None = None) -> DataFrame:
    """One row per key, the first in a fixed order (default: all other columns).

    Ranking with a ``= 1`` filter lets Spark cut each map task's copies of a key
    down to one before the shuffle, so a key with very many copies costs no more
    in the reduce task than any other.
    """
    if order is None:
        order = [F.col(c).asc_nulls_last() for c in df.columns if c not in key]
    first = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def silver(records: DataFrame, as_of: Column | None = None, batch_id: str | None = None) -> DataFrame:
    """Deduplicated, flagged and cleaned records; audit columns if a batch is named.

    Duplicates go first, so that only raw columns are sorted and shuffled; the
    derived columns depend on nothing but their own row.
    """
    rows = flag_and_clean(deduplicate(records, NATURAL_KEY), as_of)
    if batch_id is None:
        return rows
    return rows.withColumns(
        {"_silver_processed_at": F.current_timestamp(), "_silver_batch_id": F.lit(batch_id)}
    )


def any_flag() -> Column:
    return F.expr(" OR ".join(FLAGS))


def suspicious(df: DataFrame) -> DataFrame:
    return df.where(any_flag())


def clean(df: DataFrame) -> DataFrame:
    return df.where(~any_flag())


def current(df: DataFrame) -> DataFrame:
    """Rows gold tables may use: dated and not in the future."""
    return df.where(~F.col("_is_future_timestamp") & F.col("event_time").isNotNull())


def stage_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before, after, dropped and flagged, as one row."""
    total = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    return after.agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count_if(any_flag()).alias("suspicious_flagged"),
    ).select(
        total.alias("rows_before"),
        "rows_after",
        (total - F.col("rows_after")).alias("dropped"),
        "suspicious_flagged",
    )
