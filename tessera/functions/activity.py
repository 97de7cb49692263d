"""Expressions over activity records.

Written as SQL text: an expression of a hundred nodes is then one call to the
JVM. Each function named ``*_sql`` returns text, the others a Column.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tessera.schema import ACTIVITY, GRID_WIDTH

# Last millisecond of year 9999: later values have no calendar date.
_LAST_MS = 253_402_300_799_999

# ---- fixed values: tiers, classes and their limits ----
HEATMAP_TIERS = [(0.80, "High"), (0.40, "Medium")]
HEATMAP_LOWEST = "Low"
DEAD_ZONE_BELOW = 0.01


def known_sql(value: str) -> str:
    """The value, with NaN read as null."""
    return f"nanvl({value}, CAST(NULL AS DOUBLE))"


def event_time_sql(ms: str = "time_interval") -> str:
    """Epoch milliseconds to timestamp; null where no calendar date exists."""
    return f"CASE WHEN {ms} BETWEEN {-_LAST_MS} AND {_LAST_MS} THEN timestamp_millis({ms}) END"


def event_date(ms: str = "time_interval") -> Column:
    return F.expr(f"to_date({event_time_sql(ms)})")


def is_future(as_of: Column | None = None, ms: str = "time_interval") -> Column:
    """Strictly later than ``as_of`` (whole seconds, default now); null is not future."""
    now = F.current_timestamp() if as_of is None else as_of
    return F.coalesce(F.col(ms) > F.unix_seconds(now) * 1000, F.lit(False))


def has_negative_sql(columns: list[str] = ACTIVITY) -> str:
    return " OR ".join(f"coalesce({known_sql(c)} < 0, false)" for c in columns)


def all_missing_sql(columns: list[str] = ACTIVITY) -> str:
    return " AND ".join(f"{known_sql(c)} IS NULL" for c in columns)


def cleaned_sql(value: str) -> str:
    """Missing becomes 0 and negatives are clipped to 0."""
    return f"greatest(coalesce({known_sql(value)}, 0D), 0D)"


def lenient_number_sql(text: str) -> str:
    """Text to double; anything unreadable becomes 0."""
    return f"coalesce(try_cast({text} AS DOUBLE), 0D)"


def row_total_sql(columns: list[str]) -> str:
    return " + ".join(columns)


def grid_row_sql(square: str = "square_id") -> str:
    return f"CAST(({square} - 1) / {GRID_WIDTH} AS INT)"


def grid_col_sql(square: str = "square_id") -> str:
    return f"CAST(({square} - 1) % {GRID_WIDTH} AS INT)"


def anomaly_class_sql(is_anomaly: str) -> str:
    """Class of a scored row: the first reason that applies, in this order."""
    strongest = f"greatest({', '.join(f'coalesce({known_sql(c)}, 0D)' for c in ACTIVITY)})"
    return f"""CASE
        WHEN NOT coalesce({is_anomaly}, false) THEN 'normal'
        WHEN _is_future_timestamp THEN 'future_timestamp'
        WHEN _is_null_activity THEN 'null_activity'
        WHEN _has_negative_activity THEN 'negative_activity'
        WHEN {strongest} < {DEAD_ZONE_BELOW} THEN 'dead_zone'
        ELSE 'activity_spike' END"""


def present(df, columns: list[str]) -> list[str]:
    """The wanted columns that ``df`` has, in the wanted order."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def number_sql(value: float | int | None) -> str:
    """A number as an exact double literal."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    text = repr(float(value))
    return f"double('{text}')" if text in ("nan", "inf", "-inf") else f"{text}D"


def string_sql(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
