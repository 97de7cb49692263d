"""Names, types and fixed values shared by all layers."""

from __future__ import annotations

from pyspark.sql import types as T

PIPELINE_VERSION = "tessera-1"      # written beside every ingested row

# ---- fixed values: column names and the layout of the raw feed ----
ACTIVITY = ["sms_in", "sms_out", "call_in", "call_out", "internet"]
NATURAL_KEY = ["square_id", "time_interval", "country_code"]
FLAGS = ["_has_negative_activity", "_is_future_timestamp", "_is_null_activity"]
RAW_GLOB = "sms-call-internet-mi-*.txt"
SLOT_MS = 600_000
GRID_WIDTH = 100

_KEY_TYPES = [T.IntegerType(), T.LongType(), T.IntegerType()]

RAW_ACTIVITY = T.StructType(
    [T.StructField(n, t) for n, t in zip(NATURAL_KEY, _KEY_TYPES)]
    + [T.StructField(n, T.DoubleType()) for n in ACTIVITY]
)

LABELLED_ACTIVITY = T.StructType(
    RAW_ACTIVITY.fields
    + [
        T.StructField("is_anomaly_injected", T.BooleanType()),
        T.StructField("anomaly_type", T.StringType()),
    ]
)

LINEAGE_TABLE = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("dropped", T.LongType()),
        T.StructField("suspicious_flagged", T.LongType()),
    ]
)

LINEAGE_DOCUMENT = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("pipeline", T.StringType()),
        T.StructField("run_timestamp", T.StringType()),
        T.StructField("tables", T.ArrayType(LINEAGE_TABLE)),
    ]
)

VALIDATION_RESULT = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("checks_total", T.LongType()),
        T.StructField("checks_passed", T.LongType()),
        T.StructField("failures", T.ArrayType(T.StringType())),
        T.StructField("null_counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("row_count", T.LongType()),
        T.StructField("duplicate_count", T.LongType()),
    ]
)

TABLE_STATS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("rows_before", T.LongType()),
        T.StructField("rows_after", T.LongType()),
        T.StructField("dropped", T.LongType()),
        T.StructField("suspicious_flagged", T.LongType()),
    ]
)

QUALITY_DOCUMENT = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("generated_at", T.StringType()),
        T.StructField("overall_quality_score", T.DoubleType()),
        T.StructField("table_stats", T.ArrayType(TABLE_STATS)),
        T.StructField("validation_results", T.ArrayType(VALIDATION_RESULT)),
    ]
)
