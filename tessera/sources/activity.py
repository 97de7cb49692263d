"""Activity feeds: daily delimited files, and records derived from an event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from tessera.functions.activity import event_date
from tessera.schema import (
    ACTIVITY, LABELLED_ACTIVITY, NATURAL_KEY, PIPELINE_VERSION, RAW_ACTIVITY, RAW_GLOB, SLOT_MS,
)

CORRUPT = "_corrupt_record"
RAW_OR_CORRUPT = T.StructType(RAW_ACTIVITY.fields + [T.StructField(CORRUPT, T.StringType())])

# Event type -> activity column (fixed values of the test tables).
EVENT_COLUMNS = {
    "click": "sms_in",
    "view": "sms_out",
    "purchase": "call_in",
    "signup": "call_out",
    "error": "internet",
}


def read_raw(spark: SparkSession, folder: str, glob: str = RAW_GLOB) -> DataFrame:
    """All daily files: tab-separated, no header, fixed schema.

    Lines that do not fit the schema keep their text in ``_corrupt_record``
    instead of failing the batch.
    """
    return (
        spark.read.schema(RAW_OR_CORRUPT)
        .options(sep="\t", header="false", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .csv(f"{folder.rstrip('/')}/{glob}")
    )


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated activity with a header and the two label columns."""
    return spark.read.schema(LABELLED_ACTIVITY).option("header", "true").csv(path)


def _whole_line() -> Column:
    # Always true. Spark parses only the columns a query uses, and judges a line
    # by them; naming all columns makes the verdict the same in every query.
    names = ", ".join(f"CAST({c} AS STRING)" for c in RAW_ACTIVITY.fieldNames())
    return F.expr(f"size(array({names})) > 0")


def with_audit_columns(df: DataFrame, batch_id: str, version: str = PIPELINE_VERSION,
                       source: str | None = None) -> DataFrame:
    """Ingest time, source file, batch, version and the date partition.

    ``source`` names the origin where the rows do not come from files.
    """
    origin = F.col("_metadata.file_path") if source is None else F.lit(source)
    return df.select(
        "*",
        F.current_timestamp().alias("_bronze_ingested_at"),
        origin.alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
        F.lit(version).alias("_pipeline_version"),
        event_date().alias("_date_partition"),
    )


# ---- bronze: every line once, told apart by verdict ----
VERDICT, ACCEPTED, REJECTED = "_verdict", "accepted", "rejected"
BRONZE_PARTITIONS = [VERDICT, "_date_partition"]


def with_verdict(lines: DataFrame, batch_id: str) -> DataFrame:
    """Parsed lines with audit columns and a verdict: whether the line fits the schema.

    A rejected line keeps its text, and nulls where a field did not parse.
    """
    verdict = F.when(F.col(CORRUPT).isNull(), ACCEPTED).otherwise(REJECTED)
    # The file's description is a column where the lines come through a stream.
    return with_audit_columns(lines.where(_whole_line()), batch_id).withColumn(VERDICT, verdict).drop("_metadata")


def bronze(spark: SparkSession, folder: str, batch_id: str, glob: str = RAW_GLOB) -> DataFrame:
    """Raw files as the bronze table: every line, unchanged, plus audit columns and verdict; one parse."""
    return with_verdict(read_raw(spark, folder, glob), batch_id)


def records_of(bronze_table: DataFrame) -> DataFrame:
    """The rows of a bronze table as records; partly readable lines are among them, with nulls."""
    return bronze_table.drop(VERDICT, CORRUPT)


def rejects_of(bronze_table: DataFrame) -> DataFrame:
    """File, text, time and batch of every line that does not fit the schema; reads their partition only."""
    return bronze_table.where(F.col(VERDICT) == REJECTED).select(
        "_source_file", CORRUPT, F.col("_bronze_ingested_at").alias("_rejected_at"), "_batch_id")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_table_if_present(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """None where the table was never written; works on any file system Spark knows."""
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def records_from_events(events: DataFrame, squares: int = 10_000, slot_ms: int = SLOT_MS) -> DataFrame:
    """One raw activity record per event; a projection, so no shuffle.

    Two events of a user in one slot give two records with the same key, which
    is what the deduplication of the silver layer is for.
    """
    ms = "unix_millis(CAST(ts AS TIMESTAMP))"
    return events.selectExpr(
        f"CAST(user_id % {squares} + 1 AS INT) AS square_id",
        f"{ms} - pmod({ms}, {slot_ms}L) AS time_interval",
        "CAST(user_id % 7 + 39 AS INT) AS country_code",
        *[f"CASE WHEN event_type = '{event}' THEN value END AS {c}" for event, c in EVENT_COLUMNS.items()],
    )


def activity_from_events(events: DataFrame, squares: int = 10_000, slot_ms: int = SLOT_MS) -> DataFrame:
    """Activity per (square, slot, country): one column per event type."""
    sums = [F.sum(c).alias(c) for c in ACTIVITY]
    return records_from_events(events, squares, slot_ms).groupBy(*NATURAL_KEY).agg(*sums)
