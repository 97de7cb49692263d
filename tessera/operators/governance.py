"""Lineage, metrics, catalog and freshness as ordinary tables."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.schema import LINEAGE_DOCUMENT, LINEAGE_TABLE


# ---------------------------------------------------------------- lineage

def lineage_document(spark: SparkSession, layer: str, batch_id: str, pipeline: str, tables: list[dict],
                     run_timestamp: Column | None = None) -> DataFrame:
    """One document per stage run; ``tables`` are the records of the tables it wrote."""
    rows = [tuple(t.get(name) for name in LINEAGE_TABLE.fieldNames()) for t in tables]
    when = F.current_timestamp().cast("string") if run_timestamp is None else run_timestamp
    document = spark.createDataFrame([(layer, batch_id, pipeline, rows)],
                                     "layer string, batch_id string, pipeline string, "
                                     f"tables array<{LINEAGE_TABLE.simpleString()}>")
    return document.withColumn("run_timestamp", when).select(*LINEAGE_DOCUMENT.fieldNames())


def lineage_tables(documents: DataFrame) -> DataFrame:
    """One row per table written."""
    return documents.select("layer", "batch_id", "pipeline", F.inline("tables"))


def batch_history(tables: DataFrame) -> DataFrame:
    """Batches per table with their rows: what a table's history shows."""
    rows = F.coalesce("rows", "rows_after")
    return tables.groupBy("layer", "table", "batch_id").agg(F.sum(rows).alias("rows"))


def file_lineage(bronze: DataFrame) -> DataFrame:
    """Lines, rejected lines and ingest time of every file of every batch."""
    from tessera.sources.activity import REJECTED, VERDICT

    return bronze.groupBy(F.col("_batch_id").alias("batch_id"), F.col("_source_file").alias("file")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(VERDICT) == REJECTED).alias("rejected"),
        F.max("_bronze_ingested_at").alias("ingested_at"))


# Every way through the recorded writes, from every table that something is made from. A way ends at
# the first table that it meets again. Beyond Spark's limits of a recursion the query fails; it is not cut.
_WALKS = """
edges AS (
  SELECT DISTINCT source, target FROM {tables} WHERE source IS NOT NULL AND target IS NOT NULL),
walks (origin, final, path, steps, cycle) AS (
  SELECT DISTINCT source, source, array(source), 0, false FROM edges
  UNION ALL
  SELECT w.origin, e.target, array_append(w.path, e.target), w.steps + 1, array_contains(w.path, e.target)
  FROM walks w JOIN edges e ON e.source = w.final WHERE NOT w.cycle)"""


def lineage_flow(tables: DataFrame) -> DataFrame:
    """All chains source -> ... -> target over the recorded writes, of any length, in one query.

    A chain starts at a table nothing writes to and ends at one nothing is made from,
    or, with ``cycle`` true, at the first table that it meets again. Tables that no
    chain reaches lie on circles without an entrance; the least that no lesser one leads to starts one.
    Lineage has a row for each table and run, so this stays small.
    """
    return tables.sparkSession.sql(f"""WITH RECURSIVE {_WALKS},
reach AS (SELECT DISTINCT origin, final FROM walks WHERE steps > 0),
entries AS (SELECT DISTINCT source FROM edges WHERE source NOT IN (SELECT target FROM edges)),
loose AS (
  SELECT DISTINCT source FROM edges
  WHERE source NOT IN (SELECT source FROM entries)
    AND source NOT IN (SELECT final FROM reach WHERE origin IN (SELECT source FROM entries))),
led AS (
  SELECT r.final AS source FROM reach r JOIN loose l ON l.source = r.origin WHERE r.origin < r.final),
starts AS (
  SELECT source FROM entries
  UNION ALL SELECT source FROM loose WHERE source NOT IN (SELECT source FROM led))
SELECT origin, final, array_join(path, ' > ') AS flow, steps, cycle FROM walks
WHERE steps > 0 AND origin IN (SELECT source FROM starts)
  AND (cycle OR final NOT IN (SELECT source FROM edges))""", tables=tables)


def lineage_impact(tables: DataFrame) -> DataFrame:
    """For every table what it is made from (upstream) and what is made from it (downstream), and how many steps away."""
    return tables.sparkSession.sql(f"""WITH RECURSIVE {_WALKS},
near AS (SELECT origin, final, min(steps) AS steps FROM walks WHERE steps > 0 GROUP BY origin, final)
SELECT origin AS table_name, 'downstream' AS direction, final AS other, steps FROM near
UNION ALL SELECT final, 'upstream', origin, steps FROM near""", tables=tables)


# ---------------------------------------------------------------- metrics

def _metric(table: str, name: str, value: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(name).alias("metric"), value.cast("double").alias("value")
    )


def _columns_metric(table: str, df: DataFrame) -> Column:
    """Columns of a table, but for those that say when and by which batch a row was written."""
    return _metric(table, "columns", F.lit(len([c for c in df.columns if not c.startswith("_")])))


def gold_metrics(hourly: DataFrame | None, daily: DataFrame | None, heatmap: DataFrame | None) -> DataFrame:
    """Row counts and summaries of the gold tables that exist, one metric per row."""
    parts = []
    if hourly is not None:
        parts.append(
            hourly.agg(F.count(F.lit(1)).alias("n")).select(
                F.inline(F.array(_metric("hourly_grid_activity", "row_count", F.col("n")),
                                 _columns_metric("hourly_grid_activity", hourly)))
            )
        )
    if daily is not None:
        summary = daily.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("total_internet"), F.lit(0.0)).alias("internet"),
            F.count_distinct("country_code").alias("countries"),
            F.count_distinct("date").alias("days"),
        )
        names = {"row_count": "n", "total_internet": "internet",
                 "unique_countries": "countries", "active_days": "days"}
        parts.append(
            summary.select(F.inline(F.array(
                *[_metric("daily_country_usage", name, F.col(c)) for name, c in names.items()],
                _columns_metric("daily_country_usage", daily))))
        )
    if heatmap is not None:
        tiers = tier_distribution(heatmap)
        parts.append(
            heatmap.agg(F.count(F.lit(1)).alias("n")).select(
                F.inline(F.array(_metric("grid_heatmap", "row_count", F.col("n")),
                                 _columns_metric("grid_heatmap", heatmap)))
            )
        )
        parts.append(
            tiers.select(
                F.lit("grid_heatmap").alias("table_name"),
                F.concat(F.lit("tier_"), "activity_tier").alias("metric"),
                F.col("count").cast("double").alias("value"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def tier_distribution(heatmap: DataFrame) -> DataFrame:
    return heatmap.groupBy("activity_tier").agg(F.count(F.lit(1)).alias("count"))


def scorecard(results: DataFrame, layers: DataFrame) -> DataFrame:
    """Score, colour and issues per layer and table; ``layers`` maps table to layer."""
    from tessera.operators.rules import band

    score = F.round(F.coalesce(F.try_divide("checks_passed", "checks_total"), F.lit(0.0)) * 100, 1)
    scored = results.withColumn("quality_score", score)
    return scored.join(layers, "table", "left").select(
        F.coalesce("layer", F.lit("unknown")).alias("layer"),
        F.col("table").alias("table_name"),
        "quality_score",
        band(F.col("quality_score")).alias("band"),
        F.array_join("failures", "; ").alias("issues"),
    )


def context_document(quality: DataFrame | None, lineage: DataFrame | None,
                     anomaly: DataFrame | None, gold: DataFrame | None) -> DataFrame:
    """All governance facts as one JSON text; under ``missing``, the parts that do not exist.

    Every part holds a handful of rows per table, not data rows.
    """
    parts, missing = [], []
    for name, frame in [("quality", quality), ("lineage", lineage), ("anomaly", anomaly), ("gold", gold)]:
        if frame is None:
            missing.append(name)
            continue
        rows = frame.agg(F.sort_array(F.collect_list(F.to_json(F.struct(*frame.columns)))).alias("rows"))
        parts.append((name, rows))
    spark = next(f for f in (quality, lineage, anomaly, gold) if f is not None).sparkSession
    texts = [
        F.concat(F.lit(f'"{name}":['), F.array_join(rows.scalar(), ","), F.lit("]")) for name, rows in parts
    ]
    texts.append(F.lit(f'"missing":{json.dumps(missing)}'))
    return spark.range(1).select(
        F.concat(F.lit("{"), F.concat_ws(",", *texts), F.lit("}")).alias("document")
    )


# ---------------------------------------------------------------- catalog

@dataclass(frozen=True)
class Entry:
    """What people declare about a table; everything measurable is measured."""

    layer: str
    description: str
    owner_team: str
    sensitivity: str
    refresh_schedule: str
    sla_freshness_hours: int | None
    primary_key: list[str]
    pii_columns: list[str] = field(default_factory=list)
    partition_key: str | None = None
    tags: list[str] = field(default_factory=list)
    regulatory_notes: str = ""


_LOCATION = "squares locate subscribers: personal data under GDPR Art. 6 and ePrivacy, use bound to its purpose"
_SUMS = "sums over many subscribers, none of them identifiable"
_KEY = ["square_id", "time_interval", "country_code"]

CATALOG = {
    "bronze.cdr_records": Entry(
        "bronze", "One row per line of the daily files, keyed by square, ten-minute slot and country; five activity "
        "measures as delivered, null where a field was empty; file, batch and ingest time; a partition per day",
        "network-data", "restricted", "daily", 24, _KEY, ["square_id"], "_date_partition",
        ["delivered", "ten-minute"], _LOCATION),
    "silver.cdr_records": Entry(
        "silver", "One row per key; no measure is null or below zero; event time, hour, weekday and date in UTC; three "
        "flags tell what the delivered values looked like; a partition per date",
        "network-data", "confidential", "daily", 24, _KEY, ["square_id"], "date",
        ["deduplicated", "flagged", "ten-minute"], _LOCATION),
    "silver.anomaly_scores": Entry(
        "silver", "One row per silver row: mean squared residual of its seven features, whether it exceeds the "
        "threshold of the fitted detector, and the class of the reason",
        "data-science", "confidential", "daily", 36, _KEY, ["square_id"], None,
        ["detector", "ten-minute"], _LOCATION),
    "gold.hourly_grid_activity": Entry(
        "gold", "A typical week of every square: means of the five measures and the highest internet value of 168 hours",
        "analytics", "internal", "daily", 48, ["square_id", "hour_of_day", "day_of_week"], [], None,
        ["weekly profile"], _SUMS),
    "gold.daily_country_usage": Entry(
        "gold", "Sums of the five measures, rows and distinct squares of each calendar day, by the country called",
        "analytics", "internal", "daily", 48, ["country_code", "date"], [], None,
        ["daily sums"], _SUMS),
    "gold.grid_heatmap": Entry(
        "gold", "Sums since the first day for every square, its row and column in the grid, and the tier its total "
        "reaches: High from the 80th, Medium from the 40th percent rank",
        "analytics", "internal", "daily", 48, ["square_id"], [], None,
        ["map", "tiers"], _SUMS),
    "gold.anomaly_summary": Entry(
        "gold", "Rows, mean residual and mean internet value of each class the detector names, normal rows included",
        "data-science", "internal", "daily", 48, ["anomaly_type_predicted"], [], None,
        ["detector", "classes"], _SUMS),
}


def column_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """Name, type, rows and nulls of every column, one aggregation per table."""
    parts = []
    for name, df in tables.items():
        counted = df.agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_known_{i}") for i, c in enumerate(df.columns)]
        )
        rows = [
            F.struct(
                F.lit(name).alias("table_name"), F.lit(i + 1).alias("position"),
                F.lit(c).alias("column_name"), F.lit(t).alias("data_type"),
                F.col("_rows").alias("row_count"), (F.col("_rows") - F.col(f"_known_{i}")).alias("null_count"),
            )
            for i, (c, t) in enumerate(df.dtypes)
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def data_catalog(tables: dict[str, DataFrame], declared: dict[str, Entry] = CATALOG) -> DataFrame:
    """Catalog entries of the tables that exist: declared facts plus schema and row count.

    A table that nobody declared is listed as such, in the layer its name begins with.
    """
    parts = []
    for name, df in tables.items():
        entry = declared.get(name) or Entry(
            name.split(".")[0], "undeclared", "unknown", "unclassified", "unknown", None, [])
        pii = [c for c in entry.pii_columns if c in df.columns]
        words = lambda items: F.lit(items) if items else F.array().cast("array<string>")
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                F.lit(entry.layer).alias("layer"),
                F.lit(entry.description).alias("description"),
                F.lit(entry.owner_team).alias("owner_team"),
                F.lit(entry.sensitivity).alias("sensitivity"),
                words(pii).alias("pii_columns"),
                F.lit(entry.refresh_schedule).alias("refresh_schedule"),
                F.lit(entry.sla_freshness_hours).cast("int").alias("sla_freshness_hours"),
                words(entry.primary_key).alias("primary_key"),
                F.lit(entry.partition_key).cast("string").alias("partition_key"),
                words(entry.tags).alias("tags"),
                F.lit(entry.regulatory_notes).alias("regulatory_notes"),
                words(df.columns).alias("columns"),
                "row_count",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def sla_status(tables: dict[str, tuple[DataFrame, Column, int]], as_of: Column | None = None) -> DataFrame:
    """Age of the newest row of each table against its target in hours.

    ``tables`` maps a name to the frame, its timestamp and the target.
    """
    now = F.current_timestamp() if as_of is None else as_of
    parts = []
    for name, (df, stamp, hours) in tables.items():
        newest = df.agg(F.max(F.unix_seconds(stamp.cast("timestamp"))).alias("newest"))
        age = (F.unix_seconds(now) - F.col("newest")) / 3600.0
        parts.append(
            newest.select(
                F.lit(name).alias("table_name"),
                F.lit(hours).alias("sla_freshness_hours"),
                age.alias("actual_hours"),
                F.when(F.col("newest").isNull(), "no data")
                .when(age <= hours, "met").otherwise("breached").alias("status"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
