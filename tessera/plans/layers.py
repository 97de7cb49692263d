"""The layers end to end: raw files -> bronze -> silver -> scores -> gold -> governance.

Each stage reads written tables, writes its own in one pass (counts of written
rows are observed during the write) and adds a lineage document.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from tessera.operators import aggregates, cleaning, detector, governance, partials, report, rules
from tessera.schema import LINEAGE_DOCUMENT, QUALITY_DOCUMENT, RAW_GLOB
from tessera.session import BOUNDED_TASKS, settings
from tessera.sources import activity, sinks


@dataclass(frozen=True)
class Layout:
    """Where everything lives; any folder Spark can reach."""

    root: str
    raw: str
    glob: str = RAW_GLOB
    fmt: str = "parquet"

    def table(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    @property
    def lineage(self) -> str:
        return f"{self.root}/governance/lineage"

    @property
    def files(self) -> str:
        return f"{self.root}/governance/files"

    @property
    def quality(self) -> str:
        return f"{self.root}/governance/quality"

    @property
    def reports(self) -> str:
        return f"{self.root}/governance/reports"

    @property
    def catalog(self) -> str:
        return f"{self.root}/governance/catalog"

    @property
    def model(self) -> str:
        return f"{self.root}/models/detector"


    @property
    def model_metadata(self) -> str:
        return f"{self.root}/models/detector_metadata"


def _stage(run):
    """A stage whose tasks read so little at once that their sorts and aggregations stay small."""
    @wraps(run)
    def bounded(spark: SparkSession, *args, **kwargs):
        with settings(spark, BOUNDED_TASKS):
            return run(spark, *args, **kwargs)
    return bounded


def _record(spark: SparkSession, layout: Layout, layer: str, batch_id: str, pipeline: str,
            tables: list[dict]) -> None:
    document = governance.lineage_document(spark, layer, batch_id, pipeline, tables)
    sinks.write_documents(document.coalesce(1), layout.lineage)


@_stage
def run_bronze(spark: SparkSession, layout: Layout, batch_id: str, reload_days: bool = False) -> int | None:
    """Ingest all raw files in one parse and one write; None where there are none.

    Every line comes to lie under its verdict and day, so lines that do not fit the schema can be
    read with their text by themselves. The batch's files, with their lines and rejects, are noted.

    ``reload_days`` replaces only the days found in the files, under the verdicts found there: where a
    mended file has no rejected line any more, the day's old ones stay.
    """
    try:
        rows = activity.bronze(spark, layout.raw, batch_id, layout.glob)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    target = layout.table("bronze.cdr_records")
    count = sinks.write_table(rows, target, partition_by=activity.BRONZE_PARTITIONS,
                              only_given_partitions=reload_days, fmt=layout.fmt)["rows"]
    mine = activity.read_table(spark, target, layout.fmt).where(F.col("_batch_id") == batch_id)
    sinks.write_table(governance.file_lineage(mine), layout.files, partition_by="batch_id",
                      only_given_partitions=True, fmt=layout.fmt)
    _record(spark, layout, "bronze", batch_id, "ingest_lines", [
        {"table": "cdr_records", "source": layout.raw, "target": target, "rows": count}])
    return count


def rejects(spark: SparkSession, layout: Layout) -> DataFrame:
    """File, text, time and batch of every line that does not fit the schema."""
    return activity.rejects_of(activity.read_table(spark, layout.table("bronze.cdr_records"), layout.fmt))


@_stage
def run_silver(spark: SparkSession, layout: Layout, batch_id: str, as_of: Column | None = None,
               days: tuple[str, str] | None = None) -> dict:
    """Clean, flag and deduplicate bronze, then validate the written table.

    ``days`` limits the run to a range of dates: only those bronze partitions are
    read and only those silver partitions replaced. Copies of a key share their
    date, so a day can be deduplicated by itself.
    """
    source, target = layout.table("bronze.cdr_records"), layout.table("silver.cdr_records")
    bronze = activity.records_of(activity.read_table(spark, source, layout.fmt))
    if days:
        bronze = bronze.where(F.col("_date_partition").between(*[F.lit(d).cast("date") for d in days]))
    kept = sinks.write_table(
        cleaning.silver(bronze, as_of, batch_id).drop("_date_partition"), target, partition_by="date",
        only_given_partitions=days is not None, fmt=layout.fmt, suspicious=F.count_if(cleaning.any_flag()))
    before = bronze.count()     # answered from file footers
    stats = {
        "table": "cdr_records",
        "rows_before": before,
        "rows_after": kept["rows"],
        "dropped": before - kept["rows"],
        "suspicious_flagged": kept["suspicious"],
    }
    written = activity.read_table(spark, target, layout.fmt)
    results = rules.validate(written, rules.ACTIVITY_RULES, "cdr_records")
    table_stats = spark.createDataFrame([stats], QUALITY_DOCUMENT["table_stats"].dataType.elementType)
    document = report.quality_document("silver", batch_id, table_stats, results)
    sinks.write_documents(document.coalesce(1), layout.quality)
    mine = sinks.read_documents(spark, layout.quality, QUALITY_DOCUMENT).where(F.col("batch_id") == batch_id)
    sinks.write_text(report.markdown(mine), f"{layout.reports}/silver_quality_{batch_id}")
    _record(spark, layout, "silver", batch_id, "flag_and_deduplicate", [
        {**stats, "source": source, "target": target}])
    return stats


@_stage
def run_detector(spark: SparkSession, layout: Layout, batch_id: str, rank: int = detector.BOTTLENECK,
                 percentile: float = detector.PERCENTILE, tolerance: float = 0.0) -> detector.Detector:
    """Fit on clean silver rows, keep the fitted numbers, score every row."""
    source, target = layout.table("silver.cdr_records"), layout.table("silver.anomaly_scores")
    silver = activity.read_table(spark, source, layout.fmt)
    model = detector.fit(silver, rank, percentile)
    model.save(spark, layout.model)
    sinks.write_text(spark.createDataFrame([(1, model.metadata())], "line_no int, line string"), layout.model_metadata)
    scores = detector.score(silver, model, tolerance).withColumn("_scored_at", F.current_timestamp())
    count = sinks.write_table(scores, target, fmt=layout.fmt)["rows"]
    _record(spark, layout, "silver", batch_id, "score_records", [
        {"table": "anomaly_scores", "source": source, "target": target, "rows": count}])
    return model


@_stage
def run_partials(spark: SparkSession, layout: Layout, days: tuple[str, str] | None = None) -> DataFrame:
    """Write the partial states of silver, of all days or of a range, and return those of all days.

    With ``days`` only those silver partitions are read, and only those states replaced.
    """
    silver = activity.read_table(spark, layout.table("silver.cdr_records"), layout.fmt)
    target = layout.table("state.day_partials")
    if days is not None:
        chosen = silver.where(F.col("date").between(*[F.lit(d).cast("date") for d in days]))
        sinks.replace_days(partials.day_partials(chosen), target, "date", days, layout.fmt)
    else:
        sinks.write_table(partials.day_partials(silver), target, partition_by="date", fmt=layout.fmt)
    return activity.read_table(spark, target, layout.fmt)


@_stage
def run_gold(spark: SparkSession, layout: Layout, batch_id: str, days: tuple[str, str] | None = None) -> dict[str, int]:
    """The gold tables, from the partial states; the anomaly summary only where scores exist.

    ``days`` names the days whose silver has changed since the last run: no other silver day is read.
    """
    source = layout.table("silver.cdr_records")
    states = run_partials(spark, layout, days)
    plans: list[tuple[str, DataFrame, str, list[str] | None]] = [
        ("hourly_grid_activity", partials.hourly_grid_activity(states), source, ["square_id", "hour_of_day"]),
        ("daily_country_usage", partials.daily_country_usage(states), source, ["date", "country_code"]),
        ("grid_heatmap", partials.grid_heatmap(states), source, None),
    ]
    sinks.write_table(partials.square_sketches(states), layout.table("state.square_sketches"), fmt=layout.fmt)
    scores_path = layout.table("silver.anomaly_scores")
    scores = activity.read_table_if_present(spark, scores_path, layout.fmt)
    if scores is not None:
        plans.append(("anomaly_summary", aggregates.anomaly_summary(scores), scores_path, None))
    counts, records = {}, []
    for name, rows, origin, order in plans:
        rows = rows.withColumns(
            {"_gold_processed_at": F.current_timestamp(), "_gold_batch_id": F.lit(batch_id)})
        target = layout.table(f"gold.{name}")
        counts[name] = sinks.write_table(rows, target, sort_by=order, fmt=layout.fmt)["rows"]
        records.append({"table": name, "source": origin, "target": target, "rows": counts[name]})
    _record(spark, layout, "gold", batch_id, "aggregate_squares", records)
    return counts


def lineage(spark: SparkSession, layout: Layout) -> DataFrame:
    return governance.lineage_tables(sinks.read_documents(spark, layout.lineage, LINEAGE_DOCUMENT))


def quality(spark: SparkSession, layout: Layout) -> DataFrame:
    return report.latest_documents(sinks.read_documents(spark, layout.quality, QUALITY_DOCUMENT))


def written_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    found = {n: activity.read_table_if_present(spark, layout.table(n), layout.fmt) for n in governance.CATALOG}
    return {name: df for name, df in found.items() if df is not None}


def gold_metrics(spark: SparkSession, layout: Layout) -> DataFrame:
    tables = written_tables(spark, layout)
    return governance.gold_metrics(
        *[tables.get(f"gold.{n}") for n in ("hourly_grid_activity", "daily_country_usage", "grid_heatmap")])


def scorecard(spark: SparkSession, layout: Layout) -> DataFrame:
    results = quality(spark, layout).select("layer", F.inline("validation_results"))
    return governance.scorecard(results.drop("layer"), results.select("layer", "table").distinct())


def sla_status(spark: SparkSession, layout: Layout, as_of: Column | None = None) -> DataFrame:
    """Freshness by processing time, one row per table that records it."""
    stamps = ["_gold_processed_at", "_scored_at", "_silver_processed_at", "_bronze_ingested_at"]
    wanted = {}
    for name, df in written_tables(spark, layout).items():
        stamp = next((s for s in stamps if s in df.columns), None)
        if stamp:
            wanted[name] = (df, F.col(stamp), governance.CATALOG[name].sla_freshness_hours)
    return governance.sla_status(wanted, as_of)


@_stage
def run_governance(spark: SparkSession, layout: Layout, batch_id: str) -> DataFrame:
    """Write the catalog and the fact document of one batch; return the document."""
    catalog = governance.data_catalog(written_tables(spark, layout))
    sinks.write_documents(catalog.withColumn("batch_id", F.lit(batch_id)).coalesce(1), layout.catalog)
    scores = activity.read_table_if_present(spark, layout.table("silver.anomaly_scores"), layout.fmt)
    facts = governance.context_document(
        quality(spark, layout),
        lineage(spark, layout).where(F.col("batch_id") == batch_id),
        None if scores is None else detector.anomaly_bundle(scores),
        gold_metrics(spark, layout),
    )
    path = f"{layout.reports}/governance_facts_{batch_id}"
    facts.coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).withColumnRenamed("value", "document")


def run_all(spark: SparkSession, layout: Layout, batch_id: str, as_of: Column | None = None,
            rank: int = detector.BOTTLENECK, tolerance: float = 0.0) -> None:
    if run_bronze(spark, layout, batch_id) is None:
        return
    run_silver(spark, layout, batch_id, as_of)
    run_detector(spark, layout, batch_id, rank, tolerance=tolerance)
    run_gold(spark, layout, batch_id)
    run_governance(spark, layout, batch_id)
