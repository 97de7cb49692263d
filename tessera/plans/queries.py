"""Named queries over the test tables, one per operator or small group of operators.

Activity queries run on records derived from ``events`` (one record per event)
with anomalies injected, so that every flag and class occurs. Dates are returned
as text and floating-point results rounded, for comparison across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.activity import grid_col_sql, grid_row_sql, lenient_number_sql
from tessera.functions.hashing import bounded_sample, hash_sample
from tessera.operators import (
    aggregates, cleaning, commerce, detector, evaluation, governance, mixture, moments, order_stats, partials, ranks, report,
    rules,
)
from tessera.plans import layers
from tessera.schema import ACTIVITY, FLAGS, NATURAL_KEY, QUALITY_DOCUMENT, RAW_ACTIVITY
from tessera.session import configure, materialize, scratch_path
from tessera.sources import activity, sinks
from tessera.streaming import ingest, usage

AS_OF_SECONDS = 1_706_745_600          # 2024-02-01 00:00 UTC
ORDERS_AS_OF_SECONDS = 978_307_200     # 2001-01-01 00:00 UTC
EXTREME_FACTOR = 1.9
TOLERANCE = 1e-9
BATCH = "b1"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def as_of():
    return F.timestamp_seconds(F.lit(AS_OF_SECONDS))


def rounded(df: DataFrame, digits: int, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def records(spark: SparkSession, sf: str) -> DataFrame:
    return activity.records_from_events(table(spark, sf, "events"))


def injected(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.inject_anomalies(records(spark, sf))


def bronze_table(spark: SparkSession, sf: str) -> DataFrame:
    """The injected records as the written table that bronze is in practice, for several readers."""
    return materialize(injected(spark, sf), "bronze")


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """For queries with one reader: nothing is written in between."""
    return cleaning.silver(injected(spark, sf), as_of())


def bronze_and_silver(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both as written tables, for queries that read them more than once."""
    bronze = bronze_table(spark, sf)
    return bronze, materialize(cleaning.silver(bronze, as_of()), "silver")


def zscores(spark: SparkSession, sf: str) -> DataFrame:
    return detector.fit_and_score(silver(spark, sf), rank=0, tolerance=TOLERANCE)[1]


# ---------------------------------------------------------------- bronze

def _daily_files(spark: SparkSession, sf: str) -> str:
    """The records as tab-separated files without a header."""
    folder = scratch_path(configure(spark), "raw")
    records(spark, sf).write.options(sep="\t", header="false").csv(folder)
    return folder


def _per_day(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(F.col("_date_partition").cast("string").alias("date_partition"),
                          F.col("_batch_id").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(F.col("_source_file").contains("/part-"), 1)).alias("rows_with_source"),
        *[F.round(F.sum(c), 4).alias(f"total_{c}") for c in ACTIVITY],
        *[F.count(c).alias(f"known_{c}") for c in ACTIVITY],
    )


@query
def bronze_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _per_day(activity.bronze(spark, _daily_files(spark, sf), BATCH, "*.csv"))


def _with_bad_lines(spark: SparkSession, sf: str, folder: str) -> None:
    """Adds planted lines that do not fit the schema: a word for the time, or too few fields."""
    bad = records(spark, sf).where("pmod(time_interval, 12000000) = 0").selectExpr(
        "CASE WHEN country_code % 2 = 0 THEN concat_ws('\t', square_id, 'soon', country_code, '1', '1', '1', '1', '1') "
        "ELSE concat_ws('\t', square_id, time_interval) END AS value")
    bad.write.mode("append").text(folder)


@query
def bronze_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected lines of the daily files and of planted ones, written in the same pass as the accepted."""
    raw, target = _daily_files(spark, sf), scratch_path(spark, "bronze")
    _with_bad_lines(spark, sf, raw)
    sinks.write_table(activity.bronze(spark, raw, BATCH, "part-*"), target, partition_by=activity.BRONZE_PARTITIONS)
    found = activity.rejects_of(activity.read_table(spark, target))
    return found.groupBy(F.col("_corrupt_record").alias("line"), F.col("_batch_id").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(F.col("_source_file").contains("/part-"), 1)).alias("rows_with_source"))


@query
def file_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and rejected lines of each file: one file per day, and a third of the days with a broken line."""
    raw = scratch_path(configure(spark), "raw")
    rows = records(spark, sf).select("*", F.date_format(F.timestamp_millis("time_interval"), "yyyy-MM-dd").alias("day"))
    lines = rows.select("day", F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_ACTIVITY.fieldNames()])
                        .alias("value"))
    broken = rows.select("day").distinct().where("day(CAST(day AS DATE)) % 3 = 0").selectExpr("day", "'no\tnumber' AS value")
    lines.unionByName(broken).repartition("day").write.partitionBy("day").text(raw)
    target = scratch_path(spark, "bronze")
    sinks.write_table(activity.bronze(spark, raw, BATCH, "day=*/part-*"), target, partition_by=activity.BRONZE_PARTITIONS)
    found = governance.file_lineage(activity.read_table(spark, target))
    return found.select("batch_id", F.regexp_extract("file", "day=([0-9-]+)", 1).alias("day"), "row_count", "rejected",
                        F.col("ingested_at").isNotNull().alias("has_ingest_time"))


@query
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    raw, target = _daily_files(spark, sf), scratch_path(spark, "bronze")
    ingest.ingest_new_files(
        spark, raw, target, scratch_path(spark, "progress"), BATCH, "*.csv").awaitTermination()
    return _per_day(spark.read.parquet(target))


_streamed: dict[tuple[str, str], str] = {}
# Which rows arrive when: held back for weeks, a little late, or twice.
_HELD = "square_id % 7 = 3 AND day <= 4"
_SLOW = "square_id % 7 = 4 AND day BETWEEN 9 AND 10"
_TWICE = "square_id % 5 = 0 AND day BETWEEN 9 AND 10"
_ARRIVALS = [
    f"day <= 10 AND NOT ({_HELD}) AND NOT ({_SLOW})",
    f"day BETWEEN 11 AND 20 OR {_SLOW} OR {_TWICE}",
    f"day > 20 OR {_HELD}",
]


def _streamed_usage(spark: SparkSession, sf: str) -> str:
    """Three arrivals of files, each taken by the two streams; once per session."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _streamed:
        raw, root, progress = (scratch_path(spark, name) for name in ("raw", "usage", "progress"))
        cells = materialize(activity.activity_from_events(table(spark, sf, "events")).withColumn(
            "day", F.dayofmonth(F.timestamp_millis("time_interval"))), "cells")
        for arrival in _ARRIVALS:
            cells.where(arrival).drop("day").write.mode("append").options(sep="\t", header="false").csv(raw)
            usage.take_new_files(spark, raw, root, progress, "*.csv", as_of())
        _streamed[key] = root
    return _streamed[key]


@query
def stream_daily_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Sums per country and day of what came in time, copies counted once; the streams run once per session."""
    sums = usage.daily_usage(spark, _streamed_usage(spark, sf))
    return rounded(sums, 4, [f"total_{c}" for c in ACTIVITY]).withColumn("date", F.col("date").cast("string"))


@query
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that came too late, kept apart; the streams run once per session."""
    return usage.set_aside(spark, _streamed_usage(spark, sf)).groupBy(
        "verdict", "country_code", F.to_date("event_time").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("row_count"))


@query
def cdr_activity(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(activity.activity_from_events(table(spark, sf, "events")), 4, ACTIVITY)


@query
def country_series_union(spark: SparkSession, sf: str) -> DataFrame:
    """Home and foreign series put back together by column name."""
    rows = records(spark, sf)
    home = rows.where("country_code <=> 39").withColumn("series", F.lit("home"))
    foreign = rows.where("NOT country_code <=> 39").withColumn("series", F.lit("foreign"))
    return home.unionByName(foreign).groupBy("series", "country_code").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("square_id").alias("squares"))


# ---------------------------------------------------------------- injection

@query
def inject_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return injected(spark, sf)


@query
def anomaly_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.value_counts(injected(spark, sf).where("is_anomaly_injected"), "anomaly_type")


@query
def anomaly_labels(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.labels_of(injected(spark, sf))


@query
def injected_preview(spark: SparkSession, sf: str) -> DataFrame:
    chosen = injected(spark, sf).where("is_anomaly_injected")
    return chosen.select(*NATURAL_KEY, "anomaly_type", "internet").orderBy(
        *NATURAL_KEY, "anomaly_type", F.col("internet").asc_nulls_last()).limit(10)


# ---------------------------------------------------------------- silver

_SILVER = NATURAL_KEY + ACTIVITY + ["hour_of_day", "day_of_week", "date"] + FLAGS


def _silver_view(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.col("date").cast("string")).select(*_SILVER)


@query
def silver_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_view(cleaning.flag_and_clean(injected(spark, sf), as_of()))


@query
def silver_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_view(silver(spark, sf))


@query
def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    bronze = bronze_table(spark, sf)
    return cleaning.stage_counts(bronze, cleaning.silver(bronze, as_of()))


@query
def suspicious_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.suspicious(silver(spark, sf)).select(*NATURAL_KEY, *FLAGS)


@query
def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean(silver(spark, sf)).select(*NATURAL_KEY, *ACTIVITY)


@query
def lenient_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Whole values of the event properties, and the properties themselves, which are no numbers."""
    values = F.array(F.get_json_object("props", "$.k"), F.col("props"))
    text = table(spark, sf, "events").select("event_type", F.explode(values).alias("raw"))
    return text.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("raw").try_cast("double").isNull()).alias("unreadable"),
        F.sum(F.expr(lenient_number_sql("raw"))).alias("total"),
    )


@query
def hash_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return hash_sample(silver(spark, sf), 0.1, NATURAL_KEY).select(*NATURAL_KEY, *ACTIVITY)


@query
def bounded_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The five hundred rows of smallest key hash."""
    rows = materialize(silver(spark, sf).select(*NATURAL_KEY, *ACTIVITY), "silver")
    return bounded_sample(rows, 500, NATURAL_KEY)


@query
def box_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Activity of one corner of the grid in the morning, from a table written along a curve through row, column and hour."""
    target = scratch_path(configure(spark), "clustered")
    rows = silver(spark, sf).selectExpr("*", f"{grid_row_sql()} AS grid_row", f"{grid_col_sql()} AS grid_col")
    sinks.write_clustered(rows, target, [("grid_row", 7), ("grid_col", 7), ("hour_of_day", 5)], 16)
    box = "grid_row BETWEEN 0 AND 3 AND grid_col BETWEEN 8 AND 23 AND hour_of_day BETWEEN 6 AND 11"
    return rounded(spark.read.parquet(target).where(box).groupBy("grid_row", "grid_col", "hour_of_day").agg(
        *[F.sum(c).alias(f"total_{c}") for c in ACTIVITY], F.count(F.lit(1)).alias("record_count")), 4, partials.TOTALS)


def _bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze in sorted buckets of its key; the name belongs to this query's path alone."""
    path = scratch_path(configure(spark), "bucketed")
    return sinks.write_bucketed(injected(spark, sf), path, path.rsplit("/", 1)[1].replace("-", "_"), NATURAL_KEY, 8)


@query
def bucketed_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Silver from a bucketed bronze: no shuffle."""
    return _silver_view(cleaning.silver(_bucketed(spark, sf), as_of()))


@query
def bucketed_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of repeated keys, and rows whose key has a label, from a bucketed bronze: no shuffle of it."""
    bronze = _bucketed(spark, sf)
    labelled = evaluation.with_labels(
        bronze.drop("is_anomaly_injected", "anomaly_type"), evaluation.labels_of(bronze), null_safe=False)
    return rules.duplicate_count(bronze).withColumn(
        "labelled_rows", labelled.agg(F.count_if("is_anomaly_injected")).scalar())


# ---------------------------------------------------------------- quality

@query
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rules.null_counts(injected(spark, sf))


@query
def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    lines = rules.duplicate_count(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return rules.duplicate_count(records(spark, sf)).select(F.lit("records").alias("table_name"), "*").unionByName(
        lines.select(F.lit("lineitem").alias("table_name"), "*"))


@query
def validation_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The activity rules on silver and on raw records, which lack the calendar columns."""
    bronze = bronze_table(spark, sf)
    return rules.checks(cleaning.silver(bronze, as_of()), rules.ACTIVITY_RULES, "silver").unionByName(
        rules.checks(bronze, rules.ACTIVITY_RULES, "raw"))


def _activity_results(bronze: DataFrame, rows: DataFrame) -> DataFrame:
    return rules.validate(rows, rules.ACTIVITY_RULES, "silver").unionByName(
        rules.validate(bronze, rules.ACTIVITY_RULES, "raw"))


def _results(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        _activity_results(*bronze_and_silver(spark, sf)),
        rules.validate(table(spark, sf, "orders"), commerce.ORDER_RULES, "orders", ["o_orderkey"]),
        rules.validate(table(spark, sf, "customer"), commerce.CUSTOMER_RULES, "customer", ["c_custkey"]),
        rules.validate(table(spark, sf, "part"), commerce.PRODUCT_RULES, "part", ["p_partkey"]),
        rules.validate(table(spark, sf, "lineitem"), commerce.LINE_RULES, "lineitem",
                       ["l_orderkey", "l_linenumber"]),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query
def validation_result(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf).select(
        F.col("table").alias("table_name"), "passed", "checks_total", "checks_passed",
        F.array_join("failures", "; ").alias("failures"), "row_count", "duplicate_count")


@query
def validation_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Of the columns with rules, as its SQL; the results hold the nulls of every column."""
    ruled = {"silver": rules.ACTIVITY_RULES, "raw": rules.ACTIVITY_RULES, "orders": commerce.ORDER_RULES,
             "customer": commerce.CUSTOMER_RULES, "part": commerce.PRODUCT_RULES, "lineitem": commerce.LINE_RULES}
    listed = F.lit(False)
    for name, own in ruled.items():
        listed = listed | (F.col("table_name") == name) & F.col("column_name").isin([r.column for r in own])
    return _results(spark, sf).select(
        F.col("table").alias("table_name"), F.explode("null_counts").alias("column_name", "null_count")).where(listed)


@query
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    return rules.quality_score(_results(spark, sf))


@query
def quality_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    names = {"silver": "silver", "raw": "bronze"}
    results = _results(spark, sf)
    layer = F.lit("commerce")
    for name, value in names.items():
        layer = F.when(F.col("table") == name, value).otherwise(layer)
    return governance.scorecard(results, results.select("table", layer.alias("layer")))


@query
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Report lines of the silver and raw tables."""
    bronze, rows = bronze_and_silver(spark, sf)
    results = _activity_results(bronze, rows)
    stats = cleaning.stage_counts(bronze, rows).withColumn("table", F.lit("cdr_records"))
    document = report.quality_document("silver", BATCH, stats, results, F.lit("2024-02-01"))
    return report.markdown(document).select("line_no", "line")


@query
def commerce_rules(spark: SparkSession, sf: str) -> DataFrame:
    order, customer, part = (table(spark, sf, n) for n in ("orders", "customer", "part"))
    parts = [
        rules.checks(order, commerce.ORDER_RULES, "orders"),
        rules.uniqueness_check(order, "o_orderkey", "orders"),
        rules.checks(customer, commerce.CUSTOMER_RULES, "customer"),
        rules.uniqueness_check(customer, "c_custkey", "customer"),
        rules.checks(part, commerce.PRODUCT_RULES, "part"),
        rules.uniqueness_check(part, "p_partkey", "part"),
        rules.checks(table(spark, sf, "lineitem"), commerce.LINE_RULES, "lineitem"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# ---------------------------------------------------------------- gold

@query
def hourly_grid_activity(spark: SparkSession, sf: str) -> DataFrame:
    gold = aggregates.hourly_grid_activity(silver(spark, sf))
    return rounded(gold, 8, [f"avg_{c}" for c in ACTIVITY])


@query
def daily_country_usage(spark: SparkSession, sf: str) -> DataFrame:
    gold = aggregates.daily_country_usage(silver(spark, sf))
    return rounded(gold, 4, [f"total_{c}" for c in ACTIVITY]).withColumn("date", F.col("date").cast("string"))


@query
def grid_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    gold = aggregates.grid_heatmap(silver(spark, sf))
    return rounded(gold, 4, [f"total_{c}" for c in ACTIVITY] + ["total_activity"])


@query
def tier_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return governance.tier_distribution(aggregates.grid_heatmap(silver(spark, sf)))


@query
def anomaly_summary(spark: SparkSession, sf: str) -> DataFrame:
    gold = aggregates.anomaly_summary(zscores(spark, sf))
    return rounded(gold, 6, ["avg_reconstruction_error", "avg_internet"])


@query
def square_percent_rank(spark: SparkSession, sf: str) -> DataFrame:
    """The exact percent rank of every square by its total, not only its tier."""
    totals = aggregates.square_totals(silver(spark, sf)).select("square_id", F.round("total_activity", 6).alias("total_activity"))
    return rounded(ranks.with_percent_rank(materialize(totals, "totals"), ["total_activity"]), 9, ["percent_rank"])


_reloaded: dict[tuple[str, str], layers.Layout] = {}
RELOADED = ("2024-01-20", "2024-02-10")


def _reloaded_layers(spark: SparkSession, sf: str) -> layers.Layout:
    """Layers whose later days were delivered wrongly, with every value doubled and a third of the squares
    missing, then again: only those days are ingested, cleaned and aggregated anew. Once per session."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _reloaded:
        rows = injected(spark, sf).select(*RAW_ACTIVITY.fieldNames())
        day = F.to_date(F.timestamp_millis("time_interval")).between(*[F.lit(d).cast("date") for d in RELOADED])
        raw, again = scratch_path(spark, "raw"), scratch_path(spark, "raw")
        wrong = rows.where(~day | (F.col("square_id") % 3 > 0)).select(
            *NATURAL_KEY, *[F.when(day, F.col(c) * 2).otherwise(F.col(c)).alias(c) for c in ACTIVITY])
        for folder, lines in ((raw, wrong), (again, rows.where(day))):
            lines.write.options(sep="\t", header="false").csv(folder)
        root = scratch_path(spark, "layers")
        first, second = layers.Layout(root, raw, "*.csv"), layers.Layout(root, again, "*.csv")
        layers.run_bronze(spark, first, "b1")
        layers.run_silver(spark, first, "b1", as_of())
        layers.run_gold(spark, first, "b1")
        layers.run_bronze(spark, second, "b2", reload_days=True)
        layers.run_silver(spark, second, "b2", as_of(), days=RELOADED)
        layers.run_gold(spark, second, "b2", days=RELOADED)
        _reloaded[key] = second
    return _reloaded[key]


def _gold_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    gold = activity.read_table(spark, _reloaded_layers(spark, sf).table(f"gold.{name}"))
    return gold.drop("_gold_processed_at", "_gold_batch_id")


@query
def reloaded_hourly_activity(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly table after some days were delivered again; the layers are written once per session."""
    return rounded(_gold_table(spark, sf, "hourly_grid_activity"), 8, [f"avg_{c}" for c in ACTIVITY])


@query
def reloaded_daily_usage(spark: SparkSession, sf: str) -> DataFrame:
    """The daily table after some days were delivered again; the layers are written once per session."""
    return rounded(_gold_table(spark, sf, "daily_country_usage"), 4, partials.TOTALS).withColumn(
        "date", F.col("date").cast("string"))


@query
def reloaded_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    """The heat map after some days were delivered again; the layers are written once per session."""
    return rounded(_gold_table(spark, sf, "grid_heatmap"), 4, [*partials.TOTALS, "total_activity"])


@query
def country_squares(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct squares per country and span of days: counted, and whether united sketches agree."""
    states = materialize(partials.day_partials(silver(spark, sf)), "partials")
    spans = F.explode(F.array(F.lit("whole"), F.concat(F.lit("day "), F.col("date").cast("string")),
                              F.concat(F.lit("week "), F.weekofyear("date").cast("string")))).alias("span")
    sketches = materialize(partials.square_sketches(states), "sketches")
    exact = partials.exact_squares(states.select("*", spans), ["country_code", "span"])
    united = partials.distinct_squares(sketches.select("*", spans), ["country_code", "span"])
    return exact.join(united, ["country_code", "span"]).select(
        "country_code", "span", "exact_squares",
        partials.within_bound(F.col("estimated_squares"), F.col("exact_squares")).alias("sketch_within_bound"))


@query
def gold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze_and_silver(spark, sf)[1]
    metrics = governance.gold_metrics(
        aggregates.hourly_grid_activity(rows), aggregates.daily_country_usage(rows), aggregates.grid_heatmap(rows))
    return rounded(metrics, 4, ["value"])


# ---------------------------------------------------------------- detector

@query
def zscore_model(spark: SparkSession, sf: str) -> DataFrame:
    model = detector.fit(bronze_and_silver(spark, sf)[1], rank=0)
    fitted = model.parameters(spark).drop("unexplained")
    return rounded(fitted, 6, ["mean", "scale", "anomaly_threshold"])


@query
def zscore_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(zscores(spark, sf), 6, ["reconstruction_error"])


@query
def error_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact percentiles of event values and of line prices."""
    fractions = [0.5, 0.95, 0.99]
    rows = []
    for name, column in [("events", "value"), ("lineitem", "l_extendedprice")]:
        cuts = order_stats.exact_percentiles(table(spark, sf, name), column, fractions)
        rows += [(name, f, cut) for f, cut in zip(fractions, cuts)]
    return rounded(spark.createDataFrame(rows, "table_name string, fraction double, cut double"), 6, ["cut"])


@query
def anomaly_stats(spark: SparkSession, sf: str) -> DataFrame:
    kept = zscores(spark, sf).select("reconstruction_error", "is_anomaly_predicted")
    return detector.anomaly_statistics(materialize(kept, "scores"))


@query
def anomaly_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """Classes and largest values as text, after the totals."""
    kept = ["internet", "reconstruction_error", "is_anomaly_predicted", "anomaly_type_predicted"]
    scores = materialize(zscores(spark, sf).select(*NATURAL_KEY, *kept), "scores")
    return detector.anomaly_bundle(scores).select(
        "total_records", "anomalies_detected", "high_risk_count",
        F.array_join(F.transform("breakdown", lambda x: F.concat_ws(
            ":", x["anomaly_type_predicted"], x["count"].cast("string"))), ",").alias("classes"),
        F.array_join(F.transform("top_internet", lambda x: F.concat_ws(
            ":", *(x[k].cast("string") for k in NATURAL_KEY))), ",").alias("top_internet"))


@query
def anomaly_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(detector.anomaly_breakdown(zscores(spark, sf)), 6, ["avg_internet"])


@query
def top_internet_spikes(spark: SparkSession, sf: str) -> DataFrame:
    kept = zscores(spark, sf).select(*NATURAL_KEY, "internet", "reconstruction_error")
    return detector.top_internet_spikes(materialize(kept, "scores")).select(*NATURAL_KEY, "internet")


@query
def top_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    top = detector.top_anomalies(zscores(spark, sf))
    return rounded(top, 6, ["reconstruction_error"]).select(
        *NATURAL_KEY, "reconstruction_error", "anomaly_type_predicted")


@query
def error_histogram(spark: SparkSession, sf: str) -> DataFrame:
    bins = evaluation.histogram(zscores(spark, sf), "reconstruction_error")
    return rounded(bins, 6, ["bin_start", "bin_end"])


def _evaluated(spark: SparkSession, sf: str, rank: int = 0) -> DataFrame:
    bronze = bronze_table(spark, sf)
    scores = detector.fit_and_score(cleaning.silver(bronze, as_of()), rank=rank, tolerance=TOLERANCE)[1]
    return evaluation.with_labels(scores, evaluation.labels_of(bronze))


@query
def labelled_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions of the whole detector, bottleneck included, beside the injected labels."""
    return _evaluated(spark, sf, detector.BOTTLENECK).select(
        *NATURAL_KEY, "is_anomaly_predicted", "anomaly_type_predicted", "is_anomaly_injected", "anomaly_type")


@query
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.confusion_matrix(_evaluated(spark, sf))


@query
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.classification_report(_evaluated(spark, sf)), 6, ["precision", "recall", "f1"])


@query
def pca_moments(spark: SparkSession, sf: str) -> DataFrame:
    """Covariances of the features over the clean rows, merged from states kept per day."""
    days = materialize(detector.day_states(materialize(silver(spark, sf), "silver")), "day-states")
    whole = moments.merged(days, len(detector.FEATURES))
    return rounded(moments.covariances(whole, detector.FEATURES), 6, ["left_mean", "right_mean", "covariance"])


@query
def pca_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = detector.fit_and_score(silver(spark, sf), tolerance=TOLERANCE)[1]
    return rounded(scores, 6, ["reconstruction_error"])


@query
def pca_anomaly_summary(spark: SparkSession, sf: str) -> DataFrame:
    scores = detector.fit_and_score(silver(spark, sf), tolerance=TOLERANCE)[1]
    return rounded(aggregates.anomaly_summary(scores), 6, ["avg_reconstruction_error", "avg_internet"])


# ---------------------------------------------------------------- dense records: all five activities set

def _dense(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty squares in slots of six hours, summed, so that nearly every record has all activities."""
    ms = "unix_millis(CAST(ts AS TIMESTAMP))"
    rows = table(spark, sf, "events").selectExpr(
        "CAST(user_id % 20 + 1 AS INT) AS square_id", f"{ms} - pmod({ms}, 21600000L) AS time_interval",
        "CAST((user_id % 20 + 1) % 7 + 39 AS INT) AS country_code",
        *[f"CASE WHEN event_type = '{e}' THEN CAST(value AS DECIMAL(18, 2)) END AS {c}"
          for e, c in activity.EVENT_COLUMNS.items()])
    return rows.groupBy(*NATURAL_KEY).agg(*[F.sum(c).cast("double").alias(c) for c in ACTIVITY])


def _dense_silver(spark: SparkSession, sf: str) -> DataFrame:
    records = materialize(evaluation.inject_anomalies(_dense(spark, sf)), "dense")
    return materialize(cleaning.silver(records, as_of()), "dense-silver")


@query
def dense_silver_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_view(_dense_silver(spark, sf))


@query
def dense_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    gold = aggregates.grid_heatmap(_dense_silver(spark, sf))
    return rounded(gold, 4, [*partials.TOTALS, "total_activity"])


@query
def dense_zscore_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = detector.fit_and_score(_dense_silver(spark, sf), rank=0, tolerance=TOLERANCE)[1]
    return rounded(scores, 6, ["reconstruction_error"])


@query
def dense_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """The clustered bottleneck over dense records: rows scored, and whether clean rows lie nearer it than the linear one."""
    rows = _dense_silver(spark, sf)
    model, linear = mixture.fit(rows), detector.fit(rows)
    scored = materialize(mixture.score(rows, model).withColumn("linear_error", linear.error(rows)), "scores")
    kept = ~cleaning.any_flag()
    return scored.agg(
        F.count(F.lit(1)).alias("rows_scored"), F.count_if(kept).alias("training_rows"),
        (F.avg(F.when(kept, F.col("reconstruction_error"))) < F.avg(F.when(kept, F.col("linear_error")))).alias("nearer"),
        (F.count_if(kept & F.col("is_anomaly_predicted")) <= F.count_if(kept) * 0.05 + 1).alias("threshold_holds"))


# ---------------------------------------------------------------- governance

_written: dict[tuple[str, str], layers.Layout] = {}


def _layers(spark: SparkSession, sf: str) -> layers.Layout:
    """All layers written once per session from files made of the injected records."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _written:
        raw = scratch_path(spark, "raw")
        injected(spark, sf).select(*RAW_ACTIVITY.fieldNames()).write.options(sep="\t", header="false").csv(raw)
        layout = layers.Layout(scratch_path(spark, "layers"), raw, "*.csv")
        layers.run_all(spark, layout, BATCH, as_of(), rank=0, tolerance=TOLERANCE)
        _written[key] = layout
    return _written[key]


def _short(layout: layers.Layout, column: str):
    named = F.replace(F.col(column), F.lit(layout.raw), F.lit("raw"))
    return F.replace(named, F.lit(f"{layout.root}/"), F.lit("")).alias(column)


@query
def lineage_tables(spark: SparkSession, sf: str) -> DataFrame:
    layout = _layers(spark, sf)
    return layers.lineage(spark, layout).select(
        "layer", "batch_id", "pipeline", F.col("table").alias("table_name"),
        _short(layout, "source"), _short(layout, "target"),
        F.coalesce("rows", "rows_after").alias("row_count"),
        "rows_before", "dropped", "suspicious_flagged")


@query
def batch_history(spark: SparkSession, sf: str) -> DataFrame:
    return governance.batch_history(layers.lineage(spark, _layers(spark, sf))).select(
        "layer", F.col("table").alias("table_name"), "batch_id", F.col("rows").alias("row_count"))


@query
def lineage_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Chains from the raw files to every table nothing is made from, with that table's rows."""
    layout = _layers(spark, sf)
    tables = layers.lineage(spark, layout).withColumns(
        {"source": _short(layout, "source"), "target": _short(layout, "target")})
    ends = tables.select(F.col("target").alias("final"), F.coalesce("rows", "rows_after").alias("row_count"))
    return governance.lineage_flow(tables).join(ends, "final")


@query
def lineage_impact(spark: SparkSession, sf: str) -> DataFrame:
    """What every table is made from, and what is made from it."""
    layout = _layers(spark, sf)
    return governance.lineage_impact(layers.lineage(spark, layout).withColumns(
        {"source": _short(layout, "source"), "target": _short(layout, "target")}))


@query
def model_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted detector's document, read again."""
    text = spark.read.text(_layers(spark, sf).model_metadata)
    known = "training_samples bigint, threshold_percentile double, anomaly_threshold double, features array<string>, bottleneck int"
    return text.select(F.from_json("value", known).alias("d")).select(
        "d.training_samples", "d.threshold_percentile", F.round("d.anomaly_threshold", 6).alias("anomaly_threshold"),
        F.array_join("d.features", ",").alias("features"), "d.bottleneck")


@query
def layer_gold_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns and types of the written gold tables."""
    tables = {n: df for n, df in layers.written_tables(spark, _layers(spark, sf)).items() if n.startswith("gold.")}
    return governance.column_catalog(tables).select("table_name", "position", "column_name", "data_type", "null_count")


@query
def optional_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Which tables of a list exist, and their rows; a missing one is no error."""
    parts = []
    for name in ("events", "orders", "refunds"):
        found = activity.read_table_if_present(configure(spark), f"{sf}/{name}.parquet")
        rows = spark.range(0) if found is None else found
        parts.append(rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(found is not None).alias("present"), "row_count"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def ordered_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A table written in the order of its key: rows, and how many files begin before an earlier one ends."""
    target = scratch_path(spark, "ordered")
    sinks.write_table(table(spark, sf, "lineitem"), target, sort_by=["l_shipdate", "l_orderkey"])
    files = spark.read.parquet(target).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high"))
    files = materialize(files, "files")       # a row per file
    later = files.select(F.col("file").alias("after"), F.col("low").alias("next_low"))
    wrong = files.join(later, (F.col("file") < F.col("after")) & (F.col("high") > F.col("next_low"))).agg(
        F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("row_count")).withColumn("files_out_of_order", wrong.scalar())


@query
def data_catalog(spark: SparkSession, sf: str) -> DataFrame:
    tables = layers.written_tables(spark, _layers(spark, sf))
    text = lambda c: F.array_join(c, ",").alias(c)
    return governance.data_catalog(tables).select(
        "table_name", "layer", "description", "owner_team", "sensitivity", text("pii_columns"),
        "refresh_schedule", "sla_freshness_hours", text("primary_key"), "partition_key", text("tags"),
        "regulatory_notes", "row_count")


@query
def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
    return governance.column_catalog({n: table(spark, sf, n) for n in names})


@query
def sla_status(spark: SparkSession, sf: str) -> DataFrame:
    """Age of the newest row of two feeds at a fixed time."""
    feeds = {
        "events": (table(spark, sf, "events"), F.col("ts"), 24),
        "orders": (table(spark, sf, "orders"), F.col("o_orderdate"), 24),
    }
    return rounded(governance.sla_status(feeds, as_of()), 4, ["actual_hours"])


@query
def layer_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Freshness of the written layers by processing time; the age itself depends on the clock."""
    return layers.sla_status(spark, _layers(spark, sf)).select("table_name", "sla_freshness_hours", "status")


@query
def layer_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    return layers.scorecard(spark, _layers(spark, sf))


@query
def layer_gold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(layers.gold_metrics(spark, _layers(spark, sf)), 4, ["value"])


@query
def governance_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The fact document, opened again, fact by fact."""
    layout = _layers(spark, sf)
    known = ("quality array<struct<layer: string, overall_quality_score: double>>, "
             "lineage array<struct<layer: string, `table`: string, rows: bigint, rows_after: bigint>>, "
             "anomaly array<struct<total_records: bigint, anomalies_detected: bigint, high_risk_count: bigint>>, "
             "gold array<struct<table_name: string, metric: string, value: double>>, missing array<string>")
    facts = spark.read.text(f"{layout.reports}/governance_facts_{BATCH}").select(F.from_json("value", known).alias("d"))
    fact = lambda part, name, value: F.struct(
        F.lit(part).alias("part"), name.alias("name"), F.round(value.cast("double"), 4).alias("value"))
    total = lambda c: F.transform("d.anomaly", lambda a: fact("anomaly", F.lit(c), a[c]))
    return facts.select(F.inline(F.concat(
        F.transform("d.quality", lambda q: fact("quality", q["layer"], q["overall_quality_score"])),
        F.transform("d.lineage", lambda t: fact(
            "lineage", F.concat_ws(".", t["layer"], t["table"]), F.coalesce(t["rows"], t["rows_after"]))),
        *[total(c) for c in ("total_records", "anomalies_detected", "high_risk_count")],
        F.transform("d.gold", lambda g: fact("gold", F.concat_ws(".", g["table_name"], g["metric"]), g["value"])),
        F.array(fact("missing", F.lit("parts"), F.size("d.missing"))))))


@query
def latest_quality(spark: SparkSession, sf: str) -> DataFrame:
    layout = _layers(spark, sf)
    documents = sinks.read_documents(spark, layout.quality, QUALITY_DOCUMENT)
    older = documents.withColumns({"batch_id": F.lit("b0"), "overall_quality_score": F.lit(0.0)})
    latest = report.latest_documents(documents.unionByName(older))
    return latest.select("layer", "batch_id", "overall_quality_score",
                         F.inline("table_stats")).withColumnRenamed("table", "table_name")


# ---------------------------------------------------------------- commerce

@query
def daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    gold = commerce.daily_revenue(*[table(spark, sf, n) for n in ("orders", "lineitem", "part")])
    return rounded(gold, 4, ["gross_revenue", "net_revenue"]).withColumn(
        "order_date", F.col("order_date").cast("string"))


def _dated(df: DataFrame) -> DataFrame:
    return rounded(df, 4, ["lifetime_value"]).withColumns(
        {c: F.col(c).cast("string") for c in ("first_order", "last_order")})


@query
def customer_ltv(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(commerce.customer_ltv(table(spark, sf, "orders")))


@query
def customer_ntile(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in four shares of equal size by lifetime value."""
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 4).alias("lifetime_value"))
    return ranks.with_ntile(materialize(totals, "totals"), ["lifetime_value", "o_custkey"], 4, "quarter")


@query
def ltv_tier_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rollup = commerce.ltv_tier_rollup(commerce.customer_ltv(table(spark, sf, "orders")))
    return rounded(rollup, 2, ["mean", "sum"])


@query
def product_performance(spark: SparkSession, sf: str) -> DataFrame:
    gold = commerce.product_performance(table(spark, sf, "lineitem"), table(spark, sf, "part"))
    return rounded(rounded(gold, 4, ["gross_revenue", "net_revenue"]), 8, ["avg_discount"])


@query
def sales_by_category(spark: SparkSession, sf: str) -> DataFrame:
    gold = commerce.sales_by_category(table(spark, sf, "lineitem"), table(spark, sf, "part"))
    return rounded(gold, 2, ["net_revenue"])


@query
def top_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(commerce.top_customers(table(spark, sf, "orders")))


def _flagged_orders(spark: SparkSession, sf: str) -> DataFrame:
    return commerce.flag_orders(
        *[table(spark, sf, n) for n in ("orders", "lineitem", "customer")],
        F.timestamp_seconds(F.lit(ORDERS_AS_OF_SECONDS)), EXTREME_FACTOR)


@query
def order_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged_orders(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", *commerce.ORDER_FLAGS)


@query
def amount_at_risk(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(commerce.amount_at_risk(_flagged_orders(spark, sf)), 2, ["amount"])


@query
def orphan_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines without an order."""
    return commerce.orphans(table(spark, sf, "lineitem"), "l_orderkey", table(spark, sf, "orders"), "o_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query
def lines_of_missing_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Lines whose order is not among those taken over, which lack every tenth."""
    taken = table(spark, sf, "orders").where("o_orderkey % 10 <> 3")
    return commerce.orphans(table(spark, sf, "lineitem"), "l_orderkey", taken, "o_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query
def orphan_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose user is no supplier: another key space, so there are many."""
    return commerce.orphans(table(spark, sf, "events"), "user_id", table(spark, sf, "supplier"), "s_suppkey").select(
        "event_id", "user_id", "event_type")


@query
def orphan_check(spark: SparkSession, sf: str) -> DataFrame:
    t = {n: table(spark, sf, n) for n in ("orders", "lineitem", "customer", "part", "supplier", "nation", "events")}
    return commerce.referential_integrity(
        [
            ("orders.customer", t["orders"], "o_custkey", t["customer"], "c_custkey"),
            ("lineitem.orders", t["lineitem"], "l_orderkey", t["orders"], "o_orderkey"),
            ("lineitem.part", t["lineitem"], "l_partkey", t["part"], "p_partkey"),
            ("lineitem.supplier", t["lineitem"], "l_suppkey", t["supplier"], "s_suppkey"),
            ("customer.nation", t["customer"], "c_nationkey", t["nation"], "n_nationkey"),
            ("events.supplier", t["events"], "user_id", t["supplier"], "s_suppkey"),
        ]
    )


@query
def lineitem_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.deduplicate(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return rows.withColumn("l_shipdate", F.to_date("l_shipdate").cast("string"))


@query
def commerce_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return commerce.duplicate_summary(
        [
            ("orders", table(spark, sf, "orders"), ["o_orderkey"]),
            ("customer", table(spark, sf, "customer"), ["c_custkey"]),
            ("part", table(spark, sf, "part"), ["p_partkey"]),
            ("lineitem", table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]),
        ]
    )
