"""Daily usage as an event-time stream: copies dropped, late rows kept apart, days summed as they fill.

Two streams, each with a checkpoint of its own:

1. ``split_arrivals`` parses new files once and gives every row a verdict. The mark is the newest event
   time of all arrivals before; rows more than the allowed delay behind it are late. Rows of a future
   time or without one do not move the mark.
2. ``sum_days`` reads the rows in time, drops copies of a key within the watermark, and sums windows of one
   day per country and square in the state store. Its watermark is never ahead of the mark, so it
   drops no row that was judged in time. Each micro-batch writes the sums that have changed.

``daily_usage`` takes the newest sums of each cell. Both sinks keep rows by micro-batch and replace a
repeated one, so a run cut short neither loses rows nor adds any twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.activity import cleaned_sql, event_time_sql, is_future
from tessera.schema import ACTIVITY, NATURAL_KEY, RAW_ACTIVITY, RAW_GLOB
from tessera.session import BOUNDED_TASKS, settings
from tessera.sources import sinks
from tessera.sources.activity import read_table_if_present
from tessera.streaming.ingest import raw_stream

DELAY_HOURS = 48
IN_TIME, LATE, FUTURE, UNDATED = "in_time", "late", "future", "undated"
_CELL = ["date", "country_code", "square_id"]
STATES_PER_CORE = 4


def _settings(spark: SparkSession) -> dict[str, str]:
    """Tasks of bounded input, and partitions of the state by the cores there are.

    Each partition keeps two states, and every micro-batch commits each of them in files of its own, however
    few rows it has. A checkpoint keeps the number that it was begun with.
    """
    most = STATES_PER_CORE * spark.sparkContext.defaultParallelism
    states = min(int(spark.conf.get("spark.sql.shuffle.partitions")), most)
    return {**BOUNDED_TASKS, "spark.sql.shuffle.partitions": str(states)}


def _mark(spark: SparkSession, root: str, number: int) -> int | None:
    """Newest event time, in milliseconds, of the micro-batches before ``number``."""
    marks = read_table_if_present(spark, f"{root}/marks")
    return None if marks is None else marks.where(F.col(sinks.MICRO_BATCH) < number).agg(F.max("newest")).first()[0]


def split_arrivals(spark: SparkSession, folder: str, root: str, checkpoint: str, glob: str = RAW_GLOB,
                   as_of: Column | None = None, delay_hours: int = DELAY_HOURS) -> StreamingQuery:
    """New files to ``root``/arrivals, partitioned by verdict; one parse, one write."""

    def write(lines: DataFrame, number: int) -> None:
        session = lines.sparkSession
        mark = _mark(session, root, number)
        rows = lines.select(*RAW_ACTIVITY.fieldNames(), F.expr(event_time_sql()).alias("event_time"))
        late = F.lit(False) if mark is None else F.col("time_interval") <= mark - delay_hours * 3_600_000
        verdict = (F.when(F.col("event_time").isNull(), UNDATED).when(is_future(as_of), FUTURE)
                   .when(late, LATE).otherwise(IN_TIME))
        counted = F.max(F.when(F.col("verdict") == IN_TIME, F.col("time_interval")))
        found = sinks.write_micro_batch(
            rows.withColumn("verdict", verdict), f"{root}/arrivals", number, ["verdict"], newest=counted)
        # Written last: a batch without a mark of its own is one that is repeated.
        sinks.write_micro_batch(session.createDataFrame([(found["newest"],)], "newest long").coalesce(1),
                                f"{root}/marks", number, [])

    return (raw_stream(spark, folder, glob).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def sum_days(spark: SparkSession, root: str, checkpoint: str, delay_hours: int = DELAY_HOURS) -> StreamingQuery:
    """New rows in time to sums per day, country and square under ``root``/usage."""
    arrivals = spark.read.parquet(f"{root}/arrivals").drop("verdict", sinks.MICRO_BATCH)
    rows = spark.readStream.schema(arrivals.schema).parquet(
        f"{root}/arrivals/{sinks.MICRO_BATCH}=*/verdict={IN_TIME}")
    unique = rows.withWatermark("event_time", f"{delay_hours} hours").dropDuplicatesWithinWatermark(NATURAL_KEY)
    clean = unique.selectExpr("event_time", "country_code", "square_id", *[f"{cleaned_sql(c)} AS {c}" for c in ACTIVITY])
    sums = clean.groupBy(F.window("event_time", "1 day").alias("day"), "country_code", "square_id").agg(
        *[F.sum(c).alias(f"total_{c}") for c in ACTIVITY], F.count(F.lit(1)).alias("record_count"))
    changed = sums.select(F.to_date("day.start").alias("date"), *[c for c in sums.columns if c != "day"])
    return (changed.writeStream.outputMode("update")
            .foreachBatch(lambda df, number: sinks.write_micro_batch(df, f"{root}/usage", number, []))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def take_new_files(spark: SparkSession, folder: str, root: str, checkpoints: str, glob: str = RAW_GLOB,
                   as_of: Column | None = None, delay_hours: int = DELAY_HOURS) -> None:
    """Both streams, one after the other, over the files that have arrived."""
    with settings(spark, _settings(spark)):
        split_arrivals(spark, folder, root, f"{checkpoints}/arrivals", glob, as_of, delay_hours).awaitTermination()
        if read_table_if_present(spark, f"{root}/arrivals") is not None:
            sum_days(spark, root, f"{checkpoints}/usage", delay_hours).awaitTermination()


def _newest(root_usage: DataFrame) -> DataFrame:
    """The last sums written for each cell."""
    last = Window.partitionBy(*_CELL).orderBy(F.desc(sinks.MICRO_BATCH))
    return root_usage.withColumn("_age", F.row_number().over(last)).where("_age = 1").drop("_age", sinks.MICRO_BATCH)


def daily_usage(spark: SparkSession, root: str) -> DataFrame:
    """Total activity and active squares per country and day of all rows that came in time."""
    return _newest(spark.read.parquet(f"{root}/usage")).groupBy("country_code", "date").agg(
        *[F.sum(f"total_{c}").alias(f"total_{c}") for c in ACTIVITY],
        F.sum("record_count").alias("record_count"), F.count("square_id").alias("active_squares"))


def set_aside(spark: SparkSession, root: str) -> DataFrame:
    """The rows that take no part, with their verdict: late, future or undated."""
    return spark.read.parquet(f"{root}/arrivals").where(F.col("verdict") != IN_TIME)
