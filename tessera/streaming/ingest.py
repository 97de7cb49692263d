"""Daily files as a stream: each run takes the files that arrived since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.schema import RAW_GLOB
from tessera.sources import sinks
from tessera.sources.activity import BRONZE_PARTITIONS, CORRUPT, RAW_OR_CORRUPT, with_verdict


def raw_stream(spark: SparkSession, folder: str, glob: str = RAW_GLOB) -> DataFrame:
    """Parsed lines; those that do not fit the schema keep their text."""
    return (
        spark.readStream.schema(RAW_OR_CORRUPT)
        .options(sep="\t", header="false", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, pathGlobFilter=glob)
        .csv(folder)
    )


def ingest_new_files(spark: SparkSession, folder: str, target: str, checkpoint: str, batch_id: str,
                     glob: str = RAW_GLOB) -> StreamingQuery:
    """Add unseen files to a bronze table of the same columns as the batch ingest's, and stop.

    Accepted and rejected lines of a micro-batch come from one parse and go out in one write. The
    checkpoint remembers which files were taken, and a micro-batch cut short is written again
    under its number, in place of what it had left: no file is lost or taken twice.
    """

    def write(lines: DataFrame, number: int) -> None:
        sinks.write_micro_batch(with_verdict(lines, batch_id), target, number, BRONZE_PARTITIONS)

    # The file's name is a column of the scan, which foreachBatch no longer knows.
    lines = raw_stream(spark, folder, glob).select("*", "_metadata")
    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
