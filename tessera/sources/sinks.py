"""Table and document sinks. Counts of written rows come from the write itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tessera.functions.curve import interleaved_sql

# A file takes no more rows: it is read by one task, however small it is.
FILE_ROWS = 1_000_000


def write_table(df: DataFrame, path: str, *, partition_by: str | list[str] | None = None,
                sort_by: list[str] | None = None, only_given_partitions: bool = False,
                fmt: str = "parquet", **metrics: Column) -> dict[str, int]:
    """Write a table in one pass over ``df``; return its row count and any further ``metrics``.

    The counters sit above every shuffle, in the tasks that write: only there does
    Spark count each row once, even when a sort samples its input first or an
    executor is lost and its work redone.

    ``partition_by``: rows are rebalanced on the partition columns first, so each
    partition gets few files while one holding much of the data is split over
    several tasks. ``only_given_partitions`` replaces just the partitions present
    in ``df``, for reloading single days. ``sort_by`` gives a globally ordered table.

    A table that a stream writes is refused: it is kept by micro-batch, and an overwrite
    would delete batches behind the stream's back, or come to lie beside them.
    """
    if _is_streamed(df.sparkSession, path):
        raise ValueError(f"{path} is written by a stream; reload its days through the stream or to another table")
    by = [partition_by] if isinstance(partition_by, str) else partition_by
    if by:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    if sort_by:
        df = df.orderBy(*sort_by)
    watch = Observation()
    counters = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in metrics.items()]
    writer = df.observe(watch, *counters).write.format(fmt).mode("overwrite").option("maxRecordsPerFile", FILE_ROWS)
    if by:
        scope = "dynamic" if only_given_partitions else "static"
        writer = writer.partitionBy(*by).option("partitionOverwriteMode", scope)
    writer.save(path)
    return {name: int(value) for name, value in watch.get.items()}


def write_clustered(df: DataFrame, path: str, dimensions: list[tuple[str, int]], files: int,
                    fmt: str = "parquet", **options: str) -> int:
    """Write a table in the order of a curve through several ``dimensions`` (expression, bits); returns the rows.

    Rows are dealt to ``files`` ranges of the curve and sorted inside each, so a file, and each row group
    of it, covers a small box, and a filter on any of the dimensions skips the others by their minima and
    maxima. One shuffle; the curve's place itself is not kept.
    """
    place = F.expr(interleaved_sql(dimensions))
    watch = Observation()
    dealt = df.withColumn("_place", place).repartitionByRange(files, "_place").sortWithinPartitions("_place")
    dealt.drop("_place").observe(watch, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("overwrite").options(
        **options).save(path)
    return int(watch.get["rows"])


def write_bucketed(df: DataFrame, path: str, name: str, key: list[str], buckets: int) -> DataFrame:
    """Write a table in sorted buckets of ``key`` at ``path``, known as ``name``, and read it back.

    Operators on the key (duplicates, copies, joins on equality) then need no shuffle of this table. Rows are
    shuffled into their buckets once, so that a bucket is one file; a key with very many copies makes a large one.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")       # the name only: the files of an external table stay
    (df.repartition(buckets, *key).write.format("parquet").mode("overwrite").bucketBy(buckets, *key).sortBy(*key)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def replace_days(df: DataFrame, path: str, day: str, days: tuple[str, str], fmt: str = "parquet") -> int:
    """Write the days from the first to the last of ``days``, instead of what the table held of them; returns the rows.

    Other days are neither read nor written. A day that ``df`` has no rows of any more is removed.
    ``df`` holds no other days. Days of a reader are whole: each is written before its old files go.
    """
    spark = df.sparkSession
    watch = Observation()
    held = df.hint("rebalance", F.col(day)).observe(
        watch, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(day).cast("string")).alias("days"))
    held.write.format(fmt).mode("overwrite").partitionBy(day).options(
        partitionOverwriteMode="dynamic", maxRecordsPerFile=FILE_ROWS).save(path)
    written = set(watch.get["days"])
    for folder in _subfolders(spark, path):
        name, _, value = folder.getName().partition("=")
        if name == day and days[0] <= value <= days[1] and value not in written:
            _folder(spark, path)[1].delete(folder, True)
    return watch.get["rows"]


def _folder(spark: SparkSession, path: str):
    """A folder and its file system, whatever store that is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _subfolders(spark: SparkSession, path: str) -> list:
    folder, files = _folder(spark, path)
    return [s.getPath() for s in files.listStatus(folder) if s.isDirectory()] if files.exists(folder) else []


MICRO_BATCH = "_micro_batch"


def _is_streamed(spark: SparkSession, path: str) -> bool:
    names = [p.getName() for p in _subfolders(spark, path)]
    return any(n == "_spark_metadata" or n.startswith(f"{MICRO_BATCH}=") for n in names)


def write_micro_batch(df: DataFrame, path: str, number: int, partition_by: list[str], fmt: str = "parquet",
                      **metrics: Column) -> dict:
    """The rows of one micro-batch, in one write; a repeated batch replaces what its first attempt left.

    Returns ``metrics``. One stream per table: numbers of two would collide.
    """
    marked = df.withColumn(MICRO_BATCH, F.lit(number))
    if partition_by:
        marked = marked.hint("rebalance", *[F.col(c) for c in partition_by])
    watch = Observation()
    if metrics:
        marked = marked.observe(watch, *[c.alias(n) for n, c in metrics.items()])
    # A first attempt may have left partitions that this one has no rows for.
    folder, files = _folder(df.sparkSession, f"{path}/{MICRO_BATCH}={number}")
    if files.exists(folder):
        files.delete(folder, True)
    (marked.write.format(fmt).mode("append").partitionBy(MICRO_BATCH, *partition_by)
     .option("maxRecordsPerFile", FILE_ROWS).save(path))
    return watch.get if metrics else {}


def write_documents(df: DataFrame, folder: str) -> None:
    """One JSON document per row, added to the documents already in ``folder``."""
    df.write.mode("append").json(folder)


def read_documents(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(folder)


def write_text(df: DataFrame, folder: str) -> None:
    """Lines in ``line_no`` order. Meant for reports, whose length is the number of checks."""
    df.orderBy("line_no").select(F.col("line").alias("value")).coalesce(1).write.mode("overwrite").text(folder)
