"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. All of them can be set on a live
# session, so a session handed in by a cluster is adjusted, not replaced.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Settings only a new session can take.
AT_START = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",   # no stack capture per expression
}

# For stages that sort or aggregate rows of large tables as they read them. Written tables are compressed, so
# a read task of Spark's 128 MB can hold tens of millions of rows; and the default cost of opening a file makes
# many small files (a partition per day) look like much data, which packs the few large ones together.
# With the rows of a file bounded too (``sinks.FILE_ROWS``) a task reads four such files at most.
BOUNDED_TASKS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "4m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}

_local_scratch: str | None = None
_materialized: dict[str, list[str]] = {}


def build_session(app: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    own = {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in {**AT_START, **RUNTIME, **own}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session created elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Runtime settings for what runs inside; those of before come back at the end."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master that names none;
    on a cluster it would be lost with the machine, so that is an error.
    """
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="tessera-")
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch folder; nothing is ever overwritten there."""
    return f"{scratch_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def intermediate_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch folder that ``release`` will remove."""
    path = scratch_path(spark, name)
    _materialized.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and continue from the written table.

    Used where several passes follow (fits, quantiles): the passes share one
    computation, read only the columns they need, and see the same values even
    after an executor is lost and its floating-point sums are redone.
    """
    path = intermediate_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tables_written(spark: SparkSession) -> int:
    """Number of tables ``materialize`` has written and ``release`` has not removed."""
    return len(_materialized.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, kept: int = 0, newest: int = 0) -> int:
    """Remove the tables ``materialize`` has written, but for the first ``kept`` and the last ``newest``; returns
    their number.

    For the caller of a plan, once its result is written or collected: frames made
    from these tables cannot be read afterwards.
    """
    written = _materialized.get(spark.sparkContext.applicationId, [])
    upto = max(kept, len(written) - newest)
    gone, written[kept:upto] = written[kept:upto], []
    for path in gone:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return len(gone)


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables written inside are removed at the end."""
    before = tables_written(spark)
    try:
        yield
    finally:
        release(spark, before)
