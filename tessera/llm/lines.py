"""Line dedup by levelled sorted runs of line hashes.

A line's key is the line without white space at both ends and with A-Z lower-cased. Keys of at
least ``LEAST_CHARS`` code points found in at least ``LEAST_DOCS`` documents lose all their lines
except in the document of largest id.

Documents come in batches, the largest ids first, so the first batch that brings a key also
brings the document that keeps it. ``LineRuns`` holds the keys met so far as sorted runs: tables
bucketed and sorted by the key's hash, each key in one run only.

1. A batch is reduced to its distinct hashes, each with its documents and the largest of them.
2. They are merge-anti-joined with every run in turn. The runs lie in the buckets and order in
   which the hashes come out of their aggregation, so they are not shuffled or sorted for it. What
   meets no run is new, and is the batch's own run of level 0; the rest stays beside it as repeats.
3. ``FANOUT`` runs of one level are merged to one of the next, so a hash is looked up in a few
   runs per level, and written once per level.
4. Documents that do not keep a key of theirs are repeats. Only keys with ``LEAST_DOCS - 1`` of
   them are followed up: their lines' places are gathered per document and left out of its text.

All of it is DataFrame functions; no row passes through Python. A line in a third of all documents
is one row per document and map task before any shuffle by its hash, and the join back to its
places is split by Spark where one hash has too many.

Hashes have 128 bits. Defined results: a null or empty text is one empty line; rows of one id count
as one document, and all of them keep what it keeps; rows with a null id neither count nor lose
lines; a line repeated inside the keeping document stays each time; if every line goes, the text
is empty. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.llm.common import fresh
from tessera.session import intermediate_path, materialize

LEAST_CHARS = 40
LEAST_DOCS = 5
BATCHES = 4
FANOUT = 3
BLANKS = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(line: Column) -> Column:
    """The line's key. ``lower`` equals A-Z lower-casing on ASCII and is faster than ``translate``."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


@contextmanager
def _sorted_buckets(spark: SparkSession):
    """Spark takes a bucket of one file as sorted only with the first setting.

    Without the second it takes a union of bucketed scans for bucketed, but then scans
    the files one by one, so that a bucket is spread over several tasks.
    """
    wanted = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.unionOutputPartitioning": "false"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class LineRuns:
    """Hashes met so far, in levels of sorted runs; the runs lie in the shared folder.

    ``add`` takes a batch of (hash, id) and writes its hashes: the new ones are a run, with the largest
    id of each. ``close`` forgets the tables' names; their files go with the other intermediate tables.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        # As many as a shuffle makes, so that a batch meets the runs as it comes out of its aggregation.
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.batches: list[str] = []
        self._names: list[str] = []

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (df.write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash")
         .option("path", intermediate_path(self.spark, name)).saveAsTable(name))
        self._names.append(name)
        return name

    def _run(self, name: str) -> DataFrame:
        return self.spark.table(name).where("new").select("hash", "holder")

    def runs(self) -> list[DataFrame]:
        return [self._run(name) for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        found = batch.select("hash", "id").distinct().groupBy("hash").agg(
            F.max("id").alias("holder"), F.count(F.lit(1)).alias("docs"))
        with _sorted_buckets(self.spark):
            # An anti-join that keeps both sides of its verdict: without a partner in any run a hash is new.
            new = F.lit(True)
            for k, run in enumerate(self.runs()):
                found = found.join(run.select("hash", F.lit(True).alias(f"met_{k}")).hint("merge"), "hash", "left")
                new = new & F.col(f"met_{k}").isNull()
            name = self._write(found.select("hash", "holder", "docs", new.alias("new")))
            self.batches.append(name)
            self._add_run(name, 0)

    def _add_run(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            merged, self.levels[level] = self.levels[level], []
            whole = None
            for other in merged:        # a hash is new in one of them only; grouping takes it to its bucket
                whole = self._run(other) if whole is None else whole.unionByName(self._run(other))
            made = whole.groupBy("hash").agg(F.max("holder").alias("holder"))
            self._add_run(self._write(made.withColumn("new", F.lit(True))), level + 1)

    def repeats(self) -> DataFrame:
        """(hash, repeats): the documents of all batches that are not the first to hold a hash. Read before ``close``."""
        found = None
        for name in self.batches:
            own = self.spark.table(name).select("hash", (F.col("docs") - F.col("new").cast("int")).alias("n")).where("n > 0")
            found = own if found is None else found.unionByName(own)
        return found.groupBy("hash").agg(F.sum("n").alias("repeats"))

    def holders(self, hashes: DataFrame) -> DataFrame:
        """(hash, holder) of those of ``hashes`` that the runs know. Read before ``close``."""
        found = None
        for run in self.runs():
            own = hashes.select("hash").join(run, "hash")
            found = own if found is None else found.unionByName(own)
        return found

    def close(self) -> None:
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _batches(ids: DataFrame, doc_id: str, batches: int) -> Column:
    """Number of the batch of a document, 0 for the largest ids. Where the cuts lie changes no result."""
    shares = [k / batches for k in range(1, batches)]
    cuts = ids.agg(F.percentile_approx(doc_id, shares, 10_000)).first()[0] if shares else []
    number = F.lit(0)
    for cut in sorted(set(cuts or [])):
        number = number + (F.col(doc_id) < cut).cast("int")
    return number


def remove_repeated_lines(docs: DataFrame, name: str, *, doc_id: str = "doc_id", text: str = "text",
                          least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
                          batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` and struct ``name``: n_lines, n_dropped, and the text that stays."""
    spark = docs.sparkSession
    # Rows of one id may hold different texts: places belong to (id, text).
    known = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    numbered = known.select("*", _batches(known, "id", batches).alias("batch"))
    keyed = (numbered.select("batch", "id", "text_hash", F.posexplode(split_lines(F.col("text"))).alias("at", "line"))
             .select("batch", "id", "text_hash", "at", normal(F.col("line")).alias("key"))
             .where(F.char_length("key") >= least_chars)
             .select("batch", "id", "text_hash", "at", F.unhex(F.md5("key")).alias("hash")))
    lines = materialize(keyed, "lines")

    runs = LineRuns(spark, fanout)
    try:
        for number in range(batches):
            runs.add(lines.where(F.col("batch") == number))
        with _sorted_buckets(spark):
            frequent = runs.repeats().where(F.col("repeats") >= least_docs - 1)
            held = materialize(runs.holders(frequent), "held")
    finally:
        runs.close()

    own_id, own_hash, gone = (fresh(docs, c) for c in ("id", "text_hash", "gone"))
    marks = (lines.join(held, "hash").where("id < holder").groupBy("id", "text_hash")
             .agg(F.collect_set("at").alias(gone))      # a set: equal rows bring each place again
             .withColumnsRenamed({"id": own_id, "text_hash": own_hash}))
    joined = docs.join(marks, (F.col(doc_id) == F.col(own_id)) & (F.xxhash64(F.col(text)) == F.col(own_hash)), "left")
    parts, dropped = split_lines(F.col(text)), F.coalesce(F.size(gone), F.lit(0))
    # By position and by hashing, so that a very long text costs no more per line than a short one.
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    kept = F.when(dropped == 0, F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), F.struct(
        F.size(parts).cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"),
        kept.alias("text")).alias(name))
