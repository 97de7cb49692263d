"""Helpers shared by the operators: word rules, Arrow maps, gapless numbers."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from tessera.session import configure

# Texts cross to Python in batches of so many rows, which bounds a task's memory.
BATCH_ROWS = "1000"

# Byte translations. UTF-8 bytes of other characters are 0x80 and above, so both
# rules can be applied to bytes: LOWER maps A-Z only, ALNUM also turns every
# ASCII character but digits and letters into a space.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")      # of intermediate tables
    return spark


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged; ``bytes.split`` cuts at exactly these."""
    return (text or "").encode().split()


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return (text or "").encode().translate(ALNUM).split()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, underscored until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_columns(df: DataFrame, inputs: list[str], schema: str,
                start: Callable[[], Callable]) -> DataFrame:
    """Rows made from batches of ``inputs``.

    ``start()`` runs once per task and returns a function from lists (one per
    input) to lists (one per output column, of any equal length).
    """
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        step = start()
        for batch in batches:
            made = step(*(c.to_pylist() for c in batch.columns))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(made, out)], schema=out)

    return df.select(*(F.col(f"`{c}`") for c in inputs)).mapInArrow(run, schema)


def with_result(df: DataFrame, inputs: list[str], schema: str, start: Callable[[], Callable],
                name: str) -> DataFrame:
    """``df`` and one struct column ``name`` made row by row from ``inputs``; ``start`` as above."""
    made_type = T.StructType.fromDDL(schema)
    whole = T.StructType([*df.schema.fields, T.StructField(name, made_type)])
    out = to_arrow_schema(made_type)
    positions = [df.columns.index(c) for c in inputs]

    def run(batches):
        step = start()
        for batch in batches:
            made = step(*(batch.column(i).to_pylist() for i in positions))
            struct = pa.StructArray.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(made, out)], fields=list(out))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, struct],
                schema=pa.schema([*batch.schema, pa.field(name, struct.type)]))

    return df.mapInArrow(run, whole)


def gapless(df: DataFrame, group: list[str], order: list[str], number: str,
            chunk_rows: int = 4_000) -> DataFrame:
    """``number``: 0, 1, 2, ... within each group, without one task per group.

    Rows are dealt to chunks by a hash of ``order`` (which should identify a row;
    equal rows meet in one chunk), numbered inside their chunk, and moved up by
    the rows of the chunks before. The chunk count follows the row count, so a
    group with a third of all rows is spread over as many tasks as it needs. Columns
    of ``group`` hold no nulls.
    """
    chunk, before, inside = (fresh(df, c) for c in ("chunk", "before", "inside"))
    chunks = max(1, -(-df.count() // chunk_rows))
    dealt = df.withColumn(chunk, F.pmod(F.xxhash64(*order), F.lit(chunks)))
    ahead = Window.partitionBy(*group).orderBy(chunk)
    offsets = (dealt.groupBy(*group, chunk).count()
               .select(*group, chunk, (F.sum("count").over(ahead) - F.col("count")).alias(before)))
    rows = dealt.withColumn(inside, F.row_number().over(
        Window.partitionBy(*group, chunk).orderBy(*order)) - 1)
    return rows.join(offsets, [*group, chunk]).select(
        *df.columns, (F.col(inside) + F.col(before)).cast("long").alias(number))


def sha256_hex(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)
