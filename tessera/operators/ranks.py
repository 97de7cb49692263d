"""The exact rank of every row, without a window over all rows in one task.

Equal values are counted first, so a value held by a third of all rows is one row from there on. The
distinct values are dealt out by range and written with the number of their part; a running sum inside
each part, moved up by the rows of the parts before it, says how many rows come before a value. Only
the parts' totals, one number per shuffle partition, are added up outside Spark.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.session import materialize

_PART, _HERE, _BEFORE, _ALL = "_part", "_here", "_before", "_all"


def positions(df: DataFrame, by: list[str]) -> tuple[DataFrame, int]:
    """Every distinct value of the columns ``by`` (ascending, nulls first) with the rows that hold it and the rows
    before it, as ``_here`` and ``_before``; and the number of all rows."""
    clash = {_PART, _HERE, _BEFORE, _ALL} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are used by the ranks")
    values = df.groupBy(*by).agg(F.count(F.lit(1)).alias(_HERE))
    ranged = materialize(values.repartitionByRange(*by).withColumn(_PART, F.spark_partition_id()), "ranks")
    totals = sorted(tuple(r) for r in ranged.groupBy(_PART).agg(F.sum(_HERE)).collect())
    ahead = [0, *accumulate(n for _, n in totals)]
    # A literal table, also where there are no parts.
    listed = ", ".join(f"({part}, {before}L)" for (part, _), before in zip(totals or [(-1, 0)], ahead))
    offsets = df.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS t({_PART}, _ahead)")
    running = F.sum(_HERE).over(Window.partitionBy(_PART).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))
    placed = ranged.withColumn(_BEFORE, running - F.col(_HERE)).join(offsets, _PART)
    return placed.select(*by, _HERE, (F.col(_BEFORE) + F.col("_ahead")).alias(_BEFORE)), ahead[-1]


def _counted(df: DataFrame, by: list[str]) -> DataFrame:
    """Every row with the rows before its values, the rows that share them, and all."""
    found, rows = positions(df, by)
    placed = found.select(*[F.col(f"`{c}`").alias(f"_by_{i}") for i, c in enumerate(by)], _HERE, _BEFORE,
                          F.lit(rows).alias(_ALL))
    match = [F.col(f"`{c}`").eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate(by)]
    return df.join(placed, match).drop(*[f"_by_{i}" for i in range(len(by))])


def _with(df: DataFrame, by: list[str], descending: bool, columns: dict[str, Column]) -> DataFrame:
    counted = _counted(df, by)
    if descending:
        counted = counted.withColumn(_BEFORE, F.col(_ALL) - F.col(_BEFORE) - F.col(_HERE))
    return counted.withColumns(columns).drop(_HERE, _BEFORE, _ALL)


def with_rank(df: DataFrame, by: list[str], name: str = "rank", descending: bool = False) -> DataFrame:
    """Rank from 1 by the columns ``by``; equal rows share the first of their ranks."""
    return _with(df, by, descending, {name: F.col(_BEFORE) + 1})


def with_percent_rank(df: DataFrame, by: list[str], name: str = "percent_rank", descending: bool = False) -> DataFrame:
    """(rows before) / (rows - 1), 0 for a single row; equal rows share it."""
    share = F.when(F.col(_ALL) > 1, F.col(_BEFORE) / (F.col(_ALL) - 1)).otherwise(F.lit(0.0))
    return _with(df, by, descending, {name: share})


def with_ntile(df: DataFrame, by: list[str], tiles: int, name: str = "tile", descending: bool = False) -> DataFrame:
    """Number 1 .. ``tiles`` of the equal-sized share a row falls into; the first shares take what is left over.

    Columns ``by`` should identify a row: equal rows share the tile of their first.
    """
    size, larger = F.expr(f"{_ALL} DIV {tiles}"), F.expr(f"{_ALL} % {tiles}")
    edge = larger * (size + 1)
    tile = F.when(F.col(_BEFORE) < edge, F.floor(F.col(_BEFORE) / (size + 1))).otherwise(
        larger + F.floor((F.col(_BEFORE) - edge) / F.greatest(size, F.lit(1))))
    return _with(df, by, descending, {name: (tile + 1).cast("int")})
