"""Moments of several columns as states that can be merged: count, means, centred co-moments.

A mean product minus the product of the means loses everything where a column lies far from zero.
A state is computed in two aggregations instead: the means, then sums of centred values and
products, with which the means are corrected as well. What a mean loses by rounding is kept beside it
(``rests``). States of parts give the state of the whole, so a table kept per day needs only its new
days read again.

The co-moments are the upper triangle of sum((x_i - mean_i) * (x_j - mean_j)), row by row.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, functions as F

from tessera.functions.activity import number_sql


def _pairs(size: int) -> list[tuple[int, int]]:
    return list(combinations_with_replacement(range(size), 2))


def _same_group(left: str, right: str, by: list[str]) -> str:
    return " AND ".join(f"{left}.`{c}` <=> {right}.`{c}`" for c in by) or "true"


def _corrected(sums: DataFrame, by: list[str], size: int) -> DataFrame:
    """States from sums around a reference: n, r_i, a_i = sum(x_i - r_i), c_k of the products."""
    means = ", ".join(f"r_{i} + a_{i} / n" for i in range(size))
    rests = ", ".join(f"(r_{i} - (r_{i} + a_{i} / n)) + a_{i} / n" for i in range(size))
    products = ", ".join(f"c_{k} - a_{i} * a_{j} / n" for k, (i, j) in enumerate(_pairs(size)))
    return sums.where("n > 0").selectExpr(
        *[f"`{c}`" for c in by], "n", f"array({means}) AS means", f"array({rests}) AS rests",
        f"array({products}) AS comoments")


def states(rows: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """One state per group of ``by`` (nulls are a group); one for all rows without ``by``, none without rows.

    ``rows`` is read twice. ``columns`` are doubles without nulls.
    """
    by = by or []
    size = len(columns)
    x = rows.selectExpr(*[f"`{c}`" for c in by], *[f"CAST(`{c}` AS DOUBLE) AS x_{i}" for i, c in enumerate(columns)])
    means = [F.avg(f"x_{i}").alias(f"r_{i}") for i in range(size)]
    if by:
        centres = x.groupBy(*by).agg(*means)
        joined = x.alias("l").join(centres.alias("r"), F.expr(_same_group("l", "r", by))).selectExpr(
            *[f"l.`{c}`" for c in by], *[f"x_{i}" for i in range(size)], *[f"r_{i}" for i in range(size)])
    else:
        centre = x.agg(*means).first()
        joined = x.selectExpr("*", *[f"{number_sql(m)} AS r_{i}" for i, m in enumerate(centre)])
    away = joined.selectExpr(*[f"`{c}`" for c in by], *[f"r_{i}" for i in range(size)],
                             *[f"x_{i} - r_{i} AS d_{i}" for i in range(size)])
    sums = away.groupBy(*by, *[f"r_{i}" for i in range(size)]).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"d_{i}").alias(f"a_{i}") for i in range(size)],
        *[F.sum(F.col(f"d_{i}") * F.col(f"d_{j}")).alias(f"c_{k}") for k, (i, j) in enumerate(_pairs(size))])
    return _corrected(sums, by, size)


def merged(parts: DataFrame, size: int, by: list[str] | None = None) -> DataFrame:
    """The states of the unions of parts, per group of ``by``.

    Differences are taken from the means of the group's largest part, so merging cancels no more
    than the parts lie apart.
    """
    by = by or []
    listed = [f"`{c}`" for c in by]
    flat = parts.selectExpr(*listed, "n AS m", *[f"means[{i}] AS x_{i}" for i in range(size)],
                            *[f"rests[{i}] AS e_{i}" for i in range(size)],
                            *[f"comoments[{k}] AS p_{k}" for k in range(len(_pairs(size)))])
    largest = parts.groupBy(*by).agg(F.max(F.struct("n", "means")).alias("top")).selectExpr(
        *listed, *[f"top.means[{i}] AS r_{i}" for i in range(size)])
    joined = flat.alias("l").join(largest.alias("r"), F.expr(_same_group("l", "r", by))).selectExpr(
        *[f"l.`{c}`" for c in by], "m", *[f"x_{i} - r_{i} + e_{i} AS d_{i}" for i in range(size)],
        *[f"r_{i}" for i in range(size)], *[f"p_{k}" for k in range(len(_pairs(size)))])
    sums = joined.groupBy(*by, *[f"r_{i}" for i in range(size)]).agg(
        F.sum("m").alias("n"), *[F.expr(f"sum(m * d_{i})").alias(f"a_{i}") for i in range(size)],
        *[F.expr(f"sum(p_{k} + m * d_{i} * d_{j})").alias(f"c_{k}") for k, (i, j) in enumerate(_pairs(size))])
    return _corrected(sums, by, size)


def covariances(state: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """One row per pair of columns: population covariance, and the means and rows behind it."""
    rows = [
        f"struct('{columns[i]}' AS left_column, '{columns[j]}' AS right_column, means[{i}] AS left_mean, "
        f"means[{j}] AS right_mean, comoments[{k}] / n AS covariance, n AS row_count)"
        for k, (i, j) in enumerate(_pairs(len(columns)))]
    return state.selectExpr(*[f"`{c}`" for c in by or []], f"inline(array({', '.join(rows)}))")
