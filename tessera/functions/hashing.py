"""Repeatable draws: the same row gets the same number on every attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def key_digest_sql(keys: list[str], seed: int | str) -> str:
    parts = ", ".join(f"CAST({k} AS STRING)" for k in keys)
    return f"md5(concat_ws('|', {parts}, '{seed}'))"


def draw_sql(digest: str, lane: int) -> str:
    """One of four independent 32-bit numbers held in an md5 digest."""
    return f"CAST(conv(substring({digest}, {lane * 8 + 1}, 8), 16, 10) AS BIGINT)"


def hash_sample(df: DataFrame, fraction: float, keys: list[str], seed: int = 42) -> DataFrame:
    """Bernoulli sample by key hash.

    Unlike ``DataFrame.sample`` the choice does not depend on how the rows are
    split into partitions, so a retried task or a re-read picks the same rows.
    """
    number = draw_sql(key_digest_sql(keys, f"sample-{seed}"), 0)
    return df.where(f"{number} % 1000000 < {int(round(fraction * 1_000_000))}")


def bounded_sample(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """The ``n`` rows of smallest key hash (all, if fewer), ties in the order of all columns.

    The hash of the nth row is found exactly, by sketch and count; rows below it are a filter, and only
    rows that share it are ordered. Nothing is sorted as a whole, and any attempt picks the same rows.
    ``df`` is read a few times.
    """
    from tessera.operators.order_stats import order_statistics

    taken = {c.lower() for c in df.columns}
    name = next(c for c in ("_draw", "__draw", "___draw") if c not in taken)
    # 48 bits: held by a double without rounding.
    drawn = df.withColumn(name, F.expr(
        f"CAST(conv(substring({key_digest_sql(keys, f'sample-{seed}')}, 1, 12), 16, 10) AS BIGINT)"))
    if n <= 0:
        return df.limit(0)
    found = order_statistics(drawn, name, lambda known, _: [n - 1])[0]
    if not found:
        return df
    cut = F.lit(int(found[n - 1])).cast("bigint")
    below = drawn.where(F.col(name) < cut)
    missing = n - below.count()
    ties = drawn.where(F.col(name) == cut).orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in df.columns]).limit(missing)
    return below.unionByName(ties).drop(name)
