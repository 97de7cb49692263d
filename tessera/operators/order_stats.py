"""Exact order statistics without sorting a whole column in one task.

``percentile`` keeps every distinct value of a group in one task, and an
unpartitioned ``percent_rank`` sorts everything in one. Both need only a few
positions of the sorted column. Here a sketch proposes values closely around every
wanted position, and one aggregation counts the rows below, at and between them,
which says exactly where each position lies: at a proposed value, or in a gap of
few rows. The rows of the gaps are written once and searched the same way. Each
level is two scans, however many positions are wanted, and leaves some thousandths
of the rows; there is no other path for small or large inputs. Columns are compared
as doubles; NaN counts as null.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.activity import known_sql, number_sql
from tessera.session import materialize

SKETCH_SIZE = 8192       # rank error below 0.1 %
MARGIN = 0.002           # of ranks, on both sides of a wanted position


@dataclass(frozen=True)
class Part:
    """Rows of the column among which positions are wanted."""

    test: str            # which rows
    start: int           # known values before them
    rows: int
    positions: frozenset[int]       # in the whole column
    sketch: bytes


def _scan(data: DataFrame, columns: list[str]):
    """One aggregation over ``data``."""
    return data.selectExpr(*columns).first()


def _sketch_sql(test: str) -> str:
    return f"kll_sketch_agg_double(CASE WHEN {test} THEN v END, {SKETCH_SIZE})"


def _proposals(data: DataFrame, parts: list[Part]) -> list[list[float]]:
    """Distinct values in order, around and at each wanted position, for every part."""
    columns = []
    for i, part in enumerate(parts):
        middles = [(p - part.start + 0.5) / part.rows for p in part.positions]
        ranks = sorted({min(max(m + side, 0.0), 1.0) for m in middles for side in (-MARGIN, 0.0, MARGIN)})
        listed = ", ".join(number_sql(r) for r in ranks)
        columns.append(F.expr(f"kll_sketch_get_quantile_double(X'{bytes(part.sketch).hex()}', array({listed}))")
                       .alias(f"q{i}"))
    row = data.sparkSession.range(1).select(*columns).first()
    return [sorted(set(row[f"q{i}"])) for i in range(len(parts))]


def _pieces(part: Part, values: list[float]) -> list[tuple[str, float | None]]:
    """The part cut at the proposed values: conditions, and the value where there is only one."""
    at = [number_sql(v) for v in values]
    pieces: list[tuple[str, float | None]] = [(f"v < {at[0]}", None)]
    for i, v in enumerate(values):
        pieces.append((f"v = {at[i]}", v))
        above = f" AND v < {at[i + 1]}" if i + 1 < len(at) else ""
        pieces.append((f"v > {at[i]}{above}", None))
    return [(f"{part.test} AND {test}", v) for test, v in pieces]


def _locate(data: DataFrame, parts: list[Part]) -> dict[int, float]:
    """Values at the wanted positions of all parts of column ``v``."""
    found: dict[int, float] = {}
    while parts:
        pieces = [_pieces(part, values) for part, values in zip(parts, _proposals(data, parts))]
        sizes = iter(_scan(data, [f"count_if({test})" for own in pieces for test, _ in own]))
        gaps = []
        for part, own in zip(parts, pieces):
            start = part.start
            for test, value in own:
                size = next(sizes)
                here = frozenset(p for p in part.positions if start <= p < start + size)
                if value is not None:
                    found.update(dict.fromkeys(here, value))
                elif here:
                    gaps.append((test, start, size, here))
                start += size
        if not gaps:
            break
        # Only these rows are read again.
        data = materialize(data.where(" OR ".join(f"({test})" for test, *_ in gaps)), "gaps")
        sketches = _scan(data, [_sketch_sql(test) for test, *_ in gaps])
        parts = [Part(*gap, sketch) for gap, sketch in zip(gaps, sketches)]
    return found


def order_statistics(df: DataFrame, value: str,
                     positions: Callable[[int, int], Iterable[int]]) -> tuple[dict[int, float], int, int]:
    """Values at chosen 0-based positions of the sorted column, nulls left out.

    ``positions(known, nulls)`` names them once the counts are known. Returns the
    values, the number of known values and the number of nulls. ``df`` is read
    twice, so it should be a table or a cheap projection of one.
    """
    column = df.selectExpr(f"{known_sql(f'CAST({value} AS DOUBLE)')} AS v")
    rows, known, sketch = _scan(column, ["count(1)", "count(v)", _sketch_sql("v IS NOT NULL")])
    wanted = frozenset(p for p in positions(known, rows - known) if 0 <= p < known)
    parts = [Part("v IS NOT NULL", 0, known, wanted, sketch)] if wanted else []
    return _locate(column, parts), known, rows - known


def exact_percentiles(df: DataFrame, value: str, fractions: list[float]) -> list[float | None]:
    """Percentiles with linear interpolation between neighbours; None if no value is known."""

    def spot(fraction: float, known: int) -> tuple[int, int, float]:
        rank = fraction * (known - 1)
        return math.floor(rank), math.ceil(rank), rank - math.floor(rank)

    values, known, _ = order_statistics(
        df, value, lambda n, _: [p for f in fractions for p in spot(f, n)[:2]] if n else []
    )
    if not known:
        return [None] * len(fractions)
    result = []
    for fraction in fractions:
        low, high, weight = spot(fraction, known)
        result.append(values[low] + (values[high] - values[low]) * weight)
    return result


def percent_rank_cutoffs(df: DataFrame, value: str, fractions: list[float]) -> list[float | None]:
    """For each fraction the least value whose percent rank reaches it; None if no value does.

    Percent rank is (rows below) / (rows - 1), equal values share it, nulls rank first.
    """
    needed: dict[float, int | None] = {}

    def positions(known: int, nulls: int) -> list[int]:
        last = known + nulls - 1
        for fraction in fractions:
            if fraction <= 0:
                needed[fraction] = 0
            elif last <= 0:
                needed[fraction] = None
            else:
                below = math.ceil(fraction * last)
                while below > 0 and (below - 1) / last >= fraction:
                    below -= 1
                while below / last < fraction:
                    below += 1
                needed[fraction] = max(below - nulls, 0)
        return [0] + [b - 1 for b in needed.values() if b]

    values, known, _ = order_statistics(df, value, positions)
    if not known:
        return [None] * len(fractions)
    # With b rows needed below, the cutoff is the next value above position b - 1.
    floors = {f: values[b - 1] for f, b in needed.items() if b and b <= known}
    above = {}
    if floors:
        v = known_sql(f"CAST({value} AS DOUBLE)")
        least = [f"min(CASE WHEN {v} > {number_sql(x)} THEN {v} END)" for x in floors.values()]
        above = dict(zip(floors, df.selectExpr(*least).first()))
    return [values[0] if needed[f] == 0 else above.get(f) for f in fractions]


def tier_by_percent_rank(df: DataFrame, value: str, tiers: list[tuple[float, str]], lowest: str,
                         tier: str = "tier", digits: int = 6) -> DataFrame:
    """Name the tier of each row from the percent rank of ``value``.

    A tier depends on whether a value reaches a cutoff, and the cutoffs are a few
    numbers, so no row needs its own rank and no window runs. ``df`` is written
    once: its values must not change between finding and applying the cutoffs.
    Values are compared at ``digits`` decimals, so that the order in which sums
    were added cannot split a tie.
    """
    rounded = "_rank_value"
    fixed = materialize(df.withColumn(rounded, F.round(value, digits)), "tiers")
    tiers = sorted(tiers, reverse=True)
    cutoffs = percent_rank_cutoffs(fixed, rounded, [f for f, _ in tiers])
    name: Column = F.lit(lowest)
    for cutoff, (_, label) in reversed(list(zip(cutoffs, tiers))):
        if cutoff is not None:
            name = F.when(F.col(rounded) >= F.lit(cutoff), label).otherwise(name)
    return fixed.withColumn(tier, name).drop(rounded)
