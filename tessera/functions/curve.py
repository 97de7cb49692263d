"""A space-filling key: rows near in several dimensions get near keys."""

from __future__ import annotations


def interleaved_sql(dimensions: list[tuple[str, int]]) -> str:
    """The bits of several whole numbers, from the highest, taken in turn (a Z-order curve).

    ``dimensions``: expression and number of bits. Values outside 0 .. 2^bits - 1 and nulls are moved
    to the nearest end; dimensions of fewer bits start later, so that equal bits mean equal lengths.
    """
    most = max(bits for _, bits in dimensions)
    parts, place = [], 0
    for bit in range(most):             # from the lowest
        for expression, bits in reversed(dimensions):
            if bit < bits:
                held = f"CAST(least(greatest(coalesce({expression}, 0), 0), {2 ** bits - 1}) AS BIGINT)"
                parts.append(f"shiftleft(shiftright({held}, {bit}) & 1L, {place})")
                place += 1
    return "(" + " | ".join(parts) + ")"
