"""Bin indices. The two edge conventions are never mixed: pick the helper by the side that is closed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_edges(n_bins: int) -> list[float]:
    """n_bins + 1 equally spaced edges on [0, 1] as the doubles i * (1 / n)."""
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def right_closed_bin(x: Column, edges: Sequence[float]) -> Column:
    """Index of the bin (e_i, e_i+1]; the first bin also takes all below, the last all above."""
    inner = edges[1:-1]
    if not inner:
        return F.when(x.isNotNull(), F.lit(0))
    branch = F.when(x <= F.lit(inner[0]), F.lit(0))
    for i, edge in enumerate(inner[1:], start=1):
        branch = branch.when(x <= F.lit(edge), F.lit(i))
    return branch.when(x.isNotNull(), F.lit(len(inner)))


def equal_width_bin(x: Column, lo: Column, hi: Column, n: int, closed: str) -> Column:
    """Index of x among n equal-width bins on [lo, hi], by arithmetic plus a one-step edge correction.

    ``closed='left'``: [e_i, e_i+1), last bin closed. ``closed='right'``: (e_i, e_i+1], first bin closed.
    """
    width = (hi - lo) / F.lit(float(n))
    guess = F.least(F.greatest(F.floor((x - lo) / width).cast("int"), F.lit(0)), F.lit(n - 1))
    below, above = lo + guess * width, lo + (guess + 1) * width
    if closed == "left":
        moved = F.when(x < below, guess - 1).when(x >= above, guess + 1).otherwise(guess)
    elif closed == "right":
        moved = F.when(x <= below, guess - 1).when(x > above, guess + 1).otherwise(guess)
    else:
        raise ValueError(f"unknown closed side: {closed}")
    return F.when(x.isNotNull() & (width > 0), F.least(F.greatest(moved, F.lit(0)), F.lit(n - 1)))


def edge_array_bin(x: Column, edges: Column, max_edges: int) -> Column:
    """Index of x in a sorted edge array: [e_i, e_i+1), last bin closed, NULL outside the range.

    ``max_edges`` bounds the array's length; the edges are counted one by one in generated code.
    """
    position = F.lit(0)
    for i in range(max_edges):
        position = position + F.when(F.get(edges, F.lit(i)) <= x, 1).otherwise(0)
    last = F.size(edges)
    return F.when((position >= 1) & (position < last), position - 1).when(x == F.get(edges, last - 1), last - 2)
