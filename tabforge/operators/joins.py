"""Joining fitted statistics back to rows.

A statistic table is broadcast only when its row count has a bound that does
not grow with the data (levels of a checked vocabulary, folds, coefficients,
one-row aggregates) or when it has been computed and counted.  Otherwise the join
is left to Catalyst with AQE on, which splits skewed partitions of the row side
when one key holds a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import checkpoint

# Row bound up to which a statistic table is broadcast explicitly.
BROADCAST_MAX_ROWS = 200_000


def attach(rows: DataFrame, stats: DataFrame, on, how: str = "left",
           bound: int | None = None) -> DataFrame:
    """Join ``stats`` to ``rows``; broadcast only with a proven ``bound``, which is counted."""
    if bound is not None and bound <= BROADCAST_MAX_ROWS:
        n = stats.count()
        if n > bound:
            raise ValueError(f"{n} rows where at most {bound} were promised")
        stats = F.broadcast(stats)
    return rows.join(stats, on=on, how=how)


def attach_counted(rows: DataFrame, stats: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a fitted statistic of unknown size: it is computed once and counted, and broadcast if
    it has at most ``BROADCAST_MAX_ROWS`` rows, so ``rows`` are not shuffled.  A larger one has
    many keys; that join is left to AQE, which splits the partitions of hot keys."""
    stats = checkpoint(stats)
    if stats.count() <= BROADCAST_MAX_ROWS:
        stats = F.broadcast(stats)
    return rows.join(stats, on=on, how=how)
