"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

# A side known to hold at most this many short rows is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000


def broadcast_within(df: DataFrame, rows: int) -> DataFrame:
    """Mark a side for broadcasting if its row bound, found by the caller, is small enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on the keys, a null key being equal to a null key; the left side's keys stay."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(other, reduce(and_, same), how).drop(*(f"_{k}" for k in keys))


def at_latest(df: DataFrame, date: str = "fecha") -> DataFrame:
    """Rows of the latest date; on a date-partitioned table only that partition is read."""
    return df.where(F.col(date) == df.select(F.max(date)).scalar())


def pct(part: Column, whole: Column) -> Column:
    return F.try_divide(100.0 * part, whole)
