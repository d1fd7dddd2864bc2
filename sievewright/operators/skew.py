"""Joins whose left side may hold one key in a large share of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SALTS = 1_024


def salted_left_join(left: DataFrame, right: DataFrame, on: str, spread_by: str, salts: int = SALTS) -> DataFrame:
    """Left join on ``on`` with every key's rows dealt to ``salts`` parts.

    Left rows are dealt by a hash of ``spread_by``. The parts that really occur, which are
    counted up in each task first, meet the right side, so a right row is repeated at most
    once per part and no more often than it has left rows. ``right`` has one row per key.
    The plan is the same at every size; a null key has no match.
    """
    dealt = left.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    parts = dealt.where(F.col(on).isNotNull()).select(on, "__salt").distinct().join(right, on)
    out = dealt.join(parts, [on, "__salt"], "left")
    return out.select(*left.columns, *[c for c in right.columns if c != on])
