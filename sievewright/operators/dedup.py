"""Keep-first deduplication that survives a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _group(df: DataFrame, by: str, order: str, keep_null_keys: bool) -> list[Column]:
    """Grouping columns; with ``keep_null_keys`` every null key is its own group."""
    key = F.col(f"`{by}`")
    if not keep_null_keys:
        return [key.alias("__key")]
    return [key.alias("__key"), F.when(key.isNull(), F.col(order)).alias("__row")]


def dedup_first(
    df: DataFrame, by: str = "resume_url", order: str = "candidate_id", keep_null_keys: bool = False
) -> DataFrame:
    """First row per key in ``order``, which must be unique per row.

    Only ``(key, order)`` is aggregated, as a minimum that combines before the
    shuffle, so a key that holds a third of the table costs one row per task.
    The whole rows then meet the winners on the unique ``order`` column, which
    has no hot value. All null keys are one group unless ``keep_null_keys``.
    """
    if by not in df.columns:
        raise ValueError(f"Missing required columns: {[by]}")
    winners = df.groupBy(*_group(df, by, order, keep_null_keys)).agg(F.min(order).alias(order)).select(order)
    return df.join(winners, order, "left_semi")


def dedup_report(df: DataFrame, by: str = "resume_url", order: str = "candidate_id") -> DataFrame:
    """One row: rows read, kept and removed, and the largest group."""
    groups = df.groupBy(*_group(df, by, order, False)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_kept"),
        F.coalesce(F.sum("n") - F.count(F.lit(1)), F.lit(0)).alias("n_removed"),
        F.coalesce(F.max("n"), F.lit(0)).alias("largest_group"),
    )
