"""Key-based merges in place of position-based scatter and update."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

KEY = "candidate_id"


def scatter(df: DataFrame, partial: DataFrame, column: str, default: str | None, key: str = KEY) -> DataFrame:
    """Spread results that exist for some rows over all rows."""
    out = df.join(partial.select(key, column), key, "left")
    return out if default is None else out.withColumn(column, F.coalesce(column, F.lit(default)))


def update_merge(df: DataFrame, new: DataFrame, columns: Sequence[str], key: str = KEY) -> DataFrame:
    """Overwrite ``columns`` by the non-null values of ``new``; other rows keep theirs.

    Columns the left side lacks start as empty text.
    """
    right = new.select(key, *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = df.join(right, key, "left")
    merged = {
        c: F.coalesce(F.col(f"__new_{c}"), F.col(c) if c in df.columns else F.lit(""))
        for c in columns
    }
    return joined.withColumns(merged).drop(*[f"__new_{c}" for c in columns])


def write_back(df: DataFrame, partial: DataFrame, columns: Sequence[str], key: str = KEY) -> DataFrame:
    """Attach columns of the treated rows; null for all others."""
    return df.drop(*columns).join(partial.select(key, *columns), key, "left")
