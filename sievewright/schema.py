"""Canonical column names, required-column checks and edge renaming."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Short names used inside the library. External headings are mapped to these at
# the edge by the caller (``rename_in``) and mapped back at the sink.
CANDIDATE_SCHEMA = T.StructType(
    [
        T.StructField("candidate_id", T.LongType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("job_desc", T.StringType()),
        T.StructField("resume_text", T.StringType()),
        T.StructField("resume_url", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("duration", T.LongType()),
        T.StructField("criteria", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("result_llm", T.StringType()),
    ]
)

TRAIN_REQUIRED = ("job_desc", "resume_text", "verdict")
PREDICT_REQUIRED = ("job_desc", "resume_text")

TEXT_COL = "__text"  # reserved, so that a caller's own column of text stays
CLEAN_COL = "verdict_clean"
WORKING_COLS = (TEXT_COL, CLEAN_COL)


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Raise ``ValueError`` naming every required column that is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def column_or(df: DataFrame, name: str, default: object = None, dtype: str = "string") -> Column:
    """The column if the table has it, else a constant (schema check only)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(default).cast(dtype)


def ensure_columns(df: DataFrame, defaults: Mapping[str, object], dtype: str = "string") -> DataFrame:
    """Add the absent columns with their default; present ones are untouched."""
    new = {c: F.lit(v).cast(dtype) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def rename_in(df: DataFrame, headings: Mapping[str, str]) -> DataFrame:
    """External heading -> canonical name, for the headings that are present.

    Headings may hold arrows, brackets, question marks and trailing blanks.
    """
    return df.withColumnsRenamed({k: v for k, v in headings.items() if k in df.columns})


def rename_out(df: DataFrame, headings: Mapping[str, str]) -> DataFrame:
    """Inverse of :func:`rename_in`, applied at the sink."""
    return df.withColumnsRenamed({v: k for k, v in headings.items() if v in df.columns})


def drop_working(df: DataFrame) -> DataFrame:
    return df.drop(*WORKING_COLS)
