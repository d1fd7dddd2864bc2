"""CSV and Parquet tables at the edge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..schema import rename_in
from . import csv_ranges

# Cell texts that mean "missing" in the source files.
NA_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

BOM = "﻿"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes.

    Without a schema every column is a string: there is no second pass to infer
    types. Missing markers become null. A file is read by one task; :func:`land_csv` and
    :func:`csv_ranges.read_ranges` read large files by many.
    """
    reader = spark.read.option("header", True).option("multiLine", True)
    reader = reader.option("quote", '"').option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return na_to_null(reader.csv(path))


def na_to_null(df: DataFrame) -> DataFrame:
    """Missing markers -> null in every string column."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: null_if_marker(F.col(f"`{c}`")) for c in strings}) if strings else df


def null_if_marker(c):
    return F.when(~c.isin(*NA_MARKERS), c)


def land(df: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and continue from there: columnar, splittable, pruned."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def land_csv(
    spark: SparkSession,
    source: str,
    path: str,
    headings: Mapping[str, str] | None = None,
    key: str = "candidate_id",
    key_type: str = "bigint",
) -> DataFrame:
    """CSV files as one Parquet table under canonical names, with a row key in file order.

    The key is made once and written with the rows: the number of the file, by name, and the
    place in it, so that "keep the first" means the first in the files. Cells may hold line
    breaks; a file is still read by many tasks (:mod:`.csv_ranges`). A table that has a
    column ``key`` keeps its own, as ``key_type``.
    """
    headings = headings or {}
    given = [headings.get(c, c) for c in csv_ranges.headings_of(spark, source)]
    own = key in given
    raw = na_to_null(rename_in(csv_ranges.read_ranges(spark, source, key=None if own else "__at"), headings))
    if own:
        return land(raw.withColumn(key, F.col(f"`{key}`").cast(key_type)), path)
    return land(raw.select(F.col("__at").alias(key), *raw_columns(raw.drop("__at"))), path)


def raw_columns(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The table with a row count that is filled in by whatever action runs on it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def write_csv(df: DataFrame, path: str, bom: bool = True, mode: str = "errorifexists") -> None:
    """CSV parts with header and doubled quotes.

    With ``bom`` each part starts with the UTF-8 byte-order mark that spreadsheet
    programs look for; it travels in front of the first heading. Blanks at the ends
    of a cell are kept.
    """
    if bom and df.columns:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    writer = df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)
