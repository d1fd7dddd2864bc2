"""A corpus pipeline: five stages, each one operator of the training-data package.

Toxic documents go; one document of each group of near copies stays; passages that repeat
an earlier document are cut; documents with benchmark passages go; the rest is encoded.
Every stage works on what the one before kept, and learns only from that and from the
small tables beside it (``labels``, ``benchmark``). Rows with a null id pass every filter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievewright.llm import bpe, decontaminate, passages, set_join, toxicity
from sievewright.llm.common import table
from sievewright.llm.queries import tokenizer_path
from sievewright.session import settle, ship_package

ship_package()


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return set_join.one_per_class(docs, set_join.near_copies(docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the text that is left."""
    left = passages.without_passages(docs, passages.repeated(docs))
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in left.columns else left


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocab = bpe.broadcast_vocabulary(spark, tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(docs, vocab)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("byte_bpe", encoded),
]

#: Models are fitted on the way, which SQL can't state.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
