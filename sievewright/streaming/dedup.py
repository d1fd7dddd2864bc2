"""Keep-first deduplication over arriving files: a key seen in an earlier batch stays out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: How long a key is remembered after its first row, by default.
REMEMBERED_MS = 90 * 24 * 3600 * 1000


def _first_row(order: str, columns: list[str], remembered_ms: int):
    """Lets the first row of a key through and remembers the key until its time is over.

    Rows of one batch are ordered by ``order``; an earlier batch comes before a later one.
    The state is one mark per key, so it does not grow with the rows.
    """

    def task(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for part in rows:
            # Most keys come once; a table of one row needs no sorting.
            own = part if len(part) < 2 else part.sort_values(order, kind="stable").head(1)
            if len(own) and (best is None or own[order].iloc[0] < best[order].iloc[0]):
                best = own
        if best is None or state.exists:
            return
        state.update((True,))
        if remembered_ms > 0:
            state.setTimeoutDuration(remembered_ms)
        yield best[columns]

    return task


def _first_in_batch(by: str, order: str):
    """Each task sends one row per key and Arrow batch, so a key that fills a third of the
    arriving rows does not travel as often."""

    def task(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.sort_values(order, kind="stable").drop_duplicates(by)

    return task


def dedup_stream(
    stream: DataFrame,
    by: str = "resume_url",
    order: str = "candidate_id",
    keep_null_keys: bool = False,
    remembered_ms: int = REMEMBERED_MS,
) -> DataFrame:
    """First row per key over all batches, as :func:`..operators.dedup.dedup_first` over a
    table whose rows stand in the order of arrival, then of ``order``.

    Keys are kept in the stream's state, which a checkpoint restores: a row that comes
    again weeks later, or after a restart, stays out until ``remembered_ms`` have passed
    since the key's first row (0: for ever). All null keys are one key unless
    ``keep_null_keys``. Output in append mode; see :func:`run_to_end` for runs that stop.
    """
    if by not in stream.columns:
        raise ValueError(f"Missing required columns: {[by]}")
    mark, null = F.col(f"`{by}`").cast("string"), F.lit("")
    if keep_null_keys:
        null = F.concat(F.lit("#"), F.col(f"`{order}`").cast("string"))
    keyed = stream.withColumn("__key", F.when(mark.isNull(), null).otherwise(F.concat(F.lit("="), mark)))
    once = keyed.mapInPandas(_first_in_batch("__key", order), keyed.schema)
    limit = GroupStateTimeout.ProcessingTimeTimeout if remembered_ms > 0 else GroupStateTimeout.NoTimeout
    return once.groupBy("__key").applyInPandasWithState(
        _first_row(order, stream.columns, remembered_ms), stream.schema, "seen boolean", "append", limit
    )


def run_to_end(spark: SparkSession, writer: DataStreamWriter) -> None:
    """Work off what has arrived, then stop.

    Batches without rows, which only look for keys whose time is over, would follow one
    another for ever; they are left out, and such keys are dropped with the next rows.
    """
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    given = spark.conf.get(name)
    spark.conf.set(name, "false")  # a stream takes its settings when it starts
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, given)
    query.awaitTermination()
