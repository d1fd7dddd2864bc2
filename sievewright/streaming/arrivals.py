"""Newly arriving candidates: stateless scoring, and waves per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..plans.evaluation import Service, Templates, evaluate
from ..plans.prediction import predict
from ..session import settle
from .dedup import dedup_stream


def score_stream(stream: DataFrame, model: PipelineModel, confidence_threshold: float = 0.0) -> DataFrame:
    """Prediction is row-wise, so the batch flow runs on a stream unchanged."""
    return predict(stream, model, confidence_threshold=confidence_threshold)


def evaluate_stream(
    stream: DataFrame,
    service: Service,
    templates: Templates,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    remembered_ms: int | None = 0,
) -> DataStreamWriter:
    """The evaluation flow per micro-batch, for résumés that no earlier batch had.

    A résumé's address is remembered for ``remembered_ms`` (:func:`.dedup.dedup_stream`;
    0: for ever, None: each batch is deduplicated alone), so that batches cost no more calls
    than one table of the same rows.

    A batch that is repeated after a failure finds its answers in the cache, which
    is therefore required; ``sink`` must be idempotent per batch id.
    """
    if service.cache is None:
        raise ValueError("evaluate_stream needs a response cache")

    def run(batch: DataFrame, batch_id: int) -> None:
        # Written first: the flow reads it several times, the stream's state must move once.
        sink(evaluate(settle(batch, "arrivals"), service, templates), batch_id)

    once = stream if remembered_ms is None else dedup_stream(stream, remembered_ms=remembered_ms)
    return once.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
