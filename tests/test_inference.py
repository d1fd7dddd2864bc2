"""Waves: error isolation, cache, one call per distinct prompt, hot prompts."""

from __future__ import annotations

import os
import sys
import uuid
from dataclasses import dataclass

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sievewright.operators import inference as inf

# The client below lives in this module, which executors cannot import.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class LoggingClient:
    """Writes one file per call, so that calls in other processes are seen."""

    folder: str
    fail_on: str = "\0"

    def complete(self, model, prompt):
        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as f:
            f.write(prompt)
        if self.fail_on in prompt:
            raise RuntimeError("no PERMISSION for this")
        if prompt == "none":
            return None
        return f" {model}:{prompt} "

    def calls(self):
        return sorted(open(os.path.join(self.folder, f)).read() for f in os.listdir(self.folder))


def answers(df):
    return {r[0]: r[1] for r in df.collect()}


def test_wave_answers_every_row(spark, tmp_path):
    client = LoggingClient(str(tmp_path), fail_on="bad")
    df = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, "bad"), (4, None), (5, "none"), (6, "")], "candidate_id long, prompt string"
    )
    out = answers(inf.run_wave(df, client, "m", threads=3))
    assert out == {
        1: "m:a", 2: "m:a", 3: "Error: Invalid API key - no PERMISSION for this", 4: None, 5: "", 6: "m:",
    }
    assert client.calls() == ["", "a", "bad", "none"]


def test_plain_errors():
    assert inf.error_text(ValueError("timeout")) == "Error: timeout"
    assert inf.error_text(ValueError("Unauthorized")) == "Error: Invalid API key - Unauthorized"


def test_cache_asks_once_and_not_for_failures(spark, tmp_path):
    calls, store = tmp_path / "calls", tmp_path / "cache"
    calls.mkdir()
    cache = inf.ResponseCache(str(store))
    client = LoggingClient(str(calls), fail_on="bad")
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "b")], "candidate_id long, prompt string")
    first = answers(inf.run_wave(df, client, "m", cache=cache))
    again = answers(inf.run_wave(df, client, "m", cache=cache))
    assert first == again
    assert client.calls() == ["a", "b", "bad", "bad"]
    # Another model has its own answers.
    assert answers(inf.run_wave(df, client, "1", cache=cache))[1] == "1:a"
    assert len(client.calls()) == 7
    more = spark.createDataFrame([(7, "a"), (8, "c")], "candidate_id long, prompt string")
    assert answers(inf.run_wave(more, client, "m", cache=cache)) == {7: "m:a", 8: "m:c"}
    assert len(client.calls()) == 8


@dataclass(frozen=True)
class StoppingClient(LoggingClient):
    """Ends the whole process of the worker after some calls, as a lost executor does."""

    until: int = 0

    def complete(self, model, prompt):
        if len(os.listdir(self.folder)) >= self.until:
            raise KeyboardInterrupt
        return super().complete(model, prompt)


def test_stopped_wave_asks_only_for_the_rest(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    cache = inf.ResponseCache(str(tmp_path / "cache"))
    df = spark.range(60).select(F.col("id").alias("candidate_id"), F.format_string("p%02d", "id").alias("prompt"))
    with pytest.raises(Exception):
        inf.run_wave(df, StoppingClient(str(calls), until=30), "m", cache=cache, calls_per_batch=10, threads=1)
    stored = cache.read(spark, "m").count()
    assert 0 < stored <= 30
    before = len(os.listdir(calls))
    out = answers(inf.run_wave(df, LoggingClient(str(calls)), "m", cache=cache, calls_per_batch=10))
    assert out == {i: f"m:p{i:02d}" for i in range(60)}
    assert len(os.listdir(calls)) - before == 60 - stored


def test_failure_keeps_the_exception_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None)], "candidate_id long, prompt string")
    out = inf.run_wave(df, LoggingClient(str(tmp_path), fail_on="bad"), "m", failure="why")
    assert {r[0]: r["why"] for r in out.collect()} == {1: None, 2: "no PERMISSION for this", 3: None}


def test_unreadable_cache_is_not_an_empty_one(spark, tmp_path):
    (tmp_path / "c" / "model=m").mkdir(parents=True)
    (tmp_path / "c" / "other").mkdir()
    (tmp_path / "c" / "model=m" / "a.parquet").write_bytes(b"x")
    df = spark.createDataFrame([(1, "a")], "candidate_id long, prompt string")
    with pytest.raises(Exception):
        inf.run_wave(df, LoggingClient(str(tmp_path)), "m", cache=inf.ResponseCache(str(tmp_path / "c")))


def test_empty_wave(spark, tmp_path):
    df = spark.createDataFrame([], "candidate_id long, prompt string")
    out = inf.run_wave(df, LoggingClient(str(tmp_path)), "m", cache=inf.ResponseCache(str(tmp_path / "c")))
    assert out.columns == ["candidate_id", "response"] and out.isEmpty()


def test_hot_prompt_is_asked_once_and_split(spark, tmp_path):
    client = LoggingClient(str(tmp_path))
    prompt = F.when(F.col("id") % 2 == 0, "same").otherwise(F.concat(F.lit("p"), F.col("id") % 50))
    df = spark.range(2000).select(F.col("id").alias("candidate_id"), prompt.alias("prompt"))
    out = answers(inf.run_wave(df, client, "m", calls_per_task=5))
    assert len(out) == 2000
    assert out[0] == "m:same" and out[3] == "m:p3"
    assert len(client.calls()) == 26


@pytest.mark.parametrize("n", [1, 17, 40])
def test_batch_scorer_loads_and_batches(spark, n):
    from sievewright.operators.scoring import batch_scorer

    def load():
        sizes = []

        def model(values):
            sizes.append(len(values))
            assert len(values) <= 16
            import numpy as np

            return np.array([[v, v * 2.0] for v in values])

        return model

    out = spark.range(n).coalesce(1).select("id", batch_scorer(load)("id").alias("s")).collect()
    assert {r["id"]: list(r["s"]) for r in out} == {i: [i, i * 2.0] for i in range(n)}


def test_null_inputs_never_reach_the_model(spark):
    import numpy as np

    from sievewright.operators.scoring import score_rows

    def load():
        def model(values):
            assert all(v is not None for v in values)
            return np.array([[len(v), 0.0, 1.0] for v in values])

        return model

    df = spark.createDataFrame([(1, "abc", True), (2, None, True), (3, "x", False), (4, "y", None)], "id long, t string, m boolean")
    out = {r["id"]: r["predicted"] for r in score_rows(df, "t", load, F.col("m")).collect()}
    assert out == {1: "Maybe", 2: None, 3: None, 4: None}


def test_prompts_are_shuffled_once_and_not_written(spark, tmp_path, monkeypatch):
    asked = []
    calls = inf.call_service

    def seen(queue, *rest):
        asked.append(queue._jdf.queryExecution().executedPlan().toString())
        return calls(queue, *rest)

    monkeypatch.setattr(inf, "call_service", seen)
    df = spark.range(300).select(
        F.col("id").alias("candidate_id"), F.when(F.col("id") < 250, "hot").otherwise(F.col("id").cast("string")).alias("prompt")
    )
    client = LoggingClient(str(tmp_path))
    out = answers(inf.run_wave(df, client, "m", calls_per_task=10))
    assert out == {i: "m:hot" if i < 250 else f"m:{i}" for i in range(300)}
    assert client.calls() == sorted(["hot", *map(str, range(250, 300))])
    assert len(asked) == 1 and "queue-" not in asked[0]
    assert asked[0].split("Final Plan")[-1].count("REPARTITION_BY_NUM") == 1


def test_null_and_repeated_keys_of_a_hot_prompt(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inf, "COPIES", 2)
    client = LoggingClient(str(tmp_path))
    rows = [(None, "a"), (None, "a"), (None, "a"), (7, "b"), (7, "b"), (None, "b"), (8, "b"), (7, "c"), (9, None)]
    df = spark.createDataFrame(rows, "candidate_id long, prompt string")
    out = inf.run_wave(df, client, "m").collect()
    want = [(k, None if p is None else f"m:{p}") for k, p in rows]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert client.calls() == ["a", "b", "c"]
