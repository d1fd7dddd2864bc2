"""Deduplication over batches that arrive one after another."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievewright.operators.dedup import dedup_first
from sievewright.streaming.dedup import dedup_stream, run_to_end

SCHEMA = "candidate_id long, resume_url string, name string"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "in"))


def run(spark, folder, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    out = dedup_stream(stream, **options)
    writer = out.writeStream.format("parquet").option("path", str(folder / "out")).option("checkpointLocation", str(folder / "state"))
    run_to_end(spark, writer)
    return sorted((tuple(r) for r in spark.read.schema(SCHEMA).parquet(str(folder / "out")).collect()), key=str)


BATCHES = [
    [(3, "u1", "c"), (1, "u1", "a"), (2, None, "b"), (5, "u2", "e")],
    [(6, "u1", "again"), (4, None, "null again"), (8, "u3", "h"), (7, "u3", "g")],
    [(9, "u2", "again"), (10, "u4", "j"), (11, "u3", "again")],
]


def test_batches_equal_one_table(spark, tmp_path):
    """Also over a restart: the second run finds the first one's state."""
    land(spark, tmp_path, BATCHES[0])
    run(spark, tmp_path)
    land(spark, tmp_path, BATCHES[1])
    land(spark, tmp_path, BATCHES[2])
    got = run(spark, tmp_path)
    whole = spark.createDataFrame([r for b in BATCHES for r in b], SCHEMA)
    assert got == sorted((tuple(r) for r in dedup_first(whole).collect()), key=str)
    assert [r[0] for r in got] == sorted([1, 2, 5, 7, 10], key=lambda i: str((i,)))


def test_null_keys_can_stay(spark, tmp_path):
    for batch in BATCHES[:2]:
        land(spark, tmp_path, batch)
    got = run(spark, tmp_path, keep_null_keys=True)
    assert {r[0] for r in got} == {1, 2, 4, 5, 7}


def test_a_missing_key_column_is_named(spark, tmp_path):
    land(spark, tmp_path, BATCHES[0])
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="other"):
        dedup_stream(stream, by="other")


def test_the_evaluation_flow_asks_nothing_for_a_resume_that_comes_again(spark, tmp_path):
    from sievewright.catalog import stub
    from sievewright.operators.inference import ResponseCache
    from sievewright.plans.evaluation import Service
    from sievewright.streaming.arrivals import evaluate_stream

    schema = "candidate_id long, resume_url string, name string, resume_text string, job_desc string"
    seen = []

    def sink(batch, batch_id):
        seen.append(sorted(r["candidate_id"] for r in batch.select("candidate_id").collect()))

    service = Service(stub.StubClient(refuse=False), stub.WRITER, stub.JUDGE, ResponseCache(str(tmp_path / "cache")))
    for rows in ([(1, "u1", "a", "text one", "job"), (2, "u2", "b", "text two", "job")], [(3, "u1", "a", "text one, changed", "job"), (4, "u3", "c", "text three", "job")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        run_to_end(spark, evaluate_stream(stream, service, stub.TEMPLATES, sink, str(tmp_path / "cp")))
    assert seen == [[1, 2], [4]]


def test_a_key_with_one_row_is_not_sorted(monkeypatch):
    import pandas as pd

    from sievewright.streaming.dedup import _first_row

    class State:
        hasTimedOut, exists, seen = False, False, None

        def update(self, value):
            self.seen = value

    def unsorted(*a, **b):
        raise AssertionError("sorted")

    one, two = pd.DataFrame({"k": [1], "at": [7]}), pd.DataFrame({"k": [1, 2], "at": [9, 3]})
    task, state = _first_row("at", ["k", "at"], 0), State()
    assert [x.k.tolist() for x in task(("a",), iter([two, one]), state)] == [[2]] and state.seen == (True,)
    monkeypatch.setattr(pd.DataFrame, "sort_values", unsorted)
    assert [x.k.tolist() for x in task(("a",), iter([one]), State())] == [[1]]
