"""Exact folds, size-bounded batches, quantile sketches, and the rate of calls."""

from __future__ import annotations

import collections
import math
import os
import sys
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sievewright.operators import inference as inf, sketches
from sievewright.operators.scoring import batch_scorer, packed
from sievewright.operators.split import exact_folds

# The client below lives in this module, which executors cannot import.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# -- folds ------------------------------------------------------------------------


@pytest.mark.parametrize("folds", [1, 2, 5, 7])
def test_fold_sizes_differ_by_one_at_most(spark, folds):
    rows = [(i, "No" if i < 403 else "Yes" if i < 440 else "Maybe" if i < 443 else "other" if i < 460 else None) for i in range(465)]
    df = spark.createDataFrame(rows, "k long, label string").repartition(6)
    got = exact_folds(df, "k", "label", folds).collect()
    assert len(got) == 465 and all(0 <= r["fold"] < folds for r in got)
    sizes = collections.Counter((r["label"], r["fold"]) for r in got)
    for label, n in (("No", 403), ("Yes", 37), ("Maybe", 3)):
        own = [sizes[label, f] for f in range(folds)]
        assert sum(own) == n and max(own) - min(own) <= 1
    again = exact_folds(df.repartition(3), "k", "label", folds).collect()
    assert {(r["k"], r["fold"]) for r in got} == {(r["k"], r["fold"]) for r in again}


def test_folds_of_an_empty_table(spark):
    assert exact_folds(spark.createDataFrame([], "k long, label string"), "k", "label").isEmpty()


# -- batches ---------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), max_size=80), st.integers(1, 9), st.integers(1, 900))
def test_no_batch_is_over_its_limits_unless_one_input_is(sizes, rows, chars):
    batches = list(packed(sizes, rows, chars))
    assert sorted(i for b in batches for i in b) == list(range(len(sizes)))
    for b in batches:
        assert len(b) <= rows and (len(b) == 1 or len(b) * max(sizes[i] for i in b) <= chars)


def test_results_stay_in_row_order(spark):
    seen = spark.sparkContext.accumulator(0)

    def load():
        def score(values):
            if len(values) > 1 and len(values) * max(map(len, values)) > 50:
                seen.add(1)
            return np.array([[len(v)] for v in values])

        return score

    df = spark.createDataFrame([(i, None if i % 7 == 0 else "x" * ((i * 37) % 101)) for i in range(300)], "i long, t string")
    got = df.select("i", F.length("t").alias("n"), batch_scorer(load, 16, 50)("t").alias("v")).collect()
    assert all((r["v"] is None) if r["n"] is None else r["v"] == [r["n"]] for r in got) and seen.value == 0


# -- sketches ----------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.floats(1e-8, 1e12), st.sampled_from([0.001, 0.01, 0.2]))
def test_a_bin_stands_for_its_values(value, error):
    ratio = (1 + error) / (1 - error)
    number = math.ceil(math.log(value) / math.log(ratio))
    middle = ratio**number * 2 / (1 + ratio)
    assert abs(middle - value) <= error * value * (1 + 1e-9)


def test_days_add_up_to_the_month(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.lognormal(0, 3, 3_000), -rng.lognormal(0, 1, 500), np.zeros(40)])
    rows = [(f"2024-01-{1 + i % 28:02d}", float(v)) for i, v in enumerate(values)] + [("2024-01-05", None), ("2024-01-05", float("nan"))]
    df = spark.createDataFrame(rows, "day string, v double")
    days = sketches.sketch(df, "day", "v")
    month = sketches.merge(days.where("period < '2024-01-15'"), days.where("period >= '2024-01-15'"), period=F.left("period", F.lit(7)))
    once = sketches.sketch(df.withColumn("day", F.left("day", F.lit(7))), "day", "v")
    assert sorted(map(tuple, month.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    wanted = [0.0, 0.01, 0.1, 0.135, 0.5, 0.9, 0.999, 1.0]
    got = {r["q"]: r["value"] for r in sketches.quantiles(month, wanted).collect()}
    ordered = np.sort(values)
    for q in wanted:
        exact = ordered[max(math.ceil(q * len(ordered)), 1) - 1]
        assert abs(got[q] - exact) <= 0.01 * abs(exact) + 1e-9


def test_drift_sees_a_shift_and_nothing_else(spark):
    rng = np.random.default_rng(6)
    rows = [("a", float(v)) for v in rng.uniform(0, 1, 4_000)] + [("b", float(v)) for v in rng.uniform(0, 1, 4_000)]
    rows += [("c", float(v)) for v in rng.uniform(0.5, 1, 4_000)] + [("d", None)] * 10
    got = {r["period"]: (r["n"], r["psi"]) for r in sketches.drift(sketches.sketch(spark.createDataFrame(rows, "p string, v double"), "p", "v")).collect()}
    assert [got[p][0] for p in "abcd"] == [4_000, 4_000, 4_000, 10]
    assert got["a"][1] == 0 and got["b"][1] < 0.02 and got["c"][1] > 1 and got["d"][1] > 1


def test_error_must_be_a_share():
    with pytest.raises(ValueError):
        sketches.value_of(F.lit(1), 1.5)


# -- the rate of calls ------------------------------------------------------------------


class Noting:
    """Notes the time of every call in a file of its own."""

    def __init__(self, folder, fail_first=False):
        self.folder, self.fail_first = str(folder), fail_first

    def complete(self, model, prompt):
        name = prompt.replace(" ", "-")
        n = sum(f.startswith(f"{name}.") for f in os.listdir(self.folder))
        with open(f"{self.folder}/{name}.{n}", "w") as f:
            f.write(repr(time.time()))
        if self.fail_first and n == 0:
            raise RuntimeError("503 overloaded" if "retry" in prompt else "no such model")
        return prompt.upper()


def calls(folder):
    return sorted(float(open(f"{folder}/{f}").read()) for f in os.listdir(folder))


@pytest.mark.parametrize("tasks", [1, 4, 16])
def test_no_second_holds_more_calls_than_the_rate(spark, tmp_path, tasks):
    queue = spark.createDataFrame([(f"h{i}", f"p {i}") for i in range(48)], "prompt_hash string, prompt string").repartition(tasks)
    pace = inf.Pace(calls_per_second=40)
    running = min(tasks, spark.sparkContext.defaultParallelism)
    assert len(inf.call_service(queue, Noting(tmp_path), "m", 8, pace, running).collect()) == 48
    times = np.array(calls(tmp_path))
    most = max(((times >= t) & (times < t + 1.0)).sum() for t in times)
    assert len(times) == 48 and most <= 40 + running


def test_what_may_pass_is_tried_again_and_the_rest_is_not(spark, tmp_path):
    queue = spark.createDataFrame([("a", "retry me"), ("b", "hopeless")], "prompt_hash string, prompt string")
    pace = inf.Pace(retries=3, first_wait=0.05)
    got = {r["prompt_hash"]: r for r in inf.call_service(queue, Noting(tmp_path, fail_first=True), "m", 4, pace).collect()}
    assert got["a"]["response"] == "RETRY ME" and got["a"]["message"] is None
    assert got["b"]["message"] == "no such model" and len(calls(tmp_path)) == 3


def test_waits_grow_and_are_bounded():
    assert inf.Pace(retries=5, first_wait=2, longest_wait=10).waits() == [2, 4, 8, 10, 10]


def test_a_bucket_spaces_its_tokens():
    now, slept = [0.0], []

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    bucket = inf.TokenBucket(2.0, clock=lambda: now[0], sleep=sleep)
    for _ in range(4):
        bucket.take()
    assert now[0] == pytest.approx(2.0) and max(slept) == pytest.approx(0.5)
    now[0] += 100
    bucket.take()  # idle time gives no burst
    bucket.take()
    assert now[0] == pytest.approx(102.5)
