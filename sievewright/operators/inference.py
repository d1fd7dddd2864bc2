"""Batch calls of an outside text service, with a response cache.

Lineage must never repeat a billed call: each step of a wave is a written table.
"""

from __future__ import annotations

import hashlib
import threading
import time
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.parse import ERROR_MARK
from ..session import discard, new_path, settle
from ..sources.stored import StoredTable
from .skew import SALTS, salted_left_join

THREADS = 32
CALLS_PER_TASK = 2_000
CALLS_PER_BATCH = 1_000_000
#: Prompts with more requests than this, or than lets HOT_PROMPTS of them be, travel in one copy.
COPIES = 100
HOT_PROMPTS = 100_000

# Marks of a key or permission failure in an exception text.
KEY_FAILURE_MARKS = ("api key", "invalid", "401", "403", "permission", "unauthorized")


class TextClient(Protocol):
    """What the caller supplies: picklable, holds its own secrets, thread-safe."""

    def complete(self, model: str, prompt: str) -> str: ...


# Marks of a failure that may pass, in an exception's text or type.
PASSING_MARKS = ("429", "500", "502", "503", "504", "rate limit", "timeout", "timed out", "temporarily", "overloaded", "connection reset")
PASSING_TYPES = (TimeoutError, ConnectionError)


def may_pass(exc: Exception) -> bool:
    return isinstance(exc, PASSING_TYPES) or any(mark in str(exc).lower() for mark in PASSING_MARKS)


@dataclass(frozen=True)
class Pace:
    """How fast a whole job may call, and how it meets failures that can pass.

    ``calls_per_second`` holds for all tasks together: every task gets an equal part, for
    as many tasks as can run at once. Attempts count as calls. A failed call that may
    succeed later is tried ``retries`` times more, after ``first_wait`` seconds and then
    twice as long each time, at most ``longest_wait``.
    """

    calls_per_second: float | None = None
    retries: int = 0
    first_wait: float = 1.0
    longest_wait: float = 60.0
    passing: Callable[[Exception], bool] = may_pass

    def waits(self) -> list[float]:
        return [min(self.first_wait * 2**i, self.longest_wait) for i in range(self.retries)]


class TokenBucket:
    """One token per ``1 / rate`` seconds and none in store, so that no span of time holds
    more than its share; threads wait for theirs in turn."""

    def __init__(self, rate: float | None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap = 1.0 / rate if rate else 0.0
        self.clock, self.sleep = clock, sleep
        self.lock = threading.Lock()
        self.next = clock() + self.gap

    def take(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = self.clock()
            turn = max(self.next, now)
            self.next = turn + self.gap
        self.sleep(turn - now)


def error_text(exc: Exception) -> str:
    lowered = str(exc).lower()
    if any(mark in lowered for mark in KEY_FAILURE_MARKS):
        return f"{ERROR_MARK} Invalid API key - {exc}"
    return f"{ERROR_MARK} {exc}"


@dataclass(frozen=True)
class ResponseCache:
    """Answers kept in Parquet by model and prompt hash. Failed calls are not kept."""

    path: str

    SCHEMA = "prompt_hash string, response string, model string"

    def read(self, spark: SparkSession, model: str, wanted: DataFrame | None = None) -> DataFrame:
        """Stored ``(prompt_hash, response)`` of one model, as written; two runs may
        have stored the same prompt. All of them are read, whatever is ``wanted``."""
        try:
            table = spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException as exc:
            # Any other trouble must not look like an empty cache: all would be asked again.
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            table = spark.createDataFrame([], self.SCHEMA)
        return table.where(F.col("model") == model).select("prompt_hash", "response")

    def append(self, answers: DataFrame, model: str) -> None:
        answers.select("prompt_hash", "response", F.lit(model).alias("model")).write.mode("append").partitionBy(
            "model"
        ).parquet(self.path)


@dataclass(frozen=True)
class StoredCache:
    """As :class:`ResponseCache`, a stored table per model in buckets by prompt hash.

    A wave reads only the buckets that hold a prompt it asks for. Answers are appended, a
    folder per bucket and batch, until ``compact`` makes them one.
    """

    path: str
    buckets: int = 256

    def table(self, spark: SparkSession, model: str) -> StoredTable:
        return StoredTable(spark, f"{self.path}/{hashlib.sha256(model.encode()).hexdigest()[:32]}")

    def read(self, spark: SparkSession, model: str, wanted: DataFrame | None = None) -> DataFrame:
        """Stored ``(prompt_hash, response)``, of the prompt hashes in ``wanted`` if given."""
        table = self.table(spark, model)
        if not table.versions():
            return spark.createDataFrame([], "prompt_hash string, response string")
        return table.read() if wanted is None else table.lookup(wanted)

    def append(self, answers: DataFrame, model: str) -> None:
        table = self.table(answers.sparkSession, model)
        rows = answers.select("prompt_hash", "response")
        if table.versions():
            table.append(rows)
        else:
            table.create(rows, "prompt_hash", self.buckets)

    def compact(self, spark: SparkSession, model: str) -> None:
        self.table(spark, model).compact()


def call_service(
    queue: DataFrame, client: TextClient, model: str, threads: int = THREADS, pace: Pace = Pace(), running: int | None = None
) -> DataFrame:
    """``(prompt_hash, response, message)`` for each row of ``(prompt_hash, prompt)``.

    One thread pool per task; a failing call becomes an error text, with the exception's own
    text as ``message``, and leaves the others alone. ``message`` is null for an answer, so
    an answer that reads like an error stays an answer. Open calls are at most running tasks
    times ``threads``; their rate is that of ``pace``, divided over ``running`` tasks (by
    default the session's cores: no more run at once).
    """
    running = running or queue.sparkSession.sparkContext.defaultParallelism
    own_rate = pace.calls_per_second / running if pace.calls_per_second else None

    def one(prompt: str, bucket: TokenBucket) -> tuple[str, str | None]:
        waits = pace.waits()
        while True:
            bucket.take()
            try:
                answer = client.complete(model, prompt)
                return ("" if answer is None else str(answer).strip(), None)
            except Exception as exc:  # every failure is data here
                if not waits or not pace.passing(exc):
                    return (error_text(exc), str(exc))
                time.sleep(waits.pop(0))

    def call(batches):
        bucket = TokenBucket(own_rate)
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for pdf in batches:
                done = list(pool.map(lambda prompt: one(prompt, bucket), pdf["prompt"]))
                out = pdf[["prompt_hash"]].copy()
                out["response"] = [text for text, _ in done]
                out["message"] = [message for _, message in done]
                yield out

    return queue.select("prompt_hash", "prompt").mapInPandas(
        call, "prompt_hash string, response string, message string"
    )


def prompt_hash(prompt):
    return F.sha2(prompt, 256)


def distinct_prompts(requests: DataFrame, prompt: str = "prompt") -> DataFrame:
    """``(prompt_hash, prompt, n)``: each prompt once with its number of requests.

    Equal prompts meet in the task that rendered them first, so a prompt shared
    by a third of the table does not travel as many copies.
    """
    p = F.col(prompt)
    return (
        requests.where(p.isNotNull())
        .groupBy(prompt_hash(p).alias("prompt_hash"), p.alias("prompt"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _each_once(
    requests: DataFrame, keyed: DataFrame, kept: DataFrame | None, key: str, prompt: str, n_requests: int, tasks: int
) -> DataFrame:
    """``(prompt_hash, prompt)``, each prompt once, without those in ``kept``, dealt by its
    hash to ``tasks`` tasks.

    The texts are shuffled once. Of a prompt with more than ``COPIES`` requests the row of the
    smallest key alone travels; those prompts are at most ``HOT_PROMPTS``, so they are broadcast.
    """
    least = max(COPIES, n_requests // HOT_PROMPTS)
    hot = keyed.groupBy("prompt_hash").agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias("__first"))
    p = F.col(prompt)
    rows = requests.where(p.isNotNull()).select(F.col(key).alias("__key"), prompt_hash(p).alias("prompt_hash"), p.alias("prompt"))
    met = rows.join(F.broadcast(hot.where(F.col("__n") > least)), "prompt_hash", "left")
    alone = met.where(F.col("__n").isNull() | F.col("__key").eqNullSafe(F.col("__first")))
    if kept is not None and not kept.isEmpty():
        alone = alone.join(kept, "prompt_hash", "left_anti")
    return alone.select("prompt_hash", "prompt").repartition(tasks, "prompt_hash").dropDuplicates(["prompt_hash"])


def run_wave(
    requests: DataFrame,
    client: TextClient,
    model: str,
    key: str = "candidate_id",
    prompt: str = "prompt",
    response: str = "response",
    cache: ResponseCache | StoredCache | None = None,
    threads: int = THREADS,
    calls_per_task: int = CALLS_PER_TASK,
    salts: int = SALTS,
    calls_per_batch: int = CALLS_PER_BATCH,
    failure: str | None = None,
    pace: Pace = Pace(),
) -> DataFrame:
    """One answer per request, as a written table ``(key, response)``.

    Each distinct prompt that the cache does not hold is asked once. Requests with
    a null prompt get a null answer and no call. With a cache, calls are made in batches of
    about ``calls_per_batch``, and the answers of each enter the cache before the
    next begins: a wave that is stopped and started again asks only for the rest. A lost
    executor repeats at most the calls of its unfinished tasks, ``calls_per_task`` each.

    ``failure`` names a third column: the exception text of a failed call, null otherwise.
    Requests are rendered twice: for their hashes, which are written, and for the calls. Only
    several batches need a written queue of prompts; hashes and queue go when the wave is
    written. ``pace`` bounds the calls per second of the whole wave and says what is tried again.
    """
    spark = requests.sparkSession
    if spark.conf.get("spark.speculation", "false") == "true":
        warnings.warn("spark.speculation is on: a slow task's calls are made twice", stacklevel=2)
    hashes, queue, found = new_path(spark, "hashes"), new_path(spark, "queue"), new_path(spark, "answers")
    every = requests.select(key, prompt_hash(F.col(prompt)).alias("prompt_hash"))
    every.write.parquet(hashes)
    every = spark.read.schema(every.schema).parquet(hashes)
    keyed, kept = every.where(F.col("prompt_hash").isNotNull()), None
    wanted = keyed.select("prompt_hash").distinct()
    if cache is not None:
        # The stored answers in use are fixed here, before this wave adds to the folder.
        kept = settle(
            cache.read(spark, model, wanted)
            .join(wanted, "prompt_hash", "left_semi")
            .groupBy("prompt_hash")
            .agg(F.min("response").alias("response")),
            "cached",
        )
        wanted = wanted.join(kept, "prompt_hash", "left_anti")
    n_todo = wanted.count()
    # Without a cache there is nothing that a batch's answers could enter.
    batches = max(1, -(-n_todo // calls_per_batch)) if cache is not None else 1
    per_batch = -(-n_todo // batches)
    tasks = max(1, -(-per_batch // calls_per_task), min(per_batch, spark.sparkContext.defaultParallelism))
    if batches > 1:
        todo = distinct_prompts(requests, prompt).drop("n").join(kept, "prompt_hash", "left_anti")
        # A hash decides the batch, so that a batch is one folder of the queue.
        batch = F.pmod(F.xxhash64("prompt_hash"), F.lit(batches)).cast("int")
        todo.withColumn("batch", batch).repartition("batch", F.pmod(F.hash("prompt_hash"), F.lit(64))).write.partitionBy(
            "batch"
        ).parquet(queue)
        waiting = spark.read.schema("prompt_hash string, prompt string, batch int").parquet(queue)
        parts = [waiting.where(F.col("batch") == b).repartition(tasks, "prompt_hash") for b in range(batches)]
    else:
        parts = [_each_once(requests, keyed, kept, key, prompt, keyed.count(), tasks)]
    columns = "prompt_hash string, response string, message string"
    for b, part in enumerate(parts):
        path = f"{found}/batch={b}"
        call_service(part, client, model, threads, pace, min(tasks, spark.sparkContext.defaultParallelism)).write.parquet(path)
        if cache is not None:
            cache.append(spark.read.schema(columns).parquet(path).where(F.col("message").isNull()), model)
    known = spark.read.schema(columns).parquet(found).select("prompt_hash", "response", "message")
    if kept is not None:
        known = known.unionByName(kept.withColumn("message", F.lit(None).cast("string")))

    out = salted_left_join(every, known, "prompt_hash", key, salts)
    wave = settle(
        out.select(key, F.col("response").alias(response), *([F.col("message").alias(failure)] if failure else [])),
        "wave",
    )
    for path in (hashes, queue, found):
        discard(spark, path)
    return wave
