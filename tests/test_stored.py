"""The stored table: versions, touched buckets, stopped runs, two writers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from sievewright.sources.stored import StoredTable, VersionConflict

SCHEMA = "id long, version long, payload string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def data_files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path / "data") for f in fs if f.endswith(".parquet")}


@pytest.fixture
def stored(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"))
    table.create(spark.range(100).select("id", F.lit(0).cast("long").alias("version"), F.col("id").cast("string").alias("payload")), "id", 8)
    return table


def change(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_upsert_keeps_the_highest_version_and_old_versions_readable(spark, stored):
    stored.upsert(change(spark, (1, 2, "b"), (1, 5, "e"), (1, 3, "c"), (200, 1, "new"), (2, -1, "stale"), (None, 1, "null id")), "version")
    got = {r["id"]: (r["version"], r["payload"]) for r in stored.read().collect()}
    assert len(got) == 102 and got[1] == (5, "e") and got[2] == (0, "2") and got[200] == (1, "new") and got[None] == (1, "null id")
    assert stored.versions() == [0, 1] and stored.read(0).count() == 100
    assert {r["payload"] for r in stored.read(0).where("id = 1").collect()} == {"1"}


def test_untouched_files_keep_their_names(spark, stored, tmp_path):
    before, folders = data_files(tmp_path / "t"), stored.version().folders
    after = stored.upsert(change(spark, (1, 2, "b")), "version").folders
    assert data_files(tmp_path / "t") >= before
    assert sum(folders[b] != after[b] for b in folders) == 1
    # The new folder holds one bucket's rows, not the table's.
    new = [f for b, held in after.items() if held != folders[b] for f in held]
    assert spark.read.parquet(f"{stored.path}/data/{new[0]}").count() < 40


def test_a_run_stopped_before_its_manifest_changes_nothing(spark, stored, monkeypatch):
    want = rows_of(stored.read())

    def stop(version):
        raise KeyboardInterrupt

    monkeypatch.setattr(stored, "_commit", stop)
    with pytest.raises(KeyboardInterrupt):
        stored.upsert(change(spark, (1, 9, "lost"), (300, 1, "lost")), "version")
    again = StoredTable(spark, stored.path)
    assert again.versions() == [0] and rows_of(again.read()) == want
    again.upsert(change(spark, (1, 9, "kept")), "version")
    assert {r["payload"] for r in again.read().where("id = 1").collect()} == {"kept"}
    # What the stopped run wrote goes with a vacuum, the table stays.
    now = rows_of(again.read())
    assert again.vacuum(keep=1) and rows_of(again.read()) == now and again.versions() == [1]


def test_two_writers_cannot_make_one_version(spark, stored, monkeypatch):
    other = StoredTable(spark, stored.path)
    late = other.version()
    stored.upsert(change(spark, (1, 2, "first")), "version")
    monkeypatch.setattr(other, "version", lambda number=None: late)
    with pytest.raises(VersionConflict):
        other.upsert(change(spark, (1, 3, "second")), "version")
    assert {r["payload"] for r in stored.read().where("id = 1").collect()} == {"first"}
    assert not [f for f in os.listdir(f"{stored.path}/manifests") if f.startswith(".draft") and not f.endswith(".crc")]


def test_delete_lookup_and_changes_without_rows(spark, stored):
    assert stored.upsert(change(spark), "version").number == 0
    assert stored.delete(spark.createDataFrame([(1000,)], "k long")).number in (0, 1)
    stored.delete(spark.createDataFrame([(1,), (2,), (2,)], "k long"))
    assert stored.read().count() == 98
    found = stored.lookup(spark.createDataFrame([(2,), (3,), (4,)], "k int"))
    assert {r["id"] for r in found.collect()} == {3, 4}
    assert len(found.inputFiles()) < len(stored.read().inputFiles())


def test_an_emptied_table_takes_rows_again(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "e"))
    table.create(change(spark), "id", 4)
    assert table.read().columns == ["id", "version", "payload"] and table.read().isEmpty()
    table.upsert(change(spark, (1, 1, "a")), "version")
    table.delete(spark.createDataFrame([(1,)], "k long"))
    assert table.read().isEmpty()
    table.upsert(change(spark, (1, 2, None)), "version")
    assert rows_of(table.read()) == [(1, 2, None)]


def test_create_drops_older_repeats_and_needs_a_fresh_path(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "c"))
    table.create(change(spark, (1, 1, "old"), (1, 2, "new")), "id", 2, version="version")
    assert rows_of(table.read()) == [(1, 2, "new")]
    with pytest.raises(VersionConflict):
        table.create(change(spark, (5, 1, "x")), "id")
    with pytest.raises(FileNotFoundError):
        table.read(7)


def test_appended_folders_are_compacted_and_a_stopped_compaction_loses_nothing(spark, stored, monkeypatch):
    before = stored.version().folders
    stored.append(change(spark, (1, 7, "more"), (500, 1, "x")))
    stored.append(change(spark, (1, 7, "more")))
    assert stored.read().count() == 103 and stored.append(change(spark)).number == 2
    assert all(stored.version().folders[b][: len(held)] == held for b, held in before.items())
    want = rows_of(stored.read())
    commit = stored._commit
    monkeypatch.setattr(stored, "_commit", lambda version: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        stored.compact()
    assert rows_of(StoredTable(spark, stored.path).read()) == want
    monkeypatch.setattr(stored, "_commit", commit)
    after = stored.compact()
    assert all(len(held) == 1 for held in after.folders.values()) and stored.read().count() == 101
    assert stored.compact().number == after.number


def test_a_wave_reads_only_the_buckets_that_hold_its_prompts(spark, tmp_path):
    from sievewright.catalog import stub
    from sievewright.operators.inference import StoredCache, run_wave

    cache = StoredCache(str(tmp_path / "cache"), buckets=16)
    asks = lambda *texts: spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "candidate_id long, prompt string")
    client = stub.StubClient(refuse=False)
    first = run_wave(asks(*[f"p{i}" for i in range(60)]), client, "m", cache=cache)
    asked = asks("p3", "p7", "new")
    from pyspark.sql import functions as f

    wanted = asked.select(f.sha2("prompt", 256).alias("prompt_hash"))
    every = cache.table(spark, "m").read().inputFiles()
    found = cache.read(spark, "m", wanted)
    assert len(found.inputFiles()) < len(every) / 2 and found.count() == 2
    again = run_wave(asked, stub.StubClient(tag="other", refuse=False), "m", cache=cache)
    told = {r["candidate_id"]: r["response"] for r in again.collect()}
    old = {r["candidate_id"]: r["response"] for r in first.collect()}
    assert told[0] == old[3] and told[1] == old[7] and "other" in told[2]
    cache.compact(spark, "m")
    assert cache.read(spark, "m").count() == 61 and cache.read(spark, "unknown").isEmpty()
