"""CSV files read by ranges against the reader that reads a file in one task."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings, strategies as st

from sievewright.sources import csv_ranges, tables

CELLS = ["x", "", '""', '"a ""q"" b"', '"line\nbreak"', '"\n\n"', '"a,b"', '5" pipe', 'é"', '"end""\n"', "long " * 30, '"c,\n""d"""', '"cr\r\nlf"', " lead", '"tail" ']


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few lines, so that most records cross a border."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(folder, files):
    folder.mkdir()
    for name, (rows, end, last) in files.items():
        lines = [",".join(r) for r in rows]
        (folder / name).write_bytes((end.join(lines) + (end if last else "")).encode())
    return str(folder)


def in_order(df):
    return [tuple(r)[1:] for r in df.orderBy("__at").collect()]


@pytest.mark.parametrize("seed", [0, 1, 3])
def test_rows_and_order_equal_the_one_task_reader(spark, tmp_path, small_ranges, seed):
    rnd = random.Random(seed)
    rows = [[str(i), rnd.choice(CELLS), rnd.choice(CELLS), rnd.choice(CELLS)] for i in range(60)]
    end = "\r\n" if seed == 3 else "\n"
    path = written(tmp_path / "in", {"a.csv": ([["id", '"head\nline"', "b", "c"], *rows], end, seed % 2 == 0)})
    got = csv_ranges.read_ranges(spark, path, key="__at")
    want = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    assert got.columns[1:] == want.columns
    # Where cells hold bare line feeds, that reader leaves the carriage return in the last cell.
    expected = [(*r[:3], r[3].removesuffix("\r") or None if seed == 3 and r[3] else r[3]) for r in want.collect()]
    assert in_order(got) == expected
    assert [r[0] for r in got.select("__at").orderBy("__at").collect()] == list(range(60))


def test_many_tasks_read_one_file(spark, tmp_path, small_ranges):
    rows = [[str(i), f'"text {i}\nmore"'] for i in range(120)]
    path = written(tmp_path / "in", {"a.csv": ([["id", "t"], *rows], "\n", True)})
    lines = csv_ranges._lines(spark, sorted(spark.read.text(path).inputFiles()))
    assert lines.rdd.getNumPartitions() > 10
    assert lines.select("range").distinct().count() > 10
    assert csv_ranges.read_ranges(spark, path).count() == 120


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i}" for i in range(150))
    rows = [["1", "a"], ["2", f'"{long}"'], ["3", "b"], ["4", f'"{long}"']]
    path = written(tmp_path / "in", {"a.csv": ([["id", "t"], *rows], "\n", True)})
    assert in_order(csv_ranges.read_ranges(spark, path, key="__at")) == [("1", "a"), ("2", long), ("3", "b"), ("4", long)]


def test_files_blank_lines_marks_and_missing_cells(spark, tmp_path, small_ranges):
    folder = tmp_path / "in put"
    folder.mkdir()
    (folder / "b.csv").write_bytes("﻿\"h\n1\",b\n\n1,\"x\ny\"\n\n\n2\n3,z,extra\n".encode())
    (folder / "a.csv").write_bytes(b'h,b\n"0",\xff\xfe\n')
    (folder / "c.csv").write_bytes(b"h,b\n")
    (folder / "d.csv").write_bytes(b"")
    got = csv_ranges.read_ranges(spark, str(folder), key="__at").orderBy("__at").collect()
    assert [tuple(r)[1:] for r in got] == [("0", "��"), ("1", "x\ny"), ("2", None), ("3", "z")]
    assert [r["__at"] >> 33 for r in got] == [0, 1, 1, 1]


def test_types_of_a_given_schema(spark, tmp_path, small_ranges):
    from pyspark.sql.types import StructType

    path = written(tmp_path / "in", {"a.csv": ([["a", "b"], ["1", '"x\ny"'], ["oops", "2"]], "\n", True)})
    out = csv_ranges.read_ranges(spark, path, StructType.fromDDL("n int, t string"), key="__at")
    assert in_order(out) == [(1, "x\ny"), (None, "2")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*CELLS, '"open', 'a"b', '"x"y"', ",", "\n"]), max_size=30), st.integers(1, 40))
def test_chained_ranges_end_like_one_pass(cells, width):
    """Whatever the ranges, their functions chained give the state of one pass over all lines."""
    lines = ",".join(cells).split("\n")
    inside, states = False, []
    for line in lines:
        states.append(inside)
        inside = csv_ranges.inside_after(line, inside)
    chained = False
    for at in range(0, len(lines), width):
        assert chained == states[at]
        out = [False, True]
        for h in (0, 1):
            for line in lines[at : at + width]:
                out[h] = csv_ranges.inside_after(line, out[h])
        chained = out[chained]
    assert chained == inside


def test_groups_of_files_are_bounded():
    sizes = [("a", 10), ("b", 25), ("c", 0), ("d", 1000), ("e", 10)]
    assert csv_ranges.groups_of_files(sizes, 10, most=4) == [["a", "b"], ["c"], ["d"], ["e"]]


def test_landing_keeps_file_order_with_many_ranges(spark, tmp_path, small_ranges):
    rows = [[f'"n{i}\n"', "NA" if i % 2 else "v"] for i in range(80)]
    path = written(tmp_path / "in", {"a.csv": ([["Name", "Text → a"], *rows], "\n", True)})
    out = tables.land_csv(spark, path, str(tmp_path / "out"), {"Name": "name"})
    got = out.orderBy("candidate_id").collect()
    assert [r["name"] for r in got] == [f"n{i}\n" for i in range(80)]
    assert [r["Text → a"] for r in got[:4]] == ["v", None, "v", None]
