"""CSV files with line breaks in cells, read by many tasks each.

A reader that starts inside a file can't tell a line break in a cell from one between
records. So the lines of every byte range are read twice. The first pass finds, for each
range, what it does to a reader that enters outside a cell in quotes and to one that enters
inside: where either comes out, and how many records it has begun. These functions are
chained over the ranges of a file, which gives every range the state it is entered in and
the number of its first record. The second pass then emits whole records; only a record that
crosses the border of a range is put together by a shuffle, from one piece per range.

Cells in quotes hold doubled quotes, line breaks and delimiters. A quote inside an unquoted
cell is text; text behind a closing quote runs to the next delimiter. Lines end in ``\\n`` or
``\\r\\n``; empty lines between records are skipped.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import settle

BOM = "﻿"
#: Rows of one file number their records below this.
PER_FILE = 1 << 33
#: Ranges whose states are held by every task at once: a row of 30 bytes for each.
RANGES_AT_ONCE = 200_000


def inside_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a reader is inside a cell in quotes behind ``line``, if it came ``inside``."""
    at = 0
    if not inside:
        if line.startswith('"'):
            at = 1
        else:
            at = line.find(sep + '"')
            if at < 0:
                return False
            at += len(sep) + 1
    while True:
        at = line.find('"', at)
        while at >= 0 and line.startswith('"', at + 1):
            at = line.find('"', at + 2)
        if at < 0:
            return True
        # The cell is closed; what follows it belongs to it up to the next delimiter.
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        if not line.startswith(sep + '"', at):
            at = line.find(sep + '"', at)
            if at < 0:
                return False
        at += len(sep) + 1


def _as_path(spark: SparkSession, uri: str) -> str:
    """The path of an input file's name, which is a URI, with pattern characters escaped."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(uri)).toString()
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """``file, range, line`` of all files, in order within a range."""
    numbers = spark.createDataFrame(list(enumerate(files)), "file int, __path string")
    text = spark.read.option("lineSep", "\n").text([_as_path(spark, f) for f in files])
    placed = text.select(
        F.expr("make_valid_utf8(value)").alias("line"),
        F.input_file_name().alias("__path"),
        F.input_file_block_start().alias("range"),
    )
    return placed.join(F.broadcast(numbers), "__path").select("file", "range", "line")


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch, list[str], np.ndarray, np.ndarray]]:
    """Batches cut at the borders of ranges: place, rows, lines, which of them have a
    quote, and how many lines up to each are not empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, begin = (batch.column(c).to_numpy() for c in ("file", "range"))
        edges = np.flatnonzero((np.diff(file) != 0) | (np.diff(begin) != 0)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            part = batch.slice(a, b - a)
            column = part.column("line")
            quoted = pc.match_substring(column, '"').to_numpy(zero_copy_only=False)
            empty = pc.is_in(column, value_set=pa.array(["", "\r"], column.type)).to_numpy(zero_copy_only=False)
            yield (int(file[a]), int(begin[a])), part, column.to_pylist(), quoted, np.concatenate([[0], np.cumsum(~empty)])


def _without_mark(lines: list[str], first: bool) -> list[str]:
    return [lines[0].removeprefix(BOM), *lines[1:]] if first and lines[0].startswith(BOM) else lines


SUMMARY = "file int, range long, out0 boolean, out1 boolean, begun0 long, begun1 long"


def _summarise(sep: str):
    """Per range: the state behind it and the records begun in it, for either state before."""

    def task(batches):
        now, inside, begun = None, [False, True], [0, 0]
        done: list[tuple] = []
        for place, _, lines, quoted, filled in _ranges(batches):
            if place != now:
                if now is not None:
                    done.append((*now, *inside, *begun))
                now, inside, begun = place, [False, True], [0, 0]
                lines = _without_mark(lines, place[1] == 0)
            for h in (0, 1):
                at = 0
                for i in np.flatnonzero(quoted).tolist():
                    if not inside[h]:
                        begun[h] += int(filled[i + 1] - filled[at])
                    inside[h] = inside_after(lines[i], inside[h], sep)
                    at = i + 1
                if not inside[h]:
                    begun[h] += int(filled[-1] - filled[at])
        if now is not None:
            done.append((*now, *inside, *begun))
        names = ("file", "range", "out0", "out1", "begun0", "begun1")
        types = (pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(types)], names=names)

    return task


def entered(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state each range of a file is entered in, and the number of its first record."""
    ranges = ranges.sort_values("range")
    inside, begun, states, firsts = False, 0, [], []
    for out0, out1, n0, n1 in zip(ranges["out0"], ranges["out1"], ranges["begun0"], ranges["begun1"]):
        states.append(inside)
        firsts.append(begun)
        begun += int(n1 if inside else n0)
        inside = bool(out1 if inside else out0)
    return pd.DataFrame({"file": ranges["file"], "range": ranges["range"], "inside": states, "first": firsts})


RECORDS = "file int, number long, piece long, record string"


def _emit(sep: str):
    """Whole records (``piece`` null), and the pieces of those that cross a border."""

    def task(batches):
        now, inside, number, held, crossed = None, False, 0, [], False
        out: list[tuple] = []

        def flush(place):
            """The open record at the end of a range."""
            if held:
                out.append((place[0], number - 1, place[1], "\n".join(held)))
                held.clear()

        def batch_of():
            types = (pa.int32(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["file", "number", "piece", "record"])

        for place, part, lines, quoted, _ in _ranges(batches):
            if place != now:
                if now is not None:
                    flush(now)
                now, inside, number = place, part.column("inside")[0].as_py(), part.column("first")[0].as_py()
                crossed = inside
                lines = _without_mark(lines, place[1] == 0)
            for line, has_quote in zip(lines, quoted.tolist()):
                if not inside:
                    if line in ("", "\r"):
                        continue
                    number += 1
                    if not has_quote:
                        out.append((place[0], number - 1, None, line))
                        continue
                held.append(line)
                if has_quote:
                    inside = inside_after(line, inside, sep)
                if not inside:
                    out.append((place[0], number - 1, place[1] if crossed else None, "\n".join(held)))
                    held.clear()
                    crossed = False
            if len(out) > 5_000:
                yield batch_of()
        if now is not None:
            flush(now)
        yield batch_of()

    return task


def records(spark: SparkSession, files: list[str], sep: str = ",") -> DataFrame:
    """``file, number, record``: every record of the files as one text, headings included,
    numbered from 0 within its file, as a written table."""
    lines = _lines(spark, files)
    summary = settle(lines.mapInArrow(_summarise(sep), SUMMARY), "csv-ranges")
    states = summary.groupBy("file").applyInPandas(entered, "file int, range long, inside boolean, first long")
    states = settle(states, "csv-states")
    placed = lines.join(F.broadcast(states), ["file", "range"])
    found = settle(placed.mapInArrow(_emit(sep), RECORDS), "csv-records")
    ordered = F.array_sort(F.collect_list(F.struct("piece", "record")))
    joined = (
        found.where("piece is not null").groupBy("file", "number").agg(F.array_join(F.transform(ordered, lambda x: x.record), "\n").alias("record"))
    )
    return found.where("piece is null").select("file", "number", "record").unionByName(joined)


def groups_of_files(sizes: list[tuple[str, int]], range_bytes: int, most: int = RANGES_AT_ONCE) -> list[list[str]]:
    """Files in order, in groups of at most ``most`` ranges unless one file alone has more."""
    groups: list[list[str]] = []
    held = 0
    for path, size in sizes:
        n = max(1, -(-size // range_bytes))
        if not groups or held + n > most:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += n
    return groups


def file_sizes(spark: SparkSession, files: list[str]) -> list[tuple[str, int]]:
    conf = spark._jsc.hadoopConfiguration()
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(f)) for f in files]
    return [(f, p.getFileSystem(conf).getFileStatus(p).getLen()) for f, p in zip(files, paths)]


def parsed(rows: DataFrame, names: list[str], keep: list[str], schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """``keep`` and the cells of the column ``record`` under the given names, read as Spark's
    CSV reader reads them."""
    kinds = [f.dataType.simpleString() for f in schema] if schema else ["string"] * len(names)
    ddl = ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))
    options = {"quote": '"', "escape": '"', "multiLine": "true", "sep": sep}
    cells = rows.withColumn("__cells", F.from_csv(F.regexp_replace("record", r"\r\z", ""), ddl, options))
    return cells.select(*keep, *[F.col(f"__cells.c{i}").alias(name) for i, name in enumerate(names)])


def read_ranges(spark: SparkSession, path: str, schema: T.StructType | None = None, key: str | None = None, sep: str = ",") -> DataFrame:
    """The rows of CSV files with a heading each, whatever their cells hold, every file read
    by as many tasks as it has ranges of ``spark.sql.files.maxPartitionBytes``.

    ``key`` names an added first column: the number of the file, by name, and the place of
    the row in it. Files that are compressed whole are one range each.
    """
    names, files = headings_of(spark, path, sep), sorted(spark.read.text(path).inputFiles())
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    range_bytes = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size))
    out, before = None, 0
    for group in groups_of_files(file_sizes(spark, files), range_bytes):
        found = records(spark, group, sep).where("number > 0")
        place = (F.col("file") + before) * F.lit(PER_FILE) + F.col("number") - 1
        numbered = found.select("record", *([place.alias("__key")] if key else []))
        rows = parsed(numbered, [f.name for f in schema] if schema else names, ["__key"] if key else [], schema, sep)
        out = rows if out is None else out.unionByName(rows)
        before += len(group)
    return out.withColumnRenamed("__key", key) if key else out


def headings_of(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The headings; only the first record of a file is read for them."""
    reader = spark.read.option("header", True).option("multiLine", True).option("sep", sep)
    return reader.option("quote", '"').option("escape", '"').csv(path).columns
