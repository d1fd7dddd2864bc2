from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from sievewright.sources import tables

TRICKY = [("1", 'said "hi",\nthen left', " lead"), ("2", "", "x"), ("3", None, "tail "), ("4", "NA", "é")]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, "id string, `Job → Text (a)?` string, `Notes ` string")
    path = str(tmp_path / "out")
    tables.write_csv(df.coalesce(1), path)
    raw = open(glob.glob(path + "/part*.csv")[0], "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfid,")
    back = tables.read_csv(spark, path)
    assert back.columns == df.columns
    assert [tuple(r) for r in back.orderBy("id").collect()] == [
        ("1", 'said "hi",\nthen left', " lead"), ("2", None, "x"), ("3", None, "tail "), ("4", None, "é"),
    ]


def test_read_with_schema_and_landing(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b\n1,"x\ny"\n2,null\n', encoding="utf-8-sig")
    df = tables.read_csv(spark, str(path), "a int, b string")
    landed = tables.land(df, str(tmp_path / "landed"))
    assert [tuple(r) for r in landed.orderBy("a").collect()] == [(1, "x\ny"), (2, None)]


def test_na_markers(column):
    values = [*tables.NA_MARKERS, " ", "na", "Nan", "ok"]
    assert column(values, tables.null_if_marker) == [None] * len(tables.NA_MARKERS) + [" ", "na", "Nan", "ok"]


def test_observed_count(spark):
    df, seen = tables.counted(spark.range(25).select(F.col("id").cast("string").alias("x")))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n_rows": 25}


def test_written_files_are_not_replaced(spark, tmp_path):
    df = spark.range(1)
    tables.write_parquet(df, str(tmp_path / "p"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_parquet(df, str(tmp_path / "p"))
    assert tables.read_parquet(spark, str(tmp_path / "p")).count() == 1


def test_landed_rows_get_a_key_in_file_order(spark, tmp_path):
    folder = tmp_path / "in put"
    folder.mkdir()
    (folder / "b.csv").write_text('Name,Text → a\nthird,"x\ny"\nfourth,z\n')
    # The longer file would be read first; its name comes second.
    (folder / "a.csv").write_text("Name,Text → a\nfirst,1\nsecond,2\n")
    (folder / "c.csv").write_text("Name,Text → a\n" + "".join(f"n{i},{'long ' * 20}\n" for i in range(50)))
    out = tables.land_csv(spark, str(folder), str(tmp_path / "out"), {"Text → a": "resume_text"})
    rows = out.orderBy("candidate_id").collect()
    assert out.columns == ["candidate_id", "Name", "resume_text"]
    assert [r["Name"] for r in rows] == ["first", "second", "third", "fourth", *[f"n{i}" for i in range(50)]]
    assert len({r["candidate_id"] for r in rows}) == 54 and rows[2]["resume_text"] == "x\ny"
    own = tables.land_csv(spark, str(folder), str(tmp_path / "own"), {"Name": "candidate_id"}, key_type="string")
    assert own.columns == ["candidate_id", "Text → a"] and own.where("candidate_id = 'third'").count() == 1
