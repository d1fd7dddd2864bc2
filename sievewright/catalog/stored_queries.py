"""Queries over stored structures: split files, versions, indexes, state, sketches and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import labels as lab
from ..operators import cells, similarity as sim, sketches, split as sp
from ..session import new_path
from ..sources import csv_ranges, tables
from ..sources.candidates import candidates, table
from ..sources.stored import StoredTable
from ..streaming.dedup import dedup_stream, run_to_end

KEY = "candidate_id"
QUANTILES = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


def csv_split_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Résumés with line breaks and quotes, written in order and read back by byte ranges;
    ``in_order`` says that a row's key is above that of the row written before it."""
    path = new_path(spark, "csv")
    rows = candidates(spark, sf, "resume_text", "verdict")
    tables.write_csv(rows.repartitionByRange(KEY).sortWithinPartitions(KEY), path)
    back = tables.na_to_null(csv_ranges.read_ranges(spark, path, key="place"))
    in_file = Window.partitionBy(F.shiftright("place", 33)).orderBy("place")
    before = F.lag(F.col(KEY).cast("bigint")).over(in_file)
    return back.select(
        F.col(KEY).cast("bigint").alias(KEY),
        F.md5("resume_text").alias("resume_md5"),
        "verdict",
        F.coalesce(before < F.col(KEY).cast("bigint"), F.lit(True)).alias("in_order"),
    )


def _points(spark: SparkSession, sf: str) -> StoredTable:
    """The vectors with their label as payload, as a stored table."""
    points = StoredTable(spark, new_path(spark, "points"))
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.lit(0).cast("bigint").alias("version"), F.col("label").cast("string").alias("payload")
    )
    points.create(rows, "id")
    return points


def stored_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two changes to a stored table; the later events come first."""
    points = _points(spark, sf)
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), (F.col("event_id") + 1).alias("version"), F.col("event_type").alias("payload")
    )
    points.upsert(events.where("version % 2 = 0"), "version")
    points.upsert(events.where("version % 2 = 1"), "version")
    return points.read()


def stored_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each version of a table that is changed and then loses rows."""
    points = _points(spark, sf)
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), (F.col("event_id") + 1).alias("version"), F.col("event_type").alias("payload")
    )
    points.upsert(events, "version")
    points.delete(table(spark, sf, "embeddings").where("vec_id % 10 = 0").select("vec_id"))
    counted = [
        points.read(n).agg(F.lit(n).cast("bigint").alias("number"), F.count(F.lit(1)).alias("n"), F.sum("version").alias("versions"))
        for n in points.versions()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def _cells(spark: SparkSession, sf: str) -> cells.CellIndex:
    stored = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row"), F.col("embedding").cast("array<double>").alias("v"), F.array().cast("array<long>").alias("terms")
    )
    return cells.CellIndex.build(stored)


def _as_query(rows: DataFrame, score: str) -> DataFrame:
    return rows.select(
        F.col("query").alias("query_id"), F.col("row").alias("vec_id"), F.round("score", 6).alias(score), F.col("rank").cast("bigint").alias("rank")
    )


def knn_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors closest to the mean of each label, by the cell index."""
    means = sim.centroids(table(spark, sf, "embeddings"), "label")
    return _as_query(_cells(spark, sf).topk(means, 10).rows, "similarity")


def knn_retrieval(spark: SparkSession, sf: str) -> DataFrame:
    """Past cases like a case: every 25th vector against all."""
    vectors = table(spark, sf, "embeddings")
    asked = vectors.where("vec_id % 25 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return _as_query(_cells(spark, sf).topk(asked, 5).rows, "similarity")


def search_work(spark: SparkSession, sf: str) -> DataFrame:
    """Per query the rows stored, and that it never looks at more rows than two rounds can name."""
    vectors = table(spark, sf, "embeddings")
    asked = vectors.where("vec_id % 25 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    work = _cells(spark, sf).topk(asked, 5).work
    return work.select(F.col("query").alias("query_id"), "stored", (F.col("looked") <= F.col("stored")).alias("within"))


def hybrid_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """As ``hybrid_topk``, by postings and cells."""
    corpus = table(spark, sf, "embeddings")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    index = cells.HybridIndex.build(corpus, docs)
    return _as_query(index.topk(sim.centroids(corpus, "label"), asked, 10).rows, "score")


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Applications that arrive in three batches; a résumé seen in an earlier one stays out."""
    folder, out, state = (new_path(spark, name) for name in ("arriving", "arrived", "state"))
    rows = candidates(spark, sf, "resume_url", "company")
    third = F.pmod(F.xxhash64(F.col(KEY)), F.lit(3))
    for i in range(3):  # each arrival is a run of its own, from the state of the one before
        rows.where(third == i).write.parquet(f"{folder}/{i}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/*")
        writer = dedup_stream(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        run_to_end(spark, writer)
    kept = spark.read.schema(rows.schema).parquet(out)
    # Which row came first depends on the batches; every address is there once.
    return kept.groupBy("resume_url").agg(F.count(F.lit(1)).alias("n"))


def cv_folds_exact(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "verdict", "result_llm")
    df = df.select(KEY, lab.clean_label(lab.map_reject(F.col("verdict"), F.col("result_llm"))).alias("verdict_clean"))
    return sp.exact_folds(df, KEY, "verdict_clean", 5).select(KEY, "verdict_clean", F.col("fold").cast("bigint").alias("fold"))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    return sketches.sketch(days, "day", "value")


def quantile_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of each month from the stored sketches of its days."""
    path = new_path(spark, "sketches")
    _daily(spark, sf).write.parquet(path)
    months = sketches.merge(spark.read.parquet(path), period=F.left("period", F.lit(7)))
    return sketches.quantiles(months, QUANTILES).select("period", "q", F.round("value", 6).alias("value"))


def quantile_error(spark: SparkSession, sf: str) -> DataFrame:
    """How far the sketched quantiles are from the exact ones, relative to these."""
    months = sketches.merge(_daily(spark, sf), period=F.left("period", F.lit(7)))
    rows = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM").alias("period"), "value")
    exact = rows.groupBy("period").agg(*[
        F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY value)").alias(f"q{i}") for i, q in enumerate(QUANTILES)
    ])
    pairs = exact.select("period", F.explode(F.array(*[
        F.struct(F.lit(q).alias("q"), F.col(f"q{i}").alias("exact")) for i, q in enumerate(QUANTILES)
    ])).alias("p")).select("period", "p.*")
    met = pairs.join(sketches.quantiles(months, QUANTILES), ["period", "q"])
    off = F.abs(F.col("value") - F.col("exact")) <= sketches.ERROR * F.col("exact") + 1e-9
    return met.select("period", "q", F.round("exact", 6).alias("exact"), off.alias("within"))


def sketch_drift(spark: SparkSession, sf: str) -> DataFrame:
    return sketches.drift(_daily(spark, sf)).select("period", "n", F.round("psi", 6).alias("psi"))


QUERIES = {
    f.__name__: f
    for f in (
        csv_split_scan, stored_upsert, stored_versions, knn_indexed, knn_retrieval, search_work, hybrid_indexed, stream_dedup,
        cv_folds_exact, quantile_sketch, quantile_error, sketch_drift,
    )
}
