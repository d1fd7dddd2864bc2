"""The ``candidates`` view over the TPC-H-like test tables.

Columns are assembled on demand: a caller that names three columns gets only the
joins those need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

URL_PREFIX = "https://cv.example.com/"
PHONE_PATTERN = r"\+?\d[\d ().-]{8,}\d"


# Stated so that opening a table needs no job to read a footer.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def candidates(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``candidate_id`` and the named columns."""
    wanted = list(dict.fromkeys(columns))
    doc_id = F.col("doc_id")
    own: dict[str, Column] = {
        "company": F.col("source"),
        "criteria": F.col("lang"),
        "resume_text": F.when(
            doc_id % 5 == 0,
            F.concat("text", F.lit(" https://www.linkedin.com/in/u-"), doc_id.cast("string")),
        ).otherwise(F.col("text")),
        "resume_url": F.concat(F.lit(URL_PREFIX), F.md5("text")),
        "phone": F.nullif(F.regexp_extract("text", PHONE_PATTERN, 0), F.lit("")),
        "result_llm": F.get(
            F.array(*[F.lit(x) for x in ("reject ", "Advanced", "manual intervention", "Error: 403 denied")]),
            (doc_id % 4).cast("int"),
        ),
    }
    docs = table(spark, sf_dir, "documents")
    needs_text = {"resume_text", "resume_url", "phone"} & set(wanted)
    used = ["doc_id"] + (["text"] if needs_text else [])
    used += [c for c, by in (("source", "company"), ("lang", "criteria")) if by in wanted]
    docs = docs.select(*used)
    out = docs.select(
        doc_id.alias("candidate_id"), *[own[c].alias(c) for c in wanted if c in own]
    )
    for build, provides in (
        (_names, {"name"}),
        (_verdicts, {"verdict"}),
        (_interviews, {"transcript", "duration"}),
    ):
        hit = [c for c in wanted if c in provides]
        if hit:
            out = out.join(build(spark, sf_dir).select("candidate_id", *hit), "candidate_id", "left")
    if "job_desc" in wanted:
        out = _with_job(spark, sf_dir, out)
    return out.select("candidate_id", *wanted)


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("candidate_id"), F.col("c_name").alias("name")
    )


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id = F.col("doc_id")
    spelled = (
        F.when(F.col("toxic") == 1, " Reject")
        .when(F.col("quality") == 1, "YES")
        .when(doc_id % 2 == 0, "may be")
        .otherwise("manual")
    )
    return table(spark, sf_dir, "labels").select(doc_id.alias("candidate_id"), spelled.alias("verdict"))


def _interviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole page of the same number as the transcript, and its length as the talk's.

    ``pages`` holds one whole text per key, so nothing is cut and no rows are gathered.
    """
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("candidate_id"),
        F.col("html").alias("transcript"),
        F.length("html").cast("long").alias("duration"),
    )


def _with_job(spark: SparkSession, sf_dir: str, out: DataFrame) -> DataFrame:
    """Role title by part key, description by turns from the benchmark texts; every
    17th candidate has none."""
    roles = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("candidate_id"), "p_name")
    texts = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("__item"), F.col("text").alias("__about"))
    n_texts = texts.agg(F.count(F.lit(1))).scalar()
    cid = F.col("candidate_id")
    job = F.concat(F.lit("Role Title: "), F.coalesce("p_name", F.lit("")), F.lit("\n"), "__about")
    return (
        out.withColumn("__item", cid % n_texts)
        .join(roles, "candidate_id", "left")
        .join(texts, "__item", "left")
        .withColumn("job_desc", F.when(cid % 17 != 0, job))
        .drop("__item", "__about", "p_name")
    )
