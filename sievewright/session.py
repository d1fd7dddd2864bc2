"""Session helpers: settings, the shared working folder, shipping the package."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Folders of local sessions that name none; the setting itself is fixed once a session runs.
_own_dirs: dict[str, str] = {}


def local_session(app: str = "sievewright", cpus: int | str = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks.

    On a cluster the caller brings its own session; nothing in the library
    depends on the settings below except the UTC time zone.
    """
    n = str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", n if n.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A machine-local temporary folder is used only by a local session that names
    none; a cluster session without one is an error, since a written table there
    would be unreadable from the other machines.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="run-")
    return _own_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the files.

    Used where recomputing is not acceptable: answers of a billed service must
    never be asked for again because an executor was lost.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a short-lived table that go into one file.
ROWS_PER_FILE = 20_000


def written(df: DataFrame, rows: int, name: str) -> DataFrame:
    """As :func:`settle`, for a table of about ``rows`` rows: a few rows for each shuffle
    partition would else make a file each, which costs more than the rows do."""
    return settle(df.coalesce(rows // ROWS_PER_FILE + 1), name)


def settle_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """As :func:`settle`, in buckets by ``key``, as many as a shuffle has partitions.

    Joins with the table on ``key`` bring the other side to the buckets, so that its own rows
    are not shuffled again. Spark keeps the buckets' number in its catalog only; the entry
    goes once the table is open, the files stay.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, name)
    entry = f"t_{uuid.uuid4().hex}"
    writer = df.repartition(n, F.col(f"`{key}`")).write.format("parquet").bucketBy(n, key)
    writer.option("path", path).saveAsTable(entry)
    try:
        return spark.table(entry)
    finally:
        spark.sql(f"DROP TABLE {entry}")


def discard(spark: SparkSession, path: str) -> None:
    """Remove one table that :func:`new_path` named, once nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship_package() -> None:
    """Send the library's task code by value, so that a plain checkout works on
    executors that have not installed it."""
    import sievewright

    cloudpickle.register_pickle_by_value(sievewright)
