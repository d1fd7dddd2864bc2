"""A stored table of points by key that is changed in place, a version at a time.

Rows lie in buckets by a hash of their key. A manifest lists the folders of every bucket; the highest numbered one is the table. A change writes new folders for the buckets
it touches and then one new manifest that names them next to the old folders of all other
buckets. Nothing that a manifest names is ever rewritten, so a run that stops half way
leaves the last version as it was, readers of an old version are not disturbed, and two
writers can't both make the same version: the second one's manifest already exists.

The folder may be on any file system Spark can write. A manifest is one line per bucket and
appears under its name complete, by a rename.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BUCKETS = 64
#: Tasks, and files, that write one bucket.
PARTS = 4
MANIFESTS, DATA = "manifests", "data"


class VersionConflict(RuntimeError):
    """Another writer has made the version that this change was going to be."""


@dataclass(frozen=True)
class Version:
    number: int
    key: str
    buckets: int
    schema: T.StructType
    folders: dict[int, list[str]]


class StoredTable:
    """One table under ``path``; ``create`` makes it, ``upsert`` and ``delete`` change it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- manifests ---------------------------------------------------------------

    def versions(self) -> list[int]:
        folder = self._path(f"{self.path}/{MANIFESTS}")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def version(self, number: int | None = None) -> Version:
        known = self.versions()
        if not known or number is not None and number not in known:
            raise FileNotFoundError(f"no version {'' if number is None else number} of {self.path}")
        number = known[-1] if number is None else number
        stream = self._files.open(self._path(f"{self.path}/{MANIFESTS}/{number:012d}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        said = json.loads(text)
        folders = {int(b): f for b, f in said["folders"].items()}
        return Version(number, said["key"], said["buckets"], T.StructType.fromJson(said["schema"]), folders)

    def _commit(self, version: Version) -> None:
        text = json.dumps(
            {"key": version.key, "buckets": version.buckets, "schema": version.schema.jsonValue(), "folders": version.folders}
        )
        final = self._path(f"{self.path}/{MANIFESTS}/{version.number:012d}")
        draft = self._path(f"{self.path}/{MANIFESTS}/.draft-{uuid.uuid4().hex}")
        stream = self._files.create(draft)
        stream.write(text.encode())
        stream.close()
        if self._files.exists(final) or not self._files.rename(draft, final):
            self._files.delete(draft, False)
            raise VersionConflict(f"version {version.number} of {self.path} exists")

    # -- reading -----------------------------------------------------------------

    def read(self, number: int | None = None) -> DataFrame:
        """The table as of a version, by default the last."""
        version = self.version(number)
        return self._read(version, list(version.folders))

    def _read(self, version: Version, buckets: list[int]) -> DataFrame:
        folders = sorted(f"{self.path}/{DATA}/{f}" for b in buckets for f in version.folders.get(b, []))
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*folders)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows whose key is in ``keys`` (one column); only their buckets are read."""
        version = self.version()
        asked = keys.select(F.col(keys.columns[0]).cast(version.schema[version.key].dataType).alias(version.key)).distinct()
        hit = self._touched(asked, version)
        return self._read(version, hit).join(asked, version.key, "left_semi")

    # -- writing -----------------------------------------------------------------

    def create(self, rows: DataFrame, key: str, buckets: int = BUCKETS, version: str | None = None) -> Version:
        """Version 0. Of rows that repeat a key the highest ``version`` stays."""
        kept = _latest(rows, key, version) if version else rows
        made = Version(0, key, buckets, _nullable(rows.schema), self._write(kept, key, buckets))
        self._commit(made)
        return made

    def upsert(self, updates: DataFrame, version_col: str) -> Version:
        """Add rows and replace those whose key is stored with a lower ``version_col``.

        Updates may repeat keys. Only buckets with an update are read and written. A change
        without rows makes no version.
        """
        now = self.version()
        updates = updates.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in now.schema])
        hit = self._touched(updates, now)
        if not hit:
            return now
        return self._replace(now, hit, _latest(self._read(now, hit).unionByName(updates), now.key, version_col))

    def delete(self, keys: DataFrame) -> Version:
        """Remove the rows whose key is in ``keys`` (one column)."""
        now = self.version()
        gone = keys.select(F.col(keys.columns[0]).cast(now.schema[now.key].dataType).alias(now.key)).distinct()
        hit = [b for b in self._touched(gone, now) if b in now.folders]
        return self._replace(now, hit, self._read(now, hit).join(gone, now.key, "left_anti")) if hit else now

    def append(self, rows: DataFrame) -> Version:
        """Add rows without looking at the stored ones; keys may then repeat until
        :meth:`compact`. Folders of the buckets that get rows are added to their lists."""
        now = self.version()
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in now.schema])
        written = self._write(rows, now.key, now.buckets)
        if not written:
            return now
        folders = {b: now.folders.get(b, []) + written.get(b, []) for b in {*now.folders, *written}}
        made = Version(now.number + 1, now.key, now.buckets, now.schema, folders)
        self._commit(made)
        return made

    def compact(self, most: int = 1) -> Version:
        """Rewrite the buckets of more than ``most`` folders as one folder with one row per
        key: of rows that repeat a key the smallest stays. Until the new manifest is there
        the table is as before."""
        now = self.version()
        hit = [b for b, held in now.folders.items() if len(held) > most]
        if not hit:
            return now
        rest = [f"`{f.name}`" for f in now.schema if f.name != now.key]
        least = self._read(now, hit).groupBy(f"`{now.key}`").agg(F.min(F.struct(*rest)).alias("__r"))
        return self._replace(now, hit, least.select(f"`{now.key}`", "__r.*").select(*[f"`{f.name}`" for f in now.schema]))

    def _replace(self, now: Version, hit: list[int], rows: DataFrame) -> Version:
        written = self._write(rows, now.key, now.buckets)
        kept = {b: f for b, f in now.folders.items() if b not in hit}
        made = Version(now.number + 1, now.key, now.buckets, now.schema, kept | written)
        self._commit(made)
        return made

    def _write(self, rows: DataFrame, key: str, buckets: int) -> dict[int, list[str]]:
        """New folders for the buckets that have rows, ``PARTS`` files each, so that a large
        bucket is not one task and a change does not leave a file per task and bucket."""
        change = uuid.uuid4().hex
        part = F.pmod(F.hash(F.col(f"`{key}`")), F.lit(PARTS))
        dealt = rows.withColumn("__bucket", bucket(F.col(f"`{key}`"), buckets)).repartition("__bucket", part)
        dealt.write.partitionBy("__bucket").parquet(f"{self.path}/{DATA}/{change}")
        folder = self._path(f"{self.path}/{DATA}/{change}")
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return {int(n.split("=")[1]): [f"{change}/{n}"] for n in names if n.startswith("__bucket=")}

    def _touched(self, rows: DataFrame, version: Version) -> list[int]:
        """Buckets with a row: at most as many as the table has."""
        found = rows.select(bucket(F.col(f"`{version.key}`"), version.buckets).alias("b")).distinct().collect()
        return sorted(r["b"] for r in found)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete old manifests beyond the last ``keep`` and the folders that none of the kept
        ones names. No change may be under way."""
        known = self.versions()
        for number in known[:-keep] if keep else known[:-1]:
            self._files.delete(self._path(f"{self.path}/{MANIFESTS}/{number:012d}"), False)
        named = {f for n in self.versions() for held in self.version(n).folders.values() for f in held}
        gone = []
        root = self._path(f"{self.path}/{DATA}")
        for change in self._files.listStatus(root):
            held = [f"{change.getPath().getName()}/{s.getPath().getName()}" for s in self._files.listStatus(change.getPath())]
            if not any(h in named for h in held):
                self._files.delete(change.getPath(), True)
                gone.append(change.getPath().getName())
                continue
            for h in held:
                if "__bucket=" in h and h not in named:
                    self._files.delete(self._path(f"{self.path}/{DATA}/{h}"), True)
                    gone.append(h)
        return gone


def bucket(key: Column, buckets: int) -> Column:
    """A null key has a bucket too."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def _latest(rows: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key: the one with the highest ``version``, which combines in each task."""
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in (key, version)]
    held = F.struct(F.col(f"`{version}`"), *rest)
    newest = rows.groupBy(F.col(f"`{key}`")).agg(F.max_by(held, F.col(f"`{version}`")).alias("__r"))
    return newest.select(f"`{key}`", "__r.*").select(*[f"`{c}`" for c in rows.columns])
