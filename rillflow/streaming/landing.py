"""A landing folder merged into a table: every batch of new files replaces the rows of its keys.

The target is kept in buckets of its keys.  A batch is dealt to the buckets of its keys, and only these are written anew, as
folders named by batch and bucket; what a version of the table consists of is its manifest, a small file that names one folder
for each bucket that has rows.  The manifest is written last, so a batch takes effect whole or not at all: a batch that breaks
leaves folders that no manifest names, and repeating it writes them anew.  Old versions, and folders that none of the kept
manifests names, are swept after each batch.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.sets import upsert

#: Buckets of a new target, and the versions that stay readable.
BUCKETS, VERSIONS = 64, 3


class _Folder:
    """Files below a path, by Hadoop's file systems, so that any store will do."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self.path = spark._jvm, path.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(name))] if self._fs.exists(self._path(name)) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Under another name first, so that nobody reads half a file."""
        stream = self._fs.create(self._path(f"_{name}.tmp"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self._fs.delete(self._path(name), False)
        self._fs.rename(self._path(f"_{name}.tmp"), self._path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def _manifests(folder: _Folder) -> list[int]:
    return sorted(int(n[9:-5]) for n in folder.names() if n.startswith("manifest-") and n.endswith(".json"))


def _manifest(folder: _Folder, version: int) -> dict:
    return json.loads(folder.read(f"manifest-{version:09d}.json"))


def _read(spark: SparkSession, folder: _Folder, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
    paths = [f"{folder.path}/{f}" for b, f in manifest["folders"].items() if buckets is None or int(b) in buckets]
    schema = StructType.fromJson(manifest["schema"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def versions(spark: SparkSession, target: str) -> list[int]:
    return _manifests(_Folder(spark, target))


def read_target(spark: SparkSession, target: str, version: int | None = None) -> DataFrame | None:
    """The table as of a version, or of the newest one; None before the first."""
    folder = _Folder(spark, target)
    known = _manifests(folder)
    if not known or version is not None and version not in known:
        return None
    return _read(spark, folder, _manifest(folder, known[-1] if version is None else version))


def merge_batch(batch: DataFrame, batch_id: int, target: str, keys: list[str], order: str, stamp: str | None = None, buckets: int = BUCKETS, keep_versions: int = VERSIONS) -> None:
    """Makes the version of a batch: the version before it with the batch's keys replaced.

    Columns that either side lacks are null there; within a batch the largest ``order`` of a key wins.  A batch that is merged
    again starts from the version before it once more.  The number of buckets is that of the target's first version.
    """
    spark = batch.sparkSession
    folder = _Folder(spark, target)
    before = [v for v in _manifests(folder) if v < batch_id]
    old = _manifest(folder, before[-1]) if before else {"buckets": buckets, "folders": {}, "schema": None}
    rows = batch.withColumn(stamp, F.lit(batch_id)) if stamp else batch
    bucket = F.pmod(F.xxhash64(*keys), F.lit(old["buckets"])).cast("int")
    touched = [r[0] for r in rows.select(bucket.alias("b")).distinct().collect()]  # bounded by the buckets
    have = _read(spark, folder, old, touched) if old["schema"] else rows.limit(0)
    merged = upsert(have, rows, keys, order)
    out = f"data/v={batch_id:09d}"
    folder.delete(out)  # what a broken attempt left
    merged.withColumn("bucket__", bucket).repartition(max(1, len(touched)), "bucket__").write.partitionBy("bucket__").parquet(f"{folder.path}/{out}")
    folders = old["folders"] | {name[9:]: f"{out}/{name}" for name in folder.names(out) if name.startswith("bucket__=")}
    folder.write(f"manifest-{batch_id:09d}.json", json.dumps({"buckets": old["buckets"], "schema": merged.schema.jsonValue(), "folders": folders}))
    sweep(spark, target, keep_versions)


def sweep(spark: SparkSession, target: str, keep_versions: int = VERSIONS) -> None:
    """Deletes all but the newest versions, and the folders that none of these names.  Not while a batch is being written."""
    folder = _Folder(spark, target)
    known = _manifests(folder)
    for version in known[:-keep_versions]:
        folder.delete(f"manifest-{version:09d}.json")
    named = {f for version in known[-keep_versions:] for f in _manifest(folder, version)["folders"].values()}
    for version in folder.names("data"):
        parts = [f"data/{version}/{b}" for b in folder.names(f"data/{version}") if b.startswith("bucket__=")]
        for part in parts:
            if part not in named:
                folder.delete(part)
        if not any(part in named for part in parts):
            folder.delete(f"data/{version}")


def merge_landing(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, keys: list[str], order: str, files_per_batch: int = 1000, stamp: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Starts a stream that merges what is in the landing folder and not yet processed, and then ends."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return rows.writeStream.foreachBatch(lambda b, i: merge_batch(b, i, target, keys, order, stamp, buckets)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
