"""Exact dedup: binary-fuse filters of an immutable snapshot screen the digests of a new batch.

A text is normalised (every run of ASCII white space becomes one space) and hashed with SHA-256 over its whole bytes.
``write_snapshot`` groups the texts already taken in into exact buckets and builds, per shard of the digest space, a static
3-wise binary-fuse filter with 16-bit fingerprints; both are written below one path, never changed after, and found again
by ``open_snapshot``.  ``classes`` asks the filters about the digests of a batch: those not found are certainly new, and
the batch's copies among them are grouped apart; the rest (real copies and about 1 in 65,000 of the new ones) fetch
their texts and join the exact buckets byte by byte.  Copies within the batch are compared by their bytes too, so texts
with one digest that differ are two classes.

Shards hold about ``SHARD_KEYS`` digests of the snapshot; a batch with more digests to a shard is dealt to several tasks
that each get the shard's filter, so a frame in a task is bounded whichever side is larger, also for an empty snapshot.
Texts are grouped before they are dealt out, so copies never crowd a task, and only classes of several rows, spread over
``SLICES`` or broadcast if they are few, are joined back to the rows.

Defined results: null counts as empty; of equal texts the row with the smallest id stays; rows that repeat an id are
counted each, and one id stays kept in each of them; a null id is never kept before another id, and a group of null
ids only keeps them.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import at_most, per_core, scratch_dir, ship, written

SHARD_KEYS = 200_000
#: Tables of at most so many digests are broadcast.
BROADCAST_ROWS = 300_000
#: Tasks among which the rows of one digest are dealt in a larger join.
SLICES = 32
#: What a text is told by.
KEYS = ("sha", "n", "norm")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, sha, n, norm): the digest and the length in bytes of each normalised text, and the text."""
    norm = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("norm"))
    return norm.select("doc_id", digest(F.col("norm")).alias("sha"), F.octet_length("norm").alias("n"), "norm")


def grouped(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per key: its smallest id and how many rows have it."""
    return rows.groupBy(*keys).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))


# --- binary fuse filter ---------------------------------------------------------------------------------------------


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _slots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots in three neighbouring segments."""
    first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    return np.stack([(first + np.uint64(k)) * np.uint64(segment) + ((h >> np.uint64(s)) & mask) for k, s in enumerate((0, 13, 26))]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> bytes:
    """A filter over distinct unsigned 64-bit keys: a header of (seed, segment length, segments), then the slots."""
    keys = np.unique(keys)
    n = max(len(keys), 1)
    segment = 1 << min(18, max(2, int(math.log(n, 3.33) + 2.25)))
    size = int(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))) + 1
    seed = 0
    while True:
        segments = max(1, -(-size // segment))
        seed += 1
        h = _mix(keys, seed)
        at = _slots(h, segment, segments)
        total = (segments + 2) * segment
        count = np.bincount(at.ravel(), minlength=total)
        who = np.zeros(total, np.int64)
        for row in at:
            np.bitwise_xor.at(who, row, np.arange(len(keys)))
        rounds, left = [], len(keys)
        while left:
            alone = np.flatnonzero(count == 1)
            if not len(alone):
                break
            key, pick = np.unique(who[alone], return_index=True)
            rounds.append((key, alone[pick]))
            left -= len(key)
            for row in at[:, key]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(who, row, key)
        if not left:
            break
        size = int(size * 1.05) + 1
    slots = np.zeros(total, np.uint16)
    prints = _prints(h)
    for key, own in reversed(rounds):  # in a round no key's own slot is another's
        slots[own] = 0
        slots[own] = prints[key] ^ slots[at[0, key]] ^ slots[at[1, key]] ^ slots[at[2, key]]
    return np.array([seed, segment, segments], "<i8").tobytes() + slots.astype("<u2").tobytes()


def in_filter(data: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key of the filter, and for about 1 in 65,000 of others."""
    seed, segment, segments = (int(x) for x in np.frombuffer(data[:24], "<i8"))
    slots = np.frombuffer(data[24:], "<u2")
    h = _mix(keys, seed)
    a, b, c = _slots(h, segment, segments)
    return slots[a] ^ slots[b] ^ slots[c] == _prints(h)


def _keys(shas: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(x[8:16] for x in shas), "<u8") if len(shas) else np.zeros(0, np.uint64)


# --- Spark ----------------------------------------------------------------------------------------------------------


def shard_of(sha: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(sha), F.lit(shards)).cast("int")


@dataclass
class Snapshot:
    #: (sha, n, norm, least, copies): the exact buckets, one row per text
    buckets: DataFrame
    #: (sha, n) of digests that several texts have (as good as never)
    clashes: DataFrame
    #: (shard, filter, shards)
    filters: DataFrame
    shards: int


def write_snapshot(docs: DataFrame, path: str, shard_keys: int = SHARD_KEYS, doc_id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> Snapshot:
    """Writes the exact buckets and the filters of ``docs`` below a path, which must not exist yet."""
    spark = docs.sparkSession
    ship(spark)
    grouped(digests(docs, doc_id, text, digest), *KEYS).write.parquet(f"{path}/buckets")
    keys = spark.read.parquet(f"{path}/buckets").select("sha", "n")
    clashing(keys).write.parquet(f"{path}/clashes")
    shards = max(per_core(spark), -(-keys.count() // shard_keys))

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [key[0]], "filter": [build_filter(_keys(part["sha"]))]})

    filters = keys.select(shard_of(F.col("sha"), shards).alias("shard"), "sha").groupBy("shard").applyInPandas(build, "shard int, filter binary")
    filters.withColumn("shards", F.lit(shards)).write.parquet(f"{path}/filters")
    return open_snapshot(spark, path)


def clashing(keys: DataFrame) -> DataFrame:
    return keys.groupBy("sha", "n").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("sha", "n")


def open_snapshot(spark: SparkSession, path: str) -> Snapshot:
    buckets, clashes, filters = (spark.read.parquet(f"{path}/{x}") for x in ("buckets", "clashes", "filters"))
    first = filters.select("shards").first()
    return Snapshot(buckets, clashes, filters, first.shards if first else 1)


def screen(batch: DataFrame, snapshot: Snapshot, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Adds ``maybe`` to grouped digests of a batch: false means certainly not in the snapshot."""
    if snapshot.filters.isEmpty():
        return batch.withColumn("maybe", F.lit(False))
    slices = max(1, -(-batch.count() // (snapshot.shards * shard_keys)))

    def ask(key: tuple, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        rows["maybe"] = in_filter(own["filter"].iloc[0], _keys(rows["sha"])) if len(own) else False
        return rows.drop(columns=["shard", "slice"])

    left = batch.withColumn("shard", shard_of(F.col("sha"), snapshot.shards)).withColumn("slice", F.pmod(F.xxhash64(F.lit("slice"), "sha"), F.lit(slices)))
    filters = snapshot.filters.select("shard", "filter", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batch.schema)
    return left.groupBy("shard", "slice").cogroup(filters.groupBy("shard", "slice")).applyInPandas(ask, f"{kinds}, maybe boolean")


def classes(snapshot: Snapshot, batch: DataFrame, shard_keys: int = SHARD_KEYS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(sha, n, norm, keep_id, group_size): every text that several rows of snapshot and batch have, and every text of
    which the digest had to be looked at.  ``batch`` is of ``digests``."""
    screened = written(screen(grouped(batch, "sha", "n"), snapshot, shard_keys))
    suspects = written(screened.where("maybe or copies > 1").select("sha", "n"))
    if at_most(suspects, broadcast_rows):
        suspects = F.broadcast(suspects)
        positives = grouped(batch.join(suspects, ["sha", "n"], "left_semi"), *KEYS)
    else:  # copies are combined before the join, so that none crowds a task
        positives = grouped(batch, *KEYS).join(suspects, ["sha", "n"], "left_semi")
    asked = suspects.withColumn("asked", F.lit(True)).unionByName(snapshot.clashes.withColumn("asked", F.lit(True))).distinct()
    buckets = snapshot.buckets.join(F.broadcast(asked) if at_most(asked, broadcast_rows) else asked, ["sha", "n"], "left").where("asked or copies > 1")
    buckets = buckets.select(*KEYS, F.col("least").alias("old_least"), F.col("copies").alias("old_copies"))
    both = positives.join(buckets, list(KEYS), "full")  # by the text itself: the byte check
    return both.select(*KEYS, F.least("least", "old_least").alias("keep_id"), (F.coalesce("copies", F.lit(0)) + F.coalesce("old_copies", F.lit(0))).alias("group_size"))


def assigned(rows: DataFrame, found: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, sha, keep_id, group_size) for rows of ``digests`` and the ``classes`` of all of them."""
    found = written(found)
    twice = written(clashing(found.select("sha", "n")))
    out = ["doc_id", "sha", F.coalesce("keep_id", "doc_id").alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size")]
    multiple = found.where("group_size > 1").select("sha", "n", "keep_id", "group_size")
    apart = None
    if not twice.isEmpty():  # texts of these digests are told apart by themselves
        apart = rows.join(twice, ["sha", "n"], "left_semi").join(found, list(KEYS), "left").select(*out)
        rows, multiple = rows.join(twice, ["sha", "n"], "left_anti"), multiple.join(twice, ["sha", "n"], "left_anti")
    if at_most(multiple, broadcast_rows):
        joined = rows.join(F.broadcast(multiple), ["sha", "n"], "left")
    else:
        slices = multiple.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
        joined = rows.drop("norm").withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))).join(slices, ["sha", "n", "slice"], "left")
    joined = joined.select(*out)
    return joined if apart is None else joined.unionByName(apart)


def dedup(docs: DataFrame, is_snapshot: Column, path: str, shard_keys: int = SHARD_KEYS, broadcast_rows: int = BROADCAST_ROWS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, sha, keep_id, group_size) for all rows, of which some become the snapshot at ``path`` and the others the
    batch."""
    write_snapshot(docs.where(is_snapshot), path, shard_keys, digest=digest)
    snapshot = open_snapshot(docs.sparkSession, path)
    found = classes(snapshot, digests(docs.where(~is_snapshot), digest=digest), shard_keys, broadcast_rows)
    return assigned(digests(docs, digest=digest), found, broadcast_rows)


def op04_exact(docs: DataFrame) -> DataFrame:
    """The registered query: ids with an even crc32 are the snapshot, the others the new batch; the result is the same
    for any division."""
    docs = docs.select("doc_id", "text")
    old = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    out = dedup(docs, old, scratch_dir(docs.sparkSession))
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = r"""
WITH norm AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM norm WINDOW w AS (PARTITION BY text_sha256)
"""
