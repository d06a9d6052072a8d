"""Small helpers that several operators of this package share."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path
from typing import Any

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, table, written

__all__ = ["at_most", "bounded_sample", "crc_mod", "per_core", "scratch_dir", "share", "ship", "table", "written"]


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python once per application, so that none needs it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_rillflow_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{root.name}", "zip", root.parent, root.name))
    sc._rillflow_shipped = True


def share(spark: SparkSession, value: Any) -> Broadcast:
    """Broadcasts a value of bounded size (a model, a vocabulary) for use in Python workers."""
    ship(spark)
    return spark.sparkContext.broadcast(value)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most so many rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows


def bounded_sample(df: DataFrame, key: Column, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows at most, chosen by a hash of ``key``, so that a second run takes the same rows.

    Only for fitting models: a fit needs no more rows than this, however large the corpus is.
    """
    n = df.count()
    if n <= max_rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def per_core(spark: SparkSession) -> int:
    """Partitions for a shuffle that is sized by hand."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
