"""Session and the table registry."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

#: What the engine expects of a session; a cluster's own settings win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("rillflow")
    if master:
        builder = builder.master(master)
    for k, v in (DEFAULTS | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str) -> None:
    """Temporary views of the tables."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder; it is deleted when the driver ends.

    The folder is read from the session.  Only on one machine (tests) may the session name none; a temporary folder is
    taken there.  On a cluster that would be a folder of each machine's own, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir is unset: {master} needs a folder that driver and executors share")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/rillflow-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python once per application, so that none needs it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_rillflow_shipped", False):
        return
    root = Path(__file__).resolve().parent
    sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/{root.name}", "zip", root.parent, root.name))
    sc._rillflow_shipped = True


def written(df: DataFrame) -> DataFrame:
    """Cuts the lineage: writes ``df`` to the shared folder and reads it back."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
