"""Tables in and out: lookups, updates, nested JSON, layers with a box per feature, table definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import box


def read_lookup(spark: SparkSession, path: str, schema: str, separator: str = ",") -> DataFrame:
    """A lookup from delimited text with a header, with a given schema; empty cells are null.  ``path`` may be a pattern
    over many folders."""
    return spark.read.option("recursiveFileLookup", "true").csv(path, schema=schema, header=True, sep=separator, nullValue="", enforceSchema=False)


def write_lookup(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.csv(path, header=True, sep=separator)


def updated(df: DataFrame, target: str, value: object, column: str, new: object) -> DataFrame:
    """Rows of which ``target`` has the value get a new value in another column."""
    return df.withColumn(column, F.when(F.col(target).eqNullSafe(F.lit(value)), F.lit(new)).otherwise(F.col(column)))


def extremes(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, min_value, max_value, n) of text readings; what is no number doesn't count."""
    v = F.col(value).try_cast("double")
    return df.groupBy(key).agg(F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.count(v).alias("n"))


def write_rollup(df: DataFrame, path: str, keys: list[str]) -> None:
    """JSON lines: the keys, and all other columns nested in ``metrics``."""
    df.select(*keys, F.struct(*(c for c in df.columns if c not in keys)).alias("metrics")).write.json(path)


def read_rollup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = spark.read.schema(schema).json(path)
    return rows.select(*(c for c in rows.columns if c != "metrics"), "metrics.*")


def geojson(kind: str, coordinates: Column, properties: list[str]) -> Column:
    """A feature as JSON text; ``coordinates`` are arrays of numbers in the nesting of the kind."""
    geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")))


def with_box(df: DataFrame, points: str, name: str = "geometry_bbox") -> DataFrame:
    """Adds the box of an array of points as a struct of floats, widened to the next float so that it still holds them; a
    reader that filters by it skips files and row groups by their statistics."""
    b = box(F.col(points))
    # one part in eight million more than the number, which is over a float's precision
    low = lambda c: (c - F.abs(c) * 1.2e-7).cast("float")
    high = lambda c: (c + F.abs(c) * 1.2e-7).cast("float")
    return df.withColumn(name, F.struct(low(b["xmin"]).alias("xmin"), low(b["ymin"]).alias("ymin"), high(b["xmax"]).alias("xmax"), high(b["ymax"]).alias("ymax")))


def write_layer(df: DataFrame, path: str, points: str, sort: bool = True) -> None:
    """Parquet with a box per feature; sorted by the box within partitions, so that row groups are compact."""
    out = with_box(df, points)
    out = out.sortWithinPartitions("geometry_bbox.xmin", "geometry_bbox.ymin") if sort else out
    out.write.option("compression", "snappy").parquet(path)


def read_layer(spark: SparkSession, path: str, within: tuple[float, float, float, float] | None = None) -> DataFrame:
    """A layer, or those of its features of which the box meets the given one."""
    df = spark.read.parquet(path)
    if within is None:
        return df
    x0, y0, x1, y1 = within
    b = F.col("geometry_bbox")
    return df.filter((b["xmin"] <= x1) & (b["xmax"] >= x0) & (b["ymin"] <= y1) & (b["ymax"] >= y0))


def table_definition(df: DataFrame, name: str, path: str, comments: dict[str, str] | None = None) -> str:
    """SQL that defines an external table over files of this schema."""
    comment = lambda c: f" COMMENT '{(comments or {})[c].replace(chr(39), chr(39) * 2)}'" if c in (comments or {}) else ""
    columns = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}{comment(f.name)}" for f in df.schema)
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {columns}\n) USING parquet LOCATION '{path}'"
