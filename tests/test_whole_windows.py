"""Windows of whole streams where their rows are, against plain versions and against the windows of stretches."""

import numpy as np
import pytest
from conftest import SMALL
from oracle import same
from pyspark.sql import functions as F

from rillflow.operators import windows
from rillflow.plans import ORACLES, QUERIES

NAMES = ["catalogue_engine_own_width", "own_window_extremes"]


@pytest.mark.parametrize("batch", [10_000, 7, 1])
def test_windows_of_whole_streams(spark, batch):
    rng = np.random.default_rng(batch)
    rows = [(("p", None, "q", "r")[k % 4], None if k % 29 == 0 else float(d), None if k % 5 == 0 else float(v), None if k % 31 == 0 else float(d - a), float(d + b)) for k, (d, v, a, b) in enumerate(rng.integers(-40, 40, (260, 4)))]
    rows += [("one", 1.0, 2.0, 1.0, 1.0), ("none", 1.0, None, 0.0, 2.0), ("inf", 1.0, float("inf"), 1.0, 3.0), ("inf", 2.0, 7.0, 2.0, 2.0), ("nan", 1.0, float("nan"), 0.0, 9.0), ("nan", 2.0, 5.0, 0.0, 9.0)]
    df = spark.createDataFrame(rows, "path string, at double, v double, low double, high double").withColumns({"u": F.col("v"), "w": F.col("v"), "same": F.col("v")})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = windows.whole_windows(df.repartition(5, "path"), "path", "at", F.col("low"), F.col("high"), ["v"], ["u"], ["w"], keep=["low", "high", "same"])
        found = [(r.path, r.at, r.same, r.low, r.high, r.mw_v, r.mw_u, r.mw_w) for r in out.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = []
    largest = lambda v: (v != v, v)  # NaN is the largest value
    for p, at, v, low, high in rows:
        inside = [w for q, d, w, *_ in rows if q == p and None not in (d, low) and low <= d <= high and w is not None]
        wanted.append((p, at, v, low, high, sum(inside) if inside else None, min(inside, default=None, key=largest), max(inside, default=None, key=largest)))
    plain = lambda r: r[0] != "inf" or r[4] == 3.0  # a sum behind an infinite one is as exact as running sums are
    assert sorted(map(str, filter(plain, found))) == sorted(map(str, filter(plain, wanted)))


def test_whole_streams_are_shuffled_once(spark):
    for name in NAMES:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1, name


@pytest.mark.parametrize("name", NAMES)
def test_long_streams_are_cut(spark, name, monkeypatch):
    sizes = [r["count"] for r in spark.read.parquet(f"{SMALL}/lineitem.parquet").groupBy("l_suppkey").count().orderBy("count").collect()]
    monkeypatch.setattr(windows, "WHOLE", sizes[len(sizes) // 2])
    cut, own = [], windows.own_windows
    monkeypatch.setattr(windows, "own_windows", lambda *a, **k: cut.append(1) or own(*a, **k))
    same(QUERIES[name](spark, SMALL), ORACLES[name], SMALL)
    assert cut == [1]
