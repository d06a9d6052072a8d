"""Quality by a sparse rule ensemble.

``statistics`` are Spark column expressions over the whole text.  A random forest of shallow trees is grown on the
labelled sample; every path from a root to a node is a rule, a conjunction of comparisons; a lasso logistic regression
keeps few of the rules (and of the clipped, scaled statistics) with a weight.  ``compile_score`` turns them into one
column expression, so scoring needs no Python.

The sample has ``MAX_TRAIN_ROWS`` rows at most; all statistics are computed over whole texts of all documents.

Defined results: null and empty texts have statistics 0 and get the score of that; without labels of both kinds every
text scores the share of label 1 (or 0.5 without any label); repeated rows are scored each; labels, language, source
and id are no inputs of a score; extra columns are kept, but for ``score`` and those named as statistics, which are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .op03_toxicity import labelled_rows
from .util import crc_mod, written

MAX_TRAIN_ROWS = 20_000
TREES, DEPTH = 12, 3
LASSO = 0.002
#: From this score on a text counts as good.
THRESHOLD = 0.3
#: Statistics, by name; ``statistics`` says how each is computed.
NAMES = ("log_words", "word_length", "symbols", "bangs", "capitals", "digits", "stops", "distinct", "line_words", "repeats")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns ``NAMES``."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keep = lambda chars: F.length(F.regexp_replace("_t", f"[^{chars}]+", "")).cast("double")
    over = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    rest = [c for c in docs.columns if c not in NAMES]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"), t.alias("_t")).withColumn("_w", F.filter(F.split("_t", r"\s+"), lambda w: w != ""))
    n, words = F.length("_t"), F.size("_w")
    m = F.greatest(words - 1, F.lit(0))
    # words of two characters or more that repeat the one before; a pattern with a back reference overflows the stack on long runs
    repeated = F.zip_with(F.slice("_w", F.lit(1), m), F.slice("_w", F.lit(2), m), lambda a, b: F.when((a == b) & (F.length(b) > 1), F.length(b) + 1).otherwise(0))
    values = {
        "log_words": F.log1p(words),
        "word_length": over(n, words),
        "symbols": over(keep(r"%$*&#@^~|<>{}\[\]\\_=+"), n),
        "bangs": over(keep("!?"), words),
        "capitals": over(keep(r"\p{Lu}"), n),
        "digits": over(keep("0-9"), n),
        "stops": over(keep(".,;:"), words),
        "distinct": over(F.size(F.array_distinct("_w")), words),
        "line_words": over(words, F.length(F.regexp_replace("_t", "[^\n]+", "")) + 1),
        "repeats": over(F.aggregate(repeated, F.lit(0), lambda total, x: total + x), n),
    }
    return rows.select(*(F.col(f"row.`{c}`") for c in rest), *(values[k].alias(k) for k in NAMES))


@dataclass
class Model:
    offset: float = 0.0
    #: (weight, ((statistic, is_upper_bound, value), ...))
    rules: list[tuple[float, tuple]] = field(default_factory=list)
    #: (weight, statistic, low, high): a statistic clipped to a range
    linear: list[tuple[float, str, float, float]] = field(default_factory=list)


def holds(rule: tuple) -> Column:
    out = F.lit(True)
    for name, upper, value in rule:
        out = out & (F.col(name) <= value if upper else F.col(name) > value)
    return out


def _clipped(name: str, low: float, high: float) -> Column:
    return (F.least(F.greatest(F.col(name), F.lit(low)), F.lit(high)) - low) / (high - low)


def compile_score(model: Model) -> Column:
    """The model as one column expression over the statistics."""
    total = F.lit(model.offset)
    for weight, rule in model.rules:
        total = total + F.when(holds(rule), weight).otherwise(0.0)
    for weight, name, low, high in model.linear:
        total = total + weight * _clipped(name, low, high)
    return 1 / (1 + F.exp(-total))


def _paths(node, names: tuple[str, ...], above: tuple = ()) -> list[tuple]:
    """The rules of a tree: a path to every node but the root."""
    out = [_merged(above)] if above else []
    if node.getClass().getSimpleName() == "InternalNode":
        name, value = names[node.split().featureIndex()], float(node.split().threshold())
        out += _paths(node.leftChild(), names, (*above, (name, True, value)))
        out += _paths(node.rightChild(), names, (*above, (name, False, value)))
    return out


def _merged(path: tuple) -> tuple:
    """Only the tightest bound of each kind stays."""
    best: dict[tuple[str, bool], float] = {}
    for name, upper, value in path:
        old = best.get((name, upper))
        best[name, upper] = value if old is None else min(old, value) if upper else max(old, value)
    return tuple((n, u, v) for (n, u), v in sorted(best.items()))


def fit(labelled: DataFrame, text: str = "text", label: str = "quality", trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Model:
    rows = labelled.where(F.col(label).isNotNull()).select(F.col(text).alias("text"), F.col(label).cast("double").alias("label"))
    data = written(statistics(rows).drop("text"))
    n, good = data.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < good < n:
        share = good / n if n else 0.5
        return Model(math.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    data = data.coalesce(max(2, min(8, data.rdd.getNumPartitions()))).persist()
    try:
        x = VectorAssembler(inputCols=list(NAMES), outputCol="x").transform(data)
        forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="0.6", minInstancesPerNode=3).fit(x)
        rules = sorted({r for tree in forest.trees for r in _paths(tree._call_java("rootNode"), NAMES)})
        edges = data.approxQuantile(list(NAMES), [0.02, 0.98], 0.005)
        linear = [(name, low, high) for name, (low, high) in zip(NAMES, edges, strict=True) if high > low]
        inputs = [F.when(holds(r), 1.0).otherwise(0.0).alias(f"r{i}") for i, r in enumerate(rules)] + [_clipped(*x).alias(f"l{i}") for i, x in enumerate(linear)]
        wide = data.select("label", F.array(*inputs).alias("a"))
        from pyspark.ml.functions import array_to_vector

        fitted = LogisticRegression(featuresCol="x", labelCol="label", regParam=lasso, elasticNetParam=1.0, standardization=False, maxIter=60).fit(wide.select("label", array_to_vector("a").alias("x")))
    finally:
        data.unpersist()
    weights = [float(w) for w in fitted.coefficients]
    return Model(
        float(fitted.intercept),
        [(w, r) for w, r in zip(weights, rules, strict=False) if w],
        [(w, *x) for w, x in zip(weights[len(rules) :], linear, strict=True) if w],
    )


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds the statistics and ``score`` (0 to 1)."""
    return statistics(docs, text).withColumn("score", compile_score(model))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_mod(doc_id, 5) == 0, F.lit(False))


def op07_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    docs = docs.select("doc_id", "text")
    model = fit(labelled_rows(docs, labels.select("doc_id", "quality"), "quality", held_out(F.col("doc_id")), max_rows))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
