"""Toxicity by maximum-scoring segments.

Every token has a log-odds of toxic to clean tokens under Dirichlet priors in three levels: a word's counts are smoothed
by those of its 4-character prefix, a prefix's by the rate of all tokens.  A token's score is its log-odds less a drift, so
that a clean text's scores sum up to less and less, and one linear scan finds every maximal scoring segment (each passage
that can't be made better by lengthening or shortening).  Segment scores are calibrated by the extreme-value distribution
of the best segment of a clean text of m tokens, P(best <= S) = exp(-K m exp(-lambda S)): lambda and K are its maximum
likelihood over clean training texts, of which those without a segment count as best <= 0.  The segments' normalised scores
lambda S - ln(K m) that are above zero are summed up, and a logistic curve over the sum, above a floor for labels that
nothing in the text explains, gives the score of the text.

``fit`` learns from labelled rows, ``MAX_TRAIN_ROWS`` of them at most; token counts are a Spark aggregation, of which
only odd tokens reach the driver.  Equal training texts count once.  The calibration sees each text through the table of
the other ``FOLDS`` - 1 parts of the training texts.

Defined results: null and empty texts have no segment and score as clean; without labelled rows of both kinds every
text scores 0; repeated rows are scored each; a column ``score`` of the input is replaced; labels, language, source and id
are no inputs of a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import bounded_sample, crc_mod, share, ship, written

MAX_TRAIN_ROWS = 20_000
#: Pseudo-counts that a word gets from its prefix, and a prefix from the whole.
PRIOR = 3.0
PREFIX = 4
#: A token is odd from so many log-odds on, if it is in so many toxic texts, and so many standard deviations more often
#: than clean ones would have it.
MIN_LOG_ODDS, MIN_TOXIC, MIN_Z = 1.5, 3, 3.0
DRIFT = 0.35
CLEAN_TOKEN = -0.05
FOLDS = 5
#: Shares of labels that nothing in the text explains, of which the likeliest is taken.
FLOORS = (0.0, 0.001, 0.002, 0.004, 0.006, 0.008, 0.01, 0.015, 0.02, 0.03)
#: From this score on a text is called toxic.
THRESHOLD = 0.7
#: Keys that a counting task holds at once.
HELD = 100_000
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    k: float = 0.1
    slope: float = 0.0
    offset: float = -50.0
    floor: float = 0.0

    def tokens(self, text: str | None) -> list[float]:
        out = []
        for w in words_of(text):
            s = self.words.get(w)
            if s is None:
                s = self.prefixes.get(w[:PREFIX], CLEAN_TOKEN) if len(w) >= PREFIX else CLEAN_TOKEN
            out.append(s - DRIFT)
        return out

    def statistic(self, text: str | None) -> float:
        scores = self.tokens(text)
        if not scores:
            return 0.0
        floor = math.log(max(self.k * len(scores), 1e-9))
        return sum(max(0.0, self.lam * s - floor) for _, _, s in segments(scores))

    def score(self, text: str | None) -> float:
        z = self.offset + self.slope * self.statistic(text)
        return self.floor + (1 - self.floor) / (1 + math.exp(-z)) if z > -700 else self.floor


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, behind last, score), in linear time."""
    # a candidate keeps the running sum before it (left) and at its end (right)
    stack: list[tuple[int, int, float, float]] = []
    lower: list[int] = []  # for each candidate, the nearest one before it with a smaller left sum
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        first, left = i, before
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = lower[j]
            if j < 0 or stack[j][3] >= total:
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:], lower[j:]
            j -= 1
        stack.append((first, i + 1, left, total))
        lower.append(j)
    return [(a, b, right - left) for a, b, left, right in stack]


_COUNTS = ("toxic_tokens", "tokens", "toxic_texts", "texts")


def _counted(rows: DataFrame) -> DataFrame:
    """(is_word, key, counts of all and of each fold) of words and prefixes in (text, label, fold).

    A task adds up what it has read and hands it on whenever it holds ``HELD`` keys, so its memory is bounded and one row
    stands for many occurrences.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[bool, str, int], list[int]] = {}

        def out() -> pa.RecordBatch:
            keys, values = list(found), np.array(list(found.values()), np.int64).reshape(-1, 4)
            columns = [pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int32()), *(pa.array(values[:, i]) for i in range(4))]
            return pa.RecordBatch.from_arrays(columns, ["is_word", "key", "fold", *_COUNTS])

        for batch in batches:
            for text, label, fold in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = Counter(words_of(text.as_py()))
                prefixes: Counter = Counter()
                for w, k in words.items():
                    if len(w) >= PREFIX:
                        prefixes[w[:PREFIX]] += k
                for is_word, units in ((True, words), (False, prefixes)):
                    for key, k in units.items():
                        cell = found.setdefault((is_word, key, fold), [0, 0, 0, 0])
                        cell[0] += k * label
                        cell[1] += k
                        cell[2] += label
                        cell[3] += 1
                if len(found) > HELD:
                    yield out()
                    found.clear()
        if found:
            yield out()

    kinds = "is_word boolean, key string, fold int, " + ", ".join(f"{c} long" for c in _COUNTS)
    cells = rows.select("text", "label", "fold").mapInArrow(count, kinds)
    of_fold = [F.coalesce(F.sum(F.when(F.col("fold") == k, F.col(c))), F.lit(0)).alias(f"{c}_{k}") for c in _COUNTS for k in range(FOLDS)]
    return cells.groupBy("is_word", "key").agg(*(F.sum(c).alias(c) for c in _COUNTS), *of_fold)


def _tables(units: DataFrame, tokens: int, toxic_tokens: int, texts: int, toxic_texts: int) -> Model:
    """Log-odds of odd words and prefixes; ``units`` has counts of words and prefixes, the numbers are those of all."""
    if not 0 < toxic_tokens < tokens or not 0 < toxic_texts < texts:
        return Model()
    base, text_base = toxic_tokens / tokens, toxic_texts / texts
    logit = lambda x: F.log(x / (1 - x))
    smoothed = lambda parent: (F.col("toxic_tokens") + PRIOR * parent) / (F.col("tokens") + PRIOR)
    t, n = F.col("toxic_texts"), F.col("texts")
    prefixes = units.where("not is_word").withColumn("rate", smoothed(F.lit(base)))
    parents = prefixes.select(F.col("key").alias("prefix"), F.col("rate").alias("parent"))
    words = units.where(F.col("is_word") & (t >= MIN_TOXIC)).withColumn("prefix", F.when(F.length("key") >= PREFIX, F.substring("key", 1, PREFIX))).join(parents, "prefix", "left")
    words = words.withColumn("rate", smoothed(F.coalesce("parent", F.lit(base))))
    seen = (t + PRIOR * text_base) / (n + PRIOR)
    z = (logit(seen) - math.log(text_base / (1 - text_base))) / F.sqrt(1 / (t + PRIOR * text_base) + 1 / (n - t + PRIOR * (1 - text_base)))
    both = words.select("is_word", "key", "rate", *_COUNTS).unionByName(prefixes.where(t >= MIN_TOXIC).select("is_word", "key", "rate", *_COUNTS))
    odd = both.withColumn("odds", logit(F.col("rate")) - math.log(base / (1 - base))).where((F.col("odds") >= MIN_LOG_ODDS) & (z >= MIN_Z))
    found = odd.select("is_word", "key", "odds").collect()  # bounded by the sample, and few of its words
    return Model(words={r.key: r.odds for r in found if r.is_word}, prefixes={r.key: r.odds for r in found if not r.is_word})


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """The tables come from all training rows; the calibration from rows of which tables of the others know nothing."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    rows = bounded_sample(rows, F.col("key"), max_rows).groupBy("text").agg(F.max("label").alias("label"))
    rows = written(rows.select("text", "label", F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(FOLDS)).cast("int").alias("fold")))
    per_fold = {r.fold: (r.n, r.t) for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("t")).collect()}
    n, toxic = (sum(x[k] for x in per_fold.values()) for k in (0, 1))
    if not 0 < toxic < n:
        return Model()
    ship(labelled.sparkSession)
    units = written(_counted(rows))
    sums = units.where("is_word").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for base in _COUNTS[:2] for c in (base, *(f"{base}_{k}" for k in range(FOLDS))))).first()
    model = _tables(units.select("is_word", "key", *_COUNTS), sums["tokens"], sums["toxic_tokens"], n, toxic)
    parts = []
    for k in range(FOLDS):
        own_n, own_toxic = per_fold.get(k, (0, 0))
        others = units.select("is_word", "key", *((F.col(c) - F.col(f"{c}_{k}")).alias(c) for c in _COUNTS)).where("tokens > 0")
        parts.append(_tables(others, sums["tokens"] - sums[f"tokens_{k}"], sums["toxic_tokens"] - sums[f"toxic_tokens_{k}"], n - own_n, toxic - own_toxic))
    _calibrate(model, parts, rows)
    return model


def extreme_value_fit(best: np.ndarray, m: np.ndarray) -> tuple[float, float]:
    """Maximum likelihood (lambda, K) of P(best <= S) = exp(-K m exp(-lambda S)), texts without a segment being cut at 0."""
    some = best > 0
    n = some.sum()
    if n < 3:
        return 1.0, max(n, 0.5) / max(m.sum(), 1)
    scores, lengths = best[some], m[some]
    k_of = lambda lam: n / ((lengths * np.exp(-lam * scores)).sum() + m[~some].sum())
    slope = lambda lam: n / lam - scores.sum() + k_of(lam) * (lengths * scores * np.exp(-lam * scores)).sum()
    low, high = 0.05, 5.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    return low, float(k_of(low))


def logistic_fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """(offset, slope, floor) of P = floor + (1 - floor) / (1 + exp(-offset - slope x)), the likeliest with a small ridge."""
    best = None
    for floor in FLOORS:
        a, b = -5.0, 0.7
        for _ in range(200):
            s = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
            p = np.clip(floor + (1 - floor) * s, 1e-9, 1 - 1e-9)
            d = (1 - floor) * s * (1 - s)
            r, w = (y - p) / (p * (1 - p)) * d, d * d / (p * (1 - p)) + 1e-9
            g = np.array([r.sum(), (r * x).sum() - 0.5 * b])
            h = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 0.5]])
            da, db = np.linalg.solve(h, g)
            a, b = a + float(np.clip(da, -0.5, 0.5)), b + float(np.clip(db, -0.1, 0.1))
        p = np.clip(floor + (1 - floor) / (1 + np.exp(-np.clip(a + b * x, -30, 30))), 1e-9, 1 - 1e-9)
        likely = (y * np.log(p) + (1 - y) * np.log(1 - p)).sum() - 0.25 * b * b
        if best is None or likely > best[0]:
            best = (likely, a, b, floor)
    return best[1:]


def _calibrate(model: Model, parts: list[Model], rows: DataFrame) -> None:
    """lambda and K from clean texts, then the logistic curve; what comes to the driver is a few numbers a row of the
    bounded sample."""
    shared = share(rows.sparkSession, parts)

    @F.pandas_udf("m long, best double")
    def measure(texts: pd.Series, folds: pd.Series) -> pd.DataFrame:
        out = []
        for t, k in zip(texts, folds, strict=True):
            s = shared.value[k].tokens(t)
            out.append((len(s), max((x for _, _, x in segments(s)), default=0.0)))
        return pd.DataFrame(out, columns=["m", "best"])

    seen = rows.select("label", measure("text", "fold").alias("x")).select("label", "x.*").toPandas()
    clean = seen[(seen["label"] == 0) & (seen["m"] > 0)]
    lam, k = extreme_value_fit(clean["best"].to_numpy(float), clean["m"].to_numpy(float))
    for m in (model, *parts):
        m.lam, m.k = lam, k
    shared = share(rows.sparkSession, parts)

    @F.pandas_udf("double")
    def statistic(texts: pd.Series, folds: pd.Series) -> pd.Series:
        return pd.Series([shared.value[k].statistic(t) for t, k in zip(texts, folds, strict=True)], dtype="float64")

    data = rows.select("label", statistic("text", "fold").alias("x")).toPandas()
    model.offset, model.slope, model.floor = logistic_fit(data["x"].to_numpy(float), data["label"].to_numpy(float))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1)."""
    shared = share(docs.sparkSession, model)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return docs.withColumn("score", of(F.col(text)))


def passages(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, first, last, segment_score, e_value): every significant passage, in character offsets."""
    shared = share(docs.sparkSession, model)

    @F.pandas_udf("array<struct<first:int,last:int,segment_score:double,e_value:double>>")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            m = shared.value
            scores = m.tokens(t)
            spans = [x.span() for x in _WORD.finditer((t or "").lower())]
            found = []
            for a, b, s in segments(scores):
                e = m.k * len(scores) * math.exp(-m.lam * s)
                if e < 1:
                    found.append({"first": spans[a][0], "last": spans[b - 1][1], "segment_score": s, "e_value": e})
            out.append(found)
        return pd.Series(out)

    return docs.select(doc_id, F.explode(of(F.col(text))).alias("p")).select(doc_id, "p.*")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_mod(doc_id, 3) == 1, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, held: Column, max_rows: int) -> DataFrame:
    """Documents with a label outside the held-out part.  The labels are cut down to a bounded sample first, so the
    side that is broadcast has at most about ``max_rows`` rows."""
    chosen = labels.where(~held & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label))
    chosen = bounded_sample(chosen, F.col("doc_id"), max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def op03_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    docs = docs.select("doc_id", "text")
    model = fit(labelled_rows(docs, labels.select("doc_id", "toxic"), "toxic", held_out(F.col("doc_id")), max_rows), max_rows=max_rows)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
