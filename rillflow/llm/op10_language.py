"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, everything that is not a letter becomes one space, and its character 1- to 3-grams are
hashed into ``buckets`` columns.  ``fit`` counts (language, bucket) with a Spark aggregation; what reaches the
driver is the count matrix, of languages x buckets cells, never documents.  ``identify`` broadcasts the matrix of
log-probabilities and scores batches of sparse rows in numpy.

Defined results: a null text, an empty text and a text without a letter get ``und`` and 0.0; ties go to the
language that sorts first; without a labelled row every text gets ``und``.  Rows with a null language or text
teach nothing.  Repeated rows count each time; other columns pass through untouched, but for ``lang_pred`` and
``score``, which are replaced.  A text of any length is
read whole, in slices of ``SLICE`` characters that give what they would give in one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import crc_mod, share

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SLICE = 1 << 20
#: A fit reads about so many labelled rows at most.
MAX_TRAIN_ROWS = 40_000
UNDETERMINED = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _grams(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Bucket numbers of the n-grams, slice by slice; what a slice needs of the one before is carried on."""
    text = text.lower()
    after_letter, tail = True, np.zeros(0, np.uint64)
    for start in range(0, len(text), SLICE):
        codes = np.frombuffer(text[start : start + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[codes]
        keep = letter | np.concatenate(([after_letter], letter[:-1]))  # runs of non-letters count once
        after_letter, old = letter[-1], len(tail)
        codes = np.concatenate((tail, np.where(letter, codes, 32).astype(np.uint64)[keep]))
        tail = codes[len(codes) - min(len(codes), max(ORDERS) - 1) :]
        h = np.zeros(len(codes), np.uint64)
        for n in ORDERS:
            if len(codes) < n:
                break
            h = h[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)[max(0, old - n + 1) :]


def sparse(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros(buckets, np.int64)
    for b in _grams(text, buckets):
        counts += np.bincount(b, minlength=buckets)
    at = np.flatnonzero(counts)
    return at, counts[at]


class Model:
    """Languages in sorted order, log-priors, and log-probabilities [bucket, language]."""

    def __init__(self, langs: list[str], prior: np.ndarray, logp: np.ndarray):
        self.langs, self.prior, self.logp = langs, prior, logp

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """One sparse matrix for the batch: its rows are summed with reduceat."""
        names, best = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.langs else []
        buckets = len(self.logp)
        for at in range(0, len(rows), 256):
            part = rows[at : at + 256]
            cells = [sparse(texts[i], buckets) for i in part]
            starts = np.cumsum([0] + [len(c[0]) for c in cells[:-1]])
            weighted = self.logp[np.concatenate([c[0] for c in cells])] * np.concatenate([c[1] for c in cells])[:, None]
            total = np.add.reduceat(weighted, starts, axis=0) + self.prior
            total -= total.max(axis=1, keepdims=True)
            post = np.exp(total)
            post /= post.sum(axis=1, keepdims=True)
            for i, k, p in zip(part, post.argmax(axis=1), post.max(axis=1), strict=True):
                names[i], best[i] = self.langs[k], p
        return names, best


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_rows: int = MAX_TRAIN_ROWS, buckets: int = BUCKETS, smooth: float = 0.5) -> Model:
    """Learns from rows whose text and language are not null, from about ``max_rows`` of them at most, dealt evenly among the
    languages."""
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    # a bound for each language, so that one with few rows stays in the model however large the corpus is
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # as many rows as languages
    share_of = lambda n: min(1.0, max_rows / max(len(sizes), 1) / n)
    if sum(sizes.values()) > max_rows:
        keep = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, int(1_000_000 * share_of(n)))))
        rows = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(1_000_000)) < F.element_at(keep, F.col("lang")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name not in found:
                    found[name] = np.zeros(buckets + 1, np.int64)
                found[name][buckets] += 1  # the last cell counts rows
                if has_letter(t):
                    at, n = sparse(t, buckets)
                    found[name][at] += n
        for name, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})

    counts = rows.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    matrix = np.zeros((buckets + 1, len(langs)))
    matrix[counts["bucket"].to_numpy(np.int64), counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)] = counts["n"]
    docs_of, matrix = matrix[buckets], matrix[:buckets] + smooth
    logp = np.log(matrix / matrix.sum(axis=0)) if langs else matrix
    return Model(langs, np.log(docs_of / docs_of.sum()) if langs else docs_of, logp.astype(np.float32))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the posterior probability of that language."""
    shared = share(docs.sparkSession, model)

    @F.pandas_udf("lang_pred string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        names, best = shared.value.score(texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": best})

    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), score(F.col(f"`{text}`")).alias("found"))
    return row.select(*(F.col(f"row.`{c}`") for c in docs.columns if c not in ("lang_pred", "score")), "found.lang_pred", "found.score")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_mod(doc_id, 4) == 2, F.lit(False))


def op10_language(docs: DataFrame) -> DataFrame:
    """The registered query: learns from the rows that are not held out, predicts every row."""
    docs = docs.select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: Below this posterior probability a language is taken as not recognised.
MIN_SCORE = 0.5


def keep_recognised(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Drops documents without a recognised language; the columns stay as they are."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    # the names of what is added must not clash with columns of the input
    plain = docs.select(F.struct(*docs.columns).alias("row"), "text")
    kept = identify(plain, model).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
    return kept.select("row.*")
