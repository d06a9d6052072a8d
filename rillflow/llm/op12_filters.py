"""Interaction audit of document filters: what each filter removes under every order in which the filters may run.

A document's failures are a mask of one bit per filter, so a part of the corpus is fully described by the counts of its cells
(2^5 masks), summed up with partial counts before the shuffle.  ``walk`` visits all orders by swaps of neighbours (one swap
from each order to the next): a swap changes what the two swapped steps see and nothing else, so only those two are computed
anew from the cells, and the sums over all orders (Shapley) are added up along the walk, for a filter whenever it moves.

The texts are read once; what is kept of a document is its id, its mask, and the SHA-256 and length that tell equal texts.
Texts that several rows have are found by partial minima per digest; they are joined back broadcast up to ``BROADCAST_ROWS``
of them, beyond it with the rows of a text dealt in slices.

Defined results: a null text is empty; a null id is not smaller than any other and no id is smaller than it, so rows with null
ids never fail E and make no other row fail it; equal ids are not smaller than each other; of a label's repeated rows one that
says 1 is enough, null labels and documents without one are not 1; a null language and an empty one are the part ''; each row
counts, also those that repeat an id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import at_most, ship, written

#: Fixed by the contract: the filters, in the order of the mask's bits, and their limits.
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PCT, MAX_UPPER_PCT, SYMBOLS = 100, 80, 10, r"[#$%&*|]"
BROADCAST_ROWS = 300_000
#: Tasks among which the rows of one text are dealt in a larger join.
SLICES = 32
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in COUNTS)}"


def failures(text: Column, words: Column) -> list[Column]:
    """Of a text and its words, whether it fails A to D."""
    n = F.size(words)
    return [
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PCT * n,
        100 * F.octet_length(F.regexp_replace(text, "[^A-Z]+", "")) > MAX_UPPER_PCT * F.length(text),
        text.rlike(SYMBOLS),
    ]


def with_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, sha, n) without the bit of E."""
    whole = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = whole.withColumn("words", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    bits = [c.cast("int") * (1 << k) for k, c in enumerate(failures(F.col("text"), F.col("words")))]
    return split.select("doc_id", "part", reduce(lambda a, b: a + b, bits).alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"), F.octet_length("text").alias("n"))


def with_copies(rows: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Sets the bit of E where an equal text has a smaller id."""
    texts = rows.groupBy("sha", "n").agg(F.min("doc_id").alias("least"), F.count("doc_id").alias("k"))
    several = written(texts.where("k > 1").drop("k"))
    if at_most(several, broadcast_rows):
        met = rows.join(F.broadcast(several), ["sha", "n"], "left")
    else:
        dealt = several.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
        met = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))).join(dealt, ["sha", "n", "slice"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return met.select("doc_id", "part", (F.col("mask") + copy.cast("int") * (1 << FILTERS.index("E"))).alias("mask"))


def with_labels(rows: DataFrame, labels: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Adds ``good`` and ``toxic`` (0 or 1)."""
    said = labels.where("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id").agg(*(F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))))
    said = F.broadcast(said) if at_most(said, broadcast_rows) else said
    known = rows.where("doc_id is not null").join(said, "doc_id", "left")
    flags = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    return known.select("part", "mask", *flags).unionByName(rows.where("doc_id is null").select("part", "mask", *(F.lit(0).alias(c) for c in ("good", "toxic"))))


def swaps(n: int) -> Iterator[int]:
    """The left places of the neighbours to swap, one after the other, to visit all orders of n things once: the last thing
    runs through the others to and fro, and at each end the others take one step of their own walk."""
    if n < 2:
        return
    inner = swaps(n - 1)
    for k in range(factorial(n - 1)):
        down = k % 2 == 0
        yield from reversed(range(n - 1)) if down else range(n - 1)
        if k + 1 < factorial(n - 1):
            yield next(inner) + down


def walk(counts: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: str = FILTERS) -> list[tuple]:
    """(order, step, *COUNTS) of all orders from the cells: documents, good and toxic ones per mask."""
    k = len(filters)
    masks = np.arange(1 << k)
    failing = [int(counts[masks >> f & 1 == 1].sum()) for f in range(k)]

    def seen(before: int, f: int) -> tuple[int, ...]:
        """What filter f does behind those of a mask."""
        here = (masks >> f & 1 == 1) & (masks & before == 0)
        removed = int(counts[here].sum())
        return int(counts[masks & (before | 1 << f) == 0].sum()), removed, failing[f] - removed, int(counts[1 << f]), int(good[here].sum()), int(toxic[here].sum())

    order, before, out = list(range(k)), [(1 << s) - 1 for s in range(k)], []
    steps = [seen(b, f) for b, f in zip(before, order, strict=True)]
    total, since, visits = [0] * k, [0] * k, 0

    def settle(s: int) -> None:
        """Adds up what the filter of a step has removed in the orders since it moved."""
        f = order[s]
        total[f] += steps[s][1] * (visits - since[f])
        since[f] = visits

    for at in (*swaps(k), None):
        name = "".join(filters[f] for f in order)
        out += [(name, s + 1, *steps[s], order[s]) for s in range(k)]
        visits += 1
        if at is not None:
            settle(at), settle(at + 1)
            order[at], order[at + 1] = order[at + 1], order[at]
            before[at + 1] = before[at] | 1 << order[at]
            for s in (at, at + 1):
                steps[s] = seen(before[s], order[s])
    for s in range(k):
        settle(s)
    return [(*row[:-1], total[row[-1]]) for row in out]


def audit(cells: DataFrame) -> DataFrame:
    """The audit of (part, mask, n, good, toxic): a group has 2^5 rows at most."""

    def of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cell = np.zeros((3, 1 << len(FILTERS)), np.int64)
        cell[:, rows["mask"]] = rows[["n", "good", "toxic"]].to_numpy().T
        return pd.DataFrame([(key[0], *r) for r in walk(*cell)], columns=["part", "filter_order", "step", *COUNTS])

    ship(cells.sparkSession)
    return cells.groupBy("part").applyInPandas(of, RESULT)


def op12_filters(docs: DataFrame, labels: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    rows = written(with_masks(docs.select("doc_id", "lang", "text")))
    masked = with_labels(with_copies(rows, broadcast_rows), labels.select("doc_id", "quality", "toxic"), broadcast_rows)
    return audit(masked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")))


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), said AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), docs AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(t.doc_id > least, false)::INT AS mask
  FROM texts t LEFT JOIN said s ON s.doc_id = t.doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM docs GROUP BY part, mask
), letters AS (
  SELECT unnest([0, 1, 2, 3, 4]) AS f, unnest(['A', 'B', 'C', 'D', 'E']) AS name
), orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.f, b.f, c.f, d.f, e.f] AS fs
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, s AS step, fs[s] AS f, (1 << fs[s]) AS bit,
         coalesce(list_sum(list_transform(fs[1:s - 1], lambda f: 1 << f)), 0)::BIGINT AS before
  FROM orders, range(1, 6) r(s)
), met AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM steps, cells GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM met
"""
