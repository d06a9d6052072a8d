"""Exact top-k inner products over a bit-sliced index.

A vector's components are whole numbers after quantisation.  ``index`` deals the vectors to blocks of ``BLOCK`` rows and turns
each block into bitmaps: slice b of component d has bit r set where bit b of row r's component is set (components are taken
above the block's minimum, so none is negative).  A query never looks at rows.  ``score_slices`` adds the slices of all
components, shifted by the bits of the query's weight (complemented where it is negative), with full adders of bitmaps: three
bitmaps of one significance become a sum and a carry, until one bitmap for each significance of the score is left.
``select_top`` goes through these from the most significant one: rows that have the bit while fewer than k do are in for sure,
rows without it leave once k have it; what is still undecided after the last slice has one score, and of these boundary
rows those with the smallest ids are taken, which are the first bits, since a block's rows lie in the order of ids.

The queries are unpacked from the index and meet it in units of ``STRIP`` blocks and up to ``QUERIES`` queries, so a task holds
a bounded part of either; a unit returns k rows per query, and a rank over the units' rows gives the final k.

Defined results: a vector that is null or holds a null or non-finite component takes no part; the product of vectors of
unequal length is that of their common part (0 for an empty one); every row is told by its place in the index, so equal rows,
also of the query's id, are candidates of each other; a null id is never a query and follows all ids in ties; fewer than k
candidates give all of them; an empty table gives no rows.  Vectors so large that a product could leave 63 bits are an error.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import per_core, ship, written

#: Fixed by the contract: the scale of quantisation, the results of a query, and which rows are queries.
SCALE, TOP, QUERY_EVERY = 64, 20, 20
#: Rows of a block; blocks and queries of a unit of work.
BLOCK, STRIP, QUERIES = 16_384, 8, 2_048
#: Units of work for each core at least, as long as they have LEAST queries.
UNITS_PER_CORE, LEAST = 8, 64
INDEX = "block long, n int, known int, dims int, width int, base binary, ids binary, slices binary"


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def whole(vector: Column) -> Column:
    """Whether all components are finite; null for a null vector."""
    return F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))


# --- a block --------------------------------------------------------------------------------------------------------


def matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of a list column, padded with 0 to the longest."""
    values, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    if (np.abs(out.astype(np.float64)).max(axis=1, initial=0) ** 2 * sizes >= 2.0**62).any():
        raise ValueError("a vector's components are too large for products of 63 bits")
    return out


def sliced(ids: list[int | None], values: np.ndarray) -> dict:
    """The block of rows with these ids and components."""
    order = sorted(range(len(ids)), key=lambda r: (ids[r] is None, ids[r] or 0))
    values = values[order]
    known = sum(i is not None for i in ids)
    base = values.min(axis=0)
    above = (values - base).T
    width = int(above.max(initial=0)).bit_length()
    words = -(-len(ids) // 64)
    bits = np.zeros((values.shape[1], width, words * 64), bool)
    for b in range(width):
        bits[:, b, : len(ids)] = above >> b & 1
    return {"n": len(ids), "known": known, "dims": values.shape[1], "width": width, "base": base.astype("<i8").tobytes(), "ids": np.array([ids[r] or 0 for r in order], "<i8").tobytes(), "slices": np.packbits(bits, axis=2, bitorder="little").tobytes()}


def unsliced(row: pd.Series) -> np.ndarray:
    """The components of a block's rows."""
    slices = np.frombuffer(row["slices"], np.uint8).reshape(row["dims"], row["width"], -(-row["n"] // 64) * 8)
    out = np.repeat(np.frombuffer(row["base"], "<i8")[:, None], row["n"], axis=1)
    for b in range(row["width"]):
        out += np.unpackbits(slices[:, b], axis=1, count=row["n"], bitorder="little").astype(np.int64) << b
    return out.T


def score_slices(slices: np.ndarray, inverse: np.ndarray, base: np.ndarray, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
    """The score of all rows of a block as bitmaps from the least significant one, and a constant to add to it."""
    dims, width, words = slices.shape
    weights = np.concatenate([weights[:dims], np.zeros(max(0, dims - len(weights)), np.int64)])
    below = weights < 0
    constant = int(weights @ base) + int(weights[below].sum()) * ((1 << width) - 1)
    columns: dict[int, list[np.ndarray]] = defaultdict(list)
    for sign, part in ((~below, slices), (below, inverse)):
        size = np.where(sign, np.abs(weights), 0)
        for w in range(int(size.max(initial=0)).bit_length()):
            has = np.flatnonzero(size >> w & 1)
            for b in range(width if len(has) else 0):
                columns[w + b].append(part[has, b])
    out: list[np.ndarray] = []
    while any(at >= len(out) for at in columns):
        at = len(out)
        stack = np.concatenate(columns.pop(at, [np.zeros((0, words), np.uint64)]))
        while (m := len(stack)) > 2:
            t = m // 3
            a, b, c = stack[:t], stack[t : 2 * t], stack[2 * t : 3 * t]
            x = a ^ b
            columns[at + 1].append(a & b | x & c)
            stack = np.concatenate([x ^ c, stack[3 * t :]])
        if m == 2:
            columns[at + 1].append((stack[0] & stack[1])[None])
            stack = (stack[0] ^ stack[1])[None]
        out.append(stack[0] if m else np.zeros(words, np.uint64))
    return out, constant


def places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def select_top(slices: list[np.ndarray], there: np.ndarray, k: int) -> np.ndarray:
    """The places of the k rows of ``there`` with the highest scores, of equal scores the first."""
    sure, edge, n = np.zeros_like(there), there, 0
    for s in reversed(slices):
        having = edge & s
        c = int(np.bitwise_count(having).sum())
        if n + c > k:
            edge = having
        else:
            sure, edge, n = sure | having, edge & ~s, n + c
    return np.concatenate([places(sure), places(edge)[: k - n]])


def scores_at(slices: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.int64)
    for k, s in enumerate(slices):
        out += (s[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << k
    return out


# --- Spark ----------------------------------------------------------------------------------------------------------


def index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK, scale: int = SCALE) -> DataFrame:
    """The blocks of all vectors, written once; a row per block."""
    ship(vectors.sparkSession)
    rows = vectors.where(whole(F.col(vector))).select(F.col(vec_id).cast("long").alias("vec_id"), quantised(F.col(vector), scale).alias("q"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, kept = TaskContext.get().partitionId(), 0, []

        def cut(table: pa.Table) -> pa.RecordBatch:
            nonlocal done
            row = sliced(table.column("vec_id").to_pylist(), matrix(table.column("q").combine_chunks()))
            done += 1
            return pa.RecordBatch.from_pylist([{"block": part << 32 | done - 1, **row}], schema)

        for batch in batches:
            kept.append(batch)
            while sum(map(len, kept)) >= block:
                table = pa.Table.from_batches(kept)
                yield cut(table.slice(0, block))
                kept = table.slice(block).to_batches()
        if sum(map(len, kept)):
            yield cut(pa.Table.from_batches(kept))

    schema = pa.schema([("block", pa.int64()), *((c, pa.int32()) for c in ("n", "known", "dims", "width")), *((c, pa.binary()) for c in ("base", "ids", "slices"))])
    # dealt in turns and not by a key, so that repeated ids crowd no block
    return written(rows.repartition(max(1, -(-rows.count() // block))).mapInArrow(build, INDEX))


def queries_of(blocks: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """(q_block, q_at, query_id, weights) of the index's rows with an id divisible by ``every``."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                ids = np.frombuffer(row["ids"], "<i8")[: row["known"]]
                at = np.flatnonzero(ids % every == 0)
                values = unsliced(row)[at].astype("<i8")
                yield pd.DataFrame({"q_block": row["block"], "q_at": at.astype(np.int32), "query_id": ids[at], "weights": [v.tobytes() for v in values]})

    return written(blocks.mapInPandas(unpack, "q_block long, q_at int, query_id long, weights binary"))


def top(blocks: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of the index with the highest products for each query, itself not
    among them."""
    spark = blocks.sparkSession
    n_blocks, n_queries = blocks.count(), queries.count()
    strips = max(1, -(-n_blocks // STRIP))
    most = max(1, -(-n_queries // LEAST))
    parts = max(-(-n_queries // QUERIES), min(most, -(-UNITS_PER_CORE * per_core(spark) // strips)), 1)

    def search(key: tuple, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        weights = [np.frombuffer(w, "<i8") for w in asked["weights"]]
        found: list[list[pd.DataFrame]] = [[] for _ in weights]
        for _, row in own.iterrows():
            slices = np.frombuffer(row["slices"], "<u8").reshape(row["dims"], row["width"], -(-row["n"] // 64))
            inverse, base, ids = ~slices, np.frombuffer(row["base"], "<i8"), np.frombuffer(row["ids"], "<i8")
            there = np.packbits(np.arange(slices.shape[2] * 64) < row["n"], bitorder="little").view("<u8")
            for j, (w, of, at) in enumerate(zip(weights, asked["q_block"], asked["q_at"], strict=True)):
                score, constant = score_slices(slices, inverse, base, w)
                others = there
                if of == row["block"]:
                    others = there.copy()
                    others[at >> 6] &= ~np.uint64(1 << (at & 63))
                best = select_top(score, others, k)
                found[j].append((scores_at(score, best) + constant, best >= row["known"], ids[best]))
        out = []
        for j, parts_of in enumerate(found):
            if parts_of:
                score, unknown, ids = (np.concatenate(x) for x in zip(*parts_of, strict=True))
                best = np.lexsort((ids, unknown, -score))[:k]
                out.append(pd.DataFrame({"q_block": asked["q_block"].iloc[j], "q_at": asked["q_at"].iloc[j], "query_id": asked["query_id"].iloc[j], "vec_id": pd.array(ids[best], "Int64"), "score": score[best]}))
                out[-1].loc[unknown[best], "vec_id"] = pd.NA
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("q_block", "q_at", "query_id", "vec_id", "score")})

    units, deal = strips * parts, ("strip", "part")
    left = blocks.withColumn("strip", F.pmod(F.xxhash64("block"), F.lit(strips))).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    right = queries.withColumn("part", F.pmod(F.xxhash64("q_block", "q_at"), F.lit(parts))).withColumn("strip", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(strips - 1).cast("long"))))
    # a number of partitions of its own: what is small in bytes is long in work, so none are to be put together
    met = left.repartition(units, *deal).groupBy(*deal).cogroup(right.repartition(units, *deal).groupBy(*deal))
    found = met.applyInPandas(search, "q_block long, q_at int, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("q_block", "q_at").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_topk(embeddings: DataFrame) -> DataFrame:
    blocks = index(embeddings)
    return top(blocks, queries_of(blocks))


ORACLE = """
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.row, a.vec_id AS query_id, b.vec_id, coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.row <> b.row WHERE a.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score FROM pairs
WINDOW best AS (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST)
QUALIFY row_number() OVER best <= 20
"""
