"""SimHash near-duplicates with pivot distance tables.

``fingerprints`` hashes the 4-word shingles of every whole text to 64 bits.  Documents with equal fingerprints form
one class, and only classes are compared.  Fingerprints that differ in at most 4 bits agree on at least 2 of 6 blocks
of bits, so 15 block keys propose every pair to verify.  Each fingerprint carries its row of the pivot table - the
precomputed Hamming distances to ``N_PIVOTS`` reference fingerprints - and by the triangle inequality a pair whose
rows differ by more than 4 in any coordinate is discarded; the rest is verified bit by bit.  (Pivot rows alone can't
propose pairs in less than quadratic time: distances between 64-bit fingerprints crowd around 32, so one coordinate
lets more than half of all pairs through.)

Partitions sorted by block key are streamed in Arrow batches, and what leaves a task is a spanning forest of its
links, not all pairs.  A bucket over ``MAX_BUCKET`` classes is not compared pair by pair: fingerprints at most 4 bits
apart share a midpoint at most 2 bits from either, and all that share a midpoint are at most 4 bits apart, so
grouping by the 2,081 midpoints of each member links them exactly, without pairs.

Components are found by alternating large-star and small-star steps on tables written to the shared folder.

Defined results: a text without words (null, empty, white space) has the fingerprint zero and is linked like any
other; fewer words than a shingle give one shingle; repeated rows belong to one class; a null id is never a component
id unless its component has no other.  Extra columns are ignored by ``components`` and kept by ``keep_one``.

``keep_one`` also takes a Jaccard similarity of 5-word shingles (``alike``), since 4 of 64 bits reach only about 0.96.
There too the SimHash of the set of shingles comes first: classes of equal fingerprints, block keys, pivot rows, bits and
components as above, and each component is a bucket, the first one of its members.  At 0.8 about 10 bits differ, which
no block keys propose without proposing most of all pairs, so minhashes propose what is left:
``BANDS`` keys of ``ROWS`` minhashes each put a pair of similarity s in one bucket with probability 1 - (1 - s^4)^16,
which is 0.9998 at 0.8 and grows with s.  A bucket is one unit of work for one task; a bucket over ``UNIT`` members is dealt
in parts, and each pair of parts is a unit, so that no task holds more than two parts.  Within a unit signatures discard
pairs that are far below the similarity, pairs already linked are left out, and the exact similarity decides the rest;
what leaves a task is a spanning forest of its links.  Members of dealt buckets are compared with two of their bucket
first, so that a crowd of near copies is one component before parts are paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import at_most, per_core, ship, written

WORDS, SEED, MAX_BITS = 4, 42, 4
#: From so many fingerprints on, the 64 bits are cut into so many blocks, of which MAX_BITS may differ: more blocks make
#: wider keys (21, 27, 32 and 35 bits) and more of them (15, 35, 70, 126 a fingerprint).
CUTS = ((0, 6), (1 << 24, 7), (1 << 30, 8), (1 << 36, 9))
N_PIVOTS = 8
MAX_BUCKET = 4096
#: Tables of at most so many rows of a few numbers are broadcast.
BROADCAST_ROWS = 500_000
#: The similarity of the pipeline's near copies.
SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 4
UNIT = 1024
_TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SLICE = 1 << 15
_MULTIPLY, _ADD = np.array([xxhash.xxh64_intdigest(f"minhash {i}".encode(), SEED) for i in range(2 * BANDS * ROWS)], np.uint64).reshape(2, -1)


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TO_LOWER).split()


def shingles(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of the shingles, in order."""
    tokens = _tokens(text)
    n = max(1, len(tokens) - words + 1) if tokens else 0
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(tokens[i : i + words]), SEED) for i in range(n)], np.uint64))


def _ones(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, the highest one first."""
    return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def _majority(ones: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def set_fingerprint(own: np.ndarray) -> int:
    """The fingerprint of a set of shingles, each counted once; of the empty set it is zero."""
    return _majority(sum((_ones(own[at : at + _SLICE]) for at in range(0, len(own), _SLICE)), np.zeros(64, np.int64)), len(own))


def minhashes(own: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 2048):
        h = own[at : at + 2048, None] * (_MULTIPLY | np.uint64(1)) + _ADD
        least = np.minimum(least, (h ^ (h >> np.uint64(32))).min(axis=0))
    return least


def band_keys(least: np.ndarray, bands: int = BANDS) -> list[int]:
    """One signed 64-bit key per band of minhashes."""
    return [signed(xxhash.xxh64_intdigest(bytes([k]) + least[k * ROWS : (k + 1) * ROWS].tobytes(), SEED)) for k in range(bands)]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as an unsigned integer."""
    tokens = _tokens(text)
    if not tokens:
        return 0
    n = max(1, len(tokens) - words + 1)
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(words, len(tokens)) - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        ones += _ones(np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at : at + _SLICE], ends[at : at + _SLICE], strict=True)], ">u8"))
    return _majority(ones, n)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), of(F.col(text)).alias("fp"))


def pivots(n: int = N_PIVOTS) -> list[int]:
    """The reference fingerprints: the hashes of their own numbers."""
    return [xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(n)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_row(fp: Column) -> Column:
    """The row of the pivot table, one byte a coordinate."""
    parts = [F.lpad(F.hex(F.bit_count(fp.bitwiseXOR(F.lit(signed(p)))).cast("long")), 2, "0") for p in pivots()]
    return F.unhex(F.concat(*parts))


def blocks(n: int) -> tuple[tuple[int, int], ...]:
    """(first bit, width) of n blocks of the 64 bits."""
    edges = [64 * k // n for k in range(n + 1)]
    return tuple((a, b - a) for a, b in zip(edges, edges[1:]))


def block_keys(fp: Column, n_blocks: int, max_bits: int = MAX_BITS) -> Column:
    """The keys that fingerprints at most ``max_bits`` apart share at least one of: all choices of the blocks left equal."""
    keys = []
    for k, chosen in enumerate(combinations(blocks(n_blocks), n_blocks - max_bits)):
        mask = signed(sum(((1 << width) - 1) << at for at, width in chosen))
        keys.append(F.xxhash64(F.lit(k), fp.bitwiseAND(F.lit(mask))))
    return F.array(*keys)


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _linked(keys: np.ndarray, fps: np.ndarray, table: np.ndarray, max_bits: int) -> np.ndarray:
    """Pairs (i, j) of rows with equal key (keys are sorted) that differ in few bits."""
    found, left = [], np.arange(len(keys))
    for step in range(1, len(keys)):
        left = left[left + step < len(keys)]
        left = left[keys[left] == keys[left + step]]
        if not len(left):
            break
        near = left[(np.abs(table[left] - table[left + step]) <= max_bits).all(axis=1)]
        near = near[np.bitwise_count(fps[near] ^ fps[near + step]) <= max_bits]
        found.append(np.stack((near, near + step), axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def links(classes: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints ``classes.fp`` that have the components of all links."""
    n = classes.count()
    n_blocks = max(max_bits + 2, max(k for least, k in CUTS if n >= least))
    keyed = classes.select("fp", pivot_row(F.col("fp")).alias("pivots"), F.explode(block_keys(F.col("fp"), n_blocks, max_bits)).alias("key"))
    keyed = keyed.repartition(per_core(classes.sparkSession), "key").sortWithinPartitions("key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, over = _Forest(), []

        def take(keys: np.ndarray, fps: np.ndarray, table: np.ndarray) -> None:
            _, at, n = np.unique(keys, return_index=True, return_counts=True)
            small = np.repeat(n <= max_bucket, n)
            over.append(np.unique(fps[~small]))
            keys, fps, table = keys[small], fps[small], table[small]
            for i, j in _linked(keys, fps.view(np.uint64), table, max_bits):
                forest.link(int(fps[i]), int(fps[j]))

        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            table = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, N_PIVOTS).astype(np.int16)
            keys = batch.column(2).to_numpy(zero_copy_only=False)
            held.append((keys, fps, table))
            if held[0][0][0] == keys[-1]:
                if sum(len(h[0]) for h in held) > 4 * max_bucket:  # far over: its members need not stay together
                    over.extend(np.unique(h[1]) for h in held)
                    held = [tuple(np.concatenate([x[k][: max_bucket + 1] for x in held])[: max_bucket + 1] for k in range(3))]
                continue
            keys, fps, table = (np.concatenate([h[k] for h in held]) for k in range(3))
            cut = int(np.searchsorted(keys, keys[-1]))
            take(keys[:cut], fps[:cut], table[:cut])
            held = [(keys[cut:], fps[cut:], table[cut:])]
        if held:
            take(*(np.concatenate([h[k] for h in held]) for k in range(3)))
        a = np.array(list(forest.up), np.int64)
        b = np.array([forest.root(int(x)) for x in a], np.int64)
        large = np.unique(np.concatenate(over)) if over else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate((a, large)), pa.int64()), "b": pa.array(np.concatenate((b, large)), pa.int64())})

    found = written(keyed.mapInArrow(compare, "a long, b long"))
    crowded = found.where(F.col("a") == F.col("b")).select(F.col("a").alias("fp")).distinct()
    return found.where(F.col("a") != F.col("b")).union(by_midpoint(crowded, max_bits // 2))


def by_midpoint(fps: DataFrame, radius: int) -> DataFrame:
    """Links among ``fps.fp``, exact for twice the radius: every midpoint's members are tied to the smallest one."""
    masks = [signed(sum(1 << i for i in bits)) for r in range(radius + 1) for bits in combinations(range(64), r)]
    near = fps.select("fp", F.explode(F.array(*map(F.lit, masks))).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("mid"))
    least = near.groupBy("mid").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("mid", "b")
    return near.join(least, "mid").where("fp != b").select(F.col("fp").alias("a"), "b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(a, b): every node that isn't the smallest of its component, with the smallest one."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    state = None
    while True:
        # large star: each node's larger neighbours are tied to the smallest of its neighbourhood
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # small star: each node and its smaller neighbours are tied to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = written(small.where("a != b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges
        state = now


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) for every row."""
    prints = written(fingerprints(docs, doc_id, text, words))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected(links(classes.select("fp"), max_bits, max_bucket))
    rooted = classes.join(roots, classes["fp"] == roots["a"], "left").select("fp", "least", F.coalesce("b", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(smallest, "root").select(F.col("fp").alias("c_fp"), "component_id")
    return prints.join(of_class, F.col("fp") == F.col("c_fp")).select("doc_id", "fp", "component_id")


def op09_simhash(docs: DataFrame) -> DataFrame:
    out = components(docs.select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The rows of each run of equal values in the first column, as columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        units = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(units[1:] != units[:-1]) + 1).tolist(), len(units)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[0].column(0)[0] != batch.column(0)[a]:
                yield pa.Table.from_batches(held).to_pydict()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).to_pydict()


_UNIT = "unit long, side int, band int, h long, root long, keys array<long>, sig binary, text string"


def _compare(unit: dict[str, list], similarity: float, words: int) -> list[tuple[int, int]]:
    """Links of one unit.  Side 0 is compared with side 1, rows of side 2 with each other."""
    sides, keys, h, root = np.array(unit["side"]), np.array(unit["keys"], np.int64).reshape(len(unit["h"]), -1), unit["h"], unit["root"]
    sig = np.frombuffer(b"".join(unit["sig"]), np.uint8).reshape(len(h), -1)
    roots = np.array(root, np.int64)
    left, right = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
    if not len(left) or not len(right):
        return []
    band, width = unit["band"][0], sig.shape[1]
    # four standard deviations below what a pair of the similarity has in common
    need = int(similarity * width - 4.1 * (width * similarity * (1 - similarity)) ** 0.5)
    sets: dict[int, frozenset] = {}
    own = lambda i: sets[i] if i in sets else sets.setdefault(i, frozenset(shingles(unit["text"][i], words).tolist()))
    forest, found = _Forest(), []
    step = max(1, (1 << 24) // (len(right) * width))
    for at in range(0, len(left), step):
        rows = left[at : at + step]
        agree = (sig[rows][:, None, :] == sig[right][None]).sum(axis=2)
        i, j = np.nonzero((agree >= need) & (roots[rows][:, None] != roots[right][None]))
        agree, i, j = agree[i, j], rows[i], right[j]
        once = np.ones(len(i), bool) if sides[0] != 2 else i < j
        if band > 0:  # pairs that an earlier bucket holds are decided there
            once &= ~(keys[i, :band] == keys[j, :band]).any(axis=1)
        agree, i, j = agree[once], i[once], j[once]
        for k in np.argsort(-agree, kind="stable"):
            a, b = int(i[k]), int(j[k])
            if forest.root(root[a]) == forest.root(root[b]):
                continue
            x, y = own(a), own(b)
            if min(len(x), len(y)) < similarity * max(len(x), len(y)):
                continue
            both = len(x & y)
            if both >= similarity * (len(x) + len(y) - both):
                forest.link(root[a], root[b])
                found.append((h[a], h[b]))
    return found


def alike(docs: DataFrame, similarity: float = SIMILARITY, words: int = SHINGLE, doc_id: str = "doc_id", text: str = "text", unit: int = UNIT, bands: int = BANDS) -> DataFrame:
    """(doc_id, component_id) for every row: components of the pairs whose sets of shingles are at least so similar.

    Without ``bands`` only the components of the fingerprints are compared.
    """
    spark = docs.sparkSession
    ship(spark)
    n = per_core(spark)

    @F.pandas_udf("h long, fp long, keys array<long>, sig binary")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        own = [shingles(t, words) for t in texts]
        least = [minhashes(x) for x in own]
        return pd.DataFrame({"h": [signed(xxhash.xxh64_intdigest(x.tobytes(), SEED)) for x in own], "fp": np.array([set_fingerprint(x) for x in own], np.uint64).view(np.int64), "keys": [band_keys(x, bands) for x in least], "sig": [x.astype(np.uint8).tobytes() for x in least]})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches):
            if found := _compare(rows, similarity, words):
                yield pa.RecordBatch.from_pydict({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("s", sketch("text"))
    rows = written(rows.select("doc_id", "text", "s.h", "s.fp", "s.keys", "s.sig"))
    # equal sets of shingles are one class
    classes = written(rows.groupBy("h").agg(F.min("doc_id").alias("least"), F.first("fp").alias("fp"), F.first("keys").alias("keys"), F.first("sig").alias("sig")))
    # the components of the fingerprints are the first buckets
    near = connected(links(classes.select("fp").distinct())).select(F.col("a").alias("fp"), F.col("b").alias("near"))
    near = classes.join(F.broadcast(near) if at_most(near, BROADCAST_ROWS) else near, "fp", "left")
    classes = written(near.select("h", "least", F.concat(F.array(F.xxhash64(F.lit("simhash"), F.coalesce("near", "fp"))), "keys").alias("keys"), "sig"))
    keyed = classes.select("h", F.posexplode("keys").alias("band", "key"))
    buckets = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min_by("h", F.xxhash64(F.lit(0), "h")).alias("m0"), F.min_by("h", F.xxhash64(F.lit(1), "h")).alias("m1")).where("n > 1"))
    # a large bucket's members would be one task's in a join by key, so the few large buckets are joined apart
    large = buckets.where(F.col("n") > unit)
    few = at_most(large, BROADCAST_ROWS)
    large = F.broadcast(large) if few else large
    in_large = keyed.join(large, "key")
    in_small = (keyed.join(large.select("key"), "key", "left_anti") if few else keyed).join(buckets.where(F.col("n") <= unit), "key")

    def linked(members: DataFrame) -> DataFrame:
        """The links among members (unit, side, band, h, root)."""
        wanted = written(members.select("h").distinct())
        if at_most(wanted, BROADCAST_ROWS):
            texts = rows.join(F.broadcast(wanted), "h", "left_semi").groupBy("h").agg(F.first("text").alias("text"))
        else:  # equal sets are combined before the join, so that none crowds a task
            texts = rows.groupBy("h").agg(F.first("text").alias("text")).join(wanted, "h", "left_semi")
        full = members.join(texts, "h").join(classes.select("h", "keys", "sig"), "h")
        dealt = full.select(*(x.split()[0] for x in _UNIT.split(", "))).repartition(n, "unit").sortWithinPartitions("unit")
        return written(dealt.mapInArrow(compare, "a long, b long"))

    found = None
    parts = F.ceil(F.col("n") / unit).cast("int")
    part = F.pmod(F.xxhash64(F.lit("part"), "h"), parts).cast("int")
    member = lambda key, side: (key.alias("unit"), F.lit(side).alias("side"), "band", "h")
    if not large.isEmpty():
        # each part with two members of the bucket
        own = in_large.select(*member(F.xxhash64("key", part), 0))
        middles = large.select(F.explode(F.sequence(F.lit(0), parts - 1)).alias("p"), "key", F.explode(F.array("m0", "m1")).alias("h"))
        middles = middles.select(F.xxhash64("key", "p").alias("unit"), F.lit(1).alias("side"), F.lit(0).alias("band"), "h").distinct()
        found = linked(own.withColumn("band", F.lit(0)).unionByName(middles).withColumn("root", F.col("h")))
    roots = connected(found).select(F.col("a").alias("h"), F.col("b").alias("root")) if found is not None else None
    rooted = lambda df: df.join(roots, "h", "left").withColumn("root", F.coalesce("root", "h")) if roots is not None else df.withColumn("root", F.col("h"))
    members = in_small.select(*member(F.col("key"), 2))
    if found is not None:
        # the large buckets that still hold several components, in pairs of parts
        left = written(rooted(in_large))
        mixed = left.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
        left = left.join(F.broadcast(mixed) if few else mixed, "key", "left_semi").withColumn("p", part)
        left = left.withColumn("q", F.explode(F.sequence(F.lit(0), parts - 1)))
        pair = F.xxhash64("key", F.least("p", "q"), F.greatest("p", "q"))
        side = F.when(F.col("p") == F.col("q"), 2).when(F.col("p") < F.col("q"), 0).otherwise(1)
        members = members.unionByName(left.select(pair.alias("unit"), side.alias("side"), "band", "h"))
    more = linked(rooted(members))
    roots = connected(more if found is None else found.union(more))
    of_class = classes.join(roots, classes["h"] == roots["a"], "left").select("h", "least", F.coalesce("b", "h").alias("root"))
    smallest = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = of_class.join(smallest, "root").select("h", "component_id")
    return rows.select("doc_id", "h").join(of_class, "h").select("doc_id", "component_id")


def keep_one(docs: DataFrame, similarity: float | None = None) -> DataFrame:
    """One document of each component stays, the one with the smallest id; the columns stay as they are.

    The components are those of the fingerprints, or with a ``similarity`` those of ``alike``.  Rows without an id
    stay.  Rows that repeat the id that stays are all that id's document and stay too.
    """
    own = docs.select("doc_id", "text")
    found = components(own) if similarity is None else alike(own, similarity)
    stay = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(stay, "doc_id", "left_semi").select(*docs.columns)
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
