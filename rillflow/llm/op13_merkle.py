"""Merkle manifest of a table: a tree of digests per group, a tree over the groups, and a proof for every row.

A row's leaf is the SHA-256 of its fields.  Leaves of a group are numbered in the order of their ids (a range sort and the
counts of its partitions, so a group that holds most rows is still many tasks).  ``levels`` then goes up one level at a time:
an index is divided by the fan-out, the children of a run are gathered in order (``fanout`` of them at most) and their
digests hashed into the parent; a level of a group has a ``fanout``-th of the rows of the one below, so all levels together
are a small multiple of the leaves.  ``proofs`` goes down the same tables: every level joins the nodes with what was gathered
above them and adds the siblings before and behind each child, so a leaf's proof grows by one entry per level and no level
but the last has as many rows as there are leaves.  The subroots, in the order of their groups, are the leaves of the upper
tree and go through the same two functions.

Defined results: null fields are ``-``; a null group is the first group, null ids come first in theirs; rows that repeat an
id are leaves of their own, ordered by their digest; a lone leaf is its group's subroot and a lone subroot the root; an empty
table gives no rows; other columns, also those named like a result, are ignored.  A row with a null id is never tampered with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.network import ranked
from .util import at_most, crc_mod, written

#: Fixed by the contract: nodes of a run, and what a leaf is made of.
FANOUT = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Groups up to this number are broadcast to the rows.
BROADCAST_ROWS = 100_000
#: So many levels of proofs are joined before the lineage is cut.
CUT_LEVELS = 6
PATH = "array<struct<before:binary,after:binary>>"


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def leaf(fields: dict[str, Column]) -> Column:
    """The digest of a row's fields: each ``-``, or its length in bytes, a colon and its text."""
    text = {name: c.cast("string") for name, c in fields.items()}
    return digest(F.concat(*(F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in text.values())))


def levels(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Tables (g, i, n, h, kids) from the leaves (g, i, n, h) up: node i of the n that group g has at a level, its digest and
    the digests of its children.  A group ends with its level of one node."""
    out = [leaves]
    left = leaves.agg(F.max("n")).first()[0] or 0
    while left > 1:
        runs = out[-1].where("n > 1").groupBy("g", F.expr(f"i div {fanout}").alias("i")).agg(F.ceil(F.max("n") / fanout).alias("n"), F.sort_array(F.collect_list(F.struct("i", "h"))).alias("run"))
        kids = runs.select("g", "i", "n", F.transform("run", lambda x: x["h"]).alias("kids"))
        out.append(written(kids.select("g", "i", "n", digest(F.array_join(F.transform("kids", hexed), "")).alias("h"), "kids")))
        left = -(-left // fanout)
    return out


def subroots(tables: list[DataFrame]) -> DataFrame:
    """(g, h): the one node that each group ends with."""
    out = None
    for t in tables:
        one = t.where("n = 1").select("g", "h")
        out = one if out is None else out.unionByName(one)
    return out


def proofs(tables: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(g, i, path) of every leaf: per level, from the leaf up, the digests before and behind it in its run."""
    joined = lambda part: F.aggregate(part, F.lit(b""), lambda a, x: F.concat(a, x))
    paths = None
    for k in range(len(tables) - 1, -1, -1):
        tops = tables[k].where("n = 1").select("g", "i", F.array().cast(PATH).alias("path"))
        if paths is None:
            paths = tops
            continue
        met = paths.join(tables[k + 1].select("g", "i", "kids"), ["g", "i"]).select("g", "i", "path", "kids", F.posexplode("kids").alias("at", "_"))
        beside = F.struct(joined(F.slice("kids", F.lit(1), F.col("at"))).alias("before"), joined(F.slice("kids", F.col("at") + 2, F.size("kids"))).alias("after"))
        paths = tops.unionByName(met.select("g", (F.col("i") * fanout + F.col("at")).alias("i"), F.concat(F.array(beside), "path").cast(PATH).alias("path")))
        if k % CUT_LEVELS == CUT_LEVELS - 1:
            paths = written(paths)
    return paths


def folded(start: Column, path: Column) -> Column:
    """The root, in hex, that a digest in hex and its proof lead to."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(hexed(s["before"]), acc, hexed(s["after"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(hexed(s["before"]), hexed(s["after"]))), "").cast("binary"), 256)


def manifest(rows: DataFrame, group: str, order: str, fanout: int = FANOUT, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Adds (subroot, root, path) to rows with a digest ``h``; ``path`` leads from the row over its subroot to the root."""
    # numbered once, so that copies of one row are spread over the sorted ranges too
    numbered = written(rows.withColumn("_row", F.monotonically_increasing_id()))
    numbered = ranked(numbered, [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first(), F.col("h"), F.col("_row")], "_rank")
    groups = written(numbered.groupBy(F.col(group).alias("_group")).agg(F.min("_rank").alias("g"), F.count(F.lit(1)).alias("n")))
    few = at_most(groups, broadcast_rows)
    placed = written(numbered.join(F.broadcast(groups) if few else groups, F.col(group).eqNullSafe(F.col("_group"))).withColumn("i", F.col("_rank") - F.col("g")).drop("_row", "_rank", "_group"))
    lower = levels(placed.select("g", "i", "n", "h"), fanout)
    # a group's number is the rank of its first row, so the order of numbers is the order of groups
    ends = ranked(subroots(lower), [F.col("g")], "i").select(F.col("g").alias("of"), F.lit(0).alias("g"), (F.col("i") - 1).alias("i"), F.lit(groups.count()).cast("long").alias("n"), "h")
    ends = written(ends)
    upper = levels(ends.select("g", "i", "n", "h"), fanout)
    root = subroots(upper).select(F.col("h").alias("root"))  # one row
    tops = ends.select("of", "i", F.col("h").alias("subroot")).join(proofs(upper, fanout).select("i", F.col("path").alias("above")), "i").crossJoin(F.broadcast(root)).select(F.col("of").alias("g"), "subroot", "root", "above")
    found = placed.join(proofs(lower, fanout), ["g", "i"]).join(F.broadcast(tops) if few else tops, "g")
    return found.select(*rows.columns, "subroot", "root", F.concat("path", "above").alias("path"))


def op13_merkle(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    fields = {c: F.col(c) for c in FIELDS}
    forged = F.when(crc_mod(F.col("doc_id"), 7) == 0, leaf(fields | {"n_chars": F.col("n_chars") + 1}))
    rows = docs.select("doc_id", "lang", leaf(fields).alias("h"), forged.alias("forged"))
    out = manifest(rows, "lang", "doc_id", fanout)
    out = out.select("doc_id", hexed(F.col("h")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), folded(hexed(F.coalesce("forged", "h")), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = r"""
WITH RECURSIVE items AS (
  SELECT doc_id, lang, n_chars,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents
), plain AS (
  SELECT *, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || body) AS leaf,
         sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || body) AS forged
  FROM items
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM plain
), tree AS (
  SELECT 0 AS depth, g, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT depth + 1, g, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY depth, g, i // 2
), subroots AS (
  SELECT g AS i, count(*) OVER () AS n, h FROM tree WHERE n = 1
), crown AS (
  SELECT 0 AS depth, i, n, h FROM subroots
  UNION ALL
  SELECT depth + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY depth, i // 2
), starts AS (
  SELECT row_number() OVER () AS row, doc_id, leaf, g, i, n,
         CASE WHEN xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END))) % 7 = 0
           THEN forged ELSE leaf END AS start
  FROM placed
), up AS (
  SELECT row, 0 AS depth, g, i, n, start AS acc, '' AS sibs FROM starts
  UNION ALL
  SELECT row, w.depth + 1, w.g, w.i // 2, (w.n + 1) // 2, sha256(CASE WHEN w.i % 2 = 1 THEN s.h || acc ELSE acc || coalesce(s.h, '') END), sibs || coalesce(s.h, '')
  FROM up w LEFT JOIN tree s ON s.depth = w.depth AND s.g = w.g AND s.i = xor(w.i, 1) WHERE w.n > 1
), top AS (
  SELECT row, 0 AS depth, g AS i, (SELECT count(*) FROM subroots) AS n, acc, sibs FROM up WHERE n = 1
  UNION ALL
  SELECT row, w.depth + 1, w.i // 2, (w.n + 1) // 2, sha256(CASE WHEN w.i % 2 = 1 THEN s.h || acc ELSE acc || coalesce(s.h, '') END), sibs || coalesce(s.h, '')
  FROM top w LEFT JOIN crown s ON s.depth = w.depth AND s.i = xor(w.i, 1) WHERE w.n > 1
)
SELECT doc_id, leaf, r.h AS subroot, c.h AS root, sha256(sibs) AS proof_sha256, acc AS folded_root, acc = c.h AS verified
FROM starts JOIN top USING (row) JOIN subroots r ON r.i = starts.g JOIN (SELECT h FROM crown WHERE n = 1) c ON true
WHERE top.n = 1
"""
