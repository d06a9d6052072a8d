"""Line dedup with DataFrame functions only.

Every document is split at line feeds; the key of a line is the line without ASCII white space at its ends and
with A-Z in lower case, and travels as two independent 64-bit hashes.  The rows (hash, document, position) are written
once, narrow; they are then range-partitioned by (hash, document) and sorted by (hash, document, position), so a key that
stands in a third of all documents is spread over many partitions.  In that order a key's first occurrence in a document is
the row without a row of the same key and document before it; the stream of first occurrences is counted per key, with
partial counts before the shuffle.  The frequent keys are broadcast only up to ``BROADCAST_ROWS`` of them, and beyond
that joined with the rows dealt by (key, slice of the documents), so that a hot key is never one task's.
``keep_bitmaps`` returns, per document, the dropped lines as runs [first, last] - the compressed form of a keep bitmap -
instead of text; ``apply_bitmaps`` rewrites the texts in time linear in their lines.

Defined results: a null or empty text is one empty line; a key shorter than ``min_chars`` code points is never
dropped; a key is counted once per document id, and rows that repeat an id and text are rewritten alike; rows with a
null id count as one document and are told apart by their text only.  With ``keep_first`` a frequent key's first line
(that of the smallest id) stays.  A document that loses all its lines keeps the empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import at_most, per_core, written

#: Fixed by the contract: the shortest key that can be dropped, and the documents that must hold it.
MIN_CHARS, MIN_DOCS = 1, 10
BROADCAST_ROWS = 500_000
#: Slices of the documents in a join with more frequent keys than that.
SLICES = 32
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, doc_id: str = "doc_id", text: str = "text", keep_first: bool = False, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_hash, dropped_runs array<struct<first,last>>) of the documents that lose lines."""
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.posexplode(F.transform(lines_of(F.col(text)), key_of)).alias("pos", "key"),
    ).where(F.length("key") >= min_chars)
    hashed = written(keyed.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), F.col("key")).alias("h2")))
    order = ["h1", "h2", "doc_id"]
    stream = hashed.select(*order, "pos").repartitionByRange(per_core(docs.sparkSession), *order).sortWithinPartitions(*order, "pos")
    firsts = stream.withColumn("before", F.lag("pos").over(Window.partitionBy(*order).orderBy("pos"))).where("before is null")
    counts = firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("doc_id", "pos")).alias("first"))
    frequent = written(counts.where(F.col("n_docs") >= min_docs).select("h1", "h2", *(["first"] if keep_first else [])))
    if at_most(frequent, broadcast_rows):
        gone = hashed.join(F.broadcast(frequent), ["h1", "h2"])
    else:
        dealt = hashed.withColumn("slice", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SLICES)))
        gone = dealt.join(frequent.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1)))).withColumn("slice", F.col("slice").cast("long")), ["h1", "h2", "slice"])
    if keep_first:
        gone = gone.where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("pos") == F.col("first.pos"))))
    dropped = gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("d"))
    d = F.col("d")
    starts = F.filter(d, lambda x, i: (i == 0) | (F.get(d, i - 1) != x - 1))
    ends = F.filter(d, lambda x, i: (i == F.size(d) - 1) | (F.get(d, i + 1) != x + 1))
    return dropped.select("doc_id", "text_hash", F.arrays_zip(starts.alias("first"), ends.alias("last")).alias("dropped_runs"))


def dropped_positions(runs: Column) -> Column:
    return F.flatten(F.transform(runs, lambda r: F.sequence(r["first"], r["last"])))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, n_lines, n_dropped, kept): the input row as a struct, the lines before and dropped, the text that stays."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).withColumn("text_hash", F.xxhash64(f"row.`{text}`"))
    # the runs are the small side: hashed, so that the texts need no sort
    b = bitmaps.select(F.col("doc_id").alias("b_id"), F.col("text_hash").alias("b_hash"), "dropped_runs").hint("shuffle_hash")
    joined = rows.join(b, F.col(f"row.`{doc_id}`").eqNullSafe(F.col("b_id")) & F.col("text_hash").eqNullSafe(F.col("b_hash")), "left")
    whole = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    # columns of their own, each named more than once below, so that no lambda splits a text again for every line
    split = joined.select("row", whole.alias("whole"), lines_of(whole).alias("lines"), dropped_positions(F.col("dropped_runs")).alias("gone"))
    stay = split.select("row", "whole", "lines", "gone", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone").alias("stay"))
    kept = F.when(F.col("gone").isNull(), F.col("whole")).otherwise(F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n"))
    return stay.select("row", F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def op08_lines(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    out = apply_bitmaps(docs, keep_bitmaps(docs))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """Rewrites ``text`` (and ``n_chars``, where there is one); the columns stay as they are."""
    out = apply_bitmaps(docs, keep_bitmaps(docs))
    new = {"text": F.when(F.col("row.text").isNotNull(), F.col("kept")), "n_chars": F.when(F.col("n_dropped") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*((new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, i AS pos, parts[i] AS line,
         translate(regexp_replace(parts[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), flagged AS (
  SELECT l.*, f.key IS NOT NULL AS gone FROM lines l LEFT JOIN frequent f ON l.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""
