"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Words become template tokens: a number is ``<num>``, a word of ``UNITS`` behind a number is ``<unit>``, a capitalised
word inside a sentence is ``<name>`` (one for a name of two words, told by the first), and any other word is itself in
lower case: number words and a name that begins a sentence too.  A comma between groups of three digits belongs to the
number.  Windows of ``WINDOW`` tokens are
hashed and joined with the windows of the benchmark, so a question asked again with other numbers, names or units
still matches.  What the placeholders stood for is then compared: a slot value of the item must map to one value
of the document, and distinct numbers to distinct numbers, else the match is a coincidence of templates and is
dropped.  This is tested for each place where the item may stand: every alignment (the window's place in the document
less that in the item) by itself, the alignments of a stretch as long as the item together, so that a copy with words
put in or left out stays whole, and all of the document together.  The item is found if any of them passes.
Windows with fewer than ``MIN_LITERALS`` literal words are too common as templates, so they must match with the
values of their slots.

Each document is canonicalised once, and its windows of all wanted lengths are joined with the distinct templates of the
benchmark, however many items share one.  Items are then proposed by their rarest windows, and the places of an item
are attached only for the documents where it may be found.  Templates are broadcast only if there are at most
``BROADCAST_ROWS`` of them, and are otherwise joined by shuffling in slices.  A window travels as a 64-bit hash and the
few values of its slots, so texts are read once and never shuffled.  Most windows have no slots: a byte per word tells
which have, and only their values are collected.

An item is found in a document by ``MIN_WINDOWS`` consistent windows or by ``MIN_SHARE`` of the item's windows.  Items
shorter than a window are matched as one window of their own length, and items of fewer than ``MIN_LITERALS`` words
word by word: an item of one word is found wherever that word stands.

Defined results: null and empty texts and items match nothing; items that repeat are each reported; rows that repeat a
document id are one document; a null document or item id is ignored.  Extra columns are ignored by ``leaks`` and kept
by ``without_leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import at_most, written

WINDOW = 8
MIN_LITERALS = 4
MIN_WINDOWS = 3
MIN_SHARE = 0.5
#: The share of slot pairs that must follow one mapping of values.
MIN_AGREEMENT = 0.8
BROADCAST_ROWS = 500_000
#: Tasks among which the rows of one key are dealt in a join by shuffling.
SLICES = 16
#: Units that become a placeholder behind a number.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "mg", "g", "gram", "grams", "kg", "ton", "tons",
    "pound", "pounds", "lb", "lbs", "oz", "ounce", "ounces", "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "cup", "cups",
    "second", "seconds", "sec", "minute", "minutes", "min", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "dollar", "dollars", "cent", "cents", "euro", "euros", "usd", "eur", "percent", "degree", "degrees", "kmh", "mph", "kb", "mb", "gb",
)
_NAME = "\u0001"


def words_of(text: Column) -> Column:
    """The words of a text; a capitalised word inside a sentence is marked."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?=\p{Lu})(?<=[\p{Ll}\p{N},;]\s)", _NAME)
    parts = F.split(marked, r"[^\u0001\p{L}\p{M}\p{N}.,]+|[.,](?:(?!\p{N})|(?<!\p{N}[.,])|(?<=,)(?!\p{N}{3}(?!\p{N})))")
    return F.filter(parts, lambda w: w != "")


def _is_number(w: Column) -> Column:
    return F.ascii(w).between(48, 57)


def templates(rows: DataFrame, keys: list[str], text: str, with_own: bool = True) -> DataFrame:
    """(keys, hashes, values, slotted, own): per word the hash of its template token, and what a placeholder stood for (else null).

    ``slotted`` has a byte per word, 1 for a placeholder.  ``own`` has the hash of every word in lower case, for what is
    matched word by word, and is null if it isn't wanted.  Each step is a projection of its
    own that names the arrays of the step before more than once, so that the optimizer doesn't inline an array into a
    lambda, where it would be computed anew for every word.
    """
    units = F.array(*map(F.lit, UNITS))

    def token(w: Column, i: Column) -> Column:
        return (
            F.when(F.ascii(w) == 1, "<name>")
            .when(_is_number(w), "<num>")
            .when(_is_number(F.get("words", i - 1)) & F.array_contains(units, F.lower(w)), "<unit>")
            .otherwise(F.lower(w))
        )

    every = rows.select(*keys, words_of(F.col(text)).alias("words"))
    is_name = lambda i: F.coalesce(F.ascii(F.get("words", i)) == 1, F.lit(False))
    second = lambda i: is_name(i - 1) & ~is_name(i - 2) & ~is_name(i + 1)
    own = F.transform("words", lambda w: F.xxhash64(F.lower(F.ltrim(w, F.lit(_NAME))))) if with_own else F.lit(None).cast("array<bigint>")
    words = every.select(*keys, F.filter("words", lambda w, i: (F.ascii(w) != 1) | ~second(i)).alias("words"), own.alias("own"))
    tokens = words.select(*keys, "own", "words", F.transform("words", token).alias("tokens"))
    slot = lambda t: F.ascii(t) == ord("<")
    value = F.zip_with("words", "tokens", lambda w, t: F.when(slot(t), F.concat(t, F.translate(F.lower(w), ",", ""))))
    slotted = F.array_join(F.transform("tokens", lambda t: F.when(slot(t), "1").otherwise("0")), "").cast("binary")
    return tokens.select(*keys, F.transform("tokens", lambda t: F.xxhash64(t)).alias("hashes"), value.alias("values"), slotted.alias("slotted"), "own")


def windows(rows: DataFrame, keys: list[str], min_literals: int) -> DataFrame:
    """(keys, at, h, slots) for every window of ``len`` words: its place, its hash, its placeholders' values.

    With too few literals the values are part of the hash; windows of fewer than ``min_literals`` words are those of
    ``own``, which has no placeholders.
    """
    short = F.col("len") < min_literals
    none = F.expr("cast(repeat('0', len) as binary)")
    rows = rows.select(*keys, "len", F.when(short, F.col("own")).otherwise(F.col("hashes")).alias("hashes"), F.when(~short, F.col("values")).alias("values"), "slotted", none.alias("none"))
    n = F.size("hashes") - F.col("len") + 1
    has_slots = lambda i: F.substring("slotted", i + 1, F.col("len")) != F.col("none")
    slots = F.transform("places", lambda i: F.when(~short & has_slots(i), F.filter(F.slice("values", i + 1, F.col("len")), lambda v: v.isNotNull())))
    rows = rows.select(*keys, "len", "hashes", "values", "slotted", "none", F.when(n > 0, F.sequence(F.lit(0), n - 1)).alias("places"))
    rows = rows.select(*keys, "len", "hashes", "places", slots.alias("slots"))

    def window(i: Column, s: Column) -> Column:
        h = F.xxhash64(F.slice("hashes", i + 1, F.col("len")))
        return F.when(F.coalesce(F.size(s) > F.col("len") - min_literals, F.lit(False)), F.xxhash64(h, s)).otherwise(h)

    rows = rows.select(*keys, "slots", F.zip_with("places", "slots", window).alias("h"))
    # a window takes its slots from the row's after the explode, where none is copied; of a bare column the optimizer would
    # infer a filter, which computes all arrays anew
    out = rows.select(*keys, "slots", F.posexplode(F.when(F.size("h") > 0, F.col("h"))).alias("at", "h"))
    return out.select(*keys, "at", "h", F.coalesce(F.get("slots", F.col("at")), F.array().cast("array<string>")).alias("slots"))


def _matched(rows: DataFrame, few: DataFrame, on: str, dealt_by: str, broadcast_rows: int) -> DataFrame:
    """``rows`` joined with ``few`` by ``on``.

    ``few`` is broadcast up to so many rows.  Beyond them its rows are there once per slice and the rows of one key are dealt
    to the slices, so that a common template or item is never one task's.
    """
    if at_most(few, broadcast_rows):
        return rows.join(F.broadcast(few), on)
    sliced = few.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    return rows.withColumn("_s", F.pmod(F.xxhash64(dealt_by), F.lit(SLICES)).cast("int")).join(sliced, [on, "_s"]).drop("_s")


def proposers(of_items: DataFrame, totals: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(h, item_id): the windows by which an item is looked for.

    An item found has hits at ``need`` of its places, so of any ``places - need + 1`` of them one is hit.  Those whose
    templates the fewest items share are taken: what is common to the items of a frame proposes none of them.
    """
    shared = of_items.groupBy("h").agg(F.count_distinct("item_id").alias("n"))
    places = _matched(of_items, shared, "h", "item_id", broadcast_rows).groupBy("item_id", "at").agg(F.max("n").alias("n"))
    rarest = places.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("n", "at"))).alias("places"))  # as many as an item has words
    rarest = rarest.join(totals, "item_id").select("item_id", F.explode(F.slice("places", F.lit(1), F.greatest(F.size("places") - F.col("need") + 1, F.lit(0)).cast("int"))).alias("p"))
    return of_items.join(rarest.select("item_id", F.col("p.at").alias("at")), ["item_id", "at"]).select("h", "item_id").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_windows: int = MIN_WINDOWS, min_share: float = MIN_SHARE, min_literals: int = MIN_LITERALS, broadcast_rows: int = BROADCAST_ROWS, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, n_slots): one row per document and the item found in it."""
    item_texts = benchmark.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    doc_texts = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # an item that is short without the second words of its names is matched word by word
    items = templates(item_texts, ["item_id"], "text").withColumn("len", F.least(F.size("hashes"), F.lit(window)))
    items = items.withColumn("len", F.when(F.col("len") < min_literals, F.least(F.size("own"), F.lit(min_literals - 1))).otherwise(F.col("len")))
    size = F.when(F.col("len") < min_literals, F.size("own")).otherwise(F.size("hashes"))
    items = written(items.withColumn("size", size).where("len > 0"))
    lengths = sorted(r.len for r in items.select("len").distinct().collect())  # at most ``window`` values
    if not lengths:
        kinds = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, item_id {benchmark.schema[item_id].dataType.simpleString()}, n_windows long, item_windows long, n_slots long"
        return docs.sparkSession.createDataFrame([], kinds)
    totals = items.select("item_id", "size", (F.col("size") - F.col("len") + 1).cast("long").alias("item_windows")).groupBy("item_id").agg(F.max("size").alias("size"), F.max("item_windows").alias("item_windows"))
    totals = written(totals.withColumn("need", F.greatest(F.least(F.lit(min_windows), F.ceil(min_share * F.col("item_windows"))), F.lit(1))))
    of_items = written(windows(items, ["item_id"], min_literals))
    # each document is canonicalised once, and the windows of all lengths are cut from that
    rows = templates(doc_texts, ["doc_id"], "text", with_own=lengths[0] < min_literals).withColumn("len", F.explode(F.array(*map(F.lit, lengths))))
    hits = written(_matched(windows(rows, ["doc_id"], min_literals), of_items.select("h").distinct(), "h", "doc_id", broadcast_rows))
    # items are attached to documents that hit one of their rarest windows, and only then to all hits of such pairs
    pairs = written(_matched(hits.select("doc_id", "h").distinct(), proposers(of_items, totals, broadcast_rows), "h", "doc_id", broadcast_rows).select("doc_id", "item_id").distinct())
    wanted = _matched(pairs, of_items.select("item_id", "h", F.col("at").alias("i_at"), F.col("slots").alias("i_slots")), "item_id", "doc_id", broadcast_rows)
    found = written(wanted.join(hits.withColumnRenamed("slots", "d_slots"), ["doc_id", "h"]))  # read twice below
    # each hit belongs to its alignment, to the two stretches of the item's length that hold it, and to the document
    shift, size = F.col("at") - F.col("i_at"), F.col("size")
    places = F.array(*(F.struct(F.lit(scope).alias("scope"), place.cast("long").alias("place")) for scope, place in enumerate((shift, F.floor(shift / size), F.floor(shift / size + 0.5), F.lit(0)))))
    found = found.join(totals, "item_id").select("doc_id", "item_id", F.explode(places).alias("p"), "i_at", "i_slots", "d_slots")
    group = ["doc_id", "item_id", "scope", "place"]
    found = found.select("doc_id", "item_id", "p.scope", "p.place", "i_at", "i_slots", "d_slots")
    # slots: values that map to more than one value, either way, contradict each other
    pairs = found.select(*group, F.explode(F.arrays_zip("i_slots", "d_slots")).alias("s")).select(*group, F.col("s.i_slots").alias("i"), F.col("s.d_slots").alias("d"))
    tally = pairs.groupBy(*group, "i", "d").agg(F.count(F.lit(1)).alias("n"))
    one_way = lambda side: tally.groupBy(*group, side).agg(F.max("n").alias("most"), F.sum("n").alias("all")).groupBy(*group).agg(F.sum("most").alias(f"agree_{side}"), F.sum("all").alias(f"n_{side}"))
    slots = one_way("i").join(one_way("d"), group).select(*group, F.least("agree_i", "agree_d").alias("agree"), F.col("n_i").alias("n_slots"))
    counts = found.groupBy(*group).agg(F.count_distinct("i_at").alias("n_windows"))
    joined = counts.join(slots, group, "left").join(totals, "item_id")
    consistent = F.coalesce(F.col("agree") >= MIN_AGREEMENT * F.col("n_slots"), F.lit(True))
    enough = (F.col("n_windows") >= min_windows) | (F.col("n_windows") >= min_share * F.col("item_windows"))
    # of the places that pass, the one with the most windows and, of equal ones, the most slots
    best = joined.where(consistent & enough).groupBy("doc_id", "item_id").agg(F.max(F.struct("n_windows", "item_windows", F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"))).alias("best"))
    return best.select("doc_id", "item_id", "best.n_windows", "best.item_windows", "best.n_slots")


def op01_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Drops the documents that hold a benchmark item; the columns stay as they are."""
    found = leaks(docs.select("doc_id", "text"), benchmark.select("item_id", "text")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
