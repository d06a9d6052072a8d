"""Decontamination against a plain version of templates, slots and places; a frame shared by many items."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from math import floor

import regex
from conftest import SMALL

from rillflow.llm import op01_decontamination as op01
from rillflow.llm.util import table

KIND = "doc_id long, text string"
ITEM = "item_id long, text string"
MARK = "\u0001"


def plain_words(text: str | None) -> list[str]:
    marked = regex.sub(r"(?<=[\p{Ll}\p{N},;][ \t\n\r\f\v])(?=\p{Lu})", MARK, text or "")
    return [w for w in regex.split(r"[^\u0001\p{L}\p{M}\p{N}.,]+|[.,](?!\p{N})|(?<!\p{N})[.,]|,(?!\p{N}{3}(?!\p{N}))", marked) if w]


def plain_template(text: str | None) -> tuple[list[str], list[str | None], list[str]]:
    words = plain_words(text)
    own = [w.lstrip(MARK).lower() for w in words]
    name = [w.startswith(MARK) for w in words]
    at = lambda i: 0 <= i < len(words) and name[i]
    words = [w for i, w in enumerate(words) if not (name[i] and at(i - 1) and not at(i - 2) and not at(i + 1))]
    tokens, values = [], []
    for before, w in zip(["", *words], words):
        number, unit = "0" <= w[0] <= "9", bool(before) and "0" <= before[0] <= "9" and w.lower() in op01.UNITS
        token = "<name>" if w.startswith(MARK) else "<num>" if number else "<unit>" if unit else w.lower()
        tokens.append(token)
        values.append(token + w.lower().replace(",", "") if token.startswith("<") else None)
    return tokens, values, own


def plain_windows(tokens, values, own, length):
    if length < op01.MIN_LITERALS:
        return [(tuple(own[i : i + length]), ()) for i in range(len(own) - length + 1)]
    out = []
    for i in range(len(tokens) - length + 1):
        slots = tuple(v for v in values[i : i + length] if v is not None)
        key = tuple(tokens[i : i + length])
        out.append((key if len(slots) <= length - op01.MIN_LITERALS else (key, slots), slots))
    return out


def agreement(pairs: list[tuple[str, str]], side: int) -> int:
    seen = defaultdict(Counter)
    for pair in pairs:
        seen[pair[side]][pair] += 1
    return sum(max(c.values()) for c in seen.values())


def plain_leaks(docs, items):
    out = {}
    texts = {d: plain_template(t) for d, t in docs}
    for item, text in items:
        of_item = plain_template(text)
        length, size = min(len(of_item[0]), op01.WINDOW), len(of_item[0])
        if length < op01.MIN_LITERALS:
            length, size = min(len(of_item[2]), op01.MIN_LITERALS - 1), len(of_item[2])
        if not length:
            continue
        where = defaultdict(list)
        for i, (key, slots) in enumerate(plain_windows(*of_item, length)):
            where[key].append((i, slots))
        total = size - length + 1
        for doc, own in texts.items():
            groups = defaultdict(list)
            for at, (key, slots) in enumerate(plain_windows(*own, length)):
                for i, i_slots in where.get(key, ()):
                    shift = at - i
                    for scope, place in enumerate((shift, floor(shift / size), floor(shift / size + 0.5), 0)):
                        groups[scope, place].append((i, i_slots, slots))
            best = None
            for found in groups.values():
                n = len({i for i, _, _ in found})
                pairs = [p for _, a, b in found for p in zip(a, b)]
                agree = min(agreement(pairs, 0), agreement(pairs, 1)) if pairs else 0
                if agree >= op01.MIN_AGREEMENT * len(pairs) and (n >= op01.MIN_WINDOWS or n >= op01.MIN_SHARE * total):
                    best = max(best or (0, 0, 0), (n, total, len(pairs)))
            if best:
                out[doc, item] = best
    return out


def found(df) -> dict:
    return {(r.doc_id, r.item_id): (r.n_windows, r.item_windows, r.n_slots) for r in df.collect()}


def test_plain_version_of_the_tables(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    items = table(spark, SMALL, "benchmark").select("item_id", "text")
    want = plain_leaks(docs.collect(), items.collect())
    assert want and found(op01.leaks(docs, items)) == want


def made(rng: random.Random) -> tuple[list, list]:
    """Items of a few frames, short and long, and documents that hold them whole, torn, with other values, or in parts."""
    frames = ["the tank of {n} loses {a} cups each hour and then loses {b} cups each hour until it is empty", "how many km does {n} walk in {a} days and {b} hours", "add {a} and {b}", "{a}", "what is {a} * {b} - {a} + {b} / 7 - 3 ?", "please name the river of {n} Vale now"]
    fill = lambda f: f.format(n=rng.choice(["Ann", "Bob", "Cid"]), a=rng.randint(2, 9), b=rng.randint(10, 1200))
    items = [(i, fill(frames[i % len(frames)])) for i in range(24)]
    docs = []
    for d in range(120):
        parts = []
        for _ in range(rng.randint(1, 4)):
            words = (rng.choice(items)[1] if rng.random() < 0.5 else fill(rng.choice(frames))).split()
            if rng.random() < 0.4:
                words.insert(rng.randrange(len(words)), "really")
            if rng.random() < 0.3:
                words = words[: rng.randint(1, len(words))]
            parts.append(" ".join(words))
        docs.append((d, ". Nothing of the kind stands here, he said; ".join(parts)))
    return docs, items


def test_plain_version_of_made_items(spark):
    docs, items = made(random.Random(5))
    want = plain_leaks(docs, items)
    rows, benchmark = spark.createDataFrame(docs, KIND), spark.createDataFrame(items, ITEM)
    assert {i % 6 for _, i in want} == set(range(6))  # items of every frame are found
    assert found(op01.leaks(rows, benchmark)) == want
    assert found(op01.leaks(rows, benchmark, broadcast_rows=0)) == want  # in slices, by shuffles


def test_a_frame_of_many_items(spark):
    """1,000 items begin alike.  A text with the frame alone proposes none of them, one with an item only that item."""
    frame = "please tell us the exact value of the quantity"
    items = [(i, f"{frame} w{i}a w{i}b w{i}c w{i}d w{i}e") for i in range(1000)]
    benchmark = spark.createDataFrame(items, ITEM)
    docs = spark.createDataFrame([(d, f"{frame} that stands in line of text") for d in range(50)] + [(99, f"He said {items[7][1]}. Then")], KIND)
    of_items = op01.windows(op01.templates(benchmark, ["item_id"], "text").selectExpr("*", "8 as len"), ["item_id"], op01.MIN_LITERALS)
    totals = of_items.groupBy("item_id").count().selectExpr("item_id", "count as item_windows", "3 as need")
    by = op01.proposers(of_items, totals)
    shared = of_items.groupBy("h").count().where("count > 1").select("h")
    assert shared.count() == 2 and by.join(shared, "h").count() == 0
    assert by.count() == 1000 * (7 - 3 + 1 - 0)
    assert found(op01.leaks(docs, benchmark)) == {(99, 7): (7, 7, 0)}


def test_names_of_two_words_in_short_items(spark):
    benchmark = spark.createDataFrame([(1, "ask Anna Bell now")], ITEM)
    docs = spark.createDataFrame([(1, "so ask Anna Bell now"), (2, "so ask Carl Bell now"), (3, None)], KIND)
    assert set(found(op01.leaks(docs, benchmark))) == {(1, 1)}


def test_windows_collect_the_values_of_their_slots_only(spark):
    texts = [(1, "a b c d e f g h i j"), (2, "we sold 4 cups to Ann Lee and 5 to Bob , 3 4 5 6 7 8 9 1,000 km"), (3, "one two"), (4, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = op01.templates(docs, ["doc_id"], "text", with_own=False)
    assert all(r.own is None for r in rows.select("own").collect())
    values = {r.doc_id: r["values"] for r in rows.collect()}
    assert all(bytes(r.slotted).decode() == "".join("01"[v is not None] for v in values[r.doc_id]) for r in rows.collect())
    found = op01.windows(rows.selectExpr("*", "8 as len"), ["doc_id"], op01.MIN_LITERALS).collect()
    wanted = {(i, at): [x for x in v[at : at + 8] if x is not None] for i, v in values.items() for at in range(len(v) - 7)}
    assert {(r.doc_id, r["at"]): r.slots for r in found} == wanted
    assert any(len(x) > 4 for x in wanted.values()) and any(not x for x in wanted.values())
