"""What a review asked for: occurrences, odd columns, forged digests, long documents, marked pages, plain fits."""

from __future__ import annotations

import math
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rillflow.llm import op01_decontamination as op01
from rillflow.llm import op02_bpe as op02
from rillflow.llm import op03_toxicity as op03
from rillflow.llm import op04_exact as op04
from rillflow.llm import op05_html as op05
from rillflow.llm import op06_tokens as op06
from rillflow.llm import op07_quality as op07
from rillflow.llm import op08_lines as op08
from rillflow.llm import op09_simhash as op09
from rillflow.llm import op10_language as op10
from rillflow.llm.util import scratch_dir, table

KIND = "doc_id long, text string"

# 1


def test_numbers_with_separators_and_names_of_two_words(spark):
    item = "In the second year the firm paid 1,040 dollars to Anna and then 2,500 dollars more for the new roof of the house"
    again = item.replace("1,040", "7300").replace("2,500", "12,600").replace("Anna", "John Smith")
    broken = item.replace("for the new roof of the house", "and nothing else was said by anybody there").replace("In the second year the firm", "Some")
    benchmark = spark.createDataFrame([(1, item)], "item_id int, text string")
    found = op01.leaks(spark.createDataFrame([(1, again), (2, f"Before. {again}. {item}. After"), (3, broken)], KIND), benchmark).collect()
    assert {1, 2} <= {r.doc_id for r in found}
    # one window has three literals, so it matches with its values only
    assert {r.doc_id: (r.n_windows, r.item_windows) for r in found}[1] == (15, 16)


# 3


def plain_fit(rows: list[tuple[str, int, int]]) -> tuple[dict, dict]:
    """The tables by definition from (text, label, fold)."""
    tokens, texts = Counter(), Counter()
    toxic_tokens, toxic_texts = Counter(), Counter()
    n_tokens = n_toxic = n_texts = n_toxic_texts = 0
    for text, label, _ in rows:
        words = Counter(op03.words_of(text))
        units = Counter()
        for w, k in words.items():
            units[True, w] += k
            if len(w) >= op03.PREFIX:
                units[False, w[: op03.PREFIX]] += k
        for u, k in units.items():
            tokens[u] += k
            texts[u] += 1
            toxic_tokens[u] += k * label
            toxic_texts[u] += label
        n_tokens, n_toxic = n_tokens + sum(words.values()), n_toxic + label * sum(words.values())
        n_texts, n_toxic_texts = n_texts + 1, n_toxic_texts + label
    base, text_base, p = n_toxic / n_tokens, n_toxic_texts / n_texts, op03.PRIOR
    logit = lambda x: math.log(x / (1 - x))
    rate = lambda u, parent: (toxic_tokens[u] + p * parent) / (tokens[u] + p)
    out = ({}, {})
    for u in tokens:
        if toxic_texts[u] < op03.MIN_TOXIC:
            continue
        is_word, key = u
        parent = rate((False, key[: op03.PREFIX]), base) if is_word and len(key) >= op03.PREFIX else base
        odds = logit(rate(u, parent)) - logit(base)
        t, n = toxic_texts[u], texts[u]
        z = (logit((t + p * text_base) / (n + p)) - logit(text_base)) / math.sqrt(1 / (t + p * text_base) + 1 / (n - t + p * (1 - text_base)))
        if odds >= op03.MIN_LOG_ODDS and z >= op03.MIN_Z:
            out[0 if is_word else 1][key] = odds
    return out


def test_toxicity_fit_and_scores_by_definition(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "labels").select("doc_id", "toxic")
    rows = op03.labelled_rows(docs, labels, "toxic", op03.held_out(F.col("doc_id")), op03.MAX_TRAIN_ROWS)
    plain = {}
    for r in rows.collect():
        assert zlib.crc32(str(r.doc_id).encode()) % 3 != 1
        plain[r.text] = max(plain.get(r.text, 0), r.toxic)
    model = op03.fit(rows)
    words, prefixes = plain_fit([(t, y, 0) for t, y in plain.items() if t is not None])
    assert set(model.words) == set(words) and set(model.prefixes) == set(prefixes)
    assert all(math.isclose(model.words[w], words[w], rel_tol=1e-9) for w in words)
    some = docs.limit(50)
    for r in op03.score(some.withColumn("score", F.lit("clash")), model).collect():
        tokens = [words.get(w, prefixes.get(w[:4], op03.CLEAN_TOKEN) if len(w) > 3 else op03.CLEAN_TOKEN) - op03.DRIFT for w in op03.words_of(r.text)]
        floor = math.log(max(model.k * len(tokens), 1e-9)) if tokens else 0
        x = sum(max(0.0, model.lam * s - floor) for _, _, s in op03.segments(tokens))
        assert math.isclose(r.score, model.floor + (1 - model.floor) / (1 + math.exp(-model.offset - model.slope * x)), rel_tol=1e-9)


def test_extreme_values_are_found_again():
    rng = np.random.default_rng(5)
    m = rng.integers(50, 800, 20_000).astype(float)
    best = np.log(0.01 * m / -np.log(rng.random(len(m)))) / 0.8  # P(best <= s) = exp(-K m exp(-lambda s))
    lam, k = op03.extreme_value_fit(np.maximum(best, 0), m)
    assert abs(lam - 0.8) < 0.03 and abs(k - 0.01) < 0.001


def test_one_tokeniser_for_marks():
    assert op03.words_of("हिन्दी नहीं café a_b") == ["हिन्दी", "नहीं", "café", "a_b"]


def test_null_ids_and_repeated_rows_are_scored(spark):
    rows = spark.createDataFrame([(None, "vile"), (1, "vile"), (1, "vile")], KIND)
    assert op03.op03_toxicity(rows, spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, toxic int")).count() == 3


# 4


def test_forged_digests(spark):
    forged = lambda text: F.unhex(F.concat(F.lit("00" * 31), F.when(text.startswith("x"), "01").otherwise("00")))
    texts = ["ab", "cd", "ab", "ef", "cd", "cd", "xy", "gh", "xz", "xy", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), KIND)
    wanted = {}
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if (u or "") == (t or "")]
        wanted[i] = (min(same), len(same))
    for how in ("doc_id % 2 = 0", "doc_id < 0", "doc_id >= 0", "doc_id < 4"):
        for rows in (op04.BROADCAST_ROWS, 0):
            out = op04.dedup(docs, F.expr(how), scratch_dir(spark), broadcast_rows=rows, digest=forged)
            assert {r.doc_id: (r.keep_id, r.group_size) for r in out.collect()} == wanted, (how, rows)


def test_large_batch_into_an_empty_snapshot_and_one_that_lasts(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    path = scratch_dir(spark)
    op04.write_snapshot(docs.where("false"), path)
    empty = op04.open_snapshot(spark, path)
    found = op04.classes(empty, op04.digests(docs), shard_keys=5)
    assert {r.group_size for r in found.collect()} == {n for n in Counter(op04_norm(r.text) for r in docs.collect()).values() if n > 1}
    lasting = scratch_dir(spark)
    op04.write_snapshot(docs, lasting, shard_keys=20)
    again = op04.open_snapshot(spark, lasting)
    screened = op04.screen(op04.grouped(op04.digests(docs), "sha", "n"), again, shard_keys=20)
    assert screened.where("not maybe").isEmpty()


def op04_norm(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_null_and_repeated_ids(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "a"), (5, "b"), (None, "b"), (5, "b"), (7, "b")], KIND)
    out = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in op04.op04_exact(rows).collect()), key=str)
    assert out == sorted([(None, None, 2, True), (None, None, 2, True), (5, 5, 4, True), (5, 5, 4, True), (None, 5, 4, False), (7, 5, 4, False)], key=str)


# 5

_SENTENCES = (
    "The river rises in the hills above the town and runs for many miles through woods and fields before it meets the sea.",
    "Nobody had expected the old bridge to last so long, yet it stood through every flood of the last two hundred years.",
    "In autumn the water carries leaves and branches down to the mill, where the children wait for them with long sticks.",
)
_NAV = "<nav><ul><li><a href=/>Home</a><li><a href=/news>News</a><li><a href=/about>About us</a></ul></nav>"
_SIDE = "<div class='sidebar widget-area'><h3>Popular</h3><ul>" + "".join(f"<li><a href=/p{i}>Popular story number {i}</a></li>" for i in range(8)) + "</ul></div>"
_COMMENTS = "<div id=comments><h3>Comments</h3>" + "".join(f"<div class=comment><p>Reader {i} says that this was quite a good read, thanks a lot for it.</p></div>" for i in range(4)) + "</div>"
_FOOT = "<footer><p>Copyright 2024 by the paper. All rights reserved, of course.</p></footer>"
_COOKIE = "<div class='cookie-notice'>We use cookies to make this site better for you. <button>Accept</button></div>"
_AD = "<div class='ad-slot'><p>Buy our new shoes today, they are cheaper than ever before and last longer.</p></div>"


def _body(k: int) -> tuple[list[str], str]:
    paragraphs = [f"{_SENTENCES[(k + i) % 3]} {_SENTENCES[(k + i + 1) % 3]}" for i in range(3 + k % 3)]
    return [f"Title of story {k}", *paragraphs], f"<h1>Title of story {k}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)


LAYOUTS = {
    "article": lambda b: f"<header>The Paper</header>{_NAV}<main><article>{b}</article></main>{_SIDE}{_FOOT}",
    "plain divs": lambda b: f"<div class=top>{_NAV}</div><div id=content>{b}</div>{_FOOT}",
    "has-sidebar": lambda b: f"<div class='site has-sidebar'>{_NAV}<div class=content>{b}</div>{_SIDE}</div>",
    "no-comments": lambda b: f"<div class='post no-comments'>{b}</div>{_FOOT}",
    "form wrapper": lambda b: f"<form id=aspnetForm action=/><header>The Paper</header>{_NAV}<div>{b}</div>{_FOOT}</form>",
    "open head": lambda b: f"{b}",
    "comments": lambda b: f"{_NAV}<article>{b}</article>{_COMMENTS}",
    "notices": lambda b: f"{_COOKIE}<div class=page><div class=body>{b}</div>{_AD}</div>{_FOOT}",
    "table": lambda b: f"<table><tr><td>{_SIDE}</td><td>{b}</td></tr></table>",
    "deep": lambda b: f"{'<div>' * 40}{b}{'</div>' * 40}{_SIDE}",
}


def test_marked_pages():
    hit = found = wanted = 0
    for name, layout in LAYOUTS.items():
        for k in range(3):
            blocks, body = _body(k)
            head = f"<html><head><title>{k}</title><script>var x = '<p>no</p>'</script>" + ("" if name == "open head" else "</head><body>")
            text = op05.main_text(head + layout(body) + ("" if name == "open head" else "</body>") + "</html>")
            got = text.split("\n\n") if text else []
            both = Counter(got) & Counter(blocks)
            hit, found, wanted = hit + sum(len(x) * n for x, n in both.items()), found + sum(map(len, got)), wanted + sum(map(len, blocks))
            assert set(blocks[1:]) <= set(got), (name, k)
    assert hit / found >= 0.95 and hit / wanted >= 0.95


@pytest.mark.parametrize("tags", ["<div>", "<b>", "<p><table>", "<li><ul>", "<span><p>"])
def test_deep_pages_in_linear_time(tags):
    began = time.perf_counter()
    op05.main_text(tags * 5_000 + "deep")
    small = time.perf_counter() - began
    began = time.perf_counter()
    assert op05.main_text(tags * 50_000 + "deep") == "deep"
    assert time.perf_counter() - began < 30 * small + 1


def test_odd_pages(spark):
    rows = spark.createDataFrame([(1, "<p>one", "x", 1), (1, "<p>one", "x", 1), (2, None, None, 2), (3, "x" * 2_000_000, "y", 3)], "page_id long, html string, text string, n_chars int")
    out = op05.extract(rows)
    assert out.columns == ["page_id", "text", "n_chars"] and sorted(r.n_chars for r in out.collect()) == [0, 3, 3, 2_000_000]


# 2, 6, 7, 10: clashing names, null ids, repeated rows


def test_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "the house is big", "a", "b", "c", "d"), (None, None, "a", "b", "c", "d"), (1, "the house is big", "a", "b", "c", "d")], KIND + ", n_tokens string, score string, _t string, _w string")
    counted = op06.count_tokens(rows, ["▁the", "▁", "h", "o", "u", "s", "e", "i", "b", "g"])
    assert counted.count() == 3 and sorted(counted.select("n_tokens").toPandas()["n_tokens"]) == [0, 14, 14]
    named = op10.identify(rows, op10.Model(["en"], np.zeros(1), np.zeros((16, 1), np.float32)))
    assert sorted(r.score for r in named.select("score").collect()) == [0.0, 1.0, 1.0]
    scored = op07.score(rows, op07.Model(0.0))
    assert {r._t for r in scored.collect()} == {"c"} and {r.score for r in scored.collect()} == {0.5}
    assert op02.op02_bpe(rows).count() == 3


# 8


def test_lines_in_linear_time_and_long_documents(spark):
    def took(n: int) -> float:
        rows = spark.createDataFrame([(i, "\n".join(["hot", *(f"{i} line {k}" for k in range(n))])) for i in range(12)], KIND).cache()
        bits = op08.keep_bitmaps(rows).cache()
        assert bits.count() == 12
        began = time.perf_counter()
        out = op08.apply_bitmaps(rows, bits).agg(F.sum("n_dropped"), F.sum(F.length("kept"))).first()
        assert out[0] == 12 and out[1] > 0
        return time.perf_counter() - began

    took(100)
    short, long = took(4_000), took(100_000)
    assert long < 25 * 2 * short + 2


def test_lines_of_null_ids_and_first_ones(spark):
    rows = spark.createDataFrame([(None, "hot\nx")] * 3 + [(i, f"hot\nown {i}\nHOT") for i in range(10)], KIND)
    kept = {r.row.doc_id: r.kept for r in op08.apply_bitmaps(rows, op08.keep_bitmaps(rows)).collect()}
    assert kept[0] == "own 0" and kept[None] == "x"
    first = {r.row.doc_id: r.kept for r in op08.apply_bitmaps(rows.where("doc_id is not null"), op08.keep_bitmaps(rows.where("doc_id is not null"), keep_first=True)).collect()}
    assert first[0] == "hot\nown 0" and first[1] == "own 1"
    joined = op08.keep_bitmaps(rows, broadcast_rows=0)
    assert sorted(str(r) for r in joined.collect()) == sorted(str(r) for r in op08.keep_bitmaps(rows).collect())


# 9


def test_wider_keys_and_parts_give_the_same(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    wanted = {r.doc_id: r.component_id for r in op09.components(docs).collect()}
    cuts = op09.CUTS
    try:
        for n in (7, 8):
            op09.CUTS = ((0, n),)
            assert {r.doc_id: r.component_id for r in op09.components(docs.withColumn("fp", F.lit("clash"))).collect()} == wanted
    finally:
        op09.CUTS = cuts
    alike = {r.doc_id: r.component_id for r in op09.alike(docs).collect()}
    assert {r.doc_id: r.component_id for r in op09.alike(docs, unit=3).collect()} == alike


# the pipeline


def test_pipeline_of_odd_input(spark):
    import corpus_pipeline

    kind = "doc_id long, text string, lang string, source string, n_chars long, row string"
    rows = [(i, t, "en", "s", len(t or ""), "clash") for i, t in enumerate([None, "", " \n", "a", *["the same words stand here again and again for the test"] * 3, "word " * 2000])]
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        state = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            state = stage(spark, state, SMALL)
            assert state.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, state, SMALL).count() == state.count()
