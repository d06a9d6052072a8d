"""Each operator against brute force, and with odd input: nulls, empty and long texts, ties, repeats, no rows, clashing columns."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash
from conftest import SMALL
from oracle import same

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
from rillflow.llm.util import table, written

ODD = [None, "", " \t\n", "a", "ß🙂 naïve\n\n\nx", "the same line\nof text", "the same line\nof text", "word " * 30_000, "\x00\x1b odd", "1234567 12,5% MiXeD  Case"]
KIND = "doc_id long, text string"


def odd(spark, kind: str = KIND):
    return spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], kind)


def empty(spark, kind: str = KIND):
    return spark.createDataFrame([], kind)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents").cache()


# 1


def test_leaks_are_found(spark, docs):
    benchmark = table(spark, SMALL, "benchmark")
    found = {(r.doc_id, r.item_id) for r in op01.leaks(docs, benchmark).collect()}
    shingles = {}
    for r in benchmark.collect():
        w = r.text.lower().split()
        for i in range(len(w) - 7):
            shingles.setdefault(tuple(w[i : i + 8]), set()).add(r.item_id)
    plain = Counter()
    for r in docs.select("doc_id", "text").collect():
        w = (r.text or "").lower().split()
        for i in range(len(w) - 7):
            plain.update((r.doc_id, x) for x in shingles.get(tuple(w[i : i + 8]), ()))
    assert {k for k, n in plain.items() if n >= 5} <= found <= set(plain)


QUESTION = "A farmer named Miller drives 12 km to the market and sells 40 apples at 3 dollars each before he drives 12 km back home again"
AGAIN = QUESTION.replace("Miller", "Smith").replace("12", "35").replace("40", "99").replace("3 ", "7 ")
BROKEN = QUESTION.replace("12 km to", "17 km to").replace("40", "17").replace("12 km", "88 km").replace("3 ", "17 ").replace("Miller", "Smith")


def test_slots_must_be_consistent(spark):
    benchmark = spark.createDataFrame([(1, QUESTION), (2, None), (3, ""), (None, QUESTION), (4, "Too short")], "item_id int, text string")
    rows = spark.createDataFrame([(1, AGAIN, "x"), (2, "He said that " + AGAIN + ". And so on", "x"), (3, "Nothing of that kind stands in this text at all, it is clean", "x"), (4, None, "x"), (5, "", "x"), (1, AGAIN, "x"), (None, AGAIN, "x")], KIND + ", item_id string")
    assert {(r.doc_id, r.item_id) for r in op01.leaks(rows, benchmark).collect()} == {(1, 1), (2, 1)}
    joined = op01.leaks(rows, benchmark, broadcast_rows=0)  # by a shuffle
    assert {(r.doc_id, r.item_id) for r in joined.collect()} == {(1, 1), (2, 1)}
    kept = op01.without_leaks(rows, benchmark.where("item_id is not null"))
    assert kept.columns == rows.columns and {r.doc_id for r in kept.collect()} == {3, 4, 5, None}


def test_contradicting_slots(spark):
    item = "the train takes 10 minutes then 10 minutes then 10 minutes then 10 minutes then stops at last there"
    other = "the train takes 10 minutes then 20 minutes then 30 minutes then 40 minutes then stops at last there"
    benchmark = spark.createDataFrame([(1, item)], "item_id int, text string")
    assert not op01.leaks(spark.createDataFrame([(1, other)], KIND), benchmark).count()
    assert op01.leaks(spark.createDataFrame([(1, item.replace("10", "55"))], KIND), benchmark).count() == 1


TANK = "the tank loses 3 cups each hour and then loses 5 cups each hour and then loses 4 cups each hour and then loses 9 cups each hour and then it is empty"


def test_each_place_by_itself(spark):
    benchmark = spark.createDataFrame([(1, QUESTION), (2, TANK)], "item_id int, text string")
    torn = lambda text: text.replace("dollars", "whole dollars")
    rows = [(1, f"{QUESTION}. {AGAIN}"), (2, TANK), (3, f"It said {torn(QUESTION)}. {'Nothing of the kind stands here. ' * 9} {torn(AGAIN)}"), (4, BROKEN)]
    rows += [(5, TANK.replace("3", "11").replace("5", "12").replace("4 ", "13 ").replace("9", "14"))]
    found = {(r.doc_id, r.item_id): r for r in op01.leaks(spark.createDataFrame(rows, KIND), benchmark).collect()}
    assert set(found) == {(1, 1), (2, 2), (3, 1), (5, 2)}
    assert found[1, 1].n_windows == found[1, 1].item_windows == 19 and found[2, 2].n_windows >= 20


def test_few_literals_match_with_their_values(spark):
    sums = "What is 12 + 47 * 3 - 9 / 15 + 28 * 6 - 31 + 44?"
    benchmark = spark.createDataFrame([(1, sums), (2, "Name Paris twice"), (3, "42")], "item_id int, text string")
    rows = [(1, f"He asked. {sums} Nobody knew"), (2, sums.replace("47", "48").replace("15", "16").replace("12", "13").replace("31", "32").replace("9", "8").replace("28", "27")), (3, "please name Paris twice now"), (4, "name Rome twice"), (5, "it is 42.")]
    found = {(r.doc_id, r.item_id): (r.n_windows, r.item_windows) for r in op01.leaks(spark.createDataFrame(rows, KIND), benchmark).collect()}
    assert found == {(1, 1): (4, 4), (3, 2): (1, 1), (5, 3): (1, 1)}
    long = spark.createDataFrame([(9, "Ask Ann Bob Cid Dan Eve 7 8 9 10 11 12 13 of the two men now")], "item_id int, text string")
    text = "Ask Ann Bob Cid Dan Eve 7 8 9 10 11 12 13 and so on and on"
    assert op01.leaks(spark.createDataFrame([(1, text), (2, text.replace("7 8 9", "1 2 3"))], KIND), long).select("doc_id").collect() == [(1,)]


def test_leaks_of_nothing(spark):
    items = "item_id int, text string"
    assert not op01.leaks(empty(spark), spark.createDataFrame([(1, QUESTION)], items)).count()
    assert not op01.leaks(odd(spark), empty(spark, items)).count()
    assert op01.without_leaks(odd(spark), empty(spark, items)).count() == len(ODD)


# 2


@lru_cache
def encoding():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_that_of_the_library(spark, docs):
    rows = docs.select("doc_id", "text").union(odd(spark).selectExpr("doc_id + 1000000", "text"))
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    out = op02.op02_bpe(rows).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = encoding()[1].encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_round_trip_in_small_chunks(spark):
    ranks, known = encoding()
    rows = odd(spark)
    ids = op02.encode(rows, ranks, public_tokenizers.PATTERN, chunk_chars=50)
    assert {r.doc_id: list(r.ids) for r in ids.collect()} == {i: known.encode_ordinary(t or "") for i, t in enumerate(ODD)}
    decoded = op02.decode(ids.withColumn("extra", ids.doc_id), ranks)
    assert {r.extra: bytes(r.decoded).decode() for r in decoded.collect()} == {i: t or "" for i, t in enumerate(ODD)}
    assert not op02.op02_bpe(empty(spark)).count()


def test_long_words_merge_alike():
    ranks, known = encoding()
    rng = random.Random(1)
    for n in (65, 200, 3000):
        word = "".join(rng.choice("abcdet") for _ in range(n))
        assert op02.merge(word.encode(), ranks) == known.encode_ordinary(word)


# 3


def test_segments_are_all_maximal_ones():
    def plain(s: list[int], lo: int, hi: int) -> list[tuple]:
        """By definition: the best segment, shortest of ties, then the same left and right of it."""
        best = max(((sum(s[a:b]), -(b - a), -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        a, b = -best[2], -best[2] - best[1]
        return plain(s, lo, a) + [(a, b, best[0])] + plain(s, b, hi)

    rng = random.Random(7)
    for _ in range(200):
        # ties between segments are left out: sums of distinct powers never tie
        s = [rng.choice((-1, 1)) * rng.random() for _ in range(rng.randrange(0, 14))]
        found = op03.segments(s)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in plain(s, 0, len(s))]


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    labels = table(spark, d, "labels")
    out = op03.op03_toxicity(table(spark, d, "documents"), labels).join(labels, "doc_id").where("held_out").toPandas()
    good = out["predicted"] == out["toxic"]
    assert good.mean() > 0.9 and out.loc[out["predicted"] == 1, "toxic"].mean() > 0.9


def test_toxicity_of_odd_rows(spark):
    model = op03.Model(words={"vile": 4.0}, slope=2.0, offset=-3.0)
    out = {r.doc_id: r.score for r in op03.score(odd(spark), model).collect()}
    assert len(out) == len(ODD) and all(0 <= x <= 1 for x in out.values())
    text = "good words here. " * 20 + "vile vile vile" + " more good words" * 20
    found = op03.passages(spark.createDataFrame([(1, text), (2, None)], KIND), model).collect()
    assert [text[r.first : r.last] for r in found] == ["vile vile vile"]
    labels = empty(spark, "doc_id long, toxic int")
    assert {r.predicted for r in op03.op03_toxicity(odd(spark), labels).collect()} == {0}
    assert not op03.op03_toxicity(empty(spark), labels).count()


# 4


def test_exact_dedup(spark):
    same(op04.op04_exact(table(spark, SMALL, "documents")), op04.ORACLE, SMALL)
    out = {r.doc_id: r for r in op04.op04_exact(odd(spark).withColumn("sha", op04.F.lit("clash"))).collect()}
    assert out[6].keep_id == 5 and not out[6].kept and out[0].group_size == 2 and out[0].keep_id == out[1].keep_id == 0
    assert not op04.op04_exact(empty(spark)).count()


def test_filter_holds_its_keys():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 5000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        data = op04.build_filter(keys)
        assert op04.in_filter(data, keys).all()
        assert op04.in_filter(data, rng.integers(1 << 63, (1 << 64) - 1, 10_000, dtype=np.uint64)).sum() < 10


# 5

PAGE = """<!doctype html><html><head><title>T</title><style>p {}</style><script>var x = "<p>no</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav>
<div class="cookie-notice">We use cookies on this site</div>
<div id=main><article><h1>A   headline &amp; more</h1><p>First paragraph with <b>bold</b> words and a good deal of text in it, so that it is dense.<p>Second paragraph,
over two lines, with text enough &eacute; to count for something.</article></div>
<aside>Read also</aside><div class=comments><p>What a silly reader comment stands here, long and dense enough to be taken as text.</p></div><footer>Imprint</footer></body></html>"""


def test_main_text(spark):
    rows = spark.createDataFrame([(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, "u", "<p>un<closed & &bogus; "), (5, None, "<div>" * 3000 + "deep")], "page_id long, url string, html string")
    out = {r.page_id: r for r in op05.op05_html(rows).collect()}
    assert out[1].text == "A headline & more\n\nFirst paragraph with bold words and a good deal of text in it, so that it is dense.\n\nSecond paragraph, over two lines, with text enough é to count for something."
    assert out[1].n_chars == len(out[1].text) and out[2].text == out[3].text == "" and out[5].text == "deep"
    assert not op05.op05_html(rows.where("false")).count()


def test_main_text_of_several_containers():
    p = lambda word: f"<p>{' '.join([word] * 50)}</p>"
    links = "<div>" + "".join(f"<a href=/{i}>Link number {i}</a> " for i in range(12)) + "</div>"
    article = f"<div class=content><div><h2>One</h2>{p('alpha') * 3}</div><h2>Two</h2><div>{p('gamma') * 3}</div><div>{p('delta') * 3}</div></div>"
    whole = ["One", *[" ".join(["alpha"] * 50)] * 3, "Two", *[" ".join(["gamma"] * 50)] * 3, *[" ".join(["delta"] * 50)] * 3]
    for page in (article, f"<div id=page>{links}{article}{links}</div>", f"<body>{links}<div><div>{article}</div></div><span>Imprint</span></body>"):
        assert op05.main_text(page).split("\n\n") == whole
    assert op05.main_text(f"<body><div>{p('alpha')}<p><b>{'beta ' * 99}</b><br></p><p>End.</p></div>{links}</body>").endswith("End.")


# 6


def test_counts_are_those_of_greedy_pieces(spark):
    pieces = op06.read_pieces(op06.default_path())
    own, longest = set(pieces), max(map(len, pieces))

    def greedy(word: str) -> int:
        n, at = 0, 0
        while at < len(word):
            end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in own), 0)
            if not end:
                return 1
            n, at = n + 1, end
        return n

    rows = table(spark, SMALL, "documents").select("doc_id", "text").union(odd(spark).selectExpr("doc_id + 1000000", "text"))
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    known: dict[str, int] = {}
    for r in op06.count_tokens(rows, pieces).collect():
        words = texts[r.doc_id].split()
        for w in words:
            if w not in known:
                known[w] = greedy(op06.MARK + w)
        assert (r.n_words, r.n_tokens) == (len(words), sum(known[w] for w in words))
    assert not op06.op06_tokens(empty(spark)).count()


# 7


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    labels = table(spark, d, "labels")
    out = op07.op07_quality(table(spark, d, "documents"), labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (out["predicted"] == out["quality"]).mean() > 0.95


def test_rules_as_columns(spark):
    model = op07.Model(0.5, [(1.5, (("bangs", False, 0.2), ("digits", True, 0.1)))], [(-2.0, "capitals", 0.0, 0.5)])
    out = op07.score(odd(spark), model).collect()
    for r in out:
        z = 0.5 + 1.5 * (r.bangs > 0.2 and r.digits <= 0.1) - 2 * min(max(r.capitals, 0), 0.5) / 0.5
        assert math.isclose(r.score, 1 / (1 + math.exp(-z)), rel_tol=1e-9)
    labels = empty(spark, "doc_id long, quality int")
    assert op07.op07_quality(odd(spark), labels).count() == len(ODD)
    assert not op07.op07_quality(empty(spark), labels).count()


# 8


def test_line_dedup(spark):
    d = "/root/testdata/sf0.01"
    same(op08.op08_lines(table(spark, d, "documents")), op08.ORACLE, d)


def test_line_dedup_of_odd_rows(spark):
    texts = [f"  Hot LINE\t\nown {i}\n\nhot line" for i in range(12)] + [None, "", "hot line"]
    rows = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(texts)], KIND + ", n_chars long, pos string")
    out = {r.doc_id: r for r in op08.without_repeated_lines(rows).collect()}
    assert out[3].text == "own 3\n" and out[3].n_chars == 6 and out[12].text is None and out[13].text == "" and out[14].text == ""
    bits = op08.keep_bitmaps(rows).where("doc_id = 3").first()
    assert [(r.first, r.last) for r in bits.dropped_runs] == [(0, 0), (3, 3)]
    assert not op08.op08_lines(empty(spark)).count()


# 9


def brute_components(fps: dict[int, int]) -> dict[int, int]:
    ids = sorted(fps)
    found = {i: i for i in ids}
    f = np.array([fps[i] for i in ids], np.uint64)
    again = True
    while again:
        again = False
        for k, i in enumerate(ids):
            near = [ids[j] for j in np.flatnonzero(np.bitwise_count(f ^ f[k]) <= 4)]
            least = min(found[j] for j in near)
            for j in [i, *near]:
                if found[j] != least:
                    found[j], again = least, True
    return found


def plain_fingerprint(text: str | None) -> int:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components(spark, docs):
    rows = docs.select("doc_id", "text").union(odd(spark).where("doc_id != 7").selectExpr("doc_id + 1000000", "text"))
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows.collect()}
    for bucket in (op09.MAX_BUCKET, 2):  # the second: by midpoints
        out = op09.components(rows, max_bucket=bucket).collect()
        assert {r.doc_id: r.fp & ((1 << 64) - 1) for r in out} == fps
        assert {r.doc_id: r.component_id for r in out} == brute_components(fps)
    kept = op09.keep_one(rows)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_components(fps).values()))
    assert not op09.op09_simhash(empty(spark)).count()


def test_near_copies_by_similarity(spark, docs):
    words = [f"w{i}" for i in range(200)]
    at = lambda *places: " ".join("new" if i in places else w for i, w in enumerate(words))
    rows = spark.createDataFrame([(1, at()), (2, at(20, 60, 100, 140)), (3, at(20, 40, 60, 80, 100, 120)), (4, None), (5, " ")], KIND)
    assert {r.doc_id for r in op09.keep_one(rows).collect()} == {1, 2, 3, 4}  # 4 bits are too few
    # similarities: of 1 and 2 176/216, of 2 and 3 the same, of 1 and 3 166/226
    assert {r.doc_id for r in op09.keep_one(rows, 0.8).collect()} == {1, 4}
    assert {r.doc_id for r in op09.keep_one(rows.where("doc_id != 2"), 0.8).collect()} == {1, 3, 4}
    crowd = docs.select("doc_id", "text").union(odd(spark).where("doc_id != 7").selectExpr("doc_id + 1000000", "text"))
    crowd = crowd.union(spark.createDataFrame([(2000000 + i, at(*range(i, i + 1 + i % 9))) for i in range(60)], KIND))
    sets = {}
    for r in crowd.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").lower())
        sets[r.doc_id] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    least = {i: i for i in sets}
    again = True
    near = [(i, j) for i in sets for j in sets if i < j and (sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0)]
    while again:
        again = False
        for i, j in near:
            if least[i] != least[j]:
                least[i] = least[j] = min(least[i], least[j])
                again = True
    assert {r.doc_id: r.component_id for r in op09.alike(crowd).collect()} == least
    assert not op09.alike(empty(spark)).count()


def test_fingerprints_propose_near_copies(spark, docs):
    """Without minhashes: pairs in one component of the fingerprints of the sets are compared, and the similarity decides."""
    words = [f"w{i}" for i in range(400)]
    at = lambda *places: " ".join("new" if i in places else w for i, w in enumerate(words))
    rows = docs.select("doc_id", "text").union(odd(spark).where("doc_id != 7").selectExpr("doc_id + 1000000", "text"))
    rows = rows.union(spark.createDataFrame([(2000000 + i, at(*range(i, i + i % 3))) for i in range(40)], KIND))
    sets = {r.doc_id: op09.shingles(r.text) for r in rows.collect()}
    fps = {i: sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in own) > len(own)) for i, own in sets.items()}
    assert fps == {i: op09.set_fingerprint(own) for i, own in sets.items()}
    near = brute_components(fps)
    of_set = {}
    for i in sorted(sets):
        of_set.setdefault(sets[i].tobytes(), i)
    least = {i: of_set[own.tobytes()] for i, own in sets.items()}
    once = sorted(of_set.values())
    linked = [(i, j) for i in once for j in once if i < j and near[i] == near[j] and op09.jaccard(sets[i], sets[j]) >= 0.8]
    for i, j in linked * len(linked):
        if least[i] != least[j]:
            low, high = sorted((least[i], least[j]))
            least = {k: low if v == high else v for k, v in least.items()}
    assert len(set(least.values())) < len(once)
    assert {r.doc_id: r.component_id for r in op09.alike(rows, bands=0).collect()} == least
    assert {r.doc_id: r.component_id for r in op09.alike(rows, bands=0, unit=3).collect()} == least


# 10


def test_language_on_held_out_rows(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = op10.op10_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").toPandas()
    assert (out["lang_pred"] == out["lang"]).mean() > 0.97


def test_language_of_odd_rows(spark):
    rows = spark.createDataFrame([(i, "the house is big" if i % 2 else "das Haus ist groß", "en" if i % 2 else "de", "x") for i in range(40)] + [(90, None, "en", "x"), (91, "123 !", None, "x")], KIND + ", lang string, score string")
    out = {r.doc_id: r for r in op10.op10_language(rows).collect()}
    assert len(out) == 42 and out[90].lang_pred == out[91].lang_pred == "und" and out[90].score == 0
    assert all(out[i].lang_pred == ("en" if i % 2 else "de") for i in range(40))
    kept = op10.keep_recognised(rows)
    assert kept.columns == rows.columns and kept.count() == 40
    none = empty(spark, KIND + ", lang string")
    assert not op10.op10_language(none).count()
    assert {r.lang_pred for r in op10.op10_language(odd(spark).withColumn("lang", op10.F.lit(None).cast("string"))).collect()} == {"und"}


def test_long_texts_in_slices(monkeypatch):
    text = "Some text, with l'été and 12 numbers — " * 50
    whole = op10.sparse(text, 1 << 12)
    monkeypatch.setattr(op10, "SLICE", 37)
    sliced = op10.sparse(text, 1 << 12)
    assert (whole[0] == sliced[0]).all() and (whole[1] == sliced[1]).all()


# the pipeline


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, SMALL, "documents")
    state = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, state, SMALL)
        assert after.columns == docs.columns
        state = written(after)
    out = corpus_pipeline.run(spark, SMALL).toPandas()
    ids = set(pd.Series([r.doc_id for r in state.select("doc_id").collect()]))
    assert set(out["doc_id"]) == ids and 0 < len(ids) < docs.count()
