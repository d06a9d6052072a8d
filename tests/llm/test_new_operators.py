"""The bit-sliced index, the audit of filters and the manifest, against plain versions and on odd input."""

import hashlib
import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from oracle import same

from rillflow.llm import op11_topk as op11
from rillflow.llm import op12_filters as op12
from rillflow.llm import op13_merkle as op13
from rillflow.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", ["op11_exact_topk", "op12_filter_audit", "op13_merkle_manifest"])
def test_matches_sql(spark, name):
    same(QUERIES[name](spark, SMALL), ORACLES[name], SMALL)


# 11


def plain_top(rows, k=20, every=20):
    """(query id, ranks of (id, score)) of each query row, by all products."""
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(ok):
        if i is not None and i % every == 0:
            found = sorted(((-sum(x * y for x, y in zip(v, w)), j is None, j or 0) for b, (j, w) in enumerate(ok) if b != a))[:k]
            out.append((i, tuple((None if none else j, -s) for s, none, j in found)))
    return sorted(out, key=str)


def found_top(df):
    by = {}
    for r in df.collect():
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return sorted(((q, tuple((v, s) for _, v, s in sorted(x, key=lambda t: t[0]))) for q, x in by.items()), key=str)


def test_topk_ties_nulls_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(op11, "STRIP", 2)
    monkeypatch.setattr(op11, "QUERIES", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 5) / 64]) for i in range(400)]  # many ties
    rows += [(1000, [0.5, -0.25]), (1001, []), (1020, []), (1002, None), (1003, [1.0, None]), (1004, [float("nan")]), (1005, [float("-inf"), 1.0]), (None, [3.0, 3.0, 3.0, 3.0, 3.0]), (-20, [-7.3, 0.0, 9.9, 1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    blocks = op11.index(df, block=64)
    assert blocks.count() > 4
    assert found_top(op11.top(blocks, op11.queries_of(blocks))) == plain_top(rows)


def test_topk_repeated_rows_few_rows_and_none(spark):
    kind = "vec_id long, embedding array<float>, score string, rank int"
    rows = [(20, [1.0, 2.0], "x", 9), (20, [1.0, 2.0], "x", 9), (7, [0.5, 0.5], None, None)]
    out = op11.op11_topk(spark.createDataFrame(rows, kind))
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((r.rank, r.vec_id, r.score) for r in out.collect()) == sorted([(1, 20, 64 * 64 * 5), (2, 7, 64 * 64 // 2 * 3)] * 2)
    assert op11.op11_topk(spark.createDataFrame([], kind)).count() == 0
    assert op11.op11_topk(spark.createDataFrame([(20, [1.0], "", 1)], kind)).count() == 0


def test_topk_refuses_what_leaves_63_bits(spark):
    with pytest.raises(Exception, match="too large"):
        op11.op11_topk(spark.createDataFrame([(1, [1e12])], "vec_id long, embedding array<double>")).count()


# 12


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    masks = []
    for i, text, lang, *_ in docs:
        t = text or ""
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        fails = (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t), i is not None and i > least.get(t, i))
        masks.append((lang or "", fails, i in good and i is not None, i in toxic and i is not None))
    out = {}
    for part in {m[0] for m in masks}:
        own = [m for m in masks if m[0] == part]
        shapley = Counter()
        for order in itertools.permutations(range(5)):
            name, alive = "".join("ABCDE"[f] for f in order), own
            for step, f in enumerate(order, 1):
                gone = [m for m in alive if m[1][f]]
                alive = [m for m in alive if not m[1][f]]
                failing = sum(m[1][f] for m in own)
                unique = sum(m[1][f] and sum(m[1]) == 1 for m in own)
                out[part, name, step] = [len(alive), len(gone), failing - len(gone), unique, sum(m[2] for m in gone), sum(m[3] for m in gone)]
                shapley[f] += len(gone)
        for (p, name, step), row in out.items():
            if p == part:
                row.append(shapley["ABCDE".index(name[step - 1])])
    return {k: tuple(v) for k, v in out.items()}


def test_every_order_once_by_swaps():
    for n in range(1, 6):
        order = list(range(n))
        seen = {tuple(order)}
        for at in op12.swaps(n):
            order[at], order[at + 1] = order[at + 1], order[at]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(n)
        assert len(list(op12.swaps(n))) == math.factorial(n) - 1


def test_audit_of_odd_documents(spark):
    long = " ".join(f"w{i}" for i in range(150))
    texts = [long, long, None, "", "ABC $", long + " #", "X" * 200, " ".join(["same"] * 120), "w\x0bw\x1fw " * 60, "é" * 1000, long, "a|b", " \t\n", None]
    docs = [(i * 3, t, ("en", "de", None, "")[i % 4], "s", 0) for i, t in enumerate(texts)]
    docs += [(None, long, "en", "s", 0), (None, "q", "en", "s", 0), (0, long, "en", "s", 0), (3, "new", "en", None, None)]
    labels = [(0, 1, 0), (0, None, 1), (3, 0, 1), (None, 1, 1), (6, 1, None), (12, 1, 1), (999, 1, 1)]
    for rows in (op12.BROADCAST_ROWS, 0):
        d = spark.createDataFrame([(*r, "clash", 1) for r in docs], DOCS + ", part string, mask int")
        found = op12.op12_filters(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows)
        assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in op12.COUNTS) for r in found.collect()} == plain_audit(docs, labels)
    empty = spark.createDataFrame([], DOCS)
    assert op12.op12_filters(empty, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


# 13


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(docs, fanout=2):
    def leaf(doc_id, text, lang, source, n_chars):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def tree(leaves):
        """The root, and of every leaf the siblings per level."""
        nodes, members, proofs = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
        while len(nodes) > 1:
            up, up_members = [], []
            for a in range(0, len(nodes), fanout):
                run = nodes[a : a + fanout]
                for k, own in enumerate(members[a : a + fanout]):
                    for i in own:
                        proofs[i].append((run[:k], run[k + 1 :]))
                up.append(H("".join(run)))
                up_members.append([i for own in members[a : a + fanout] for i in own])
            nodes, members = up, up_members
        return nodes[0], proofs

    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append((d[0] is not None, d[0] or 0, leaf(*d), d))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in langs}
    root, upper = tree([trees[g][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for (_, _, own, d), proof in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1], strict=True):
            path = proof + upper[k]
            forged = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 and d[4] is not None
            acc = leaf(*d[:4], d[4] + 1) if forged else own
            for before, after in path:
                acc = H("".join(before) + acc + "".join(after))
            out.append((d[0], own, trees[g][0], root, H("".join("".join(b) + "".join(a) for b, a in path)), acc, acc == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest_of_odd_rows(spark, fanout, monkeypatch):
    monkeypatch.setattr(op13, "CUT_LEVELS", 2)
    docs = [(i * 7 % 101 - 20, f"täxt {i}", ("en", "de", None, "", "éa", "zz")[min(5, i * i % 7)], None if i % 5 else "s", None if i % 4 == 0 else i) for i in range(60)]
    docs += [(None, None, "en", None, None), (None, "", "en", "", 0), (5, "same", "fr", "s", 4), (5, "same", "fr", "s", 4), (5, "other", "fr", "s", 4), (1, "x" * 100_000, "lone", "s", 1)]
    df = spark.createDataFrame([(*r, "clash", 3) for r in docs], DOCS + ", leaf string, g int")
    for limit in (op13.BROADCAST_ROWS, 0):
        monkeypatch.setattr(op13, "BROADCAST_ROWS", limit)
        rows = df.select("doc_id", "lang", op13.leaf({c: df[c] for c in op13.FIELDS}).alias("h"))
        assert op13.manifest(rows, "lang", "doc_id", fanout, limit).count() == len(docs)
    out = op13.op13_merkle(df, fanout)
    assert sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str) == plain_manifest(docs, fanout)


def test_manifest_of_one_row_and_of_none(spark):
    one = op13.op13_merkle(spark.createDataFrame([(3, "a", "en", "s", 1)], DOCS)).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == H("")
    assert op13.op13_merkle(spark.createDataFrame([], DOCS)).count() == 0
