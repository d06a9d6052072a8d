"""Gaps between lines against a plain version that closes the nearest one at a time."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from rillflow.operators import shapes

KIND = "stream string, part long, ax double, ay double, bx double, by double, limit double"


def plain_bridges(rows: list[tuple]) -> set[tuple]:
    """Of the free ends of unlike lines the nearest two, one pair after the other."""
    out = set()
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        ends = {2 * r[1] + i: (r[2 + 2 * i], r[3 + 2 * i]) for r in own for i in (0, 1)}
        at = Counter(ends.values())
        line = {r[1]: r[1] for r in own}

        def join(p: int, q: int) -> None:
            old, new = line[p], line[q]
            for n, l in line.items():
                if l == old:
                    line[n] = new

        for e, p in ends.items():
            for f, q in ends.items():
                if p == q and at[p] == 2:
                    join(e // 2, f // 2)
        free = [e for e, p in ends.items() if at[p] == 1]
        while True:
            pairs = [(((ends[e][0] - ends[f][0]) ** 2 + (ends[e][1] - ends[f][1]) ** 2) ** 0.5, e, f) for e in free for f in free if e < f and line[e // 2] != line[f // 2]]
            gap, e, f = min(pairs, default=(own[0][6], 0, 0))
            if gap >= own[0][6]:
                break
            out.add((key, e // 2, e % 2, f // 2, f % 2))
            join(e // 2, f // 2)
            free = [x for x in free if x not in (e, f)]
    return out


def found(df) -> set[tuple]:
    return {(r.stream, r.from_part, r.from_end, r.to_part, r.to_end) for r in df.collect()}


def made(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows, n = [], 0
    for key, limit in (("a", 30.0), ("b", 4.0), ("c", 1000.0)):
        for _ in range(20):
            x, y = rng.uniform(0, 100), rng.uniform(0, 100)
            for _ in range(rng.randint(1, 3)):  # parts that meet
                u, v = x + rng.uniform(-15, 15), y + rng.uniform(-15, 15)
                rows.append((key, n, x, y, u, v, limit) if rng.random() < 0.5 else (key, n, u, v, x, y, limit))
                x, y, n = u, v, n + 1
    return rows


@pytest.mark.parametrize("seed", [1])
def test_nearest_ends_first(spark, seed, monkeypatch):
    rows = made(seed)
    want = plain_bridges(rows)
    assert len({k for k, *_ in want}) == 3
    monkeypatch.setattr(shapes, "CELL_ENDS", 4)  # begins with small cells
    assert found(shapes.bridges(spark.createDataFrame(rows, KIND), "stream", "limit")) == want


def test_star_loop_and_gap(spark):
    """Ends that meet are no free ones, a line is never bridged with itself, and what lies at the limit stays open."""
    star = [("s", i, 0.0, 0.0, x, y, 3.0) for i, (x, y) in enumerate([(9.0, 0.0), (-9.0, 0.0), (0.0, 9.0)])]
    loop = [("l", 10, 0.0, 0.0, 5.0, 0.0, 9.0), ("l", 11, 5.0, 0.0, 5.0, 5.0, 9.0), ("l", 12, 0.0, 1.0, 5.0, 5.0, 9.0)]  # open by 1
    gap = [("g", 20, 0.0, 0.0, 10.0, 0.0, 2.0), ("g", 21, 11.0, 0.0, 20.0, 0.0, 2.0), ("g", 22, 30.0, 0.0, 22.0, 0.0, 2.0)]  # gaps of 1 and 2
    near = [("s", 3, 10.0, 0.0, 20.0, 0.0, 3.0), ("s", 4, 0.5, 0.5, 0.5, -20.0, 3.0)]  # one at a tip, one near the middle
    odd = [(None, 30, 0.0, 0.0, 1.0, 1.0, 5.0), ("n", 31, None, 0.0, 1.0, 1.0, 5.0), ("n", 32, 1.5, 1.0, 8.0, 8.0, 5.0), ("z", 33, 0.0, 0.0, 4.0, 0.0, None), ("z", 34, 4.1, 0.0, 9.0, 0.0, None)]
    rows = spark.createDataFrame(star + loop + gap + near + odd, KIND)
    pairs = shapes.bridges(rows, "stream", "limit")
    assert found(pairs) == {("s", 0, 1, 3, 0), ("g", 20, 1, 21, 0), ("n", 31, 1, 32, 0)}
    line = {r.part: r.line for r in shapes.closed_lines(rows, "stream", pairs).collect()}
    assert len(line) == 16 - 1 + 1 and line[3] == line[0] == 0 and line[21] == 20 and line[22] == 22 and line[12] == 10 and line[34] == 34


def test_no_parts(spark):
    parts = spark.createDataFrame([], KIND)
    pairs = shapes.bridges(parts, "stream", "limit")
    assert not pairs.count() and not shapes.closed_lines(parts, "stream", pairs).count()
