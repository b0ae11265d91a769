"""Hard negatives against brute force; the tree's bounds; edges."""

import math

import numpy as np
from pyspark.sql import functions as F

from citecube.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, id string, cell int, anchor_id int, p int"


def make(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "x", 1, 2, 3)
                                  for i, v, lab in rows], SCHEMA)


def brute(rows, every=3):
    good = [(i, [math.floor(256 * x) if abs(x) < 1e15 else int(x) * 256 for x in v], lab) for i, v, lab in rows
            if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, v, lab in good:
        if i % every == 0 and (i not in anchors or v < anchors[i][0]):
            anchors[i] = (v, lab)
    out = []
    for a, (v, lab) in anchors.items():
        near = sorted((-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(v, w)))), i, other)
                      for i, w, other in good if i != a and len(w) == len(v))
        near = [(-s, i, other) for s, i, other in near]
        for ps, p, _ in [n for n in near if n[2] == lab][:5]:
            hits = [(s, i) for s, i, other in near if other != lab and 80 * ps <= 100 * s <= 100 * ps][:5]
            out += [(a, p, r + 1, i, ps, s) for r, (s, i) in enumerate(hits)]
    return sorted(out)


def run(vectors, every=3):
    return sorted(map(tuple, hn.hard_negatives(vectors, F.col("vec_id") % every == 0, F.col("label")).collect()))


def hostile(seed, many=260):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((6, 12)) / 3
    rows = [(i, centers[i % 6] + rng.standard_normal(12) / 6, int(rng.integers(0, 3))) for i in range(many)]
    rows += [(1000 + k, rows[0][1], k % 3) for k in range(90)]                       # a third of all rows alike
    rows += [(2000, None, 1), (2001, [None] * 12, 1), (2002, [math.nan] * 12, 1), (2003, rows[1][1], None), (None, rows[1][1], 1),
             (2004, [], 1), (2007, [], 2), (2005, [0.5, 1.0], 1), (2006, [0.5, 1.0], 2), (2010, [0.5, 1.1], 1), (2013, [0.0] * 12, 0)]
    return [(i, None if v is None else list(v), lab) for i, v, lab in rows]


def test_against_brute_force(spark, monkeypatch):
    for name, value in (("CHUNK", 16), ("GROUP", 20), ("SAMPLE", 60)):      # many chunks, groups and rows outside the sample
        monkeypatch.setattr(hn, name, value)
    rows = hostile(1)
    want = brute(rows)
    assert len(want) > 300
    assert run(make(spark, rows)) == want


def test_repeated_ids_and_huge_components(spark):
    rows = [(i, [((i * 7) % 11) / 4, 1.0], i % 2) for i in range(40)] + [(3, [0.25, 0.5], 0), (4, [2.0, 2.0], 0), (4, [2.0, 2.0], 0)]
    rows += [(51, [1e18, 3.0], 0), (52, [9e17, 2.0], 0), (53, [9e17, 1.0], 1), (54, [1e300, 1.0], 1)]
    got, want = run(make(spark, rows)), brute(rows)
    twice = (4,)       # equal rows are two positives, each with negatives of its own
    assert [r for r in got if r[1] not in twice] == [r for r in want if r[1] not in twice]
    assert sorted(got) == sorted(want)


def test_edges(spark):
    assert run(make(spark, []).limit(0)) == []
    rows = [(3, [1.0], 0), (4, [1.0], 0), (5, [1.0], 1), (6, [-1.0], 1), (7, [0.9], 2)]
    assert run(make(spark, rows)) == brute(rows)


def test_no_leaf_with_a_hit_is_eliminated():
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.standard_normal((3000, 4)))
    tree = hn.Tree(x[:1000])
    for node, j, rows, apart in tree.descend(x):
        square = (x[rows] ** 2).sum(axis=1)
        tree.ranges[node, j] = (apart.min(axis=0), apart.max(axis=0), square.min(), square.max())
    leaf, eliminated = tree.leaf_of(x), 0
    for q in x[:60]:
        s = x @ q
        top = np.sort(s)[-6]
        for low, high in ((top, math.inf), (0.9 * top, top), (-10.0, 10.0)):
            found = tree.search(q, np.array([low]), np.array([high]))
            assert set(leaf[(s >= low) & (s <= high)].tolist()) <= set(found)
            eliminated += tree.leaves - len(found)
    assert eliminated > 60 * tree.leaves      # and a third of all leaves goes, at least
